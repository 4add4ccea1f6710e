"""Exact duplicates by counting quotient filters.

A 64-bit fingerprint is split into a quotient (high bits) and a remainder. Every task builds a
filter of its own rows: per block of quotients a bitmap of the quotients in use, a bitmap that
ends the run of each, the sorted remainders and their counters. Filters of one block merge
without loss, because their remainders are sorted: merging is a merge of sorted runs that adds
counters. Only fingerprints counted more than once send their texts to byte verification.

Defined results: a null text counts as empty. Rows are equal when their texts are identical after
replacing every run of white space by one space. Of rows that also share the smallest ``doc_id``
one stays. A null ``doc_id`` is larger than any other. Other columns, whatever their names, are
never read; in :func:`deduplicate` they stay as they are.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skylattice.llm.common import BLANK, small, stage

FILTER = "block long, occupied binary, ends binary, remainders binary, counts binary"
#: Fingerprints that a task gathers before it writes a filter.
BATCH = 2_000_000
#: Groups of copies (about a hundred bytes each) up to which texts need no shuffle to find theirs.
GROUPS = 300_000


def normalised(text: str | Column = "text") -> Column:
    """The text with each run of white space replaced by one space; null is empty."""
    text = F.col(text) if isinstance(text, str) else text
    # A single space already is what it would become, so only other runs are matched.
    runs = rf"[\x09-\x0D][{BLANK}]*|\x20[{BLANK}]+"
    return F.regexp_replace(F.coalesce(text, F.lit("")), runs, " ")


class Layout:
    """How a fingerprint is divided: ``q`` quotient bits, the low ``k`` of them inside a block."""

    def __init__(self, rows: int) -> None:
        self.q = min(40, max(14, math.ceil(math.log2(max(rows, 1))) + 1))
        self.k = max(8, min(16, self.q - 7))
        self.r = 64 - self.q

    def pack(self, prints: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        """Filters, one row a block, of sorted distinct fingerprints and their counts."""
        quotient = prints >> np.uint64(self.r)
        block = (quotient >> np.uint64(self.k)).astype(np.int64)
        inside = (quotient & np.uint64((1 << self.k) - 1)).astype(np.int64)
        rest = prints & np.uint64((1 << self.r) - 1)
        last = np.r_[quotient[1:] != quotient[:-1], True][: len(quotient)]
        cuts = np.r_[0, np.flatnonzero(np.diff(block)) + 1, len(block)] if len(block) else np.array([0])
        rows: dict[str, list] = {name: [] for name in ("block", "occupied", "ends", "remainders", "counts")}
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            used = np.zeros(1 << self.k, dtype=np.uint8)
            used[inside[a:b]] = 1
            rows["block"].append(int(block[a]))
            rows["occupied"].append(np.packbits(used).tobytes())
            rows["ends"].append(np.packbits(last[a:b]).tobytes())
            rows["remainders"].append(rest[a:b].astype("<u8").tobytes())
            rows["counts"].append(counts[a:b].astype("<i8").tobytes())
        kinds = (pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary())
        return pa.record_batch([pa.array(v, t) for v, t in zip(rows.values(), kinds, strict=True)], list(rows))

    def unpack(self, block: int, occupied: bytes, ends: bytes, remainders: bytes, counts: bytes):
        """The sorted fingerprints and counts of one filter."""
        rest = np.frombuffer(remainders, "<u8")
        last = np.unpackbits(np.frombuffer(ends, np.uint8), count=len(rest)).astype(np.int64)
        used = np.flatnonzero(np.unpackbits(np.frombuffer(occupied, np.uint8)))
        run = np.cumsum(last) - last  # index of the run that each remainder is in
        quotient = (np.uint64(block) << np.uint64(self.k)) | used[run].astype(np.uint64)
        return (quotient << np.uint64(self.r)) | rest, np.frombuffer(counts, "<i8")


def counted(prints: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct fingerprints in order, with the sums of their counts."""
    if not len(prints):
        return prints, counts
    order = np.argsort(prints, kind="stable")
    prints, counts = prints[order], counts[order]
    first = np.r_[0, np.flatnonzero(prints[1:] != prints[:-1]) + 1]
    return prints[first], np.add.reduceat(counts, first)


def build(prints: DataFrame, layout: Layout) -> DataFrame:
    """Filters of the single ``bigint`` column, one or more a task, one row a block in use."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            held.append(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))
            if sum(map(len, held)) >= BATCH:
                yield layout.pack(*np.unique(np.concatenate(held), return_counts=True))
                held = []
        if sum(map(len, held)):
            yield layout.pack(*np.unique(np.concatenate(held), return_counts=True))

    return prints.mapInArrow(task, FILTER)


def merge(filters: DataFrame, layout: Layout) -> DataFrame:
    """One filter a block. A group has one row a task at most, however often a text repeats."""

    def group(table: pa.Table) -> pa.Table:
        parts = [layout.unpack(*row.values()) for row in table.to_pylist()]
        merged = counted(np.concatenate([p for p, _ in parts]), np.concatenate([c for _, c in parts]))
        return pa.Table.from_batches([layout.pack(*merged)])

    return filters.groupBy("block").applyInArrow(group, FILTER)


def repeated(filters: DataFrame, layout: Layout) -> DataFrame:
    """``(print, n)`` of the fingerprints that a merged filter counts more than once."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                prints, counts = layout.unpack(*row.values())
                many = counts > 1
                yield pa.record_batch([pa.array(prints[many].view(np.int64)), pa.array(counts[many])], ["print", "n"])

    return filters.mapInArrow(task, "print long, n long")


def _rows(docs: DataFrame) -> DataFrame:
    norm = normalised()
    return docs.select("doc_id", norm.alias("norm")).withColumn("print", F.xxhash64("norm"))


def verified(docs: DataFrame) -> DataFrame:
    """``(print, sha, keep, n, n_keep)`` for each text that occurs more than once.

    The filters name the fingerprints; grouping by the text itself compares bytes. Copies are
    combined before the shuffle, so one text of a group leaves each task.
    """
    layout = Layout(docs.count())
    prints = _rows(docs).select("print")
    many = stage(repeated(merge(build(prints, layout), layout), layout), "repeated")
    routed = _rows(docs).join(many.select("print"), "print", "left_semi")
    groups = (
        routed.groupBy("print", "norm", "doc_id")
        .agg(F.count("*").alias("n"))
        .groupBy("print", "norm")
        .agg(F.sum("n").alias("n"), F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "n")).alias("first"))
    )
    return stage(
        groups.where("n > 1").select(
            "print",
            F.sha2("norm", 256).alias("sha"),
            F.col("first.doc_id").alias("keep"),
            "n",
            F.col("first.n").alias("n_keep"),
        ),
        "verified",
    )


def mark(docs: DataFrame) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256``, one row for each row of ``docs``."""
    groups = verified(docs)
    rows = _rows(docs).select("doc_id", "print", F.sha2("norm", 256).alias("sha"))
    marked = rows.join(groups, ["print", "sha"], "left").select(
        "doc_id",
        F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("keep")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).alias("group_size"),
        (F.col("n").isNull() | F.col("doc_id").eqNullSafe(F.col("keep"))).alias("kept"),
        F.col("sha").alias("text_sha256"),
        (F.coalesce("n_keep", F.lit(1)) > 1).alias("again"),
    )
    marked = stage(marked, "marked")
    out = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    # Rows that repeat the staying row, its doc_id included: counted, then one of them stays.
    again = marked.where("again and kept").groupBy(*out).agg(F.count("*").alias("m"))
    again = again.select(*out, F.explode(F.sequence(F.lit(1), F.col("m"))).alias("i"))
    again = again.withColumn("kept", F.col("i") == 1)
    return marked.where("not (again and kept)").select(out).unionByName(again.select(out))


def deduplicate(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    groups = verified(docs).select(
        F.col("print").alias("__print"),
        F.col("sha").alias("__sha"),
        F.col("keep").alias("__keep"),
        F.col("n_keep").alias("__n_keep"),
    )
    rows = docs.withColumn("__norm", normalised())
    rows = rows.withColumn("__print", F.xxhash64("__norm")).withColumn("__sha", F.sha2("__norm", 256))
    rows = rows.drop("__norm").join(small(groups, GROUPS), ["__print", "__sha"], "left")
    rows = rows.where(F.col("__n_keep").isNull() | F.col("doc_id").eqNullSafe(F.col("__keep")))
    if groups.where("__n_keep > 1").isEmpty():
        return rows.select(*docs.columns)
    once = rows.where(F.coalesce("__n_keep", F.lit(1)) == 1).select(*docs.columns)
    again = rows.where("__n_keep > 1").groupBy("__print", "__sha")
    again = again.agg(F.first(F.struct(*docs.columns)).alias("__row")).select("__row.*")
    return once.unionByName(again)
