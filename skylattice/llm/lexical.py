"""Ranked lexical search without random access (NRA).

Every document that holds a term has an impact in the term's list: the term's weight times its
saturated frequency, in whole numbers. For an item the lists of its terms are read in step, from
the highest impact down. A document's lower score is what was read of it; its upper score adds, for
every list in which it was not yet seen, the next impact of that list. Reading goes on until the
documents that can still be among the first are known with lower and upper score equal, so that
membership, ties and final scores are settled; nothing is looked up outside of the lists.

Documents are dealt over tasks, whose lists hold their own documents; the first of each task meet by
item, and the first of these are the result. Weights come from the whole table beforehand. A task
handles ``Settings.documents`` documents and ``Settings.postings`` postings at a time, so memory does not grow with
the table; items go in blocks of bounded text, each of which reads the documents once.

Defined results: a null text has no terms; a document without terms of an item does not appear; rows
that repeat are documents of their own; equal scores go by ascending ``doc_id``, a null one last; items
that repeat count once, and an ``item_id`` with several texts is one item with the terms of all; items or
documents without terms give no rows. Only ``doc_id``, ``item_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skylattice.llm.common import stage
from skylattice.llm.words import words


@dataclass(frozen=True)
class Settings:
    top: int = 10
    #: Documents and postings whose lists a task holds at a time.
    documents: int = 20_000
    postings: int = 2_000_000
    #: Entries of each list in the first round, and by what the depth grows.
    depth: int = 32
    growth: int = 3
    #: Characters of the items of one block, and items.
    item_chars: int = 4_000_000
    items: int = 5_000


@dataclass(frozen=True)
class Items:
    """A block of items: ids, and the distinct terms of each with their number."""

    ids: list[int | None]
    terms: list[np.ndarray]
    times: list[np.ndarray]


RESULT = "item_id long, doc_id long, score long"
#: Documents in one batch of postings.
OUT_ROWS = 2_048


def item_blocks(items: DataFrame, settings: Settings) -> Iterator[tuple[Items, dict[bytes, int]]]:
    """The items in blocks of bounded size, each with the numbers of its terms."""
    plain = items.select(F.col("item_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")).distinct()
    n, chars = plain.agg(F.count("*"), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    blocks = max(1, -(-n // settings.items), -(-chars // settings.item_chars))
    for k in range(blocks):
        own = plain.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == k) if blocks > 1 else plain
        found: dict[int | None, Counter] = {}
        for r in own.toLocalIterator():
            found.setdefault(r["item_id"], Counter()).update(words(r["text"]))
        found = {i: c for i, c in found.items() if c}
        numbers = {t: j for j, t in enumerate(sorted(set().union(*found.values())))}
        yield (
            Items(
                list(found),
                [np.array([numbers[t] for t in c], dtype=np.int64) for c in found.values()],
                [np.array(list(c.values()), dtype=np.int64) for c in found.values()],
            ),
            numbers,
        )


def postings(docs: DataFrame, numbers: dict[bytes, int]) -> DataFrame:
    """``doc_id, n, terms, times``: a document's length, and which terms it holds how often."""
    shared = docs.sparkSession.sparkContext.broadcast(numbers)  # the terms of a block

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = shared.value
        for whole in batches:
            for start in range(0, whole.num_rows, OUT_ROWS):
                batch = whole.slice(start, OUT_ROWS)
                sizes, terms, times = [], [], []
                for text in batch.column(1):
                    found = words(text.as_py())
                    held = Counter(filter(None.__ne__, map(numbers.get, found)))
                    sizes.append(len(found))
                    terms.append(list(held))
                    times.append(list(held.values()))
                lists = pa.list_(pa.int32())
                yield pa.record_batch(
                    [batch.column(0), pa.array(sizes, pa.int64()), pa.array(terms, lists), pa.array(times, lists)],
                    ["doc_id", "n", "terms", "times"],
                )

    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(task, "doc_id long, n long, terms array<int>, times array<int>")


def weights(held: DataFrame, terms: int) -> tuple[int, int, np.ndarray]:
    """Documents with a term, all terms with repeats, and the weight of each term of the block."""
    n, length = held.where("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    by_term = held.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    weight = F.floor(F.lit(1000.0) * F.ln(F.lit(2.0 * n + 2) / (2 * F.col("df") + 1))).cast("long")
    out = np.zeros(terms, dtype=np.int64)
    for r in by_term.select("term", weight.alias("weight")).toLocalIterator():  # the terms of a block
        out[r["term"]] = r["weight"]
    return n, length, out


class Lists:
    """The impact-sorted lists of some documents. Impacts are without the terms' weights."""

    def __init__(self, term: np.ndarray, doc: np.ndarray, impact: np.ndarray, terms: int):
        order = np.lexsort((-impact, term))
        self.doc, self.impact = doc[order], impact[order]
        self.start = np.searchsorted(term[order], np.arange(terms + 1))

    def of(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        part = slice(self.start[term], self.start[term + 1])
        return self.doc[part], self.impact[part]


def nra(lists: Lists, terms: np.ndarray, by: np.ndarray, documents: int, settings: Settings) -> tuple[np.ndarray, np.ndarray, int]:
    """The documents that may be among the first, their final scores, and how many entries were read.

    ``by`` is what a list's impacts count for: the term's weight times its number in the item.
    """
    read = [(*lists.of(t), w) for t, w in zip(terms, by, strict=True) if w > 0]
    read = [(doc, impact, w) for doc, impact, w in read if len(doc)]
    lower = np.zeros(documents, dtype=np.int64)
    seen = np.zeros((len(read), documents), dtype=bool)
    at, depth, entries = [0] * len(read), settings.depth, 0
    none = np.zeros(0, dtype=np.int64)
    if not read:
        return none, none, 0
    while True:
        for k, (doc, impact, w) in enumerate(read):
            upto = min(depth, len(doc))
            part = doc[at[k] : upto]
            lower[part] += w * impact[at[k] : upto]  # a document stands once in a list
            seen[k, part] = True
            entries += len(part)
            at[k] = upto
        next_ = np.array([w * impact[a] if a < len(impact) else 0 for a, (_, impact, w) in zip(at, read, strict=True)])
        unseen = int(next_.sum())  # the upper score of a document that no list has shown
        least = max(int(np.partition(lower, -settings.top)[-settings.top]) if documents >= settings.top else 0, 1)
        if unseen < least:
            near = np.flatnonzero(lower + unseen >= least)
            upper = lower[near] + unseen
            for k in np.flatnonzero(next_):
                upper -= next_[k] * seen[k, near]
            near, upper = near[upper >= least], upper[upper >= least]
            if (upper == lower[near]).all():
                return near, lower[near], entries
        depth *= settings.growth


def search(docs: DataFrame, items: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``item_id, rank, doc_id, score``: the highest-scoring documents of each item."""
    spark = docs.sparkSession
    found = spark.createDataFrame([], RESULT)
    for block, numbers in item_blocks(items, settings):
        held = stage(postings(docs, numbers), "postings")
        found = found.unionByName(_first(held, block, *weights(held, len(numbers)), settings))
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= settings.top)
    return ranked.select("item_id", "rank", "doc_id", "score")


def _first(held: DataFrame, block: Items, n: int, length: int, weight: np.ndarray, settings: Settings) -> DataFrame:
    """The first documents of each item among those that a task holds at a time."""
    shared = held.sparkSession.sparkContext.broadcast((block, weight))  # the terms of a block

    def firsts(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        block, weight = shared.value
        ids = pa.concat_arrays([p.column(0) for p in parts])
        size = np.concatenate([p.column(1).to_numpy() for p in parts])
        held = [len(x) for p in parts for x in p.column(2)]
        term, times = (np.concatenate([p.column(k).flatten().to_numpy() for p in parts]).astype(np.int64) for k in (2, 3))
        middle = 25 + (75 * size * n) // max(length, 1)
        doc = np.repeat(np.arange(len(size)), held)
        impact = (1_000_000_000 * times) // (1000 * times + 8 * middle[doc])
        lists = Lists(term, doc, impact, len(weight))
        names = np.where(ids.is_null(), np.iinfo(np.int64).max, ids.fill_null(0).to_numpy())
        out: list[tuple[int | None, int | None, int]] = []
        for item, terms, number in zip(block.ids, block.terms, block.times, strict=True):
            near, scores, _ = nra(lists, terms, weight[terms] * number, len(size), settings)
            best = np.lexsort((near, names[near], -scores))[: settings.top]
            out += [(item, ids[int(near[b])].as_py(), int(scores[b])) for b in best]
        columns = zip(*out, strict=True) if out else ([], [], [])
        return pa.record_batch([pa.array(list(c), pa.int64()) for c in columns], ["item_id", "doc_id", "score"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, rows, entries = [], 0, 0
        for whole in batches:
            for start in range(0, whole.num_rows, OUT_ROWS):
                part = whole.slice(start, OUT_ROWS)
                parts.append(part)
                rows += part.num_rows
                entries += sum(len(c.flatten()) for c in (part.column(2),))
                if rows >= settings.documents or entries >= settings.postings:
                    yield firsts(parts)
                    parts, rows, entries = [], 0, 0
        if parts:
            yield firsts(parts)

    return held.where("size(terms) > 0").mapInArrow(task, RESULT)
