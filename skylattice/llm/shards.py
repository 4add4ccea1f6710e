"""Two-pass external shuffle into shards.

First pass: a seeded hash scatters the records uniformly over buckets that fit in a task's
memory. Second pass: each bucket is put in the order of a second seeded hash (so that the result
does not depend on the order in which the shuffle delivered it) and permuted by a seeded
Fisher-Yates shuffle. Buckets one after another are the shuffled corpus; cut into equal runs it
gives shards whose row counts differ by one at most (law ``rows``).

Defined results: a null text has no bytes (size 1) and checksum 0; an empty table gives no rows;
rows that repeat get a place each. A record's bucket depends on ``doc_id`` and text; rows equal in both go
by their other columns. The number of buckets follows the bytes of the table, so a bucket that
is larger than a task should hold comes of rows equal in both only; it is permuted in runs of
the second hash's order, which is uniform already, so memory stays bounded. Input columns named
as an output column are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

#: Bytes of text a bucket should hold, and the most a task permutes at once.
BUCKET_BYTES = 8 << 20
RUN_BYTES = 64 << 20
#: Fewest buckets, and up to how many their table of offsets (two longs each) is broadcast.
LEAST_BITS, SMALL_BITS = 8, 20
#: Bytes of buckets that go to one task.
TASK_BYTES = 64 << 20
OUT_BATCH = 512


def _keyed(docs: DataFrame, seed: int) -> DataFrame:
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")))
    key = F.xxhash64(F.lit(seed), F.col("doc_id"), crc)
    return docs.withColumn("__key", key)


def _bucket(bits: int):
    return F.shiftrightunsigned("__key", 64 - bits)


def scatter(docs: DataFrame, seed: int) -> tuple[DataFrame, DataFrame, int]:
    """``docs`` with ``__key`` and ``__bucket``, the offsets of the buckets, and the number of tasks."""
    keyed = _keyed(docs, seed)
    bytes_of = F.octet_length(F.coalesce(F.col("text"), F.lit(""))) + 1
    total = keyed.agg(F.sum(bytes_of)).first()[0] or 0
    # Small buckets while their offsets are a small table, then larger ones, of half a run at most.
    aim = min(RUN_BYTES / 2, max(BUCKET_BYTES, total / (1 << SMALL_BITS)))
    bits = max(LEAST_BITS, math.ceil(math.log2(max(1, total / aim))))
    counts = keyed.groupBy(_bucket(bits).alias("__bucket")).agg(F.count("*").alias("n"))
    # Prefix sums in two levels: inside pages of 1024 buckets, then over the pages.
    page = F.col("__bucket") - F.pmod(F.col("__bucket"), F.lit(1024))
    counts = counts.withColumn("page", page)
    inner = Window.partitionBy("page").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.orderBy("page").rowsBetween(Window.unboundedPreceding, -1)
    pages = counts.groupBy("page").agg(F.sum("n").alias("rows"))
    pages = pages.withColumn("before", F.coalesce(F.sum("rows").over(outer), F.lit(0)))
    offsets = counts.withColumn("inside", F.coalesce(F.sum("n").over(inner), F.lit(0))).join(pages, "page")
    offsets = offsets.select("__bucket", (F.col("before") + F.col("inside")).alias("__offset"))
    tasks = max(_shuffle(docs), min(1 << bits, math.ceil(total / TASK_BYTES)))
    return keyed.withColumn("__bucket", _bucket(bits)), F.broadcast(offsets) if bits <= SMALL_BITS else offsets, tasks


def permuted(table: pa.Table, seed: int, bucket: int, run: int) -> pa.Table:
    """The rows in the order of a Fisher-Yates shuffle seeded by bucket and run."""
    draw = np.random.default_rng([seed, bucket, run])
    order = np.arange(table.num_rows)
    # order[i] changes places with one of order[:i + 1], i from the last to the second
    for i, j in zip(range(len(order) - 1, 0, -1), draw.integers(0, np.arange(len(order), 1, -1)), strict=True):
        order[i], order[j] = order[j], order[i]
    return table.take(pa.array(order))


def shuffled(docs: DataFrame, seed: int = 17) -> DataFrame:
    """``docs`` with ``position``, the 0-based place in the shuffled corpus; stored bucket by bucket."""
    rows, offsets, tasks = scatter(docs, seed)
    place = T.StructField("__place", T.LongType())
    schema = T.StructType([*rows.schema.fields, place])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        bucket, run, place, size = -1, 0, 0, 0

        def flush() -> Iterator[pa.RecordBatch]:
            table = permuted(pa.Table.from_batches(held), seed, bucket, run)
            places = pa.array(np.arange(place, place + table.num_rows))
            table = table.append_column("__place", places)
            yield from table.to_batches(max_chunksize=OUT_BATCH)

        for batch in batches:
            keys = batch.column(batch.schema.get_field_index("__bucket")).to_numpy()
            cuts = np.r_[0, np.flatnonzero(np.diff(keys)) + 1, len(keys)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if a == b:
                    continue
                if held and (keys[a] != bucket or size >= RUN_BYTES):
                    yield from flush()
                    rows = sum(x.num_rows for x in held)
                    held, size = [], 0
                    run, place = (run + 1, place + rows) if keys[a] == bucket else (0, 0)
                bucket = int(keys[a])
                held.append(batch.slice(a, b - a))
                size += held[-1].nbytes
        if held:
            yield from flush()

    second = F.xxhash64(F.col("__key"), F.lit(seed + 1))
    others = [c for c, kind in docs.dtypes if not any(x in kind for x in ("map<", "variant"))]
    ordered = rows.repartition(tasks, "__bucket").sortWithinPartitions("__bucket", second, "doc_id", F.xxhash64(*others))
    placed = ordered.mapInArrow(task, schema).join(offsets, "__bucket")
    position = (F.col("__offset") + F.col("__place")).alias("position")
    return placed.select(*[c for c in docs.columns if c != "position"], position)


def _shuffle(docs: DataFrame) -> int:
    return int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def shard(docs: DataFrame, shards: int = 16, seed: int = 17) -> DataFrame:
    """``docs`` with ``shard`` and ``slot``, gapless from 0 in each shard.

    The shuffled corpus of n rows is cut into runs of ``n div shards`` rows; the first
    ``n mod shards`` shards have one more.
    """
    total = docs.count()
    base, more = divmod(total, shards)
    p, head = F.col("position"), more * (base + 1)
    long = F.when(p < head, F.floor(p / (base + 1))).otherwise(more + F.floor((p - head) / max(base, 1)))
    rows = shuffled(docs, seed).withColumn("__shard", long.cast("int"))
    start = F.col("__shard") * base + F.least("__shard", F.lit(more))
    keep = [c for c in docs.columns if c not in ("shard", "slot")]
    return rows.select(*keep, F.col("__shard").alias("shard"), (p - start).cast("long").alias("slot"))


def write_shards(docs: DataFrame, path: str, shards: int = 16, seed: int = 17) -> None:
    """Write each bucket's permuted rows under its shard's folder, ``slot`` in order in each file."""
    shard(docs, shards, seed).write.partitionBy("shard").mode("error").parquet(path)
