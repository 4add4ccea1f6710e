"""Staging, size-checked broadcast and connected components, shared by the operators here."""

from __future__ import annotations

import gc
import math
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skylattice.storage import delete, new_dir

#: White space of the word and line rules: space, tab, line feed, vertical tab, form feed, return.
BLANK = r"\x20\x09-\x0D"
WORD = rf"[^{BLANK}]+"
#: Rows of a few numbers that are broadcast at once.
BROADCAST = 1_000_000


def stage(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    The written table cuts the lineage: a lost executor costs the tasks it ran, never the
    steps before. The folder lives as long as the session's shared folder, or until :func:`unstage`.
    """
    return stage_all([df], label)


def stage_all(parts: Iterable[DataFrame], label: str) -> DataFrame:
    """The rows of all ``parts`` (one at least, of one schema) staged as one table, a part after the other.

    Between two parts the disk is rid of the first one's exchanges.
    """
    df = path = None
    for part in parts:
        if df is not None:
            tidy(df.sparkSession)
        df, path = part, path or new_dir(part.sparkSession, label)
        df.write.mode("append").parquet(path)
    staged = df.sparkSession.read.schema(df.schema).parquet(path)
    staged._staged_at = path
    return staged


def unstage(*frames: DataFrame) -> None:
    """Delete tables of :func:`stage` that nothing reads any more."""
    for df in frames:
        delete(df.sparkSession, df._staged_at)


def tidy(spark: SparkSession) -> None:
    """Let Spark delete the exchanges of finished steps.

    It keeps their files until the driver's garbage, in which their last references are, is collected.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def small(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``rows`` rows (``BROADCAST``), else as it is.

    For staged tables of a few numbers a row; beyond the bound Spark's shuffle join is used,
    with the same result.
    """
    return F.broadcast(df) if df.count() <= (BROADCAST if rows is None else rows) else df


def pieces(df: DataFrame, *by: str, least: int = 1) -> Iterator[DataFrame]:
    """A staged table in ``least`` parts or more, of ``BROADCAST`` rows on the average at most, each with a broadcast hint.

    Rows that agree in ``by`` are in one part. A large table that meets one part after the other is read
    again for each, and never shuffled.
    """
    n = max(least, math.ceil(df.count() / BROADCAST))
    for k in range(n):
        yield F.broadcast(df.where(F.pmod(F.xxhash64(*by), F.lit(n)) == k) if n > 1 else df)


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for the nodes of ``edges (a, b)``: root is the smallest node reachable.

    Alternating large-star and small-star steps: every step replaces edges by edges to the
    smallest neighbour, so that a star of any size is only ever aggregated by ``min`` (combined
    before the shuffle) and joined back (adaptive skew join). The number of steps grows with
    the logarithm of the longest path; each step is written to the shared folder.
    """
    edges = stage(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "edges",
    )
    state = _state(edges)
    while state[0]:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        step = large.join(least, "a")
        before, edges = edges, stage(
            step.select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(least.select("a", F.col("m").alias("b")))
            .where("a <> b")
            .distinct(),
            "edges",
        )
        unstage(before)
        now = _state(edges)
        if now == state:
            break
        if now[0] > BROADCAST:
            tidy(edges.sparkSession)
        state = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first())
