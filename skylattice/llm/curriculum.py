"""Mixing sources to target weights by a time-varying curriculum, in DataFrame functions only.

Each source has a weight schedule over training time 0 to 1, a list of linear pieces. The integral
of a source's schedule is its share of the mix; a share of more than ``most`` times the source's
words stops there and the rest goes to the other sources by weight. The demand for a source up to
time t is its target times the part of its integral up to t. A document that starts at a certain
word of its source's stream is due when that demand arrives: the inverse of the cumulative
demand gives its training position, and sorting by range of position gives the training order.

Streams are ordered by a keyed digest of ``doc_id`` and text. Running sums go in two levels, over
digest buckets of a source and inside each bucket, so that no window holds a source. A target of
k whole passes and a rest takes every document k times; the rest is filled first by the large
documents (to their part of it), then by the small ones up to what is still missing, so that the
words taken miss the target by half a small document at most.

Defined results: a null text has size 0 and is never taken; a null source is a source, the last;
an empty table gives no rows; rows that repeat are separate documents. Input columns named as
an output column are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skylattice.llm.common import WORD, stage

#: Linear pieces (from, to, weight at from, weight at to).
Pieces = list[tuple[float, float, float, float]]
#: Weights 3, 1, 2 over the whole training: one falls, one rises, one stays.
THREE_ONE_TWO: list[Pieces] = [
    [(0.0, 0.5, 4.0, 3.0), (0.5, 1.0, 3.0, 2.0)],
    [(0.0, 1.0, 0.5, 1.5)],
    [(0.0, 1.0, 2.0, 2.0)],
]
#: Documents that a bucket of the running sums should hold.
BUCKET_ROWS = 2048
PLAN = ["size", "source_size", "target", "taken", "copies", "positions"]


def words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def digest(seed: str) -> Column:
    """Order of a source's stream, the same in every run and in any engine with MD5."""
    key = F.concat(
        F.lit(f"{seed}:"),
        F.coalesce(F.col("doc_id").cast("string"), F.lit("-")),
        F.lit(":"),
        F.coalesce(F.col("text"), F.lit("")),
    )
    return F.md5(key)


def integral(pieces: Pieces) -> float:
    return sum((t1 - t0) * (w0 + w1) / 2 for t0, t1, w0, w1 in pieces)


def _pieces(pieces: Pieces) -> Column:
    """The pieces as an array, each with the demand before it."""
    before, rows = 0.0, []
    for t0, t1, w0, w1 in pieces:
        rows.append(
            F.struct(*[F.lit(float(v)).alias(n) for n, v in zip("abuvq", (t0, t1, w0, w1, before), strict=True)])
        )
        before += (t1 - t0) * (w0 + w1) / 2
    return F.array(*rows)


def due(demand: Column, pieces: Column) -> Column:
    """The time at which a cumulative demand (0 to the integral) arrives."""
    piece = F.element_at(F.filter(pieces, lambda p: (p["q"] <= demand) | (p["q"] == 0)), -1)
    rest, span = demand - piece["q"], piece["b"] - piece["a"]
    slope = (piece["v"] - piece["u"]) / span
    root = F.sqrt(F.greatest(piece["u"] * piece["u"] + 2 * slope * rest, F.lit(0.0)))
    low = piece["u"] + root
    return F.least(piece["b"], piece["a"] + F.when(low > 0, 2 * rest / low).otherwise(0.0))


def _source() -> Column:
    """A key that is never null and sorts as the source does by code point, null last."""
    return F.when(F.col("source").isNull(), "t").otherwise(F.concat(F.lit("s"), F.col("source").cast("string")))


def targets(sources: DataFrame, schedules: list[Pieces], share: float, most: int) -> DataFrame:
    """``sources`` (``__source``, ``__words`` and others) with weight, schedule and target.

    One row a source: sources are named, so this table is small whatever the corpus is.
    """
    by_name = Window.orderBy("__source")
    n = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(schedules)))
    rows = sources.withColumn("__n", n)
    weight = F.element_at(F.array(*[F.lit(integral(s)) for s in schedules]), F.col("__n") + 1)
    pieces = _pieces(schedules[0])
    for i, s in enumerate(schedules[1:], 1):
        pieces = F.when(F.col("__n") == i, _pieces(s)).otherwise(pieces)
    rows = rows.withColumns({"__weight": weight, "__pieces": pieces})
    # Sources by the level of words a unit of weight at which they stop. All before the first
    # source that does not stop are at their most; the others share the rest by weight.
    rows = rows.withColumn("__stop", most * F.col("__words") / F.col("__weight"))
    by_stop = Window.orderBy("__stop", "__source")
    before, everything = by_stop.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    total = share * F.sum("__words").over(everything)
    left = F.sum("__weight").over(everything) - F.coalesce(F.sum("__weight").over(before), F.lit(0.0))
    full = most * F.coalesce(F.sum("__words").over(before), F.lit(0))
    rows = rows.withColumns({"__level": (total - full) / left, "__at": F.row_number().over(by_stop)})
    going = F.when(F.col("__level") < F.col("__stop"), F.col("__at"))
    rows = rows.withColumn("__first", F.min(going).over(everything))
    level = F.max(F.when(F.col("__at") == F.col("__first"), F.col("__level"))).over(everything)
    stopped = F.col("__first").isNull() | (F.col("__at") < F.col("__first"))
    target = F.when(stopped, (most * F.col("__words")).cast("double")).otherwise(level * F.col("__weight"))
    return rows.withColumn("__target", target).drop("__n", "__stop", "__level", "__at", "__first")


def _running(rows: DataFrame, buckets: DataFrame) -> DataFrame:
    """Rows with the figures of their source and the words before them: of large, of small documents.

    Join and window share one exchange, by source and bucket.
    """
    inside = Window.partitionBy("__source", "__bucket").orderBy("__digest", "doc_id")
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.join(buckets, ["__source", "__bucket"])
    big = F.col("__size") > F.col("__small")
    rows = rows.withColumn("__big", big)
    large, small = F.when(big, F.col("__size")).otherwise(0), F.when(big, 0).otherwise(F.col("__size"))
    return rows.withColumns(
        {
            "__l0": F.col("__large0") + F.coalesce(F.sum(large).over(before), F.lit(0)),
            "__s0": F.col("__small0") + F.coalesce(F.sum(small).over(before), F.lit(0)),
        }
    )


def plan(
    docs: DataFrame,
    schedules: list[Pieces] = THREE_ONE_TWO,
    share: float = 1.5,
    most: int = 2,
    seed: str = "mix",
    whole: bool = False,
) -> DataFrame:
    """How often and when each document is taken.

    Columns: ``doc_id, source``, then ``size`` (words), ``source_size``, ``target`` (words the
    source should give), ``taken`` (words the mix takes of the document), ``copies``, and
    ``positions`` (training time of each copy). ``whole`` keeps all columns of ``docs``.
    """
    rows = stage(
        docs.select(
            "doc_id", _source().alias("__source"), words().alias("__size"), digest(seed).alias("__digest")
        ),
        "sizes",
    )
    digits = min(8, max(1, math.ceil(math.log(max(1, rows.count() / BUCKET_ROWS), 16))))
    bucket = F.substring("__digest", 1, digits)
    rows = rows.withColumn("__bucket", bucket)

    # One pass over the sizes: words by source, bucket and power of two of the size.
    power = F.when(F.col("__size") > 0, F.ceil(F.log2(F.col("__size").cast("double")))).otherwise(0)
    cells = stage(
        rows.groupBy("__source", "__bucket", power.cast("int").alias("__power")).agg(
            F.sum("__size").alias("words"), F.max("__size").alias("largest")
        ),
        "cells",
    )
    # Small: up to the least power of two for which small documents hold as many words as the
    # largest document has, which is more than the large ones can miss their part by.
    sized = cells.groupBy("__source", "__power").agg(
        F.sum("words").alias("words"), F.max("largest").alias("largest")
    )
    same = Window.partitionBy("__source")
    sized = sized.withColumn("upto", F.sum("words").over(same.orderBy("__power")))
    sized = sized.withColumn("largest", F.max("largest").over(same))
    enough = F.min(F.when(F.col("upto") >= F.col("largest"), F.col("__power")))
    sources = sized.groupBy("__source").agg(
        F.sum("words").alias("__words"), F.pow(F.lit(2.0), enough).cast("long").alias("__small")
    )
    passes = F.when(F.col("__words") > 0, F.floor(F.col("__target") / F.col("__words"))).otherwise(0)
    sources = targets(sources, schedules, share, most).withColumn("__passes", passes.cast("int"))
    rest = F.col("__target") - F.col("__passes") * F.col("__words")
    sources = stage(sources.withColumn("__rest", rest), "sources")

    big = F.pow(F.lit(2.0), F.col("__power")).cast("long") > F.col("__small")
    buckets = cells.join(sources.select("__source", "__small"), "__source")
    buckets = buckets.groupBy("__source", "__bucket").agg(
        F.sum(F.when(big, F.col("words")).otherwise(0)).alias("large"),
        F.sum(F.when(big, 0).otherwise(F.col("words"))).alias("small"),
    )
    before = same.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = buckets.select(
        "__source",
        "__bucket",
        F.coalesce(F.sum("large").over(before), F.lit(0)).alias("__large0"),
        F.coalesce(F.sum("small").over(before), F.lit(0)).alias("__small0"),
        F.sum("large").over(same).alias("__large"),
    )
    buckets = stage(buckets.join(sources, "__source"), "buckets")

    half = F.col("__size") / 2
    first = F.col("__big") & (F.col("__l0") + half < F.col("__rest") * F.col("__large") / F.col("__words"))
    given = _running(rows, buckets).where(first).groupBy("__source").agg(F.sum("__size").alias("__given"))
    given = stage(given, "given")
    buckets = buckets.join(given, "__source", "left")

    if whole:
        rows = docs.withColumns({"__source": _source(), "__size": words(), "__digest": digest(seed)})
        rows = rows.withColumn("__bucket", bucket)
    rows = _running(rows, buckets)
    missing = F.col("__rest") - F.coalesce("__given", F.lit(0))
    extra = F.when(F.col("__big"), first).otherwise(F.col("__s0") + half < missing)
    copies = F.when(F.col("__size") == 0, 0).otherwise(F.col("__passes") + extra.cast("int"))
    rows = rows.withColumn("__copies", copies)
    # Whole passes follow each other; the rest of the target is spread over the last one.
    start, passes = F.col("__l0") + F.col("__s0"), F.col("__passes") * F.col("__words")
    at = F.transform(
        F.sequence(F.lit(1), F.col("__copies")),
        lambda i: F.when(i <= F.col("__passes"), (i - 1) * F.col("__words") + start).otherwise(
            passes + F.col("__rest") * start / F.col("__words")
        ),
    )
    times = F.transform(at, lambda x: due(x / F.col("__target") * F.col("__weight"), F.col("__pieces")))
    out = {
        "size": F.col("__size"),
        "source_size": F.col("__words"),
        "target": F.col("__target"),
        "taken": F.col("__size") * F.col("__copies"),
        "copies": F.col("__copies"),
        "positions": F.when(F.col("__copies") > 0, times).otherwise(F.array().cast("array<double>")),
    }
    name = F.when(F.col("__source") != "t", F.substring("__source", 2, 1 << 30)).alias("source")
    kept = [c for c in docs.columns if c not in PLAN] if whole else ["doc_id", name]
    return rows.select(*kept, *[c.alias(n) for n, c in out.items()])


def ordered(docs: DataFrame, **settings) -> DataFrame:
    """:func:`plan` with ``places``: where each copy of a document stands in the training order, from 0.

    The order is by position (nine decimals) and ``doc_id``. Copies are sorted by ranges of position; a
    place is the number of copies in the ranges before and of those before it in its range.
    """
    rows = stage(plan(docs, **settings).withColumn("__row", F.monotonically_increasing_id()), "plan")
    copies = rows.select("__row", "doc_id", F.posexplode("positions").alias("__copy", "__at"))
    copies = copies.withColumn("__at", F.round("__at", 9))
    order = ["__at", F.asc_nulls_first("doc_id"), "__copy", "__row"]
    copies = copies.repartitionByRange(*order).sortWithinPartitions(*order)
    # The upper bits of the running number are the range, the lower ones the place in it.
    numbered = copies.withColumn("__n", F.monotonically_increasing_id()).select("__row", "__copy", "__n")
    numbered = stage(numbered, "order")
    span, inside = F.shiftright("__n", 33), F.col("__n").bitwiseAND(F.lit((1 << 33) - 1))
    ranges = numbered.groupBy(span.alias("__range")).agg(F.count("*").alias("__copies_in"))
    ahead = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)  # a row for each task
    ranges = ranges.select("__range", F.coalesce(F.sum("__copies_in").over(ahead), F.lit(0)).alias("__before"))
    placed = numbered.withColumn("__range", span).join(F.broadcast(ranges), "__range")
    places = placed.groupBy("__row").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("__copy", (F.col("__before") + inside).alias("place")))), lambda x: x["place"]).alias("places")
    )
    none = F.array().cast("array<long>")
    return rows.join(places, "__row", "left").withColumn("places", F.coalesce("places", none)).drop("__row")


def mix(docs: DataFrame, **settings) -> DataFrame:
    """The training corpus: a row for each copy, ``position`` added, sorted by range of position."""
    rows = docs.select("doc_id", "source", "text", F.struct(*docs.columns).alias("__row"))
    rows = plan(rows, whole=True, **settings)
    copies = rows.select("doc_id", "__row", F.explode("positions").alias("__position"))
    keep = [F.col("__row")[c].alias(c) for c in docs.columns if c != "position"]
    copies = copies.select(*keep, F.col("__position").alias("position"))
    return copies.repartitionByRange("position", "doc_id").sortWithinPartitions("position", "doc_id")
