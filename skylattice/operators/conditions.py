"""The most frequent weather condition per city and day."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skylattice.functions.time import obs_date, timely
from skylattice.operators.filters import between_half_open
from skylattice.operators.hourly import CELL, by_cell, to_city
from skylattice.schemas import TABLES, to_table

CONDITION = ["WeatherMain", "WeatherDescription"]


def exploded(keyed: DataFrame, *keys: str) -> DataFrame:
    """One row per reported condition, with the cell and ``keys``.

    An observation that reports several conditions counts for each; one that reports none
    (null or empty array) counts for nothing.
    """
    items = keyed.select(*CELL, *keys, F.explode("weather").alias("w"))
    return items.select(
        *CELL,
        *keys,
        F.col("w.main").alias("WeatherMain"),
        F.col("w.description").alias("WeatherDescription"),
    )


def condition_counts(raw: DataFrame, by_date: bool = True, tz: str = "UTC") -> DataFrame:
    """Observations per cell, [date,] and condition."""
    keys = ["Date"] if by_date else []
    timed = raw.filter(timely(F.col("dt"))) if by_date else raw
    keyed = by_cell(timed, **{k: obs_date(F.col("dt"), tz) for k in keys})
    return exploded(keyed, *keys).groupBy(*CELL, *keys, *CONDITION).agg(F.count("*").alias("cnt"))


def top1(counts: DataFrame, partition: list[str], order: list[Column]) -> DataFrame:
    """The first row of each partition.

    Spark keeps one candidate per task and partition before the shuffle, so a large partition
    is never gathered whole.
    """
    ranked = counts.withColumn("_rn", F.row_number().over(Window.partitionBy(*partition).orderBy(*order)))
    return ranked.filter(F.col("_rn") == 1).drop("_rn")


def modal_condition(raw: DataFrame, by_date: bool = True, tz: str = "UTC") -> DataFrame:
    """Per cell [and date] the condition with the highest count.

    Ties go to the smaller main, then the smaller description. Counting first keeps the pass
    over the raw rows a plain hash aggregation, and the ranking sees one row per condition.
    """
    keys = [*CELL, *(["Date"] if by_date else [])]
    order = [F.desc("cnt"), *(F.asc(c) for c in CONDITION)]
    return top1(condition_counts(raw, by_date, tz), keys, order).drop("cnt")


def best_condition(counts: DataFrame, keys: list[Column | str]) -> DataFrame:
    """The winner of :func:`modal_condition` as one aggregate over the counts.

    The smallest (-count, main, description) is the condition wanted. A stream, which cannot
    rank rows, uses this form. (``mode`` over a struct would do in one step but miscounts: keys
    that went through a spilled buffer no longer equal fresh ones.)
    """
    smallest = F.min(F.struct((-F.col("cnt")).alias("rank"), *CONDITION)).alias("best")
    return counts.groupBy(*keys).agg(smallest)


def modal_condition_aggregate(raw: DataFrame, tz: str = "UTC") -> DataFrame:
    """The same rows as :func:`modal_condition` by date, without a window."""
    keys = [*CELL, "Date"]
    return best_condition(condition_counts(raw, tz=tz), keys).select(
        *keys, *(F.col(f"best.{c}") for c in CONDITION)
    )


def condition_daily(
    raw: DataFrame,
    city: DataFrame,
    start: datetime | None = None,
    end: datetime | None = None,
    tz: str = "UTC",
) -> DataFrame:
    """``weather_condition_day`` rows for observations in ``[start, end)``.

    One day is the daily job, an open start with ``end`` at today's midnight the backfill.
    """
    found = modal_condition(between_half_open(raw, "dt", start, end), tz=tz)
    return to_table(to_city(found, city), TABLES["weather_condition_day"])

