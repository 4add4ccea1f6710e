"""Upkeep by lots: sums that are kept, so that new observations need no old ones.

A lot is a named set of observations that arrived together. Its sums per cell and hour, and its counts per
cell, day and condition, are small, and sums of several lots add up exactly. A result needs the
sums of the dates that a lot touched, however late its observations are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skylattice.functions.numeric import combined, parts, rounded
from skylattice.functions.time import obs_date, obs_hour, timely
from skylattice.operators.conditions import CONDITION, condition_counts, top1
from skylattice.operators.hourly import CELL, by_cell, measures, to_city
from skylattice.schemas import HOUR_MEASURES, PARTS, TABLES, to_table

HOUR_KEYS = [*CELL, "Date", "Hour"]


def hour_sums(raw: DataFrame, tz: str = "UTC") -> DataFrame:
    """The sums of each measure per cell, date and hour."""
    keyed = by_cell(raw.filter(timely(F.col("dt"))), Date=obs_date(F.col("dt"), tz), Hour=obs_hour(F.col("dt"), tz))
    sums = [
        (F.count(x) if part == "count" else F.sum(x)).alias(f"{m}_{part}")
        for m, reading in measures().items()
        for part, x in parts(reading).items()
    ]
    return keyed.groupBy(*HOUR_KEYS).agg(*sums)


def hours_of(sums: DataFrame, city: DataFrame) -> DataFrame:
    """``weather_hour`` rows from the sums of all lots."""
    names = [f"{m}_{p}" for m in HOUR_MEASURES for p in PARTS]
    added = sums.groupBy(*HOUR_KEYS).agg(*(F.sum(n).alias(n) for n in names))
    means = added.select(*HOUR_KEYS, *(combined(*(F.col(f"{m}_{p}") for p in PARTS)).alias(m) for m in HOUR_MEASURES))
    return to_table(to_city(rounded(means, HOUR_MEASURES), city), TABLES["weather_hour"])


def condition_sums(raw: DataFrame, tz: str = "UTC") -> DataFrame:
    """Observations per cell, date and condition."""
    return condition_counts(raw, tz=tz)


def conditions_of(counts: DataFrame, city: DataFrame) -> DataFrame:
    """``weather_condition_day`` rows from the counts of all lots."""
    keys = [*CELL, "Date"]
    added = counts.groupBy(*keys, *CONDITION).agg(F.sum("cnt").alias("cnt"))
    found = top1(added, keys, [F.desc("cnt"), *(F.asc(c) for c in CONDITION)])
    return to_table(to_city(found, city), TABLES["weather_condition_day"])
