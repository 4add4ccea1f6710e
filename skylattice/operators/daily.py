"""Daily minimum, maximum and average of the hourly measures."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skylattice.functions.numeric import mean, rounded
from skylattice.operators.filters import in_dates
from skylattice.schemas import DAY_FAMILIES, TABLES, to_table


def _extremes(family: str) -> list[Column]:
    prefix, x = DAY_FAMILIES[family][1], F.col(family)
    return [F.round(F.min(x), 2).alias(f"{prefix}Min"), F.round(F.max(x), 2).alias(f"{prefix}Max")]


def _averages(family: str) -> dict[str, Column]:
    _, prefix, extra = DAY_FAMILIES[family]
    return {f"{prefix}Avg": mean(F.col(family))} | {n: mean(F.col("FeelsLike")) for n in extra}


def daily(
    weather_hour: DataFrame,
    families: Iterable[str] = tuple(DAY_FAMILIES),
    start: date | None = None,
    end: date | None = None,
) -> DataFrame:
    """All requested families per city and date in one scan and one exchange.

    The five daily tables are projections of this result (:func:`day_table`); asking for one
    family alone prunes the other measures from the scan. ``start <= Date < end``.
    """
    families = list(families)
    averages = {n: a for f in families for n, a in _averages(f).items()}
    kept = weather_hour.filter(in_dates("Date", start, end))
    grouped = kept.groupBy("IdCity", "Date").agg(
        *(e for f in families for e in _extremes(f)), *(a.alias(n) for n, a in averages.items())
    )
    return rounded(grouped, averages)


def day_table(wide: DataFrame, family: str) -> DataFrame:
    """The table of one family out of the wide daily result."""
    return to_table(wide, TABLES[DAY_FAMILIES[family][0]])
