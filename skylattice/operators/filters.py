"""Period predicates in the form that reaches the scan.

All of them compare a bare column with literals, so parquet, JSON partitions and JDBC sources
receive them as pushed filters. Raw data that is partitioned by observation date also gets the
matching partition predicate.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skylattice.functions.periods import epoch, month_period
from skylattice.schemas import OBS_DATE


def since(df: DataFrame, col: str, t0: datetime) -> DataFrame:
    """Rows with ``col`` (epoch seconds) at or after ``t0``."""
    return between_half_open(df, col, start=t0)


def before(df: DataFrame, col: str, t: datetime) -> DataFrame:
    """Rows with ``col`` (epoch seconds) strictly before ``t``."""
    return between_half_open(df, col, end=t)


def between_half_open(
    df: DataFrame, col: str, start: datetime | None = None, end: datetime | None = None
) -> DataFrame:
    """Rows with ``start <= col < end`` on epoch seconds; either bound may be missing."""
    partitioned = OBS_DATE in df.columns
    if start is not None:
        a = epoch(start)
        df = df.filter(F.col(col) >= F.lit(a))
        if partitioned:
            df = df.filter(F.col(OBS_DATE) >= F.lit(_utc_day(a)))
    if end is not None:
        b = epoch(end)
        df = df.filter(F.col(col) < F.lit(b))
        if partitioned:
            df = df.filter(F.col(OBS_DATE) <= F.lit(_utc_day(b - 1)))
    return df


def _utc_day(seconds: int) -> date:
    return date(1970, 1, 1) + timedelta(days=seconds // 86400)


def on_date(df: DataFrame, day: date, col: str = "Date") -> DataFrame:
    return df.filter(F.col(col) == F.lit(day))


def date_range(df: DataFrame, first: date, last: date, col: str = "Date") -> DataFrame:
    """Rows dated ``first`` to ``last``, both included."""
    return df.filter(F.col(col).between(F.lit(first), F.lit(last)))


def in_dates(col: str, start: date | None, end: date | None) -> Column:
    """Predicate ``start <= col < end``; a missing bound is open."""
    keep = F.lit(True)
    if start is not None:
        keep = keep & (F.col(col) >= F.lit(start))
    if end is not None:
        keep = keep & (F.col(col) < F.lit(end))
    return keep


def in_month(df: DataFrame, year: int, month: int, col: str = "Date") -> DataFrame:
    """Rows of one month, as a date range.

    ``year(col) = y and month(col) = m`` selects the same rows but hides the column inside
    functions: only ``IsNotNull`` would be pushed and no partition pruned.
    """
    return df.filter(in_dates(col, *month_period(year, month).dates))
