"""Checks that a relational store would enforce, as reports over DataFrames."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skylattice.functions.numeric import degrees, usable
from skylattice.functions.time import timely
from skylattice.operators.hourly import CELL, by_cell, city_cells, measures


def check_not_null(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """One row per column with its number of nulls; all columns are counted in one pass."""
    cols = list(cols)
    counts = df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in cols))
    pairs = F.array(
        *(F.struct(F.lit(c).alias("column_name"), F.col(c).alias("nulls")) for c in cols)
    )
    return counts.select(F.inline(pairs))


def unusable(raw: DataFrame) -> DataFrame:
    """Per measure the readings, those that are missing and those that are no measurement.

    NaN, infinity and magnitudes beyond the limit count as missing in every average; here is
    their number. ``dt`` counts documents without a time in the calendar.
    """
    given = {"dt": F.col("dt")} | measures()
    counts = raw.agg(
        *(
            F.struct(
                F.lit(name).alias("measure"),
                F.count("*").alias("documents"),
                F.count_if(x.isNull()).alias("missing"),
                F.count_if(x.isNotNull() & ~(timely(x) if name == "dt" else usable(x))).alias("unusable"),
            ).alias(name)
            for name, x in given.items()
        )
    )
    return counts.select(F.inline(F.array(*given)))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def orphans(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Rows of ``fact`` whose ``key`` is missing from ``dim``."""
    return fact.filter(F.col(key).isNotNull()).join(dim.select(key), key, "left_anti")


def unmatched_cells(raw: DataFrame, city: DataFrame) -> DataFrame:
    """Cells without a city and their number of observations.

    These observations are what the city join leaves out, including those without usable
    coordinates (null cell).
    """
    counts = by_cell(raw).groupBy(*CELL).agg(F.count("*").alias("observations"))
    return _located(counts.join(city_cells(city), CELL, "left_anti"), "observations")


def ambiguous_cells(city: DataFrame) -> DataFrame:
    """Cells that hold several cities: each of them receives the cell's rows."""
    located = city_cells(city).filter(F.col("lon_c").isNotNull() & F.col("lat_c").isNotNull())
    shared = located.groupBy(*CELL).agg(F.count("*").alias("cities")).filter("cities > 1")
    return _located(shared, "cities")


def _located(cells: DataFrame, *cols: str) -> DataFrame:
    lon, lat = (degrees(F.col(c)) for c in CELL)
    return cells.select(lon.alias("lon"), lat.alias("lat"), *cols)
