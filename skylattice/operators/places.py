"""Cities that share their cells, as one place.

Every hourly row of a cell goes to each of its cities, so cities of the same cells have the same rows and whatever
is worked out from them city by city. With many cities a cell it is worked out once a place, and the finished
rows go to the place's cities: ``at_cities(daily(hourly(raw, places(city))), members(city))`` gives the rows of
``daily(hourly(raw, city))``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skylattice.functions.numeric import degrees
from skylattice.operators.hourly import CELL, city_cells


def _cells(city: DataFrame) -> DataFrame:
    """Each ``IdCity`` with its cells and how often it stands in them."""
    each = city_cells(city).groupBy("IdCity", *CELL).agg(F.count("*").alias("n"))
    return each.groupBy("IdCity").agg(F.sort_array(F.collect_list(F.struct(*CELL, "n"))).alias("_cells"))


def _first(cells: DataFrame) -> DataFrame:
    """Each set of cells with the smallest of its cities, which stands for all of them."""
    return cells.groupBy("_cells").agg(F.min("IdCity").alias("_place"))


def places(city: DataFrame) -> DataFrame:
    """One city of each place, with the position of each of its cells, as often as it stands there."""
    cells = _first(_cells(city)).select(F.col("_place").alias("IdCity"), F.inline("_cells"))
    times = cells.withColumn("_", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n"))))
    return times.select("IdCity", degrees(F.col("lon_c")).alias("Lon"), degrees(F.col("lat_c")).alias("Lat"))


def members(city: DataFrame) -> DataFrame:
    """Every ``IdCity`` once, with the city that stands for it (``_place``)."""
    cells = _cells(city)
    return cells.join(_first(cells), "_cells").select("IdCity", "_place")


def at_cities(rows: DataFrame, of_place: DataFrame) -> DataFrame:
    """``rows`` by place (in ``IdCity``) for each city of :func:`members`, with further columns of ``of_place``."""
    more = [c for c in of_place.columns if c not in ("IdCity", "_place")]
    at = rows.withColumnRenamed("IdCity", "_at")
    return at.join(of_place, F.col("_at").eqNullSafe(F.col("_place"))).select(*rows.columns, *more)
