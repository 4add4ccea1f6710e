"""Country and city dimensions: insert-if-absent with allocated keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skylattice.operators.conditions import top1
from skylattice.schemas import TABLES, to_table

KEY_RANGE = 1_000_000


def insert_if_absent(
    new: DataFrame, existing: DataFrame, keys: list[str], order: list[Column] | None = None
) -> DataFrame:
    """The rows of ``new`` whose key is not in ``existing``, one per key.

    Inside the batch the first row by ``order`` wins; without ``order`` the batch must already
    be unique by ``keys``. Null keys never match an existing row.
    """
    absent = new.join(existing.select(*keys), keys, "left_anti")
    return absent if order is None else top1(absent, keys, order)


def _before(key: str, within: str | None = None) -> Column:
    """Rows counted (``_n``) by the keys before this one."""
    order = Window.partitionBy(within) if within else Window
    ahead = order.orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum("_n").over(ahead), F.lit(0))


def assign_keys(new: DataFrame, existing: DataFrame, id_col: str, order_col: str) -> DataFrame:
    """Number ``new`` from ``max(existing.id_col) + 1`` on, ascending by ``order_col``.

    ``order_col`` is a unique non-negative integer of any spread. Rows are numbered inside ranges
    of a million order values, ranges inside groups of a million ranges, and only the groups (at
    most 9.3 million of a 64-bit integer) meet in one task. ``new`` is evaluated for the counts
    and for the rows: pass stored rows where it is costly.
    """
    ranged = new.withColumns(
        {
            "_range": F.expr(f"`{order_col}` div {KEY_RANGE}"),
            "_group": F.expr(f"`{order_col}` div {KEY_RANGE * KEY_RANGE}"),
        }
    )
    ranges = ranged.groupBy("_range", "_group").agg(F.count("*").alias("_n"))
    groups = ranges.groupBy("_group").agg(F.sum("_n").alias("_n"))
    held = existing.agg(
        F.lit(-1).cast("bigint").alias("_group"),
        F.coalesce(F.max(id_col), F.lit(0)).cast("bigint").alias("_n"),
    )
    bases = groups.unionByName(held).select("_group", _before("_group").alias("_base"))
    offsets = ranges.join(bases, "_group").select(
        "_range", (F.col("_base") + _before("_range", "_group")).alias("_offset")
    )
    position = F.row_number().over(Window.partitionBy("_range").orderBy(order_col))
    numbered = ranged.withColumn("_pos", position).join(offsets, "_range")
    return numbered.withColumn(
        id_col, (F.col("_offset") + F.col("_pos")).cast(existing.schema[id_col].dataType)
    ).drop("_range", "_group", "_pos", "_offset")


def lookup(df: DataFrame, dim: DataFrame, name: str, id_col: str) -> DataFrame:
    """``df`` with the id of every dimension ``name``, as one join."""
    return df.join(dim.select(name, id_col), name)


def absent_countries(seed: DataFrame, country: DataFrame) -> DataFrame:
    """Countries of the seed list that ``country`` lacks, with the ``seq`` they appear at."""
    first = seed.groupBy(F.col("country").alias("CountryName")).agg(F.min("seq").alias("seq"))
    return insert_if_absent(first, country, ["CountryName"])


def absent_cities(seed: DataFrame, country: DataFrame, city: DataFrame) -> DataFrame:
    """Cities of the seed list that ``city`` lacks, with the ``seq`` they appear at.

    ``country`` already holds every country of the seed list. A city that is listed again, or
    exists already, keeps its first coordinates.
    """
    named = seed.select(
        F.col("country").alias("CountryName"),
        F.col("city").alias("CityName"),
        F.col("lon").alias("Lon"),
        F.col("lat").alias("Lat"),
        "seq",
    )
    first = top1(named, ["CityName", "CountryName"], [F.asc("seq")])
    located = lookup(first, country, "CountryName", "IdCountry")
    return insert_if_absent(located, city, ["CityName", "IdCountry"])


def number_countries(absent: DataFrame, country: DataFrame) -> DataFrame:
    """``country`` rows for the absent ones, in order of appearance."""
    return to_table(assign_keys(absent, country, "IdCountry", "seq"), TABLES["country"])


def number_cities(absent: DataFrame, city: DataFrame) -> DataFrame:
    """``city`` rows for the absent ones, in order of appearance."""
    return to_table(assign_keys(absent, city, "IdCity", "seq"), TABLES["city"])
