"""Relational tables as files or over JDBC, and the seed list of cities."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skylattice.operators.health import analyze
from skylattice.schemas import SEED, TABLES, Table, declared, to_table
from skylattice.sources.raw import STREAM_LOG
from skylattice.storage import delete, exists


def register(df: DataFrame, name: str) -> DataFrame:
    """Make ``df`` visible to ``spark.sql`` under ``name``."""
    df.createOrReplaceTempView(name)
    return df


def seed_cities(
    spark: SparkSession, rows_or_path: Iterable[dict] | str, fmt: str = "json"
) -> DataFrame:
    """The seed list: country, city, lat, lon and ``seq``, the position in the list.

    A list of dicts is numbered in its order. Rows of a file have no order in a distributed scan:
    they go by the file's ``seq`` or, where it has none, by country, city, lat and lon
    (:func:`in_order`). An entry without country or city is an error.
    """
    if isinstance(rows_or_path, str):
        reader = spark.read.format(fmt).schema(SEED)
        if fmt == "csv":
            reader = reader.option("header", "true").option("enforceSchema", "false")
            names = spark.read.option("header", "true").csv(rows_or_path).columns
            declared = ", ".join(c for c in SEED.split(", ") if c.split()[0] in names)
            reader = reader.schema(declared)
        return in_order(reader.load(rows_or_path))
    rows = [
        (r["country"], r["city"], float(r["lat"]), float(r["lon"]), i)
        for i, r in enumerate(rows_or_path)
    ]
    return spark.createDataFrame(rows, SEED)


def in_order(seed: DataFrame) -> DataFrame:
    """``seed`` with a ``seq`` that is unique and not negative.

    A given ``seq`` is checked. Otherwise entries are numbered by country, city, lat and lon:
    countries one after the other, entries inside each. Entries alike in all four get any of their
    numbers, which changes nothing.
    """
    numbered = "seq" in seed.columns
    seq = F.col("seq") if numbered else F.lit(None).cast("bigint")
    found = seed.agg(
        F.count("*").alias("n"),
        F.count(seq).alias("given"),
        F.count_if(seq < 0).alias("negative"),
        F.count_if(F.col("country").isNull() | F.col("city").isNull()).alias("nameless"),
    ).first()
    if found.nameless:
        raise ValueError(f"{found.nameless} seed entries without country or city")
    if found.given:
        again = seed.groupBy("seq").count().filter("count > 1").limit(1).count()
        if found.given < found.n or found.negative or again:
            raise ValueError("seq must be there for all entries or for none, unique and not negative")
        return seed
    sizes = seed.groupBy("country").agg(F.count("*").alias("_n"))
    ahead = Window.orderBy("country").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("country", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("country").orderBy("city", "lat", "lon")
    ranked = seed.withColumn("_at", F.row_number().over(inside)).join(offsets, "country")
    return ranked.withColumn("seq", F.col("_before") + F.col("_at") - 1).drop("_before", "_at")


class MissingTable(FileNotFoundError):
    """A table that a job reads was never written."""


@dataclass
class FileStore:
    """Tables as parquet folders under ``root``, facts partitioned by period."""

    spark: SparkSession
    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def read(self, name: str) -> DataFrame:
        """The table by its declared schema; one that was never written is an error."""
        table = declared(name)
        if not exists(self.spark, self.path(name)):
            raise MissingTable(self.path(name))
        return to_table(self.spark.read.schema(table.ddl).parquet(self.path(name)), table)

    def held(self, name: str) -> DataFrame:
        """What a table to be written holds: nothing yet, or its rows."""
        if not exists(self.spark, self.path(name)):
            return self.spark.createDataFrame([], declared(name).ddl)
        return self.read(name)

    def append(self, rows: DataFrame, table: Table) -> None:
        self._refuse_streamed(table)
        self._writer(rows, table).mode("append").parquet(self.path(table.name))

    def replace(self, rows: DataFrame, table: Table, within: Column) -> None:
        """Overwrite the partitions that ``within`` selects.

        Partitions that get rows are overwritten one by one; those left without rows are then
        deleted. A job lost in between leaves both; running it again gives the same table.
        """
        self._refuse_streamed(table)
        parts = list(table.partition_by)
        held = self.held(table.name).filter(within).select(*parts).distinct()
        stale = held.join(rows.select(*parts).distinct(), parts, "left_anti").collect()
        writer = self._writer(rows, table).mode("overwrite")
        writer.option("partitionOverwriteMode", "dynamic").parquet(self.path(table.name))
        for row in stale:
            folder = "/".join(f"{c}={row[c]}" for c in parts)
            delete(self.spark, f"{self.path(table.name)}/{folder}")

    def _refuse_streamed(self, table: Table) -> None:
        """Readers of a folder with a file stream's log see nothing that others write there."""
        if exists(self.spark, f"{self.path(table.name)}/{STREAM_LOG}"):
            raise ValueError(f"{table.name} holds the log of a file stream, which hides what others write")

    def _writer(self, rows: DataFrame, table: Table) -> DataFrameWriter:
        """Few files per partition, each ordered by key so that its statistics prune look-ups."""
        order = dict.fromkeys([*table.partition_by, *table.keys])
        spread = rows.hint("rebalance", *table.partition_by).sortWithinPartitions(*order)
        return spread.write.partitionBy(*table.partition_by)


@dataclass
class CatalogStore:
    """Tables of a catalog database, facts partitioned by period and bucketed by city.

    Tables of one bucketing join on the city without a shuffle; where the join has further keys, the
    session needs ``session.CO_LOCATED``. Each write is followed by column statistics, for which Spark reads the
    table once; with ``analysed=False`` they are left to ``analyze_job``. ``location`` is the shared folder
    of a database that does not exist yet; by default it lies in the warehouse.
    """

    spark: SparkSession
    database: str
    buckets: int = 64
    location: str | None = None
    analysed: bool = True

    def __post_init__(self) -> None:
        if not re.fullmatch(r"\w+", self.database):
            raise ValueError(f"a database is named by letters, digits and '_', not {self.database!r}")
        where = f" LOCATION '{self.location}'" if self.location else ""
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database}{where}")

    def name(self, name: str) -> str:
        return f"{self.database}.{declared(name).name}"

    def read(self, name: str) -> DataFrame:
        """The table; one that was never written is an error."""
        if not self.spark.catalog.tableExists(self.name(name)):
            raise MissingTable(self.name(name))
        return to_table(self.spark.table(self.name(name)), declared(name))

    def held(self, name: str) -> DataFrame:
        """What a table to be written holds: nothing yet, or its rows."""
        if not self.spark.catalog.tableExists(self.name(name)):
            return self.spark.createDataFrame([], declared(name).ddl)
        return self.read(name)

    def append(self, rows: DataFrame, table: Table) -> None:
        writer = self._spread(rows, table).write.format("parquet").mode("append")
        if table.partition_by:
            writer = writer.partitionBy(*table.partition_by)
        if "IdCity" in table.columns:
            writer = writer.bucketBy(self.buckets, "IdCity").sortBy("IdCity")
        writer.saveAsTable(self.name(table.name))
        self._settle(table)

    def replace(self, rows: DataFrame, table: Table, within: Column) -> None:
        """Overwrite the partitions that ``within`` selects, then drop those left without rows.

        A job lost in between leaves both; running it again gives the same table.
        """
        name, parts = self.name(table.name), list(table.partition_by)
        if not self.spark.catalog.tableExists(name):
            self.append(rows, table)
            return
        held = self.read(table.name).filter(within).select(*parts).distinct()
        stale = held.join(rows.select(*parts).distinct(), parts, "left_anti").collect()
        spread = self._spread(rows, table).select(*self.spark.table(name).columns)
        spread.write.option("partitionOverwriteMode", "dynamic").insertInto(name, overwrite=True)
        for row in stale:
            spec = ", ".join(f"`{c}` = '{row[c]}'" for c in parts)
            self.spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({spec})")
        self._settle(table)

    def _spread(self, rows: DataFrame, table: Table) -> DataFrame:
        """One task a bucket, so a write leaves one file for each bucket and partition."""
        return rows.repartition(self.buckets, "IdCity") if "IdCity" in table.columns else rows

    def _settle(self, table: Table) -> None:
        if self.analysed:
            analyze(self.spark, self.name(table.name))


@dataclass
class JdbcStore:
    """Tables of a relational database through Spark's JDBC source.

    ``ranges`` maps a table to (column, lower, upper, partitions): its reads are split into
    that many queries. Without an entry a table is read in one task, so a table by period needs
    one. A write that loses an executor may have stored some partitions: run it again with
    ``on_conflict='skip'``.
    """

    spark: SparkSession
    url: str
    properties: dict[str, str] = field(default_factory=dict)
    ranges: dict[str, Sequence] = field(default_factory=dict)

    def read(self, name: str) -> DataFrame:
        """The table; filters on the result are pushed into the database."""
        split = self.ranges.get(name, ())
        if TABLES[name].partition_by and not split:
            raise ValueError(f"{name} grows with time: give its reads a range")
        options = jdbc_options(self.url, name, self.properties, *split)
        return to_table(self.spark.read.format("jdbc").options(**options).load(), TABLES[name])

    def held(self, name: str) -> DataFrame:
        return self.read(name)

    def append(self, rows: DataFrame, table: Table) -> None:
        rows.write.mode("append").jdbc(self.url, table.name, properties=self.properties)


def jdbc_options(
    url: str,
    name: str,
    properties: dict[str, str],
    column: str | None = None,
    lower: str | int | None = None,
    upper: str | int | None = None,
    num_partitions: int | None = None,
) -> dict[str, str]:
    """Reader options; the partitioning ones come all together or not at all."""
    ranges = {
        "partitionColumn": column,
        "lowerBound": lower,
        "upperBound": upper,
        "numPartitions": num_partitions,
    }
    given = {k: str(v) for k, v in ranges.items() if v is not None}
    if given and len(given) < len(ranges):
        raise ValueError(f"a partitioned read needs all of {sorted(ranges)}")
    return {"url": url, "dbtable": name} | properties | given
