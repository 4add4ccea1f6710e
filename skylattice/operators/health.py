"""Size and row counts of tables, and their history."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from skylattice.functions.units import human_size, size_mb
from skylattice.storage import exists


def table_stats(spark: SparkSession, tables: dict[str, str], fmt: str = "parquet") -> DataFrame:
    """Row count and stored bytes of each named path, largest first.

    Rows are counted per file from hidden file metadata; the empty schema spares looking for one
    and no column is read.
    """
    found = reduce(DataFrame.unionByName, (_stats(spark, n, p, fmt) for n, p in tables.items()))
    return sized(found).orderBy(F.desc("size_bytes"), "table_name")


def volume(table: DataFrame, name: str) -> DataFrame:
    """Row count of a table and the bytes of its values written as text, whatever stores it."""
    text = reduce(
        lambda a, b: a + b,
        (F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in table.columns),
    )
    return table.agg(
        F.lit(name).alias("table_name"),
        F.count("*").alias("row_count"),
        F.coalesce(F.sum(text.cast("bigint")), F.lit(0)).alias("size_bytes"),
    )


def sized(stats: DataFrame) -> DataFrame:
    """``stats`` with sizes in megabytes and as text."""
    return stats.withColumns(
        {"size_mb": size_mb(F.col("size_bytes")), "size": human_size(F.col("size_bytes"))}
    )


def all_stats(spark: SparkSession, written: dict[str, str], names: Iterable[str]) -> DataFrame:
    """:func:`table_stats` of the paths in ``written``, and a row of zeros for every other name."""
    absent = [(n, 0, 0) for n in names if n not in written]
    zeros = sized(spark.createDataFrame(absent, "table_name string, row_count bigint, size_bytes bigint"))
    return table_stats(spark, written).unionByName(zeros) if written else zeros


def _stats(spark: SparkSession, name: str, path: str, fmt: str) -> DataFrame:
    files = (
        spark.read.format(fmt)
        .schema(StructType())
        .load(path)
        .groupBy(F.col("_metadata.file_path").alias("file"))
        .agg(F.max("_metadata.file_size").alias("size"), F.count("*").alias("n"))
    )
    return files.agg(
        F.lit(name).alias("table_name"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum("size"), F.lit(0)).alias("size_bytes"),
    )


def total_size(stats: DataFrame) -> DataFrame:
    """Size of all tables together."""
    return stats.agg(F.sum("size_bytes").alias("size_bytes")).withColumn(
        "size", human_size(F.col("size_bytes"))
    )


def health_snapshot(stats: DataFrame, as_of: datetime) -> DataFrame:
    """``stats`` marked with the moment they were taken."""
    return stats.withColumn("as_of", F.lit(as_of.replace(tzinfo=None)).cast("timestamp_ntz"))


def append_health(stats: DataFrame, as_of: datetime, target: str) -> None:
    """Append a snapshot to the history at ``target``; one of that moment that is there already stays."""
    snapshot = health_snapshot(stats, as_of)
    spark = stats.sparkSession
    if exists(spark, target):
        held = spark.read.schema(snapshot.schema).parquet(target)
        if held.filter(F.col("as_of") == F.lit(as_of.replace(tzinfo=None)).cast("timestamp_ntz")).take(1):
            return
    snapshot.write.mode("append").parquet(target)


def stats_trend(history: DataFrame) -> DataFrame:
    """Change of each table's rows and bytes since its previous snapshot.

    Historical trends are planned in the original design without a definition; ours is the
    difference to the snapshot before. A table has one row per snapshot.
    """
    by_table = Window.partitionBy("table_name").orderBy("as_of")
    changes = {
        f"{c}_change": F.col(c) - F.lag(c).over(by_table) for c in ("row_count", "size_bytes")
    }
    return history.withColumns(changes)


def analyze(spark: SparkSession, table: str) -> None:
    """Refresh the optimizer statistics of a catalog table."""
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR ALL COLUMNS")
