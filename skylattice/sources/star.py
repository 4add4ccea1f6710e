"""An events/customer star schema presented as observations, cities and seed lists.

``events`` are the observations, ``customer`` and ``supplier`` the cities and ``nation`` the
countries. Every row of each table is used. A reading's position scatters around its city, at
times into the next cell, where there is no city; suppliers share the cell of a customer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skylattice.functions.time import epoch_seconds
from skylattice.streaming.observations import read_raw_stream

# Declared, so that opening a table reads no file footer.
SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int",
    "nation": "n_nationkey int, n_name string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _lon(key: Column) -> Column:
    return (key % 360 - 180).cast("double")


def _lat(key: Column) -> Column:
    return (F.floor(key / 360) % 170 - 85).cast("double")


def as_observations(events: DataFrame) -> DataFrame:
    """Events in the shape of raw observation documents."""
    k = F.get_json_object("props", "$.k").cast("int")
    item = F.struct(
        F.col("event_type").alias("main"),
        F.concat_ws("_", "event_type", (F.col("k") % 3).cast("string")).alias("description"),
    )
    mist = F.struct(F.lit("mist").alias("main"), F.lit("mist").alias("description"))
    none = F.array().cast("array<struct<main: string, description: string>>")
    weather = (
        F.when(F.col("k") % 10 == 0, none)
        .when(F.col("event_type") == "error", F.array(item, mist))
        .otherwise(F.array(item))
    )
    reading = F.col("k").cast("double")
    return events.withColumn("k", k).select(
        F.struct(
            (_lon(F.col("user_id")) + (F.col("event_id") % 9 - 4) * F.lit(0.001)).alias("lon"),
            (_lat(F.col("user_id")) + (F.col("event_id") % 13 - 6) * F.lit(0.001)).alias("lat"),
        ).alias("coord"),
        weather.alias("weather"),
        F.struct(
            F.col("value").alias("temp"),
            (F.col("value") - 1.25).alias("feels_like"),
            (reading + 1000).alias("pressure"),
            reading.alias("humidity"),
        ).alias("main"),
        F.struct((reading / 10).alias("speed")).alias("wind"),
        F.when(F.col("event_type") == "purchase", F.struct((F.col("value") / 50).alias("1h"))).alias("rain"),
        F.struct(reading.alias("all")).alias("clouds"),
        epoch_seconds(F.col("ts")).alias("dt"),
    )


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_observations(table(spark, sf_dir, "events"))


def observation_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same observations as a file stream."""
    return as_observations(read_raw_stream(spark, f"{sf_dir}/events*.parquet", "parquet", SCHEMAS["events"]))


def cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers get even ids, suppliers odd ones."""
    customer = table(spark, sf_dir, "customer").select(
        (F.col("c_custkey") * 2).alias("IdCity"),
        F.col("c_name").alias("CityName"),
        F.col("c_nationkey").cast("int").alias("IdCountry"),
        _lon(F.col("c_custkey")).alias("Lon"),
        _lat(F.col("c_custkey")).alias("Lat"),
    )
    spot = F.col("s_suppkey") * 7
    supplier = table(spark, sf_dir, "supplier").select(
        (F.col("s_suppkey") * 2 + 1).alias("IdCity"),
        F.col("s_name").alias("CityName"),
        F.col("s_nationkey").cast("int").alias("IdCountry"),
        _lon(spot).alias("Lon"),
        _lat(spot).alias("Lat"),
    )
    return customer.unionByName(supplier)


def countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("int").alias("IdCountry"), F.col("n_name").alias("CountryName")
    )


def seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One seed entry per order: its customer's city, listed again with other coordinates."""
    order = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("c_custkey"), F.col("o_orderkey").alias("seq"), "o_orderstatus"
    )
    customer = table(spark, sf_dir, "customer").select(
        "c_custkey", F.col("c_name").alias("city"), F.col("c_nationkey").alias("n_nationkey")
    )
    nation = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("country"))
    shift = (F.col("seq") % 9 - 4) * F.lit(0.001)
    return (
        order.join(customer, "c_custkey")
        .join(nation, "n_nationkey")
        .select(
            "country",
            "city",
            (_lat(F.col("c_custkey")) + shift).alias("lat"),
            (_lon(F.col("c_custkey")) + shift).alias("lon"),
            "seq",
            "o_orderstatus",
        )
    )
