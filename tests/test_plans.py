"""Shape of the physical plans: what decides whether an operator survives large data."""

import re
from datetime import date, datetime

import pytest
from conftest import SF, plan, rows

from skylattice.operators.conditions import condition_daily
from skylattice.operators.daily import daily
from skylattice.operators.filters import in_month
from skylattice.operators.hourly import hourly
from skylattice.operators.monthly import monthly, monthly_join
from skylattice.plans import catalog
from skylattice.plans.catalog import QUERIES
from skylattice.sources import star
from skylattice.sources.tables import FileStore

STREAMS = {"raw_stream", "hourly_stream", "condition_stream"}


def exchanges(text: str) -> int:
    return len(re.findall(r"^\(\d+\) Exchange", text, re.M))


def tree(text: str) -> str:
    return text.split("\n\n(1)")[0]


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STREAMS))
def test_no_python_no_cross_join(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for banned in ("Python", "Pandas", "CartesianProduct", "NestedLoop", "MapInArrow"):
        assert banned not in text, name


def test_hourly_is_one_exchange_and_a_broadcast(spark):
    text = plan(catalog.weather_hour(spark, SF))
    assert exchanges(text) == 1 and "BroadcastHashJoin" in text


def test_city_beyond_the_broadcast_size_is_merged_with_the_same_rows(spark):
    small = rows(catalog.weather_hour(spark, SF), "IdCity", "Date", "Hour")
    small_days = rows(catalog.condition_backfill(spark, SF), "IdCity", "Date")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = catalog.weather_hour(spark, SF)
        assert "SortMergeJoin" in plan(large) and "Broadcast" not in plan(large)
        assert rows(large, "IdCity", "Date", "Hour") == small
        assert rows(catalog.condition_backfill(spark, SF), "IdCity", "Date") == small_days
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_daily_families_share_one_scan_and_one_exchange(spark, tmp_path):
    store = FileStore(spark, str(tmp_path))
    catalog.weather_hour(spark, SF).write.partitionBy("Date").parquet(store.path("weather_hour"))
    text = plan(daily(store.read("weather_hour"), start=date(2024, 1, 2), end=date(2024, 1, 4)))
    assert exchanges(text) == 1 and len(re.findall(r"^\(\d+\) Scan", text, re.M)) == 1
    assert "PartitionFilters: [isnotnull(Date" in text
    one = plan(daily(store.read("weather_hour"), ["Wind"]))
    assert "ReadSchema: struct<IdCity:bigint,Wind:double>" in one


def test_aggregates_combine_before_the_exchange(spark):
    for df in (
        catalog.weather_hour(spark, SF),
        condition_daily(star.observations(spark, SF), star.cities(spark, SF)),
    ):
        found = tree(plan(df))
        assert re.search(r"- Exchange \(\d+\)\n.*\+- HashAggregate", found)
        assert "SortAggregate" not in found


def test_ranking_keeps_one_candidate_before_the_exchange(spark):
    text = plan(condition_daily(star.observations(spark, SF), star.cities(spark, SF)))
    assert tree(text).count("WindowGroupLimit") == 2


def test_month_filter_is_pushed_as_a_range(spark, tmp_path):
    store = FileStore(spark, str(tmp_path))
    daily(catalog.weather_hour(spark, SF)).write.parquet(store.path("wide"))
    wide = spark.read.parquet(store.path("wide"))
    for df in (in_month(wide, 2024, 1), monthly(wide, 2024, 1)):
        assert "GreaterThanOrEqual(Date,2024-01-01), LessThan(Date,2024-02-01)" in plan(df)
    assert exchanges(plan(monthly(wide))) == 1


def test_monthly_joins_add_no_exchange(spark, tmp_path):
    catalog.daily_wide(spark, SF).write.parquet(str(tmp_path / "wide"))
    wide = spark.read.parquet(str(tmp_path / "wide"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(monthly_join(wide, wide, wide, wide))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert tree(text).count("SortMergeJoin") == 3
    assert exchanges(text) + text.count("ReusedExchange") <= 4


def test_alerts_need_no_exchange(spark, tmp_path):
    catalog.weather_hour(spark, SF).write.parquet(str(tmp_path / "wh"))
    hours = spark.read.parquet(str(tmp_path / "wh"))
    assert exchanges(plan(catalog.alerts(hours, catalog.RULES))) == 0


def test_trailing_run_pushes_its_bounds(spark, tmp_path):
    star.observations(spark, SF).write.parquet(str(tmp_path / "raw"))
    raw = spark.read.parquet(str(tmp_path / "raw"))
    as_of = datetime(2024, 1, 15, 12, 5)
    text = plan(hourly(raw, star.cities(spark, SF), as_of, "trailing", end=as_of))
    assert "GreaterThanOrEqual(dt,1705316700), LessThan(dt,1705320300)" in text
