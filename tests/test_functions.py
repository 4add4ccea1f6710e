import random
from datetime import date, datetime, timedelta, timezone
from decimal import Decimal

import pytest
from conftest import at, rows
from pyspark.sql import functions as F

from skylattice.functions import periods
from skylattice.functions.numeric import cell, difference, mean, round2
from skylattice.functions.time import epoch_seconds, hour_start, obs_date, obs_hour, obs_time, to_day
from skylattice.functions.units import convert, human_size, size_mb


def one(spark, values, column):
    return spark.createDataFrame([(v,) for v in values], "x double").agg(column).first()[0]


@pytest.mark.parametrize(
    "values, expected",
    [
        ([1.0, 2.0], 1.5),
        ([0.01, 0.02], 0.02),  # exactly 0.015
        ([1.005], 1.01),
        ([-0.005], -0.01),
        ([49.32, 49.33], 49.33),  # exactly 49.325
        ([None, 3.0, float("nan"), float("inf"), float("-inf")], 3.0),
        ([None], None),
        ([float("nan")], None),
        ([], None),
    ],
)
def test_average_rounds_half_up_and_skips_what_is_no_number(spark, values, expected):
    assert one(spark, values, round2(mean(F.col("x")))) == expected


def test_average_does_not_depend_on_partitioning(spark):
    base = spark.range(20000).select(
        (F.col("id") % 13).alias("k"), (F.pmod(F.xxhash64("id"), F.lit(10000)) / 100).alias("x")
    )
    found = [
        rows(base.repartition(n).groupBy("k").agg(mean(F.col("x")), round2(mean(F.col("x")))), "k")
        for n in (1, 3, 200)
    ]
    assert found[0] == found[1] == found[2]


def test_mean_is_one_exact_division(spark):
    assert one(spark, [0.1] * 10, mean(F.col("x"))) == 0.1
    assert one(spark, [0.1, 0.2], mean(F.col("x"))) == 0.15


@pytest.mark.parametrize(
    "x, expected",
    [
        (7.367, 737),
        (1.005, 101),
        (-1.005, -101),
        (-177.995, -17800),
        (-0.004, 0),
        (0.004, 0),
        (float("nan"), None),
        (float("inf"), None),
        (1e9, None),
        (None, None),
    ],
)
def test_cell(spark, x, expected):
    assert spark.createDataFrame([(x,)], "x double").select(cell(F.col("x"))).first()[0] == expected


def test_fast_rounding_is_round(spark):
    thousandths = spark.range(400000).select(((F.col("id") - 200000) / 1000).alias("x"))
    spread = spark.range(200000).select(
        (F.xxhash64("id") / F.pow(F.lit(10.0), F.col("id") % 19)).alias("x")
    )
    x = thousandths.union(spread)
    assert x.filter(~round2(F.col("x")).eqNullSafe(F.round("x", 2))).isEmpty()
    by_text = (F.round("x", 2).cast("decimal(20,2)") * 100).cast("int")
    assert thousandths.filter(~cell(F.col("x")).eqNullSafe(by_text)).isEmpty()


@pytest.mark.parametrize("x", [-0.004, -0.0, float("nan"), float("inf"), 1e300, None])
def test_fast_rounding_of_special_values(spark, x):
    df = spark.createDataFrame([(x,)], "x double").select(round2(F.col("x")), F.round("x", 2))
    assert len({str(v) for v in df.first()}) == 1


def test_difference_has_no_binary_noise(spark):
    df = spark.createDataFrame([(286.82, 283.06)], "a double, b double")
    assert df.select(difference(F.col("a"), F.col("b"))).first()[0] == 3.76


@pytest.mark.parametrize("moment", ["1969-12-31T23:59:59", "2024-03-10T02:30:00", "2024-09-18T11:59:18"])
def test_time_columns_ignore_the_session_zone(spark, any_zone, moment):
    df = spark.createDataFrame([(at(moment),)], "dt bigint").select(
        obs_date(F.col("dt")), obs_hour(F.col("dt")), epoch_seconds(obs_time(F.col("dt"))), "dt",
        obs_time(F.col("dt")),
    )
    day, hour, back, dt, ts = df.first()
    wanted = datetime.fromisoformat(moment)
    assert (day, hour, back, ts) == (wanted.date(), wanted.hour, dt, wanted)


def test_local_zone_on_request(spark, any_zone):
    df = spark.createDataFrame([(at("2024-09-18T22:30:00"),)], "dt bigint")
    found = df.select(obs_date(F.col("dt"), "Europe/Rome"), obs_hour(F.col("dt"), "Europe/Rome"))
    assert tuple(found.first()) == (date(2024, 9, 19), 0)


def test_hour_start(spark, any_zone):
    df = spark.createDataFrame([(date(2024, 3, 10), 2)], "d date, h int")
    assert df.select(hour_start(F.col("d"), F.col("h"))).first()[0] == datetime(2024, 3, 10, 2)


def utc(*args):
    return datetime(*args, tzinfo=timezone.utc)


def test_periods():
    now = datetime(2025, 3, 1, 0, 5)
    assert periods.period("hour", now) == periods.Period(utc(2025, 2, 28, 23, 5), utc(2025, 3, 1, 0, 5))
    assert periods.period("day", now).dates == (date(2025, 2, 28), date(2025, 3, 1))
    assert periods.period("month", now).dates == (date(2025, 2, 1), date(2025, 3, 1))
    assert periods.period("history", now).end == utc(2025, 3, 1)
    assert periods.period("week", datetime(2025, 1, 1)).dates == (date(2024, 12, 30), date(2025, 1, 6))
    assert periods.month_period(2024, 12).dates == (date(2024, 12, 1), date(2025, 1, 1))
    assert periods.date_period(date(2024, 1, 1), date(2024, 1, 1)).epochs == (
        at("2024-01-01"),
        at("2024-01-02"),
    )
    with pytest.raises(ValueError):
        periods.date_period(date(2024, 1, 2), date(2024, 1, 1))
    with pytest.raises(ValueError):
        periods.period("decade", now)


def test_period_of_a_zone_follows_its_midnight():
    span = periods.period("day", datetime(2025, 3, 31, 12), "Europe/Rome")
    assert span.dates == (date(2025, 3, 30), date(2025, 3, 31))
    assert span.epochs[1] - span.epochs[0] == 23 * 3600


def test_epoch_rounds_up():
    assert periods.epoch(datetime(1970, 1, 1) + timedelta(milliseconds=1500)) == 2


def test_units(spark):
    df = spark.createDataFrame([(284.2, 4.09)], "Temp double, Wind double")
    df = convert(df, "Temp", "K", "C", "C")
    df = convert(df, "Temp", "K", "F", "F")
    assert tuple(convert(df, "Wind", "m/s", "km/h").first()) == (284.2, 14.724, 11.05, 51.89)
    with pytest.raises(ValueError):
        convert(df, "Temp", "K", "R")


def test_sizes(spark):
    sizes = [0, 10239, 10240, 5 * 1024**2, 12 * 1024**2, 3 * 1024**4 * 10]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(sizes)], "i int, s bigint")
    found = rows(df.select("i", human_size(F.col("s")), size_mb(F.col("s"))), "i")
    assert [r[1] for r in found] == ["0 bytes", "10239 bytes", "10 kB", "5120 kB", "12 MB", "30 TB"]
    assert found[3][2] == 5.0


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize(
    "values, wanted",
    [
        ([1e12] * 20, 1e12),
        ([8.9e12] * 3000, 8.9e12),
        ([-1e12] * 7, -1e12),
        ([4e-7] * 4, 4e-7),
        ([1e-9, 3e-9], 2e-9),
        ([9.9e13, 2.0, 4.0], 3.0),
        ([float("nan"), float("inf"), None, 1.5], 1.5),
        ([9.9e13], None),
        ([1.0, 1.01], 1.005),
        ([-0.5, 0.25], -0.125),
        ([123456.789] * 11, 123456.789),
    ],
)
def test_averages_hold_for_any_size(spark, ansi, values, wanted):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = spark.createDataFrame([(v,) for v in values], "x double")
        assert df.agg(mean(F.col("x"))).first()[0] == wanted
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_text_to_date(spark):
    df = spark.createDataFrame([("2024-02-29",), ("2024-02-30",), ("x",), (None,)], "t string")
    assert rows(df.select(to_day(F.col("t")))) == [(date(2024, 2, 29),), (None,), (None,), (None,)]


@pytest.mark.parametrize(
    "x", [1234.0000004, 999.999999999999, 1000.0000000001, 99999.0000001, 123456.789, 1234567.0000004, 98765432.000001, 0.1, 3e-12]
)
@pytest.mark.parametrize("sign", [1.0, -1.0])
def test_mean_keeps_fourteen_digits_at_every_magnitude(spark, x, sign):
    df = spark.createDataFrame([(sign * x,)] * 2, "x double")
    found = df.agg(mean(F.col("x")).alias("m")).first().m
    assert f"{found:.14g}" == f"{sign * x:.14g}"


def test_mean_of_decimals_has_no_binary_noise(spark):
    rng = random.Random(3)
    for low, places in ((0, 6), (1_000, 6), (100_000, 4), (10_000_000, 3), (10**9, 2)):
        values = [round(low + rng.random() * low + rng.random(), places) for _ in range(301)]
        exact = sum(Decimal(repr(v)) for v in values) / len(values)
        found = spark.createDataFrame([(v,) for v in values], "x double").agg(mean(F.col("x")).alias("m")).first().m
        assert abs(Decimal(found) - exact) <= exact * Decimal(2) ** -52
