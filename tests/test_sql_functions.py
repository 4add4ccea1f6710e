from pyspark.sql import functions as F

from conftest import plan
from skylattice.functions import numeric, time, units
from skylattice.functions.sql import FUNCTIONS, register_functions

NUMBERS = [0.0, -0.0, 0.005, -0.005, 1.005, 49.325, 123.456789, 1234.0000004, -99999.999, 1e6 + 0.015, 3e9, 8.9e12, 9e12, float("nan"), float("inf"), None]
SECONDS = [0, -1, 1704067199, time.FIRST_SECOND, time.LAST_SECOND, time.LAST_SECOND + 1, 10**15, None]


def test_functions_equal_the_column_functions(spark):
    register_functions(spark)
    x, dt = F.col("x"), F.col("dt")
    parts = numeric.parts(x)
    pairs = {
        "grid_cell(x)": numeric.cell(x),
        "round_2(x)": numeric.round2(x),
        "reading_high(x)": parts["high"],
        "reading_low(x)": parts["low"],
        "reading_rest(x)": parts["rest"],
        "obs_time(dt)": time.obs_time(dt),
        "obs_date(dt)": time.obs_date(dt),
        "obs_hour(dt)": time.obs_hour(dt),
        "megabytes(dt)": units.size_mb(dt),
        "to_day(day)": time.to_day(F.col("day")),
    }
    days = ["2024-02-29", "2023-02-29", "soon", "", None]
    rows = [(n, SECONDS[i % len(SECONDS)], days[i % len(days)]) for i, n in enumerate(NUMBERS)]
    df = spark.createDataFrame(rows, "x double, dt bigint, day string")
    found = df.select(*(F.expr(text).alias(f"a{i}") for i, text in enumerate(pairs)), *(c.alias(f"b{i}") for i, c in enumerate(pairs.values())))
    for row in found.collect():
        for i, text in enumerate(pairs):
            assert str(row[f"a{i}"]) == str(row[f"b{i}"]), (text, row)


def test_averages_equal_the_column_function(spark):
    register_functions(spark)
    df = spark.range(400).select((F.col("id") % 7).alias("k"), ((F.col("id") * 37 % 1000) / 7 + F.when(F.col("id") % 7 == 3, 1e5).otherwise(0)).alias("x"))
    text = "average_of(sum(reading_high(x)), sum(reading_low(x)), sum(reading_rest(x)), count(reading_low(x)))"
    found = df.groupBy("k").agg(F.expr(text).alias("a"), numeric.mean(F.col("x")).alias("b")).collect()
    assert len(found) == 7 and all(r.a == r.b for r in found)


def test_functions_become_part_of_the_plan(spark):
    register_functions(spark)
    spark.range(3).createOrReplaceTempView("numbers")
    text = plan(spark.sql("SELECT " + ", ".join(f"{n}({'id' if 'BIGINT' in a else 'CAST(id AS DOUBLE)'})" for n, (a, _, _) in FUNCTIONS.items() if "," not in a and "STRING" not in a) + " FROM numbers"))
    assert "Python" not in text and "grid_cell" not in text.split("== Physical")[-1].replace("grid_cell(", "")
