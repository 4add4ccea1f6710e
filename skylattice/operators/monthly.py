"""Monthly and weekly summaries of the daily tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skylattice.functions.numeric import difference, mean
from skylattice.functions.periods import month_period, week_period
from skylattice.operators.filters import in_dates
from skylattice.schemas import TABLES, to_table

# Daily average column -> summary column; a summary needs all four families.
AVERAGES = {
    "TempAvg": "AvgTemp",
    "HumidityAvg": "AvgHumidity",
    "RainAvg": "AvgRain",
    "WindAvg": "AvgWind",
}


def _month_keys() -> dict[str, Column]:
    return {"Year": F.year("Date"), "Month": F.month("Date")}


def _week_keys() -> dict[str, Column]:
    return {
        "Year": F.extract(F.lit("yearofweek"), F.col("Date")),
        "NumWeek": F.weekofyear("Date"),
    }


def _summary(daily_wide: DataFrame, keys: dict[str, Column], bounds: tuple, table: str) -> DataFrame:
    kept = daily_wide.filter(in_dates("Date", *bounds)).withColumns(keys)
    complete = F.lit(True)
    for source in AVERAGES:
        complete = complete & (F.col(f"_n_{source}") > 0)
    grouped = kept.groupBy("IdCity", *keys).agg(
        *(mean(F.col(source)).alias(name) for source, name in AVERAGES.items()),
        *(F.count(source).alias(f"_n_{source}") for source in AVERAGES),
        difference(F.max("TempMax"), F.min("TempMin")).alias("TempVariation"),
    )
    return to_table(grouped.filter(complete), TABLES[table])


def monthly(daily_wide: DataFrame, year: int | None = None, month: int | None = None) -> DataFrame:
    """``AVG_month`` from the wide daily table: one aggregate, no join.

    The average is the plain mean of the daily averages, unrounded. Cities that lack one of
    the four families for the whole month drop out, as they do in :func:`monthly_join`.
    """
    bounds = month_period(year, month).dates if year else (None, None)
    return _summary(daily_wide, _month_keys(), bounds, "AVG_month")


def monthly_measure(
    day: DataFrame, measure: str, year: int | None = None, month: int | None = None
) -> DataFrame:
    """Monthly mean of one daily table; temperature also carries its extremes."""
    bounds: tuple[date | None, date | None] = month_period(year, month).dates if year else (None, None)
    aggregates = [mean(F.col(f"{measure}Avg")).alias(f"Avg{measure}")]
    if measure == "Temp":
        aggregates += [F.min("TempMin").alias("MinTemp"), F.max("TempMax").alias("MaxTemp")]
    kept = day.filter(in_dates("Date", *bounds)).withColumns(_month_keys())
    return kept.groupBy("IdCity", "Year", "Month").agg(*aggregates)


def join_monthly(temp: DataFrame, humidity: DataFrame, rain: DataFrame, wind: DataFrame) -> DataFrame:
    """Inner join of the four monthly aggregates on their common key.

    Each side is already partitioned by the key it was grouped on, so the joins add no shuffle.
    """
    keys = ["IdCity", "Year", "Month"]
    joined = temp.join(humidity, keys).join(rain, keys).join(wind, keys)
    return joined.withColumn("TempVariation", difference(F.col("MaxTemp"), F.col("MinTemp")))


def monthly_join(
    temperature_day: DataFrame,
    humidity_day: DataFrame,
    rain_day: DataFrame,
    wind_day: DataFrame,
    year: int | None = None,
    month: int | None = None,
) -> DataFrame:
    """``AVG_month`` from four separate daily tables."""
    sides = [
        monthly_measure(day, measure, year, month)
        for day, measure in [
            (temperature_day, "Temp"),
            (humidity_day, "Humidity"),
            (rain_day, "Rain"),
            (wind_day, "Wind"),
        ]
    ]
    return to_table(join_monthly(*sides), TABLES["AVG_month"])


def weekly(daily_wide: DataFrame, year: int | None = None, week: int | None = None) -> DataFrame:
    """``AVGWeek`` by ISO week and ISO year, with the monthly formulas.

    The original design declares the table only; the definition is ours.
    """
    bounds = week_period(year, week).dates if year else (None, None)
    return _summary(daily_wide, _week_keys(), bounds, "AVGWeek")


def week_dim(dates: DataFrame, col: str = "Date") -> DataFrame:
    """The ``Week`` rows from the week of the first to the week of the last date in ``dates``.

    The original design declares the table only. Ours: ISO weeks, Monday to Sunday, keyed by
    ``year * 100 + week``. The dates collapse to one pair of bounds before the weeks are
    generated.
    """
    span = dates.agg(
        F.date_trunc("week", F.min(col)).cast("date").alias("a"),
        F.date_trunc("week", F.max(col)).cast("date").alias("b"),
    )
    mondays = span.filter(F.col("a").isNotNull()).select(
        F.explode(F.expr("sequence(a, b, interval 7 days)")).alias("Date")
    )
    weeks = mondays.withColumns(_week_keys()).select(
        (F.col("Year") * 100 + F.col("NumWeek")).alias("IdWeek"),
        "NumWeek",
        F.col("Date").alias("DateIni"),
        F.date_add("Date", 6).alias("DateEnd"),
    )
    return to_table(weeks, TABLES["Week"])
