"""Missing hours: report and fill.

The original design plans missing-value handling without a definition; these are ours. Both
work from the distance between consecutive rows of a city. No grid of all cities and hours is
joined: the missing hours are generated only where a gap is.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skylattice.functions.periods import epoch
from skylattice.functions.time import epoch_hour, obs_date, obs_hour
from skylattice.schemas import HOUR_MEASURES


def _hours(start: datetime, end: datetime) -> tuple[int, int]:
    """The whole hours ``[a, b)`` of a period as hours since the epoch."""
    return -(-epoch(start) // 3600), -(-epoch(end) // 3600)


def _placed(hours: DataFrame, city: DataFrame, a: int) -> DataFrame:
    """Rows by hour (``_h``) with one more for every city of the roster at ``a - 1``, without values."""
    nothing = {m: F.lit(None).cast("double") for m in HOUR_MEASURES}
    listed = city.select("IdCity").withColumns({"_h": F.lit(a - 1).cast("bigint")} | nothing)
    columns = ["IdCity", "_h", *HOUR_MEASURES]
    rows = hours.select(columns).withColumn("_listed", F.lit(False))
    return rows.unionByName(listed.select(*columns, F.lit(True).alias("_listed")))


def _until(weather_hour: DataFrame, b: int) -> DataFrame:
    hour = epoch_hour(F.col("Date"), F.col("Hour"))
    return weather_hour.filter(F.col("Date") <= _date_of(b - 1)).withColumn("_h", hour).filter(F.col("_h") < b)


def _date_of(hour: int) -> Column:
    return F.date_from_unix_date(F.lit(hour // 24))


def fill_gaps(
    weather_hour: DataFrame, city: DataFrame, start: datetime, end: datetime, known: DataFrame | None = None
) -> DataFrame:
    """Every hour of ``[start, end)`` for each city of the roster ``city``.

    A missing hour, and a missing measure in a present hour, takes the city's last known value,
    also one from before ``start``: filling two periods one after the other gives what filling
    both at once gives. Before the first known value it is null. ``Filled`` marks hours that had no
    row. Rows before ``start`` are read for that, unless ``known`` holds the last known values at ``start``
    (:func:`known_values`). One scan and one window by city either way.
    """
    a, b = _hours(start, end)
    hours = _until(weather_hour, b)
    if known is not None:
        hours = hours.filter((F.col("Date") >= _date_of(a)) & (F.col("_h") >= a)).select("IdCity", "_h", *HOUR_MEASURES)
        hours = hours.unionByName(known.select("IdCity", F.lit(a - 1).cast("bigint").alias("_h"), *HOUR_MEASURES))
    of_city = Window.partitionBy("IdCity")
    order = of_city.orderBy("_h", "_listed")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = _placed(hours, city, a).withColumns(
        {m: F.last(m, ignorenulls=True).over(so_far) for m in HOUR_MEASURES}
        | {"_until": F.lead("_h", 1, b).over(order), "_listed": F.max("_listed").over(of_city)}
    )
    since = F.greatest(F.col("_h"), F.lit(a).cast("bigint"))
    none = F.array().cast("array<bigint>")
    each = F.when(F.col("_listed") & (since < F.col("_until")), F.sequence(since, F.col("_until") - 1)).otherwise(none)
    filled = placed.withColumn("_g", F.explode(each))
    seconds = F.col("_g") * 3600
    return filled.select(
        "IdCity",
        obs_date(seconds).alias("Date"),
        obs_hour(seconds).alias("Hour"),
        *HOUR_MEASURES,
        (F.col("_g") != F.col("_h")).alias("Filled"),
    )


def known_values(filled: DataFrame, end: datetime) -> DataFrame:
    """The last known values of each city at ``end``: those of the last hour before it in a filled period."""
    hour = _hours(end, end)[1] - 1
    last = (F.col("Date") == _date_of(hour)) & (F.col("Hour") == hour % 24)
    return filled.filter(last).select("IdCity", F.lit(end.date()).alias("AsOf"), *HOUR_MEASURES)


def gap_report(weather_hour: DataFrame, city: DataFrame, start: datetime, end: datetime) -> DataFrame:
    """Per city of the roster the hours present and missing in ``[start, end)`` and the longest gap."""
    a, b = _hours(start, end)
    hours = _until(weather_hour, b).filter((F.col("Date") >= _date_of(a)) & (F.col("_h") >= a))
    order = Window.partitionBy("IdCity").orderBy("_h")
    gaps = _placed(hours, city, a).withColumn("_after", F.lead("_h", 1, b).over(order) - F.col("_h") - 1)
    present = F.count_if(F.col("_h") >= a)
    each = gaps.groupBy("IdCity").agg(
        present.alias("HoursPresent"),
        (F.lit(b - a) - present).alias("HoursMissing"),
        F.max("_after").alias("LongestGap"),
        F.max("_listed").alias("_listed"),
    )
    return each.filter("_listed").drop("_listed")
