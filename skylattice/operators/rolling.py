"""Rolling averages and anomaly detection over trailing windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skylattice.functions.numeric import combined, finite, parts
from skylattice.functions.time import epoch_hour


def rolling(daily_wide: DataFrame, cols: list[str], days: int) -> DataFrame:
    """Mean of each column over the ``days`` calendar days that end on the row's date.

    Rolling averages are planned in the original design without a definition; this one is ours.
    Missing days do not stretch the window. A city has one row per date, so its window
    partition is bounded by the calendar however many observations it had.
    """
    frame = (
        Window.partitionBy("IdCity")
        .orderBy(F.unix_date("Date"))
        .rangeBetween(-(days - 1), Window.currentRow)
    )
    sums = {
        f"_{name}_{c}": (F.count if name == "count" else F.sum)(part).over(frame)
        for c in cols
        for name, part in parts(F.col(c)).items()
    }
    names = ("high", "low", "rest", "count")
    return daily_wide.withColumns(sums).select(
        "IdCity",
        "Date",
        *(combined(*(F.col(f"_{name}_{c}") for name in names)).alias(f"{c}Roll") for c in cols),
    )


def anomalies(
    weather_hour: DataFrame, col: str, hours: int, z: float, min_points: int = 3
) -> DataFrame:
    """Hourly values more than ``z`` standard deviations off the city's trailing mean.

    The trailing window is the ``hours`` before the row, the row itself excluded; it needs
    ``min_points`` values that are not all equal. Anomaly detection is planned in the original
    design without a definition; this one is ours. The moments are sums of whole hundredths
    (hourly values carry two decimals), so they are exact and independent of order.
    """
    frame = (
        Window.partitionBy("IdCity")
        .orderBy(epoch_hour(F.col("Date"), F.col("Hour")))
        .rangeBetween(-hours, -1)
    )
    cents = F.round(finite(F.col(col)) * 100).cast("decimal(18,0)")
    measured = weather_hour.select("IdCity", "Date", "Hour", F.col(col).alias("Value"), cents.alias("_x"))
    moments = measured.withColumns(
        {
            "_n": F.count("_x").over(frame),
            "_s": F.sum("_x").over(frame),
            "_q": F.sum(F.col("_x") * F.col("_x")).over(frame),
        }
    )
    n, s, q = (F.col(c).cast("decimal(38,0)") for c in ("_n", "_s", "_q"))
    spread = n * q - s * s
    deviation = F.sqrt(F.try_divide(spread.cast("double"), F.col("_n") * (F.col("_n") - 1)))
    trailing = F.try_divide(F.col("_s").cast("double"), F.col("_n"))
    score = F.try_divide(F.col("_x") - trailing, deviation)
    return (
        moments.filter((F.col("_n") >= max(min_points, 2)) & (spread > 0))
        .withColumn("Z", score)
        .filter(F.abs("Z") > z)
        .select("IdCity", "Date", "Hour", "Value", "Z")
    )


