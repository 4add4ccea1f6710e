"""Hourly averages per grid cell, matched to cities."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skylattice.functions.numeric import cell, mean, rounded
from skylattice.functions.periods import aware
from skylattice.functions.time import obs_date, obs_hour, timely
from skylattice.operators.filters import between_half_open
from skylattice.schemas import HOUR_MEASURES, TABLES, to_table

CELL = ["lon_c", "lat_c"]
MODES = ("calendar", "trailing", "schedule")


def measures() -> dict[str, Column]:
    """Measure name -> reading. A missing rain object means a dry hour; other gaps stay null."""
    return {
        "Temp": F.col("main.temp"),
        "FeelsLike": F.col("main.feels_like"),
        "Clouds": F.col("clouds.all"),
        "Rain": F.coalesce(F.col("rain.`1h`"), F.lit(0.0)),
        "Wind": F.col("wind.speed"),
        "Pressure": F.col("main.pressure"),
        "Humidity": F.col("main.humidity"),
    }


def by_cell(raw: DataFrame, **extra: Column) -> DataFrame:
    """``raw`` with its cell key (hundredths of a degree) and further derived grouping columns."""
    return raw.withColumns(
        {"lon_c": cell(F.col("coord.lon")), "lat_c": cell(F.col("coord.lat"))} | extra
    )


def cell_averages(keyed: DataFrame, keys: list[str]) -> DataFrame:
    """The seven rounded averages per ``keys``.

    Averages combine on the map side, so a cell that holds much of the data sends one partial
    row per task and key.
    """
    means = keyed.groupBy(*keys).agg(*(mean(x).alias(m) for m, x in measures().items()))
    return rounded(means, HOUR_MEASURES)


def city_cells(city: DataFrame) -> DataFrame:
    return city.select("IdCity", cell(F.col("Lon")).alias("lon_c"), cell(F.col("Lat")).alias("lat_c"))


def to_city(cells: DataFrame, city: DataFrame) -> DataFrame:
    """Replace the cell key by the cities of the cell.

    Cells without a city drop out and a cell with several cities gives a row for each; see
    ``quality.unmatched_cells`` and ``quality.ambiguous_cells`` for both. ``cells`` is already
    aggregated. No broadcast hint: Spark broadcasts the cities when their size is below its
    threshold, by file statistics or by the measured shuffle size, and sort-merges otherwise.
    """
    return cells.join(city_cells(city), CELL).drop(*CELL)


def hourly(
    raw: DataFrame,
    city: DataFrame,
    as_of: datetime | None = None,
    mode: str = "calendar",
    start: datetime | None = None,
    end: datetime | None = None,
    minute: int = 5,
    tz: str = "UTC",
) -> DataFrame:
    """``weather_hour`` rows.

    ``calendar`` groups by the observation's own date and hour, within ``[start, end)``. Documents
    without a time in the calendar belong to no hour; ``quality.unusable`` counts them.

    ``trailing`` is one scheduled run: everything observed since ``as_of`` minus one hour (and
    before ``end``, when given) is stamped with the date and hour of that instant.

    ``schedule`` gives what trailing runs at ``minute`` past every hour would have written over
    the whole history: the run at H:minute owns ``[H-1:minute, H:minute)`` and stamps hour H-1.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    if mode == "trailing":
        return _trailing(raw, city, as_of, end, tz)
    labelled = F.col("dt") - minute * 60 if mode == "schedule" else F.col("dt")
    keyed = by_cell(
        between_half_open(raw, "dt", start, end).filter(timely(F.col("dt"))), Date=obs_date(labelled, tz), Hour=obs_hour(labelled, tz)
    )
    rows = to_city(cell_averages(keyed, [*CELL, "Date", "Hour"]), city)
    return to_table(rows, TABLES["weather_hour"])


def _trailing(
    raw: DataFrame, city: DataFrame, as_of: datetime | None, end: datetime | None, tz: str
) -> DataFrame:
    if as_of is None:
        raise ValueError("mode 'trailing' needs as_of")
    t0 = aware(as_of, tz) - timedelta(hours=1)
    window = between_half_open(raw, "dt", t0, end)
    rows = stamp(to_city(cell_averages(by_cell(window), CELL), city), t0)
    return to_table(rows, TABLES["weather_hour"])


def stamp(df: DataFrame, moment: datetime) -> DataFrame:
    """Constant ``Date`` and ``Hour`` columns of ``moment``."""
    return df.withColumns({"Date": F.lit(moment.date()), "Hour": F.lit(moment.hour)})

