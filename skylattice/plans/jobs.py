"""The scheduled and ad-hoc jobs: read, one operator, checked write.

Each job takes the raw observations or a store and an explicit ``as_of`` or date range. A store
is a ``FileStore``, a ``CatalogStore`` or a ``JdbcStore``; ``replace`` needs one of the first two.
"""

from __future__ import annotations

import re
from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skylattice.functions.periods import Period, date_period, period
from skylattice.operators.conditions import condition_daily
from skylattice.operators.daily import daily, day_table
from skylattice.operators.dims import (
    absent_cities,
    absent_countries,
    number_cities,
    number_countries,
)
from skylattice.operators.filters import in_dates
from skylattice.operators.gaps import fill_gaps, known_values
from skylattice.operators.hourly import hourly
from skylattice.operators import quality
from skylattice.operators.health import analyze, append_health
from skylattice.operators.increments import condition_sums, conditions_of, hour_sums, hours_of
from skylattice.operators.monthly import monthly, monthly_join, week_dim, weekly
from skylattice.schemas import DAY_FAMILIES, STATES, TABLES, to_table
from skylattice.sinks.tables import write_table
from skylattice.sources.tables import CatalogStore, FileStore, JdbcStore
from skylattice.storage import staged

Store = FileStore | CatalogStore | JdbcStore


def hourly_job(
    raw: DataFrame, store: Store, as_of: datetime, on_conflict: str = "error", tz: str = "UTC"
) -> None:
    """The run at ``as_of``: the last 60 minutes, stamped with the hour they began in."""
    if on_conflict == "replace":
        raise ValueError("an hour is not a whole partition: use hourly_backfill to replace days")
    span = period("hour", as_of, tz)
    rows = hourly(raw, store.read("city"), as_of, "trailing", end=span.end, tz=tz)
    write_table(store, rows, "weather_hour", on_conflict, F.col("Date") == F.lit(span.start.date()))


def hourly_backfill(
    raw: DataFrame,
    store: Store,
    first: date | None = None,
    last: date | None = None,
    on_conflict: str = "error",
    tz: str = "UTC",
) -> None:
    """All history, or the dates ``first`` to ``last`` (both included)."""
    span = _range(first, last, tz)
    start, end = (span.start, span.end) if span else (None, None)
    rows = hourly(raw, store.read("city"), start=start, end=end, tz=tz)
    write_table(store, rows, "weather_hour", on_conflict, _within(span))


def increment_job(raw: DataFrame, store: FileStore, lot: str, tz: str = "UTC", city: DataFrame | None = None) -> None:
    """Add the observations of a lot to the kept sums, and renew the hours and conditions they touch.

    Rows are kept for the cities of the store or for those of ``city``, such as one of each place.

    ``raw`` holds the lot alone. Its sums replace those of an earlier run under the same name, so a run
    that was lost or is repeated counts nothing twice. Read are the lot and the sums of the dates in it;
    these dates are written anew in ``weather_hour`` and ``weather_condition_day``.
    """
    if not re.fullmatch(r"[\w.-]+", lot):
        raise ValueError(f"a lot is named by letters, digits, '_', '.' and '-', not {lot!r}")
    city = store.read("city") if city is None else city
    for state, sums, result, rows in (
        ("cell_hour", hour_sums, "weather_hour", hours_of),
        ("cell_condition", condition_sums, "weather_condition_day", conditions_of),
    ):
        table = STATES[state]
        with staged(to_table(sums(raw, tz).withColumn("Lot", F.lit(lot)), table)) as own:
            dates = [r.Date for r in own.select("Date").distinct().collect()]  # folders of the write
            if not dates:
                continue
            touched = F.col("Date").isin(dates)
            store.replace(own, table, touched & (F.col("Lot") == lot))
            write_table(store, rows(store.read(state).filter(touched), city), result, "replace", touched)


def daily_job(store: Store, as_of: datetime, on_conflict: str = "error", tz: str = "UTC") -> None:
    """The five daily tables for yesterday."""
    _daily(store, period("day", as_of, tz), on_conflict)


def daily_backfill(
    store: Store, first: date, last: date, on_conflict: str = "error", tz: str = "UTC"
) -> None:
    """The five daily tables for ``first`` to ``last``, both included."""
    _daily(store, date_period(first, last, tz), on_conflict)


def _daily(store: Store, span: Period, on_conflict: str) -> None:
    start, end = span.dates
    with staged(daily(store.read("weather_hour"), start=start, end=end)) as wide:
        for family, (name, _, _) in DAY_FAMILIES.items():
            write_table(store, day_table(wide, family), name, on_conflict, _within(span), stored=True)


def fill_job(store: FileStore, first: date, last: date, tz: str = "UTC", city: DataFrame | None = None) -> None:
    """``hour_filled`` for ``first`` to ``last``, and the values known at its end.

    The roster is that of the store or ``city``, such as one city of each place.

    Values from before come from the job's run up to ``first``, if there was one; then only the period is
    read. Otherwise all earlier hours are.
    """
    span = date_period(first, last, tz)
    start, end = span.dates
    held = store.held("last_known").filter(F.col("AsOf") == F.lit(start))
    known = held if held.take(1) else None
    roster = store.read("city") if city is None else city
    rows = fill_gaps(store.read("weather_hour"), roster, span.start, span.end, known)
    write_table(store, rows, "hour_filled", "replace", in_dates("Date", start, end))
    filled = store.read("hour_filled").filter(in_dates("Date", start, end))
    write_table(store, known_values(filled, span.end), "last_known", "replace", F.col("AsOf") == F.lit(end))


def condition_job(
    raw: DataFrame, store: Store, as_of: datetime, on_conflict: str = "error", tz: str = "UTC"
) -> None:
    """Modal conditions of yesterday."""
    _conditions(raw, store, period("day", as_of, tz), on_conflict, tz)


def condition_backfill(
    raw: DataFrame, store: Store, as_of: datetime, on_conflict: str = "error", tz: str = "UTC"
) -> None:
    """Modal conditions of every day before the day of ``as_of``."""
    _conditions(raw, store, period("history", as_of, tz), on_conflict, tz)


def _conditions(raw: DataFrame, store: Store, span: Period, on_conflict: str, tz: str) -> None:
    rows = condition_daily(raw, store.read("city"), span.start, span.end, tz)
    write_table(store, rows, "weather_condition_day", on_conflict, _within(span))


def monthly_job(store: Store, as_of: datetime, on_conflict: str = "error", tz: str = "UTC") -> None:
    """``AVG_month`` for the month of yesterday, from the four stored daily tables."""
    start = period("month", as_of, tz).start
    days = [store.read(DAY_FAMILIES[f][0]) for f in ("Temp", "Humidity", "Rain", "Wind")]
    rows = monthly_join(*days, year=start.year, month=start.month)
    within = (F.col("Year") == start.year) & (F.col("Month") == start.month)
    write_table(store, rows, "AVG_month", on_conflict, within)


def weekly_job(store: Store, as_of: datetime, on_conflict: str = "error", tz: str = "UTC") -> None:
    """``AVGWeek`` for the ISO week of yesterday and its ``Week`` row, from hourly rows."""
    span = period("week", as_of, tz)
    start, end = span.dates
    iso = start.isocalendar()
    with staged(daily(store.read("weather_hour"), start=start, end=end)) as wide:
        within = (F.col("Year") == iso.year) & (F.col("NumWeek") == iso.week)
        write_table(store, weekly(wide, iso.year, iso.week), "AVGWeek", on_conflict, within)
        kept = "append" if on_conflict == "append" else "skip"
        write_table(store, week_dim(wide), "Week", kept)


def quality_job(raw: DataFrame, store: Store, target: str, as_of: datetime) -> None:
    """Append the quality reports to folders under ``target``, marked with ``as_of``.

    ``unmatched``: cells whose observations no city receives; ``ambiguous``: cells of several
    cities; ``unusable``: readings that count as missing; ``orphans``: hourly rows per city
    that the city table lacks; ``duplicates``: keys that occur twice, by table.
    """
    city, hours = store.read("city"), store.held("weather_hour")
    lost = quality.orphans(hours, city, "IdCity").groupBy("IdCity").agg(F.count("*").alias("rows"))
    twice = [
        quality.duplicate_keys(store.held(name), list(TABLES[name].keys)).agg(
            F.lit(name).alias("table_name"), F.count("*").alias("keys")
        )
        for name in TABLES
    ]
    reports = {
        "unmatched": quality.unmatched_cells(raw, city),
        "ambiguous": quality.ambiguous_cells(city),
        "unusable": quality.unusable(raw),
        "orphans": lost,
        "duplicates": reduce(DataFrame.unionByName, twice),
    }
    for name, report in reports.items():
        append_health(report, as_of, f"{target}/{name}")


def analyze_job(store: CatalogStore) -> None:
    """Column statistics of every table that was written."""
    for name in TABLES:
        if store.spark.catalog.tableExists(store.name(name)):
            analyze(store.spark, store.name(name))


def summaries_from_hours(weather_hour: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Monthly and weekly summaries straight from hourly rows, without stored daily tables."""
    wide = daily(weather_hour)
    return monthly(wide), weekly(wide)


def load_countries(seed: DataFrame, store: Store) -> None:
    """Add the countries of ``seed`` that the store lacks."""
    held = store.held("country")
    with staged(absent_countries(seed, held)) as absent, staged(number_countries(absent, held)) as rows:
        write_table(store, rows, "country", "error", stored=True)


def load_dims(seed: DataFrame, store: Store) -> None:
    """Add the countries and cities of ``seed`` that the store lacks."""
    load_countries(seed, store)
    held = store.held("city")
    with staged(absent_cities(seed, store.read("country"), held)) as absent, staged(number_cities(absent, held)) as rows:
        write_table(store, rows, "city", "error", stored=True)


def _range(first: date | None, last: date | None, tz: str) -> Period | None:
    if (first is None) != (last is None):
        raise ValueError("give both dates or neither")
    return date_period(first, last, tz) if first else None


def _within(span: Period | None):
    return None if span is None else in_dates("Date", *span.dates)
