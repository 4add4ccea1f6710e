from datetime import date, datetime, timedelta

import pytest
from conftest import SF, doc, plan, rows
from pyspark.sql import functions as F

from skylattice.operators.conditions import condition_daily
from skylattice.operators.gaps import fill_gaps
from skylattice.operators.hourly import hourly
from skylattice.operators.increments import hours_of
from skylattice.plans.jobs import fill_job, increment_job
from skylattice.schemas import HOUR_MEASURES
from skylattice.sinks.tables import write_table
from skylattice.sources import star
from skylattice.sources.tables import FileStore


@pytest.fixture
def store(spark, tmp_path, city):
    store = FileStore(spark, str(tmp_path / "t"))
    write_table(store, city, "city", "append")
    return store


def everything(df):
    return sorted(map(str, rows(df)))


def test_lots_add_up_to_one_pass_over_everything(spark, store):
    """Three lots in any order, the last with observations of all dates, and one of them twice."""
    cities = star.cities(spark, SF)
    write_table(store, cities.filter("IdCity > 2"), "city", "append")
    cities = store.read("city")
    seen = star.observations(spark, SF).filter("dt < 1704412800")  # four dates, for the test's time
    for lot in (1, 0, 2, 1):
        increment_job(seen.filter(F.col("dt") % 3 == lot), store, f"lot-{lot}")
    assert everything(store.read("weather_hour")) == everything(hourly(seen, cities))
    assert everything(store.read("weather_condition_day")) == everything(condition_daily(seen, cities))


def test_a_lot_reads_itself_and_the_sums_of_its_dates(spark, store, raw):
    days = [datetime(2024, 1, 1) + timedelta(days=k) for k in range(3)]
    increment_job(raw(*(doc(d.isoformat(), temp=1.0) for d in days)), store, "first")
    touched = F.col("Date").isin([date(2024, 1, 2)])
    text = plan(hours_of(store.read("cell_hour").filter(touched), store.read("city")))
    sums = text[text.index("cell_hour") :]
    assert "2024-01-02" in sums[: sums.index("PushedFilters")]
    before = {f: f.stat().st_mtime_ns for f in (spark_files(store, "weather_hour"))}
    increment_job(raw(doc("2024-01-02T00:30:00", temp=2.0), doc("2024-01-02T05:00:00", weather=None)), store, "late")
    after = {f: f.stat().st_mtime_ns for f in (spark_files(store, "weather_hour"))}
    same = {f.parent.name for f in before if after.get(f) == before[f]}
    assert same == {"Date=2024-01-01", "Date=2024-01-03"}
    found = store.read("weather_hour").select("Date", "Hour", "Temp")
    assert rows(found.filter(touched), "Hour") == [(date(2024, 1, 2), 0, 1.5), (date(2024, 1, 2), 5, 284.2)]


def spark_files(store, name):
    from pathlib import Path

    return sorted(Path(store.path(name)).rglob("*.parquet"))


def test_odd_lots(spark, store, raw):
    increment_job(raw(), store, "nothing")
    increment_job(raw(doc(None), doc("2024-01-01", lon=None), doc(10**15)), store, "nowhere")
    increment_job(raw(doc("2024-01-01", temp=None, weather=[]), doc("2024-01-01", temp=4.0)), store, "a.b")
    found = store.read("weather_hour").select("IdCity", "Temp", "Rain")
    assert rows(found) == [(1, 4.0, 0.0)]
    for name in ("", "a/b", "a b", "a=b"):
        with pytest.raises(ValueError, match="lot"):
            increment_job(raw(), store, name)


def test_filling_two_periods_reads_the_kept_values(spark, store, hours):
    a, b, c = date(2024, 1, 1), date(2024, 1, 3), date(2024, 1, 5)
    known = [(1, a, 3, 1.0), (1, date(2024, 1, 2), 20, 2.0), (1, b, 5, 3.0), (2, date(2023, 12, 30), 1, 9.0), (77, a, 0, 5.0)]
    write_table(store, hours(*({"IdCity": i, "Date": d, "Hour": h, "Temp": t} for i, d, h, t in known)), "weather_hour")
    for _ in range(2):
        fill_job(store, a, date(2024, 1, 2))
        fill_job(store, b, date(2024, 1, 4))
    whole = fill_gaps(store.read("weather_hour"), store.read("city"), datetime(2024, 1, 1), datetime(2024, 1, 5))
    assert everything(store.read("hour_filled")) == everything(whole) and whole.count() == 2 * 96
    kept = store.read("last_known").select("IdCity", "AsOf", "Temp")
    assert rows(kept, "AsOf", "IdCity") == [(1, b, 2.0), (2, b, 9.0), (1, c, 3.0), (2, c, 9.0)]


def test_filling_from_kept_values_scans_the_period_only(spark, store, hours):
    write_table(store, hours({"IdCity": 1, "Date": date(2024, 1, 1), "Hour": 3, "Temp": 1.0}), "weather_hour")
    fill_job(store, date(2024, 1, 1), date(2024, 1, 1))
    kept = store.read("last_known").filter(F.col("AsOf") == F.lit(date(2024, 1, 2)))
    filled = fill_gaps(store.read("weather_hour"), store.read("city"), datetime(2024, 1, 2), datetime(2024, 1, 4), kept)
    text = plan(filled)
    assert text.count("tables/weather_hour]") + text.count("t/weather_hour]") == 1
    scan = text[text.index("/weather_hour]") :]
    assert "(Date" in scan and "2024-01-02" in scan[: scan.index("ReadSchema")] and "2024-01-03" in scan[: scan.index("ReadSchema")]
    assert [m for m in HOUR_MEASURES if filled.select(m).distinct().count() > 2] == []


def test_filling_without_kept_values_scans_the_hours_once(spark, store, hours):
    write_table(store, hours({"IdCity": 1, "Date": date(2024, 1, 1), "Hour": 3, "Temp": 1.0}), "weather_hour")
    text = plan(fill_gaps(store.read("weather_hour"), store.read("city"), datetime(2024, 1, 2), datetime(2024, 1, 4)))
    assert text.count("t/weather_hour]") == 1
