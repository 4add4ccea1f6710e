"""The jobs end to end over file tables, as the command line runs them."""

import json
from datetime import date, datetime

import pytest
from conftest import at, doc

from skylattice import __main__ as cli
from skylattice.plans import jobs
from skylattice.sinks.tables import WriteConflict
from skylattice.sources.raw import read_raw
from skylattice.sources.tables import FileStore

SEED = [
    {"country": "Italy", "city": "Turin", "lat": 45.133, "lon": 7.367},
    {"country": "Norway", "city": "Oslo", "lat": 59.91, "lon": 10.75},
]


@pytest.fixture
def place(spark, tmp_path):
    """Documents of two cities from 30 January to 1 February, every quarter of an hour."""
    (tmp_path / "in").mkdir()
    first, last = at("2024-01-30"), at("2024-02-01T06:00:00")
    docs = [
        doc(t, lon=s["lon"], lat=s["lat"], temp=280.0 + t // 900 % 8 + i, rain=0.5)
        for t in range(first, last, 900)
        for i, s in enumerate(SEED)
    ]
    (tmp_path / "in" / "a.json").write_text("\n".join(map(json.dumps, docs)))
    (tmp_path / "seed.json").write_text("\n".join(map(json.dumps, SEED)))
    return tmp_path


def run(place, *argv, mode="error"):
    cli.main(["--root", str(place / "t"), "--on-conflict", mode, *argv])


def count(spark, place, name):
    return FileStore(spark, str(place / "t")).read(name).count()


def test_all_jobs(spark, place):
    raw = ["--raw", str(place / "raw")]
    run(place, "load-dims", "--seed", str(place / "seed.json"))
    run(place, "load-dims", "--seed", str(place / "seed.json"))
    for _ in range(2):  # the second run finds nothing new
        run(place, "land", "--incoming", str(place / "in"), *raw)
    assert (count(spark, place, "country"), count(spark, place, "city")) == (2, 2)

    run(place, "hourly-backfill", *raw, "--start-date", "2024-01-30", "--end-date", "2024-01-31")
    assert count(spark, place, "weather_hour") == 2 * 48
    with pytest.raises(WriteConflict):
        run(place, "hourly-backfill", *raw)
    run(place, "hourly-backfill", *raw, mode="skip")
    assert count(spark, place, "weather_hour") == 2 * 54

    run(place, "daily-backfill", "--start-date", "2024-01-30", "--end-date", "2024-01-30")
    run(place, "daily", "--as-of", "2024-02-01T00:30:00")
    run(place, "daily", "--as-of", "2024-02-01T00:30:00", mode="replace")
    for name in ("temperature_day", "wind_day", "humidity_day", "rain_day", "pressure_day"):
        assert count(spark, place, name) == 4

    run(place, "condition-backfill", *raw, "--as-of", "2024-01-31T08:00:00")
    run(place, "condition", *raw, "--as-of", "2024-02-01T00:30:00")
    assert count(spark, place, "weather_condition_day") == 4

    run(place, "monthly", "--as-of", "2024-02-01T02:00:00")
    month = FileStore(spark, str(place / "t")).read("AVG_month").orderBy("IdCity").collect()
    assert [(r.Year, r.Month, r.AvgTemp, r.TempVariation) for r in month] == [
        (2024, 1, 283.5, 4.0),
        (2024, 1, 284.5, 4.0),
    ]
    run(place, "health", "--as-of", "2024-02-01T01:10:00", "--raw-path", str(place / "raw"))
    health = spark.read.parquet(str(place / "t" / "health"))
    counts = {r.table_name: r.row_count for r in health.collect()}
    assert (counts["weather_hour"], counts["raw"], counts["WeatherAlerts"]) == (108, 2 * 54 * 4, 0)

    for _ in range(2):
        run(place, "weekly", "--as-of", "2024-02-01T02:00:00", mode="replace")
    weeks = FileStore(spark, str(place / "t")).read("AVGWeek").orderBy("IdCity").collect()
    assert [(r.IdCity, r.Year, r.NumWeek) for r in weeks] == [(1, 2024, 5), (2, 2024, 5)]
    assert [tuple(r) for r in FileStore(spark, str(place / "t")).read("Week").collect()] == [
        (202405, 5, date(2024, 1, 29), date(2024, 2, 4))
    ]

    run(place, "quality", *raw, "--as-of", "2024-02-01T03:00:00", "--reports", str(place / "q"))
    report = lambda name: spark.read.parquet(str(place / "q" / name))
    assert report("unmatched").count() == report("ambiguous").count() == report("orphans").count() == 0
    assert report("unusable").filter("unusable > 0 or missing > 0").count() == 0
    assert report("duplicates").agg({"keys": "sum"}).first()[0] == 0


def test_a_job_without_its_input_fails(spark, place):
    for argv in (["daily", "--as-of", "2024-02-01"], ["monthly", "--as-of", "2024-02-01"], ["hourly-backfill", "--raw", str(place / "in"), "--raw-format", "json"]):
        with pytest.raises(FileNotFoundError):
            run(place, *argv)


def test_history_has_no_first_day(spark, place):
    run(place, "load-dims", "--seed", str(place / "seed.json"))
    old = [doc(at("1952-03-01T10:00:00")), doc(at("1952-03-01T11:00:00")) | {"dt": None}]
    (place / "old").mkdir()
    (place / "old" / "a.json").write_text("\n".join(map(json.dumps, old)))
    raw = ["--raw", str(place / "old"), "--raw-format", "json"]
    run(place, "condition-backfill", *raw, "--as-of", "2024-02-01T08:00:00")
    run(place, "hourly-backfill", *raw)
    store = FileStore(spark, str(place / "t"))
    assert [r.Date for r in store.read("weather_condition_day").collect()] == [date(1952, 3, 1)]
    assert [(r.Date, r.Hour) for r in store.read("weather_hour").collect()] == [(date(1952, 3, 1), 10)]


def test_hourly_runs_add_up_to_days(spark, place):
    store = FileStore(spark, str(place / "t"))
    run(place, "load-dims", "--seed", str(place / "seed.json"))
    raw = read_raw(spark, str(place / "in"), "json")
    for hour in (9, 10):
        jobs.hourly_job(raw, store, datetime(2024, 1, 30, hour, 5))
    assert [(r.Date, r.Hour) for r in store.read("weather_hour").filter("IdCity = 1").orderBy("Hour").collect()] == [
        (date(2024, 1, 30), 8),
        (date(2024, 1, 30), 9),
    ]
    with pytest.raises(WriteConflict):
        jobs.hourly_job(raw, store, datetime(2024, 1, 30, 10, 5))
    with pytest.raises(ValueError):
        jobs.hourly_job(raw, store, datetime(2024, 1, 30, 11, 5), "replace")


def test_summaries_from_hours(spark, place):
    run(place, "load-dims", "--seed", str(place / "seed.json"))
    store = FileStore(spark, str(place / "t"))
    jobs.hourly_backfill(read_raw(spark, str(place / "in"), "json"), store)
    months, weeks = jobs.summaries_from_hours(store.read("weather_hour"))
    assert (months.count(), weeks.count()) == (4, 2)


def test_command_line_rejects_bad_dates():
    with pytest.raises(SystemExit):
        cli.parse(["--root", "x", "daily-backfill", "--start-date", "soon", "--end-date", "2024-01-01"])
    with pytest.raises(SystemExit):
        cli.parse(["--root", "x", "daily-backfill"])
