from datetime import date, datetime

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from skylattice import session
from skylattice.operators.monthly import monthly_join
from skylattice.plans import jobs
from skylattice.schemas import TABLES
from skylattice.sinks.tables import WriteConflict, write_table
from skylattice.sources.tables import CatalogStore, FileStore, MissingTable

FOUR = ["temperature_day", "humidity_day", "rain_day", "wind_day"]


@pytest.fixture
def store(spark, tmp_path):
    made = CatalogStore(spark, "t_" + "".join(c for c in tmp_path.name if c.isalnum()), 4, str(tmp_path / "db"))
    yield made
    spark.sql(f"DROP DATABASE {made.database} CASCADE")


@pytest.fixture
def hourly_rows(hours):
    names = [c for c in TABLES["weather_hour"].columns if c not in ("IdCity", "Date", "Hour")]
    return hours(
        *(
            {"IdCity": c, "Date": date(2024, m, d), "Hour": h} | dict.fromkeys(names, float(c * m + d + h))
            for c in range(1, 6)
            for m in (1, 2)
            for d in (1, 2, 3)
            for h in (0, 12)
        )
    )


def test_jobs_give_the_rows_of_the_file_store(spark, store, hourly_rows, tmp_path):
    files = FileStore(spark, str(tmp_path / "files"))
    for target in (store, files):
        write_table(target, hourly_rows, "weather_hour")
        jobs.daily_backfill(target, date(2024, 1, 1), date(2024, 2, 28))
        jobs.monthly_job(target, datetime(2024, 2, 2))
        jobs.monthly_job(target, datetime(2024, 2, 2), "replace")
        jobs.daily_backfill(target, date(2024, 1, 1), date(2024, 2, 28), "replace")
    for name in [*FOUR, "AVG_month"]:
        got = rows(store.read(name), *store.read(name).columns)
        assert got and got == rows(files.read(name), *files.read(name).columns)


def test_the_monthly_join_moves_no_rows_and_knows_their_number(spark, store, hourly_rows):
    write_table(store, hourly_rows, "weather_hour")
    jobs.daily_backfill(store, date(2024, 1, 1), date(2024, 2, 28))
    shown = spark.sql(f"DESCRIBE EXTENDED {store.name(FOUR[0])}").where("col_name = 'Statistics'").first()
    assert "30 rows" in shown.data_type
    column = spark.sql(f"DESCRIBE EXTENDED {store.name(FOUR[0])} IdCity").where("info_name = 'distinct_count'").first()
    assert column.info_value == "5"
    settings = session.CO_LOCATED | {"spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        assert "Exchange" not in plan(monthly_join(*(store.read(n) for n in FOUR)))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_checks_hold_and_stale_partitions_go(store, table):
    name, jan = "temperature_day", [date(2024, 1, d) for d in (1, 2)]
    width = len(TABLES[name].columns) - 2
    with pytest.raises(MissingTable):
        store.read(name)
    day = lambda *keys: table(name, *((c, d, *([1.0] * width)) for c, d in keys))
    write_table(store, day((1, jan[0]), (2, jan[1])), name)
    with pytest.raises(WriteConflict):
        write_table(store, day((1, jan[0])), name)
    write_table(store, day((1, jan[0]), (3, jan[0])), name, "skip")
    assert store.read(name).count() == 3
    write_table(store, day((5, jan[1])), name, "replace", F.col("Date").between(*jan))
    assert [(r.IdCity, r.Date) for r in store.read(name).collect()] == [(5, jan[1])]


def test_statistics_by_a_job_of_their_own(spark, store, table):
    store.analysed = False
    width = len(TABLES["wind_day"].columns) - 2
    write_table(store, table("wind_day", (1, date(2024, 1, 1), *([1.0] * width))), "wind_day")
    described = lambda: spark.sql(f"DESCRIBE EXTENDED {store.name('wind_day')}").where("col_name = 'Statistics'").collect()
    assert not any("1 rows" in r.data_type for r in described())
    jobs.analyze_job(store)
    assert any("1 rows" in r.data_type for r in described())


def test_names_of_databases(spark):
    with pytest.raises(ValueError, match="letters"):
        CatalogStore(spark, "a; drop")
