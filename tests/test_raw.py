import json
from datetime import date, datetime

import pytest
from conftest import SF, at, doc, plan, rows
from pyspark.sql import functions as F

from skylattice.operators.filters import before, between_half_open, since
from skylattice.operators.hourly import hourly
from skylattice.operators.quality import unmatched_cells, unusable
from skylattice.schemas import RAW_LANDED
from skylattice.sources.raw import land_raw, read_raw, undeclared
from skylattice.sources.tables import register
from skylattice.streaming.observations import land_stream


def write(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines))


DOCS = [doc("2024-01-01T23:59:59"), doc("2024-01-02T00:00:00"), doc("2024-01-03T12:00:00", rain=1.0)]


def test_landing_keeps_every_document(spark, tmp_path, city):
    write(tmp_path / "in", "a.json", *DOCS, '{"coord": {"lon": 1', {"dt": "soon", "name": "x"})
    land_raw(spark, str(tmp_path / "in"), str(tmp_path / "raw"))
    raw = read_raw(spark, str(tmp_path / "raw"))
    counts = raw.groupBy("obs_date").agg(F.count("*"), F.count("_corrupt"))
    assert rows(counts, "obs_date") == [
        (None, 2, 2),
        (date(2024, 1, 1), 1, 0),
        (date(2024, 1, 2), 1, 0),
        (date(2024, 1, 3), 1, 0),
    ]
    assert hourly(raw, city).count() == 3
    assert rows(unmatched_cells(raw, city)) == [(None, None, 2)]


def test_landing_keeps_undeclared_fields(spark, tmp_path):
    write(tmp_path / "in", "a.json", doc("2024-01-01") | {"snow": {"1h": 0.5}, "new": [1]}, "", "not json")
    land_raw(spark, str(tmp_path / "in"), str(tmp_path / "raw"))
    raw = read_raw(spark, str(tmp_path / "raw"), schema=RAW_LANDED)
    found = raw.select(undeclared(raw, "$.snow['1h']"), undeclared(raw, "$.new"), "_corrupt")
    assert sorted(rows(found), key=str) == [("0.5", "[1]", None), (None, None, "not json")]


def test_multiline_documents(spark, tmp_path, city):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text(json.dumps(DOCS[0], indent=2))
    land_raw(spark, str(tmp_path / "in"), str(tmp_path / "raw"), multiline=True)
    assert rows(read_raw(spark, str(tmp_path / "raw")).select("dt", "_corrupt")) == [(DOCS[0]["dt"], None)]
    land_stream(spark, str(tmp_path / "in"), str(tmp_path / "s"), str(tmp_path / "state"), multiline=True).awaitTermination()
    assert read_raw(spark, str(tmp_path / "s")).count() == 1


def test_any_time_lands(spark, tmp_path, city):
    write(tmp_path / "in", "a.json", *(doc(t) for t in (10**15, -(10**15), 0)), doc(0) | {"dt": None})
    land_raw(spark, str(tmp_path / "in"), str(tmp_path / "raw"))
    raw = read_raw(spark, str(tmp_path / "raw"))
    assert raw.count() == 4 and raw.filter("obs_date is null").count() == 3
    assert hourly(raw, city).count() == 1
    assert {r.measure: (r.missing, r.unusable) for r in unusable(raw).collect()}["dt"] == (1, 2)


def test_period_reads_only_its_partitions(spark, tmp_path):
    write(tmp_path / "in", "a.json", *DOCS)
    land_raw(spark, str(tmp_path / "in"), str(tmp_path / "raw"))
    day = read_raw(
        spark, str(tmp_path / "raw"), start=datetime(2024, 1, 2), end=datetime(2024, 1, 3)
    )
    assert [r.dt for r in day.collect()] == [at("2024-01-02")]
    text = plan(day.select("main.temp"))
    assert "PartitionFilters: [isnotnull(obs_date" in text
    assert "GreaterThanOrEqual(dt," in text and "LessThan(dt," in text


def test_only_fields_in_use_are_read(spark, tmp_path, city):
    write(tmp_path / "in", "a.json", *DOCS)
    land_raw(spark, str(tmp_path / "in"), str(tmp_path / "raw"))
    text = plan(hourly(read_raw(spark, str(tmp_path / "raw")), city))
    schema = text[text.index("ReadSchema: ") :].splitlines()[0]
    assert "main:struct<temp:double,feels_like:double,pressure:double,humidity:double>" in schema
    for unused in ("weather", "sunrise", "gust", "_corrupt", "temp_min"):
        assert unused not in schema


def test_bounds_on_epoch_seconds(raw):
    data = raw(*(doc(t) for t in (9, 10, 11)))
    get = lambda df: [r.dt for r in df.orderBy("dt").collect()]
    ten = datetime(1970, 1, 1, 0, 0, 10)
    assert get(since(data, "dt", ten)) == [10, 11]
    assert get(since(data, "dt", ten.replace(microsecond=1))) == [11]
    assert get(before(data, "dt", ten)) == [9]
    assert get(between_half_open(data, "dt", ten, ten.replace(second=11))) == [10]


def test_stream_lands_each_file_once(spark, tmp_path):
    paths = [str(tmp_path / p) for p in ("in", "raw", "state")]
    write(tmp_path / "in", "a.json", *DOCS[:2])
    land_stream(spark, *paths).awaitTermination()
    write(tmp_path / "in", "b.json", DOCS[2], "{broken")
    for _ in range(2):
        land_stream(spark, *paths).awaitTermination()
    raw = read_raw(spark, paths[1])
    assert raw.count() == 4 and raw.filter("_corrupt is not null").count() == 1
    land_raw(spark, *paths[:2])
    assert read_raw(spark, paths[1]).count() == 4


def test_same_documents_land_once(spark, tmp_path):
    """Under several file names, in one batch and in several, by batch and by stream."""
    paths = [str(tmp_path / p) for p in ("in", "raw", "state")]
    write(tmp_path / "in", "a.json", *DOCS, DOCS[0], "{broken", "{broken")
    land_raw(spark, *paths[:2])
    assert read_raw(spark, paths[1]).count() == 4
    write(tmp_path / "in", "b.json", DOCS[1], doc("2024-01-02T00:00:01"))
    land_stream(spark, *paths).awaitTermination()
    raw = read_raw(spark, paths[1], schema=RAW_LANDED)
    assert raw.count() == 5 and raw.select("digest").distinct().count() == 5
    assert rows(raw.filter("document is not null").select("document")) == [("{broken",)]


def test_a_lost_batch_lands_once(spark, tmp_path):
    paths = [str(tmp_path / p) for p in ("in", "raw", "state")]
    write(tmp_path / "in", "a.json", *DOCS)
    land_stream(spark, *paths).awaitTermination()
    for commit in (tmp_path / "state" / "commits").iterdir():
        commit.unlink()  # as if the program had ended before it could say that the batch was done
    land_stream(spark, *paths).awaitTermination()
    assert read_raw(spark, paths[1]).count() == 3


def test_a_file_stream_keeps_its_folder(spark, tmp_path):
    from skylattice.streaming.observations import read_raw_stream, run_available

    write(tmp_path / "in", "a.json", *DOCS)
    folder = str(tmp_path / "out")
    run_available(read_raw_stream(spark, str(tmp_path / "in")), folder, str(tmp_path / "state")).awaitTermination()
    with pytest.raises(ValueError, match="log of a file stream"):
        land_raw(spark, str(tmp_path / "in"), folder)


def test_looking_for_landed_documents_reads_their_dates_only(spark, tmp_path):
    from skylattice.sources.raw import _met_before, parse_documents, with_obs_date

    write(tmp_path / "in", "a.json", *DOCS)
    land_raw(spark, str(tmp_path / "in"), str(tmp_path / "raw"))
    write(tmp_path / "new", "b.json", DOCS[1], DOCS[1])
    parsed = parse_documents(spark.read.text(str(tmp_path / "new")))
    batch = with_obs_date(parsed).withColumn("digest", F.unhex(F.md5("document")))
    found = _met_before(batch, str(tmp_path / "raw"))
    assert rows(found.select("_n", "_known")) == [(2, True)]
    text = plan(found)
    landed = text[text.index(str(tmp_path / "raw")) :]
    assert "PartitionFilters: [((obs_date" in landed and "2024-01-02" in landed
    assert "ReadSchema: struct<digest:binary>" in landed


def test_sql_over_a_registered_view(spark, raw):
    register(raw(*DOCS), "observations")
    found = spark.sql("SELECT max(rain.`1h`) AS r, count(main.temp) AS n FROM observations")
    assert rows(found) == [(1.0, 3)]


def test_parquet_without_partitions_keeps_its_period(spark, raw, tmp_path):
    raw(*DOCS).write.parquet(str(tmp_path / "flat"))
    day = read_raw(spark, str(tmp_path / "flat"), start=datetime(2024, 1, 2), end=datetime(2024, 1, 3))
    assert [r.dt for r in day.collect()] == [at("2024-01-02")]


def test_documents_written_again_are_dealt_to_all_tasks(spark, tmp_path, monkeypatch):
    """Not to a fixed number of tasks, whatever the input."""
    from skylattice.plans import catalog

    made = {}
    monkeypatch.setattr(catalog, "new_dir", lambda _, label: made.setdefault(label, str(tmp_path / label)))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert catalog.landed_once(spark, SF).count() > 0
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(list((tmp_path / "again").glob("part-*"))) == 4  # the session's shuffle partitions
