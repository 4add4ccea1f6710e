import json
from datetime import date

import pytest
from conftest import SF, doc, rows

from pyspark.sql import functions as F

from skylattice.operators.conditions import condition_daily
from skylattice.operators.hourly import hourly
from skylattice.schemas import TABLES
from skylattice.session import STREAMING
from skylattice.sinks.tables import WriteConflict, write_table
from skylattice.sources import star
from skylattice.sources.raw import parse_documents
from skylattice.sources.tables import FileStore
from skylattice.streaming.observations import (
    condition_stream,
    hourly_stream,
    into_table,
    read_document_stream,
    read_raw_stream,
    run_available,
)


@pytest.fixture(params=["default", "rocksdb"])
def state_store(request, spark):
    if request.param == "rocksdb":
        for k, v in STREAMING.items():
            spark.conf.set(k, v)
    yield
    for k in STREAMING:
        spark.conf.unset(k)


def feed(tmp_path, name, *docs):
    (tmp_path / "in").mkdir(exist_ok=True)
    (tmp_path / "in" / name).write_text("\n".join(json.dumps(d) for d in docs))


def forget(path):
    path.unlink()
    path.with_name(f".{path.name}.crc").unlink(missing_ok=True)


def run(spark, tmp_path, build, city, table):
    stream = build(read_raw_stream(spark, str(tmp_path / "in")), city, "15 minutes")
    run_available(stream, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    return spark.read.schema(TABLES[table].ddl).parquet(str(tmp_path / "out"))


def test_hours_close_with_the_watermark_and_late_rows_drop(spark, tmp_path, city, state_store):
    feed(tmp_path, "1.json", doc("2024-01-01T10:10:00", temp=1.0), doc("2024-01-01T10:50:00", temp=2.0))
    assert run(spark, tmp_path, hourly_stream, city, "weather_hour").count() == 0
    feed(tmp_path, "2.json", doc("2024-01-01T10:55:00", temp=3.0), doc("2024-01-01T11:20:00", temp=9.0))
    out = run(spark, tmp_path, hourly_stream, city, "weather_hour")
    assert rows(out.select("IdCity", "Date", "Hour", "Temp")) == [(1, date(2024, 1, 1), 10, 2.0)]
    feed(tmp_path, "3.json", doc("2024-01-01T10:59:00", temp=99.0), doc("2024-01-01T12:30:00"))
    out = run(spark, tmp_path, hourly_stream, city, "weather_hour")
    assert rows(out.select("Hour", "Temp"), "Hour") == [(10, 2.0), (11, 9.0)]


def test_days_close_with_the_watermark(spark, tmp_path, city, state_store):
    rain, fog = [("Rain", "r")], [("Fog", "f")]
    feed(tmp_path, "1.json", doc("2024-01-01T01:00:00", weather=rain), doc("2024-01-01T02:00:00", weather=fog))
    feed(tmp_path, "2.json", doc("2024-01-01T23:00:00", weather=rain), doc("2024-01-02T00:30:00", weather=fog))
    feed(tmp_path, "3.json", doc("2024-01-03T00:30:00", weather=fog), doc("2024-01-01T22:00:00", lon=None))
    out = run(spark, tmp_path, condition_stream, city, "weather_condition_day")
    assert rows(out, "Date") == [(1, date(2024, 1, 1), "Rain", "r"), (1, date(2024, 1, 2), "Fog", "f")]


@pytest.mark.parametrize(
    "build, batch, table",
    [(hourly_stream, hourly, "weather_hour"), (condition_stream, condition_daily, "weather_condition_day")],
)
def test_stream_equals_batch_once_all_windows_closed(spark, tmp_path, build, batch, table):
    city = star.cities(spark, SF)
    data = star.observations(spark, SF)
    data.write.json(str(tmp_path / "in"))
    feed(tmp_path, "last.json", doc("2030-01-01T00:00:00", lon=0.0, lat=0.5))
    out = run(spark, tmp_path, build, city, table)
    assert sorted(map(str, rows(out))) == sorted(map(str, rows(batch(data, city))))


def test_documents_of_a_text_column_stream_into_a_table(spark, tmp_path, city):
    feed(tmp_path, "1.txt", doc("2024-01-01T10:10:00", temp=1.0), doc("2024-01-01T10:50:00", temp=2.0))
    feed(tmp_path, "2.txt", doc("2024-01-01T12:30:00"))
    store = FileStore(spark, str(tmp_path / "t"))
    for _ in range(2):
        stream = hourly_stream(read_document_stream(spark, str(tmp_path / "in"), files=1), city, "15 minutes")
        into_table(stream, store, "weather_hour", str(tmp_path / "state")).awaitTermination()
    found = store.read("weather_hour").select("IdCity", "Date", "Hour", "Temp")
    assert rows(found) == [(1, date(2024, 1, 1), 10, 1.5)]


def test_a_stream_s_table_takes_batch_writes(spark, tmp_path, city, hours):
    """Rows that other writers add are seen, and a replayed batch adds nothing."""
    feed(tmp_path, "1.txt", doc("2024-01-01T10:10:00", temp=1.0), doc("2024-01-01T12:30:00", temp=5.0))
    store, state = FileStore(spark, str(tmp_path / "t")), str(tmp_path / "state")

    def stream():
        documents = read_document_stream(spark, str(tmp_path / "in"), files=1)
        into_table(hourly_stream(documents, city, "15 minutes"), store, "weather_hour", state).awaitTermination()

    def held():
        return rows(store.read("weather_hour").select("Date", "Hour", "Temp"), "Date", "Hour")

    first, second, other = (date(2024, 1, 1), 10, 1.0), (date(2024, 1, 1), 12, 5.0), (date(2024, 1, 2), 0, 7.0)
    stream()
    assert held() == [first]
    write_table(store, hours({"IdCity": 1, "Date": other[0], "Hour": 0, "Temp": 7.0}), "weather_hour")
    assert held() == [first, other]
    with pytest.raises(WriteConflict, match="key exists"):
        write_table(store, hours({"IdCity": 1, "Date": first[0], "Hour": 10, "Temp": 9.0}), "weather_hour")
    feed(tmp_path, "2.txt", doc("2024-01-02T10:10:00"))
    stream()
    assert held() == [first, second, other]
    # The last batch again: once on record as applied, once not.
    for applied in (True, False):
        last = max((tmp_path / "state" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
        forget(last)
        if not applied:
            forget(tmp_path / "state" / "applied" / last.name)
        stream()
        assert held() == [first, second, other]


def test_no_write_goes_into_a_file_stream_s_folder(spark, tmp_path, city, hours):
    feed(tmp_path, "1.json", doc("2024-01-01T10:10:00"), doc("2024-01-01T12:30:00"))
    store = FileStore(spark, str(tmp_path / "t"))
    stream = hourly_stream(read_raw_stream(spark, str(tmp_path / "in")), city)
    run_available(stream, store.path("weather_hour"), str(tmp_path / "state")).awaitTermination()
    row = hours({"IdCity": 1, "Date": date(2024, 1, 2), "Hour": 0})
    for mode, within in (("append", None), ("error", None), ("skip", None), ("replace", F.col("Date") == "2024-01-02")):
        with pytest.raises(ValueError, match="log of a file stream"):
            write_table(store, row, "weather_hour", mode, within)
    assert store.read("weather_hour").count() == 1


def test_binary_texts_are_parsed(spark):
    texts = spark.createDataFrame([(bytearray(json.dumps(doc(5)), "utf-8"),)], "value binary")
    assert [r.dt for r in parse_documents(texts).collect()] == [5]


@pytest.mark.parametrize("build", [hourly_stream, condition_stream])
def test_closed_windows_are_never_broadcast(spark, tmp_path, city, build):
    """The last batch has no rows of its own, so its size says nothing about what the state emits."""
    docs = [doc(f"2024-01-0{d}T10:10:00") for d in (1, 2, 3, 4)]
    feed(tmp_path, "1.json", *docs)
    stream = build(read_raw_stream(spark, str(tmp_path / "in")), city, "15 minutes")
    query = run_available(stream, str(tmp_path / "out"), str(tmp_path / "state"))
    query.awaitTermination()
    text = query._jsq.explainInternal(False)
    assert "SortMergeJoin" in text and "Broadcast" not in text
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3
