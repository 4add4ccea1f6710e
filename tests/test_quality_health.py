from datetime import date, datetime

from conftest import SF, doc, rows

from skylattice.operators import health, quality


def test_not_null(spark):
    df = spark.createDataFrame([(1, None), (None, None)], "a int, b int")
    assert rows(quality.check_not_null(df, ["a", "b"]), "column_name") == [("a", 1), ("b", 2)]


def test_duplicates_and_orphans(spark, city, hours):
    D = date(2024, 1, 1)
    fact = hours(*({"IdCity": c, "Date": D, "Hour": 0} for c in (1, 1, 5, None)))
    assert rows(quality.duplicate_keys(fact, ["IdCity", "Date", "Hour"])) == [(1, D, 0, 2)]
    assert [r.IdCity for r in quality.orphans(fact, city, "IdCity").collect()] == [5]


def test_cells(raw, table):
    city = table("city", (1, "A", 1, 7.367, 45.133), (2, "B", 1, 7.371, 45.129), (3, "C", 1, None, 1.0))
    assert rows(quality.ambiguous_cells(city)) == [(7.37, 45.13, 2)]
    data = raw(doc(0), doc(0, lon=1.0, lat=2.0), doc(0, lon=1.001, lat=2.0))
    assert rows(quality.unmatched_cells(data, city)) == [(1.0, 2.0, 2)]


def test_table_stats(spark, tmp_path):
    import os

    paths = {n: f"{SF}/{n}.parquet" for n in ("events", "nation", "orders")}
    found = health.table_stats(spark, paths).collect()
    assert [r.table_name for r in found] == sorted(paths, key=lambda n: -os.path.getsize(paths[n]))
    assert {r.table_name: r.size_bytes for r in found} == {n: os.path.getsize(p) for n, p in paths.items()}
    assert {r.table_name: r.row_count for r in found} == {n: spark.read.parquet(p).count() for n, p in paths.items()}
    total = health.total_size(health.table_stats(spark, paths)).first()
    assert total.size_bytes == sum(map(os.path.getsize, paths.values()))


def test_health_history_and_trend(spark, tmp_path):
    target = str(tmp_path / "health")
    for day, n in [(1, 3), (2, 10)]:
        data = str(tmp_path / f"t{day}")
        spark.range(n).write.parquet(data)
        stats = health.table_stats(spark, {"t": data})
        health.append_health(stats, datetime(2024, 1, day, 1, 10), target)
    trend = health.stats_trend(spark.read.parquet(target)).orderBy("as_of").collect()
    assert [(r.row_count, r.row_count_change) for r in trend] == [(3, None), (10, 7)]


def test_analyze(spark, tmp_path):
    spark.range(4).write.mode("overwrite").option("path", str(tmp_path / "a")).saveAsTable("analyzed")
    health.analyze(spark, "analyzed")
    info = {r.col_name: r.data_type for r in spark.sql("DESCRIBE EXTENDED analyzed").collect()}
    assert "4 rows" in info["Statistics"]
    spark.sql("DROP TABLE analyzed")


def test_a_snapshot_of_one_moment_is_kept_once(spark, tmp_path):
    stats = spark.createDataFrame([("t", 3, 5)], "table_name string, row_count bigint, size_bytes bigint")
    for as_of in (datetime(2024, 1, 1, 5), datetime(2024, 1, 1, 5), datetime(2024, 1, 2, 5)):
        health.append_health(stats, as_of, str(tmp_path / "health"))
    assert spark.read.parquet(str(tmp_path / "health")).count() == 2
