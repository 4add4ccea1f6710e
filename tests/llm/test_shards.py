import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF
from texts import ODD, empty, odd

from skylattice.llm import shards as S


def check(rows, n, shards):
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r.slot)
    assert sum(map(len, by.values())) == n
    assert all(sorted(slots) == list(range(len(slots))) for slots in by.values())
    sizes = [len(by.get(s, [])) for s in range(shards)]
    assert set(by) <= set(range(shards)) and max(sizes) - min(sizes) <= 1


@pytest.mark.parametrize("shards", [1, 3, 16])
def test_odd_rows(spark, shards):
    df = odd(spark)
    out = S.shard(df, shards)
    assert [c for c in out.columns if c not in ("shard", "slot")] == [c for c in df.columns if c not in ("shard", "slot")]
    rows = out.collect()
    check(rows, len(ODD), shards)
    assert Counter((r.doc_id, r.text) for r in rows) == Counter((r[0], r[1]) for r in ODD)


def test_empty_table(spark):
    assert S.shard(empty(spark)).collect() == []


def test_order_is_the_same_however_the_rows_come(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    one = {r.doc_id: (r.shard, r.slot) for r in S.shard(docs).collect()}
    two = {r.doc_id: (r.shard, r.slot) for r in S.shard(docs.repartition(5).orderBy("text")).collect()}
    assert one == two
    other = {r.doc_id: (r.shard, r.slot) for r in S.shard(docs, seed=4).collect()}
    assert one != other
    check(S.shard(docs).collect(), docs.count(), 16)


def test_large_bucket_is_permuted_in_runs(spark, monkeypatch):
    monkeypatch.setattr(S, "RUN_BYTES", 2000)
    df = spark.createDataFrame([(1, "same")] * 900 + [(i, "other") for i in range(100)], "doc_id long, text string")
    check(S.shard(df, 4).collect(), 1000, 4)


def plain_positions(rows, bits, seed):
    """Places by the method, without Spark: scatter, sort by the second hash, Fisher-Yates, buckets in a row."""
    buckets = {}
    for key, second, doc_id, others, row in rows:
        buckets.setdefault((key % (1 << 64)) >> (64 - bits), []).append((second, doc_id, others, row))
    out = []
    for bucket in sorted(buckets):
        held = [x[3] for x in sorted(buckets[bucket])]
        draw = np.random.default_rng([seed, bucket, 0])
        for i, j in zip(range(len(held) - 1, 0, -1), draw.integers(0, np.arange(len(held), 1, -1)), strict=True):
            held[i], held[j] = held[j], held[i]
        out += held
    return out


@pytest.mark.parametrize("bucket_bytes", [300, 8 << 20])
def test_against_a_plain_version(spark, monkeypatch, bucket_bytes):
    """Also where buckets are small and many, and where rows repeat with other columns."""
    monkeypatch.setattr(S, "BUCKET_BYTES", bucket_bytes)
    monkeypatch.setattr(S, "LEAST_BITS", 2)
    rows = [(i % 150, f"text {i % 150} " * (i % 9), f"row {i}") for i in range(450)]
    df = spark.createDataFrame(rows, "doc_id long, text string, other string")
    total = sum(len(t.encode()) + 1 for _, t, _ in rows)
    bits = max(2, int(np.ceil(np.log2(max(1, total / bucket_bytes)))))
    assert bits > 5 or bucket_bytes > 300
    key = S._keyed(df, 17)
    hashed = key.select("__key", S.F.xxhash64("__key", S.F.lit(18)), "doc_id", S.F.xxhash64(*df.columns), "other").collect()
    want = plain_positions([tuple(r) for r in hashed], bits, 17)
    for n in (1, 7):
        got = S.shuffled(df.repartition(n)).orderBy("position").collect()
        assert [r.position for r in got] == list(range(450))
        assert [r.other for r in got] == want


def test_many_buckets_join_their_offsets_without_a_broadcast(spark, monkeypatch):
    monkeypatch.setattr(S, "SMALL_BITS", 3)
    monkeypatch.setattr(S, "LEAST_BITS", 2)
    monkeypatch.setattr(S, "RUN_BYTES", 400)
    df = spark.createDataFrame([(i, "word " * (i % 7)) for i in range(400)], "doc_id long, text string")
    check(S.shard(df, 5).collect(), 400, 5)


def test_permutation_is_uniform():
    table = pa.table({"x": [0, 1, 2]})
    seen = Counter(tuple(S.permuted(table, 1, b, 0)["x"].to_pylist()) for b in range(6000))
    assert len(seen) == 6 and min(seen.values()) > 850
    assert S.permuted(table.slice(0, 0), 1, 0, 0).num_rows == 0


def test_written_shards_hold_every_row(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    S.write_shards(docs, str(tmp_path / "out"), shards=4)
    back = spark.read.parquet(str(tmp_path / "out"))
    check(back.collect(), docs.count(), 4)
    assert sum(zlib.crc32(r.text.encode()) for r in back.collect()) == sum(zlib.crc32((r.text or "").encode()) for r in docs.collect())


def test_positions_mix_neighbours(spark):
    rows = S.shuffled(spark.range(2000).selectExpr("id as doc_id", "string(id) as text")).collect()
    by_id = np.array([r.position for r in sorted(rows, key=lambda r: r.doc_id)])
    assert sorted(by_id) == list(range(2000))
    assert abs(np.corrcoef(by_id, np.arange(2000))[0, 1]) < 0.1
