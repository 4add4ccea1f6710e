import hashlib
import re
from collections import defaultdict

import pytest
from conftest import SF
from texts import ODD, empty, odd

from skylattice.llm import curriculum as C


def water(words, weights, share=1.5, most=2):
    """Targets by giving out what is left, again and again."""
    target, open_, left = dict.fromkeys(words, 0.0), set(words), share * sum(words.values())
    while open_:
        total = sum(weights[s] for s in open_)
        full = {s for s in open_ if left * weights[s] / total > most * words[s]}
        if not full:
            target.update({s: left * weights[s] / total for s in open_})
            break
        target.update({s: float(most * words[s]) for s in full})
        left -= sum(most * words[s] for s in full)
        open_ -= full
    return target


def size(text):
    return len(re.findall("[^\x20\x09-\x0d]+", text or ""))


def check(rows, docs):
    words, largest = defaultdict(int), defaultdict(int)
    for _, text, source in docs:
        words[source] += size(text)
        largest[source] = max(largest[source], size(text))
    names = sorted(words, key=lambda s: (s is None, (s or "").encode()))
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    target, taken = water(words, weights), defaultdict(int)
    assert len(rows) == len(docs)
    for r in rows:
        assert r.source_size == words[r.source]
        assert r.target == pytest.approx(target[r.source])
        assert r.taken == r.copies * r.size <= 2 * r.size
        assert len(r.positions) == r.copies and all(0 <= p <= 1 for p in r.positions)
        taken[r.source] += r.taken
    for s in names:
        assert abs(taken[s] - target[s]) <= max(largest[s], 1)
    return taken, target


def test_documents_come_near_their_targets(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    taken, target = check(C.plan(docs).collect(), rows)
    assert sum(taken.values()) == pytest.approx(sum(target.values()), rel=0.05)


def test_odd_rows_and_reruns(spark):
    rows = [(r[0], r[1], r[2]) for r in ODD]
    first = C.plan(odd(spark)).collect()
    check(first, rows)
    again = C.plan(odd(spark).repartition(5)).collect()
    key = str
    assert sorted(map(key, first)) == sorted(map(key, again))


def test_empty_table_and_empty_texts(spark):
    assert C.plan(empty(spark)).collect() == []
    assert C.mix(empty(spark)).collect() == []
    nothing = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert [(r.size, r.taken, r.target) for r in C.plan(nothing).collect()] == [(0, 0, 0.0)] * 2


def test_hot_source(spark):
    rows = [(i, "w " * (i % 17 + 1), "hot" if i % 3 else f"s{i % 40}") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    taken, target = check(C.plan(df).collect(), rows)
    assert all(abs(taken[s] - target[s]) <= 8 for s in target)


def test_mix_is_in_training_order(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("copies", C.F.lit("mine"))
    mixed = C.mix(docs)
    rows = mixed.collect()
    assert [r.position for r in rows] == sorted(r.position for r in rows)
    assert len(rows) == C.plan(docs).agg({"copies": "sum"}).first()[0]
    assert mixed.columns == [*docs.columns, "position"]


def test_places_are_those_of_the_mix(spark):
    """Each copy has one place, and places follow positions."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").repartition(5)
    rows = C.ordered(docs).collect()
    copies = sorted((place, round(at, 9), r.doc_id) for r in rows for place, at in zip(r.places, r.positions, strict=True))
    assert [c[0] for c in copies] == list(range(len(copies)))
    assert [c[1:] for c in copies] == sorted(c[1:] for c in copies)
    assert [c[2] for c in copies] == [r.doc_id for r in C.mix(docs).collect()]
    assert {r.doc_id: r.places for r in C.ordered(docs.repartition(2)).collect()} == {r.doc_id: r.places for r in rows}


def test_places_of_odd_rows(spark):
    rows = C.ordered(odd(spark)).collect()
    assert len(rows) == len(ODD)
    assert sorted(p for r in rows for p in r.places) == list(range(sum(r.copies for r in rows)))
    assert C.ordered(empty(spark)).collect() == []


def integral(pieces, t):
    total = 0.0
    for t0, t1, w0, w1 in pieces:
        x = max(0.0, min(t, t1) - t0)
        total += x * w0 + (w1 - w0) / (t1 - t0) * x * x / 2
    return total


@pytest.mark.parametrize("pieces", [*C.THREE_ONE_TWO, [(0.0, 0.25, 0.0, 4.0), (0.25, 1.0, 0.0, 1.0)]])
def test_due_inverts_the_integral(spark, pieces):
    whole = C.integral(pieces)
    assert whole == pytest.approx(integral(pieces, 1.0))
    df = spark.range(201).select((C.F.col("id") / 200 * whole).alias("d"))
    df = df.select("d", C.due(C.F.col("d"), C._pieces(pieces)).alias("t"))
    for r in df.collect():
        assert integral(pieces, r.t) == pytest.approx(r.d, abs=1e-9)


def test_rising_source_comes_later_than_falling_one(spark):
    rows = [(i, "one two three", s) for i in range(400) for s in ("a", "b", "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    where = defaultdict(list)
    for r in C.plan(df).collect():
        where[r.source] += r.positions
    mean = {s: sum(p) / len(p) for s, p in where.items()}
    assert mean["a"] < mean["c"] < mean["b"]


def test_digest_is_md5(spark):
    df = spark.createDataFrame([(3, "x"), (None, None)], "doc_id long, text string")
    got = [r[0] for r in df.select(C.digest("mix")).collect()]
    assert got == [hashlib.md5(x).hexdigest() for x in (b"mix:3:x", b"mix:-:")]
