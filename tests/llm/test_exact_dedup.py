import hashlib
import re
from collections import defaultdict

import numpy as np
import pytest
from conftest import SF
from hypothesis import given, settings
from hypothesis import strategies as st
from texts import ODD, empty, odd

from skylattice.llm import exact_dedup as X


def plain(text):
    return re.sub("[\x20\x09-\x0d]+", " ", text or "")


def expected(rows):
    groups = defaultdict(list)
    for i, text in rows:
        groups[plain(text)].append(i)
    out = []
    for norm, ids in groups.items():
        known = sorted(i for i in ids if i is not None)
        keep = known[0] if known else None
        stayed = False
        for i in ids:
            stays = i == keep and not stayed
            stayed |= stays
            out.append((i, keep, len(ids), stays, hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=str)


def test_odd_rows(spark):
    got = [tuple(r) for r in X.mark(odd(spark)).collect()]
    assert sorted(got, key=str) == expected([(r[0], r[1]) for r in ODD])


def test_rows_that_stay_keep_their_columns(spark):
    df = odd(spark)
    kept = X.deduplicate(df)
    assert kept.columns == df.columns
    stays = [r for r in expected([(r[0], r[1]) for r in ODD]) if r[3]]
    assert sorted(r.doc_id or -1 for r in kept.collect()) == sorted(r[0] or -1 for r in stays)


def test_empty_table(spark):
    assert X.mark(empty(spark)).collect() == []
    assert X.deduplicate(empty(spark)).collect() == []


def test_hot_group_and_null_ids(spark):
    rows = [(i, "same text") for i in range(500)] + [(None, "same  text"), (None, "alone"), (None, "alone")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = [tuple(r) for r in X.mark(df).collect()]
    assert sorted(got, key=str) == expected(rows)


def test_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = [tuple(r) for r in X.mark(docs).collect()]
    assert sorted(got, key=str) == expected([(r.doc_id, r.text) for r in docs.collect()])


@settings(max_examples=30, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2**64 - 1) | st.integers(0, 5), max_size=40), min_size=1, max_size=5))
def test_filters_hold_and_merge_without_loss(parts):
    layout = X.Layout(sum(map(len, parts)))
    prints, counts = [], []
    for part in parts:
        packed = layout.pack(*np.unique(np.array(part, dtype=np.uint64), return_counts=True))
        for row in packed.to_pylist():
            p, c = layout.unpack(*row.values())
            prints.append(p)
            counts.append(c)
    if prints:
        merged = X.counted(np.concatenate(prints), np.concatenate(counts))
        once = np.unique(np.array(sum(parts, []), dtype=np.uint64), return_counts=True)
        assert [x.tolist() for x in merged] == [x.tolist() for x in once]
    else:
        assert not sum(parts, [])


def test_colliding_fingerprints_are_told_apart(spark, monkeypatch):
    """Texts that share a fingerprint go to byte verification and stay apart."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(X, "_rows", lambda docs: docs.select("doc_id", X.normalised().alias("norm")).withColumn("print", F.lit(1).cast("long")))
    rows = [(1, "a"), (2, "b"), (3, "a ")]
    got = X.verified(spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "doc_id long, text string")).collect()
    assert [(r.keep, r.n) for r in got] == [(1, 2)]
    assert len(rows) == 3


@pytest.mark.parametrize("text", ["a\t\tb", " a", "a ", "\r\n", "a  b", "a\x0bb", "a b"])
def test_normal_form(spark, text):
    df = spark.createDataFrame([(text,)], "text string")
    assert df.select(X.normalised()).first()[0] == plain(text)
