import numpy as np
import pytest

from skylattice.llm import common
from skylattice.llm.common import components, pieces, small, stage, stage_all, unstage
from skylattice.storage import exists


def expected(edges):
    part = {}

    def find(x):
        part.setdefault(x, x)
        while part[x] != x:
            x = part[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        part[max(a, b)] = min(a, b)
    return {(x, find(x)) for x in part}


CASES = {
    "none": [],
    "loop": [(1, 1)],
    "path": [(i, i + 1) for i in range(40)],
    "path backwards": [(i + 1, i) for i in range(0, 80, 2)] + [(i, i + 1) for i in range(1, 79, 2)],
    "star": [(1000, i) for i in range(300)],
    "repeated": [(3, 2), (2, 3), (3, 2), (5, 4)],
    "random": [tuple(map(int, p)) for p in np.random.default_rng(3).integers(-200, 200, (220, 2))],
}


@pytest.mark.parametrize("name", CASES)
def test_components(spark, name):
    edges = CASES[name]
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert len(got) == len(set(got))
    assert {tuple(r) for r in got} == expected([e for e in edges if e[0] != e[1]])


def test_small_hints_only_within_its_bound(spark):
    def hinted(df):
        return "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()

    assert hinted(small(spark.range(10), 10)) and not hinted(small(spark.range(11), 10))


def test_staged_rows_are_read_back(spark):
    assert sorted(r.id for r in stage(spark.range(5), "x").collect()) == [0, 1, 2, 3, 4]


def test_pieces_hold_every_row_once_and_keys_together(spark, monkeypatch):
    monkeypatch.setattr(common, "BROADCAST", 10)
    parts = [[(r.k, r.id) for r in p.collect()] for p in pieces(spark.range(95).selectExpr("id", "id % 20 as k"), "k")]
    assert len(parts) == 10 and sorted(sum(parts, [])) == sorted((i % 20, i) for i in range(95))
    assert sum(len({k for k, _ in p}) for p in parts) == 20
    assert len(list(pieces(spark.range(3), "id", least=4))) == 4
    assert [p.count() for p in pieces(spark.range(0), "id")] == [0]


def test_parts_are_staged_as_one_table_and_deleted(spark):
    whole = stage_all((spark.range(k, k + 2) for k in (0, 5, 7)), "x")
    assert sorted(r.id for r in whole.collect()) == [0, 1, 5, 6, 7, 8]
    unstage(whole)
    assert not exists(spark, whole._staged_at)
