import numpy as np
import pytest
from conftest import SF

from skylattice.llm import projections as P

SCHEMA = "vec_id long, embedding array<float>, label int, size long, kept string"


def brute(rows, cosine=0.95):
    """Links and smallest reachable ids by all pairs."""
    good = []
    for i, (vec_id, v) in enumerate(rows):
        if vec_id is not None and v and None not in v and np.isfinite(v).all() and np.any(np.array(v) != 0):
            good.append(i)
    links, part = [0] * len(rows), list(range(len(rows)))

    def find(x):
        while part[x] != x:
            x = part[x]
        return x

    for k, i in enumerate(good):
        for j in good[:k]:
            a, b = (np.array(rows[x][1], dtype=np.float64) for x in (i, j))
            if len(a) == len(b):
                a, b = a / np.abs(a).max(), b / np.abs(b).max()
                if a @ b / np.sqrt((a @ a) * (b @ b)) >= cosine:
                    links[i] += 1
                    links[j] += 1
                    part[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, (vec_id, _) in enumerate(rows):
        if vec_id is not None:
            least[find(i)] = min(least.get(find(i), vec_id), vec_id)
    return sorted(((rows[i][0], links[i], least.get(find(i))) for i in range(len(rows))), key=str)


def result(df):
    return sorted(((r.vec_id, r.n_links, r.component_id) for r in P.near_duplicates(df).collect()), key=str)


def test_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    v = [0.0, *map(float, np.random.default_rng(6).standard_normal(63))]
    times = lambda k: [x * k for x in v]
    vectors = [
        (1, v), (2, v), (2, v), (3, times(2.0)), (4, times(-1.0)), (5, None), (6, []), (7, times(0.0)),
        (8, [nan, *v[1:]]), (9, [inf, *v[1:]]), (10, [None, *v[1:]]), (None, v), (11, times(1e-30)),
        (12, [-0.0, *v[1:]]), (13, times(1e30)), (14, v[:32]), (15, v[:32]),
    ]
    df = spark.createDataFrame([(i, v, None, 3, "x") for i, v in vectors], SCHEMA)
    assert result(df) == brute([(i, v and [x if x is None else float(np.float32(x)) for x in v]) for i, v in vectors])
    assert P.near_duplicates(df.where("false")).collect() == []


def cloud(n, size, seed=1):
    """Vectors at random, near copies of some at cosines around the limit, and a hot copy."""
    draw = np.random.default_rng(seed)
    base = draw.standard_normal((n, size))
    rows = [base]
    for noise in (0.1, 0.25, 0.33, 0.4):
        some = base[draw.choice(n, n // 8)]
        length = np.linalg.norm(some, axis=1, keepdims=True)
        rows.append(some + noise * length / np.sqrt(size) * draw.standard_normal(some.shape))
    rows.append(np.repeat(base[:1], 50, axis=0))
    return np.concatenate(rows).astype(np.float32)


def frame(spark, vectors):
    return spark.createDataFrame([(i, v.tolist(), 0, 0, "") for i, v in enumerate(vectors)], SCHEMA).repartition(5)


def recall(spark, vectors):
    """Share of the links between different vectors that are found; none may be false."""
    unit = np.unique(vectors.astype(np.float32), axis=0).astype(np.float64)
    _, found = P.classes(frame(spark, unit.astype(np.float32)))
    got = {(r.a, r.b) for r in P.links(P.stage(found, "vectors")).collect()}
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    cosine = unit @ unit.T
    want = {(a, b) for a, b in zip(*np.nonzero(np.triu(cosine >= 0.95 + 1e-12, 1)), strict=True)}
    assert all(cosine[a, b] >= 0.95 - 1e-12 for a, b in got) and len(want) > 30
    return len(got & want) / len(want)


@pytest.mark.parametrize("size,shift", [(64, 0.0), (16, 0.0), (64, 0.6)])
def test_recall_over_different_vectors(spark, size, shift):
    assert recall(spark, cloud(700, size) + np.float32(shift)) >= 0.95


def test_recall_of_pairs_that_just_link(spark):
    """All pairs at cosines from 0.95 to 0.96, in clusters whose other pairs do not link."""
    draw = np.random.default_rng(9)
    middle = draw.standard_normal((8, 64))
    base = middle[draw.integers(0, 8, 600)] * 0.8 + draw.standard_normal((600, 64))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    away = draw.standard_normal((600, 64))
    away -= (away * base).sum(axis=1, keepdims=True) * base
    away /= np.linalg.norm(away, axis=1, keepdims=True)
    c = draw.uniform(0.9501, 0.96, (600, 1))
    assert recall(spark, np.concatenate([base, c * base + np.sqrt(1 - c * c) * away])) >= 0.93


def test_copies_count_as_links(spark):
    vectors = cloud(300, 32)
    unit = vectors.astype(np.float64)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    links = (unit @ unit.T >= 0.95).sum(axis=1) - 1
    got = np.array([r.n_links for r in sorted(P.near_duplicates(frame(spark, vectors)).collect(), key=lambda r: r.vec_id)])
    assert (got <= links).all() and got[-50:].min() >= 50


def test_crowded_regions_write_few_collisions(spark):
    """Vectors of a few clusters collide often; only those near one another are written."""
    draw = np.random.default_rng(10)
    middle = draw.standard_normal((4, 64))
    vectors = middle[draw.integers(0, 4, 1500)] * 0.7 + draw.standard_normal((1500, 64))
    _, found = P.classes(frame(spark, vectors.astype(np.float32)))
    found = P.stage(found, "vectors")
    plan = P.calibrate(1500, 64, P.Settings())
    assert P.collisions(found, plan).count() < 1500


def test_sketches_differ_as_angles_do():
    draw = np.random.default_rng(11)
    u, v = draw.standard_normal((2, 500, 32))
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    v -= (v * u).sum(axis=1, keepdims=True) * u
    w = 0.95 * u + np.sqrt(1 - 0.95**2) * v / np.linalg.norm(v, axis=1, keepdims=True)
    plan = P.calibrate(500, 32, P.Settings())
    near, far = (sum(P.differing(a, b) for a, b in zip(P.sketch(u, plan.signs).T, P.sketch(x, plan.signs).T, strict=True)) for x in (w, v))
    assert near.max() <= plan.differ and far.min() > plan.differ


def test_embeddings(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()][:400]
    some = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert result(some) == brute(rows)


def test_ends_are_all_sums_above_the_level():
    draw = np.random.default_rng(4)
    x, y = draw.standard_normal((30, 9)), draw.standard_normal((30, 7))
    at, direction, value = P.ends(x, y, 1.5)
    got = {(int(a), int(d)): float(v) for a, d, v in zip(at, direction, value, strict=True)}
    want = {}
    for v in range(30):
        for i in range(9):
            for j in range(7):
                for code, (sx, sy) in enumerate([(1, 1), (1, -1), (-1, 1), (-1, -1)]):
                    s = (sx * x[v, i] + sy * y[v, j]) / np.sqrt(2)
                    if s >= 1.5:
                        want[v, (i * 7 + j) * 4 + code] = s
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in got)


def test_windows_across_batches(spark):
    """Rows of one direction meet though they come in several batches."""
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        vectors = cloud(120, 8, seed=3)
        rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
        got = sum(r[1] for r in result(spark.createDataFrame(rows, "vec_id long, embedding array<float>")))
        assert got >= 0.95 * sum(r[1] for r in brute(rows))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_vectors_of_one_component(spark):
    """They link by sign, and do not stop the query."""
    rows = [(1, [2.0]), (2, [0.5]), (3, [-1.0]), (4, [-3.0]), (5, [0.0]), (6, [2.0])]
    assert result(spark.createDataFrame(rows, "vec_id long, embedding array<float>")) == brute(rows)
