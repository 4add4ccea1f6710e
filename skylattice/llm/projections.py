"""Near duplicates of embeddings by collision-counting projections.

Unit vectors are projected on many random directions, and each projection is sorted. A window is
laid around each value; two vectors collide in a projection when one lies in the other's window.
Pairs that collide often enough are verified by their cosine. So that windows stay thin however
many vectors there are, only the ends of a projection are used: values above a level that a
fixed number of vectors is expected to reach. Directions are the sums of two base directions, one
of each of two sets, so millions of them cost a few thousand products a vector.

The number of directions and the collisions that a pair must have are calibrated: pairs of vectors
with just the cosine that links are drawn and projected, and the count is the largest that
``Settings.recall`` of them reach. Closer pairs reach it more often. Each end of a projection carries a
sketch of its vector, the signs of products with ``Settings.signs`` further directions. Vectors that only share a
crowded region collide often and differ in many signs; a collision counts if they differ in no more than six
standard deviations above what a pair that just links does, so that only near pairs are written.

Equal vectors form a class and are projected once. Defined results: vectors that are null, empty,
zero, or hold null or non-finite components link with nothing, as do rows without ``vec_id``;
vectors of different lengths never link; vectors of one component link by sign; rows that repeat are vectors of their own. Other columns
are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skylattice.llm.common import components, stage


@dataclass(frozen=True)
class Settings:
    cosine: float = 0.95
    recall: float = 0.98
    #: Vectors expected above the level of a projection, and collisions expected of a linked pair.
    above: int = 8
    collisions: float = 9.0
    #: Half a window, in standard deviations of the difference of a pair that just links.
    window: float = 1.5
    pairs: int = 600
    #: Directions of the sketch, a multiple of 64.
    signs: int = 256
    seed: int = 23


@dataclass(frozen=True)
class Plan:
    """Base directions of both sets, the level and half window of values, and the least count."""

    first: np.ndarray
    second: np.ndarray
    level: float
    window: float
    least: int
    signs: np.ndarray
    differ: int


#: Pairs in one batch of results.
OUT_PAIRS = 200_000


def ends(x: np.ndarray, y: np.ndarray, level: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Vector, direction and value wherever a sum of base projections reaches the level.

    ``x`` and ``y`` hold a vector's products with the two sets in a row. Only base directions that
    can reach the level with the best partner are paired.
    """
    high = level * math.sqrt(2)
    none = np.zeros(0, dtype=np.int64)
    at, direction, value = [none], [none], [none.astype(np.float64)]
    for sx in (1, -1):
        for sy in (1, -1):
            best = (sy * y).max(axis=1)
            v, i = np.nonzero(sx * x >= (high - best)[:, None])
            for k in range(0, len(v), 100_000):
                vk, ik = v[k : k + 100_000], i[k : k + 100_000]
                sums = (sx * x[vk, ik])[:, None] + sy * y[vk]
                r, j = np.nonzero(sums >= high)
                at.append(vk[r])
                sign = (sx < 0) * 2 + (sy < 0)
                direction.append((ik[r].astype(np.int64) * y.shape[1] + j) * 4 + sign)
                value.append(sums[r, j] / math.sqrt(2))
    return np.concatenate(at), np.concatenate(direction), np.concatenate(value)


def differing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many of 64 signs differ."""
    return np.bitwise_count((a ^ b).view(np.uint64)).astype(np.int64)  # of signed numbers it would count other bits


def calibrate(n: int, size: int, settings: Settings) -> Plan:
    """Directions, level and count for ``n`` vectors of ``size`` components.

    What a linked pair's collisions depend on is its cosine alone, wherever other vectors lie.
    """
    apart = math.sqrt(2 - 2 * settings.cosine)  # of a pair that just links, in projections
    share = settings.above / max(n, 2048)
    level = -NormalDist().inv_cdf(share)
    draw = np.random.default_rng(settings.seed)
    u = draw.standard_normal((settings.pairs, size))
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    w = draw.standard_normal((settings.pairs, size))
    w -= (w * u).sum(axis=1, keepdims=True) * u
    w /= np.linalg.norm(w, axis=1, keepdims=True)
    v = settings.cosine * u + math.sqrt(1 - settings.cosine**2) * w
    bases = max(4, math.ceil(math.sqrt(settings.collisions / (0.5 * share) / 4)))
    signs = np.random.default_rng([settings.seed, size, 1]).standard_normal((settings.signs, size))
    odds = math.acos(settings.cosine) / math.pi
    differ = math.ceil(settings.signs * odds + 6 * math.sqrt(settings.signs * odds * (1 - odds)))
    for _ in range(50):
        base = np.random.default_rng([settings.seed, size])
        first, second = (base.standard_normal((bases, size)) for _ in range(2))
        counts = np.zeros(settings.pairs, dtype=np.int64)
        a = ends(u @ first.T, u @ second.T, level)
        b = ends(v @ first.T, v @ second.T, level)
        keys = [p * (4 * bases * bases) + d for p, d, _ in (a, b)]
        both, ia, ib = np.intersect1d(keys[0], keys[1], return_indices=True)
        met = np.abs(a[2][ia] - b[2][ib]) <= settings.window * apart
        np.add.at(counts, both[met] // (4 * bases * bases), 1)
        least = int(np.sort(counts)[math.floor((1 - settings.recall) * settings.pairs)])
        if least >= 2:
            return Plan(first, second, level, settings.window * apart, least, signs, differ)
        bases = math.ceil(bases * 1.2)
    raise RuntimeError(f"no number of directions reaches a recall of {settings.recall} for {n} vectors of {size} components")


def sketch(u: np.ndarray, signs: np.ndarray) -> np.ndarray:
    """The signs of a vector's products, 64 in a number."""
    return np.packbits(u @ signs.T > 0, axis=1).view(np.int64)


def classes(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``vec_id`` with its class key, and the classes with their smallest id, size and unit vector."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    some = F.exists("embedding", lambda x: x != 0)
    good = F.coalesce(F.col("vec_id").isNotNull() & finite & some, F.lit(False))
    # -0.0 and 0.0 are one value.
    plain = F.transform(F.col("embedding").cast("array<double>"), lambda x: x + F.lit(0.0))
    rows = vectors.select(F.col("vec_id").cast("long"), F.when(good, plain).alias("vector"))
    keys = [F.xxhash64("vector").alias("k1"), F.xxhash64(F.lit(5), F.size("vector"), "vector").alias("k2")]
    rows = rows.select("vec_id", "vector", *keys)
    found = rows.where(F.col("vector").isNotNull()).groupBy("k1", "k2")
    found = found.agg(F.min("vec_id").alias("class"), F.count("*").alias("size"), F.first("vector").alias("vector"))
    return rows.withColumn("vector", F.col("vector").isNotNull()), found


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def _unit(m: np.ndarray) -> np.ndarray:
    m = m / np.abs(m).max(axis=1, keepdims=True)
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def collisions(found: DataFrame, plan: Plan) -> DataFrame:
    """``(a, b)`` once for every projection in which two classes collide."""
    size = plan.first.shape[1]
    shared = found.sparkSession.sparkContext.broadcast(plan)  # two sets of base directions

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = shared.value
        for whole in batches:
            for start in range(0, whole.num_rows, 1024):
                batch = whole.slice(start, 1024)
                u = _unit(_matrix(batch.column(1), size))
                at, direction, value = ends(u @ plan.first.T, u @ plan.second.T, plan.level)
                names = batch.column(0).to_numpy()[at]
                marks = sketch(u, plan.signs)[at]
                columns = [direction, value, names, *marks.T]
                yield pa.record_batch([pa.array(np.ascontiguousarray(c)) for c in columns], schema_names)

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width, size = plan_window, 0
        out: list[tuple[np.ndarray, np.ndarray]] = []
        carried = None

        def flush() -> pa.RecordBatch:
            pairs = [np.concatenate(x) for x in zip(*out, strict=True)]
            return pa.record_batch([pa.array(np.minimum(*pairs)), pa.array(np.maximum(*pairs))], ["a", "b"])

        for batch in batches:
            columns = [c.to_numpy() for c in batch.columns]
            old = 0
            if carried is not None:
                old = len(carried[0])
                columns = [np.concatenate(x) for x in zip(carried, columns, strict=True)]
            direction, value, name, *marks = columns
            for step in range(1, len(value)):
                near = (direction[step:] == direction[:-step]) & (value[step:] - value[:-step] <= width)
                if not near.any():
                    break
                near[: max(0, old - step)] = False  # both were here before
                i = np.flatnonzero(near)
                apart = sum(differing(m[i], m[i + step]) for m in marks)
                i = i[apart <= differ]
                for k in range(0, len(i), OUT_PAIRS):
                    part = i[k : k + OUT_PAIRS]
                    out.append((name[part], name[part + step]))
                    size += len(part)
                    if size >= OUT_PAIRS:
                        yield flush()
                        out, size = [], 0
            if len(value):
                last = (direction == direction[-1]) & (value >= value[-1] - width)
                carried = [c[last] for c in columns]
        if out:
            yield flush()

    plan_window, differ = plan.window, plan.differ
    marks = [f"mark{k}" for k in range(len(plan.signs) // 64)]
    schema_names = ["direction", "value", "class", *marks]
    schema = "direction long, value double, class long" + "".join(f", {m} long" for m in marks)
    rows = found.select("class", "vector").mapInArrow(project, schema)
    tasks = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Windows of one direction must meet: rows go by direction, and in it by value.
    ordered = rows.repartition(tasks, "direction").sortWithinPartitions("direction", "value")
    return ordered.mapInArrow(windows, "a long, b long")


def verified(pairs: DataFrame, found: DataFrame, cosine: float) -> DataFrame:
    """The pairs of classes whose vectors, in double precision, reach the cosine."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b = (_matrix(batch.column(k), len(batch.column(k)[0])) for k in (2, 3))
                dots = np.einsum("ij,ij->i", a, b)
                norms = np.sqrt(np.einsum("ij,ij->i", a, a)) * np.sqrt(np.einsum("ij,ij->i", b, b))
                fine = norms > 0
                with np.errstate(all="ignore"):
                    value = dots / norms
                odd = ~fine | ~np.isfinite(value)  # squares out of range
                value[odd] = np.einsum("ij,ij->i", _unit(a[odd]), _unit(b[odd])) if odd.any() else 0
                keep = pa.array(value >= cosine)
                yield pa.record_batch([batch.column(0), batch.column(1)], ["a", "b"]).filter(keep)

    vector = found.select("class", "vector")
    sides = pairs.join(vector.withColumnsRenamed({"class": "a", "vector": "va"}), "a")
    sides = sides.join(vector.withColumnsRenamed({"class": "b", "vector": "vb"}), "b")
    return sides.select("a", "b", "va", "vb").mapInArrow(task, "a long, b long")


def _of_one_sign(found: DataFrame) -> DataFrame:
    """``class, rows, root`` of the classes of one component: all of a sign link, as the cosine is 1 or -1."""
    rows = found.where(F.size("vector") == 1).select("class", "size", (F.col("vector")[0] > 0).alias("sign"))
    signs = rows.groupBy("sign").agg(F.sum("size").alias("rows"), F.min("class").alias("root"))
    return rows.select("class", "sign").join(F.broadcast(signs), "sign").drop("sign")  # two rows


def links(found: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``(a, b)``: classes of several components that link, each pair once. ``found`` is staged."""
    spaces = [r[0] for r in found.select(F.size("vector")).distinct().collect()]
    pairs = found.sparkSession.createDataFrame([], "a long, b long")
    for size in sorted(spaces):  # one vector length as a rule
        if size == 1:  # not by pairs, see _of_one_sign
            continue
        own = found.where(F.size("vector") == size)
        plan = calibrate(own.count(), size, settings)
        counted = collisions(own, plan).groupBy("a", "b").agg(F.count("*").alias("n"))
        pairs = pairs.unionByName(verified(counted.where(F.col("n") >= plan.least).select("a", "b"), own, settings.cosine))
    return stage(pairs, "links")


def near_duplicates(vectors: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``vec_id, n_links, component_id, kept``, one row for each row of ``vectors``."""
    rows, found = classes(vectors)
    found = stage(found, "vectors")
    edges = links(found, settings)
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    sizes = found.select(F.col("class").alias("b"), "size")
    others = both.join(sizes, "b").groupBy(F.col("a").alias("class")).agg(F.sum("size").alias("others"))
    roots = components(edges).withColumnsRenamed({"node": "class"})
    one = _of_one_sign(found).withColumnRenamed("root", "of_sign")
    named = found.select("k1", "k2", "class", "size").join(others, "class", "left").join(roots, "class", "left")
    named = named.join(one, "class", "left").select(
        "k1",
        "k2",
        (F.coalesce("rows", F.col("size") + F.coalesce("others", F.lit(0))) - 1).alias("n_links"),
        F.coalesce("of_sign", "root", "class").alias("component_id"),
    )
    good = F.col("vector")
    out = rows.join(named, ["k1", "k2"], "left").select(
        "vec_id",
        F.when(good, F.col("n_links")).otherwise(0).cast("long").alias("n_links"),
        F.when(good, F.col("component_id")).otherwise(F.col("vec_id")).alias("component_id"),
    )
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
