"""Codes of vectors by parts, with codebooks learned over metric trees (anchors hierarchy).

Components become whole numbers, and a vector is cut into equal consecutive parts. Each part
position has a codebook, which starts as that part of the vectors of smallest ``vec_id``; each round gives
every part to its nearest entry (ties to the lower one) and moves the entries to the means of their parts.

The vectors are dealt over blocks, and for every block and part position a metric tree is built once and stored.
Trees grow middle-out: anchors are drawn one after the other, each the point farthest from its anchor, and
take over the points that are nearer to them; anchors are then joined in pairs, the smallest balls first,
up to the root, and the points of each anchor make a tree of their own below. A ball holds its middle and radius, and the number
and sum of its points. A round walks down every tree with a list of entries that may own a point of the
ball; a child inherits its parent's list and strikes those that some other entry beats everywhere in its ball. A
ball whose list has one entry left adds its sum and number at once; only the points of the smallest balls are compared
with the entries left, one by one. All decisions are exact: bounds carry a margin for rounding, and distances are whole.

Defined results: a vector that is null or holds null or non-finite components is left out; a row without
``vec_id`` gets a code and starts no codebook unless there are too few others; equal ``vec_id`` are told
apart by their components; fewer vectors than entries make a smaller codebook. Vectors of each length
have codebooks of their own, and where the length is no multiple of the parts, parts differ by one component. Components so large that
squared distances leave 64 bits are an error, named as such. An empty table gives no rows.
Only ``vec_id``, ``embedding`` and ``label`` are read.
"""

from __future__ import annotations

import hashlib
import io
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from skylattice.llm.common import small, stage


@dataclass(frozen=True)
class Settings:
    parts: int = 16
    entries: int = 64
    rounds: int = 2
    scale: int = 256
    #: Vectors of a block, and points below which a ball is not divided further.
    block: int = 8_192
    leaf: int = 24


#: Room for rounding in comparisons of doubles, as a share of their size.
MARGIN = 1e-9


def cuts(length: int, parts: int) -> list[slice]:
    return [slice(k * length // parts, (k + 1) * length // parts) for k in range(parts)]


# Trees: arrays with a row for each ball, parents before their children.

TREE = ("parent", "depth", "begin", "end", "leaf", "middle", "radius", "total", "order")


def _anchors(points: np.ndarray, k: int) -> list[np.ndarray]:
    """Places of the points of at most ``k`` anchors."""
    owner = np.zeros(len(points), dtype=np.int64)
    near = ((points - points[0]) ** 2).sum(axis=1)
    for anchor in range(1, k):
        far = int(near.argmax())  # it lies in the anchor of the largest radius
        if not near[far]:
            break
        apart = ((points - points[far]) ** 2).sum(axis=1)
        taken = apart < near
        owner[taken] = anchor
        near[taken] = apart[taken]
    return [m for m in (np.flatnonzero(owner == a) for a in range(owner.max() + 1)) if len(m)]


class _Ball:
    """A ball while its tree grows: the places of its points, and the two balls it was joined of."""

    __slots__ = ("places", "middle", "radius", "total", "below")

    def __init__(self, points: np.ndarray, places: np.ndarray, below: tuple[_Ball, ...] = ()):
        own = points[places]
        self.places, self.below = places, below
        self.total = own.sum(axis=0)
        self.middle = self.total / len(places)
        self.radius = float(np.sqrt(((own - self.middle) ** 2).sum(axis=1).max()))


def _joined(points: np.ndarray, balls: list[_Ball]) -> _Ball:
    """The root of balls that are joined in pairs, those first whose ball is the smallest."""
    n = len(balls)
    alive: list[_Ball | None] = list(balls)
    middles, radii = np.array([b.middle for b in balls]), np.array([b.radius for b in balls])
    wide = np.sqrt(((middles[:, None] - middles[None]) ** 2).sum(axis=2)) + radii[:, None] + radii[None]
    wide[np.tril_indices(n)] = np.inf
    for _ in range(n - 1):
        i, j = divmod(int(wide.argmin()), n)
        new = _Ball(points, np.concatenate([alive[i].places, alive[j].places]), (alive[i], alive[j]))
        alive[i], alive[j] = new, None
        middles[i], radii[i] = new.middle, new.radius
        wide[j], wide[:, j] = np.inf, np.inf
        still = np.array([b is not None for b in alive])
        reach = np.sqrt(((middles - new.middle) ** 2).sum(axis=1)) + radii + new.radius
        wide[i, i + 1 :] = np.where(still[i + 1 :], reach[i + 1 :], np.inf)
        wide[:i, i] = np.where(still[:i], reach[:i], np.inf)
    return next(b for b in alive if b is not None)


def _grown(points: np.ndarray, places: np.ndarray, leaf: int) -> _Ball:
    """The tree of some points: anchors, a tree below each, and the joins above them."""
    if len(places) <= leaf:
        return _Ball(points, places)
    groups = _anchors(points[places], int(np.ceil(np.sqrt(len(places)))))
    if len(groups) == 1:  # copies of one point
        return _Ball(points, places)
    return _joined(points, [_grown(points, places[g], leaf) for g in groups])


def tree(points: np.ndarray, leaf: int) -> dict[str, np.ndarray]:
    """The tree of all points, balls with ranges of one order of the points."""
    rows: dict[str, list] = {name: [] for name in TREE[:-1]}
    order: list[np.ndarray] = []
    begin = 0
    stack = [(_grown(points, np.arange(len(points)), leaf), -1, 0)]
    while stack:
        ball, parent, depth = stack.pop()
        here = len(rows["parent"])
        values = (parent, depth, begin, begin + len(ball.places), not ball.below, ball.middle, ball.radius, ball.total)
        for name, value in zip(TREE, values, strict=False):
            rows[name].append(value)
        if ball.below:
            stack += [(b, here, depth + 1) for b in reversed(ball.below)]
        else:  # balls are left in the order of their points
            order.append(ball.places)
            begin += len(ball.places)
    return {name: np.array(column) for name, column in rows.items()} | {"order": np.concatenate(order)}


def owned(balls: dict[str, np.ndarray], points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Who owns what: balls and their entry, single points and their entry. Together they hold every point once."""
    far = _square(balls["middle"], entries.astype(np.float64))
    gaps = np.sqrt(_square(entries.astype(np.float64), entries.astype(np.float64)))
    lists = np.zeros(far.shape, dtype=bool)
    lists[:, np.unique(entries, axis=0, return_index=True)[1]] = True  # of equal entries the lowest
    entry = np.full(len(far), -1)
    loose: list[np.ndarray] = []
    depth = balls["depth"]
    for level in range(int(depth.max()) + 1):
        here = np.flatnonzero(depth == level)
        if level:
            parent = balls["parent"][here]
            open_ = entry[parent] == -1
            entry[here[~open_]] = -2  # lies in a ball that is owned
            here = here[open_]
            if not len(here):
                continue
            lists[here] = lists[balls["parent"][here]]
        apart = np.where(lists[here], far[here], np.inf)
        best = apart.argmin(axis=1)
        least = apart[np.arange(len(here)), best]
        beaten = apart - least[:, None] > (2 * balls["radius"][here, None] * gaps[best]) * (1 + MARGIN) + MARGIN * (apart + 1)
        lists[here] &= ~beaten
        alone = lists[here].sum(axis=1) == 1
        entry[here[alone]] = lists[here[alone]].argmax(axis=1)
        loose.append(here[~alone & balls["leaf"][here]])
    found = np.flatnonzero(entry >= 0)
    ball = np.concatenate(loose)
    sizes = balls["end"][ball] - balls["begin"][ball]
    place = np.repeat(balls["begin"][ball] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
    place = balls["order"][place]
    # Each point with the entries left to its ball, nearest first and then lowest.
    who, which = np.nonzero(lists[np.repeat(ball, sizes)])
    apart = ((points[place[who]] - entries[which]) ** 2).sum(axis=1)
    order = np.lexsort((which, apart, who))
    first = order[np.searchsorted(who, np.arange(len(place)))]
    return found, entry[found], place, which[first]


def _square(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return ((a[:, None, :] - b[None, :, :]) ** 2).sum(axis=2)


def _packed(arrays: dict[str, np.ndarray]) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def _unpacked(data: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(data), allow_pickle=False) as found:
        return {name: found[name] for name in found.files}


# Blocks: a row holds the vectors of a block and their trees.


def whole_vectors(vectors: DataFrame, settings: Settings) -> DataFrame:
    """``vec_id, label, ints`` of the vectors that are kept."""
    plain = F.col("embedding").cast("array<double>")
    fine = F.forall(plain, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = vectors.where(F.col("embedding").isNotNull() & fine)
    # Beyond 2^53 a component has no fraction, and the size check refuses it.
    limit = F.lit(2.0**53)
    ints = F.transform(plain, lambda x: F.floor(F.greatest(F.least(x * settings.scale, limit), -limit)).cast("long"))
    return rows.select(F.col("vec_id").cast("long"), "label", ints.alias("ints"))


def blocks(rows: DataFrame, length: int, settings: Settings) -> DataFrame:
    """The vectors of one length in blocks, with a tree for each part position."""
    schema = T.StructType(
        [T.StructField(c, T.ArrayType(rows.schema[c].dataType)) for c in ("vec_id", "label")]
        + [T.StructField("points", T.BinaryType()), T.StructField("trees", T.ArrayType(T.BinaryType()))]
    )
    arrow = to_arrow_schema(schema)

    def block(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(parts).combine_chunks()
        points = table["ints"].combine_chunks().flatten().to_numpy().reshape(table.num_rows, length)
        trees = [_packed(tree(np.ascontiguousarray(points[:, c]), settings.leaf)) for c in cuts(length, settings.parts)]
        columns = [[table["vec_id"].to_pylist()], [table["label"].to_pylist()], [points.astype("<i8").tobytes()], [trees]]
        return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, settings.block - n)
                batch = batch.slice(part.num_rows)
                held.append(part)
                n += part.num_rows
                if n == settings.block:
                    yield block(held)
                    held, n = [], 0
        if held:
            yield block(held)

    return rows.select("vec_id", "label", "ints").mapInArrow(task, schema)


def first_entries(rows: DataFrame, settings: Settings) -> np.ndarray:
    """The entries that all codebooks start with: whole vectors, cut later."""
    least = rows.orderBy(F.asc_nulls_last("vec_id"), "ints").select("ints").limit(settings.entries)
    return np.array([r["ints"] for r in least.collect()], dtype=np.int64)


def sums(held: DataFrame, entries: np.ndarray, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """For every entry the sum of its parts, by component, and their number, by part."""
    length, parts = entries.shape[1], cuts(entries.shape[1], settings.parts)
    shared = held.sparkSession.sparkContext.broadcast(entries)  # a codebook of fixed size

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = shared.value
        total, number = np.zeros(entries.shape, dtype=np.int64), np.zeros((len(entries), len(parts)), dtype=np.int64)
        for batch in batches:
            for points, trees in zip(batch.column(0), batch.column(1), strict=True):
                flat = np.frombuffer(points.as_py(), "<i8")
                for k, c in enumerate(parts):
                    balls = _unpacked(trees[k].as_py())
                    own = flat.reshape(len(balls["order"]), length)[:, c]
                    ball, by_ball, place, by_place = owned(balls, own, entries[:, c])
                    np.add.at(total[:, c], by_ball, balls["total"][ball])
                    np.add.at(number[:, k], by_ball, balls["end"][ball] - balls["begin"][ball])
                    np.add.at(total[:, c], by_place, own[place])
                    np.add.at(number[:, k], by_place, 1)
        yield pa.record_batch([pa.array([np.concatenate([total.ravel(), number.ravel()])], pa.list_(pa.int64()))], ["sums"])

    each = held.select("points", "trees").mapInArrow(task, "sums array<long>")
    added = each.select(F.posexplode("sums").alias("at", "n")).groupBy("at").agg(F.sum("n").alias("n"))
    out = np.zeros(entries.size + len(entries) * len(parts), dtype=np.int64)
    for r in added.collect():  # a codebook of fixed size
        out[r["at"]] = r["n"]
    return out[: entries.size].reshape(entries.shape), out[entries.size :].reshape(len(entries), -1)


def learned(held: DataFrame, entries: np.ndarray, settings: Settings) -> np.ndarray:
    """The codebooks after all rounds."""
    for _ in range(settings.rounds):
        total, number = sums(held, entries, settings)
        entries = entries.copy()
        for k, c in enumerate(cuts(entries.shape[1], settings.parts)):
            used = number[:, k] > 0
            entries[used, c] = total[used, c] // number[used, k][:, None]
    return entries


def digest(entries: np.ndarray, settings: Settings) -> str:
    """Hash of all components in decimal, by part, entry and place in the part."""
    whole = (entries[e, c].tolist() for c in cuts(entries.shape[1], settings.parts) for e in range(len(entries)))
    return hashlib.sha256(",".join(str(x) for part in whole for x in part).encode()).hexdigest()


def coded(held: DataFrame, entries: np.ndarray, settings: Settings) -> DataFrame:
    """``vec_id, label, code, error`` by the final codebooks."""
    label = held.schema["label"].dataType.elementType
    schema = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("label", label), T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    names, length, parts = schema.names, entries.shape[1], cuts(entries.shape[1], settings.parts)
    shared = held.sparkSession.sparkContext.broadcast(entries)  # a codebook of fixed size

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = shared.value
        for batch in batches:
            for i in range(batch.num_rows):
                ids, labels = batch.column(0)[i].values, batch.column(1)[i].values
                whole = np.frombuffer(batch.column(2)[i].as_py(), "<i8").reshape(len(ids), length)
                codes = np.zeros((len(ids), len(parts)), dtype=np.uint8)
                error = np.zeros(len(ids), dtype=np.int64)
                for k, c in enumerate(parts):
                    balls, own = _unpacked(batch.column(3)[i][k].as_py()), whole[:, c]
                    ball, by_ball, place, by_place = owned(balls, own, entries[:, c])
                    codes[place, k] = by_place
                    for b, e in zip(ball, by_ball, strict=True):
                        codes[balls["order"][balls["begin"][b] : balls["end"][b]], k] = e
                    error += ((own - entries[codes[:, k], c]) ** 2).sum(axis=1)
                texts = pa.array([bytes(row).hex() for row in codes], pa.string())
                yield pa.record_batch([ids, labels, texts, pa.array(error)], names)

    return held.select("vec_id", "label", "points", "trees").mapInArrow(task, schema)


def compress(vectors: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256``, a row for each vector that is kept."""
    rows = stage(whole_vectors(vectors, settings), "vectors")
    largest = F.array_max(F.transform("ints", lambda x: F.abs(x)))
    lengths = rows.groupBy(F.size("ints").alias("length")).agg(F.max(largest).alias("largest")).collect()
    out = None
    for length, most in sorted((r["length"], r["largest"] or 0) for r in lengths):  # one length as a rule
        if length * (2 * most + 1) ** 2 >= 1 << 62:
            raise ValueError(f"components up to {most / settings.scale:g} give squared distances beyond 64 bits")
        own = rows.where(F.size("ints") == length)
        entries = first_entries(own, settings)
        held = stage(blocks(own, length, settings), "trees")
        entries = learned(held, entries, settings)
        part = coded(held, entries, settings).withColumn("codebooks_sha256", F.lit(digest(entries, settings)))
        out = part if out is None else out.unionByName(part)
    if out is None:
        empty = "string as code", "long as error", "string as codebooks_sha256"
        out = rows.select("vec_id", "label", *(F.lit(None).cast(x.split()[0]).alias(x.split()[2]) for x in empty))
    out = stage(out, "codes")
    by_label = small(out.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")))
    whole = out.join(by_label, F.col("label").eqNullSafe(F.col("of")), "left")
    return whole.select("vec_id", "code", "error", "label_error", "codebooks_sha256")
