"""Quality classifier: naive Bayes support vectors.

Features are indicators of byte n-grams (hashed to a fixed number of columns) and of n-grams over
the sequence that says for each word whether it repeats the one before. Their counts in both classes, over all labelled rows for learning, give naive Bayes log-count ratios. Indicator
vectors scaled by the ratios and brought to length one are the input of a linear model with
squared hinge loss, fitted by dual coordinate descent; a logistic curve over margins turns the
margin into a score between 0 and 1.

Counts and scores cover all rows. The descent runs on a bounded sample of the labelled rows
(``Settings.sample``), the rows with the smallest keyed hash of ``doc_id``, of which a fifth is kept
for the logistic curve. The model is a vector of a fixed number of columns, whatever the corpus is.

Defined results: a null text is scored as an empty one; an empty text has no features and gets the
curve's value at margin 0; label rows that repeat count once, and a ``doc_id`` with different
labels or a null one is not learned from; with no labelled rows, or rows of one class only, the score is the
share of label 1 (0.5 without any); an empty table gives no rows. Only ``doc_id`` (to find labels)
and ``text`` are read; other columns stay as they are in :func:`score`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skylattice.llm.common import small


#: Columns behind the hashed ones: n-grams of "repeats the word before" of order 1 to 4, told apart
#: by a leading 1 bit, and eighths of words that do.
REPEATS = 32 + 16


@dataclass(frozen=True)
class Settings:
    bits: int = 16
    orders: tuple[int, ...] = (1, 2, 3)
    sample: int = 8_000
    smooth: float = 1.0
    cost: float = 1.0
    rounds: int = 20
    seed: int = 11

    @property
    def columns(self) -> int:
        return (1 << self.bits) + REPEATS


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    slope: float
    base: float


#: Odd multipliers that spread n-grams of each order over the columns.
SPREAD = {1: 0x9E3779B97F4A7C15, 2: 0xC2B2AE3D27D4EB4F, 3: 0x165667B19E3779F9, 4: 0xD6E8FEB86659FD93}
#: Columns in one message of counts.
CHUNK = 1024
OUT_ROWS = 2048


def repeats(data: bytes) -> list[int]:
    """Columns, from 0, of the word-repetition n-grams of a text."""
    words = data.lower().split()
    same = bytes(map(eq, words, words[1:]))
    if not any(same):
        return []
    found = {32 + sum(same) * 8 // len(same)}
    bits = np.frombuffer(same, dtype=np.uint8).astype(np.int64)
    for order in range(1, 5):
        gram = np.ones(max(len(bits) - order + 1, 0), dtype=np.int64)
        for k in range(order):
            gram = 2 * gram + bits[k : len(gram) + k]
        found.update(np.unique(gram).tolist())
    return list(found)


def grams(text: str, settings: Settings, seen: np.ndarray) -> np.ndarray:
    """The columns of a text's n-grams, ascending; ``seen`` is an all-false scratch array."""
    data = text.encode()
    codes = np.frombuffer(data, dtype=np.uint8).astype(np.uint64)
    for order in settings.orders:
        if len(codes) < order:
            continue
        n = len(codes) - order + 1
        gram = codes[:n].copy()
        for k in range(1, order):
            gram = (gram << np.uint64(8)) | codes[k : n + k]
        seen[(gram * np.uint64(SPREAD[order])) >> np.uint64(64 - settings.bits)] = True
    seen[[(1 << settings.bits) + i for i in repeats(data)]] = True
    found = np.flatnonzero(seen)
    seen[found] = False
    return found


def for_learning(doc_id: str | Column = "doc_id") -> Column:
    """Rows whose labels may be learned from: the others are held out."""
    key = F.coalesce(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id, F.lit(""))
    return F.pmod(F.crc32(key), F.lit(5)) != 0


def learning_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, text, label`` of the rows to learn from."""
    known = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id")
    known = known.agg(F.min("quality").alias("label"), F.max("quality").alias("most"))
    known = known.where((F.col("label") == F.col("most")) & F.col("label").isin(0, 1) & for_learning())
    return docs.select("doc_id", "text").join(small(known.select("doc_id", "label")), "doc_id")


def class_counts(rows: DataFrame, settings: Settings) -> np.ndarray:
    """Rows of each class that hold each n-gram: two rows of counts."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, settings.columns), dtype=np.int64)
        seen = np.zeros(settings.columns, dtype=bool)
        for whole in batches:
            for start in range(0, whole.num_rows, OUT_ROWS):
                texts, labels = (c.to_pylist() for c in whole.slice(start, OUT_ROWS).columns)
                for text, label in zip(texts, labels, strict=True):
                    counts[label, grams(text or "", settings, seen)] += 1
        parts = [counts[:, i : i + CHUNK] for i in range(0, counts.shape[1], CHUNK)]
        used = [i for i, p in enumerate(parts) if p.any()]
        yield pa.record_batch([pa.array(used, pa.int32()), pa.array([parts[i].tobytes() for i in used], pa.binary())], ["chunk", "counts"])

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, dtype=np.int64) for x in table["counts"].to_pylist())
        return pa.table({"chunk": table["chunk"].slice(0, 1), "counts": pa.array([total.tobytes()], pa.binary())})

    schema = "chunk int, counts binary"
    sums = rows.select("text", "label").mapInArrow(task, schema).groupBy("chunk").applyInArrow(add, schema)
    counts = np.zeros((2, settings.columns), dtype=np.int64)
    for chunk, part in sums.collect():  # a fixed number of columns
        part = np.frombuffer(part, dtype=np.int64).reshape(2, -1)
        counts[:, chunk * CHUNK : chunk * CHUNK + part.shape[1]] = part
    return counts


def ratios(counts: np.ndarray, smooth: float) -> np.ndarray:
    """Log-count ratios of label 1 against label 0."""
    share = counts + smooth
    share = share / share.sum(axis=1, keepdims=True)
    return np.log(share[1] / share[0])


def sampled(rows: DataFrame, total: int, settings: Settings) -> list[tuple[np.ndarray, int]]:
    """Columns and labels of at most ``sample`` rows, those with the smallest keyed hash."""
    key = F.xxhash64(F.lit(settings.seed), "doc_id")
    # A cut of the hash range that keeps somewhat more than the sample; the rest goes by order.
    share = min(1.0, 1.2 * settings.sample / max(total, 1))
    cut = int(-(2**63) + share * (2**64 - 1))
    near = rows.withColumn("key", key).where(F.col("key") <= F.lit(min(cut, 2**63 - 1)))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(settings.columns, dtype=bool)
        for batch in batches:
            found = [grams(t or "", settings, seen).astype("<u4").tobytes() for t in batch.column(0).to_pylist()]
            yield pa.record_batch([batch.column(1), batch.column(2), batch.column(3), pa.array(found, pa.binary())], ["label", "key", "doc_id", "found"])

    schema = "label int, key long, doc_id long, found binary"
    taken = near.select("text", F.col("label").cast("int"), "key", F.col("doc_id").cast("long"))
    taken = taken.mapInArrow(task, schema).orderBy("key", "doc_id").limit(settings.sample)
    return [(np.frombuffer(r["found"], "<u4").astype(np.int64), r["label"]) for r in taken.collect()]


def descend(rows: list[tuple[np.ndarray, np.ndarray, int]], size: int, settings: Settings) -> np.ndarray:
    """Weights of the squared-hinge linear model by dual coordinate descent.

    ``rows`` holds columns, values and label. The dual variable of one row is minimised at a time,
    rows in a new order each round, until no variable moves.
    """
    weights, order = np.zeros(size), np.random.default_rng(settings.seed)
    signs = np.array([1.0 if y else -1.0 for _, _, y in rows])
    heavy = np.array([max(np.sum(signs == -s), 1) for s in (-1.0, 1.0)]) / max(len(rows), 1) * 2
    costs = settings.cost * np.where(signs > 0, heavy[1], heavy[0])
    ridge = 1 / (2 * costs)
    square = np.array([x @ x for _, x, _ in rows]) + ridge
    dual = np.zeros(len(rows))
    for _ in range(settings.rounds):
        moved = 0.0
        for i in order.permutation(len(rows)):
            at, x, _ = rows[i]
            slope = signs[i] * (weights[at] @ x) - 1 + ridge[i] * dual[i]
            new = max(dual[i] - slope / square[i], 0.0)
            step = new - dual[i]
            if step:
                weights[at] += step * signs[i] * x
                dual[i] = new
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    return weights


def curve(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and base of the logistic curve of label 1 over margins, by Newton's method."""
    ones, n = labels.sum(), len(labels)
    goal = np.where(labels == 1, (ones + 1) / (ones + 2), 1 / (n - ones + 2))
    a, b = 1.0, float(np.log((ones + 1) / (n - ones + 1)))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -500, 500)))
        d, v = p - goal, np.maximum(p * (1 - p), 1e-9)
        grad = np.array([d @ margins, d.sum()])
        bend = np.array([[v @ margins**2 + 1e-6, v @ margins], [v @ margins, v.sum() + 1e-6]])
        step = np.linalg.solve(bend, grad)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return max(float(a), 1e-6), float(b)


def scaled(found: np.ndarray, ratio: np.ndarray) -> np.ndarray:
    """Values of a text's columns: their ratios, brought to length one."""
    x = ratio[found]
    length = np.sqrt(x @ x)
    return x / length if length > 0 else x


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> tuple[np.ndarray, Model]:
    """Ratios and model learned from the labelled rows of ``docs``."""
    rows = learning_rows(docs, labels)
    by_class = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    size, total = settings.columns, sum(by_class.values())
    if len(by_class) < 2:
        share = by_class.get(1, 0) / total if total else 0.5
        base = float(np.log((share + 1e-6) / (1 - share + 1e-6)))
        return np.zeros(size), Model(np.zeros(size), 1.0, base)
    ratio = ratios(class_counts(rows, settings), settings.smooth)
    data = [(at, scaled(at, ratio), y) for at, y in sampled(rows, total, settings)]
    learn = [r for i, r in enumerate(data) if i % 5]
    weights = descend(learn, size, settings)
    kept = data[::5]
    margins = np.array([weights[at] @ x for at, x, _ in kept])
    return ratio, Model(weights, *curve(margins, np.array([y for _, _, y in kept])))


def score(docs: DataFrame, ratio: np.ndarray, model: Model, settings: Settings = Settings()) -> DataFrame:
    """``docs`` with ``score``, higher where label 1 is likelier; an input column of that name goes."""
    fields = [f for f in docs.schema.fields if f.name != "score"]
    schema = T.StructType([*fields, T.StructField("score", T.DoubleType(), False)])
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((ratio, model))  # a fixed number of columns

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratio, model = shared.value
        seen = np.zeros(settings.columns, dtype=bool)
        for whole in batches:
            for start in range(0, whole.num_rows, OUT_ROWS):
                batch = whole.slice(start, OUT_ROWS)
                margins = np.zeros(batch.num_rows)
                for i, text in enumerate(batch.column(batch.schema.get_field_index("text")).to_pylist()):
                    found = grams(text or "", settings, seen)
                    margins[i] = model.weights[found] @ scaled(found, ratio)
                scores = 1 / (1 + np.exp(-np.clip(model.slope * margins + model.base, -500, 500)))
                kept = [batch.column(batch.schema.get_field_index(f.name)) for f in fields]
                yield pa.record_batch([*kept, pa.array(scores)], schema.names)

    return docs.mapInArrow(task, schema)


def keep_good(docs: DataFrame, labels: DataFrame, least: float = 0.3, settings: Settings = Settings()) -> DataFrame:
    """The rows of ``docs`` with a score of at least ``least``."""
    rows = docs.select("text", F.struct("*").alias("row"))
    scored = score(rows, *fit(docs, labels, settings), settings)
    return scored.where(F.col("score") >= least).select("row.*")
