"""Toxicity: non-negative positive-unlabelled learning.

The classifiers see confirmed toxic documents (label 1) and unlabelled text, which holds toxic
documents in a known share, the class prior. With ``g`` a margin, ``l`` the logistic loss and the prior
``p``, the risk of a margin is ``p * E1[l(g)] + max(0, EU[l(-g)] - p * E1[l(-g)])``: the loss of the clean
documents is that of all text less the toxic share of it, and as a share of text it cannot be
negative. Where the estimate of a batch falls below zero, the step goes against it instead, so that
the classifier does not learn the unlabelled documents by heart.

Features are indicators of words (letters and digits, A-Z lower-cased) and of runs of five bytes in
them, both hashed. How many toxic and how many unlabelled documents hold each is counted over all rows
for learning; those whose share differs most, in standard errors, are the model's columns. Each of
``Settings.members`` linear classifiers is trained by numpy in a task of its own on its own sample
of about ``positives`` toxic and ``unlabelled`` other rows at most, drawn by a keyed hash of
``doc_id``, a fifth of it kept aside to bring margins to probabilities; a score is the mean of these. Text of held-out rows takes no part, and label 0 is
not learned from: it only serves, with label 1, to give the prior unless that is set.

Defined results: a null text is scored as an empty one, which has no words; label rows that repeat
count once, and a ``doc_id`` with different labels is unlabelled; without a toxic row every score is
the prior (0.5 without labels); an empty table gives no rows. Only ``doc_id`` (to find labels) and ``text``
are read; other columns stay as they are in :func:`score`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skylattice.llm.common import small
from skylattice.llm.words import words


@dataclass(frozen=True)
class Settings:
    bits: int = 18
    #: Bytes in a run.
    order: int = 5
    columns: int = 512
    #: Standard errors by which shares differ at least.
    apart: float = 3.5
    members: int = 4
    positives: int = 4_000
    unlabelled: int = 16_000
    prior: float | None = None
    epochs: int = 150
    batches: int = 4
    rate: float = 0.05
    decay: float = 1e-4
    #: Confirmed rows of a sample from which on margins are brought to probabilities.
    enough: int = 200
    seed: int = 29

    @property
    def hashes(self) -> int:
        """Columns of runs and of words, before the telling ones are chosen."""
        return 2 << self.bits


@dataclass(frozen=True)
class Model:
    """Place in the weights by hashed word (-1: none), and weights and base of each member."""

    places: np.ndarray
    weights: np.ndarray
    base: np.ndarray


#: Odd multiplier that spreads runs over the columns.
SPREAD = np.uint64(0x9E3779B97F4A7C15)
#: Hashed words in one message of counts, and rows scored at a time.
CHUNK = 8_192
OUT_ROWS = 2_048


def hashed(text: str | None, bits: int, order: int) -> np.ndarray:
    """The columns of a text's words and of the ``order`` byte runs in them, ascending, each once.

    A run may take in the blank before or behind a word, so stems and endings count as well.
    """
    found = words(text)
    data = np.frombuffer(b" " + b" ".join(found) + b" ", dtype=np.uint8).astype(np.uint64)
    n = max(len(data) - order + 1, 0)
    gram = np.zeros(n, dtype=np.uint64)
    for k in range(order):
        gram = (gram << np.uint64(8)) | data[k : n + k]
    gram = ((gram * SPREAD) >> np.uint64(64 - bits)).astype(np.int64)
    found = set(found)
    whole = np.fromiter(map(crc32, found), np.int64, len(found)) & ((1 << bits) - 1)
    return np.unique(np.concatenate([gram, whole | (1 << bits)]))


def for_learning(doc_id: str | Column = "doc_id") -> Column:
    """Rows that may be learned from: the others are held out."""
    key = F.coalesce(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id, F.lit(""))
    return F.pmod(F.crc32(key), F.lit(4)) != 2


def known_labels(labels: DataFrame) -> DataFrame:
    """``doc_id, toxic`` of the learnable documents with one label."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy("doc_id")
    known = known.agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most"))
    agreed = (F.col("toxic") == F.col("most")) & F.col("toxic").isin(0, 1) & for_learning()
    return known.where(agreed).select("doc_id", F.col("toxic").cast("int").alias("toxic"))


def learning_rows(docs: DataFrame, known: DataFrame) -> DataFrame:
    """``doc_id, text, toxic`` of the rows to learn from: 1 confirmed, 0 unlabelled."""
    toxic = small(known.where("toxic = 1").select("doc_id", F.lit(1).alias("toxic")))
    rows = docs.select("doc_id", "text").where(for_learning())
    return rows.join(toxic, "doc_id", "left").withColumn("toxic", F.coalesce("toxic", F.lit(0)))


def word_counts(rows: DataFrame, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Rows that hold each hashed word, unlabelled and confirmed (two rows), and how many rows there are."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, n = np.zeros((2, settings.hashes), dtype=np.int64), np.zeros(2, dtype=np.int64)
        for batch in batches:
            for text, toxic in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                counts[toxic, hashed(text, settings.bits, settings.order)] += 1
                n[toxic] += 1
        parts = {i // CHUNK: counts[:, i : i + CHUNK] for i in range(0, settings.hashes, CHUNK)}
        found = [(k, p.tobytes()) for k, p in parts.items() if p.any()] + [(-1, n.tobytes())]
        yield pa.record_batch([pa.array([k for k, _ in found], pa.int32()), pa.array([p for _, p in found], pa.binary())], ["chunk", "counts"])

    def add(chunk: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, total = None, 0
        for batch in chunk:
            for name, part in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                total = total + np.frombuffer(part, dtype=np.int64)
        yield pa.record_batch([pa.array([name], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["chunk", "counts"])

    schema = "chunk int, counts binary"
    sums = rows.select("text", "toxic").mapInArrow(task, schema).groupBy("chunk").applyInArrow(add, schema)
    counts, n = np.zeros((2, settings.hashes), dtype=np.int64), np.zeros(2, dtype=np.int64)
    for chunk, part in sums.collect():  # a fixed number of columns
        part = np.frombuffer(part, dtype=np.int64)
        if chunk < 0:
            n += part
        else:
            part = part.reshape(2, -1)
            counts[:, chunk * CHUNK : chunk * CHUNK + part.shape[1]] = part
    return counts, n


def telling(counts: np.ndarray, n: np.ndarray, settings: Settings) -> np.ndarray:
    """Place of each hashed word among the columns, -1 for words that are none.

    Words go by the difference of their shares among confirmed and unlabelled rows, in standard errors.
    """
    share = counts / np.maximum(n, 1)[:, None]
    both = counts.sum(axis=0) / max(n.sum(), 1)
    error = np.sqrt(np.maximum(both * (1 - both), 1e-12) * (1 / np.maximum(n, 1)).sum())
    apart = np.abs(share[1] - share[0]) / error
    order = np.lexsort((np.arange(len(apart)), -apart))[: settings.columns]
    places = np.full(len(apart), -1, dtype=np.int64)
    order = order[apart[order] >= settings.apart]
    places[order] = np.arange(len(order))
    return places


def drawn(rows: DataFrame, n: np.ndarray, places: np.ndarray, settings: Settings) -> DataFrame:
    """``member, toxic, found``: the members' samples, with the columns that each text holds.

    The unlabelled sample stands for all text, so confirmed rows are in it by their share.
    """
    shared = rows.sparkSession.sparkContext.broadcast(places)  # a fixed number of columns

    def taken(member: int, toxic: int, bound: int, of: int) -> Column:
        share = min(1.0, bound / max(of, 1))
        cut = min(int(-(2**63) + share * (2**64 - 1)), 2**63 - 1)
        draw = F.xxhash64(F.lit(settings.seed), F.lit(member), F.lit(toxic), "doc_id", "text")
        chosen = draw <= F.lit(cut)
        return F.when(chosen & (F.col("toxic") == 1) if toxic else chosen, F.lit(2 * member + toxic))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = shared.value
        for whole in batches:
            for start in range(0, whole.num_rows, OUT_ROWS):
                batch = whole.slice(start, OUT_ROWS)
                found = (places[hashed(t, settings.bits, settings.order)] for t in batch.column(0).to_pylist())
                kept = pa.array([f[f >= 0].astype("<u4").tobytes() for f in found], pa.binary())
                yield pa.record_batch([batch.column(1), kept], ["places", "found"])

    places_ = [
        c
        for m in range(settings.members)
        for c in (taken(m, 1, settings.positives, int(n[1])), taken(m, 0, settings.unlabelled, int(n.sum())))
    ]
    wide = rows.select("text", F.array_compact(F.array(*places_)).alias("places")).where(F.size("places") > 0)
    sampled = wide.mapInArrow(task, "places array<int>, found binary").select(F.explode("places").alias("place"), "found")
    return sampled.select(F.expr("place div 2").cast("int").alias("member"), F.pmod("place", F.lit(2)).alias("toxic"), "found")


def descend(x: np.ndarray, toxic: np.ndarray, prior: float, settings: Settings, seed: int) -> tuple[np.ndarray, float]:
    """Weights and base of a linear classifier of least non-negative risk, by Adam.

    ``x`` holds 0 and 1. Every batch has its share of confirmed and of unlabelled rows.
    """
    size = x.shape[1]
    at, moment, square = np.zeros(size + 1), np.zeros(size + 1), np.zeros(size + 1)
    at[size] = np.log(prior / (1 - prior))
    order, steps = np.random.default_rng(seed), 0
    sides = [np.flatnonzero(toxic == t) for t in (0, 1)]
    batches = max(1, min(settings.batches, *(len(s) for s in sides)))

    def slope(rows: np.ndarray, sign: float) -> tuple[float, np.ndarray]:
        """Mean logistic loss of ``sign * margin`` and its slope."""
        part = x[rows].astype(np.float32)
        margin = np.clip(sign * (part @ at[:size].astype(np.float32) + at[size]), -60, 60)
        pull = -sign / (1 + np.exp(margin)) / len(rows)
        return float(np.logaddexp(0, -margin).mean()), np.append(pull.astype(np.float32) @ part, pull.sum())

    for _ in range(settings.epochs):
        deals = [np.array_split(order.permutation(s), batches) for s in sides]
        for unlabelled, confirmed in zip(*deals, strict=True):
            _, up = slope(confirmed, 1.0)
            low, down = slope(confirmed, -1.0)
            all_low, all_down = slope(unlabelled, -1.0)
            clean = all_low - prior * low
            way = prior * up + (all_down - prior * down) if clean >= 0 else prior * down - all_down
            way[:size] += settings.decay * at[:size]
            steps += 1
            moment = 0.9 * moment + 0.1 * way
            square = 0.999 * square + 0.001 * way * way
            at -= settings.rate * (moment / (1 - 0.9**steps)) / (np.sqrt(square / (1 - 0.999**steps)) + 1e-8)
    return at[:size], float(at[size])


def curve(margins: np.ndarray, toxic: np.ndarray, prior: float) -> tuple[float, float]:
    """Slope and base that bring margins of rows kept aside to probabilities.

    The same risk without the bound, which two parameters do not need: with the logistic loss it
    is convex, and at its minimum the mean probability of all text is the prior. By Newton's method.
    """
    rest, ones = margins[toxic == 0], margins[toxic == 1]
    if not len(rest) or not len(ones):
        return 1.0, 0.0
    a, b = 1.0, 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * rest + b, -500, 500)))
        v = np.maximum(p * (1 - p), 1e-9)
        grad = np.array([(p * rest).mean() - prior * ones.mean() + 1e-3 * (a - 1), p.mean() - prior])
        bend = np.array([[(v * rest**2).mean() + 1e-3, (v * rest).mean()], [(v * rest).mean(), v.mean() + 1e-6]])
        step = np.clip(np.linalg.solve(bend, grad), -1, 1)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return max(float(a), 1e-6), float(b)


def trained(samples: DataFrame, size: int, prior: float, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Weights and base of each member, each trained in a task of its own on its sample."""

    def train(group: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        member, toxic, found = None, [], []
        for batch in group:
            member = batch.column(0)[0].as_py() if batch.num_rows else member
            toxic += batch.column(1).to_pylist()
            found += batch.column(2).to_pylist()
        # In an order that no shuffle changes: the same rows give the same weights.
        order = sorted(range(len(found)), key=lambda i: (toxic[i], found[i]))
        x = np.zeros((len(found), size), dtype=np.uint8)
        for i, k in enumerate(order):
            x[i, np.frombuffer(found[k], "<u4")] = 1
        y = np.array([toxic[k] for k in order])
        if min(np.sum(y == 1), np.sum(y == 0)) == 0:
            weights, base = np.zeros(size), np.log(prior / (1 - prior))
        else:
            kept = np.random.default_rng(settings.seed + member).random(len(y)) < 0.2
            kept &= np.sum(y) >= settings.enough
            weights, base = descend(x[~kept], y[~kept], prior, settings, settings.seed + member)
            slope, shift = curve(x[kept] @ weights + base, y[kept], prior)
            weights, base = slope * weights, slope * base + shift
        yield pa.record_batch([pa.array([member], pa.int32()), pa.array([np.append(weights, base).tobytes()], pa.binary())], ["member", "weights"])

    found = samples.groupBy("member").applyInArrow(train, "member int, weights binary").orderBy("member").collect()
    both = np.array([np.frombuffer(r["weights"]) for r in found]).reshape(len(found), size + 1)
    return both[:, :size], both[:, size]


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """The members learned from the confirmed rows of ``docs`` and the text of the others."""
    known = known_labels(labels)
    rows = learning_rows(docs, known)
    named = docs.select("doc_id").join(small(known), "doc_id").groupBy("toxic").agg(F.count("*").alias("n"))
    by_label = {r["toxic"]: r["n"] for r in named.collect()}
    total = sum(by_label.values())
    prior = settings.prior if settings.prior is not None else by_label.get(1, 0) / total if total else 0.5
    prior = min(max(prior, 1e-4), 1 - 1e-4)
    none = Model(np.full(settings.hashes, -1), np.zeros((1, 1)), np.array([np.log(prior / (1 - prior))]))
    if not by_label.get(1):
        return none
    counts, n = word_counts(rows, settings)
    places = telling(counts, n, settings)
    size = int(places.max()) + 1
    if not size:
        return none
    return Model(places, *trained(drawn(rows, n, places, settings), size, prior, settings))


def score(docs: DataFrame, model: Model, settings: Settings = Settings()) -> DataFrame:
    """``docs`` with ``score``, higher where label 1 is likelier; an input column of that name goes."""
    fields = [f for f in docs.schema.fields if f.name != "score"]
    schema = T.StructType([*fields, T.StructField("score", T.DoubleType(), False)])
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a fixed number of columns

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for whole in batches:
            for start in range(0, whole.num_rows, OUT_ROWS):
                batch = whole.slice(start, OUT_ROWS)
                scores = np.zeros(batch.num_rows)
                for i, text in enumerate(batch.column(batch.schema.get_field_index("text")).to_pylist()):
                    found = model.places[hashed(text, settings.bits, settings.order)]
                    margins = model.weights[:, found[found >= 0]].sum(axis=1) + model.base
                    scores[i] = (1 / (1 + np.exp(-np.clip(margins, -500, 500)))).mean()
                kept = [batch.column(batch.schema.get_field_index(f.name)) for f in fields]
                yield pa.record_batch([*kept, pa.array(scores)], schema.names)

    return docs.mapInArrow(task, schema)
