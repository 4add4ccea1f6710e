import zlib

import numpy as np
import pytest
from texts import ODD, empty, odd

from skylattice.llm import toxicity as X
from skylattice.llm.queries import op11_toxicity, table

SF = "/root/testdata/sf0.1"
FAST = X.Settings(bits=14, members=2, epochs=20)


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_held_out_accuracy(spark):
    truth = {r.doc_id: r.toxic for r in table(spark, SF, "labels").collect()}
    rows = op11_toxicity(spark, SF).collect()
    assert len(rows) == table(spark, SF, "documents").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    held = [(r.score, r.predicted, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    scores, toxic = np.array([h[0] for h in held]), np.array([h[2] for h in held])
    # About one in twelve of these labels contradicts its text.
    assert (scores[toxic == 1][:, None] > scores[toxic == 0][None, :]).mean() > 0.93
    assert np.mean([p for _, p, y in held if y == 1]) > 0.75
    assert np.mean([p for _, p, y in held if y == 0]) < 0.03


def test_held_out_rows_and_label_0_do_not_matter(spark):
    """Only which learnable rows are confirmed, and the prior, go into the model."""
    sf = "/root/testdata/sf0.01"
    docs, known = table(spark, sf, "documents"), table(spark, sf, "labels")
    held = ~X.for_learning()
    turned = known.withColumn("toxic", X.F.when(held, 1 - known.toxic).otherwise(known.toxic))
    other = docs.withColumn("text", X.F.when(held, "scum idiot").otherwise(docs.text))
    settings = X.Settings(bits=14, members=2, epochs=5, prior=0.1)
    a = X.fit(docs, known, settings)
    b = X.fit(other.withColumn("lang", X.F.lit("x")), turned.where("toxic = 1").repartition(5), settings)
    assert np.array_equal(a.places, b.places)
    assert np.array_equal(a.weights, b.weights) and np.array_equal(a.base, b.base)


def test_odd_rows(spark):
    known = labels(spark, [(1, 1, 1), (1, 1, 1), (2, 0, 0), (3, None, None), (None, 1, 1), (6, 1, 1), (7, 0, 1), (7, 1, 0), (9, 0, 0), (99, 1, 1)])
    df = odd(spark)
    settings = X.Settings(bits=12, members=2, epochs=3, apart=0.1)
    scored = X.score(df, X.fit(df, known, settings), settings)
    rows = scored.collect()
    assert len(rows) == len(ODD) and scored.columns.count("score") == 1
    assert all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if not (r.text or "").strip()}) == 1
    assert X.score(empty(spark), X.fit(empty(spark), known, settings), settings).collect() == []


@pytest.mark.parametrize("rows,share", [([], 0.5), ([(2, 0, 0)], 1e-4)])
def test_without_a_toxic_row_the_score_is_the_prior(spark, rows, share):
    learnable = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 != 2]
    df = odd(spark)
    scores = X.score(df, X.fit(df, labels(spark, rows), FAST), FAST).collect()
    assert all(r.score == pytest.approx(share if learnable else 0.5) for r in scores)


def test_words_and_runs_count_once():
    a, b = X.hashed("You SCUM, scum!", 18, 5), X.hashed("scum you scum", 18, 5)
    assert len(np.unique(a)) == len(a)
    assert {c for c in a if c >= 1 << 18} == {c for c in b if c >= 1 << 18} and len(a[a >= 1 << 18]) == 2
    assert len(X.hashed(None, 18, 5)) == len(X.hashed("", 18, 5)) == 0
    # " scum" and "scum " stand in every text with the word.
    assert len(set(X.hashed("scum", 18, 5)) & set(X.hashed("that scum here", 18, 5))) == 3


def test_counts_are_rows_that_hold_a_feature(spark):
    rows = spark.createDataFrame([("ab ab", 1), ("ab", 1), ("b", 0), (None, 0)], "text string, toxic int").repartition(3)
    counts, n = X.word_counts(rows, FAST)
    word = (1 << FAST.bits) | (zlib.crc32(b"ab") & ((1 << FAST.bits) - 1))
    assert n.tolist() == [2, 2] and counts[:, word].tolist() == [0, 2]


def _risk(x, y, w, b, prior):
    g = x @ w + b
    low, high = np.logaddexp(0, -g[y == 1]).mean(), np.logaddexp(0, g[y == 1]).mean()
    return prior * low + max(0.0, np.logaddexp(0, g[y == 0]).mean() - prior * high)


def test_descent_lowers_the_corrected_risk():
    draw = np.random.default_rng(2)
    truth = draw.random(4000) < 0.2
    x = (draw.random((4000, 6)) < np.where(truth[:, None], [0.7, 0.6, 0.5, 0.5, 0.5, 0.2], [0.1, 0.1, 0.2, 0.5, 0.5, 0.6])).astype(np.uint8)
    shown = truth & (draw.random(4000) < 0.5)
    rows = np.concatenate([x[shown], x])
    y = np.concatenate([np.ones(shown.sum(), int), np.zeros(len(x), int)])
    w, b = X.descend(rows, y, 0.2, X.Settings(epochs=150, batches=4), 1)
    assert _risk(rows, y, w, b, 0.2) < 0.6 * _risk(rows, y, np.zeros(6), np.log(0.25), 0.2)
    # Probabilities near the truth, though half of the toxic rows stood unlabelled.
    p = 1 / (1 + np.exp(-(x @ w + b)))
    assert abs(p.mean() - 0.2) < 0.03
    assert np.mean((p > 0.5) == truth) > 0.9


def test_curve_brings_the_mean_to_the_prior():
    draw = np.random.default_rng(3)
    toxic = draw.random(5000) < 0.1
    margins = np.where(toxic, draw.normal(0.6, 0.5, 5000), draw.normal(-0.6, 0.5, 5000))
    both = np.concatenate([margins[toxic], margins])
    a, b = X.curve(both, np.concatenate([np.ones(toxic.sum(), int), np.zeros(5000, int)]), 0.1)
    p = 1 / (1 + np.exp(-(a * margins + b)))
    assert a > 1 and abs(p.mean() - 0.1) < 0.01
