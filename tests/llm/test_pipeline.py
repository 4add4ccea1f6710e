import hashlib
from collections import Counter

import numpy as np
import pytest
import test_curriculum
import test_exact_dedup
import test_ngram_join
from conftest import SF
from texts import empty, odd
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline as pipeline
from skylattice.llm import quality
from skylattice.llm.common import stage
from skylattice.llm.queries import table, vocabulary


@pytest.fixture(scope="module")
def steps(spark):
    """The rows before the first and after each stage."""
    docs = table(spark, SF, "documents")
    found = [docs.collect()]
    for name, function in pipeline.STAGES:
        docs = stage(function(spark, docs, SF), name)
        found.append(docs.collect())
    return found


def test_all_stages_but_the_last_keep_the_columns(spark, steps):
    columns = table(spark, SF, "documents").columns
    assert all(rows[0].__fields__ == columns for rows in steps[:-1])


def test_quality_stage_keeps_what_scores_well(spark, steps):
    docs = table(spark, SF, "documents")
    ratio, model = quality.fit(docs, table(spark, SF, "labels"))
    settings = quality.Settings()
    seen, kept = np.zeros(settings.columns, dtype=bool), []
    for r in steps[0]:
        found = quality.grams(r.text or "", settings, seen)
        margin = model.weights[found] @ quality.scaled(found, ratio)
        if 1 / (1 + np.exp(-(model.slope * margin + model.base))) >= 0.3:
            kept.append(r.doc_id)
    assert sorted(r.doc_id for r in steps[1]) == sorted(kept)
    good = {r.doc_id for r in table(spark, SF, "labels").collect() if r.quality == 1}
    assert len(good & set(kept)) >= 0.97 * len(good & {r.doc_id for r in steps[0]})


def test_exact_stage(steps):
    rows = [(r.doc_id, r.text) for r in steps[1]]
    assert sorted(r.doc_id for r in steps[2]) == sorted(i for i, _, _, stays, _ in test_exact_dedup.expected(rows) if stays)


def test_near_stage(steps):
    rows = [(r.doc_id, r.text) for r in steps[2]]
    assert sorted(r.doc_id for r in steps[3]) == sorted({c for _, _, c in test_ngram_join.expected(rows, 5, 80)})


def test_mix_stage(spark, steps):
    before = {r.doc_id: r for r in steps[3]}
    taken = Counter(r.doc_id for r in steps[4])
    assert set(taken) <= set(before) and max(taken.values()) <= 2
    words, largest = Counter(), Counter()
    for r in before.values():
        words[r.source] += test_curriculum.size(r.text)
        largest[r.source] = max(largest[r.source], test_curriculum.size(r.text))
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sorted(words, key=str.encode))}
    target = test_curriculum.water(words, weights)
    given = Counter()
    for i, n in taken.items():
        given[before[i].source] += n * test_curriculum.size(before[i].text)
    assert all(abs(given[s] - target[s]) <= largest[s] for s in words)


def test_token_stage(steps):
    library = Tokenizer.from_file(vocabulary())
    texts = {r.doc_id: r.text or "" for r in steps[4]}
    assert Counter(r.doc_id for r in steps[5]) == Counter(r.doc_id for r in steps[4])
    for r in steps[5]:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        assert (r.ids, r.n_tokens) == (ids, len(ids))
        assert r.decoded_sha256 == hashlib.sha256(back.encode()).hexdigest()


def test_run_gives_what_the_stages_give(spark, steps):
    assert pipeline.ORACLE_SQL is None
    rows = contract.queries()["pipeline"](spark, SF).collect()
    assert Counter((r.doc_id, r.ids_sha256) for r in rows) == Counter((r.doc_id, r.ids_sha256) for r in steps[-1])


@pytest.mark.parametrize("make", [odd, empty])
def test_odd_rows_pass_through_every_stage(spark, make):
    docs = make(spark)
    for name, function in pipeline.STAGES:
        columns = docs.columns
        docs = stage(function(spark, docs, SF), name)
        assert name == "bpe" or docs.columns == columns
    rows = docs.collect()
    if make is empty:
        assert rows == []
    else:
        assert {r.doc_id for r in rows} <= {1, 2, 3, 4, 5, 6, 7, None, 8, 9}
