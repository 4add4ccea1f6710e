"""The registered queries of the text operators against their DuckDB form, and their contract."""

import pytest
from conftest import SF

import __spark_entry__ as contract
from check import compare, connect
from skylattice.llm.oracle import ORACLES
from skylattice.llm.queries import QUERIES


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", ORACLES)
def test_query_matches_its_oracle(spark, duck, name):
    assert compare(spark, duck, SF, name) == ""


def test_every_operator_is_registered():
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(contract.queries())
    assert set(ORACLES) <= set(contract.oracle_sql())


COLUMNS = {
    "op1_surrogates": "doc_id bigint, text string, n_entities bigint",
    "op4_ngram_join": "doc_id bigint, n_shingles bigint, component_id bigint",
    "op6_quality": "doc_id bigint, held_out boolean, score double, predicted int",
    "op9_projections": "vec_id bigint, n_links bigint, component_id bigint, kept boolean",
    "op10_shards": "doc_id bigint, size bigint, text_crc32 bigint, law string, shard int, slot bigint, grown_shard int",
    "op11_toxicity": "doc_id bigint, held_out boolean, score double, predicted int",
    "op12_nra_search": "item_id bigint, rank int, doc_id bigint, score bigint",
    "op13_anchor_codes": "vec_id bigint, code string, error bigint, label_error bigint, codebooks_sha256 string",
}


@pytest.mark.parametrize("name", COLUMNS)
def test_columns(spark, name):
    found = QUERIES[name](spark, SF)
    assert ", ".join(f"{c} {t}" for c, t in found.dtypes) == COLUMNS[name]
