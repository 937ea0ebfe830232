"""Every query of the folder, and the pipeline, on the smallest tables and on empty ones."""

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tests import oracle
from tidemill.llm.queries import ORACLES, QUERIES

TABLES = ("documents", "embeddings", "pages", "labels", "conversations", "benchmark")
#: The table that a query has a row for each row of.
ROWS = {
    "op2_digest": "documents", "op3_forest": "embeddings", "op4_minhash": "documents", "op6_crossent": "documents",
    "op7_mixing": "documents", "op8_extract": "pages", "op9_ordinal": "documents", "op10_debruijn": "documents",
    "op11_repair": "documents", "op12_manifest": "documents",
}


@pytest.fixture(scope="module")
def empty(spark, small, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("empty"))
    for name in TABLES:
        spark.read.parquet(f"{small}/{name}.parquet").limit(0).write.parquet(f"{folder}/{name}.parquet")
    return folder


def test_all_are_registered():
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())
    assert {int(name[2:].split("_")[0]) for name in QUERIES} == set(range(1, 14))
    assert entry.queries()["pipeline"] is corpus_pipeline.run


@pytest.mark.parametrize("name", sorted(set(ORACLES) - {"op12_manifest", "op13_trie"}))
def test_query_equals_sql(spark, small, name):
    assert oracle.compare(QUERIES[name](spark, small), oracle.connect(small), ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(ROWS))
def test_query_has_a_row_for_every_row(spark, small, name):
    if name in ORACLES:
        pytest.skip("compared with its SQL")
    assert QUERIES[name](spark, small).count() == spark.read.parquet(f"{small}/{ROWS[name]}.parquet").count()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_on_empty_tables(spark, empty, name):
    assert QUERIES[name](spark, empty).count() == 0


def test_pipeline_on_empty_tables(spark, empty):
    assert corpus_pipeline.run(spark, empty).count() == 0


def test_pipeline_packs_every_piece_once(spark, small):
    found = corpus_pipeline.run(spark, small).collect()
    assert found and all(0 < r.length <= 1024 for r in found)
    places = {}
    for r in found:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 1024
