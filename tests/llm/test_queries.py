import os

import pytest

import corpus_pipeline
from tests.llm.helpers import odd_documents
from tidylake.llm.queries import ORACLE_SQL, QUERIES
from tools.oracle_check import compare, duck

TABLE_DIR = os.environ.get("TIDYLAKE_ORACLE_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("key", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, key):
    ok, n_spark, n_oracle, _, detail = compare(spark, TABLE_DIR, key, QUERIES[key], ORACLE_SQL[key],
                                               duck(TABLE_DIR))
    assert ok, f"{key}: spark={n_spark} oracle={n_oracle}{detail}"


@pytest.mark.parametrize("key", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_query_covers_its_table(spark, key):
    table, column = ("pages", "page_id") if key.startswith("op1_") else ("documents", "doc_id")
    rows = spark.read.parquet(f"{TABLE_DIR}/{table}.parquet").select(column)
    got = QUERIES[key](spark, TABLE_DIR).select(column)
    assert sorted(got.collect()) == sorted(rows.collect())


def test_every_operator_has_one_query():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))


def test_native_queries_run_no_python(spark):
    for key in ("op3_mixture", "op8_interleaved_shards"):
        plan = QUERIES[key](spark, TABLE_DIR)._jdf.queryExecution().toString()
        assert "Python" not in plan and "Pandas" not in plan and "InArrow" not in plan


def test_pipeline(spark):
    docs = spark.read.parquet(f"{TABLE_DIR}/documents.parquet")
    last = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        last = stage(spark, last, TABLE_DIR)
        assert last.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    got = corpus_pipeline.run(spark, TABLE_DIR)
    assert got.count() > 0
    assert {r["doc_id"] for r in got.collect()} <= {r["doc_id"] for r in docs.collect()}


def test_stages_take_odd_rows(spark):
    df = odd_documents(spark)
    for _, stage in corpus_pipeline.STAGES:
        stage(spark, df, TABLE_DIR).count()
        stage(spark, df.limit(0), TABLE_DIR).count()
