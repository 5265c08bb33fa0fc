"""Every registered query against its DuckDB oracle on the smallest tables
(``TIDYLAKE_ORACLE_DIR`` points it at larger ones)."""

import os

import pytest

from tidylake.plans.acceptance import QUERIES
from tools.oracle_check import compare, duck

TABLE_DIR = os.environ.get("TIDYLAKE_ORACLE_DIR", "/root/testdata/sf0.001")


def _cases():
    from __spark_entry__ import oracle_sql, queries
    sql = oracle_sql()
    return [(k, fn, sql[k]) for k, fn in queries().items() if k in sql and k in QUERIES]


@pytest.fixture(scope="module")
def con():
    return duck(TABLE_DIR)


@pytest.mark.parametrize("key,fn,sql", _cases(), ids=[c[0] for c in _cases()])
def test_query_matches_oracle(spark, con, key, fn, sql):
    ok, n_spark, n_oracle, _, detail = compare(spark, TABLE_DIR, key, fn, sql, con)
    assert ok, f"{key}: spark={n_spark} oracle={n_oracle}{detail}"


def test_every_query_has_an_oracle():
    from __spark_entry__ import oracle_sql, queries
    assert set(QUERIES) == set(oracle_sql()) & set(QUERIES)
    assert set(QUERIES) <= set(queries())


def test_entry_smoke(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.columns == ["l_orderkey", "l_linenumber", "l_partkey", "p_name", "weekday",
                          "in_range", "late", "nation_from", "nation_to"]
    assert df.count() > 0


@pytest.mark.parametrize("key", ["left_join_dimension", "role_playing_join", "gold_enriched"])
def test_shuffle_join_plan_matches_oracle(spark, con, key, monkeypatch):
    """The large-table plan (no broadcast: sort-merge joins with salted null
    keys) gives the same rows as the broadcast plan."""
    from __spark_entry__ import oracle_sql, queries
    from tidylake.operators import joins
    monkeypatch.setattr(joins, "DEFAULT_MAX_BROADCAST_ROWS", 1)
    fn = queries()[key]
    plan = fn(spark, TABLE_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan
    ok, n_spark, n_oracle, _, detail = compare(spark, TABLE_DIR, key, fn, oracle_sql()[key], con)
    assert ok, f"{key}: spark={n_spark} oracle={n_oracle}{detail}"
