import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidylake.operators import (by_key, clean_columns, clean_headers, date_range_flag,
                                delay_flag, directional_endpoints, fill_nulls, lookup,
                                replace_values, role_lookup, role_projection, select_renamed,
                                union_by_name)
from tidylake.operators import rows as distinct_rows
from tidylake.operators.joins import checked_broadcast

ZW = "\u200b"


def test_select_renamed_keeps_dict_order_and_drops_rest(spark):
    df = spark.createDataFrame([(1, "a", 2.0)], "x int, y string, z double")
    out = select_renamed(df, {"z": "zz", "x": "xx"})
    assert out.columns == ["zz", "xx"]
    assert rows(out) == [(2.0, 1)]


def test_select_renamed_odd_names(spark):
    df = spark.createDataFrame([(1,)], "`Service Type.Code` int")
    assert select_renamed(df, {"Service Type.Code": "code"}).columns == ["code"]


def test_clean_headers(spark):
    df = spark.createDataFrame([(1, 2)], f"`{ZW}a{ZW}` int, `b{ZW}` int")
    assert clean_headers(df).columns == ["a", "b"]
    clash = spark.createDataFrame([(1, 2)], f"`{ZW}a` int, `a` int")
    with pytest.raises(ValueError):
        clean_headers(clash)


def test_role_projection(spark):
    df = spark.createDataFrame([("SBGR", "large")], "icao string, kind string")
    assert role_projection(df, role="dep").columns == ["icao_dep", "kind_dep"]
    assert role_projection(df, {"icao": "dep_icao"}).columns == ["dep_icao"]


def test_fill_nulls_numeric_string_and_type_skip(spark):
    df = spark.createDataFrame([(None, None, None, None), (1, float("nan"), "x", None)],
                               "i int, d double, s string, t timestamp")
    num = fill_nulls(df, -1, ["i", "d"])
    assert rows(num.select("i", "d")) == [(-1, -1.0), (1, -1.0)]  # NaN filled too
    txt = fill_nulls(df, "none", ["s", "t"])  # timestamp silently skipped
    assert [r.t for r in txt.collect()] == [None, None]
    assert sorted(r.s for r in txt.collect()) == ["none", "x"]
    with pytest.raises(TypeError):
        fill_nulls(df, "none", ["t"], strict=True)
    with pytest.raises(ValueError):
        fill_nulls(df, "none", ["nope"], strict=True)


def test_replace_values_subset_only(spark):
    df = spark.createDataFrame([("1", "1"), ("2", "1")], "mes string, other string")
    out = replace_values(df, {"1": "Janeiro"}, ["mes"])
    assert rows(out) == [("2", "1"), ("Janeiro", "1")]


def test_clean_columns(spark):
    df = spark.createDataFrame([(f"{ZW} J ", f"{ZW}x")], "a string, b string")
    assert rows(clean_columns(df, ["a"])) == [("J", f"{ZW}x")]


def test_by_key_deterministic_survivor_and_null_keys(spark):
    data = [(1, None, "b", 5), (1, None, "a", 9), (None, None, "z", 1), (None, None, "y", 2),
            (2, 3, "q", 0)]
    df = spark.createDataFrame(data, "k1 int, k2 int, v string, w int")
    first = by_key(df, ["k1", "k2"])
    assert first.columns == ["k1", "k2", "v", "w"]
    assert rows(first) == sorted([(1, None, "a", 9), (None, None, "y", 2), (2, 3, "q", 0)],
                                 key=repr)
    by_w = by_key(df, ["k1", "k2"], order_by=["w"])
    assert rows(by_w) == sorted([(1, None, "b", 5), (None, None, "z", 1), (2, 3, "q", 0)],
                                key=repr)
    last = by_key(df, ["k1", "k2"], order_by=["w"], keep="last")
    assert rows(last) == sorted([(1, None, "a", 9), (None, None, "y", 2), (2, 3, "q", 0)],
                                key=repr)
    # idempotent
    assert rows(by_key(first, ["k1", "k2"])) == rows(first)


def test_by_key_is_one_shuffle_with_partial_aggregation(spark):
    df = spark.range(100).select((F.col("id") % 7).alias("k"), F.col("id").alias("v"))
    plan = by_key(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    assert "partial_min" in plan


def test_distinct_rows(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (2, None)], "a int, b string")
    assert rows(distinct_rows(df)) == [(1, "a"), (2, None)]


def test_union_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    b = spark.createDataFrame([("y", 2)], "v string, k int")
    out = union_by_name([a, b])
    assert out.columns == ["k", "v"] and rows(out) == [(1, "x"), (2, "y")]
    c = spark.createDataFrame([(3,)], "k int")
    with pytest.raises(Exception):
        union_by_name([a, c]).collect()
    assert rows(union_by_name([a, c], allow_missing=True)) == [(1, "x"), (3, None)]


@pytest.fixture()
def fact_dim(spark):
    fact = spark.createDataFrame([(1, "A"), (2, "B"), (3, None), (4, "Z"), (5, "A")],
                                 "id int, code string")
    dim = spark.createDataFrame([("A", "alpha"), ("B", "beta"), ("B", "beta2")],
                                "dcode string, name string")
    return fact, dim


@pytest.mark.parametrize("broadcast", ["auto", False])
def test_lookup_left_semantics(spark, fact_dim, broadcast):
    fact, dim = fact_dim
    out = lookup(fact, dim, "code", "dcode", broadcast=broadcast)
    assert out.columns == ["id", "code", "dcode", "name"]
    assert rows(out) == sorted([(1, "A", "A", "alpha"), (2, "B", "B", "beta"),
                                (2, "B", "B", "beta2"), (3, None, None, None),
                                (4, "Z", None, None), (5, "A", "A", "alpha")], key=repr)
    uniq = lookup(fact, dim, "code", "dcode", unique=True, broadcast=broadcast)
    assert uniq.count() == fact.count()
    assert rows(uniq.where("id = 2").select("name")) == [("beta",)]


def test_lookup_plans(spark, fact_dim):
    fact, dim = fact_dim
    small = lookup(fact, dim, "code", "dcode")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in small
    big = lookup(fact, dim, "code", "dcode", max_broadcast_rows=1)
    plan = big._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and "__tidylake_salt" in plan
    salted = lookup(fact, dim, "code", "dcode", broadcast=False, skew_salt=4)
    assert rows(salted) == rows(lookup(fact, dim, "code", "dcode"))


def test_checked_broadcast_bounds(spark):
    df = spark.range(1000).select(F.lit("x" * 100).alias("s"))
    assert checked_broadcast(df, max_rows=1000)
    assert not checked_broadcast(df, max_rows=999)
    assert not checked_broadcast(df, max_rows=10_000, max_bytes=50_000)


def test_role_lookup_twice(spark):
    fact = spark.createDataFrame([(1, "X", "Y"), (2, "Y", None)], "id int, src string, dst string")
    dim = spark.createDataFrame([("X", "Ex"), ("Y", "Why")], "icao string, name string")
    out = role_lookup(fact, dim, "src", "icao", {"icao": "src_icao", "name": "src_name"})
    out = role_lookup(out, dim, "dst", "icao", {"icao": "dst_icao", "name": "dst_name"})
    assert rows(out.select("id", "src_name", "dst_name")) == [(1, "Ex", "Why"), (2, "Why", None)]


def test_delay_flag_boundaries(spark):
    base = dt.datetime(2024, 1, 1, 10, 0)
    data = [(base + dt.timedelta(minutes=m), base, cat)
            for cat in ("Doméstico", "Internacional") for m in (29, 30, 59, 60)]
    data += [(None, base, "Doméstico"), (base + dt.timedelta(hours=5), base, "Outro"),
             (base + dt.timedelta(hours=5), base, None)]
    df = spark.createDataFrame(data, "a timestamp, p timestamp, c string")
    out = delay_flag(df, "a", "p", "c", {"Doméstico": 30, "Internacional": 60}, "late")
    got = [r.late for r in out.collect()]
    assert got == [False, True, True, True, False, False, False, True, False, False, False]


def test_delay_flag_midnight(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 2, 0, 20), dt.datetime(2024, 1, 1, 23, 50),
                                 "D")], "a timestamp, p timestamp, c string")
    clock = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 20), dt.datetime(2024, 1, 1, 23, 50),
                                    "D")], "a timestamp, p timestamp, c string")
    assert delay_flag(df, "a", "p", "c", {"D": 30}, "x").first().x
    assert not delay_flag(clock, "a", "p", "c", {"D": 30}, "x").first().x
    assert delay_flag(clock, "a", "p", "c", {"D": 30}, "x", wrap_midnight=True).first().x


def test_date_range_flag_null_is_false(spark):
    df = spark.createDataFrame([(None,), (dt.datetime(2021, 1, 1),)], "d timestamp")
    assert [r.f for r in date_range_flag(df, "d", "2020-03-20", "2022-04-22", "f").collect()] \
        == [False, True]


def test_directional_endpoints(spark):
    df = spark.createDataFrame([("D", "A", "B"), ("P", "A", "B"), ("X", "A", "B"), (None, "A", "B")],
                               "t string, own string, other string")
    out = directional_endpoints(df, "t", "own", "other", "src", "dst")
    assert [(r.src, r.dst) for r in out.collect()] == [("A", "B"), ("B", "A"), (None, None),
                                                        (None, None)]
