"""The answer of a lookup does not depend on the size of its dimension."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidylake.operators import joins

HOWS = ["inner", "left", "right", "full", "left_semi", "left_anti"]


@pytest.fixture(scope="module")
def sides(spark):
    fact = spark.createDataFrame(
        [(i, None if i % 4 == 0 else "hot" if i % 4 == 1 else f"k{i % 6}") for i in range(40)],
        "id int, k string")
    dim = spark.createDataFrame([("hot", "H"), ("k2", "2"), ("k3", "3"), ("k3", "33"),
                                 ("unmatched", "u"), (None, "n")], "d string, v string")
    return fact, dim


@pytest.mark.parametrize("how", HOWS)
@pytest.mark.parametrize("same_names", [False, True])
def test_broadcast_and_shuffle_agree(sides, how, same_names):
    fact, dim = sides
    dim = dim.withColumnRenamed("d", "k") if same_names else dim
    key = "k" if same_names else "d"
    want = rows(joins.lookup(fact, dim, "k", key, how=how, broadcast=True))
    assert rows(joins.lookup(fact, dim, "k", key, how=how, broadcast=False)) == want
    salted = [dict(skew_salt=4), dict(hot_keys=["hot"], hot_salt=8), dict(hot_keys=["unmatched"])]
    for options in salted:
        for broadcast in (True, False):
            if how in ("right", "full"):
                with pytest.raises(ValueError, match="salted"):
                    joins.lookup(fact, dim, "k", key, how=how, broadcast=broadcast, **options)
            else:
                got = joins.lookup(fact, dim, "k", key, how=how, broadcast=broadcast, **options)
                assert rows(got) == want


def test_dotted_keys(spark):
    fact = spark.createDataFrame([(1, "x"), (2, None)], "`a.b` int, c string")
    dim = spark.createDataFrame([(1, "one")], "`d.e` int, v string")
    want = [(1, "x", 1, "one"), (2, None, None, None)]
    for broadcast in (True, False):
        assert rows(joins.lookup(fact, dim, "a.b", "d.e", broadcast=broadcast)) == rows(
            spark.createDataFrame(want, "a int, b string, c int, d string"))


def test_size_check_sends_one_row_per_task(spark):
    dim = spark.range(0, 1000, 1, 8).withColumn("s", F.lit("x" * 10))
    assert joins.sizes(dim) == (1000, 1000 * (8 + 18 + 48))
    assert joins.checked_broadcast(dim) and not joins.checked_broadcast(dim, max_rows=999)
    assert not joins.checked_broadcast(dim, max_bytes=1000)


def test_the_bound_holds_for_all_broadcasts_together(spark):
    small, large = spark.range(100), spark.range(1000)
    assert joins.measure(large, small, large, max_bytes=70_000) == [True, True, False]
