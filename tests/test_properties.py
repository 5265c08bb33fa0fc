"""Properties (hypothesis) over small generated frames; one Spark job per example."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tests.conftest import rows
from tidylake.operators import by_key, delay_flag, lookup, union_by_name

SETTINGS = settings(max_examples=6, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])
small_rows = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 3)),
                                st.one_of(st.none(), st.integers(0, 3)),
                                st.one_of(st.none(), st.text("ab", max_size=2))),
                      max_size=25)


@SETTINGS
@given(data=small_rows)
def test_dedup_idempotent_and_one_row_per_key(spark, data):
    df = spark.createDataFrame(data, "k int, a int, b string")
    once = by_key(df, ["k"])
    assert rows(by_key(once, ["k"])) == rows(once)
    assert once.count() == len({r[0] for r in data})


@SETTINGS
@given(data=small_rows, cut=st.integers(0, 25))
def test_union_of_layouts_is_whole(spark, data, cut):
    df = spark.createDataFrame(data, "k int, a int, b string")
    left = spark.createDataFrame(data[:cut], "k int, a int, b string")
    right = spark.createDataFrame([(r[2], r[0], r[1]) for r in data[cut:]],
                                  "b string, k int, a int")
    assert rows(union_by_name([left, right])) == rows(df)


@SETTINGS
@given(keys=st.lists(st.one_of(st.none(), st.integers(0, 5)), max_size=20))
def test_unique_lookup_keeps_fact_rows(spark, keys):
    fact = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "id int, k int")
    dim = spark.createDataFrame([(k, f"n{k}") for k in (0, 1, 1, 2, 3, 3)], "dk int, name string")
    assert lookup(fact, dim, "k", "dk", unique=True).count() == len(keys)
    assert lookup(fact, dim, "k", "dk", unique=True, broadcast=False).count() == len(keys)


@SETTINGS
@given(minutes=st.lists(st.integers(-120, 240), min_size=2, max_size=30))
def test_delay_flag_monotone_in_actual_time(spark, minutes):
    base = dt.datetime(2024, 1, 1, 12)
    data = [(i, base + dt.timedelta(minutes=m), base, c)
            for i, m in enumerate(sorted(minutes)) for c in ("D", "I")]
    df = spark.createDataFrame(data, "i int, a timestamp, p timestamp, c string")
    out = delay_flag(df, "a", "p", "c", {"D": 30, "I": 60}, "late")
    for cat in ("D", "I"):
        flags = [r.late for r in out.where(f"c = '{cat}'").orderBy("i").collect()]
        assert flags == sorted(flags)  # once late, later actual times stay late
