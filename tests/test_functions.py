import datetime as dt

from pyspark.sql import functions as F

from tidylake.functions import (clean_key, in_range, map_labels, minutes_between,
                                seconds_of_day, weekday_label)
from tidylake.plans import airport

ZW = "\u200b"


def test_map_labels_int_keys_on_text(spark):
    df = spark.createDataFrame([("1",), ("01",), ("12",), ("13",), (None,), ("abc",)], "m string")
    got = [r[0] for r in df.select(map_labels("m", airport.MONTH_LABELS, airport.MONTH_DEFAULT,
                                              key_type="int")).collect()]
    assert got == ["Janeiro", "Janeiro", "Dezembro", airport.MONTH_DEFAULT,
                   airport.MONTH_DEFAULT, airport.MONTH_DEFAULT]


def test_map_labels_without_default_is_null(spark):
    df = spark.createDataFrame([("D",), ("X",), (None,)], "c string")
    got = [r[0] for r in df.select(map_labels("c", {"D": "dom"})).collect()]
    assert got == ["dom", None, None]


def test_clean_key_removes_zero_width_and_spaces(spark):
    df = spark.createDataFrame([(f" {ZW}SBGR{ZW} ",), (f"{ZW}",), (None,), ("\tX",)], "k string")
    got = [r[0] for r in df.select(clean_key("k")).collect()]
    assert got == ["SBGR", "", None, "\tX"]  # trim removes ASCII spaces only


def test_weekday_label(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 10),), (dt.datetime(2024, 1, 7),),
                                (None,)], "d timestamp")
    got = [r[0] for r in df.select(weekday_label("d", airport.WEEKDAY_LABELS,
                                                 airport.WEEKDAY_DEFAULT)).collect()]
    assert got == ["Segunda-feira", "Domingo", "Dia não informado"]


def test_in_range_end_is_midnight_unless_whole_days(spark):
    vals = [dt.datetime(2020, 3, 19, 23, 59), dt.datetime(2020, 3, 20), dt.datetime(2022, 4, 22),
            dt.datetime(2022, 4, 22, 10), dt.datetime(2022, 4, 23), None]
    df = spark.createDataFrame([(v,) for v in vals], "d timestamp")
    strict = [r[0] for r in df.select(in_range("d", "2020-03-20", "2022-04-22")).collect()]
    whole = [r[0] for r in df.select(in_range("d", "2020-03-20", "2022-04-22", True)).collect()]
    assert strict == [False, True, True, False, False, False]
    assert whole == [False, True, True, True, False, False]


def test_minutes_between_and_midnight_wrap(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 20), dt.datetime(2024, 1, 1, 23, 50))],
                               "a timestamp, p timestamp")
    r = df.select(minutes_between("a", "p").alias("plain"),
                  minutes_between("a", "p", wrap_midnight=True).alias("wrapped")).first()
    assert r.plain == -1410.0
    assert r.wrapped == 30.0


def test_seconds_of_day(spark):
    df = spark.createDataFrame([("10:30",), ("23:59:59",), ("24:00",), ("x",), (None,)], "t string")
    got = [r[0] for r in df.select(seconds_of_day("t")).collect()]
    assert got == [37800, 86399, None, None, None]


def test_expressions_stay_in_codegen(spark):
    df = spark.range(10).select(F.col("id").cast("string").alias("k"))
    plan = df.select(clean_key("k"), map_labels("k", {"1": "a"}, "b"))._jdf.queryExecution() \
        .executedPlan().toString()
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan


def test_malformed_seconds_are_not_absent_ones(spark):
    from tidylake.functions.time import seconds_of_day
    texts = ["10:30", "10:30:05", "10:30:ab", "10:30:45.5", "10:30:", "10:30:60", "24:00", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(seconds_of_day("t")).collect()] == [
        37800, 37805, None, None, None, None, None, None]
