"""Files of many column layouts in one scan, and malformed rows as a second output."""

import os
import random

import pytest
from pyspark.sql import functions as F

from tidylake import sinks
from tidylake.operators import joins
from tidylake.plans import airport
from tidylake.sources import CsvLayout, read_csv, read_layouts, read_mixed, split_rejects
from tidylake.sources.csv import literal_path
from tests.conftest import rows as _rows

SCHEMA = [("K", "int"), ("T", "timestamp"), ("V", "string"), ("W", "double"), ("D", "date")]
NAMES = [n for n, _ in SCHEMA]
CELLS = {
    "K": ["1", "-7", "+5", "null", "", "x", " 3", "2.5", "99999999999", '"4"'],
    "T": ["2020-01-02 03:04:05", "2020-01-02T03:04:05", "2020-01-02", "null", "nope", "2020-13-01", "10:30", ""],
    "V": ["a", "", "null", '"q;r"', '"say ""x"""', " pad ", "é", '"back\\\\slash"', "NULL", '"a\\"b"', "x\\"],
    "W": ["1.5", "-2", "null", "1e3", "1,5", "NaN", "", "abc", ".5"],
    "D": ["2021-05-06", "null", "2021-5-6", "06/05/2021", ""],
}


def rows(df):
    """Rows to compare, a NaN like any value."""
    return [tuple("NaN" if isinstance(v, float) and v != v else v for v in r) for r in _rows(df)]


def _write(path, names, records, sep=";"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8", newline="") as fh:
        fh.write(sep.join(names) + "\n")
        for r in records:
            fh.write(sep.join(r[n] for n in names) + "\n")


def _records(n, seed):
    rnd = random.Random(seed)
    return [{c: rnd.choice(v) for c, v in CELLS.items()} for _ in range(n)]


def _ways():
    return [NAMES, NAMES[::-1], NAMES[2:] + NAMES[:2], NAMES[1:] + NAMES[:1]]


@pytest.fixture()
def lake(tmp):
    """Four layouts with two files each, cells of every kind."""
    for i, way in enumerate(_ways()):
        for j in range(2):
            _write(f"{tmp}/raw/l{i}/a b{j}.csv", way, _records(40, 10 * i + j))
    return tmp


def test_equals_one_scan_per_layout(spark, lake):
    rename = {"K": "k", "T": "t", "V": "v", "W": "w", "D": "d"}
    layouts = [CsvLayout(f"{lake}/raw/l{i}", [(n, dict(SCHEMA)[n]) for n in way], rename)
               for i, way in enumerate(_ways())]
    want = read_layouts(spark, layouts, sep=";", null_value="null")
    got = read_mixed(spark, f"{lake}/raw", SCHEMA, rename, sep=";", null_value="null")
    assert got.schema == want.schema
    assert rows(got) == rows(want)


def test_malformed_rows_equal_those_of_the_reader(spark, lake):
    want = read_csv(spark, f"{lake}/raw/l0", schema=SCHEMA, sep=";", null_value="null", corrupt="bad")
    got = read_mixed(spark, f"{lake}/raw/l0", SCHEMA, sep=";", null_value="null", corrupt="bad")
    assert rows(got) == rows(want)
    assert 0 < want.where("bad is null").count() < want.count()


def test_plan_does_not_grow_and_no_path_is_sent(spark, lake):
    def plan():
        df = read_mixed(spark, f"{lake}/raw", SCHEMA, sep=";")
        return df, df._jdf.queryExecution().executedPlan().toString()

    before, small = plan()
    assert small.count("FileScan csv") == 1 and "BroadcastHashJoin" in small and "Python" not in small
    for i in range(30):  # more files and layouts
        _write(f"{lake}/raw/more{i}/x.csv", random.Random(i).sample(NAMES, 5), _records(3, i))
    after, large = plan()
    assert large.count("\n") == small.count("\n")
    assert after.count() == before.count() + 90
    assert "more" not in large.replace(f"{lake}/raw", "")


def test_shuffled_by_file_beyond_the_bound(spark, lake, monkeypatch):
    want = rows(read_mixed(spark, f"{lake}/raw", SCHEMA, sep=";"))
    monkeypatch.setattr(joins, "DEFAULT_MAX_BROADCAST_ROWS", 1)
    df = read_mixed(spark, f"{lake}/raw", SCHEMA, sep=";", spread=3)
    assert "BroadcastHashJoin" not in df._jdf.queryExecution().executedPlan().toString()
    assert rows(df) == want


def test_file_column_include_and_options(spark, lake):
    df = read_mixed(spark, f"{lake}/raw", SCHEMA, {"D": "d"}, sep=";", include="/l[01]/", file="f",
                    dateFormat="dd/MM/yyyy")
    assert df.columns == ["d", "f"]
    files = {r.f for r in df.select("f").distinct().collect()}
    assert len(files) == 4 and all("a%20b" in f for f in files)
    assert {str(r.d) for r in df.where("d is not null").collect()} == {"2021-05-06"}
    one = sorted(files)[0]
    assert read_csv(spark, literal_path(one), sep=";").count() == 40


def test_wrong_header_fails(spark, tmp):
    _write(f"{tmp}/a.csv", ["K", "X"], [])
    with pytest.raises(Exception, match="does not name the schema"):
        read_mixed(spark, tmp, [("K", "int"), ("V", "string")], sep=";").collect()


def test_one_type_only_and_empty_files(spark, tmp):
    _write(f"{tmp}/s/a.csv", ["V", "U"], [{"V": "1", "U": "2"}])
    _write(f"{tmp}/s/b.csv", ["U", "V"], [{"V": "3", "U": "4"}, {"V": "", "U": "5"}])
    _write(f"{tmp}/s/c.csv", ["U", "V"], [])
    df = read_mixed(spark, f"{tmp}/s", "V string, U string", sep=";")
    assert rows(df) == [("1", "2"), ("3", "4"), (None, "5")]
    df = read_mixed(spark, f"{tmp}/s", "V int, U int", sep=";", corrupt="c")
    assert rows(df.where("c is null").select("V", "U")) == [(1, 2), (3, 4), (None, 5)]


def test_rejects_are_written_and_counted(spark, tmp):
    _write(f"{tmp}/raw/a.csv", NAMES[:2], [{"K": "1", "T": "2020-01-01"}, {"K": "x", "T": "2020-01-01"}])
    with open(f"{tmp}/raw/a.csv", "a", encoding="utf-8") as fh:
        fh.write("5\n6;2020-01-01;extra\n7;\n")
    for read in (read_csv, read_mixed):
        raw = read(spark, f"{tmp}/raw", schema=SCHEMA[:2], sep=";", corrupt="bad", file="f")
        n = sinks.write_with_rejects(raw, f"{tmp}/good", f"{tmp}/bad", "bad", "f")
        assert n == (2, 3)
        good, bad = spark.read.parquet(f"{tmp}/good"), spark.read.parquet(f"{tmp}/bad")
        assert good.columns == ["K", "T"] and sorted(r.K for r in good.collect()) == [1, 7]
        assert sorted(r.text for r in bad.collect()) == ["5", "6;2020-01-01;extra", "x;2020-01-01"]
        assert {os.path.basename(r.file) for r in bad.collect()} == {"a.csv"}
        # the cells that could be read are there
        assert sorted(r["k"] for r in bad.select(F.col("parsed.K").alias("k")).collect() if r["k"]) == [5, 6]


def test_rejects_see_all_columns(spark, tmp):
    """A column that is not selected still makes its row malformed."""
    _write(f"{tmp}/raw/a.csv", ["K", "V", "W"], [{"K": "1", "V": "a", "W": "bad"}, {"K": "2", "V": "b", "W": "1"}])
    raw = read_csv(spark, f"{tmp}/raw", schema="K int, V string, W double", sep=";", corrupt="c")
    good, bad = split_rejects(raw, "c")
    assert rows(good.select("K")) == [(2,)] and bad.count() == 1
    with pytest.raises(ValueError):
        read_csv(spark, f"{tmp}/raw", corrupt="c")


def test_movement_flow_over_many_layouts(spark, tmp):
    """Every file in an order of its own: the flow reads them as one layout would be."""
    names = [n for n, _ in airport.MOVEMENT_FIELDS]

    def record(i):
        r = {n: f"{n}{i}" for n in names} | {n: str(i) for n, t in airport.MOVEMENT_FIELDS if t in ("int", "double")}
        day = f"2021-0{i % 3 + 1}-11"
        return r | {"ANO": "2021", "MES": str(i % 3 + 1), "NR_NATUREZA": "D", "NR_MOVIMENTO_TIPO": "P"} | {
            n: day for n in names if n.startswith("DT_")} | {n: f"1{i % 10}:30:00" for n in names if n.startswith("HH_")}

    records = [record(i) for i in range(12)]
    for i in range(4):
        way = random.Random(i).sample(names, len(names))
        _write(f"{tmp}/many/2021/f{i}.csv", way, records[3 * i:3 * i + 3])
    _write(f"{tmp}/one/2021/f.csv", names, records)
    for x in ("many", "one"):
        airport.movements_to_silver(spark, f"{tmp}/{x}", f"{tmp}/silver-{x}", ["2021"])
    many, one = (spark.read.schema(airport.silver_movement_schema()).parquet(f"{tmp}/silver-{x}")
                 for x in ("many", "one"))
    assert many.count() == len({r["MES"] + r["HH_CALCO"] for r in records})
    assert rows(many) == rows(one)
