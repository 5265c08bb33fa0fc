import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidylake import sinks
from tidylake.schema import make_schema, reorder
from tidylake.sources import CsvLayout, read_csv, read_layouts, read_parquet
from tidylake.sources.html_tables import extract_tables, parse_tables, table_columns

ZW = "\u200b"
SCHEMA = [("a", "int"), ("b", "string"), ("c", "double"), ("t", "timestamp")]


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(text)


def test_csv_permissive_and_null_tokens(spark, tmp):
    _write(f"{tmp}/x/f.csv", "a;b;c;t\n"
           "1;null;2.5;2024-01-01 10:00:00\n"
           "x;;\"\";bad\n"
           "3;short\n"
           "4;e;1;2024-01-02;extra\n")
    df = read_csv(spark, f"{tmp}/x", schema=SCHEMA, sep=";", null_value="null")
    got = rows(df.select("a", "b", "c", F.col("t").cast("string")))
    assert got == sorted([(1, None, 2.5, "2024-01-01 10:00:00"), (None, None, None, None),
                          (3, "short", None, None), (4, "e", 1.0, "2024-01-02 00:00:00")],
                         key=repr)


def test_csv_strict_header_rejects_other_order(spark, tmp):
    _write(f"{tmp}/y/f.csv", "b;a;c;t\nq;1;2;\n")
    loose = read_csv(spark, f"{tmp}/y", schema=SCHEMA, sep=";")
    assert loose.first().a is None  # positional: 'q' into int a -> null
    strict = read_csv(spark, f"{tmp}/y", schema=SCHEMA, sep=";", strict_header=True)
    with pytest.raises(Exception):
        strict.collect()


def test_csv_header_strings_and_exclusion(spark, tmp):
    _write(f"{tmp}/z/2019/a.csv", "k,v\n1,x\n")
    _write(f"{tmp}/z/2020/b.csv", "k,v\n2,y\n")
    _write(f"{tmp}/z/2020/odd.csv", "v,k\nz,3\n")
    _write(f"{tmp}/z/2020/notes.txt", "k,v\n9,no\n")
    df = read_csv(spark, f"{tmp}/z", glob="*.csv", recursive=True, exclude=["odd.csv"])
    assert dict(df.dtypes) == {"k": "string", "v": "string"}
    assert rows(df) == [("1", "x"), ("2", "y")]
    by_folder = read_csv(spark, f"{tmp}/z", glob="*.csv", recursive=True,
                         exclude=["z/2020/"])
    assert rows(by_folder) == [("1", "x")]


def test_read_layouts_union(spark, tmp):
    _write(f"{tmp}/m/2019/a.csv", "K;V\n1;x\n")
    _write(f"{tmp}/m/2020/b.csv", "K;V\n2;y\n")
    _write(f"{tmp}/m/2020/odd.csv", "V;K\nz;3\n")
    schema = make_schema([("K", "int"), ("V", "string")])
    df = read_layouts(spark, [
        CsvLayout([f"{tmp}/m/2019", f"{tmp}/m/2020"], schema, {"K": "k", "V": "v"},
                  exclude=[f"{tmp}/m/2020/odd.csv"]),
        CsvLayout(f"{tmp}/m/2020/odd.csv", reorder(schema, ["V", "K"]), {"K": "k", "V": "v"}),
    ], sep=";")
    assert df.columns == ["k", "v"]
    assert rows(df) == [(1, "x"), (2, "y"), (3, "z")]


def test_parquet_partitions_counted_and_typed(spark, tmp):
    df = spark.createDataFrame([(1, "2020", "Março"), (2, "2021", "Abril"), (3, "2021", "Março")],
                               "id int, ano string, mes string")
    n = sinks.write_parquet(df, f"{tmp}/p", ["ano", "mes"], rebalance=True, count=True)
    assert n == 3
    assert os.path.isdir(f"{tmp}/p/ano=2020/mes=Março")
    inferred = read_parquet(spark, f"{tmp}/p")
    assert dict(inferred.dtypes)["ano"] == "int"  # folder names inferred
    typed = read_parquet(spark, f"{tmp}/p", schema="id int, ano string, mes string")
    assert dict(typed.dtypes)["ano"] == "string"
    pruned = typed.where((F.col("ano") == "2021") & (F.col("mes") == "Março"))
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ano" in plan
    assert rows(pruned.select("id")) == [(3,)]


def test_parquet_static_and_dynamic_overwrite(spark, tmp):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "id int, part string")
    sinks.write_parquet(a, f"{tmp}/o", ["part"])
    b = spark.createDataFrame([(3, "y")], "id int, part string")
    sinks.write_parquet(b, f"{tmp}/o", ["part"], dynamic=True)
    assert rows(read_parquet(spark, f"{tmp}/o").select("id", "part")) == [(1, "x"), (3, "y")]
    sinks.write_parquet(b, f"{tmp}/o", ["part"])
    assert rows(read_parquet(spark, f"{tmp}/o").select("id", "part")) == [(3, "y")]


def test_csv_overwrite_and_count(spark, tmp):
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    sinks.write_csv(a, f"{tmp}/c")
    n = sinks.write_csv(a.union(a), f"{tmp}/c", count=True)
    assert n == 2
    assert read_csv(spark, f"{tmp}/c", schema=a.schema, strict_header=True).count() == 2


HTML = (
    "<html><script>var t='<table><tr><td>no</td></tr></table>';</script>"
    "<table><tr><td>t0</td></tr></table>"
    "<table><tr><td>t1 <table><tr><td>nested</td></tr></table></td></tr></table>"
    f"<table><tr><th>{ZW}Code</th><th>Name{ZW}</th><th>Span</th></tr>"
    "<tr><td>J<td>A &amp; B<td rowspan=2>r</tr>"
    "<tr><td colspan=2>wide</td></tr>"
    "<tr><td>  lots   of\n space </td><td></td></tr>"
    "</table></html>"
)


def test_parse_tables_rules():
    tables = parse_tables(HTML)
    assert len(tables) == 4  # script text ignored; nested table counted
    assert tables[1] == [["t1 nested"]]
    assert tables[2] == [["nested"]]
    assert tables[3] == [[f"{ZW}Code", f"Name{ZW}", "Span"], ["J", "A & B", "r"],
                         ["wide", "wide", "r"], ["lots of space", None]]
    assert parse_tables("") == [] and parse_tables("<p>none</p>") == []


def test_extract_tables_and_columns(spark):
    pages = spark.createDataFrame([(1, HTML), (2, "<table><tr><td>only</td></tr></table>"),
                                   (3, None)], "page_id long, html string")
    ext = extract_tables(pages, "html", keep=["page_id"], table_index=3)
    assert rows(ext.select("page_id", "row_ix")) == [(1, 1), (1, 2), (1, 3)]
    out = table_columns(ext, {"Code": "code", "Name": "name", "Missing": "m"})
    assert rows(out) == sorted([(1, "J", "A & B", None), (1, "wide", "wide", None),
                                (1, "lots of space", None, None)], key=repr)
    everything = extract_tables(pages, "html", header=False)
    assert everything.where("page_id = 2").count() == 1


def test_excluded_files_are_not_read(spark, tmp):
    """The exclusion prunes files before the scan: an excluded file whose header
    would fail the strict check does not fail the job."""
    _write(f"{tmp}/q/good.csv", "k,v\n1,x\n")
    _write(f"{tmp}/q/other_layout.csv", "v,k\ny,2\n")
    schema = [("k", "int"), ("v", "string")]
    strict = read_csv(spark, f"{tmp}/q", schema=schema, strict_header=True)
    with pytest.raises(Exception):
        strict.collect()
    pruned = read_csv(spark, f"{tmp}/q", schema=schema, strict_header=True,
                      exclude=["other_layout.csv"])
    assert rows(pruned) == [(1, "x")]


def test_discover_layouts_by_header(spark, tmp):
    from tidylake.sources import discover_layouts, file_headers
    _write(f"{tmp}/d/2019/a.csv", "K;V;W\n1;x;1.5\n")
    _write(f"{tmp}/d/2019/b.csv", "K;V;W\n2;y;2.5\n")
    _write(f"{tmp}/d/2020/c.csv", "W;K;V\n3.5;3;z\n")
    _write(f"{tmp}/d/2021/e f.csv", '"V";"W";"K"\n' + "q;4.5;4\n")
    _write(f"{tmp}/d/2021/notes.txt", "nothing\n")
    heads = {r.path.rsplit("/", 1)[-1]: r.header for r in file_headers(spark, f"{tmp}/d").collect()}
    assert heads == {"a.csv": "K;V;W", "b.csv": "K;V;W", "c.csv": "W;K;V",
                     "e f.csv": '"V";"W";"K"'}
    schema = [("K", "int"), ("V", "string"), ("W", "double")]
    layouts = discover_layouts(spark, f"{tmp}/d", schema, {"K": "k", "V": "v", "W": "w"},
                               sep=";")
    assert len(layouts) == 3
    df = read_layouts(spark, layouts, sep=";")
    assert rows(df) == [(1, "x", 1.5), (2, "y", 2.5), (3, "z", 3.5), (4, "q", 4.5)]
    _write(f"{tmp}/d/2022/bad.csv", "K;X;W\n5;?;1\n")
    with pytest.raises(ValueError, match="bad.csv"):
        discover_layouts(spark, f"{tmp}/d", schema, None, sep=";")


def test_exclusion_matches_encoded_names(spark, tmp):
    for name in ("e f.csv", "Março.csv", "ok.csv"):
        _write(f"{tmp}/enc/{name}", "k\n1\n")
    schema = [("k", "int")]
    assert read_csv(spark, f"{tmp}/enc", schema=schema, exclude=["e f.csv", "Março.csv"]).count() == 1
    full = [f"file:{tmp}/enc/e f.csv", f"file:{tmp}/enc/Março.csv"]
    assert read_csv(spark, f"{tmp}/enc", schema=schema, exclude=full).count() == 1


def test_file_headers(spark, tmp):
    from tidylake.sources import discover_layouts, file_headers
    _write(f"{tmp}/h/2019/a.csv", "\ufeffK;V\n1;x\n2;y\n")
    _write(f"{tmp}/h/2020/e f.csv", "V;K\nz;3\n")
    _write(f"{tmp}/h/2020/a+b.csv", "K;V\n4;w\n")
    heads = {r.path.rsplit("/", 1)[-1]: r.header
             for r in file_headers(spark, f"{tmp}/h").collect()}
    assert heads == {"a.csv": "K;V", "e f.csv": "V;K", "a+b.csv": "K;V"}
    layouts = discover_layouts(spark, f"{tmp}/h", [("K", "int"), ("V", "string")], None,
                               sep=";")
    assert rows(read_layouts(spark, layouts, sep=";")) == [(1, "x"), (2, "y"), (3, "z"),
                                                            (4, "w")]


def test_max_records_per_file(spark, tmp):
    import glob
    df = spark.range(100).select(F.col("id"), F.lit("x").alias("p")).coalesce(1)
    sinks.write_parquet(df, f"{tmp}/mr", ["p"], max_records_per_file=30)
    assert len(glob.glob(f"{tmp}/mr/p=x/*.parquet")) == 4
    assert read_parquet(spark, f"{tmp}/mr").count() == 100


def test_long_and_latin1_headers(spark, tmp):
    import os

    from tidylake.sources import file_headers
    names = [f"coluna_{i}_é" for i in range(120_000)]  # longer than a mebibyte
    os.makedirs(f"{tmp}/l")
    with open(f"{tmp}/l/a.csv", "w", encoding="latin-1") as f:
        f.write(";".join(names) + "\n1\n")
    header = file_headers(spark, f"{tmp}/l", encoding="latin-1").first().header
    assert header.split(";") == names


def test_headers_read_no_more_of_longer_files(spark, tmp, monkeypatch):
    import io

    from tidylake.sources import layouts
    read = []

    class Counted(io.BytesIO):
        def read(self, n=-1):
            block = super().read(n)
            read.append(len(block))
            return block

    for rows_ in (10, 1_000_000):
        monkeypatch.setattr(layouts, "_open", lambda p, o, n=rows_: Counted(b"K;V\n" + b"1;x\n" * n))
        assert layouts._first_line("any", "utf-8") == "K;V"
    assert max(read) <= 65536 and len(read) == 2


def test_unreachable_header_is_an_error():
    from tidylake.sources import layouts
    with pytest.raises(Exception):
        layouts._first_line("file:/no/such/file.csv", "utf-8")


def test_half_the_files_in_each_of_two_layouts(spark, tmp):
    import itertools

    from tidylake.sources import discover_layouts
    columns = ["K", "V", "W"]
    orders = list(itertools.permutations(columns))[:5]
    want = []
    for i in range(20):
        order = orders[i % 2] if i < 16 else orders[2 + i % 3]
        row = {"K": str(i), "V": f"v{i}", "W": f"w{i}"}
        _write(f"{tmp}/two/{i}.csv", ";".join(order) + "\n" + ";".join(row[c] for c in order) + "\n")
        want.append((i, f"v{i}", f"w{i}"))
    layouts = discover_layouts(spark, f"{tmp}/two", [("K", "int"), ("V", "string"), ("W", "string")],
                               None, sep=";")
    assert rows(read_layouts(spark, layouts, sep=";").select("K", "V", "W")) == sorted(want, key=repr)


def test_wide_spans(spark):
    from tidylake.sources.html_tables import extract_tables, parse_tables
    tall = "<table><tr><td rowspan=1500>a</td><td>0</td></tr>" + "".join(
        f"<tr><td>{i}</td></tr>" for i in range(1, 1500)) + "<tr><td>z</td></tr></table>"
    grid = parse_tables(tall)[0]
    assert grid[:1500] == [["a", str(i)] for i in range(1500)] and grid[1500] == ["z"]
    wide = parse_tables("<table><tr><td colspan=1500>a</td><td>b</td></tr></table>")[0]
    assert wide == [["a"] * 1500 + ["b"]]
    absurd = spark.createDataFrame([(7, "<table><tr><td colspan=99999999>a</td></tr></table>")],
                                   "page_id int, html string")
    with pytest.raises(Exception, match="page .*7"):
        extract_tables(absurd).collect()


def test_building_html_plan_starts_no_job(spark):
    from tidylake.sources.html_tables import extract_tables
    pages = spark.range(100).groupBy("id").count().select("id", F.lit("<table></table>").alias("html"))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("html-plan", "", False)
    extract_tables(pages, keep=["id"], spread=4)
    assert list(tracker.getJobIdsForGroup("html-plan")) == []


def test_missing_table_column_is_an_error(spark):
    from tidylake.sources.html_tables import extract_tables, table_columns
    pages = spark.createDataFrame([(1, "<table><tr><th>a</th></tr><tr><td>1</td></tr></table>")],
                                  "page_id int, html string")
    found = extract_tables(pages, header_chars="")
    assert table_columns(found, {"b": "b"}).collect()[0]["b"] is None
    with pytest.raises(Exception, match="no column 'b'"):
        table_columns(found, {"b": "b"}, required=True).collect()
