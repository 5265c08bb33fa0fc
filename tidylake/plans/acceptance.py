"""Acceptance queries: every operator exercised on the driver's tables.

Each function takes ``(spark, table_dir)`` and returns a DataFrame over the
*whole* input tables (``{table_dir}/{name}.parquet``).  File-format operators
first write their input with Spark to a fresh folder below the session's shared
checkpoint directory, then read it back with the operator under test, and joins
first measure their dimensions: these jobs run while the query is built.  ``ORACLE_SQL`` holds the equivalent ANSI SQL for each key.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidylake import sinks
from tidylake.functions.labels import map_labels
from tidylake.functions.text import ZERO_WIDTH_SPACE, html_escape
from tidylake.operators import cleaning, colocated, dedup, enrich, joins
from tidylake.operators.projection import clean_headers, select_renamed
from tidylake.operators.union import union_by_name
from tidylake.plans import airport, ledger
from tidylake.plans.layers import LabelRule, changed_only, refine_dimension, refine_fact
from tidylake.schema import make_schema, reorder
from tidylake.session import configure, scratch_path
from tidylake.sources.csv import CsvLayout, read_csv, read_layouts
from tidylake.sources.html_tables import extract_tables, table_columns
from tidylake.sources.layouts import discover_layouts
from tidylake.sources.mixed import read_mixed
from tidylake.sources.parquet import read_parquet
from tidylake.sources.parquet import row_count as footer_count
from tidylake.streaming.keyed import ingest_keyed

ZW = ZERO_WIDTH_SPACE
STATUS_LABELS = {"F": "Março", "O": "Aberto"}  # accented partition values
RETURN_LABELS = {"A": "Doméstico", "R": "Internacional"}


def table(spark: SparkSession, table_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{table_dir.rstrip('/')}/{name}.parquet")


def _start(spark: SparkSession) -> SparkSession:
    return configure(spark)


# -- sources -----------------------------------------------------------------

def csv_scan_typed(spark, d):
    """`;` CSV with header, explicit schema, header verified."""
    _start(spark)
    orders = table(spark, d, "orders")
    path = scratch_path(spark, "csv_scan_typed")
    sinks.write_csv(orders, path, sep=";")
    schema = make_schema([(f.name, f.dataType) for f in orders.schema.fields])
    return read_csv(spark, path, schema=schema, sep=";", null_value="null", strict_header=True)


def _variant_month():
    """Orders of one month are written in the variant column order."""
    return (F.year("o_orderdate") == 1996) & (F.month("o_orderdate") == 7)


def csv_scan_variant_union(spark, d):
    """One month's files in another column order; two layouts, union."""
    _start(spark)
    orders = table(spark, d, "orders")
    base = scratch_path(spark, "csv_scan_variant_union")
    odd = F.coalesce(_variant_month(), F.lit(False))
    variant_order = list(reversed(orders.columns))
    sinks.write_csv(orders.where(~odd), f"{base}/default", sep=";")
    sinks.write_csv(orders.where(odd).select(*variant_order), f"{base}/variant", sep=";")
    schema = make_schema([(f.name, f.dataType) for f in orders.schema.fields])
    return read_layouts(spark, [CsvLayout(f"{base}/default", schema),
                                CsvLayout(f"{base}/variant", reorder(schema, variant_order))],
                        sep=";", null_value="null", strict_header=True)


def csv_scan_mixed_layouts(spark, d):
    """Four column orders with a quarter of the orders each, in one folder, read
    in one scan by the table of the files' headers."""
    _start(spark)
    orders = table(spark, d, "orders")
    base = scratch_path(spark, "csv_scan_mixed_layouts")
    cols = orders.columns
    ways = [cols, cols[::-1], cols[1:] + cols[:1], cols[::2] + cols[1::2]]
    for i, way in enumerate(ways):
        sinks.write_csv(orders.where(F.pmod("o_orderkey", F.lit(len(ways))) == i).select(*way),
                        base, sep=";", mode="append")
    schema = make_schema([(f.name, f.dataType) for f in orders.schema.fields])
    return read_mixed(spark, base, schema, sep=";", null_value="null")


def csv_scan_positional(spark, d):
    """S2 as the original read it: by position under a schema, whatever the headers say."""
    _start(spark)
    orders = table(spark, d, "orders")
    path = scratch_path(spark, "csv_scan_positional")
    sinks.write_csv(orders.toDF(*[f"field_{i}" for i in range(len(orders.columns))]), path, sep=";")
    schema = make_schema([(f.name, f.dataType) for f in orders.schema.fields])
    return read_csv(spark, path, schema=schema, sep=";", null_value="null", strict_header=False)


def _planted_lines(orders: DataFrame) -> DataFrame:
    """Orders as CSV lines; every eleventh has a bad price, every thirteenth a cell too few."""
    price = F.when(F.col("o_orderkey") % 11 == 0, F.lit("12,x")).otherwise(
        F.col("o_totalprice").cast("string"))
    line = F.concat_ws(";", F.col("o_orderkey").cast("string"), F.col("o_orderstatus"), price)
    return orders.select(F.when(F.col("o_orderkey") % 13 == 0, F.concat_ws(
        ";", F.col("o_orderkey").cast("string"), F.col("o_orderstatus"))).otherwise(line).alias("line"))


def csv_scan_rejects(spark, d):
    """Malformed rows of a CSV are written as a table of their own, with their file and
    text, and counted; good and rejected rows side by side."""
    _start(spark)
    base = scratch_path(spark, "csv_scan_rejects")
    # one column of text with the header as its name: the files' lines are the rows
    _planted_lines(table(spark, d, "orders")).toDF("o_orderkey;o_orderstatus;o_totalprice").write.option(
        "header", True).option("sep", "\t").option("quote", "").csv(f"{base}/raw")
    raw = read_csv(spark, f"{base}/raw", schema="o_orderkey bigint, o_orderstatus string, o_totalprice double",
                   sep=";", strict_header=True, corrupt="__bad", file="__file")
    good, bad = sinks.write_with_rejects(raw, f"{base}/good", f"{base}/bad", "__bad", "__file")
    goods, bads = (read_parquet(spark, f"{base}/{x}") for x in ("good", "bad"))
    counts = F.lit(good).cast("long").alias("n_good"), F.lit(bad).cast("long").alias("n_bad")
    return goods.select("o_orderkey", "o_orderstatus", "o_totalprice", F.lit(None).cast("string").alias("text"),
                        F.lit(True).alias("known_file"), *counts).union(bads.select(
                            "parsed.o_orderkey", "parsed.o_orderstatus", "parsed.o_totalprice", "text",
                            F.col("file").contains("/raw/part-"), *counts))


def csv_scan_header_strings(spark, d):
    """Names from the header, every column a string, directory read."""
    _start(spark)
    path = scratch_path(spark, "csv_scan_header_strings")
    sinks.write_csv(table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus"),
                    path)
    return read_csv(spark, path)


def file_discovery(spark, d):
    """Recursive listing, `*.csv` only (a `.txt` decoy), one folder excluded."""
    _start(spark)
    orders = table(spark, d, "orders")
    root = scratch_path(spark, "file_discovery")
    (orders.withColumn("grp", F.pmod("o_orderkey", F.lit(5))).hint("rebalance", "grp")
     .write.mode("overwrite").partitionBy("grp").option("header", True).csv(root))
    orders.select(F.concat_ws(";", *orders.columns).alias("v")).write.mode("append").text(root)
    return read_csv(spark, root, schema=orders.schema, glob="*.csv", recursive=True,
                    exclude=["grp=4/"])


def csv_write_roundtrip(spark, d):
    """K1: CSV with header replacing the target; read back with its schema."""
    _start(spark)
    supplier = table(spark, d, "supplier")
    path = scratch_path(spark, "csv_write_roundtrip")
    sinks.write_csv(supplier.select(*reversed(supplier.columns)), path)  # to be replaced
    sinks.write_csv(supplier, path)
    return read_csv(spark, path, schema=supplier.schema, strict_header=True)


def pages_with_tables(pages: DataFrame) -> DataFrame:
    """Each stored page with three tables in front of its own HTML: two decoys
    and a third whose rows are the page URL's path segments (header cells
    carry zero-width spaces)."""
    parts = F.split(F.col("url"), "/")
    rows = F.array_join(F.transform(parts, lambda x, i: F.concat(
        F.lit("<tr><td>"), (i + 1).cast("string"), F.lit("</td><td>"), html_escape(x),
        F.lit("</td></tr>"))), "")
    html = F.concat(
        F.lit("<table><tr><td>decoy</td></tr></table>"),
        F.lit("<table><tr><th>a</th><th>b</th></tr><tr><td>1</td><td>2</td></tr></table>"),
        F.lit(f"<table><tr><th>{ZW}part_no</th><th> part{ZW} </th></tr>"), rows,
        F.lit("</table>"), F.coalesce(F.col("html"), F.lit("")))
    return pages.select("page_id", html.alias("html"))


def html_table_extract(spark, d):
    """Third table of every page, header names cleaned, columns by name."""
    _start(spark)
    pages = pages_with_tables(table(spark, d, "pages"))
    rows = extract_tables(pages, "html", keep=["page_id"], table_index=2)
    return table_columns(rows, {"part_no": "part_no", "part": "part"}, keep=["page_id"])


def _orders_partitioned(spark, d, name):
    orders = table(spark, d, "orders")
    out = orders.select("o_orderkey", "o_totalprice",
                        F.year("o_orderdate").alias("ano"),
                        map_labels("o_orderstatus", STATUS_LABELS, "Não informado").alias("label"))
    path = scratch_path(spark, name)
    sinks.write_parquet(out, path, partition_by=["ano", "label"], rebalance=True)
    schema = "o_orderkey bigint, o_totalprice double, ano int, label string"
    return read_parquet(spark, path, schema=schema)


def partitioned_roundtrip(spark, d):
    """Parquet partitioned by year and an accented label, typed read-back."""
    _start(spark)
    return _orders_partitioned(spark, d, "partitioned_roundtrip")


def partition_pruned_read(spark, d):
    """Filters on partition columns prune folders (PartitionFilters)."""
    _start(spark)
    df = _orders_partitioned(spark, d, "partition_pruned_read")
    return df.where((F.col("ano") == 1997) & (F.col("label") == "Março"))


def parquet_overwrite(spark, d):
    """K3: a second overwrite replaces the first table."""
    _start(spark)
    customer = table(spark, d, "customer")
    path = scratch_path(spark, "parquet_overwrite")
    sinks.write_parquet(customer, path)
    sinks.write_parquet(customer.where(F.col("c_mktsegment") == "BUILDING"), path)
    return read_parquet(spark, path)


def row_count(spark, d):
    """A3: a global count."""
    _start(spark)
    return table(spark, d, "lineitem").agg(F.count(F.lit(1)).alias("n"))


def row_count_footers(spark, d):
    """A3: a count that reads no column, from the Parquet footers."""
    _start(spark)
    return footer_count(spark, f"{d.rstrip('/')}/lineitem.parquet")


def write_count(spark, d):
    """K4: the rows observed during a write, next to the count of what was
    written."""
    _start(spark)
    path = scratch_path(spark, "write_count")
    n = sinks.write_parquet(table(spark, d, "lineitem"), path, count=True)
    return read_parquet(spark, path).agg(F.lit(n).cast("long").alias("observed"),
                                         F.count(F.lit(1)).alias("n"))


# -- projections, cleaning, labels ---------------------------------------------

def select_rename(spark, d):
    """P1 P2."""
    _start(spark)
    return select_renamed(table(spark, d, "orders"), {
        "o_orderkey": "order_id", "o_orderdate": "ordered_at", "o_totalprice": "total"})


def clean_headers_q(spark, d):
    """Column names with zero-width spaces."""
    _start(spark)
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    return clean_headers(orders.toDF(f"{ZW}o_orderkey{ZW}", f"o_orderstatus{ZW}"))


def filter_sentinel(spark, d):
    """Numeric fill with a sentinel, then filter on it."""
    _start(spark)
    li = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.nullif(F.col("l_discount"), F.lit(0.0)).alias("l_discount"))
    li = cleaning.fill_nulls(li, -1, ["l_discount"], strict=True)
    return li.where(F.col("l_discount") == -1)


def fill_nulls_q(spark, d):
    """String and numeric fills."""
    _start(spark)
    o = table(spark, d, "orders").select(
        "o_orderkey", F.nullif(F.col("o_orderstatus"), F.lit("F")).alias("o_orderstatus"),
        F.when(F.col("o_totalprice") >= 50000, F.col("o_totalprice")).alias("o_totalprice"))
    o = cleaning.fill_nulls(o, "Não informado", ["o_orderstatus"], strict=True)
    return cleaning.fill_nulls(o, -1, ["o_totalprice"], strict=True)


def replace_values_q(spark, d):
    """N3."""
    _start(spark)
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    return cleaning.replace_values(o, {"F": "Final", "O": "Open"}, ["o_orderstatus"])


def month_label(spark, d):
    """Zero-padded month text -> month name; text that is no number and
    null give the default."""
    _start(spark)
    turn = F.pmod(F.col("o_orderkey"), F.lit(5))
    o = table(spark, d, "orders").select(
        "o_orderkey", F.when(turn == 1, F.lit("x1")).when(
            turn != 2, F.date_format("o_orderdate", "MM")).alias("mes"))
    return enrich.label_column(o, "mes", airport.MONTH_LABELS, airport.MONTH_DEFAULT,
                               key_type="int")


def code_label(spark, d):
    """N5."""
    _start(spark)
    li = table(spark, d, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_partkey",
                     map_labels("l_returnflag", RETURN_LABELS, "Não informada").alias("natureza"))


def directional_endpoints_q(spark, d):
    """E4 N6."""
    _start(spark)
    li = table(spark, d, "lineitem")
    li = enrich.directional_endpoints(li, "l_returnflag", own="l_partkey", other="l_suppkey",
                                      out_from="from_key", out_to="to_key",
                                      outbound="A", inbound="R")
    return li.select("l_orderkey", "l_linenumber", "from_key", "to_key")


# -- joins ---------------------------------------------------------------------

def left_join_dimension(spark, d):
    """Every customer kept; nations 20.. absent from the dimension."""
    _start(spark)
    customer = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, d, "nation").where(F.col("n_nationkey") < 20).select(
        "n_nationkey", "n_name")
    return joins.lookup(customer, nation, "c_nationkey", "n_nationkey")


def _orders_with_customer(orders: DataFrame, customer: DataFrame, orders_small: bool,
                          customer_small: bool) -> tuple[DataFrame, bool]:
    """Customer attributes joined onto orders *before* they meet the line items.

    Orders are ~1/4 of the line items, so with big dimensions shuffling orders
    twice (by customer, then by order key) costs less than shuffling the line
    items by customer key.  The joined frame is never measured: a left join on
    the customers' key keeps the rows of orders, so it is small if both are.
    """
    oc = joins.lookup(orders, customer, "o_custkey", "c_custkey", small=customer_small)
    return oc, orders_small and customer_small


HOT_PART = "hot"


def lookup_null_and_hot_keys(spark, d):
    """J1 on the shuffle path: a third of the keys null, a third one hot value."""
    _start(spark)
    turn = F.pmod(F.col("l_orderkey"), F.lit(3))
    li = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.when(turn == 1, F.lit(HOT_PART)).when(turn == 2, F.col("l_partkey").cast("string"))
        .alias("k"))
    part = table(spark, d, "part").select(F.col("p_partkey").cast("string").alias("part_key"),
                                          "p_name")
    dim = part.union(spark.createDataFrame([(HOT_PART, "the hot part")], part.schema))
    return joins.lookup(li, dim, "k", "part_key", broadcast=False, hot_keys=[HOT_PART])


def lookup_measured_hot_keys(spark, d):
    """J1 on the shuffle path with hot keys that nobody listed: a third of the line items
    fall on one part and a sixth on another; the join finds both in the data."""
    _start(spark)
    turn = F.pmod(F.col("l_orderkey"), F.lit(6))
    li = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.when(turn < 2, F.lit(1)).when(turn == 2, F.lit(2)).when(turn < 5, F.col("l_partkey"))
        .cast("bigint").alias("k"))
    part = table(spark, d, "part").select(F.col("p_partkey").cast("bigint").alias("part_key"), "p_name")
    return joins.lookup(li, part, "k", "part_key", broadcast=False, hot_keys="measure")


def lookup_pruned_dimension(spark, d):
    """J1 on the shuffle path where few dimension rows are referred to: orders of one
    status, looked up in all customers; a filter of the orders' keys cuts the customers
    before they are shuffled."""
    _start(spark)
    orders = table(spark, d, "orders").select("o_orderkey", F.when(
        F.col("o_custkey") % 10 == 0, F.col("o_custkey")).alias("o_custkey"))
    customer = table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return joins.lookup(orders, customer, "o_custkey", "c_custkey", broadcast=False, prune=True)


def lookup_colocated(spark, d):
    """J1 without an exchange: line items and parts stored in buckets of the part key, a third
    of the line items on one part and some without any."""
    _start(spark)
    base = scratch_path(spark, "lookup_colocated")
    turn = F.pmod(F.col("l_orderkey"), F.lit(6))
    li = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_partkey").cast("bigint").alias("l_partkey"),
        F.when(turn < 2, F.lit(1)).when(turn < 5, F.col("l_partkey")).cast("bigint").alias("k"))
    part = table(spark, d, "part").select(F.col("p_partkey").cast("bigint").alias("part_key"), "p_name")
    hot = joins.heavy_keys(li, "k")[0]
    name = "tidylake_" + base.rsplit("-", 1)[1]
    fact = colocated.store_fact(li, f"{name}_fact", "k", 16, f"{base}/fact", hot)
    dim = colocated.store_dimension(part, f"{name}_dim", "part_key", 16, f"{base}/dim", hot)
    return colocated.lookup(fact, dim, "k", "part_key")


def left_join_unique_dimension(spark, d):
    """J1 with D9: a dimension holding every key twice (two spellings of the
    name); ``unique=True`` keeps one deterministic row per key, so the fact
    rows are not multiplied."""
    _start(spark)
    customer = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, d, "nation").select("n_nationkey", "n_name")
    doubled = union_by_name([nation, nation.select(
        "n_nationkey", F.lower("n_name").alias("n_name"))])
    return joins.lookup(customer, doubled, "c_nationkey", "n_nationkey", unique=True)


def _nation_role(role: str):
    return {"n_nationkey": f"{role}_nationkey", "n_name": f"nation_{role}"}


def role_playing_join(spark, d):
    """One nation dimension in two roles (customer's, supplier's)."""
    _start(spark)
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey",
                                            "l_suppkey")
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    customer = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    supplier = table(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    nation = table(spark, d, "nation").select("n_nationkey", "n_name")
    o_s, c_s, s_s, n_s = joins.measure(orders, customer, supplier, nation)
    oc, oc_s = _orders_with_customer(orders, customer, o_s, c_s)
    x = joins.lookup(li, oc, "l_orderkey", "o_orderkey", small=oc_s)
    x = joins.lookup(x, supplier, "l_suppkey", "s_suppkey", small=s_s)
    x = joins.role_lookup(x, nation, "c_nationkey", "n_nationkey", _nation_role("from"),
                          small=n_s)
    x = joins.role_lookup(x, nation, "s_nationkey", "n_nationkey", _nation_role("to"),
                          small=n_s)
    return x.select("l_orderkey", "l_linenumber", "l_partkey", "nation_from", "nation_to")


# -- dedup, union, scalar functions -------------------------------------------

def dedup_subset(spark, d):
    """A1: one row per (order, line); survivor = smallest by the other columns."""
    _start(spark)
    return dedup.by_key(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


def dedup_rare_keys(spark, d):
    """A1 in two phases: keys almost unique, one in a hundred orders there twice."""
    _start(spark)
    orders = table(spark, d, "orders")
    again = orders.where(F.col("o_orderkey") % 100 == 0).withColumn(
        "o_totalprice", F.col("o_totalprice") - 1)
    return dedup.by_rare_key(union_by_name([orders, again]), ["o_orderkey"], ["o_totalprice"])


def dedup_rows(spark, d):
    """A2: whole rows, every line item there twice."""
    _start(spark)
    li = table(spark, d, "lineitem")
    return dedup.rows(union_by_name([li, li]))


def dedup_null_keys(spark, d):
    """A1: null keys count as one key value."""
    _start(spark)
    o = table(spark, d, "orders").withColumn(
        "o_custkey", F.when(F.col("o_custkey") % 3 != 0, F.col("o_custkey")))
    return dedup.by_key(o, ["o_custkey"], ["o_orderkey"])


def union_by_name_q(spark, d):
    """Two overlapping parts that together hold all orders, in different column
    orders; rows in both come out twice."""
    _start(spark)
    orders = table(spark, d, "orders")
    a = orders.where(F.col("o_orderkey") % 3 != 0)
    b = orders.where(F.col("o_orderkey") % 3 < 2).select(*reversed(orders.columns))
    return union_by_name([a, b])


def clean_keys(spark, d):
    """Zero-width spaces and blanks around a key."""
    _start(spark)
    parts = table(spark, d, "part").select(
        "p_partkey", F.concat(F.lit(f" {ZW}"), F.col("p_name"), F.lit(f"{ZW}  ")).alias("p_key"))
    return cleaning.clean_columns(parts, ["p_key"])


def weekday_label(spark, d):
    """E3 C3."""
    _start(spark)
    o = table(spark, d, "orders")
    o = enrich.weekday_column(o, "o_orderdate", airport.WEEKDAY_LABELS, "dia_semana",
                              airport.WEEKDAY_DEFAULT)
    return o.select("o_orderkey", "dia_semana")


def date_range_flag(spark, d):
    """E1 F2 F5."""
    _start(spark)
    o = table(spark, d, "orders")
    o = enrich.date_range_flag(o, "o_orderdate", "1996-03-20", "1998-04-22", "in_range")
    return o.select("o_orderkey", "in_range")


def date_range_whole_days(spark, d):
    """E1 with D10: a range over timestamps with a time of day, last day
    included entirely."""
    _start(spark)
    ev = enrich.date_range_flag(table(spark, d, "events"), "ts", "2024-01-10", "2024-01-20",
                                "in_range", whole_days=True)
    return ev.select("event_id", "in_range")


def delay_flag(spark, d):
    """Minutes late against the start of the hour, per event type."""
    _start(spark)
    ev = table(spark, d, "events").withColumn("planned", F.date_trunc("hour", "ts"))
    ev = enrich.delay_flag(ev, actual="ts", planned="planned", category="event_type",
                           thresholds={"click": 30, "view": 45}, out="late")
    return ev.select("event_id", "late")


# -- layered flows on the driver's tables -------------------------------------

ORDER_STATUS_LABELS = {"O": "Doméstico", "P": "Internacional"}


def silver_movements(spark, d):
    """L1: orders as raw `;` CSVs in two layouts (found from the headers) ->
    silver (fills, labels, dedup, partitioned write) -> typed read-back."""
    _start(spark)
    orders = table(spark, d, "orders")
    raw = orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                        "o_orderdate", F.year("o_orderdate").cast("string").alias("ANO"),
                        F.date_format("o_orderdate", "MM").alias("MES"))
    base = scratch_path(spark, "silver_movements")
    odd = F.coalesce(_variant_month(), F.lit(False))
    variant_order = list(reversed(raw.columns))
    sinks.write_csv(raw.where(~odd), f"{base}/raw/default", sep=";")
    sinks.write_csv(raw.where(odd).select(*variant_order), f"{base}/raw/variant", sep=";")
    schema = make_schema([(f.name, f.dataType) for f in raw.schema.fields])
    rename = {"o_orderkey": "o_orderkey", "o_custkey": "o_custkey", "o_orderstatus": "status",
              "o_totalprice": "o_totalprice", "o_orderdate": "o_orderdate", "ANO": "ano",
              "MES": "mes"}
    # layouts found from the files' header lines, not declared per folder
    layouts = discover_layouts(spark, f"{base}/raw", schema, rename, sep=";")
    bronze = read_layouts(spark, layouts, sep=";", null_value="null", strict_header=True)
    silver = refine_fact(
        bronze,
        fills=[("Não informado", ["status"]), ("Ano não informado", ["ano"])],
        labels=[LabelRule("status", ORDER_STATUS_LABELS, "Não informado"),
                LabelRule("mes", airport.MONTH_LABELS, airport.MONTH_DEFAULT, key_type="int")],
        dedup_keys=["o_custkey", "o_orderdate"], dedup_order=["o_orderkey"], strict_fills=True)
    sinks.write_parquet(silver, f"{base}/silver", partition_by=["ano", "mes"], rebalance=True)
    back = read_parquet(spark, f"{base}/silver", schema=(
        "o_orderkey bigint, o_custkey bigint, status string, o_totalprice double, "
        "o_orderdate timestamp_ntz, ano int, mes string"))
    return back.select("o_orderkey", "o_custkey", "status", "o_totalprice", "o_orderdate",
                       "ano", "mes")


def silver_dimension(spark, d):
    """L2 L3: a lookup table as dirty CSV (decorated headers and keys, rows
    twice) -> silver (header clean-up, rename, key clean-up, dedup)."""
    _start(spark)
    part = table(spark, d, "part")
    dirty = part.select(
        F.concat(F.lit(f"{ZW} "), F.col("p_partkey").cast("string"), F.lit(ZW)).alias(f"{ZW}code"),
        F.col("p_name").alias(f"name{ZW}"), F.lit("dropped").alias("note"))
    base = scratch_path(spark, "silver_dimension")
    sinks.write_csv(dirty, f"{base}/raw")
    sinks.write_csv(dirty, f"{base}/raw", mode="append")
    raw = read_csv(spark, f"{base}/raw")
    silver = refine_dimension(raw, {"code": "code", "name": "part_name"},
                              key_columns=["code"])
    sinks.write_parquet(silver, f"{base}/silver")
    return read_parquet(spark, f"{base}/silver")


ORDER_YEARS = [str(y) for y in range(1992, 1999)]
_SILVER_ORDERS = "o_orderkey bigint, o_custkey bigint, o_totalprice double, ano string, mes string"


def _order_year_files(spark, d, base: str) -> tuple[object, dict]:
    """Orders as raw CSVs below ``base/{year}``, years outside the range in the nearest: rows
    of odd years (some without a year) also in the next folder, half of the years in the
    reverse column order; the folder of 1997 for a start with rows of its own. Their schema
    and renaming."""
    y = F.greatest(F.lit(1992), F.least(F.lit(1998), F.coalesce(F.year("o_orderdate"), F.lit(1992))))
    raw = table(spark, d, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice",
        F.when(F.col("o_orderkey") % 7 != 0, F.year("o_orderdate")).cast("string").alias("ANO"),
        F.date_format("o_orderdate", "MM").alias("MES"), y.alias("y"))
    for i, year in enumerate(map(int, ORDER_YEARS)):
        rows = raw.where((F.col("y") == year) | ((F.col("y") == year - 1) & (F.col("y") % 2 == 1)
                                                 & (F.col("o_orderkey") % 2 == 0))).drop("y")
        rows = rows.select(*reversed(rows.columns)) if i % 2 else rows
        sinks.write_csv(rows, f"{base}/{year}", sep=";")
        if year == 1997:  # files that will disappear: rows of a partition of their own
            lost = rows.withColumns({"ANO": F.lit("1900"), "o_orderkey": -F.col("o_orderkey")})
            sinks.write_csv(lost.select(*rows.columns), f"{base}/{year}/late", sep=";")
    schema = make_schema([(f.name, f.dataType) for f in raw.drop("y").schema.fields])
    rename = {"o_orderkey": "o_orderkey", "o_custkey": "o_custkey",
              "o_totalprice": "o_totalprice", "ANO": "ano", "MES": "mes"}
    return schema, rename


def _order_run(spark, base: str, schema, rename, only=None):
    """A run, or a re-run of some years, of the order years below ``base`` with a ledger."""
    def read(paths):
        raw = read_mixed(spark, paths, schema, rename, sep=";", null_value="null", file="__file")
        return refine_fact(
            raw, fills=[("Ano não informado", ["ano"])],
            labels=[LabelRule("mes", airport.MONTH_LABELS, airport.MONTH_DEFAULT, key_type="int")],
            strict_fills=True)

    return ledger.run(spark, f"{base}/silver", f"{base}/ledger",
                      {y: f"{base}/raw/{y}" for y in ORDER_YEARS}, read, ["ano", "mes"],
                      ["o_orderkey"], only=only, file="__file")


def silver_movements_rerun(spark, d):
    """L1 with D15: a full run over all order years, whose folders share partitions (rows
    without a year, rows in the next year's folder) and lie in two layouts; then files of
    one year disappear and that year is re-run by the ledger. The table must be that of a
    full run without them, partitions that nothing feeds any more included."""
    _start(spark)
    base = scratch_path(spark, "silver_movements_rerun")
    schema, rename = _order_year_files(spark, d, f"{base}/raw")
    _order_run(spark, base, schema, rename)
    # the late files are replaced by one without rows
    empty = spark.createDataFrame([], schema)
    sinks.write_csv(empty.coalesce(1), f"{base}/raw/1997/late", sep=";")
    _order_run(spark, base, schema, rename, only=["1997"])
    return read_parquet(spark, f"{base}/silver", schema=_SILVER_ORDERS)


def gold_changed_partitions(spark, d):
    """L4 incremental: gold from a first silver table; then a year's files disappear, silver is
    re-run by its ledger, and gold is brought up to date from the changed partitions only
    (pruned at run time). The result is that of a full run."""
    _start(spark)
    base = scratch_path(spark, "gold_changed")
    schema, rename = _order_year_files(spark, d, f"{base}/raw")
    _order_run(spark, base, schema, rename)
    customer = table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    small = joins.checked_broadcast(customer)
    parts = ["ano", "mes"]

    def enriched(silver):
        gold = joins.lookup(silver, customer, "o_custkey", "c_custkey", small=small)
        return gold.select("o_orderkey", "o_totalprice", "c_mktsegment", "ano", "mes")

    def silver():
        return read_parquet(spark, f"{base}/silver", schema=_SILVER_ORDERS)

    sinks.write_parquet(enriched(silver()), f"{base}/gold", parts, rebalance=not small)
    sinks.write_csv(spark.createDataFrame([], schema).coalesce(1), f"{base}/raw/1997/late", sep=";")
    done = _order_run(spark, base, schema, rename, only=["1997"])
    ledger.log_changes("second", done.changed, f"{base}/changes")
    changed = spark.read.schema("ano string, mes string, run string").parquet(
        f"{base}/changes").where(F.col("run") == "second")
    touched = changed_only(silver(), changed, parts)
    ledger.drop_partitions(spark, f"{base}/gold", ledger.outside(
        done.changed, touched.select(*parts).distinct(), parts), parts)
    sinks.write_parquet(enriched(touched), f"{base}/gold", parts, rebalance=not small, dynamic=True)
    return read_parquet(spark, f"{base}/gold", schema=(
        "o_orderkey bigint, o_totalprice double, c_mktsegment string, ano string, mes string"))


def silver_incremental(spark, d):
    """A1 in the incremental ingest: orders arrive in three drops that overlap; keys seen
    before are found in the stream's keyed state, and the first drop's row of a key stays."""
    _start(spark)
    base = scratch_path(spark, "silver_incremental")
    orders = table(spark, d, "orders").select(
        "o_orderkey", F.col("o_custkey").cast("string").alias("o_custkey"), "o_totalprice",
        F.year("o_orderdate").cast("string").alias("ANO"))
    schema = make_schema([(f.name, f.dataType) for f in orders.schema.fields])
    rename = {"o_orderkey": "o_orderkey", "o_custkey": "cust", "o_totalprice": "price", "ANO": "ano"}
    layout = CsvLayout(f"{base}/raw", schema, rename, glob="*.csv", recursive=True)
    for drop in range(3):
        rows = orders.where(F.col("o_orderkey") % 3 <= drop).withColumn(
            "o_totalprice", F.col("o_totalprice") + drop)
        # every order twice in a drop: the smaller price stays
        sinks.write_csv(rows.union(rows.withColumn("o_totalprice", F.col("o_totalprice") + 0.5)),
                        f"{base}/raw/{drop}", sep=";")
        ingest_keyed(spark, [layout], lambda df: cleaning.fill_nulls(df, "Ano não informado", ["ano"]),
                     f"{base}/silver", ["ano"], ["o_orderkey"], ["price"], sep=";",
                     checkpoint=f"{base}/checkpoint").awaitTermination()
    return read_parquet(spark, f"{base}/silver", schema=(
        "o_orderkey bigint, cust string, price double, ano string"))


def gold_flow(spark, d):
    """L4 as a whole: silver Parquet partitions -> key clean-up -> one lookup and
    two role lookups -> flags -> partitioned write -> read-back."""
    _start(spark)
    base = scratch_path(spark, "gold_flow")
    decorated = lambda c: F.concat(F.lit(f" {ZW}"), F.col(c).cast("string"), F.lit(f"{ZW} "))
    li = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_returnflag", "l_shipdate",
        decorated("l_partkey").alias("part_key"), decorated("l_suppkey").alias("own_key"),
        decorated("l_linenumber").alias("other_key"),
        F.year("l_shipdate").alias("ano"), F.month("l_shipdate").alias("mes"))
    sinks.write_parquet(li, f"{base}/silver", ["ano", "mes"], rebalance=True)
    silver = read_parquet(spark, f"{base}/silver")
    part = table(spark, d, "part").select(decorated("p_partkey").alias("p_key"), "p_name")
    supplier = table(spark, d, "supplier").select(decorated("s_suppkey").alias("s_key"), "s_name")
    silver = cleaning.clean_columns(silver, ["part_key", "own_key", "other_key"])
    part = cleaning.clean_columns(part, ["p_key"])
    supplier = cleaning.clean_columns(supplier, ["s_key"])
    p_s, s_s = joins.measure(part, supplier)
    fact = joins.lookup(silver, part, "part_key", "p_key", small=p_s)
    fact = enrich.weekday_column(fact, "l_shipdate", airport.WEEKDAY_LABELS, "weekday",
                                 airport.WEEKDAY_DEFAULT)
    fact = enrich.date_range_flag(fact, "l_shipdate", SHIPPING_RULES["low"],
                                  SHIPPING_RULES["high"], "in_range")
    fact = enrich.directional_endpoints(fact, "l_returnflag", own="own_key", other="other_key",
                                        out_from="k_from", out_to="k_to",
                                        outbound="A", inbound="R")
    for role in ("from", "to"):
        fact = joins.role_lookup(fact, supplier, f"k_{role}", "s_key",
                                 {"s_key": f"{role}_key", "s_name": f"supplier_{role}"}, small=s_s)
    gold = fact.select("l_orderkey", "l_linenumber", "part_key", "p_name", "weekday", "in_range",
                       "supplier_from", "supplier_to", "ano", "mes")
    sinks.write_parquet(gold, f"{base}/gold", ["ano", "mes"], rebalance=not (p_s and s_s))
    return read_parquet(spark, f"{base}/gold", schema=gold.schema)


def airports_flow(spark, d):
    """L3: a wide CSV under its strict schema -> some columns renamed -> distinct
    rows -> Parquet -> read-back."""
    _start(spark)
    base = scratch_path(spark, "airports_flow")
    li = table(spark, d, "lineitem")
    sinks.write_csv(li, f"{base}/raw", sep=",")
    sinks.write_csv(li, f"{base}/raw", sep=",", mode="append")
    raw = read_csv(spark, f"{base}/raw", schema=li.schema, strict_header=True)
    silver = dedup.rows(select_renamed(raw, {
        "l_orderkey": "order_id", "l_partkey": "part_id", "l_quantity": "quantity",
        "l_returnflag": "flag"}))
    sinks.write_parquet(silver, f"{base}/silver", count=True)
    return read_parquet(spark, f"{base}/silver")


def page_to_csv_flow(spark, d):
    """The third table of every page -> CSV -> all string read-back -> clean-up ->
    Parquet -> read-back."""
    _start(spark)
    base = scratch_path(spark, "page_to_csv_flow")
    rows = extract_tables(pages_with_tables(table(spark, d, "pages")), "html", keep=["page_id"],
                          table_index=2)
    sinks.write_csv(table_columns(rows, {"part_no": "part_no", "part": "part"}, keep=["page_id"],
                                  required=True), f"{base}/raw")
    silver = refine_dimension(read_csv(spark, f"{base}/raw"),
                              {"page_id": "page_id", "part_no": "no", "part": "part"},
                              key_columns=["part"])
    sinks.write_parquet(silver, f"{base}/silver")
    return read_parquet(spark, f"{base}/silver")


def single_file_check_flow(spark, d):
    """One `;` CSV under its strict schema -> rename -> numeric and text fills
    -> value replacement -> rows whose amount was missing."""
    _start(spark)
    base = scratch_path(spark, "single_file_check_flow")
    orders = table(spark, d, "orders").select(
        "o_orderkey", F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("o_orderstatus"),
        F.when(F.col("o_orderkey") % 4 != 0, F.col("o_totalprice")).alias("o_totalprice"),
        F.month("o_orderdate").cast("string").alias("MES"))
    sinks.write_csv(orders, base, sep=";")
    raw = read_csv(spark, base, schema=orders.schema, sep=";", strict_header=True)
    df = select_renamed(raw, {"o_orderkey": "order_id", "o_orderstatus": "status",
                              "o_totalprice": "total", "MES": "mes"})
    df = cleaning.fill_nulls(df, -1, ["total"])
    df = cleaning.fill_nulls(df, "Não informado", ["status"])
    df = cleaning.replace_values(df, {"1": "Janeiro"}, ["mes"])
    return df.where(F.col("total") == -1)


SHIPPING_RULES = dict(low="1996-03-20", high="1998-04-22",
                          delay_minutes={"A": 43200, "R": 86400})


def gold_enriched(spark, d):
    """L4 (flagship): line items enriched with a part lookup, weekday, range and
    delay flags, direction-dependent endpoints and the nation in both roles."""
    _start(spark)
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey",
                                            "l_suppkey", "l_returnflag", "l_shipdate")
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customer = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    supplier = table(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    part = table(spark, d, "part").select("p_partkey", "p_name")
    nation = table(spark, d, "nation").select("n_nationkey", "n_name")

    o_s, c_s, s_s, p_s, n_s = joins.measure(orders, customer, supplier, part, nation)
    oc, oc_s = _orders_with_customer(orders, customer, o_s, c_s)
    fact = joins.lookup(li, oc, "l_orderkey", "o_orderkey", small=oc_s)
    fact = joins.lookup(fact, supplier, "l_suppkey", "s_suppkey", small=s_s)
    fact = joins.lookup(fact, part, "l_partkey", "p_partkey", small=p_s)
    fact = enrich.weekday_column(fact, "l_shipdate", airport.WEEKDAY_LABELS, "weekday",
                                 airport.WEEKDAY_DEFAULT)
    fact = enrich.date_range_flag(fact, "l_shipdate", SHIPPING_RULES["low"],
                                  SHIPPING_RULES["high"], "in_range")
    fact = enrich.delay_flag(fact, actual="l_shipdate", planned="o_orderdate",
                             category="l_returnflag",
                             thresholds=SHIPPING_RULES["delay_minutes"], out="late")
    fact = enrich.directional_endpoints(fact, "l_returnflag", own="c_nationkey",
                                        other="s_nationkey", out_from="k_from", out_to="k_to",
                                        outbound="A", inbound="R")
    fact = joins.role_lookup(fact, nation, "k_from", "n_nationkey", _nation_role("from"),
                             small=n_s)
    fact = joins.role_lookup(fact, nation, "k_to", "n_nationkey", _nation_role("to"),
                             small=n_s)
    return fact.select("l_orderkey", "l_linenumber", "l_partkey", "p_name", "weekday",
                       "in_range", "late", "nation_from", "nation_to")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "csv_scan_typed": csv_scan_typed,
    "csv_scan_variant_union": csv_scan_variant_union,
    "csv_scan_mixed_layouts": csv_scan_mixed_layouts,
    "csv_scan_positional": csv_scan_positional,
    "csv_scan_rejects": csv_scan_rejects,
    "csv_scan_header_strings": csv_scan_header_strings,
    "file_discovery": file_discovery,
    "csv_write_roundtrip": csv_write_roundtrip,
    "html_table_extract": html_table_extract,
    "partitioned_roundtrip": partitioned_roundtrip,
    "partition_pruned_read": partition_pruned_read,
    "parquet_overwrite": parquet_overwrite,
    "row_count": row_count,
    "row_count_footers": row_count_footers,
    "write_count": write_count,
    "select_rename": select_rename,
    "clean_headers": clean_headers_q,
    "filter_sentinel": filter_sentinel,
    "fill_nulls": fill_nulls_q,
    "replace_values": replace_values_q,
    "month_label": month_label,
    "code_label": code_label,
    "directional_endpoints": directional_endpoints_q,
    "left_join_dimension": left_join_dimension,
    "left_join_unique_dimension": left_join_unique_dimension,
    "lookup_null_and_hot_keys": lookup_null_and_hot_keys,
    "lookup_measured_hot_keys": lookup_measured_hot_keys,
    "lookup_pruned_dimension": lookup_pruned_dimension,
    "lookup_colocated": lookup_colocated,
    "role_playing_join": role_playing_join,
    "dedup_subset": dedup_subset,
    "dedup_null_keys": dedup_null_keys,
    "dedup_rare_keys": dedup_rare_keys,
    "dedup_rows": dedup_rows,
    "union_by_name": union_by_name_q,
    "clean_keys": clean_keys,
    "weekday_label": weekday_label,
    "date_range_flag": date_range_flag,
    "date_range_whole_days": date_range_whole_days,
    "delay_flag": delay_flag,
    "silver_movements": silver_movements,
    "silver_movements_rerun": silver_movements_rerun,
    "silver_incremental": silver_incremental,
    "silver_dimension": silver_dimension,
    "gold_changed_partitions": gold_changed_partitions,
    "gold_flow": gold_flow,
    "airports_flow": airports_flow,
    "page_to_csv_flow": page_to_csv_flow,
    "single_file_check_flow": single_file_check_flow,
    "gold_enriched": gold_enriched,
}

def _sql_list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


# SQL arrays built from the fixed labels of the airport configuration
_MONTHS = _sql_list(airport.MONTH_LABELS[m] for m in range(1, 13))
_WEEKDAYS_ISO = _sql_list(airport.WEEKDAY_LABELS[d] for d in (
    "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"))

ORACLE_SQL: dict[str, str] = {
    "csv_scan_typed": "SELECT * FROM orders",
    "csv_scan_variant_union": "SELECT * FROM orders",
    "csv_scan_header_strings": (
        "SELECT o_orderkey::VARCHAR AS o_orderkey, o_custkey::VARCHAR AS o_custkey, "
        "o_orderstatus FROM orders"),
    "file_discovery": "SELECT * FROM orders WHERE o_orderkey % 5 <> 4",
    "csv_write_roundtrip": "SELECT * FROM supplier",
    "html_table_extract": (
        "SELECT page_id, i::VARCHAR AS part_no, NULLIF(parts[i], '') AS part FROM ("
        "SELECT page_id, string_split(url, '/') AS parts, "
        "unnest(generate_series(1, len(string_split(url, '/')))) AS i FROM pages)"),
    "partitioned_roundtrip": (
        "SELECT o_orderkey, o_totalprice, year(o_orderdate)::INTEGER AS ano, "
        "CASE o_orderstatus WHEN 'F' THEN 'Março' WHEN 'O' THEN 'Aberto' "
        "ELSE 'Não informado' END AS label FROM orders"),
    "partition_pruned_read": (
        "SELECT o_orderkey, o_totalprice, year(o_orderdate)::INTEGER AS ano, 'Março' AS label "
        "FROM orders WHERE year(o_orderdate) = 1997 AND o_orderstatus = 'F'"),
    "parquet_overwrite": "SELECT * FROM customer WHERE c_mktsegment = 'BUILDING'",
    "row_count": "SELECT count(*) AS n FROM lineitem",
    "select_rename": (
        "SELECT o_orderkey AS order_id, o_orderdate AS ordered_at, o_totalprice AS total "
        "FROM orders"),
    "write_count": "SELECT count(*) AS observed, count(*) AS n FROM lineitem",
    "clean_headers": "SELECT o_orderkey, o_orderstatus FROM orders",
    "filter_sentinel": (
        "SELECT l_orderkey, l_linenumber, l_partkey, "
        "coalesce(nullif(l_discount, 0.0), -1.0) AS l_discount FROM lineitem "
        "WHERE coalesce(nullif(l_discount, 0.0), -1.0) = -1.0"),
    "fill_nulls": (
        "SELECT o_orderkey, coalesce(nullif(o_orderstatus, 'F'), 'Não informado') AS "
        "o_orderstatus, CASE WHEN o_totalprice < 50000 THEN -1.0 ELSE o_totalprice END AS "
        "o_totalprice FROM orders"),
    "replace_values": (
        "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'Final' WHEN 'O' THEN 'Open' "
        "ELSE o_orderstatus END AS o_orderstatus FROM orders"),
    "month_label": (
        "SELECT o_orderkey, CASE WHEN o_orderkey % 5 NOT IN (1, 2) THEN coalesce(" + _MONTHS +
        "[month(o_orderdate)], '" + airport.MONTH_DEFAULT + "') ELSE '" + airport.MONTH_DEFAULT +
        "' END AS mes FROM orders"),
    "code_label": (
        "SELECT l_orderkey, l_linenumber, l_partkey, CASE l_returnflag WHEN 'A' THEN "
        "'Doméstico' WHEN 'R' THEN 'Internacional' ELSE 'Não informada' END AS natureza "
        "FROM lineitem"),
    "directional_endpoints": (
        "SELECT l_orderkey, l_linenumber, CASE l_returnflag WHEN 'A' THEN l_partkey "
        "WHEN 'R' THEN l_suppkey END AS from_key, CASE l_returnflag WHEN 'R' THEN l_partkey "
        "WHEN 'A' THEN l_suppkey END AS to_key FROM lineitem"),
    "left_join_dimension": (
        "SELECT c_custkey, c_nationkey, n_nationkey, n_name FROM customer LEFT JOIN "
        "(SELECT * FROM nation WHERE n_nationkey < 20) ON c_nationkey = n_nationkey"),
    "left_join_unique_dimension": (
        "SELECT c_custkey, c_nationkey, n_nationkey, n_name FROM customer LEFT JOIN "
        "(SELECT n_nationkey, min(n_name) AS n_name FROM (SELECT n_nationkey, n_name FROM nation "
        "UNION ALL SELECT n_nationkey, lower(n_name) FROM nation) GROUP BY n_nationkey) "
        "ON c_nationkey = n_nationkey"),
    "role_playing_join": (
        "SELECT l_orderkey, l_linenumber, l_partkey, cn.n_name AS nation_from, "
        "sn.n_name AS nation_to FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey "
        "LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN supplier ON "
        "l_suppkey = s_suppkey LEFT JOIN nation cn ON c_nationkey = cn.n_nationkey "
        "LEFT JOIN nation sn ON s_nationkey = sn.n_nationkey"),
    "dedup_subset": (
        "SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, "
        "l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, "
        "l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) = 1"),
    "dedup_null_keys": (
        "SELECT * REPLACE (CASE WHEN o_custkey % 3 <> 0 THEN o_custkey END AS o_custkey) "
        "FROM orders QUALIFY row_number() OVER (PARTITION BY CASE WHEN o_custkey % 3 <> 0 THEN o_custkey END ORDER BY o_orderkey) = 1"),
    "dedup_rows": "SELECT DISTINCT * FROM lineitem",
    "union_by_name": (
        "SELECT * FROM orders WHERE o_orderkey % 3 <> 0 UNION ALL "
        "SELECT * FROM orders WHERE o_orderkey % 3 < 2"),
    "clean_keys": "SELECT p_partkey, trim(p_name) AS p_key FROM part",
    "lookup_null_and_hot_keys": (
        "WITH l AS (SELECT l_orderkey, l_linenumber, l_partkey, CASE l_orderkey % 3 WHEN 1 THEN "
        "'hot' WHEN 2 THEN l_partkey::VARCHAR END AS k FROM lineitem), "
        "p AS (SELECT p_partkey::VARCHAR AS part_key, p_name FROM part "
        "UNION ALL SELECT 'hot', 'the hot part') "
        "SELECT * FROM l LEFT JOIN p ON k = part_key"),
    "silver_movements_rerun": (
        "SELECT o_orderkey, o_custkey, o_totalprice, coalesce(CASE WHEN o_orderkey % 7 <> 0 THEN "
        "year(o_orderdate)::VARCHAR END, 'Ano não informado') AS ano, coalesce(" + _MONTHS +
        "[month(o_orderdate)], '" + airport.MONTH_DEFAULT + "') AS mes FROM orders"),
    "gold_changed_partitions": (
        "SELECT o_orderkey, o_totalprice, c_mktsegment, coalesce(CASE WHEN o_orderkey % 7 <> 0 THEN "
        "year(o_orderdate)::VARCHAR END, 'Ano não informado') AS ano, coalesce(" + _MONTHS +
        "[month(o_orderdate)], '" + airport.MONTH_DEFAULT + "') AS mes FROM orders "
        "LEFT JOIN customer ON o_custkey = c_custkey"),
    "silver_incremental": (
        "SELECT o_orderkey, o_custkey::VARCHAR AS cust, o_totalprice + o_orderkey % 3 AS price, "
        "coalesce(year(o_orderdate)::VARCHAR, 'Ano não informado') AS ano FROM orders"),
    "csv_scan_mixed_layouts": "SELECT * FROM orders",
    "csv_scan_positional": "SELECT * FROM orders",
    "csv_scan_rejects": (
        "WITH r AS (SELECT *, o_orderkey % 13 = 0 AS short, o_orderkey % 11 = 0 AS odd FROM orders), "
        "c AS (SELECT count(*) FILTER (NOT short AND NOT odd) AS n_good, "
        "count(*) FILTER (short OR odd) AS n_bad FROM r) "
        "SELECT o_orderkey, o_orderstatus, CASE WHEN NOT short AND NOT odd THEN o_totalprice END AS "
        "o_totalprice, CASE WHEN short THEN o_orderkey::VARCHAR || ';' || o_orderstatus WHEN odd THEN "
        "o_orderkey::VARCHAR || ';' || o_orderstatus || ';12,x' END AS text, true AS known_file, "
        "n_good, n_bad FROM r, c"),
    "row_count_footers": "SELECT count(*) AS n FROM lineitem",
    "lookup_measured_hot_keys": (
        "WITH l AS (SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_orderkey % 6 < 2 THEN 1 "
        "WHEN l_orderkey % 6 = 2 THEN 2 WHEN l_orderkey % 6 < 5 THEN l_partkey END::BIGINT AS k "
        "FROM lineitem) SELECT l.*, p_partkey::BIGINT AS part_key, p_name FROM l LEFT JOIN part "
        "ON k = p_partkey"),
    "lookup_pruned_dimension": (
        "WITH o AS (SELECT o_orderkey, CASE WHEN o_custkey % 10 = 0 THEN o_custkey END AS o_custkey "
        "FROM orders) SELECT o.*, c_custkey, c_name, c_mktsegment FROM o LEFT JOIN customer "
        "ON o_custkey = c_custkey"),
    "lookup_colocated": (
        "WITH l AS (SELECT l_orderkey, l_linenumber, l_partkey::BIGINT AS l_partkey, CASE WHEN "
        "l_orderkey % 6 < 2 THEN 1 WHEN l_orderkey % 6 < 5 THEN l_partkey END::BIGINT AS k "
        "FROM lineitem) SELECT l.*, p_partkey::BIGINT AS part_key, p_name FROM l LEFT JOIN part "
        "ON k = p_partkey"),
    "dedup_rare_keys": (
        "SELECT * REPLACE (CASE WHEN o_orderkey % 100 = 0 THEN o_totalprice - 1 ELSE o_totalprice "
        "END AS o_totalprice) FROM orders"),
    "gold_flow": (
        "WITH f AS (SELECT *, CASE l_returnflag WHEN 'A' THEN l_suppkey WHEN 'R' THEN "
        "l_linenumber END AS k_from, CASE l_returnflag WHEN 'R' THEN l_suppkey WHEN 'A' THEN "
        "l_linenumber END AS k_to FROM lineitem) "
        "SELECT l_orderkey, l_linenumber, l_partkey::VARCHAR AS part_key, p_name, coalesce(" +
        _WEEKDAYS_ISO + "[isodow(l_shipdate)], '" + airport.WEEKDAY_DEFAULT + "') AS weekday, "
        "coalesce(l_shipdate BETWEEN TIMESTAMP '1996-03-20' AND TIMESTAMP '1998-04-22', false) AS "
        "in_range, a.s_name AS supplier_from, b.s_name AS supplier_to, "
        "year(l_shipdate)::INTEGER AS ano, month(l_shipdate)::INTEGER AS mes "
        "FROM f LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN supplier a ON k_from = "
        "a.s_suppkey LEFT JOIN supplier b ON k_to = b.s_suppkey"),
    "airports_flow": (
        "SELECT DISTINCT l_orderkey AS order_id, l_partkey AS part_id, l_quantity AS quantity, "
        "l_returnflag AS flag FROM lineitem"),
    "page_to_csv_flow": (
        "SELECT DISTINCT page_id::VARCHAR AS page_id, i::VARCHAR AS no, NULLIF(trim(parts[i]), '') "
        "AS part FROM (SELECT page_id, string_split(url, '/') AS parts, "
        "unnest(generate_series(1, len(string_split(url, '/')))) AS i FROM pages)"),
    "single_file_check_flow": (
        "SELECT o_orderkey AS order_id, coalesce(nullif(o_orderstatus, 'P'), 'Não informado') AS "
        "status, -1.0::DOUBLE AS total, CASE month(o_orderdate) WHEN 1 THEN 'Janeiro' ELSE "
        "month(o_orderdate)::VARCHAR END AS mes FROM orders WHERE o_orderkey % 4 = 0 OR "
        "o_totalprice IS NULL"),
    "weekday_label": (
        "SELECT o_orderkey, coalesce(" + _WEEKDAYS_ISO + "[isodow(o_orderdate)], "
        "'" + airport.WEEKDAY_DEFAULT + "') AS dia_semana FROM orders"),
    "date_range_flag": (
        "SELECT o_orderkey, coalesce(o_orderdate BETWEEN TIMESTAMP '1996-03-20' AND "
        "TIMESTAMP '1998-04-22', false) AS in_range FROM orders"),
    "date_range_whole_days": (
        "SELECT event_id, coalesce(ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-21', "
        "false) AS in_range FROM events"),
    "delay_flag": (
        "SELECT event_id, coalesce(((floor(epoch(ts)) - floor(epoch(date_trunc('hour', ts)))) "
        "/ 60 >= 30 AND event_type = 'click') OR ((floor(epoch(ts)) - "
        "floor(epoch(date_trunc('hour', ts)))) / 60 >= 45 AND event_type = 'view'), false) "
        "AS late FROM events"),
    "silver_movements": (
        "SELECT o_orderkey, o_custkey, CASE o_orderstatus WHEN 'O' THEN 'Doméstico' "
        "WHEN 'P' THEN 'Internacional' ELSE 'Não informado' END AS status, o_totalprice, "
        "o_orderdate, year(o_orderdate)::INTEGER AS ano, " + _MONTHS + "[month(o_orderdate)] "
        "AS mes FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderdate "
        "ORDER BY o_orderkey, o_orderstatus, o_totalprice) = 1"),
    "silver_dimension": (
        "SELECT DISTINCT p_partkey::VARCHAR AS code, p_name AS part_name FROM part"),
    "gold_enriched": (
        "WITH f AS (SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag, l_shipdate, "
        "o_orderdate, c_nationkey, s_nationkey FROM lineitem LEFT JOIN orders ON "
        "l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN "
        "supplier ON l_suppkey = s_suppkey), "
        "g AS (SELECT *, CASE l_returnflag WHEN 'A' THEN c_nationkey WHEN 'R' THEN "
        "s_nationkey END AS k_from, CASE l_returnflag WHEN 'R' THEN c_nationkey WHEN 'A' "
        "THEN s_nationkey END AS k_to FROM f) "
        "SELECT l_orderkey, l_linenumber, l_partkey, p_name, coalesce(" + _WEEKDAYS_ISO +
        "[isodow(l_shipdate)], '" + airport.WEEKDAY_DEFAULT + "') AS weekday, coalesce(l_shipdate BETWEEN "
        "TIMESTAMP '1996-03-20' AND TIMESTAMP '1998-04-22', false) AS in_range, "
        "coalesce(((floor(epoch(l_shipdate)) - floor(epoch(o_orderdate))) / 60 >= 43200 AND "
        "l_returnflag = 'A') OR ((floor(epoch(l_shipdate)) - floor(epoch(o_orderdate))) / 60 "
        ">= 86400 AND l_returnflag = 'R'), false) AS late, a.n_name AS nation_from, "
        "b.n_name AS nation_to FROM g LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN "
        "nation a ON k_from = a.n_nationkey LEFT JOIN nation b ON k_to = b.n_nationkey"),
}
