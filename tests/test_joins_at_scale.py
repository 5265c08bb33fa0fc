"""Heavy keys found in the data, pruned dimensions, buckets, two-phase dedup, counts from
footers."""

import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidylake.operators import by_key, by_rare_key, colocated, heavy_keys, joins, lookup, referenced
from tidylake.sources import row_count

N = 30_000


@pytest.fixture(scope="module")
def fact(spark):
    k = (F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 6 == 1, F.lit(None))
         .when(F.col("id") % 12 == 2, F.lit(8)).otherwise(F.col("id") % 1000 + 100))
    return spark.range(N).select(F.col("id"), k.cast("long").alias("k"))


@pytest.fixture(scope="module")
def dim(spark):
    return spark.range(2000).select(F.col("id").alias("dk"), (F.col("id") * 2).alias("v"))


def _partitions_of(df, value):
    return df.where(F.col("k") == value).select(F.spark_partition_id().alias("p")).distinct().count()


def test_heavy_keys(spark, fact):
    assert heavy_keys(fact, "k") == [[7, 8]]
    assert heavy_keys(fact, "k", share=0.3) == [[7]]
    assert heavy_keys(fact, "k", "id") == [[7, 8], []]
    text = fact.select(F.concat(F.lit("é "), F.col("k").cast("string")).alias("a.b`c"))
    assert heavy_keys(text, "a.b`c") == [["é 7", "é 8"]]
    assert heavy_keys(fact.limit(0), "k") == [[]]
    assert heavy_keys(fact.select(F.lit(None).cast("string").alias("k")), "k") == [[]]
    with pytest.raises(ValueError):
        heavy_keys(fact, "k", share=1e-6)


def test_heavy_keys_are_never_missed(spark):
    """Whatever the order and the number of distinct keys, over many partitions."""
    rnd = random.Random(1)
    values = [1] * 400 + [2] * 250 + list(range(10, 12_000))
    rnd.shuffle(values)
    df = spark.createDataFrame([(v,) for v in values], "k int").repartition(16)
    assert heavy_keys(df, "k", share=0.015, tracked=1024)[0] == [1, 2]


def test_measured_hot_key_is_split_on_the_shuffle_path(spark, fact, dim):
    want = rows(fact.join(dim, F.col("k") == F.col("dk"), "left"))
    before = spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        plain = lookup(fact, dim, "k", "dk", broadcast=False)
        measured = lookup(fact, dim, "k", "dk", broadcast=False, hot_keys="measure")
        assert _partitions_of(plain, 7) == 1
        assert _partitions_of(measured, 7) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", before)
    assert rows(measured) == rows(plain) == want
    # a broadcast needs no measuring
    assert rows(lookup(fact, dim, "k", "dk", hot_keys="measure")) == want


def test_referenced_dimension(spark, fact, dim):
    few = fact.where("k < 150")
    kept = referenced(dim, few, "dk", "k", words=256)
    keys = {r.k for r in few.select("k").distinct().collect()}
    found = {r.dk for r in kept.collect()}
    assert keys <= found and len(found) < 150  # none lost, few of the others stay
    assert kept.columns == dim.columns
    assert referenced(dim, few.limit(0), "dk", "k").count() == 0
    # keys of another type, of two columns, and repeated dimension rows
    text = few.select(F.col("k").cast("string").alias("k"), F.lit(1).alias("x"))
    two = dim.select(F.col("dk").cast("string").alias("dk"), F.lit(1).cast("long").alias("y")).union(
        dim.select(F.col("dk").cast("string"), F.lit(1).cast("long")))
    assert keys - {None} <= {int(r.dk) for r in referenced(two, text, ["dk", "y"], ["k", "x"]).collect()}
    wide = referenced(two, text, ["dk", "y"], ["k", "x"], words=4096)
    assert wide.count() < 2 * (len(keys) + 40)


def test_pruned_lookup(spark, fact, dim):
    few = fact.where("k < 150 or k is null")
    for how in ("left", "inner"):
        assert rows(lookup(few, dim, "k", "dk", how, broadcast=False, prune=True)) == rows(
            lookup(few, dim, "k", "dk", how, broadcast=False))
    # joins that keep dimension rows are not pruned
    assert lookup(few, dim, "k", "dk", "right", broadcast=False, prune=True).where("id is null").count() > 0


def test_colocated_join_has_no_exchange(spark, fact, dim, tmp):
    hot = heavy_keys(fact, "k")[0]
    a = colocated.store_fact(fact, "t_fact", "k", 8, f"{tmp}/fact", hot, salts=4)
    b = colocated.store_dimension(dim, "t_dim", "dk", 8, f"{tmp}/dim", hot, salts=4)
    for how in ("left", "inner", "left_semi", "left_anti"):
        df = colocated.lookup(a, b, "k", "dk", how)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "SortMergeJoin" in plan
        assert rows(df) == rows(fact.join(dim, F.col("k") == F.col("dk"), how))
    # the hot key lies in several buckets, and so do the null keys
    files = a.withColumn("f", F.input_file_name())
    for where in ("k = 7", "k is null"):
        assert files.where(where).select("f").distinct().count() > 1
    with pytest.raises(ValueError):
        colocated.lookup(a, b, "k", "dk", "full")
    with pytest.raises(ValueError):
        colocated.lookup(a, b.withColumn("dk", F.col("dk").cast("int")), "k", "dk")
    for t in ("t_fact", "t_dim"):
        spark.sql(f"DROP TABLE {t}")


@pytest.mark.parametrize("keep", ["first", "last"])
def test_two_phase_dedup_keeps_the_same_rows(spark, fact, keep):
    wide = spark.range(5000).select(
        (F.col("id") - F.when(F.col("id") % 50 == 0, 1).otherwise(0)).alias("a"),
        F.when(F.col("id") % 700 != 0, F.lit("x")).alias("b"), F.col("id"), F.lit("w").alias("c"))
    for df, keys in ((wide, ["a"]), (wide, ["a", "b"]), (fact, ["k"]), (fact, ["id", "k"])):
        got = by_rare_key(df, keys, ["id"], keep)
        assert got.columns == df.columns and rows(got) == rows(by_key(df, keys, ["id"], keep))
    assert rows(by_rare_key(fact, ["k"], max_repeated=10)) == rows(by_key(fact, ["k"]))
    assert by_rare_key(wide.limit(0), ["a"]).count() == 0


def test_two_phase_dedup_shuffles_less(spark, tmp):
    """Shuffled bytes on almost unique keys: well below those of the plain dedup."""
    pad = F.concat(*[F.sha2(F.concat(F.col("id").cast("string"), F.lit(str(i))), 512) for i in range(4)])
    spark.range(20_000).select((F.col("id") - F.when(F.col("id") % 1000 == 0, 1).otherwise(0)).alias("a"),
                               pad.alias("pad")).write.parquet(f"{tmp}/t")
    df = spark.read.parquet(f"{tmp}/t")

    prints = df.groupBy(F.xxhash64("a").alias("f")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    plain, two = _shuffled(by_key(df, ["a"])), _shuffled(by_rare_key(df, ["a"])) + _shuffled(prints)
    assert 0 < two < plain / 4


def _shuffled(df):
    """Bytes that the exchanges of a plan have written."""
    df.collect()
    total, nodes = 0, [df._jdf.queryExecution().executedPlan()]
    while nodes:
        node = nodes.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            nodes.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            nodes.append(node.plan())
        else:
            if kind == "ShuffleExchangeExec":
                total += node.metrics().apply("shuffleBytesWritten").value()
            nodes += [node.children().apply(i) for i in range(node.children().size())]
    return total


def test_count_from_footers(spark, fact, tmp):
    fact.write.parquet(f"{tmp}/t")
    df = row_count(spark, f"{tmp}/t")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*)]" in plan and "ReadSchema: struct<count(*):bigint>" in plan
    assert rows(df) == [(N,)] and df.columns == ["n"]
    # the caller's session still reads as before
    assert "BatchScan" not in spark.read.parquet(f"{tmp}/t")._jdf.queryExecution().executedPlan().toString()
    assert rows(row_count(spark, [f"{tmp}/t", f"{tmp}/t"], "rows")) == [(2 * N,)]


def test_airport_joins_split_what_is_busy(spark):
    """A busy airport that no list names is found for the joins that shuffle."""
    from tidylake.plans import airport
    moves = spark.range(1000).select(
        F.when(F.col("id") % 2 == 0, F.lit("SBGR")).otherwise(F.concat(F.lit("X"), F.col("id"))).alias("aeroporto_ref"),
        F.when(F.col("id") % 5 == 0, F.lit("SBSP")).otherwise(F.concat(F.lit("Y"), F.col("id"))).alias("aeroporto_outro"),
        F.lit("J").alias("tipo_servico"))
    assert airport.hot_movement_keys(moves, False, False) == (["J"], ["SBGR", "SBSP"])
    assert airport.hot_movement_keys(moves, True, True) == ([], [])
    assert joins.HEAVY_SHARE > 4 / joins.TRACKED_KEYS
