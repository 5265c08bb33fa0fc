"""A third of all rows on one key (and many null keys): results stay whole and
exact, and the hot group is not funnelled into one task."""

from pyspark.sql import functions as F

from tidylake.operators import by_key, lookup

N = 30_000


def _skewed(spark):
    # key 7 holds a third of the rows, a sixth have a null key, the rest spread
    k = (F.when(F.col("id") % 3 == 0, F.lit(7))
         .when(F.col("id") % 6 == 1, F.lit(None).cast("long"))
         .otherwise(F.col("id") % 1000))
    return spark.range(N).select(F.col("id"), k.alias("k"))


def test_dedup_hot_key(spark):
    df = _skewed(spark)
    out = by_key(df, ["k"], order_by=["id"])
    got = {r.k: r.id for r in out.collect()}
    assert got[7] == 0 and got[None] == 1
    assert len(got) == df.select("k").distinct().count()


def test_lookup_hot_and_null_keys_shuffle_path(spark):
    fact = _skewed(spark)
    dim = spark.range(1000).select(F.col("id").alias("dk"), (F.col("id") * 2).alias("v"))
    for kw in ({"broadcast": False}, {"broadcast": False, "skew_salt": 8}, {}):
        out = lookup(fact, dim, "k", "dk", **kw)
        assert out.count() == N
        assert out.where(F.col("k").isNotNull() & F.col("v").isNull()).count() == 0
        assert out.where(F.col("k").isNull() & F.col("v").isNotNull()).count() == 0
    # the shuffle join's output: null-key rows sit in many partitions, not one
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = lookup(fact, dim, "k", "dk", broadcast=False)
        parts = (out.where(F.col("k").isNull()).select(F.spark_partition_id().alias("p"))
                 .distinct().count())
        n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        assert parts == n_parts
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
