"""Sharding by proportional stratified interleaving.

Rows are shuffled within their source by a seeded hash and ranked; the rank
divided by the source's size spreads every source evenly over [0, 1).  Sorted by
that fraction, any stretch of rows holds the sources in the mixture's
proportions, so equal cuts give shards that all match the mixture, with row
counts at most one apart.

Neither ranking sorts a source or the table in one task.  Rows fall into
buckets of the hash (or of the fraction); a count per bucket gives each bucket's
first rank, and rows are ordered only within their bucket.  The number of
buckets grows with the table, so a bucket stays of ``BUCKET_ROWS`` rows however
large a source is.  Repeated rows are counted before they are ranked and spread
over their ranks afterwards, so a row repeated a million times is no hot key.

Only DataFrame functions are used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidylake.llm.common import checkpointed, hash_key, ref

BUCKET_ROWS = 16_384
_KEY_SPAN = float(2**60)


def _first_ranks(counts: DataFrame, within: list[str]) -> DataFrame:
    """``counts`` (bucket, n) with ``first``, the rows before each bucket."""
    upto = Window.partitionBy(*within).orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    return counts.withColumn("first", F.coalesce(F.sum("n").over(upto), F.lit(0)).cast("long"))


def interleave(df: DataFrame, n_shards: int, source_col: str = "source",
               seed: int = 0, shard_col: str = "shard", slot_col: str = "slot",
               key_cols: Sequence[str] | None = None) -> DataFrame:
    """``df`` with ``shard`` (0 to ``n_shards`` - 1) and ``slot`` (from 0,
    without gaps, in the shard) for every row.

    ``key_cols`` seed the shuffle (default: all columns).  A null source is a
    source of its own.  Repeated rows are separate rows, each with its own slot;
    which of them gets which cannot be told apart.  An input column named like an
    output column is replaced.  With fewer rows than shards the last shards are
    empty; an empty table gives no rows.
    """
    cols = [c for c in df.columns if c not in (shard_col, slot_col)]
    keys = [ref(c) for c in (key_cols or cols)]
    names = [f"c{i}" for i in range(len(cols))]
    rows = checkpointed(df.select(
        *[ref(c).alias(n) for c, n in zip(cols, names)],
        F.coalesce(F.concat(F.lit("="), ref(source_col).cast("string")), F.lit(""))
        .alias("stratum"),
        hash_key(seed, ref(source_col), *keys).alias("key")))
    total = rows.count()
    n_buckets = max(1, -(-total // BUCKET_ROWS))
    bucket = F.floor(F.col("key") / F.lit(_KEY_SPAN) * n_buckets).cast("long")
    each = rows.groupBy("stratum", "key", *names).agg(F.count(F.lit(1)).alias("copies"))
    each = each.withColumn("bucket", bucket)
    per_source = checkpointed(rows.groupBy("stratum", bucket.alias("bucket"))
                              .agg(F.count(F.lit(1)).alias("n")))
    starts = _first_ranks(per_source, ["stratum"]).withColumn(
        "of", F.sum("n").over(Window.partitionBy("stratum")))
    inside = Window.partitionBy("stratum", "bucket").orderBy(
        "key", *names).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = each.withColumn("upto", F.sum("copies").over(inside))
    ranked = counted.join(starts, ["stratum", "bucket"]).select(
        "stratum", "key", *names, "of",
        F.explode(F.sequence(F.col("first") + F.col("upto") - F.col("copies"),
                             F.col("first") + F.col("upto") - 1)).alias("rank"))
    fraction = (F.col("rank") + F.lit(0.5)) / F.col("of")
    spread = checkpointed(ranked.withColumn("fraction", fraction).withColumn(
        "bucket", F.least(F.floor(fraction * n_buckets), F.lit(n_buckets - 1)).cast("long")))
    per_part = spread.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    offsets = _first_ranks(per_part, []).select("bucket", "first")
    order = Window.partitionBy("bucket").orderBy(
        "fraction", "stratum", "rank")
    placed = spread.withColumn("nth", F.row_number().over(order)).join(offsets, "bucket")
    position = F.col("first") + F.col("nth") - 1
    low, longer = divmod(total, n_shards)
    turn = longer * (low + 1)
    shard = F.when(position < turn, F.floor(position / (low + 1))).otherwise(
        longer + F.floor((position - turn) / max(low, 1)))
    slot = F.when(position < turn, position % (low + 1)).otherwise(
        (position - turn) % max(low, 1))
    return placed.select(*[F.col(n).alias(c) for c, n in zip(cols, names)],
                         shard.cast("int").alias(shard_col), slot.cast("long").alias(slot_col))


def write_shards(sharded: DataFrame, path: str, shard_col: str = "shard",
                 slot_col: str = "slot") -> None:
    """One folder per shard, rows in slot order within each file."""
    (sharded.repartition(ref(shard_col)).sortWithinPartitions(ref(shard_col), ref(slot_col))
     .write.partitionBy(shard_col).parquet(path))
