"""Mixing sources to target weights: capped water-filling.

Every source gets a share of the wanted total in proportion to its weight, but
no more than ``max_epochs`` times its own size; what a capped source leaves over
goes to the others by weight.  Sorted by size per weight the capped sources are
a prefix, so one pass of running sums finds the water level.

A source's target is then met by whole repetitions of all its documents and one
seeded, fractional repetition: documents in the order of a seeded hash, up to
the document at which the running size passes what is left.  That cut is found
without sorting a source: sizes are summed per hash bucket (partial sums before
the shuffle, so a source with a third of all rows is a few thousand rows), the
bucket that holds the cut is looked up, and only its rows are ordered.

Only DataFrame functions are used.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidylake.llm.common import broadcast_if_small, checkpointed, hash_key, ref, word_count

BUCKET_BITS = 12
MAX_BROADCAST_SOURCES = 100_000
_DEC = "decimal(38,0)"


def source_targets(sizes: DataFrame, weights: Sequence[int] = (3, 1, 2),
                   share_percent: int = 150, max_epochs: int = 2) -> DataFrame:
    """Targets of sources given as rows ``(source, source_size)``.

    Sources take the weights in turn in the order of their code points, null
    last.  Returns ``source, source_size, target, epochs, rest``: the target in
    words, the whole repetitions and what is left for the fractional one.
    Sources are few (one row each), so the running sums use one task.
    """
    cycle = F.array(*[F.lit(int(w)) for w in weights])
    lcm = math.lcm(*map(int, weights))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    level = Window.orderBy(F.col("per_weight"), F.col("place"))
    total = F.sum("source_size").over(Window.partitionBy())
    # all amounts are scaled by 100 so that the shared total is a whole number
    ranked = (sizes.withColumn("place", F.row_number().over(by_name) - 1)
              .withColumn("weight", F.element_at(
                  cycle, (F.col("place") % len(weights) + 1).cast("int")).cast(_DEC))
              .withColumn("per_weight", F.col("source_size").cast(_DEC)
                          * (F.lit(lcm).cast(_DEC) / F.col("weight")).cast(_DEC))
              .withColumn("cap", F.col("source_size").cast(_DEC) * (100 * max_epochs))
              .withColumn("wanted", (total * share_percent).cast(_DEC)))
    before = level.rowsBetween(Window.unboundedPreceding, -1)
    after = level.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    zero = F.lit(0).cast(_DEC)
    levelled = (ranked
                .withColumn("left", F.col("wanted") - F.coalesce(F.sum("cap").over(before), zero))
                .withColumn("open", F.sum("weight").over(after))
                .withColumn("capped", (F.col("left").cast(_DEC) * F.col("weight"))
                            >= (F.col("cap") * F.col("open").cast(_DEC)))
                .withColumn("spent", F.sum(F.when(F.col("capped"), F.col("cap")).otherwise(zero))
                            .over(Window.partitionBy()))
                .withColumn("open_all",
                            F.sum(F.when(F.col("capped"), zero).otherwise(F.col("weight")))
                            .over(Window.partitionBy())))
    share = (((F.col("wanted") - F.col("spent")).cast(_DEC) * F.col("weight")).cast("double")
             / (F.col("open_all") * 100).cast("double"))
    target = F.when(F.col("capped"), F.col("source_size").cast("double") * max_epochs).otherwise(share)
    epochs = F.when(F.col("source_size") > 0,
                    F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    return (levelled.withColumn("target", target).withColumn("epochs", epochs)
            .select("source", "source_size", "target", "epochs",
                    (F.col("target") - F.col("epochs") * F.col("source_size")).alias("rest")))


def cuts(docs: DataFrame, targets: DataFrame) -> DataFrame:
    """``targets`` with ``cut_key, cut_id``: the last document of the fractional
    repetition in the order (key, doc_id); ``cut_key`` is -1 where there is none.

    ``docs``: ``doc_id, source, size, key``.
    """
    bucket = F.shiftright("key", 60 - BUCKET_BITS)
    running = Window.partitionBy("source").orderBy("bucket")
    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    filled = (docs.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("sum"))
              .withColumn("upto", F.sum("sum").over(running)))
    needs = targets.where("rest > 0").select("source", "rest")
    found = filled.join(needs, same(filled, needs)).select(
        filled["source"], "bucket", "rest", (F.col("upto") - F.col("sum")).alias("base")).where(
        (F.col("base") < F.col("rest")) & (F.col("base") + F.col("sum") >= F.col("rest")))
    found = broadcast_if_small(checkpointed(found), MAX_BROADCAST_SOURCES)
    rows = docs.withColumn("bucket", bucket)
    inside = (rows.join(found, same(rows, found) & (rows["bucket"] == found["bucket"]))
              .groupBy(rows["source"].alias("source"), "key", "doc_id", "base", "rest")
              .agg(F.sum("size").alias("size")))
    order = Window.partitionBy("source").orderBy("key", F.col("doc_id").asc_nulls_first())
    # a document is in if at least half of it lies below the cut
    taken = (inside.withColumn("upto", F.col("base") + F.sum("size").over(order))
             .where(F.col("upto") - F.col("size") / 2 <= F.col("rest")))
    # with no document of the bucket in, the cut lies at the bucket's start
    last = taken.groupBy("source").agg(F.max(F.struct("key", "doc_id")).alias("last"))
    start = found.select("source", F.shiftleft(F.col("bucket"), 60 - BUCKET_BITS).alias("start"))
    ends = start.join(last, start["source"].eqNullSafe(last["source"]), "left").select(
        start["source"], F.coalesce("last.key", F.col("start") - 1).alias("cut_key"),
        F.when(F.col("last").isNull(), F.lit(None)).otherwise(F.col("last.doc_id")).alias("cut_id"),
        F.col("last").isNull().alias("open_cut"))
    return targets.join(ends, targets["source"].eqNullSafe(ends["source"]), "left").select(
        targets["source"], "source_size", "target", "epochs",
        F.coalesce("cut_key", F.lit(-1)).alias("cut_key"), "cut_id",
        F.coalesce("open_cut", F.lit(True)).alias("open_cut"))


def _digest(df: DataFrame, id_col: str, text_col: str, source_col: str, seed: int) -> DataFrame:
    return df.select(ref(id_col).alias("doc_id"), ref(source_col).alias("source"),
                     word_count(ref(text_col)).alias("size"),
                     hash_key(seed, ref(id_col)).alias("key"))


def _limits(docs: DataFrame, weights: Sequence[int], share_percent: int,
            max_epochs: int) -> DataFrame:
    sizes = docs.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = checkpointed(source_targets(sizes, weights, share_percent, max_epochs))
    return broadcast_if_small(checkpointed(cuts(docs, targets)), MAX_BROADCAST_SOURCES)


def _copies() -> Column:
    """Copies of a row joined to its source's limits."""
    up_to_id = F.coalesce(F.col("doc_id") <= F.col("cut_id"), F.col("doc_id").isNull())
    at_cut = (F.col("key") == F.col("cut_key")) & (F.col("open_cut") | up_to_id)
    extra = F.coalesce((F.col("key") < F.col("cut_key")) | at_cut, F.lit(False))
    return F.col("epochs") + extra.cast("long")


def mixture(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            source_col: str = "source", weights: Sequence[int] = (3, 1, 2),
            share_percent: int = 150, max_epochs: int = 2, seed: int = 0) -> DataFrame:
    """How often the mix takes each document: ``doc_id, source, size,
    source_size, target, copies, taken``, one row per input row.

    ``size``: words of the text (null or empty: 0); ``taken``: ``copies`` times
    ``size``, so at most ``max_epochs`` times the size.  A null source is a
    source of its own, as is an empty name; a null id is a value like others.
    Rows with the same source and id share one place in the seeded order (all or
    none are in the fractional repetition).  An empty table gives no rows; other
    columns play no part, whatever their names.
    """
    docs = checkpointed(_digest(df, id_col, text_col, source_col, seed))
    limits = _limits(docs, weights, share_percent, max_epochs)
    joined = docs.join(limits, docs["source"].eqNullSafe(limits["source"]))
    return joined.select(
        docs["doc_id"], docs["source"], "size", "source_size", "target",
        _copies().alias("copies"), (_copies() * F.col("size")).alias("taken"))


def mixed(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          source_col: str = "source", weights: Sequence[int] = (3, 1, 2),
          share_percent: int = 150, max_epochs: int = 2, seed: int = 0) -> DataFrame:
    """The mix itself: every row of ``df`` as often as it is taken, all columns
    kept.  A row's place in the order is computed from the row, so the texts
    are not shuffled: only the limits of the sources are joined to them."""
    docs = checkpointed(_digest(df, id_col, text_col, source_col, seed))
    limits = _limits(docs, weights, share_percent, max_epochs)
    row = df.select(F.struct(*[ref(c) for c in df.columns]).alias("__tl_row"),
                    ref(id_col).alias("doc_id"), ref(source_col).alias("source"),
                    hash_key(seed, ref(id_col)).alias("key"))
    joined = row.join(limits, row["source"].eqNullSafe(limits["source"])).select(
        "__tl_row", _copies().alias("copies")).where("copies > 0")
    return joined.select("__tl_row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(
        *[F.col("__tl_row")[c].alias(c) for c in df.columns])
