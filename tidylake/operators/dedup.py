"""Duplicate removal.

``by_key`` keeps one row per key with a *deterministic* survivor.  It is an
aggregation, not a window: ``min(struct(order..., rest...))`` is combined
map-side before the single shuffle, so a hot key (for instance the group of
rows whose keys are all null) reaches its reducer as one row per map task
instead of all its rows.  (A ``row_number() = 1`` window gets a similar
map-side ``WindowGroupLimit`` from Spark's optimizer and measured about the
same at sf0.1; the aggregation is kept because its map-side reduction does not
depend on that rule firing.)
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidylake.operators.projection import ref
from tidylake.session import scratch_path

_ROW, _PRINT = "__tidylake_row", "__tidylake_print"


def by_key(df: DataFrame, keys: Iterable[str], order_by: Iterable[str | Column] = (),
           keep: str = "first", survivor: str = "deterministic") -> DataFrame:
    """One row per distinct ``keys`` (nulls are equal to each other).

    The survivor is the smallest row (``keep="first"``) or the largest
    (``keep="last"``) by ``order_by`` and then by all remaining columns in
    frame order, ascending with nulls first, so reruns and retries pick the
    same row.  ``survivor="arbitrary"`` is Spark's ``dropDuplicates`` (any
    row of the group).  Output columns keep the input order.
    """
    keys = list(keys)
    if survivor == "arbitrary":
        return df.dropDuplicates(keys)
    if keep not in ("first", "last"):
        raise ValueError("keep must be 'first' or 'last'")
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*[ref(k) for k in keys]).distinct()
    order = [ref(c) if isinstance(c, str) else c for c in order_by]
    fields = [e.alias(f"__order{i}") for i, e in enumerate(order)]
    fields += [ref(c).alias(c) for c in rest]
    pick = F.min if keep == "first" else F.max
    packed = df.groupBy(*[ref(k) for k in keys]).agg(pick(F.struct(*fields)).alias(_ROW))
    return packed.select(*[ref(c) if c in keys else F.col(_ROW).getField(c).alias(c)
                           for c in df.columns])


def by_rare_key(df: DataFrame, keys: Iterable[str], order_by: Iterable[str | Column] = (),
                keep: str = "first", max_repeated: int = 5_000_000) -> DataFrame:
    """:func:`by_key` in two phases, for tables whose keys are almost unique.

    First only a 64-bit fingerprint of each row's key is shuffled and counted.  Rows whose
    fingerprint occurs once are no duplicates and stream past the aggregation; only the
    others are sent through it.  The survivors are those of :func:`by_key` (a collision of
    fingerprints only sends a row the longer way).  The repeated fingerprints are stored in
    the session's scratch folder and broadcast; beyond ``max_repeated`` of them the keys are
    not rare and :func:`by_key` does it all.

    The first phase is a job of its own, run while the query is built; the input is read
    three times, so it should be a table, not a long plan."""
    keys, order_by = list(keys), list(order_by)
    spark = df.sparkSession
    print_of = F.xxhash64(*[ref(k) for k in keys])
    repeated = df.groupBy(print_of.alias(_PRINT)).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    path = scratch_path(spark, "repeated-keys")
    seen = Observation()
    repeated.select(_PRINT).observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(path)
    if seen.get["n"] > max_repeated:
        return by_key(df, keys, order_by, keep)
    table = F.broadcast(spark.read.schema(f"{_PRINT} long").parquet(path))
    same = print_of == F.col(_PRINT)
    return by_key(df.join(table, same, "left_semi"), keys, order_by, keep).unionByName(
        df.join(table, same, "left_anti"))


def rows(df: DataFrame) -> DataFrame:
    """Whole-row distinct (partial + final hash aggregation, one shuffle)."""
    return df.dropDuplicates()
