"""Lookups without an exchange: fact and dimension stored in buckets of the key.

A fact table that is joined again and again with the same large dimension is shuffled each
time.  Stored once in buckets of the join key (a catalog table), its tasks find the
dimension's rows of their bucket in the dimension's file of the same bucket, and a join
reads both without an exchange.

A bucket cannot be split when it is read, so hot keys are dealt with when it is written:
next to the key, rows are bucketed by a salt that spreads null keys (which match nothing)
and the ``hot_keys`` over ``salts`` buckets, derived from the row's content; the
dimension's rows of these keys are stored once per salt.  For every other key the salt is 0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidylake.operators.projection import ref

SALT = "__tidylake_salt"


def _store(df: DataFrame, table: str, key: str, buckets: int, path: str | None) -> DataFrame:
    # one task per bucket writes one sorted file per bucket
    writer = (df.repartition(buckets, ref(key), F.col(SALT)).write.mode("overwrite").format("parquet")
              .bucketBy(buckets, key, SALT).sortBy(key, SALT))
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return df.sparkSession.table(table)


def store_fact(df: DataFrame, table: str, key: str, buckets: int, path: str | None = None,
               hot_keys: Sequence[object] = (), salts: int = 64,
               salt_by: Sequence[str] | None = None) -> DataFrame:
    """``df`` as catalog table ``table`` in ``buckets`` buckets of ``key`` (below ``path``,
    or in the warehouse), with its salt column."""
    spread = F.pmod(F.xxhash64(*[ref(c) for c in (salt_by or df.columns)]), F.lit(salts))
    hot = ref(key).isNull()
    if hot_keys:
        hot = hot | ref(key).isin(list(hot_keys))
    return _store(df.withColumn(SALT, F.when(hot, spread).otherwise(F.lit(0)).cast("int")),
                  table, key, buckets, path)


def store_dimension(df: DataFrame, table: str, key: str, buckets: int, path: str | None = None,
                    hot_keys: Sequence[object] = (), salts: int = 64) -> DataFrame:
    """``df`` as a catalog table in the same buckets; rows of ``hot_keys`` once per salt."""
    copies = F.array(F.lit(0))
    if hot_keys:
        copies = F.when(ref(key).isin(list(hot_keys)), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(
            copies)
    return _store(df.withColumn(SALT, F.explode(copies.cast("array<int>"))), table, key, buckets, path)


def lookup(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, how: str = "left") -> DataFrame:
    """Join two stored tables bucket by bucket (``how``: left, inner, left_semi or
    left_anti; the others keep dimension rows, whose copies would come out repeated).

    Both must have been stored with the same number of buckets, hot keys and salts; keys of
    different types hash differently and are refused."""
    if how.lower().replace("_", "") not in {"left", "leftouter", "inner", "leftsemi", "leftanti"}:
        raise ValueError(f"a {how!r} join keeps dimension rows, which are stored in copies")
    if fact.schema[fact_key].dataType != dim.schema[dim_key].dataType:
        raise ValueError("the keys' types differ, so do their buckets")
    same = (fact[fact_key] == dim[dim_key]) & (fact[SALT] == dim[SALT])
    joined = fact.join(dim, same, how)
    if "semi" in how.lower() or "anti" in how.lower():
        return joined.drop(SALT)
    return joined.drop(fact[SALT]).drop(dim[SALT])
