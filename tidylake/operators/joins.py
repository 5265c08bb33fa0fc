"""Dimension lookups (left equi joins) with a checked broadcast.

Strategy of :func:`lookup`:

1. A dimension *measured* (one plain aggregate: rows and bytes, one row per task
   before the shuffle) to lie within both bounds is broadcast: the fact side is
   never shuffled and hot keys cost nothing extra.
2. Otherwise both sides are hash-partitioned (sort-merge join).  Fact rows with a
   null key can never match, yet would all hash to one partition; they get a
   deterministic salt so they spread over ``null_salt`` partitions.  Keys named
   in ``hot_keys`` (e.g. the label that replaced nulls), or found in the data by
   :func:`heavy_keys` (``hot_keys="measure"``), are spread over
   ``hot_salt`` partitions, and only their dimension rows are replicated;
   ``skew_salt=N`` does that for every key.  With ``prune`` dimension rows that no
   fact row refers to are left out before the shuffle (:func:`referenced`).  AQE's skew-join splitting stays on as
   the backstop.

Both ways give the same rows.  Replicating dimension rows would repeat unmatched
ones in joins that keep them, so salting keys is refused for ``right`` and
``full`` joins, whatever the size.

Salts are derived from row content (``xxhash64``), never from random numbers,
so a recomputed task after an executor loss sends every row to the same place.
"""

from __future__ import annotations

import logging
import math
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidylake.operators import dedup
from tidylake.operators.projection import ref, role_projection

log = logging.getLogger(__name__)

_SALT = "__tidylake_salt"

# Bounds of a broadcast dimension (read at call time, so a deployment can set
# them once for all lookups).
DEFAULT_MAX_BROADCAST_ROWS = 5_000_000
DEFAULT_MAX_BROADCAST_BYTES = 256 * 1024 * 1024


_FIXED_WIDTH = 8
_FIXED = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
_VARIABLE = (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.StructType)


def _row_bytes(df: DataFrame) -> Column:
    """Approximate in-memory width of a row: 8 bytes per fixed-width value,
    the UTF-8 length for strings/binary."""
    parts = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            parts.append(F.coalesce(F.octet_length(ref(f.name)), F.lit(0)) + F.lit(8))
        elif isinstance(f.dataType, _FIXED):
            parts.append(F.lit(_FIXED_WIDTH))
        else:  # nested values: size of their JSON text as a stand-in
            parts.append(F.coalesce(F.octet_length(F.to_json(F.struct(ref(f.name)))),
                                    F.lit(0)))
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    return total.cast("long")


# A hash relation holds, beside the values, about this much per row.
_ROW_OVERHEAD = 48


def sizes(dim: DataFrame) -> tuple[int, int]:
    """Rows of ``dim`` and their approximate bytes as a hash relation, by one
    aggregate: a task sends one row, whatever it reads."""
    n, width = dim.agg(F.count(F.lit(1)), F.sum(_row_bytes(dim))).first()
    return n, (width or 0) + n * _ROW_OVERHEAD


def checked_broadcast(dim: DataFrame, max_rows: int | None = None,
                      max_bytes: int | None = None) -> bool:
    """True when ``dim`` holds at most ``max_rows`` rows and ``max_bytes``;
    measured, not estimated.  Only the two numbers reach the driver."""
    return measure(dim, max_rows=max_rows, max_bytes=max_bytes)[0]


def measure(*dims: DataFrame, max_rows: int | None = None,
            max_bytes: int | None = None) -> list[bool]:
    """Which of the dimensions of one query may be broadcast together.

    They are measured by concurrent Spark jobs; the smallest are taken first
    while their bytes together stay within ``max_bytes``, so the bound holds for
    the query, not for each dimension alone.
    """
    max_rows = DEFAULT_MAX_BROADCAST_ROWS if max_rows is None else max_rows
    max_bytes = DEFAULT_MAX_BROADCAST_BYTES if max_bytes is None else max_bytes
    with ThreadPoolExecutor(max_workers=min(max(len(dims), 1), 8)) as pool:
        measured = list(pool.map(sizes, dims))
    small, total = [False] * len(dims), 0
    for i in sorted(range(len(dims)), key=lambda i: measured[i][1]):
        rows, width = measured[i]
        if rows <= max_rows and total + width <= max_bytes:
            small[i], total = True, total + width
    return small


#: Share of the rows from which a key counts as heavy, and the keys that the summary
#: tracks: its counts are low by at most about 3.5 / TRACKED_KEYS of the rows.
HEAVY_SHARE, TRACKED_KEYS = 0.01, 8192


def heavy_keys(df: DataFrame, *columns: str, share: float | None = None,
               tracked: int | None = None) -> list[list[object]]:
    """For each column the values that hold at least ``share`` of all rows, heaviest first
    (nulls are not counted).

    A mergeable frequent-items summary per column, built as one aggregate: a task sends
    a summary of a bounded number of keys, whatever it reads, so the key that dominates
    one part of the data is found without counting all keys.  Counts are low by
    ``3.5 / tracked`` of the rows at most, which is allowed for.  At most ``1 / share``
    values per column reach the driver."""
    share = HEAVY_SHARE if share is None else share
    tracked = TRACKED_KEYS if tracked is None else tracked
    if not 4 / tracked < share <= 1:
        raise ValueError("share must be over 4 / tracked, and 1 at most")
    most = math.ceil(1 / (share - 3.5 / tracked))
    tops = [F.expr(f"approx_top_k({_quoted(c)}, {most}, {tracked}) FILTER (WHERE {_quoted(c)} IS NOT NULL)")
            .alias(f"top{i}") for i, c in enumerate(columns)]
    row = df.agg(F.count(F.lit(1)).alias("n"), *tops).first()
    least = max(1, row["n"] * (share - 3.5 / tracked))
    return [[r["item"] for r in row[f"top{i}"] or [] if r["count"] >= least and r["item"] is not None]
            for i in range(len(columns))]


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


#: 64-bit words of a filter of referenced keys: at most 16 MB when broadcast.
FILTER_WORDS = 1 << 20


def referenced(dim: DataFrame, fact: DataFrame, dim_key: str | Sequence[str],
               fact_key: str | Sequence[str], words: int | None = None) -> DataFrame:
    """``dim`` without rows that no row of ``fact`` refers to, by a Bloom filter of the
    fact's keys: rows that are referred to are never lost, a few others stay.

    The filter is a table of ``words`` words; each key sets four bits of one word.  It is
    built by one aggregate over the fact's key columns, where a task sends at most one row
    per word, and broadcast: its size is bounded by ``words``, not by the data."""
    words = FILTER_WORDS if words is None else words

    def bits(columns: Sequence[Column]) -> tuple[Column, Column]:
        h = F.xxhash64(*columns, F.lit("word"))
        g = F.xxhash64(*columns, F.lit("bits"))
        mask = F.lit(0).cast("long")
        for i in range(4):
            place = F.shiftrightunsigned(g, 16 * i).bitwiseAND(F.lit(63)).cast("int")
            mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), place))
        return F.pmod(h, F.lit(words)), mask

    fks, dks = _keys(fact_key), _keys(dim_key)
    types = [fact.schema[f].dataType for f in fks]
    word, mask = bits([ref(f) for f in fks])
    filled = fact.select(word.alias("__tl_word"), mask.alias("__tl_bits")).groupBy("__tl_word").agg(
        F.bit_or("__tl_bits").alias("__tl_set"))
    # hashes depend on the type
    word, mask = bits([ref(d).cast(t) for d, t in zip(dks, types)])
    kept = dim.withColumns({"__tl_at": word, "__tl_mask": mask}).join(
        F.broadcast(filled), F.col("__tl_at") == F.col("__tl_word"))
    return kept.where(F.col("__tl_set").bitwiseAND(F.col("__tl_mask")) == F.col("__tl_mask")).select(
        *[ref(c) for c in dim.columns])


# joins that keep dimension rows without a match
_KEEPS_DIMENSION = {"right", "rightouter", "full", "fullouter", "outer"}


def _of(df: DataFrame, name: str) -> Column:
    """A column of ``df`` by its exact name, also one with a dot."""
    return df["`" + name.replace("`", "``") + "`"]


def _keys(k: str | Sequence[str]) -> list[str]:
    return [k] if isinstance(k, str) else list(k)


def lookup(fact: DataFrame, dim: DataFrame, fact_key: str | Sequence[str],
           dim_key: str | Sequence[str] | None = None, how: str = "left",
           unique: bool = False, broadcast: bool | str = "auto",
           max_broadcast_rows: int | None = None,
           max_broadcast_bytes: int | None = None,
           null_salt: int = 64, skew_salt: int = 1,
           hot_keys: Sequence[object] | str = (), hot_salt: int = 64,
           salt_by: Sequence[str] | None = None, small: bool | None = None,
           prune: bool = False) -> DataFrame:
    """Join ``dim`` onto ``fact`` by equal keys (left outer by default).

    Both key columns are kept when their names differ (with equal names the
    join is ``USING`` and the key appears once).  Null keys never match.  A
    key repeated in ``dim`` multiplies the fact row, as in SQL; ``unique=True``
    first reduces ``dim`` to one deterministic row per key.

    ``broadcast``: ``"auto"``/``True`` broadcast after the size check (``True``
    logs when the check fails and falls back), ``False`` never.  ``hot_keys``
    lists key values that may hold a large share of the fact; ``"measure"`` finds them
    by one aggregate over the fact's key if the join shuffles.  ``prune`` filters the
    dimension by the fact's keys before a shuffle.  ``small`` passes the result of an earlier :func:`checked_broadcast` of the same
    dimension (e.g. one dimension used in two roles), skipping the check.
    """
    fks = _keys(fact_key)
    dks = _keys(dim_key) if dim_key is not None else fks
    if len(fks) != len(dks):
        raise ValueError("fact_key and dim_key differ in length")
    use_broadcast = False
    if broadcast in ("auto", True):
        # measured before any dedup: dedup never adds rows or bytes, so the raw
        # dimension's bound holds for the reduced one, and the check never has
        # to run the dedup's shuffle
        use_broadcast = small if small is not None else checked_broadcast(
            dim, max_broadcast_rows, max_broadcast_bytes)
        if broadcast is True and not use_broadcast:
            log.warning("dimension exceeds the broadcast bound; using a shuffle join")
    if unique:
        dim = dedup.by_key(dim, dks)
    same_names = fks == dks
    if hot_keys and len(fks) != 1:
        raise ValueError("hot_keys are values of a single key column")
    if (hot_keys or skew_salt > 1) and how.lower().replace("_", "") in _KEEPS_DIMENSION:
        raise ValueError(f"keys cannot be salted in a {how!r} join: it keeps dimension rows, "
                         "and replicas without a match would come out repeated")

    if use_broadcast:
        bdim = F.broadcast(dim)
        if same_names:
            return fact.join(bdim, on=fks, how=how)
        cond = [_of(fact, f) == _of(bdim, d) for f, d in zip(fks, dks)]
        return fact.join(bdim, on=cond, how=how)

    if prune and how.lower().replace("_", "") not in _KEEPS_DIMENSION:
        dim = referenced(dim, fact, dks, fks)
    if hot_keys == "measure":
        hot_keys = heavy_keys(fact, fks[0])[0]
    # Shuffle join: salt the partitioning so null (or hot) keys spread out.
    row_hash = F.xxhash64(*[ref(c) for c in (salt_by or fact.columns)])
    copies = F.array(F.lit(0))
    if skew_salt > 1:  # every key over skew_salt partitions, dimension replicated
        fact_salt = F.pmod(row_hash, F.lit(skew_salt))
        copies = F.sequence(F.lit(0), F.lit(skew_salt - 1))
    else:  # rows with a null key (they never match) and rows of hot keys spread out
        fact_salt = F.lit(0)
        if hot_keys:
            fact_salt = F.when(ref(fks[0]).isin(list(hot_keys)),
                               F.pmod(row_hash, F.lit(hot_salt))).otherwise(fact_salt)
            copies = F.when(ref(dks[0]).isin(list(hot_keys)),
                            F.sequence(F.lit(0), F.lit(hot_salt - 1))).otherwise(copies)
        any_null = None
        for f in fks:
            any_null = ref(f).isNull() if any_null is None else any_null | ref(f).isNull()
        if null_salt > 1:
            fact_salt = F.when(any_null, F.pmod(row_hash, F.lit(null_salt))).otherwise(fact_salt)
    dim_s = dim.withColumn(_SALT, F.explode(copies))
    fact_s = fact.withColumn(_SALT, fact_salt.cast("int"))
    dim_s = dim_s.withColumn(_SALT, F.col(_SALT).cast("int"))
    if same_names:
        joined = fact_s.join(dim_s, on=fks + [_SALT], how=how)
    else:
        cond = [_of(fact_s, f) == _of(dim_s, d) for f, d in zip(fks, dks)]
        cond.append(fact_s[_SALT] == dim_s[_SALT])
        joined = fact_s.join(dim_s, on=cond, how=how).drop(dim_s[_SALT])
    return joined.drop(_SALT)


def role_lookup(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str,
                mapping: Mapping[str, str], **kwargs) -> DataFrame:
    """Look up ``dim`` in one role: its columns renamed by ``mapping``.

    ``dim_key`` is the dimension key's original name; it must be in
    ``mapping``.  Used twice on one dimension for role-playing joins
    (departure / arrival airport); measure the dimension once with
    :func:`checked_broadcast` and pass ``small=`` to both calls.
    """
    if dim_key not in mapping:
        raise ValueError(f"mapping must rename the key {dim_key!r}")
    return lookup(fact, role_projection(dim, mapping), fact_key, mapping[dim_key], **kwargs)
