"""Generic layer steps.  Each returns a lazy DataFrame; the caller writes it.

* :func:`refine_fact`      raw fact -> silver: fills, code labels, dedup.
* :func:`refine_dimension` raw lookup table -> silver: header clean-up,
  select/rename, key clean-up, whole-row dedup.
* :func:`enrich_fact`      silver -> gold: a sequence of DataFrame steps.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidylake.functions.labels import map_labels
from tidylake.functions.text import ZERO_WIDTH_SPACE
from tidylake.operators import cleaning, dedup
from tidylake.operators.projection import clean_headers, ref, select_renamed


@dataclass(frozen=True)
class LabelRule:
    """Replace (or add as ``out``) ``column`` by the label of its code."""

    column: str
    mapping: Mapping
    default: object = None
    key_type: str | None = None
    out: str | None = None


def refine_fact(df: DataFrame, fills: Iterable[tuple[object, Sequence[str]]] = (),
                labels: Iterable[LabelRule] = (), dedup_keys: Sequence[str] | None = None,
                dedup_order: Sequence[str] = (), strict_fills: bool = False) -> DataFrame:
    """Fill nulls, map codes to labels, drop duplicates (in that order).

    All fills and labels collapse into one projection; the dedup is the only
    shuffle (partial aggregation first, see ``operators.dedup``).
    """
    for value, cols in fills:
        df = cleaning.fill_nulls(df, value, cols, strict=strict_fills)
    labels = list(labels)
    if labels:
        df = df.withColumns({r.out or r.column: map_labels(ref(r.column), r.mapping, r.default,
                                                           r.key_type) for r in labels})
    if dedup_keys:
        df = dedup.by_key(df, dedup_keys, dedup_order)
    return df


def refine_dimension(df: DataFrame, rename: Mapping[str, str],
                     key_columns: Sequence[str] = (), header_chars: str = ZERO_WIDTH_SPACE,
                     clean_all_strings: bool = False, distinct: bool = True) -> DataFrame:
    """Clean a small lookup table read from raw text.

    Header names lose ``header_chars``; ``rename`` selects and renames;
    ``key_columns`` (new names) lose ``header_chars`` and surrounding spaces;
    ``clean_all_strings`` cleans every string column the same way (otherwise
    invisible characters left in descriptions defeat the whole-row dedup).
    """
    df = select_renamed(clean_headers(df, header_chars), rename)
    cols = list(key_columns)
    if clean_all_strings:
        cols = [f for f, t in df.dtypes if t == "string"]
    if cols:
        df = cleaning.clean_columns(df, cols, header_chars)
    return dedup.rows(df) if distinct else df


def enrich_fact(fact: DataFrame, steps: Iterable[Callable[[DataFrame], DataFrame]]
                ) -> DataFrame:
    """Apply DataFrame steps in order (``df.transform`` chain)."""
    return reduce(lambda df, step: df.transform(step), steps, fact)


def touched_partitions(full: DataFrame, part: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows of ``full`` in the partitions that rows of ``part`` fall into (null
    partition values included)."""
    touched = part.select(*[ref(c).alias(f"__tidylake_{c}") for c in partition_by]).distinct()
    same = reduce(and_, [ref(c).eqNullSafe(F.col(f"__tidylake_{c}")) for c in partition_by])
    return full.join(touched, same, "left_semi")


def changed_only(table: DataFrame, changed: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows of a partitioned table in the partitions that ``changed`` lists.

    ``changed`` (one row per folder) is broadcast and its values prune the table's folders
    at run time; for that it must be a filtered table (one run of a table of changes) and
    its partition values not null."""
    listed = changed.select(*[ref(c).alias(f"__tidylake_{c}") for c in partition_by])
    same = reduce(and_, [ref(c) == F.col(f"__tidylake_{c}") for c in partition_by])
    return table.join(F.broadcast(listed), same, "left_semi")
