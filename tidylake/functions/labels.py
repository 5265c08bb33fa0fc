"""Code -> label mapping as a CASE expression."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def map_labels(column: str | Column, mapping: Mapping, default=None,
               key_type: str | None = None) -> Column:
    """``CASE column WHEN k1 THEN v1 ... ELSE default END``.

    ``mapping`` is applied in its own order (first match wins).  A null input
    or a code missing from ``mapping`` gives ``default`` (null when ``None``).
    ``key_type`` (e.g. ``"int"``) compares ``try_cast(column AS key_type)``
    with the keys, so ``"01"`` matches ``1`` and non-numeric text falls to the
    default instead of failing under ANSI mode.  Values may be literals or
    ``Column`` expressions.
    """
    key = _col(column)
    if key_type is not None:
        key = key.try_cast(key_type)
    expr = None
    for code, label in mapping.items():
        value = label if isinstance(label, Column) else F.lit(label)
        cond = key == F.lit(code)
        expr = F.when(cond, value) if expr is None else expr.when(cond, value)
    fallback = default if isinstance(default, Column) else F.lit(default)
    if expr is None:
        return fallback
    return expr.otherwise(fallback) if default is not None else expr
