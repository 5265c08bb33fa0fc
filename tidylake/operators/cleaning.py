"""Null filling, value replacement and key clean-up."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidylake.functions.text import ZERO_WIDTH_SPACE, clean_key
from tidylake.operators.projection import ref

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
            T.DoubleType, T.DecimalType)


def _accepts(dtype: T.DataType, value) -> bool:
    if isinstance(value, bool):
        return isinstance(dtype, T.BooleanType)
    if isinstance(value, (int, float)):
        return isinstance(dtype, _NUMERIC)
    if isinstance(value, str):
        return isinstance(dtype, T.StringType)
    return False


def fill_nulls(df: DataFrame, value, columns: Iterable[str] | None = None,
               strict: bool = False) -> DataFrame:
    """Replace nulls in ``columns`` (all when ``None``) by ``value``.

    Spark's ``na.fill`` semantics: a numeric value fills numeric columns (cast
    to the column type; NaN in float/double columns is filled as well), a
    string fills string columns, a bool fills boolean columns; a column of
    another type is skipped silently.  ``strict=True`` raises instead of
    skipping, so a fill that would do nothing is caught.
    """
    cols = list(columns) if columns is not None else None
    if strict:
        types = dict(df.dtypes)
        schema = {f.name: f.dataType for f in df.schema.fields}
        for c in cols if cols is not None else list(types):
            if c not in schema:
                raise ValueError(f"unknown column {c!r}")
            if not _accepts(schema[c], value):
                raise TypeError(f"cannot fill {types[c]} column {c!r} with {value!r}")
    return df.na.fill(value, subset=cols)


def replace_values(df: DataFrame, mapping: Mapping, columns: Iterable[str] | None = None
                   ) -> DataFrame:
    """Replace exact values by ``mapping`` in ``columns``; other values stay."""
    return df.replace(dict(mapping), subset=list(columns) if columns is not None else None)


def clean_columns(df: DataFrame, columns: Iterable[str],
                  chars: str = ZERO_WIDTH_SPACE) -> DataFrame:
    """Strip invisible characters and ASCII spaces from string columns."""
    return df.withColumns({c: clean_key(ref(c), chars) for c in columns})
