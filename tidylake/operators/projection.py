"""Projections: select + rename, header clean-up, role projections."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidylake.functions.text import ZERO_WIDTH_SPACE, clean_name


def ref(name: str) -> Column:
    """Column reference that tolerates dots, spaces and backticks in names."""
    return F.col("`" + name.replace("`", "``") + "`")


def select_renamed(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Keep the columns named in ``mapping`` (in its order) under new names.

    Columns not in ``mapping`` are dropped; a missing source column is an
    analysis error.  One ``Project``: Catalyst prunes the dropped columns down
    to the scan.
    """
    return df.select(*[ref(old).alias(new) for old, new in mapping.items()])


def clean_headers(df: DataFrame, chars: str = ZERO_WIDTH_SPACE,
                  strip: bool = False) -> DataFrame:
    """Rename every column with the characters in ``chars`` removed.

    ``strip`` also trims surrounding whitespace.  Two columns that become equal
    raise ``ValueError`` instead of producing an ambiguous frame.
    """
    new = [clean_name(c, chars, strip) for c in df.columns]
    dupes = sorted({n for n in new if new.count(n) > 1})
    if dupes:
        raise ValueError(f"column names collide after clean-up: {dupes}")
    return df.toDF(*new)


def role_projection(dim: DataFrame, mapping: Mapping[str, str] | None = None,
                    role: str | None = None, template: str = "{name}_{role}") -> DataFrame:
    """The same dimension under role-specific column names.

    Either an explicit ``mapping`` (old -> new, also selects) or a ``role``
    applied to every column through ``template``.
    """
    if mapping is None:
        if role is None:
            raise ValueError("give a mapping or a role")
        mapping = {c: template.format(name=c, role=role) for c in dim.columns}
    return select_renamed(dim, mapping)
