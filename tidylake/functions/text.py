"""Text clean-up expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ZERO_WIDTH_SPACE = "\u200b"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_invisible(column: str | Column, chars: str = ZERO_WIDTH_SPACE) -> Column:
    """Remove every occurrence of the characters in ``chars``.

    ``translate`` with an empty replacement deletes characters without a regex
    engine per row.
    """
    return F.translate(_col(column), chars, "")


def clean_key(column: str | Column, chars: str = ZERO_WIDTH_SPACE) -> Column:
    """Join-key clean-up: drop invisible characters, then trim ASCII spaces."""
    return F.trim(strip_invisible(column, chars))


def clean_name(name: str, chars: str = ZERO_WIDTH_SPACE, strip: bool = False) -> str:
    """A column *name* with invisible characters removed (plain Python)."""
    for ch in chars:
        name = name.replace(ch, "")
    return name.strip() if strip else name


def html_escape(column: str | Column) -> Column:
    """Escape ``&``, ``<`` and ``>`` for embedding text in HTML."""
    c = F.replace(_col(column), F.lit("&"), F.lit("&amp;"))
    c = F.replace(c, F.lit("<"), F.lit("&lt;"))
    return F.replace(c, F.lit(">"), F.lit("&gt;"))
