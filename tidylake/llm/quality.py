"""Quality rules: compression bands.

A text is compressed with zstandard, whole and in fixed chunks.  Text that
compresses far better than prose of its length repeats itself; text that hardly
compresses is noise (encoded data, random characters).  How well prose
compresses depends on its length, so limits depend on the length.  The operator
also counts words, symbols, repeated lines and repeated five-word windows, and a
text that fails these base rules is rejected as well.

The limits come from the table itself: over all texts that pass the base rules,
Spark gathers the median ratio of each octave of lengths, and per length band the
median distance of the ratios from the line through these medians; whole texts
and chunks have limits of their own.  A text is accepted from ``LOW_MARGIN`` robust
standard deviations below the line to ``HIGH_MARGIN`` above it.  Texts that begin alike count once, so a family
of copies does not set the limits.  Lengths beyond the octaves with at least
``MIN_TEXTS`` texts keep fixed limits per band.

Two passes: the first sends a hash, a length and a ratio per text and chunk, the
second judges each row on its own whole text inside one Arrow batch.  A few dozen
numbers reach the driver.
"""

from __future__ import annotations

import bisect
import math
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidylake.llm.common import WHITE, WORD_PATTERN, checkpointed, ref

# Upper ends of the length bands (UTF-8 bytes) and, for each band
# and the open last one, the lowest and highest accepted ratio of size to
# compressed size where a table has too few texts of a length to tell.
BAND_ENDS = (256, 1024, 4096, 16384, 65536)
LOWEST = (0.45, 1.10, 1.35, 1.50, 1.60, 1.60)
HIGHEST = (2.60, 2.70, 2.80, 3.00, 3.20, 3.60)

# Robust standard deviations (1.4826 times the median distance) that a ratio may
# lie from the line, at least as many texts in an octave that says where it is,
# the least standard deviation, and the bytes in which copies are taken alike.
# Prose has a longer tail of low ratios (lists, names, numbers), noise lies far lower.
LOW_MARGIN, HIGH_MARGIN = 6.0, 4.0
MIN_TEXTS = 20
MIN_SPREAD = 0.02
HEAD_BYTES = 64

CHUNK_BYTES = 4096
MAX_BAD_SHARE = 0.3
LEVEL = 3

# Fixed values of the base rules.
SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

_WORD = re.compile(WORD_PATTERN)

FIELDS = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, ratio double, n_chunks int, repetitive_bytes long, "
          "incompressible_bytes long, verdict string, kept boolean")


def repeat_words(words: list[str], width: int = WINDOW) -> int:
    """Words that lie in a window of ``width`` words found at least twice."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    ids: dict[str, int] = {}
    codes = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    key = codes[:n]
    rank = len(ids)
    for k in range(1, width):
        # exact: the key is re-ranked before the next word could overflow it
        if rank * len(ids) >= 2**62:
            distinct, key = np.unique(key, return_inverse=True)
            rank = len(distinct)
        key = key * len(ids) + codes[k:n + k]
        rank *= len(ids)
    order = np.argsort(key, kind="stable")
    same = np.diff(key[order]) == 0
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    step = np.zeros(len(words) + 1, np.int64)
    starts = np.flatnonzero(twice)
    np.add.at(step, starts, 1)
    np.add.at(step, starts + width, -1)
    return int((np.cumsum(step[:-1]) > 0).sum())


def dup_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    if "\n" not in text:
        return 0
    seen, n = set(), 0
    for line in text.split("\n"):
        if line in seen:
            n += 1
        elif line.strip(WHITE):
            seen.add(line)
    return n


def base_counts(text: str) -> tuple[int, int, int, int, int, bool]:
    words = _WORD.findall(text)
    n_words = len(words)
    chars = len(text) - sum(map(text.count, WHITE))
    repeats = repeat_words(words)
    failed = n_words < MIN_WORDS or 100 * repeats > MAX_REPEAT_PERCENT * n_words
    return (n_words, chars, sum(map(text.count, SYMBOLS)), dup_lines(text), repeats, failed)


class Line(NamedTuple):
    """Accepted ratios by length: medians at known lengths (log2 of bytes) and a
    spread per band."""
    at: tuple[float, ...]
    medians: tuple[float, ...]
    spreads: tuple[float, ...]

    def limits(self, size: int) -> tuple[float, float]:
        band, x = bisect.bisect_left(BAND_ENDS, size), math.log2(size)
        if not self.at or not math.floor(self.at[0]) <= x < math.floor(self.at[-1]) + 1:
            return LOWEST[band], HIGHEST[band]
        middle, spread = float(np.interp(x, self.at, self.medians)), self.spreads[band]
        return middle - LOW_MARGIN * spread, middle + HIGH_MARGIN * spread


class Limits(NamedTuple):
    whole: Line
    chunk: Line


_FIXED = Line((), (), ())
FIXED_LIMITS = Limits(_FIXED, _FIXED)


def _side(size: int, packed: int, line: Line) -> tuple[int, float]:
    """-1: incompressible, 1: repetitive, 0: like prose; and the ratio."""
    (low, high), ratio = line.limits(size), size / packed
    return (-1 if ratio < low else 1 if ratio > high else 0), ratio


def _chunks(data: bytes) -> list[bytes]:
    """The chunks of a text that is longer than one."""
    if len(data) <= CHUNK_BYTES:
        return []
    return [data[at:at + CHUNK_BYTES] for at in range(0, len(data), CHUNK_BYTES)]


def compression(data: bytes, pack, limits: Limits = FIXED_LIMITS) -> tuple[float, int, int, int, str]:
    """Ratio of the whole, number of chunks, bytes in repetitive and in
    incompressible chunks, and the verdict.  An empty text has ratio 1."""
    if not data:
        return 1.0, 0, 0, 0, "empty"
    side, ratio = _side(len(data), len(pack(data)), limits.whole)
    n = bad_high = bad_low = 0
    for chunk in _chunks(data):
        n += 1
        s, _ = _side(len(chunk), len(pack(chunk)), limits.chunk)
        bad_high += len(chunk) * (s > 0)
        bad_low += len(chunk) * (s < 0)
    if not n:
        n = 1
        bad_high, bad_low = len(data) * (side > 0), len(data) * (side < 0)
    if side > 0 or bad_high > MAX_BAD_SHARE * len(data):
        return ratio, n, bad_high, bad_low, "repetitive"
    if side < 0 or bad_low > MAX_BAD_SHARE * len(data):
        return ratio, n, bad_high, bad_low, "incompressible"
    return ratio, n, bad_high, bad_low, "prose"


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``kind, head, size, milli`` (thousandths of the ratio) of the texts that
    pass the base rules and of their chunks."""
    pack = zstandard.ZstdCompressor(level=LEVEL).compress
    for batch in batches:
        rows = []
        for text in batch.column(0):
            text = text.as_py() or ""
            if base_counts(text)[-1]:
                continue
            data = text.encode("utf-8", "surrogatepass")
            rows += [(kind, xxhash.xxh3_64_intdigest(part[:HEAD_BYTES]) >> 1, len(part),
                      round(1000 * len(part) / len(pack(part))))
                     for kind, parts in enumerate(([data], _chunks(data))) for part in parts]
        columns = list(zip(*rows)) or [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns],
                                         names=["kind", "head", "size", "milli"])


def table_limits(df: DataFrame, text_col: str = "text") -> Limits:
    """The limits that the texts of ``df`` set."""
    seen = df.select(ref(text_col).alias("text")).mapInArrow(
        _measured, "kind long, head long, size long, milli long")
    once = seen.groupBy("kind", "head").agg(F.min(F.struct("size", "milli")).alias("one")).select(
        "kind", "one.*")
    # values are rounded, so that a median's counts are bounded
    length = F.round(F.log2("size"), 2)
    band = sum((F.col("size") > end).cast("int") for end in BAND_ENDS)
    once = checkpointed(once.select("kind", "milli", length.alias("x"), band.alias("band"),
                                    F.floor(F.log2("size")).alias("octave")))
    octaves = once.groupBy("kind", "octave").agg(
        F.count(F.lit(1)).alias("n"), F.expr("percentile(x, 0.5)").alias("x"),
        F.expr("percentile(milli, 0.5)").alias("milli")).where(
        F.col("n") >= MIN_TEXTS).orderBy("kind", "octave").collect()  # at most 2 x 63 rows
    knots = [[(r["x"], r["milli"]) for r in octaves if r["kind"] == kind] for kind in (0, 1)]

    def distance(kinds: pd.Series, x: pd.Series, milli: pd.Series) -> pd.Series:
        out = np.zeros(len(x))
        for kind, line in enumerate(knots):
            mine = (kinds == kind).to_numpy()
            if line and mine.any():
                out[mine] = np.abs(milli[mine] - np.interp(x[mine], *zip(*line)))
        return pd.Series(np.rint(out).astype("int64"))

    far = F.pandas_udf(distance, "long")
    spreads = {(r["kind"], r["band"]): r["far"] for r in once.select(
        "kind", "band", far("kind", "x", "milli").alias("far")).groupBy("kind", "band").agg(
        F.expr("percentile(far, 0.5)").alias("far")).collect()}  # at most 2 x 6 rows
    return Limits(*[Line(
        tuple(x for x, _ in line), tuple(m / 1000 for _, m in line),
        tuple(max(MIN_SPREAD, 1.4826 * spreads.get((kind, b), 0) / 1000)
              for b in range(len(BAND_ENDS) + 1))) for kind, line in enumerate(knots)])


def _judge(texts: pd.Series, limits: Limits) -> pd.DataFrame:
    pack = zstandard.ZstdCompressor(level=LEVEL).compress
    out = []
    for text in texts:
        text = text or ""
        base = base_counts(text)
        packed = compression(text.encode("utf-8", "surrogatepass"), pack, limits)
        out.append((*base, *packed, not base[-1] and packed[-1] == "prose"))
    return pd.DataFrame(out, columns=[f.split()[0] for f in FIELDS.split(", ")])


def compression_bands(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with the columns of :data:`FIELDS` for every row.

    ``kept`` is false for a text that fails the base rules, else true only for
    verdict ``prose``.  A null or empty text has no words, so it fails the base
    rules (verdict ``empty``).  The limits are those of :func:`table_limits` on
    ``df``.  Repeated rows are judged alike; an input column
    with an output column's name is replaced; all other columns stay.
    """
    fields = [f.split()[0] for f in FIELDS.split(", ")]
    kept = [ref(c) for c in df.columns if c not in fields or c == text_col]
    limits = table_limits(df, text_col)

    def run(texts: pd.Series) -> pd.DataFrame:
        return _judge(texts, limits)

    judge = F.pandas_udf(run, FIELDS)
    judged = df.select(*kept, judge(ref(text_col)).alias("__tl_judged"))
    own = [ref(c) for c in df.columns if c not in fields]
    return judged.select(*own, *[F.col(f"__tl_judged.{f}").alias(f) for f in fields])
