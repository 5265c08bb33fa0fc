"""Date/time expressions: weekday labels, differences, ranges, clock times."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidylake.functions.labels import map_labels

# Spark's dayofweek(): 1 = Sunday ... 7 = Saturday.
ENGLISH_WEEKDAYS = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday",
                    "Saturday")


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def weekday_label(column: str | Column, labels: Mapping[str, str],
                  default: str | None = None) -> Column:
    """Label of the weekday of a date/timestamp.

    ``labels`` maps English weekday names to output labels.  The day is taken
    with ``dayofweek`` (an integer, locale-free) instead of formatting a name
    per row.  Null input or a day missing from ``labels`` gives ``default``.
    """
    by_number = {i + 1: labels[name] for i, name in enumerate(ENGLISH_WEEKDAYS)
                 if name in labels}
    return map_labels(F.dayofweek(_col(column)), by_number, default)


def seconds_between(later: str | Column, earlier: str | Column) -> Column:
    """Whole seconds from ``earlier`` to ``later`` (fractions truncated)."""
    return F.unix_timestamp(_col(later)) - F.unix_timestamp(_col(earlier))


def minutes_between(later: str | Column, earlier: str | Column,
                    wrap_midnight: bool = False) -> Column:
    """Minutes (double) from ``earlier`` to ``later``.

    ``wrap_midnight`` is for clock times without a date: the difference is
    brought into ``[-12h, +12h)``, so planned 23:50 / actual 00:20 is +30.
    """
    secs = seconds_between(later, earlier)
    if wrap_midnight:
        secs = F.pmod(secs + F.lit(43200), F.lit(86400)) - F.lit(43200)
    return secs / F.lit(60.0)


def seconds_of_day(column: str | Column) -> Column:
    """Seconds since midnight of a clock-time string ``H:MM[:SS]``.

    Keeps the date out of clock columns, so a re-run gives the same value
    (parsing ``10:30`` as a timestamp would stamp it with the day of the read).
    Malformed text gives null, also where only the seconds are malformed;
    absent seconds are zero.
    """
    parts = F.split(F.trim(_col(column)), ":")
    h = F.get(parts, 0).try_cast("int")
    m = F.get(parts, 1).try_cast("int")
    s = F.when(F.size(parts) < 3, F.lit(0)).otherwise(F.get(parts, 2).try_cast("int"))
    ok = (h.between(0, 23) & m.between(0, 59) & s.between(0, 59)
          & (F.size(parts) <= 3))
    return F.when(ok, h * 3600 + m * 60 + s)


def in_range(column: str | Column, low: str, high: str, whole_days: bool = False) -> Column:
    """``low <= column <= high`` for ISO date strings; never null.

    The literals are cast to the column's own type by Spark's coercion, so a
    plain ``timestamp_ntz`` column is compared without a per-row cast.  With
    ``whole_days`` the last day is included entirely (``< high + 1 day``);
    otherwise the end is ``high`` at midnight.  Null input gives ``False``.
    """
    c = _col(column)
    if whole_days:
        stop = (_dt.date.fromisoformat(high[:10]) + _dt.timedelta(days=1)).isoformat()
        pred = (c >= F.lit(low)) & (c < F.lit(stop))
    else:
        pred = c.between(F.lit(low), F.lit(high))
    return F.coalesce(pred, F.lit(False))
