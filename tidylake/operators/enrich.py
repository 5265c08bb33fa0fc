"""Derived columns: labels, weekday, date-range flag, delay flag, endpoints.

Each operator is one ``withColumns`` over built-in expressions; Catalyst
collapses consecutive calls into a single ``Project`` inside the same
whole-stage-codegen span as the scan.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidylake.functions.labels import map_labels
from tidylake.functions.time import in_range, minutes_between, weekday_label
from tidylake.operators.projection import ref


def label_column(df: DataFrame, column: str, mapping: Mapping, default=None,
                 out: str | None = None, key_type: str | None = None) -> DataFrame:
    """``out`` (default: replace ``column``) = label of ``column``'s code."""
    return df.withColumn(out or column, map_labels(ref(column), mapping, default, key_type))


def weekday_column(df: DataFrame, column: str, labels: Mapping[str, str], out: str,
                   default: str | None = None) -> DataFrame:
    """``out`` = weekday label of the date/timestamp ``column``."""
    return df.withColumn(out, weekday_label(ref(column), labels, default))


def date_range_flag(df: DataFrame, column: str, low: str, high: str, out: str,
                    whole_days: bool = False) -> DataFrame:
    """``out`` = ``low <= column <= high`` (ISO dates, inclusive); null -> False.

    ``whole_days=False`` (reference behaviour) ends the range at midnight of
    ``high``; ``True`` includes all of that day.
    """
    return df.withColumn(out, in_range(ref(column), low, high, whole_days))


def delay_flag(df: DataFrame, actual: str, planned: str, category: str,
               thresholds: Mapping[str, float], out: str,
               wrap_midnight: bool = False) -> DataFrame:
    """``out`` = True when ``actual - planned`` in minutes reaches the threshold
    of the row's ``category``.

    ``thresholds`` maps category values to minutes.  Other categories, null
    times or a null category give False.  ``wrap_midnight`` treats both
    columns as clock times (planned 23:50, actual 00:20 -> 30 minutes late).
    """
    minutes = minutes_between(ref(actual), ref(planned), wrap_midnight)
    cond = None
    for cat, limit in thresholds.items():
        term = (minutes >= F.lit(limit)) & (ref(category) == F.lit(cat))
        cond = term if cond is None else cond | term
    flag = F.coalesce(cond, F.lit(False)) if cond is not None else F.lit(False)
    return df.withColumn(out, flag)


def directional_endpoints(df: DataFrame, direction: str, own: str, other: str,
                          out_from: str, out_to: str, outbound="D",
                          inbound="P") -> DataFrame:
    """Origin/destination from a movement direction.

    ``outbound`` rows leave ``own`` for ``other``; ``inbound`` rows arrive at
    ``own`` from ``other``.  Any other direction (or null) gives null for both.
    """
    d = ref(direction)
    start = F.when(d == F.lit(outbound), ref(own)).when(d == F.lit(inbound), ref(other))
    end = F.when(d == F.lit(inbound), ref(own)).when(d == F.lit(outbound), ref(other))
    return df.withColumns({out_from: start, out_to: end})
