"""DataFrame -> DataFrame operators."""

from tidylake.operators.cleaning import clean_columns, fill_nulls, replace_values
from tidylake.operators.dedup import by_key, by_rare_key, rows
from tidylake.operators.enrich import (date_range_flag, delay_flag, directional_endpoints,
                                       label_column, weekday_column)
from tidylake.operators.joins import (checked_broadcast, heavy_keys, lookup, measure, referenced,
                                      role_lookup)
from tidylake.operators.projection import clean_headers, role_projection, select_renamed
from tidylake.operators.union import union_by_name

__all__ = [
    "clean_columns", "fill_nulls", "replace_values", "by_key", "by_rare_key", "rows",
    "date_range_flag", "delay_flag", "directional_endpoints", "label_column",
    "weekday_column", "checked_broadcast", "heavy_keys", "referenced", "lookup", "measure", "role_lookup", "clean_headers",
    "role_projection", "select_renamed", "union_by_name",
]
