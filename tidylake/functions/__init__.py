"""Column expressions.  All are built-in Spark SQL expressions (codegen'd)."""

from tidylake.functions.labels import map_labels
from tidylake.functions.text import (ZERO_WIDTH_SPACE, clean_key, clean_name, html_escape,
                                     strip_invisible)
from tidylake.functions.time import (ENGLISH_WEEKDAYS, in_range, minutes_between,
                                     seconds_between, seconds_of_day, weekday_label)

__all__ = [
    "map_labels", "ZERO_WIDTH_SPACE", "clean_key", "clean_name", "html_escape",
    "strip_invisible", "ENGLISH_WEEKDAYS", "in_range", "minutes_between",
    "seconds_between", "seconds_of_day", "weekday_label",
]
