"""Column-level building blocks; all are built-in Spark expressions."""

from tripmart.functions.calendar import calendar_columns, hour_floor, period_of
from tripmart.functions.casts import range_checked_int, text_to_bool
from tripmart.functions.interleave import interleave, place
from tripmart.functions.keys import KEY_NULL, surrogate_key

__all__ = [
    "KEY_NULL", "calendar_columns", "hour_floor", "interleave",
    "period_of", "place", "range_checked_int", "surrogate_key", "text_to_bool",
]
