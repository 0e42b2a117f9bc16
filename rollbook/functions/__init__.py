from rollbook.functions.strings import (
    classify_strings,
    is_double,
    is_empty,
    is_int,
    is_json,
    profile_strings,
    replace_nulls,
)
from rollbook.functions.times import with_month_bounds, with_time_string

__all__ = [
    "classify_strings",
    "is_double",
    "is_empty",
    "is_int",
    "is_json",
    "profile_strings",
    "replace_nulls",
    "with_month_bounds",
    "with_time_string",
]
