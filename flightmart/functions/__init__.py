"""Scalar column expressions (all JVM-side, codegen-friendly)."""

from flightmart.functions.text import (
    na_to_null, py_lstrip, part_before, part_after_first, first_word, pg_bool_or_null,
)
from flightmart.functions.clock import clock_to_int
from flightmart.functions.measures import (
    distance_group, dep_delay_gt15, next_day_arrival, next_day_arrival_fixed,
)
from flightmart.functions.hashing import content_hash
from flightmart.functions.dates import as_of_between

__all__ = [
    "na_to_null", "py_lstrip", "part_before", "part_after_first", "first_word", "pg_bool", "pg_bool_or_null",
    "clock_to_int", "distance_group", "dep_delay_gt15", "next_day_arrival",
    "next_day_arrival_fixed", "content_hash", "as_of_between",
]
