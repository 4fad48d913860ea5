"""Clock / minute text ('1425', '1425.0') to integer."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clock_to_int(c: Column) -> Column:
    """``text::numeric::integer``: parse as a number, round half away from zero.

    A plain decimal -> int cast truncates in Spark, so round first; the scale is wide enough
    that the cast to decimal doesn't round before. Text that is
    not a number gives NULL (a flight with an unreadable clock is never a
    next-day arrival) instead of failing the whole load.
    """
    return F.round(c.try_cast("decimal(38,18)")).try_cast("int")
