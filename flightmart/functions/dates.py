"""Validity-interval predicate of SCD2 versions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_of_between(as_of: dt.date, efft: str = "efft_date", expy: str = "expy_date") -> Column:
    """``as_of BETWEEN efft AND expy`` — both ends inclusive."""
    return F.lit(as_of).between(F.col(efft), F.col(expy))
