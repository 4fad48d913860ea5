"""Derived measures of the flight fact: distance band, late departure, next-day arrival."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from flightmart.functions.clock import clock_to_int
from flightmart.schemas import (
    DEP_DELAY_THRESHOLD, DISTANCE_BAND_WIDTH, DISTANCE_FIRST_BAND, DISTANCE_SUFFIX,
    NEXT_DAY_GAP_MINUTES,
)


def int_div(a: Column, b: int) -> Column:
    """SQL integer division: truncates toward zero (Spark '%' keeps the dividend's sign)."""
    return ((a - a % b) / b).cast("int")


def distance_group(distance: Column) -> Column:
    """'0-100 miles' up to 100, then '101-200 miles', '201-300 miles', ...

    A NULL distance falls through to the band branch, whose concatenation
    skips NULLs and yields '- miles', as the warehouse's CONCAT does.
    """
    w = DISTANCE_BAND_WIDTH
    base = int_div(distance - 1, w) * w
    band = F.concat(
        F.coalesce((base + 1).cast("string"), F.lit("")), F.lit("-"),
        F.coalesce((base + w).cast("string"), F.lit("")), F.lit(DISTANCE_SUFFIX),
    )
    return F.when(distance <= w, F.lit(DISTANCE_FIRST_BAND)).otherwise(band)


def dep_delay_gt15(depdelay: Column) -> Column:
    """1 when the departure delay exceeds 15 minutes; NULL counts as 0."""
    return F.when(depdelay > DEP_DELAY_THRESHOLD, 1).otherwise(0).cast("smallint")


def next_day_arrival(deptime: Column, arrtime: Column, elapsed: Column, fixed: bool = False) -> Column:
    """1 when the arrival falls on the next day, else 0.

    As written, departure minutes are ``dep/100*60 + MOD(dep/100*60, 100)``;
    with ``fixed=True`` they are ``dep/100*60 + MOD(dep, 100)``, the form the
    arrival side always uses.
    """
    dep = clock_to_int(deptime)
    arr = clock_to_int(arrtime)
    ela = clock_to_int(elapsed)
    dep_h60 = int_div(dep, 100) * 60
    dep_min = dep_h60 + (dep % 100 if fixed else dep_h60 % 100)
    arr_min = int_div(arr, 100) * 60 + arr % 100
    cond = (dep > arr) & ((dep_min + ela - arr_min) > NEXT_DAY_GAP_MINUTES)
    return F.when(cond, 1).otherwise(0).cast("smallint")


def next_day_arrival_fixed(deptime: Column, arrtime: Column, elapsed: Column) -> Column:
    return next_day_arrival(deptime, arrtime, elapsed, fixed=True)
