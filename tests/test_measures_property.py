"""Measures against plain-Python restatements of the warehouse SQL over many values."""

import random
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from flightmart.functions import clock_to_int, distance_group, next_day_arrival, next_day_arrival_fixed


def _div(a, b):  # SQL integer division truncates toward zero
    q = abs(a) // abs(b)
    return q if (a >= 0) == (b >= 0) else -q


def _mod(a, b):  # SQL MOD keeps the dividend's sign
    return a - _div(a, b) * b


def py_band(d):
    if d is None:
        return "- miles"
    if d <= 100:
        return "0-100 miles"
    lo = _div(d - 1, 100) * 100
    return f"{lo + 1}-{lo + 100} miles"


def py_clock(t):
    try:
        return int(Decimal(t).quantize(Decimal(1), rounding=ROUND_HALF_UP))
    except Exception:
        return None


def py_next_day(dep, arr, ela, fixed):
    dep, arr, ela = py_clock(dep), py_clock(arr), py_clock(ela)
    if None in (dep, arr, ela) or not dep > arr:
        return 0
    h60 = _div(dep, 100) * 60
    dep_min = h60 + (_mod(dep, 100) if fixed else _mod(h60, 100))
    return 1 if dep_min + ela - (_div(arr, 100) * 60 + _mod(arr, 100)) > 300 else 0


def test_against_python(spark):
    rng = random.Random(11)
    dists = [rng.randint(-50, 5000) for _ in range(300)] + [None, 100, 101, 200, 201]
    df = spark.createDataFrame([(d,) for d in dists], "d int")
    assert [r[0] for r in df.select(distance_group(F.col("d"))).collect()] == [py_band(d) for d in dists]

    def clock():
        v = rng.randint(0, 2359)
        return rng.choice([str(v), f"{v}.0", f"{v}.5", f"{v}.49", "x"])

    rows = [(clock(), clock(), str(rng.randint(0, 600)) + rng.choice(["", ".0", ".5"])) for _ in range(400)]
    df = spark.createDataFrame(rows, "d string, a string, e string")
    got = df.select(clock_to_int(F.col("d")), next_day_arrival(F.col("d"), F.col("a"), F.col("e")),
                    next_day_arrival_fixed(F.col("d"), F.col("a"), F.col("e"))).collect()
    assert [r[0] for r in got] == [py_clock(d) for d, _, _ in rows]
    assert [r[1] for r in got] == [py_next_day(d, a, e, False) for d, a, e in rows]
    assert [r[2] for r in got] == [py_next_day(d, a, e, True) for d, a, e in rows]
