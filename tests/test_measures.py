from pyspark.sql import functions as F

from flightmart.functions import (
    clock_to_int, dep_delay_gt15, distance_group, next_day_arrival, next_day_arrival_fixed,
)


def test_distance_group(spark):
    vals = [1, 100, 101, 200, 201, 569, 2500, 0, -5, None]
    df = spark.createDataFrame([(v,) for v in vals], "d int")
    got = [r[0] for r in df.select(distance_group(F.col("d"))).collect()]
    assert got == ["0-100 miles", "0-100 miles", "101-200 miles", "101-200 miles", "201-300 miles",
                   "501-600 miles", "2401-2500 miles", "0-100 miles", "0-100 miles", "- miles"]


def test_dep_delay_gt15(spark):
    df = spark.createDataFrame([(15,), (16,), (None,), (-20,)], "d int")
    assert [r[0] for r in df.select(dep_delay_gt15(F.col("d"))).collect()] == [0, 1, 0, 0]


def test_clock_to_int_rounds_half_away(spark):
    df = spark.createDataFrame([("1425",), ("1425.0",), ("1425.5",), ("-2.5",), ("abc",), (None,), ("",)], "c string")
    assert [r[0] for r in df.select(clock_to_int(F.col("c"))).collect()] == [1425, 1425, 1426, -3, None, None, None]


def test_next_day_arrival_written_vs_fixed(spark):
    # dep 23:30, arr 01:10, elapsed 100 min.
    # as written: dep minutes = 23*60 + (23*60 % 100) = 1380 + 80 = 1460; arr = 70; 1460+100-70 = 1490 > 300
    # fixed:      dep minutes = 1380 + 30 = 1410; 1410 + 100 - 70 = 1440 > 300
    # dep 07:50 -> arr 06:00 elapsed 10: written 420+20+10-360 = 90; fixed 420+50+10-360=120 (both 0)
    rows = [("2330", "110.0", "100.0"), ("750", "600", "10"), ("100", "2300", "60"), (None, "1", "1")]
    df = spark.createDataFrame(rows, "d string, a string, e string")
    w = [r[0] for r in df.select(next_day_arrival(F.col("d"), F.col("a"), F.col("e"))).collect()]
    f = [r[0] for r in df.select(next_day_arrival_fixed(F.col("d"), F.col("a"), F.col("e"))).collect()]
    assert w == [1, 0, 0, 0] and f == [1, 0, 0, 0]


def test_next_day_arrival_differs_where_minutes_wrap(spark):
    # dep 05:59, arr 00:30, elapsed 60: written 300+0+60-30 = 330 > 300 -> 1; fixed 300+59+60-30 = 389 -> 1
    # dep 05:10, arr 00:05, elapsed 0: written 300+0-5 = 295 -> 0; fixed 300+10-5 = 305 -> 1
    df = spark.createDataFrame([("559", "30", "60"), ("510", "5", "0")], "d string, a string, e string")
    w = [r[0] for r in df.select(next_day_arrival(F.col("d"), F.col("a"), F.col("e"))).collect()]
    f = [r[0] for r in df.select(next_day_arrival_fixed(F.col("d"), F.col("a"), F.col("e"))).collect()]
    assert w == [1, 0] and f == [1, 1]
