"""The fact and view give the same rows whether Spark broadcasts the dimension
sides or falls back to shuffled sort-merge joins (with AQE skew splitting), also
when one tail number carries a third of all flights."""

import datetime as dt
from collections import Counter

from pyspark.sql import functions as F

from flightmart.operators import cleaning, scd2, staging
from flightmart.operators.fact import build_fact
from flightmart.operators.view import vw_flights
from flightmart.schemas import DIMS
from flightmart.sources.feed import raw_feed

SF = "/root/testdata/sf0.001"
AS_OF = dt.date(2024, 1, 1)


def _results(spark):
    raw = raw_feed(spark, SF).where(F.col("batch") == 0)
    # one hot tail number: every third flight
    raw = raw.withColumn("tailnum", F.when(F.xxhash64("transactionid") % 3 == 0, F.lit("N-HOT"))
                         .otherwise(F.col("tailnum")))
    flights = spark.createDataFrame(cleaning.clean_flights(raw).collect(), cleaning.clean_flights(raw).schema)
    dims = {}
    for name, spec in DIMS.items():
        nxt = scd2.scd2_step(scd2.empty_dim(spark, spec), staging.STAGERS[name](flights), spec, AS_OF)
        dims[name] = spark.createDataFrame(nxt.collect(), spec.schema)
    fact = build_fact(flights, dims["dim_air_route"], dims["dim_airplane"])
    view = vw_flights(fact, dims["dim_airplane"], dims["dim_air_route"], dims["dim_airport"])
    return Counter(map(tuple, fact.collect())), Counter(map(tuple, view.collect())), fact, view


def test_broadcast_and_shuffled_joins_agree(spark):
    fact_b, view_b, _, _ = _results(spark)
    old = {k: spark.conf.get(k) for k in (
        "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "1k")
        spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2")
        fact_s, view_s, fact, _ = _results(spark)
        plan = fact._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert fact_s == fact_b
    assert view_s == view_b
    assert sum(fact_b.values()) > 0
