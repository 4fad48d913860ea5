from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from flightmart.operators.cleaning import first_rows
from flightmart.operators.keys import assign_keys, bucket_of
from flightmart.session import shared_dir


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "local-cluster[2,1,1024]"])
def test_cluster_without_shared_folder_is_refused(master):
    sc = SimpleNamespace(master=master, getCheckpointDir=lambda: None)
    spark = SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda key, default=None: default))
    with pytest.raises(RuntimeError):
        shared_dir(spark)


def test_key_buckets_go_beyond_16_bits(spark):
    rows = spark.range(20_000).withColumn("b", bucket_of(["id"], 1 << 20))
    assert rows.agg(F.max("b")).first()[0] > 1 << 16
    keyed = assign_keys(spark.range(500).select(F.col("id").cast("string").alias("c")), "k", 10, buckets=100_000)
    assert sorted(r.k for r in keyed.collect()) == list(range(11, 511))


def test_first_rows(spark):
    assert first_rows(spark.range(20)).count() == 5
