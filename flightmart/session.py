"""Session settings and the shared scratch folder.

The warehouse jobs rely on Catalyst + AQE for join strategy, skew splitting and
partition coalescing. ``recommended_conf`` lists the settings a cluster session
should carry; ``local_session`` is what tests and the bench use.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the jobs are designed around. Sizes are per-cluster decisions; these
# are safe defaults for a large cluster (AQE coalesces small shuffles anyway).
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # HotSpot does not JIT-compile methods over 8000 bytes of bytecode; a fused
    # stage above that runs interpreted (measured 3-4x slower than no fusion).
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Dynamic overwrite lets a rerun replace one load-date partition of the fact.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "flightmart") -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in RECOMMENDED_CONF.items():
        builder = builder.config(k, v)
    builder = (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide checkpoint folder. Unset, it is a temp folder in local mode (tests) and
    an error on a cluster, where each machine would write to a disk of its own."""
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if not d:
        d = spark.conf.get("spark.checkpoint.dir", None)
        if not d:
            if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            d = tempfile.mkdtemp(prefix="flightmart-ckpt-")
        sc.setCheckpointDir(d)
        d = sc.getCheckpointDir()
    return d.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh sub-folder of the shared folder for one run."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and read it back.

    Cuts the lineage like ``checkpoint()`` but in one job (a reliable RDD
    checkpoint recomputes its plan a second time to write), and keeps the
    columnar format, so later scans prune columns and push filters.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
