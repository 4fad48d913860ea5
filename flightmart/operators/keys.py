"""Surrogate keys: dense integers for new dimension rows, without a global sort.

``row_number() over (order by ...)`` would pull every row into one partition.
Instead each row goes to one of ``buckets`` hash buckets (a hash of its own
content, so the choice is the same on every recomputation, whatever the
partitioning); per-bucket counts (at most ``buckets`` rows, a bound fixed by
configuration, not by data) give each bucket its starting offset; within a
bucket rows are numbered in content order. Keys start after the largest key
already issued, as a sequence would.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_BUCKETS = 256


def bucket_of(cols: list[str], buckets: int = DEFAULT_BUCKETS) -> Column:
    """Stable bucket: first 32 bits of md5 over the row's text, modulo ``buckets``."""
    text = F.concat_ws("|", *[F.col(c).cast("string") for c in cols])
    return F.pmod(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long"), F.lit(buckets).cast("long"))


def assign_keys(rows: DataFrame, key_col: str, start_after: Column | int,
                order_cols: list[str] | None = None, buckets: int = DEFAULT_BUCKETS) -> DataFrame:
    """Add ``key_col`` = start_after + 1 .. start_after + n over the (distinct) rows.

    ``rows`` is read twice, for the per-bucket counts and for the numbering: pass a written
    table. The counts are partial aggregates (at most ``buckets`` rows a task), turned into
    offsets and broadcast (at most ``buckets`` rows in all); the numbering takes one exchange
    by bucket.
    """
    order_cols = order_cols or rows.columns
    b = rows.withColumn("_kb", bucket_of(order_cols, buckets))
    numbered = b.withColumn("_rn", F.row_number().over(
        Window.partitionBy("_kb").orderBy(*[F.col(c).asc_nulls_first() for c in order_cols])))
    counts = b.groupBy("_kb").agg(F.count(F.lit(1)).alias("_n"))
    # At most `buckets` rows: the running total runs in one small task.
    offsets = counts.select(
        "_kb",
        F.coalesce(F.sum("_n").over(Window.orderBy("_kb").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_off"),
    )
    base = start_after if isinstance(start_after, Column) else F.lit(start_after)
    return (
        numbered.join(F.broadcast(offsets), "_kb")
        .withColumn(key_col, (base + F.col("_off") + F.col("_rn")).cast("int"))
        .drop("_kb", "_off", "_rn")
    )


def max_key(dim: DataFrame, key_col: str) -> Column:
    """Largest key issued so far, as a scalar subquery (0 for an empty table)."""
    return dim.agg(F.coalesce(F.max(key_col), F.lit(0)).cast("long")).scalar()
