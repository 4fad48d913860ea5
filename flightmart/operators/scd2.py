"""Type-2 slowly changing dimensions: one load step ``dim_prev -> dim_next``.

Semantics of a load on date ``as_of`` (the warehouse's, kept exactly):

1. *current* rows are those with ``as_of BETWEEN efft_date AND expy_date``;
2. insert (flag 'Y', efft = as_of, expy = 9999-12-31, new surrogate key) every
   stage row whose natural key has no current row (anti join), and every stage
   row whose content hash differs from a current row of its key (semi join);
3. after the insert, for every natural key with more than one current row,
   take the smallest efft_date among its current rows; every row of that key
   with that efft_date — current or already closed — gets
   ``expy = as_of - offset`` and flag 'N'. Ties expire together; keys with a
   NULL part never match and are never expired.

A load writes three small tables before the last step: the unkeyed inserts, the keyed
inserts and the (key, efft) pairs to close. The anti and the semi join run once, and the
planner knows the pairs' size when it plans the last step: the closed history is scanned, joined with the broadcast
pairs and not shuffled. If the pairs are too many to broadcast, it is a shuffled join.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightmart.functions import as_of_between, content_hash
from flightmart.operators.keys import DEFAULT_BUCKETS, assign_keys, max_key
from flightmart.schemas import CURRENT_FLAG_CLOSED, CURRENT_FLAG_OPEN, OPEN_END, DimSpec
from flightmart.session import materialize


def current_as_of(dim: DataFrame, as_of: dt.date) -> DataFrame:
    """Versions valid on ``as_of`` (both ends inclusive)."""
    return dim.where(as_of_between(as_of))


def _with_content(df: DataFrame, spec: DimSpec, hash_style: str | None) -> DataFrame:
    return df.withColumn("_content", content_hash(hash_style or spec.hash_style, *[F.col(a) for a in spec.attrs]))


def new_rows(stage: DataFrame, dim: DataFrame, spec: DimSpec, as_of: dt.date) -> DataFrame:
    """Stage rows whose natural key has no current version (NULL keys never match)."""
    cur = current_as_of(dim, as_of).select(*spec.keys)
    return stage.join(cur, on=list(spec.keys), how="left_anti")


def changed_rows(stage: DataFrame, dim: DataFrame, spec: DimSpec, as_of: dt.date,
                 hash_style: str | None = None) -> DataFrame:
    """Stage rows whose content differs from a current version of the same key."""
    s = _with_content(stage, spec, hash_style).alias("s")
    c = _with_content(current_as_of(dim, as_of).select(*spec.keys, *spec.attrs), spec, hash_style) \
        .select(*spec.keys, "_content").alias("c")
    cond = [F.col(f"s.{k}") == F.col(f"c.{k}") for k in spec.keys]
    cond.append(F.col("s._content") != F.col("c._content"))
    return s.join(c, on=cond, how="left_semi").drop("_content")


def unkeyed_inserts(stage: DataFrame, dim: DataFrame, spec: DimSpec, as_of: dt.date,
                    hash_style: str | None = None) -> DataFrame:
    """New and changed stage rows. The two parts are disjoint (a key either has a current
    version or not) and the stage is distinct, so no UNION-distinct pass is needed."""
    cols = list(spec.stage_columns)
    return new_rows(stage, dim, spec, as_of).select(*cols).unionByName(
        changed_rows(stage, dim, spec, as_of, hash_style).select(*cols))


def inserts(stage: DataFrame, dim: DataFrame, spec: DimSpec, as_of: dt.date,
            hash_style: str | None = None, key_buckets: int = DEFAULT_BUCKETS) -> DataFrame:
    """New and changed stage rows as dimension rows with fresh surrogate keys (a written table)."""
    fresh = unkeyed_inserts(stage, dim, spec, as_of, hash_style)
    return keyed_inserts(fresh, spec, as_of, max_key(dim, spec.skey), key_buckets)


def keyed_inserts(fresh: DataFrame, spec: DimSpec, as_of: dt.date, last_key: Column | int,
                  key_buckets: int = DEFAULT_BUCKETS) -> DataFrame:
    """Stage rows to insert as open dimension rows with keys after ``last_key`` (a written table)."""
    cols = list(spec.stage_columns)
    fresh = materialize(fresh, f"fresh-{spec.name}")
    keyed = assign_keys(fresh, spec.skey, last_key, order_cols=cols, buckets=key_buckets)
    return materialize(keyed.select(
        spec.skey, *cols,
        F.lit(CURRENT_FLAG_OPEN).alias("current_flag"),
        F.lit(as_of).alias("efft_date"),
        F.lit(OPEN_END).alias("expy_date"),
    ), f"inserts-{spec.name}")


def expiry_pairs(dim: DataFrame, spec: DimSpec, as_of: dt.date) -> DataFrame:
    """(natural key, efft_date) of the versions to close: per key with more than
    one current version, its earliest efft_date among them."""
    return (
        current_as_of(dim, as_of)
        .groupBy(*spec.keys)
        .agg(F.count(F.lit(1)).alias("_cnt"), F.min("efft_date").alias("efft_date"))
        .where(F.col("_cnt") > 1)
        .drop("_cnt")
    )


def expire(dim: DataFrame, spec: DimSpec, as_of: dt.date, pairs: DataFrame,
           offset_days: int | None = None) -> DataFrame:
    """Close the versions picked by :func:`expiry_pairs` (equality match on key and efft_date)."""
    offset = spec.expire_offset_days if offset_days is None else offset_days
    pairs = pairs.withColumn("_hit", F.lit(True))
    on = list(spec.keys) + ["efft_date"]
    joined = dim.join(pairs, on=on, how="left")
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    return joined.select(
        *[
            F.when(hit, F.date_sub(F.lit(as_of), offset)).otherwise(F.col(c)).alias(c) if c == "expy_date"
            else F.when(hit, F.lit(CURRENT_FLAG_CLOSED)).otherwise(F.col(c)).alias(c) if c == "current_flag"
            else F.col(c)
            for c in spec.schema.fieldNames()
        ]
    )


def scd2_step(prev: DataFrame, stage: DataFrame, spec: DimSpec, as_of: dt.date, *,
              hash_style: str | None = None, offset_days: int | None = None,
              key_buckets: int = DEFAULT_BUCKETS) -> DataFrame:
    """One load: insert new/changed versions, then expire superseded ones.

    ``stage`` is read by the anti and the semi join; pass the written stage table (as the
    daily load does), not a lazy aggregate over the flights.
    """
    prev = prev.select(*spec.schema.fieldNames())
    merged = prev.unionByName(inserts(stage, prev, spec, as_of, hash_style, key_buckets))
    pairs = materialize(expiry_pairs(merged, spec, as_of), f"pairs-{spec.name}")
    return expire(merged, spec, as_of, pairs, offset_days)


# --- the warehouse's window quantities (W1 count per key, W2 rank 1 by efft) ---
#
# ``count(*) over (partition by key)`` and ``rank() over (... order by efft)``
# would put every current row of a key into one task, and the NULL key group
# (inserted again by every load) only grows. The same values come from a
# per-key aggregate (partial, map-side) joined back on the key with NULL-safe
# equality, a join AQE can split when one key is hot.


def _per_key(dim: DataFrame, spec: DimSpec, as_of: dt.date) -> DataFrame:
    cur = current_as_of(dim, as_of)
    stats = cur.groupBy(*spec.keys).agg(
        F.count(F.lit(1)).cast("int").alias("cnt"), F.min("efft_date").alias("_min_efft"))
    c, s = cur.alias("c"), stats.alias("s")
    cond = [F.col(f"c.{k}").eqNullSafe(F.col(f"s.{k}")) for k in spec.keys]
    return c.join(s, on=cond).select("c.*", "s.cnt", "s._min_efft")


def version_counts(dim: DataFrame, spec: DimSpec, as_of: dt.date) -> DataFrame:
    """Current versions, each with the number of current versions of its key (W1)."""
    return _per_key(dim, spec, as_of).drop("_min_efft")


def expiry_candidates(dim: DataFrame, spec: DimSpec, as_of: dt.date) -> DataFrame:
    """Current versions of keys with cnt > 1 that rank first by efft_date (ties share rank 1)."""
    return (
        _per_key(dim, spec, as_of)
        .where((F.col("cnt") > 1) & (F.col("efft_date") == F.col("_min_efft")))
        .select(*spec.keys, "efft_date")
    )


def empty_dim(spark, spec: DimSpec) -> DataFrame:
    return spark.createDataFrame([], spec.schema)
