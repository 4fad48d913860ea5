"""Checkable loads over the derived feed: the registered queries.

Every function takes ``(spark, sf_dir)`` and returns a DataFrame computed from
the driver tables. The load history is the one of FIXTURES.md: batch 0 loaded
as of 2024-01-01, batch 1 as of 2024-02-01, batch 1 again the same day, then
batch 0 as of 2024-03-01. Dimensions are carried between loads as DataFrames
whose lineage is cut after every load by writing them to the cluster's shared
checkpoint folder (``materialize``).
"""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flightmart.functions import clock_to_int
from flightmart.operators import cleaning, fact, scd2, staging
from flightmart.operators.view import vw_flights
from flightmart.plans.daily_load import LoadOptions, daily_load
from flightmart.schemas import AIR_ROUTE, AIRPLANE, AIRPORT, DIMS, FLIGHTS, STG_AIR_ROUTE, STG_AIRPLANE
from flightmart.session import materialize, scratch_path
from flightmart.sources.feed import FEED_COLUMNS, batch_feed, raw_feed
from flightmart.sources.pipe_file import read_pipe_file, write_pipe_file
from flightmart.sources.store import TableStore

LOADS = (
    (dt.date(2024, 1, 1), 0),
    (dt.date(2024, 2, 1), 1),
    (dt.date(2024, 2, 1), 1),
    (dt.date(2024, 3, 1), 0),
)
SECOND = LOADS[1]

# ---------------------------------------------------------------------------
# shared building blocks
# ---------------------------------------------------------------------------


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived feed written once as the raw input, as a file scan feeds a
    real load (cleaning rules are then not fused into the feed's own
    projection, which would make one oversized generated method)."""
    return materialize(raw_feed(spark, sf_dir), "raw")


#: The flights' columns that each dimension is staged from, and those a fact row is built from.
STAGED_FROM = {
    "dim_airplane": STG_AIRPLANE.fieldNames(),
    "dim_airport": ["originairportcode", "origairportname", "origincityname",
                    "destairportcode", "destairportname", "destcityname"],
    "dim_air_route": STG_AIR_ROUTE.fieldNames(),
}
FACT_FROM = ["transactionid", "tailnum", *AIR_ROUTE.keys, "depdelay", "deptime", "arrtime", "actualelapsedtime"]


def _clean(spark: SparkSession, sf_dir: str, *dims: str, columns=()) -> DataFrame:
    """Cleaned flights of both batches (``batch`` passes through), lineage cut.

    The feed is cleaned in the pass that makes it; every row passes every rule. Only the columns that some
    dimensions are staged from and ``columns`` are written (all of them without either)."""
    wanted = {"batch", *columns, *[c for name in dims for c in STAGED_FROM[name]]}
    kept = [c for c in FEED_COLUMNS if c in wanted or wanted == {"batch"}]
    clean = cleaning.clean_flights(raw_feed(spark, sf_dir)).select(*kept)
    # a folder per batch, so a load scans its own batch only
    path = scratch_path(spark, "clean")
    clean.write.partitionBy("batch").parquet(path)
    return spark.read.schema(clean.schema).parquet(path)


#: For queries that name columns: the oracle tests share the whole cleaned flights under ``_clean``.
_clean_for = _clean


def _batch(clean: DataFrame, b: int) -> DataFrame:
    return clean.where(F.col("batch") == b)


def _dim_history(spark: SparkSession, clean: DataFrame, spec, loads=LOADS) -> list[DataFrame]:
    """Snapshots of one dimension after each load."""
    dim = scd2.empty_dim(spark, spec)
    out = []
    for as_of, b in loads:
        # the stage table is refilled and read back, as the load does
        stage = materialize(staging.STAGERS[spec.name](_batch(clean, b)), f"stg-{spec.name}")
        dim = materialize(scd2.scd2_step(dim, stage, spec, as_of), spec.name)
        out.append(dim)
    return out


def _histories(spark: SparkSession, clean: DataFrame, n: int) -> dict[str, list[DataFrame]]:
    """All three dimension histories; they are independent, so their jobs are
    submitted concurrently (as the daily load does)."""
    with ThreadPoolExecutor(max_workers=len(DIMS)) as pool:
        futs = {name: pool.submit(_dim_history, spark, clean, spec, LOADS[:n]) for name, spec in DIMS.items()}
        return {name: f.result() for name, f in futs.items()}


def _public(spec) -> list[str]:
    """Dimension columns compared by the oracle (surrogate key left out)."""
    return [c for c in spec.schema.fieldNames() if c != spec.skey]


# ---------------------------------------------------------------------------
# scans, NA handling, filters, cleaning
# ---------------------------------------------------------------------------


def q_scan_pipe_file(spark, sf_dir):
    path = scratch_path(spark, "raw-feed")
    write_pipe_file(raw_feed(spark, sf_dir), path)
    return read_pipe_file(spark, path)


def q_na_tokens(spark, sf_dir):
    return cleaning.normalize_na(_raw(spark, sf_dir))


def q_drop_cancelled(spark, sf_dir):
    return cleaning.drop_cancelled(cleaning.normalize_na(_raw(spark, sf_dir)))


def q_drop_diverted(spark, sf_dir):
    return cleaning.drop_diverted(cleaning.normalize_na(_raw(spark, sf_dir)))


def q_drop_bad_tailnum(spark, sf_dir):
    return cleaning.drop_bad_tailnum(cleaning.normalize_na(_raw(spark, sf_dir)))


def q_clean_names(spark, sf_dir):
    df = cleaning.clean_names(cleaning.normalize_na(_raw(spark, sf_dir)))
    return df.select("batch", "transactionid", "airlinename", "origairportname", "destairportname")


def q_clock_to_int(spark, sf_dir):
    df = cleaning.normalize_na(_raw(spark, sf_dir))
    return df.select(
        "transactionid",
        *[clock_to_int(F.col(c)).alias(f"{c}_int") for c in ("deptime", "arrtime", "actualelapsedtime")],
    )


def q_clean_flights(spark, sf_dir):
    return cleaning.clean_flights(_raw(spark, sf_dir)).select(*FEED_COLUMNS)


def q_load_profile(spark, sf_dir):
    return cleaning.load_profile(_raw(spark, sf_dir), by=("batch",))


# ---------------------------------------------------------------------------
# measures
# ---------------------------------------------------------------------------


def _measured(spark, sf_dir):
    return fact.measures(cleaning.clean_flights(_raw(spark, sf_dir)))


def q_distance_group(spark, sf_dir):
    return _measured(spark, sf_dir).select("transactionid", "distance", "distancegroup")


def q_dep_delay_gt15(spark, sf_dir):
    return _measured(spark, sf_dir).select(
        "transactionid", "depdelay", F.col("depdelaygt15").cast("int").alias("depdelaygt15"))


def q_next_day_arrival(spark, sf_dir):
    return _measured(spark, sf_dir).select(
        "transactionid", F.col("nextdayarr").cast("int").alias("nextdayarr"))


def q_next_day_arrival_fixed(spark, sf_dir):
    df = fact.measures(cleaning.clean_flights(_raw(spark, sf_dir)), fixed_next_day=True)
    return df.select("transactionid", F.col("nextdayarr").cast("int").alias("nextdayarr"))


# ---------------------------------------------------------------------------
# staging
# ---------------------------------------------------------------------------


def _stage_query(name):
    def q(spark, sf_dir):
        clean = cleaning.clean_flights(_raw(spark, sf_dir))
        return staging.STAGERS[name](clean, by=("batch",))
    return q


# ---------------------------------------------------------------------------
# SCD2 pieces on the second load (batch 1 as of 2024-02-01 over the first load)
# ---------------------------------------------------------------------------


def _second_load_inputs(spark, sf_dir, spec):
    clean = _clean_for(spark, sf_dir, spec.name)
    dim1 = _dim_history(spark, clean, spec, LOADS[:1])[-1]
    stage2 = materialize(staging.STAGERS[spec.name](_batch(clean, SECOND[1])), f"stg-{spec.name}")
    return clean, dim1, stage2


def _new_query(spec):
    def q(spark, sf_dir):
        _, dim1, stage2 = _second_load_inputs(spark, sf_dir, spec)
        return scd2.new_rows(stage2, dim1, spec, SECOND[0])
    return q


def _changed_query(spec):
    def q(spark, sf_dir):
        _, dim1, stage2 = _second_load_inputs(spark, sf_dir, spec)
        return scd2.changed_rows(stage2, dim1, spec, SECOND[0])
    return q


def _all_dims(spark, sf_dir, fn, loads: int = 2) -> DataFrame:
    """``fn(dimension, spec)`` of all three dimensions, after ``loads`` loads, in one table."""
    clean = _clean_for(spark, sf_dir, *DIMS)
    hist = _histories(spark, clean, loads)
    parts = [fn(clean, hist[name], spec) for name, spec in DIMS.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _text(cols) -> Column:
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in cols])


def _described(df: DataFrame, spec, *extra: str) -> DataFrame:
    """``dim``, natural key and attributes as text, and ``extra`` columns."""
    return df.select(F.lit(spec.name).alias("dim"), _text(spec.keys).alias("natural_key"),
                     _text(spec.attrs).alias("attributes"), *extra)


def _merged_second_load(clean, history, spec):
    """Dimension after the second load's insert, before its expiry step."""
    stage2 = materialize(staging.STAGERS[spec.name](_batch(clean, SECOND[1])), f"stg-{spec.name}")
    return history[0].unionByName(scd2.inserts(stage2, history[0], spec, SECOND[0]))


def q_version_counts(spark, sf_dir):
    def counts(clean, history, spec):
        m = _merged_second_load(clean, history, spec)
        return _described(scd2.version_counts(m, spec, SECOND[0]), spec, "current_flag", "efft_date", "expy_date", "cnt")
    return _all_dims(spark, sf_dir, counts, 1)


def q_expiry_candidates(spark, sf_dir):
    def candidates(clean, history, spec):
        m = scd2.expiry_candidates(_merged_second_load(clean, history, spec), spec, SECOND[0])
        return m.select(F.lit(spec.name).alias("dim"), _text(spec.keys).alias("natural_key"), "efft_date")
    return _all_dims(spark, sf_dir, candidates, 1)


def q_surrogate_keys(spark, sf_dir):
    """Keys issued to the versions of all dimensions over the first two loads."""
    return _all_dims(spark, sf_dir, lambda clean, history, spec: _described(
        history[-1].withColumn("skey", F.col(spec.skey)), spec, "skey", "efft_date"))


def q_current_as_of(spark, sf_dir):
    return _all_dims(spark, sf_dir, lambda clean, history, spec: _described(
        scd2.current_as_of(history[-1], SECOND[0]), spec, "current_flag", "efft_date", "expy_date"))


def _scd2_query(spec):
    def q(spark, sf_dir):
        clean = _clean_for(spark, sf_dir, spec.name)
        snaps = _dim_history(spark, clean, spec)
        out = None
        for i, d in enumerate(snaps, start=1):
            part = d.select(F.lit(i).alias("load_no"), *_public(spec))
            out = part if out is None else out.unionByName(part)
        return out
    return q


# ---------------------------------------------------------------------------
# fact and view after two loads
# ---------------------------------------------------------------------------


def _two_loads(spark, sf_dir):
    clean = _clean_for(spark, sf_dir, *DIMS, columns=FACT_FROM)
    hist = _histories(spark, clean, 2)
    facts = []
    for i, (as_of, b) in enumerate(LOADS[:2]):
        f = fact.build_fact(_batch(clean, b), hist["dim_air_route"][i], hist["dim_airplane"][i])
        facts.append(f.withColumn("load_date", F.lit(as_of)))
    return clean, {k: v[-1] for k, v in hist.items()}, facts[0].unionByName(facts[1])


def _lookup(spark, sf_dir, spec, lookup, names: dict[str, str], keys) -> DataFrame:
    """The lookup of both loads, each against the dimension after it."""
    clean = _clean_for(spark, sf_dir, spec.name, columns=["transactionid", *keys])
    out = None
    for i, dim in enumerate(_dim_history(spark, clean, spec, LOADS[:2])):
        flights = _batch(clean, LOADS[i][1]).select("transactionid", *keys)
        part = lookup(flights, dim.withColumnsRenamed(names), extra=tuple(names.values()))
        part = part.select(F.lit(i + 1).alias("load_no"), "transactionid", *names.values())
        out = part if out is None else out.unionByName(part)
    return out


def q_fact_route_lookup(spark, sf_dir):
    names = {"crsdeptime": "route_crsdeptime", "crsarrtime": "route_crsarrtime", "efft_date": "route_efft_date"}
    return _lookup(spark, sf_dir, AIR_ROUTE, fact.route_lookup, names, AIR_ROUTE.keys)


def q_fact_airplane_lookup(spark, sf_dir):
    names = {"airlinecode": "airplane_airlinecode", "airlinename": "airplane_airlinename", "efft_date": "airplane_efft_date"}
    return _lookup(spark, sf_dir, AIRPLANE, fact.airplane_lookup, names, AIRPLANE.keys)


def q_fact_flights(spark, sf_dir):
    _, _, facts = _two_loads(spark, sf_dir)
    return facts.select(
        "load_date", "transactionid", "distance", "distancegroup", "depdelay",
        F.col("depdelaygt15").cast("int").alias("depdelaygt15"),
        F.col("nextdayarr").cast("int").alias("nextdayarr"),
        F.col("air_route_skey").isNotNull().alias("has_route"),
        F.col("airplane_skey").isNotNull().alias("has_airplane"),
    )


def _view_out(df: DataFrame) -> DataFrame:
    return df.select(
        "transactionid", "distancegroup", F.col("depdelaygt15").cast("int").alias("depdelaygt15"),
        F.col("nextdayarr").cast("int").alias("nextdayarr"), "airlinename", "origairportname", "destairportname")


def q_vw_flights(spark, sf_dir):
    _, dims, facts = _two_loads(spark, sf_dir)
    return _view_out(vw_flights(facts, dims["dim_airplane"], dims["dim_air_route"], dims["dim_airport"]))


# ---------------------------------------------------------------------------
# store round trips
# ---------------------------------------------------------------------------


def q_flights_refresh(spark, sf_dir):
    """FLIGHTS_DLT after loading batch 0 and then refreshing it with batch 1.

    Each batch is cleaned as its snapshot is written, as a load does; orders of the other batch are left out
    before lineitem is joined."""
    store = TableStore(spark, scratch_path(spark, "store"))
    store.ensure_tables()
    for b in (0, 1):
        store.write_snapshot("flights_dlt", cleaning.to_flights_table(cleaning.clean_flights(batch_feed(spark, sf_dir, b))))
    return store.read("flights_dlt").select(*FLIGHTS.fieldNames())


def q_two_batch_load(spark, sf_dir):
    """End to end: two raw pipe files, two daily loads into a fresh store, the view.

    The files arrive compressed: as plain text they are larger than all tables of the store."""
    root = scratch_path(spark, "warehouse")
    store = TableStore(spark, root)
    result = None
    for as_of, b in LOADS[:2]:
        path = f"{root}/_incoming/batch={b}"
        write_pipe_file(batch_feed(spark, sf_dir, b), path, compression="gzip")
        result = daily_load(spark, store, path, as_of, LoadOptions())
    return _view_out(result)


QUERIES = {
    "scan_pipe_file": q_scan_pipe_file,
    "na_tokens": q_na_tokens,
    "drop_cancelled": q_drop_cancelled,
    "drop_diverted": q_drop_diverted,
    "drop_bad_tailnum": q_drop_bad_tailnum,
    "clean_names": q_clean_names,
    "clock_to_int": q_clock_to_int,
    "clean_flights": q_clean_flights,
    "load_profile": q_load_profile,
    "distance_group": q_distance_group,
    "dep_delay_gt15": q_dep_delay_gt15,
    "next_day_arrival": q_next_day_arrival,
    "next_day_arrival_fixed": q_next_day_arrival_fixed,
    "stage_airplane": _stage_query("dim_airplane"),
    "stage_airport": _stage_query("dim_airport"),
    "stage_air_route": _stage_query("dim_air_route"),
    "surrogate_keys": q_surrogate_keys,
    "current_as_of": q_current_as_of,
    "new_airplanes": _new_query(AIRPLANE),
    "new_airports": _new_query(AIRPORT),
    "new_routes": _new_query(AIR_ROUTE),
    "changed_airplanes": _changed_query(AIRPLANE),
    "changed_airports": _changed_query(AIRPORT),
    "changed_routes": _changed_query(AIR_ROUTE),
    "version_counts": q_version_counts,
    "expiry_candidates": q_expiry_candidates,
    "scd2_airplane": _scd2_query(AIRPLANE),
    "scd2_airport": _scd2_query(AIRPORT),
    "scd2_air_route": _scd2_query(AIR_ROUTE),
    "fact_route_lookup": q_fact_route_lookup,
    "fact_airplane_lookup": q_fact_airplane_lookup,
    "fact_flights": q_fact_flights,
    "vw_flights": q_vw_flights,
    "flights_refresh": q_flights_refresh,
    "two_batch_load": q_two_batch_load,
}
