"""Registered queries of the opt-in load mechanisms, over the feed and load history of ``scenario``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flightmart.operators import cleaning, inferred, intervals, scd2, staging
from flightmart.operators.scd2_single import single_step
from flightmart.operators.scd2_sliced import sliced_step
from flightmart.plans.daily_load import LoadOptions, daily_load, view
from flightmart.plans.scenario import (  # noqa: F401 (_clean: see _clean_for)
    FACT_FROM, LOADS, _batch, _clean, _clean_for, _histories, _public, _raw, _text, _view_out,
)
from flightmart.schemas import AIR_ROUTE, AIRPLANE, AIRPORT, DIMS, FLIGHTS, DimSpec
from flightmart.session import materialize, scratch_path
from flightmart.sources.feed import FEED_COLUMNS, batch_feed, raw_feed
from flightmart.sources.pipe_file import write_pipe_file
from flightmart.sources.quoted_file import read_quoted_file
from flightmart.sources.slices import SlicedVersion, base_path
from flightmart.sources.store import LOAD_DATE, TableStore


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# -- sliced dimensions -----------------------------------------------------------


def _sliced_history(spark: SparkSession, clean: DataFrame, spec: DimSpec) -> list[SlicedVersion]:
    """The sliced versions of one dimension after each load."""
    now = SlicedVersion(spec, base_path(scratch_path(spark, "sliced"), spec.name), 0)
    out = []
    for i, (as_of, b) in enumerate(LOADS, start=1):
        stage = materialize(staging.STAGERS[spec.name](_batch(clean, b)), f"stg-{spec.name}")
        now = sliced_step(spark, now, stage, as_of, i)
        out.append(now)
    return out


def _sliced_query(spec: DimSpec) -> Callable[[SparkSession, str], DataFrame]:
    def q(spark, sf_dir):
        versions = _sliced_history(spark, _clean_for(spark, sf_dir, spec.name), spec)
        return _union([v.read(spark).select(F.lit(i).alias("load_no"), *_public(spec))
                       for i, v in enumerate(versions, start=1)])
    return q


def q_dimension_slices(spark, sf_dir):
    """Which slices each load holds, and which of them it wrote."""
    clean = _clean_for(spark, sf_dir, *DIMS)
    parts = []
    for name, spec in DIMS.items():
        for i, v in enumerate(_sliced_history(spark, clean, spec), start=1):
            rows = v.read(spark).withColumn("state", F.when(F.year("expy_date") == 9999, "open").otherwise("closed"))
            counts = rows.groupBy("state", "efft_date").agg(F.count(F.lit(1)).alias("n_rows"))
            listed = spark.createDataFrame([(s.state, s.efft_date, s.version == i) for s in v.slices],
                                           "state string, efft_date date, written boolean")
            listed = listed.groupBy("state", "efft_date").agg(F.max("written").alias("written"))
            parts.append(counts.join(listed, ["state", "efft_date"], "full").select(
                F.lit(name).alias("dim"), F.lit(i).alias("load_no"), "state", "efft_date", "n_rows", "written"))
    return _union(parts)


def q_multi_version_keys(spark, sf_dir):
    """The keys that each load hands on as having several versions that may still be current."""
    clean = _clean_for(spark, sf_dir, *DIMS)
    return _union([v.multi(spark).select(F.lit(name).alias("dim"), F.lit(i).alias("load_no"), _text(spec.keys).alias("natural_key"))
                   for name, spec in DIMS.items()
                   for i, v in enumerate(_sliced_history(spark, clean, spec), start=1)])


# -- one current row per key -------------------------------------------------------


def _single_query(spec: DimSpec) -> Callable[[SparkSession, str], DataFrame]:
    def q(spark, sf_dir):
        clean = _clean_for(spark, sf_dir, spec.name)
        dim, parts = scd2.empty_dim(spark, spec), []
        for i, (as_of, b) in enumerate(LOADS, start=1):
            stage = materialize(staging.STAGERS[spec.name](_batch(clean, b)), f"stg-{spec.name}")
            dim = materialize(single_step(dim, stage, spec, as_of), spec.name)
            parts.append(dim.select(F.lit(i).alias("load_no"), *spec.schema.fieldNames()))
        return _union(parts).withColumnRenamed(spec.skey, "skey")
    return q


# -- fact and view -------------------------------------------------------------------


def _fact_out(fact: DataFrame) -> DataFrame:
    return fact.select(
        LOAD_DATE, "transactionid", "distance", "distancegroup", "depdelay",
        F.col("depdelaygt15").cast("int").alias("depdelaygt15"), F.col("nextdayarr").cast("int").alias("nextdayarr"),
        F.col("air_route_skey").isNotNull().alias("has_route"), F.col("airplane_skey").isNotNull().alias("has_airplane"))


def q_fact_append_new_only(spark, sf_dir):
    """The fact after all four loads where flights that it holds are not appended again."""
    store = TableStore(spark, scratch_path(spark, "warehouse"))
    raw = _raw(spark, sf_dir)
    for as_of, b in LOADS:
        daily_load(spark, store, _batch(raw, b).drop("batch"), as_of, LoadOptions(skip_known_transactions=True))
    return _fact_out(store.read("fact_flights"))


def _one_row_facts(spark, sf_dir) -> tuple[DataFrame, dict[str, DataFrame]]:
    clean = _clean_for(spark, sf_dir, *DIMS, columns=FACT_FROM)
    hist = _histories(spark, clean, 2)
    facts = _union([intervals.build_fact_at(_batch(clean, b), hist["dim_air_route"][i], hist["dim_airplane"][i], as_of)
                    .withColumn(LOAD_DATE, F.lit(as_of)) for i, (as_of, b) in enumerate(LOADS[:2])])
    return facts, {k: v[-1] for k, v in hist.items()}


def q_fact_one_row(spark, sf_dir):
    """One fact row a flight, with the keys of the versions that fit its load date."""
    facts, _ = _one_row_facts(spark, sf_dir)
    return facts.select(LOAD_DATE, "transactionid", "air_route_skey", "airplane_skey")


def q_vw_flights_one_row(spark, sf_dir):
    facts, dims = _one_row_facts(spark, sf_dir)
    facts = materialize(facts, "fact-one-row")
    return _view_out(intervals.vw_flights_at(facts, dims["dim_airplane"], dims["dim_air_route"], dims["dim_airport"],
                                             F.col(LOAD_DATE)))


def q_vw_flights_after_first_load(spark, sf_dir):
    """The report as it was after the first load, read when the second has been published."""
    store = TableStore(spark, scratch_path(spark, "warehouse"))
    raw = _raw(spark, sf_dir)
    for n, (as_of, b) in enumerate(LOADS[:2], start=1):
        daily_load(spark, store, _batch(raw, b).drop("batch"), as_of, load_id=f"load-{n}")
    return _view_out(view(store, name=None, commit=store.commit_of("load-1")))


def q_load_each_file_once(spark, sf_dir):
    """Two files (compressed, as in ``two_batch_load``), the second load given both folders and a third given the
    first again: the view."""
    root = scratch_path(spark, "warehouse")
    store = TableStore(spark, root)
    paths = {}
    for b in (0, 1):
        paths[b] = f"{root}/_incoming/batch-{b}"
        write_pipe_file(batch_feed(spark, sf_dir, b), paths[b], compression="gzip")
    opts = LoadOptions(new_files_only=True)
    daily_load(spark, store, paths[0], LOADS[0][0], opts)
    daily_load(spark, store, [paths[0], paths[1]], LOADS[1][0], opts)
    return _view_out(daily_load(spark, store, [paths[0], paths[1]], LOADS[3][0], opts))


def q_vw_flights_sliced(spark, sf_dir):
    """The view over two loads of a store with sliced dimensions."""
    store = TableStore(spark, scratch_path(spark, "warehouse"))
    raw = _raw(spark, sf_dir)
    out = None
    for as_of, b in LOADS[:2]:
        out = daily_load(spark, store, _batch(raw, b).drop("batch"), as_of, LoadOptions(sliced_dimensions=True))
    return _view_out(out)


# -- inferred types ---------------------------------------------------------------------


def q_column_kinds(spark, sf_dir):
    return inferred.column_kinds(raw_feed(spark, sf_dir).drop("batch"))


def q_flights_as_read(spark, sf_dir):
    """The feed's text as it is loaded when the reader infers the columns' types."""
    return inferred.as_read(_raw(spark, sf_dir))


# -- quoted line breaks -----------------------------------------------------------------


def q_scan_quoted_lines(spark, sf_dir):
    """The feed with city names of two lines, written as pipe files and read back split by split."""
    df = raw_feed(spark, sf_dir)
    two = F.concat("destcityname", F.lit("\n\"East|West\""))
    df = df.withColumn("destcityname", F.when(F.col("transactionid").like("%7"), two).otherwise(F.col("destcityname")))
    path = scratch_path(spark, "raw-quoted")
    write_pipe_file(df, path)
    return read_quoted_file(spark, path)


# -- rejects -----------------------------------------------------------------------------

#: Faults planted in the feed, by the last digits of the transaction id.
FAULTS = (
    ("depdelay", "%13", "'late'"), ("airlinename", "%27", "null"), ("origairportname", "%41", "'no colon'"),
    ("distance", "%55", "'far'"), ("flightdate", "%69", "'2002-13-45'"), ("cancelled", "%83", "'maybe'"),
    ("destairportname", "%97", "null"), ("depdelay", "%55", "'NaN'"), ("diverted", "%313", "''"),
)


def _faulty(spark, sf_dir) -> DataFrame:
    df = raw_feed(spark, sf_dir)
    for column, like, value in FAULTS:
        df = df.withColumn(column, F.expr(f"case when transactionid like '{like}' then {value} else {column} end"))
    return materialize(df, "raw-faulty")


def q_rejects_by_rule(spark, sf_dir):
    return cleaning.rejects_by_rule(cleaning.judged_flights(_faulty(spark, sf_dir)))


def q_tolerated_flights(spark, sf_dir):
    """FLIGHTS_DLT after a load that puts bad rows aside."""
    store = TableStore(spark, scratch_path(spark, "warehouse"))
    daily_load(spark, store, _faulty(spark, sf_dir).drop("batch"), LOADS[0][0], LoadOptions(tolerated_rejects=0.5))
    return store.read("flights_dlt").select(*FLIGHTS.fieldNames())


def q_rejected_flights(spark, sf_dir):
    """What that load put aside: the raw text of bad rows and the rules they break."""
    store = TableStore(spark, scratch_path(spark, "warehouse"))
    daily_load(spark, store, _faulty(spark, sf_dir).drop("batch"), LOADS[0][0], LoadOptions(tolerated_rejects=0.5))
    kept = [c for c in FEED_COLUMNS if c != "batch"]
    return store.rejects().select(*kept, F.array_join("rules", "; ").alias("rules"))


QUERIES = {
    "scd2_sliced_airplane": _sliced_query(AIRPLANE),
    "scd2_sliced_airport": _sliced_query(AIRPORT),
    "scd2_sliced_air_route": _sliced_query(AIR_ROUTE),
    "dimension_slices": q_dimension_slices,
    "multi_version_keys": q_multi_version_keys,
    "vw_flights_sliced": q_vw_flights_sliced,
    "fact_append_new_only": q_fact_append_new_only,
    "scd2_single_airplane": _single_query(AIRPLANE),
    "scd2_single_airport": _single_query(AIRPORT),
    "scd2_single_air_route": _single_query(AIR_ROUTE),
    "fact_one_row": q_fact_one_row,
    "vw_flights_one_row": q_vw_flights_one_row,
    "column_kinds": q_column_kinds,
    "flights_as_read": q_flights_as_read,
    "scan_quoted_lines": q_scan_quoted_lines,
    "rejects_by_rule": q_rejects_by_rule,
    "tolerated_flights": q_tolerated_flights,
    "rejected_flights": q_rejected_flights,
    "vw_flights_after_first_load": q_vw_flights_after_first_load,
    "load_each_file_once": q_load_each_file_once,
}
