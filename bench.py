"""Benchmark: the warehouse jobs on $BENCH_SF_DIR.

Prints one JSON line: {"metric", "value" (total seconds), "unit", "queries", "sf", ...}.

Set-up (not timed): the derived flights feed of the driver tables is written
once as two raw pipe-delimited files (batch 0 and batch 1), the input a real
load starts from. Then each job runs as the warehouse runs it:

- clean_flights: read both raw files, clean, write to the noop sink;
- scd2_<dim>: the four loads of FIXTURES.md (stage table write, SCD2 step, snapshot write);
- fact_flights: fact rows of loads 1 and 2 against the dimension snapshots;
- vw_flights: the reporting view over that fact and the final dimensions;
- two_batch_load: two complete daily loads from the raw files into a fresh
  table store, then the view.

One warm-up pass, then the median of $BENCH_REPEATS (default 3) runs per job.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))

    from pyspark.sql import functions as F

    from flightmart.operators import cleaning, scd2, staging
    from flightmart.operators.fact import build_fact
    from flightmart.operators.view import vw_flights
    from flightmart.plans.daily_load import daily_load
    from flightmart.plans.scenario import LOADS
    from flightmart.schemas import DIMS
    from flightmart.session import local_session, materialize, scratch_path
    from flightmart.sources.feed import batch_feed
    from flightmart.sources.pipe_file import read_pipe_file, write_pipe_file
    from flightmart.sources.store import TableStore

    spark = local_session(cpus, shuffle_partitions=int(cpus))
    root = scratch_path(spark, "bench")
    raw = {b: f"{root}/raw/batch={b}" for b in (0, 1)}
    for b, path in raw.items():
        write_pipe_file(batch_feed(spark, sf_dir, b), path)
    clean = {b: materialize(cleaning.clean_flights(read_pipe_file(spark, p)), "bench-clean") for b, p in raw.items()}
    state: dict = {}

    def noop(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    def job_clean() -> None:
        noop(cleaning.clean_flights(read_pipe_file(spark, list(raw.values()))))

    def job_scd2(name):
        def run() -> None:
            spec = DIMS[name]
            dim = scd2.empty_dim(spark, spec)
            snaps = []
            for as_of, b in LOADS:
                stage = materialize(staging.STAGERS[name](clean[b]), f"bench-stg-{name}")
                dim = materialize(scd2.scd2_step(dim, stage, spec, as_of), f"bench-{name}")
                snaps.append(dim)
            state[name] = snaps
        return run

    def job_fact() -> None:
        parts = [
            build_fact(clean[b], state["dim_air_route"][i], state["dim_airplane"][i])
            .withColumn("load_date", F.lit(as_of))
            for i, (as_of, b) in enumerate(LOADS[:2])
        ]
        fact = parts[0].unionByName(parts[1])
        noop(fact)
        state["fact"] = fact

    def job_view() -> None:
        fact = state.setdefault("fact_table", materialize(state["fact"], "bench-fact"))
        noop(vw_flights(fact, state["dim_airplane"][1], state["dim_air_route"][1], state["dim_airport"][1]))

    def job_two_batch_load() -> None:
        store = TableStore(spark, scratch_path(spark, "bench-store"))
        result = None
        for as_of, b in LOADS[:2]:
            result = daily_load(spark, store, raw[b], as_of)
        noop(result)

    jobs = {
        "clean_flights": job_clean,
        "scd2_airplane": job_scd2("dim_airplane"),
        "scd2_airport": job_scd2("dim_airport"),
        "scd2_air_route": job_scd2("dim_air_route"),
        "fact_flights": job_fact,
        "vw_flights": job_view,
        "two_batch_load": job_two_batch_load,
    }

    def timed(fn) -> float:
        t0 = time.perf_counter()
        fn()
        return time.perf_counter() - t0

    for fn in jobs.values():  # warm-up: JVM, code generation, file listings
        fn()
    times = {name: round(statistics.median(timed(fn) for _ in range(repeats)), 3) for name, fn in jobs.items()}
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "warehouse_jobs_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": int(cpus),
        "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
