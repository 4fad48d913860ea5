"""Print the executed (AQE final) physical plans of the warehouse jobs.

usage: python tools/show_plans.py [sf_dir]   (default /root/testdata/sf0.01)
Runs one daily load into a scratch store, then executes and explains each job.
"""

from __future__ import annotations

import datetime as dt
import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from flightmart.operators import cleaning, scd2, staging
    from flightmart.operators.fact import build_fact
    from flightmart.plans.daily_load import daily_load, view
    from flightmart.schemas import AIR_ROUTE
    from flightmart.session import local_session, scratch_path
    from flightmart.sources.feed import batch_feed
    from flightmart.sources.pipe_file import read_pipe_file, write_pipe_file
    from flightmart.sources.store import TableStore

    spark = local_session(8, 8)
    root = scratch_path(spark, "plans")
    store = TableStore(spark, root)
    raw = {b: f"{root}/raw/b{b}" for b in (0, 1)}
    for b, p in raw.items():
        write_pipe_file(batch_feed(spark, sf_dir, b), p)
    daily_load(spark, store, raw[0], dt.date(2024, 1, 1))
    flights = store.read("flights_dlt")
    jobs = {
        "clean_flights (raw pipe file -> typed rows)": cleaning.clean_flights(read_pipe_file(spark, raw[1])),
        "stage_airport (one scan, inline, partial aggregate)": staging.stage_airport(flights),
        "scd2_step air route (inserts, keys, expiry)": scd2.scd2_step(
            store.read("dim_air_route"), store.read("stg_air_route_dlt"), AIR_ROUTE, dt.date(2024, 2, 1)),
        "build_fact (two lookups)": build_fact(flights, store.read("dim_air_route"), store.read("dim_airplane")),
        "vw_flights (four joins)": view(store, name=None),
    }
    for title, df in jobs.items():
        # run the DataFrame's own query execution (JVM side) so the explain
        # below shows AQE's final plan, not the initial one
        df._jdf.queryExecution().toRdd().count()
        print(f"\n===== {title} =====")
        df.explain("formatted")
    spark.stop()


if __name__ == "__main__":
    main()
