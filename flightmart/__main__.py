"""Command line: run one daily load, or print a file's batch-rule violations.

    python -m flightmart load --store PATH --raw PATH [PATH ...] --as-of 2024-02-01 [--load-id ID] [fix flags]
    python -m flightmart check --raw PATH [PATH ...]

The session comes from the environment (spark-submit / cluster defaults);
settings of ``session.RECOMMENDED_CONF`` are applied only where unset.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from pyspark.sql import SparkSession

from flightmart.operators.cleaning import batch_violations
from flightmart.operators.keys import DEFAULT_BUCKETS
from flightmart.plans.daily_load import LoadOptions, daily_load
from flightmart.schemas import TAILNUM_SENTINELS
from flightmart.session import RECOMMENDED_CONF
from flightmart.sources.pipe_file import read_pipe_file
from flightmart.sources.store import TableStore


def _session() -> SparkSession:
    spark = SparkSession.builder.appName("flightmart").getOrCreate()
    for k, v in RECOMMENDED_CONF.items():
        if spark.conf.get(k, None) is None:
            try:
                spark.conf.set(k, v)
            except Exception:  # static settings can only come from the launcher
                pass
    return spark


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="flightmart")
    sub = p.add_subparsers(dest="cmd", required=True)
    load = sub.add_parser("load", help="run one daily load")
    load.add_argument("--store", required=True)
    load.add_argument("--raw", required=True, nargs="+")
    load.add_argument("--as-of", required=True, type=dt.date.fromisoformat)
    load.add_argument("--load-id")
    load.add_argument("--extra-sentinel", action="append", default=[], help="more tail numbers to drop")
    load.add_argument("--hash-style", choices=["concat_ws_dash", "underscore_prefix", "separated"])
    load.add_argument("--expire-offset-days", type=int)
    load.add_argument("--valid-only-lookups", action="store_true")
    load.add_argument("--fixed-next-day", action="store_true")
    load.add_argument("--replace-fact-partition", action="store_true")
    load.add_argument("--sliced-dimensions", action="store_true", help="rewrite only the slices a load changes")
    load.add_argument("--one-version-per-key", action="store_true", help="ties have a winner, a key one current row")
    load.add_argument("--one-row-per-flight", action="store_true", help="look versions up by load date")
    load.add_argument("--skip-known-transactions", action="store_true", help="append no flight the fact holds")
    load.add_argument("--tolerated-rejects", type=float, help="share of bad rows to put aside; default: none, one rejects the file")
    load.add_argument("--new-files-only", action="store_true", help="leave out files that a load has read")
    load.add_argument("--inferred-types", action="store_true", help="column types as the source's reader infers them")
    load.add_argument("--quoted-line-breaks", action="store_true", help="fields in quotes may hold line breaks")
    load.add_argument("--key-buckets", type=int, default=DEFAULT_BUCKETS, help="tasks that number new keys")
    check = sub.add_parser("check", help="count rows breaking each batch-rejection rule")
    check.add_argument("--raw", required=True, nargs="+")
    a = p.parse_args(argv)

    spark = _session()
    if a.cmd == "check":
        print(json.dumps(batch_violations(read_pipe_file(spark, a.raw)).first().asDict()))
        return
    opts = LoadOptions(
        tailnum_sentinels=TAILNUM_SENTINELS + tuple(a.extra_sentinel),
        hash_style=a.hash_style, expire_offset_days=a.expire_offset_days,
        valid_only_lookups=a.valid_only_lookups, fixed_next_day=a.fixed_next_day,
        replace_fact_partition=a.replace_fact_partition, key_buckets=a.key_buckets,
        sliced_dimensions=a.sliced_dimensions, one_version_per_key=a.one_version_per_key,
        one_row_per_flight=a.one_row_per_flight, skip_known_transactions=a.skip_known_transactions,
        tolerated_rejects=a.tolerated_rejects, new_files_only=a.new_files_only,
        quoted_line_breaks=a.quoted_line_breaks, inferred_types=a.inferred_types,
    )
    store = TableStore(spark, a.store)
    daily_load(spark, store, a.raw, a.as_of, opts, load_id=a.load_id)
    print(json.dumps({t: store.version(t) for t in ("flights_dlt", "dim_airplane", "dim_airport",
                                                   "dim_air_route", "fact_flights")}))


if __name__ == "__main__":
    main()
