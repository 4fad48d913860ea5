"""Opt-in fixes (LoadOptions / operator parameters) and raw-file strictness."""

import datetime as dt

import pytest

from flightmart.operators import cleaning, scd2
from flightmart.operators.fact import build_fact
from flightmart.schemas import AIR_ROUTE, AIRPLANE, AIRPORT, TAILNUM_SENTINELS
from flightmart.session import scratch_path
from flightmart.sources.pipe_file import read_pipe_file

from test_cleaning import frame, row

D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 2, 1)


def _dim(spark, spec, loads, **kw):
    dim = scd2.empty_dim(spark, spec)
    for as_of, rows in loads:
        cols = spec.stage_columns
        schema = spec.schema.__class__([f for f in spec.schema.fields if f.name in cols])
        st = spark.createDataFrame([tuple(r[c] for c in cols) for r in rows], schema)
        dim = spark.createDataFrame(scd2.scd2_step(dim, st, spec, as_of, **kw).collect(), spec.schema)
    return [r.asDict() for r in dim.collect()]


def test_extra_sentinels_drop_name_and_unknown(spark):
    rows = [row("a", tailnum="#NAME?"), row("b", tailnum="UNKNOWN"), row("c")]
    out = cleaning.clean_flights(frame(spark, rows), sentinels=TAILNUM_SENTINELS + ("#NAME?", "UNKNOWN"))
    assert [r.transactionid for r in out.collect()] == ["c"]


def test_separated_hash_sees_what_the_prefix_hash_misses(spark):
    apt = lambda n, c: {"airportcode": "X", "airportname": n, "cityname": c}
    loads = [(D1, [apt("ab", "c")]), (D2, [apt("a", "bc")])]
    assert len(_dim(spark, AIRPORT, loads)) == 1
    assert len(_dim(spark, AIRPORT, loads, hash_style="separated")) == 2


def test_expire_offset_override(spark):
    ap = lambda c: {"tailnum": "N1", "airlinecode": c, "airlinename": "n"}
    out = _dim(spark, AIRPLANE, [(D1, [ap("A")]), (D2, [ap("B")])], offset_days=0)
    assert {r["expy_date"] for r in out if r["airlinecode"] == "A"} == {D2}


def test_valid_only_lookup_joins_one_version(spark):
    dim = spark.createDataFrame(
        [(1, "N103", "A", "n", "N", D1, D2 - dt.timedelta(days=1)), (2, "N103", "B", "n", "Y", D2, dt.date(9999, 12, 31))],
        AIRPLANE.schema)
    flights = cleaning.clean_flights(frame(spark, [row("t")]))
    routes = scd2.empty_dim(spark, AIR_ROUTE)
    all_versions = build_fact(flights, routes, dim).collect()
    valid = build_fact(flights, routes, dim, as_of=D2).collect()
    assert sorted(r.airplane_skey for r in all_versions) == [1, 2]
    assert [r.airplane_skey for r in valid] == [2]


def test_malformed_row_fails_the_scan(spark):
    path = scratch_path(spark, "t-bad")
    spark.createDataFrame([("TRANSACTIONID|TAILNUM",), ("1|N1",), ("2|N2|extra",)], "v string") \
        .coalesce(1).write.text(path)
    with pytest.raises(Exception, match="row with too many fields"):
        read_pipe_file(spark, path).collect()


def test_files_with_different_headers_fail(spark):
    root = scratch_path(spark, "t-hdr")
    for name, cols in (("a", "TRANSACTIONID string, TAILNUM string"), ("b", "TAILNUM string, TRANSACTIONID string")):
        spark.createDataFrame([("1", "N1")], cols).write.options(sep="|", header="true").csv(f"{root}/{name}")
    ok = read_pipe_file(spark, [f"{root}/a", f"{root}/a"]).collect()
    assert len(ok) == 2
    with pytest.raises(Exception, match="(?i)header|schema"):
        read_pipe_file(spark, [f"{root}/a", f"{root}/b"]).collect()


def test_command_line_load_and_resume(spark, capsys):
    import json

    from flightmart.__main__ import main
    from flightmart.sources.feed import batch_feed
    from flightmart.sources.pipe_file import write_pipe_file

    root = scratch_path(spark, "t-cli")
    write_pipe_file(batch_feed(spark, "/root/testdata/sf0.001", 0), f"{root}/raw")
    main(["check", "--raw", f"{root}/raw"])
    assert set(json.loads(capsys.readouterr().out.strip().splitlines()[-1]).values()) == {0}
    args = ["load", "--store", f"{root}/wh", "--raw", f"{root}/raw", "--as-of", "2024-01-01", "--load-id", "r1"]
    main(args)
    first = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    main(args)  # same load id: nothing is published again
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1]) == first
