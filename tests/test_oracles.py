"""Every registered query against its DuckDB oracle (row count, columns, values)."""

import datetime as dt
import decimal
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from flightmart.plans import scenario, scenario_options
from flightmart.plans.queries import QUERIES

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TABLES = "lineitem orders customer supplier nation".split()


def _norm(v):
    if isinstance(v, (float, decimal.Decimal)):
        return round(float(v), 6)
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.fixture(scope="module", autouse=True)
def shared_inputs():
    """The queries share what they all write first: the feed, the cleaned flights, the dimension histories.

    A history of fewer loads is the beginning of the longest one. (tools/check_oracles.py runs every query
    on its own.)
    """
    patch, kept = pytest.MonkeyPatch(), {}

    def once(key, make):
        if key not in kept:
            kept[key] = make()
        return kept[key]

    raw, clean = scenario._raw, scenario._clean
    history, sliced = scenario._dim_history, scenario_options._sliced_history
    for module in (scenario, scenario_options):
        patch.setattr(module, "_raw", lambda spark, sf: once("raw", lambda: raw(spark, sf)))
        patch.setattr(module, "_clean", lambda spark, sf: once("clean", lambda: clean(spark, sf)))
    patch.setattr(scenario, "_dim_history", lambda spark, flights, spec, loads=scenario.LOADS: once(
        spec.name, lambda: history(spark, flights, spec, scenario.LOADS))[:len(loads)])
    patch.setattr(scenario_options, "_sliced_history", lambda spark, flights, spec: once(
        f"sliced {spec.name}", lambda: sliced(spark, flights, spec)))
    yield
    patch.undo()


CORE = sorted(QUERIES)  # the training-data operators have tests of their own


@pytest.mark.parametrize("name", CORE)
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    oracle = entry.oracle_sql()[name]
    res = con.execute(oracle)
    o_cols = [d[0] for d in res.description]
    s_cols = df.columns
    assert sorted(s_cols) == sorted(o_cols)
    assert _rows(s_cols, df.collect()) == _rows(o_cols, res.fetchall())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["transactionid", "distancegroup", "depdelaygt15", "nextdayarr",
                          "airlinename", "origairportname", "destairportname"]
    assert df.count() > 0
