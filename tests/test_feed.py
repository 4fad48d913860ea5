"""The derived feed over a few rows of our own."""

import datetime as dt
from collections import Counter

import duckdb
import pytest

from flightmart.sources.feed import raw_feed
from flightmart.session import scratch_path

TABLES = {
    "nation": "n_nationkey int",
    "customer": "c_custkey long, c_nationkey int",
    "supplier": "s_suppkey long, s_nationkey int",
    "orders": "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz, o_orderstatus string",
    "lineitem": "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double",
}
FIRST, SECOND = dt.datetime(1997, 5, 1), dt.datetime(1998, 5, 1)


def tables(spark, lines):
    """Tables with one customer and one supplier a nation (key = nation + 1) and an order per line, given as
    ``(nation of origin, nation of destination, date, part)``."""
    rows = {
        "nation": [(n,) for n in range(25)],
        "customer": [(n + 1, n) for n in range(25)],
        "supplier": [(n + 1, n) for n in range(25)],
        "orders": [(i, o + 1, day, "O") for i, (o, _, day, _) in enumerate(lines)],
        "lineitem": [(i, 1, part, d + 1, 1.0, 100.0) for i, (_, d, _, part) in enumerate(lines)],
    }
    root = scratch_path(spark, "own-tables")
    for t, schema in TABLES.items():
        spark.createDataFrame(rows[t], schema).coalesce(1).write.parquet(f"{root}/{t}.parquet")
    return root


def by_sql(root, name):
    import __spark_entry__ as e

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{root}/{t}.parquet/*.parquet')")
    cur = con.execute(e.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    return Counter(tuple(sorted(zip(names, map(str, r), strict=True))) for r in cur.fetchall())


def by_spark(spark, root, name):
    import __spark_entry__ as e

    return Counter(tuple(sorted((c, str(v)) for c, v in r.asDict().items())) for r in e.queries()[name](spark, root).collect())


def test_city_names_are_missing_at_every_airport(spark):
    lines = [(n, 24 - n, FIRST, 58) for n in range(25)] + [(n, 24 - n, FIRST, 38) for n in range(25)]
    root = tables(spark, lines)
    feed = raw_feed(spark, root).collect()
    assert {r.originairportcode for r in feed if r.origincityname == "NA"} == {f"AP{n}" for n in range(25)}
    assert {r.destairportcode for r in feed if r.destcityname == "N/A"} == {f"AP{n}" for n in range(25)}
    for name in ("scan_pipe_file", "stage_airport"):
        assert by_spark(spark, root, name) == by_sql(root, name)


def test_an_airport_that_is_whole_in_the_first_load_changes_in_the_second(spark):
    root = tables(spark, [(10, 0, FIRST, 2), (3, 1, FIRST, 58), (3, 1, FIRST, 3), (10, 0, SECOND, 2), (3, 1, SECOND, 3)])
    changed = by_spark(spark, root, "changed_airports")
    assert {dict(r)["airportname"] for r in changed} == {"Field 10 Intl", "Field 0 Intl"}
    assert changed == by_sql(root, "changed_airports")


def test_column_kinds_take_one_small_aggregate_a_column(spark):
    from flightmart.operators.inferred import column_kinds

    values = {"whole": ["1", "-2", " 3 "], "gaps": ["1", None, "NA"], "real": ["1", "2.5", "NaN"], "huge": ["1", "9" * 20, "2"],
              "word": ["True", "false", None], "text": ["1", "x", "True"], "none": [None, "NA", ""], "mixed": ["1", "True", "0"]}
    df = spark.createDataFrame(list(zip(*values.values(), strict=True)), ", ".join(f"{c} string" for c in values))
    kinds = column_kinds(df)
    assert {r.column_name: r.kind for r in kinds.collect()} == {
        "whole": "integer", "gaps": "float", "real": "float", "huge": "text", "word": "boolean", "text": "text",
        "none": "empty", "mixed": "text"}
    assert {r.kind for r in column_kinds(df.where("false")).collect()} == {"empty"}
    # it took six counters a column
    plan = kinds._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("bit_and(") == len(values) and "count(" not in plan


def test_nation_texts_are_made_before_the_join(spark):
    root = tables(spark, [(1, 2, FIRST, 58)])
    plan = raw_feed(spark, root)._jdf.queryExecution().optimizedPlan().toString()
    above = plan[:plan.index("Join")]
    assert "Field " not in above and "City" not in above
    assert plan.count("Field ") >= 2


def test_a_dimension_query_writes_the_columns_it_reads_and_no_raw_copy(spark, monkeypatch):
    from flightmart.plans import scenario

    written = []
    scratch = scenario.scratch_path
    monkeypatch.setattr(scenario, "scratch_path", lambda s, label: written.append(label) or scratch(s, label))
    monkeypatch.setattr(scenario, "materialize", lambda df, label: written.append(label) or df)
    root = tables(spark, [(1, 0, FIRST, 58), (3, 1, SECOND, 2)])
    clean = scenario._clean(spark, root, "dim_airplane")
    assert written == ["clean"] and clean.count() == 2
    assert set(clean.columns) == {"batch", "tailnum", "airlinecode", "airlinename"}
    assert set(scenario._clean(spark, root).columns) == set(scenario.FEED_COLUMNS)


def test_parts_of_a_text_are_found_without_regular_expressions(spark):
    from pyspark.sql import functions as F

    from flightmart.functions import part_after_first, part_before

    texts = ["a:b:c", "a:b", "a:", ":b", ":", "", "none", "::", "é: ü :x"]
    df = spark.createDataFrame([(t,) for t in [*texts, None]], "t string").select(
        "t", part_before(F.col("t"), ":").alias("b"), part_after_first(F.col("t"), ":").alias("a"))
    got = {r.t: (r.b, r.a) for r in df.collect()}
    assert got == {t: ((t.split(":") + [""])[0], (t.split(":") + [""])[1]) for t in texts} | {None: (None, None)}
    assert "split_part" not in df._jdf.queryExecution().analyzed().toString()
    assert "split" not in df._jdf.queryExecution().optimizedPlan().toString().lower()


CITY = ("cityname", "origincityname")
EVERY = {f"AP{n}" for n in range(25)}


@pytest.fixture(scope="module")
def both_loads(spark):
    """Every airport is an origin in both loads, with and without its city name."""
    return tables(spark, [(n, int(day is SECOND), day, part) for n in range(25) for day in (FIRST, SECOND) for part in (58, 2)])


def without_city(row):
    if "attributes" in row:
        return row["dim"] == "dim_airport" and row["attributes"].endswith("|~")
    return any(row.get(c) == "None" for c in CITY)


@pytest.mark.parametrize("name", ["drop_cancelled", "stage_airport", "surrogate_keys", "current_as_of", "new_airports",
                                  "version_counts", "scd2_airport", "flights_refresh"])
def test_every_airport_is_there_without_its_city(spark, both_loads, name):
    rows = by_spark(spark, both_loads, name)
    assert rows == by_sql(both_loads, name)
    found = [r for r in map(dict, rows) if without_city(r)]
    assert {r.get("airportcode") or r.get("originairportcode") or r["natural_key"] for r in found} == EVERY


def test_airports_with_and_without_city_tie(spark, both_loads):
    rows = {n: by_spark(spark, both_loads, n) for n in ("expiry_candidates", "changed_airports", "vw_flights")}
    for name, found in rows.items():
        assert found == by_sql(both_loads, name)
    assert {dict(r)["natural_key"] for r in rows["expiry_candidates"] if dict(r)["dim"] == "dim_airport"} == EVERY
    # ties leave no current version that could change
    assert not rows["changed_airports"]
    flights = Counter()
    for r, n in rows["vw_flights"].items():
        flights[dict(r)["transactionid"]] += n
    assert len(flights) == 100 and min(flights.values()) >= 4


def test_a_refresh_cleans_each_batch_as_it_is_written(spark, both_loads, monkeypatch):
    from flightmart.plans import scenario

    written = []
    scratch = scenario.scratch_path
    monkeypatch.setattr(scenario, "scratch_path", lambda s, label: written.append(label) or scratch(s, label))
    assert scenario.q_flights_refresh(spark, both_loads).count() == 50
    assert written == ["store"]


def test_batches_are_written_without_a_sort(spark, both_loads):
    import __spark_entry__ as e
    from flightmart.plans import scenario

    e._prepare(spark)
    # a task sorts its rows as soon as it has that many folders; there are two batches
    assert int(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")) > 2
    clean = scenario._clean(spark, both_loads, "dim_airplane")
    assert {r.batch: r["count"] for r in clean.groupBy("batch").count().collect()} == {0: 50, 1: 50}


def test_usual_flags_are_read_without_folding_case(spark):
    from pyspark.sql import functions as F

    from flightmart.functions import pg_bool_or_null
    from flightmart.functions.text import _BOOL_FALSE, _BOOL_TRUE, _BOOL_USUAL

    words = {w: True for w in _BOOL_TRUE} | {w: False for w in _BOOL_FALSE}
    texts = {f(w): v for w, v in words.items() for f in (str, str.upper, str.capitalize, lambda w: f" {w} ", str.swapcase)}
    texts |= {t: None for t in ("", "o", "2", "maybe", "truely", None)}
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", pg_bool_or_null(F.col("t")).alias("v"))
    assert {r.t: r.v for r in df.collect()} == texts
    assert {"True", "False", "T", "F", "0", "1"} <= set(_BOOL_USUAL)
    assert all(words[w.lower()] is v for w, v in _BOOL_USUAL.items())


@pytest.fixture(scope="module")
def one_line_an_airport(spark):
    """Every airport is once an origin and once a destination without its city name."""
    return tables(spark, [(n, 24 - n, FIRST, part) for n in range(25) for part in (58, 38)])


#: The destinations of flights whose tail number, that of supplier nation + 1, is missing or NKNO: those rows are dropped.
NO_TAIL = {f"AP{s - 1}" for s in (3, 5, 20, 22)}


@pytest.mark.parametrize(("name", "dropped"), [("na_tokens", set()), ("drop_diverted", set()), ("drop_bad_tailnum", NO_TAIL), ("clean_flights", NO_TAIL)])
def test_a_filter_keeps_rows_of_every_airport_without_its_city(spark, one_line_an_airport, name, dropped):
    rows = by_spark(spark, one_line_an_airport, name)
    assert rows == by_sql(one_line_an_airport, name)
    found = [dict(r) for r in rows]
    assert {r["destairportcode"] for r in found if r["destcityname"] == "None"} == EVERY - dropped
    # the flight from AP<n> goes to AP<24 - n>
    assert {r["originairportcode"] for r in found if r["origincityname"] == "None"} == EVERY - {f"AP{24 - int(p[2:])}" for p in dropped}
