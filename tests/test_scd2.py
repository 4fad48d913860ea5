import datetime as dt
import random
from collections import Counter

from flightmart.operators import scd2
from flightmart.schemas import AIR_ROUTE, AIRPLANE, AIRPORT, OPEN_END

from scd2_model import load as model_load

D1, D2, D3 = dt.date(2024, 1, 1), dt.date(2024, 2, 1), dt.date(2024, 3, 1)


def stage_df(spark, spec, rows):
    cols = spec.stage_columns
    schema = spec.schema.__class__([f for f in spec.schema.fields if f.name in cols])
    return spark.createDataFrame([tuple(r[c] for c in cols) for r in rows], schema)


def run(spark, spec, loads):
    """loads: list of (as_of, stage rows as dicts). Returns the final dim as dicts."""
    dim = scd2.empty_dim(spark, spec)
    for as_of, rows in loads:
        nxt = scd2.scd2_step(dim, stage_df(spark, spec, rows), spec, as_of)
        dim = spark.createDataFrame(nxt.collect(), spec.schema)  # a few test rows: restart the plan
    return [r.asDict() for r in dim.collect()]


def model(spec, loads):
    dim = []
    for as_of, rows in loads:
        dim = model_load(spec, dim, rows, as_of)
    return dim


def public(spec, rows):
    cols = list(spec.stage_columns) + ["current_flag", "efft_date", "expy_date"]
    return Counter(tuple(r[c] for c in cols) for r in rows)


def ap(tail, code, name="n"):
    return {"tailnum": tail, "airlinecode": code, "airlinename": name}


def apt(code, name, city="c"):
    return {"airportcode": code, "airportname": name, "cityname": city}


def test_first_load_and_unchanged_rerun(spark):
    loads = [(D1, [ap("N1", "A"), ap("N2", "B")]), (D2, [ap("N1", "A"), ap("N2", "B")])]
    out = run(spark, AIRPLANE, loads)
    assert len(out) == 2 and all(r["expy_date"] == OPEN_END and r["current_flag"] == "Y" for r in out)


def test_change_expires_old_version_offset_one(spark):
    out = run(spark, AIRPLANE, [(D1, [ap("N1", "A")]), (D2, [ap("N1", "B")])])
    old = [r for r in out if r["airlinecode"] == "A"][0]
    new = [r for r in out if r["airlinecode"] == "B"][0]
    assert old["expy_date"] == D2 - dt.timedelta(days=1) and old["current_flag"] == "N"
    assert new["expy_date"] == OPEN_END and new["efft_date"] == D2


def test_airport_expires_on_load_date(spark):
    out = run(spark, AIRPORT, [(D1, [apt("X", "a")]), (D2, [apt("X", "b")])])
    old = [r for r in out if r["airportname"] == "a"][0]
    assert old["expy_date"] == D2


def test_e1_tie_on_first_load_expires_all(spark):
    out = run(spark, AIRPLANE, [(D1, [ap("N1", "A"), ap("N1", "B")])])
    assert len(out) == 2 and all(r["current_flag"] == "N" for r in out)
    assert all(r["expy_date"] == D1 - dt.timedelta(days=1) for r in out)  # E5: expy < efft


def test_e3_airport_same_day_rerun_inserts_again(spark):
    loads = [(D1, [apt("X", "a")]), (D2, [apt("X", "b")]), (D2, [apt("X", "b")])]
    out = run(spark, AIRPORT, loads)
    opened = [r for r in out if r["airportname"] == "b"]
    assert len(opened) == 2 and all(r["expy_date"] == OPEN_END for r in opened)
    assert public(AIRPORT, out) == public(AIRPORT, model(AIRPORT, loads))


def test_e6_closed_row_sharing_efft_is_rewritten(spark):
    loads = [(D1, [ap("N1", "A"), ap("N1", "B")]), (D2, [ap("N1", "C")]), (D3, [ap("N1", "D")])]
    assert public(AIRPLANE, run(spark, AIRPLANE, loads)) == public(AIRPLANE, model(AIRPLANE, loads))


def test_e7_null_key_inserted_every_run_never_expired(spark):
    loads = [(D1, [apt(None, "a")]), (D2, [apt(None, "a")]), (D3, [apt(None, "b")])]
    out = run(spark, AIRPORT, loads)
    assert len(out) == 3 and all(r["expy_date"] == OPEN_END for r in out)


def test_e8_missing_key_untouched_and_e9_return_to_old_value(spark):
    loads = [(D1, [ap("N1", "A"), ap("N2", "X")]), (D2, [ap("N1", "B")]), (D3, [ap("N1", "A")])]
    out = run(spark, AIRPLANE, loads)
    assert [r for r in out if r["tailnum"] == "N2"][0]["expy_date"] == OPEN_END
    assert len([r for r in out if r["tailnum"] == "N1"]) == 3


def test_e13_two_new_sets_over_one_old_row(spark):
    r = lambda t: {"flightnum": "1", "originairportcode": "A", "destairportcode": "B",
                   "crsdeptime": t, "crsarrtime": "9", "distance": 100}
    loads = [(D1, [r("1")]), (D2, [r("2"), r("3")])]
    out = run(spark, AIR_ROUTE, loads)
    assert len([x for x in out if x["expy_date"] == OPEN_END]) == 2
    assert public(AIR_ROUTE, out) == public(AIR_ROUTE, model(AIR_ROUTE, loads))


def test_underscore_hash_collision_is_kept(spark):
    # '_' is a prefix, not a separator: ('ab','c') and ('a','bc') hash alike -> no change detected
    loads = [(D1, [apt("X", "ab", "c")]), (D2, [apt("X", "a", "bc")])]
    out = run(spark, AIRPORT, loads)
    assert len(out) == 1


def test_surrogate_keys_unique_dense_and_continuing(spark):
    loads = [(D1, [ap(f"N{i}", "A") for i in range(40)]), (D2, [ap(f"N{i}", "B") for i in range(0, 40, 3)])]
    out = run(spark, AIRPLANE, loads)
    keys = sorted(r["airplane_skey"] for r in out)
    assert keys == list(range(1, len(out) + 1))
    first = {r["airplane_skey"] for r in out if r["efft_date"] == D1}
    assert first == set(range(1, 41))


def _random_history(rng, spec, n_loads):
    dates = sorted(rng.sample([D1 + dt.timedelta(days=d) for d in range(6)], 3))
    loads = []
    for _ in range(n_loads):
        as_of = rng.choice(dates)
        rows = []
        for _ in range(rng.randint(1, 6)):
            if spec is AIR_ROUTE:
                r = {"flightnum": rng.choice(["1", "2", None]), "originairportcode": rng.choice(["A", "B"]),
                     "destairportcode": "C", "crsdeptime": rng.choice(["10", "11", None]),
                     "crsarrtime": rng.choice(["5", "6"]), "distance": rng.choice([100, 200])}
            elif spec is AIRPORT:
                r = apt(rng.choice(["X", "Y", None]), rng.choice(["a", "ab", None]), rng.choice(["c", "bc"]))
            else:
                r = ap(rng.choice(["N1", "N2", "N3"]), rng.choice(["A", "B", None]), rng.choice(["n", "m"]))
            if r not in rows:
                rows.append(r)
        loads.append((as_of, rows))
    loads.sort(key=lambda x: x[0])
    return loads


def test_random_histories_match_brute_force(spark):
    rng = random.Random(7)
    for spec in (AIRPLANE, AIRPORT, AIR_ROUTE):
        for _ in range(6):
            loads = _random_history(rng, spec, 3)
            got = run(spark, spec, loads)
            assert public(spec, got) == public(spec, model(spec, loads)), loads
            assert len({r[spec.skey] for r in got}) == len(got)


def test_window_quantities_group_null_keys_like_partition_by(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    rows = [
        (1, None, "a", "c", "Y", D1, OPEN_END), (2, None, "b", "c", "Y", D2, OPEN_END),
        (3, None, "c", "c", "Y", D2, OPEN_END), (4, "X", "a", "c", "Y", D1, OPEN_END),
        (5, "X", "b", "c", "Y", D2, OPEN_END), (6, "Y", "a", "c", "Y", D1, OPEN_END),
        (7, "X", "z", "c", "N", D1, D1),  # not current on D3
    ]
    dim = spark.createDataFrame(rows, AIRPORT.schema)
    cur = dim.where(F.lit(D3).between(F.col("efft_date"), F.col("expy_date")))
    w = Window.partitionBy("airportcode")
    want_counts = Counter(
        (r.airport_skey, r.cnt) for r in cur.withColumn("cnt", F.count(F.lit(1)).over(w)).collect())
    got_counts = Counter((r.airport_skey, r.cnt) for r in scd2.version_counts(dim, AIRPORT, D3).collect())
    assert got_counts == want_counts
    ranked = cur.withColumn("cnt", F.count(F.lit(1)).over(w)).where("cnt > 1") \
        .withColumn("rk", F.rank().over(w.orderBy("efft_date"))).where("rk = 1")
    want = Counter((r.airportcode, r.efft_date) for r in ranked.collect())
    got = Counter((r.airportcode, r.efft_date) for r in scd2.expiry_candidates(dim, AIRPORT, D3).collect())
    assert got == want and (None, D1) in got


def test_last_step_does_not_shuffle_the_history(spark):
    from flightmart.session import materialize

    dim = scd2.empty_dim(spark, AIRPLANE)
    for day, code in ((D1, "A"), (D2, "B"), (D3, "C")):
        stage = materialize(stage_df(spark, AIRPLANE, [ap(f"N{i}", code) for i in range(50)]), "t-stage")
        nxt = scd2.scd2_step(dim, stage, AIRPLANE, day)
        plan = nxt._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan
        dim = materialize(nxt, "t-dim")
    assert dim.count() == 150


def test_insert_set_is_computed_once(spark):
    from flightmart.session import materialize

    first = materialize(scd2.scd2_step(scd2.empty_dim(spark, AIRPLANE),
                                       materialize(stage_df(spark, AIRPLANE, [ap("N1", "A")]), "t"), AIRPLANE, D1), "t")
    stage = materialize(stage_df(spark, AIRPLANE, [ap("N1", "B"), ap("N2", "C")]), "t")
    plan = scd2.unkeyed_inserts(stage, first, AIRPLANE, D2)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftAnti") == 1 and plan.count("LeftSemi") == 1
    # the keyed inserts are a written table: no join is left in their plan
    keyed = scd2.inserts(stage, first, AIRPLANE, D2)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in keyed
