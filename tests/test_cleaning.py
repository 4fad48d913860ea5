import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from flightmart.operators import cleaning
from flightmart.schemas import NA_TOKENS

COLS = ["transactionid", "flightdate", "airlinecode", "airlinename", "tailnum", "flightnum",
        "originairportcode", "origairportname", "origincityname", "destairportcode", "destairportname",
        "destcityname", "crsdeptime", "deptime", "depdelay", "crsarrtime", "arrtime",
        "actualelapsedtime", "cancelled", "diverted", "distance"]


def row(tid, **kw):
    base = dict(
        transactionid=tid, flightdate="20020101", airlinecode="WN",
        airlinename="Southwest Airlines Co.: WN", tailnum="N103", flightnum="1425",
        originairportcode="ABQ", origairportname="Albuquerque, NM: Albuquerque International",
        origincityname="Albuquerque", destairportcode="DAL", destairportname="Dallas, TX: Love Field",
        destcityname="Dallas", crsdeptime="1425", deptime="1425", depdelay="16.0", crsarrtime="1610",
        arrtime="1615.0", actualelapsedtime="80.0", cancelled="F", diverted="False", distance="569 miles")
    base.update(kw)
    return tuple(base[c] for c in COLS)


def frame(spark, rows):
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in COLS))


def clean_rows(spark, rows, **kw):
    return {r.transactionid: r for r in cleaning.clean_flights(frame(spark, rows), **kw).collect()}


def test_types_and_parsing(spark):
    out = clean_rows(spark, [row("1")])["1"]
    assert out.flightdate == dt.date(2002, 1, 1)
    assert out.airlinename == "Southwest Airlines Co."
    assert out.origairportname == "Albuquerque International"
    assert out.destairportname == "Love Field"
    assert out.depdelay == 16 and out.distance == 569
    assert out.cancelled is False and out.diverted is False


def test_row_filters(spark):
    rows = [
        row("c1", cancelled="True"), row("c2", cancelled="T"), row("c3", cancelled="1"),
        row("c4", cancelled="true"),  # case-sensitive: kept, loads as true
        row("d1", diverted="True"), row("d2", diverted="T"), row("d3", diverted="1"),
        row("t1", tailnum=None), row("t2", tailnum="NKNO"), row("t3", tailnum="UNKNOW"),
        row("t4", tailnum="UNKNOWN"), row("t5", tailnum="#NAME?"), row("t6", tailnum="NA"),
    ]
    out = clean_rows(spark, rows)
    assert set(out) == {"c4", "t4", "t5"}
    assert out["c4"].cancelled is True


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("bad", [
    {"flightdate": None}, {"cancelled": None}, {"diverted": "NA"}, {"depdelay": "abc"}, {"depdelay": None},
    {"distance": "far miles"}, {"distance": None}, {"cancelled": "perhaps"},
])
def test_kept_rows_with_missing_or_unreadable_values_reject_the_batch(spark, ansi, bad):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(PySparkException):
            clean_rows(spark, [row("ok"), row("bad", **bad)])
        # a dropped row may hold anything but an unreadable date
        dropped = {k: v for k, v in bad.items() if k not in ("cancelled", "diverted")}
        assert set(clean_rows(spark, [row("ok"), row("gone", **{**dropped, "cancelled": "True"})])) == {"ok"}
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_na_tokens_become_null(spark):
    rows = [row(str(i), crsdeptime=tok) for i, tok in enumerate(NA_TOKENS)]
    out = clean_rows(spark, rows)
    assert len(out) == len(NA_TOKENS)
    assert all(r.crsdeptime is None for r in out.values())
    # '#NAME?' is not a reader token
    assert clean_rows(spark, [row("x", crsdeptime="#NAME?")])["x"].crsdeptime == "#NAME?"


def test_depdelay_truncates(spark):
    out = clean_rows(spark, [row("a", depdelay="16.9"), row("b", depdelay="-3.7"), row("c", depdelay="7")])
    assert (out["a"].depdelay, out["b"].depdelay, out["c"].depdelay) == (16, -3, 7)


def test_lstrip_is_python_whitespace(spark):
    out = clean_rows(spark, [row("a", origairportname="X, Y:\t \u00a0\u2003Field")])
    assert out["a"].origairportname == "Field"


def test_second_part_only(spark):
    out = clean_rows(spark, [row("a", destairportname="A: B: C")])
    assert out["a"].destairportname == "B"


@pytest.mark.parametrize("bad", [
    dict(depdelay=None), dict(depdelay="NaN"), dict(airlinename=None), dict(origairportname="no colon"),
    dict(destairportname=None), dict(distance=None), dict(cancelled="maybe"),
])
def test_batch_rejected(spark, bad):
    with pytest.raises(PySparkException):
        cleaning.clean_flights(frame(spark, [row("ok"), row("bad", **bad)])).collect()


def test_rejection_only_for_kept_rows(spark):
    # a cancelled row may lack DEPDELAY: it is dropped before the rule applies
    out = clean_rows(spark, [row("ok"), row("x", cancelled="T", depdelay=None)])
    assert set(out) == {"ok"}


def test_bad_date_rejects_even_dropped_rows(spark):
    with pytest.raises(PySparkException):
        cleaning.clean_flights(frame(spark, [row("ok"), row("x", cancelled="T", flightdate="2002-01-01")])).collect()


def test_batch_violations_reports_rules(spark):
    v = cleaning.batch_violations(frame(spark, [row("a", depdelay=None), row("b", distance=None),
                                                row("c", cancelled="T", depdelay=None)])).first()
    assert v["missing or non-numeric DEPDELAY"] == 1 and v["missing or non-numeric DISTANCE"] == 1


def test_header_subset_binds_by_name(spark):
    df = frame(spark, [row("a")]).drop("crsarrtime")
    out = cleaning.to_flights_table(cleaning.clean_flights(df))
    assert len(out.columns) == 31
    r = out.first()
    assert r.crsarrtime is None and r.originstate is None and r.transactionid == "a"


def test_pg_bool_words(spark):
    from flightmart.functions import pg_bool_or_null
    words = ["t", "TRUE", " yes ", "on", "1", "f", "False", "NO", "off", "0", "o", "x"]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    got = [r[0] for r in df.select(pg_bool_or_null(F.col("w"))).collect()]
    assert got == [True, True, True, True, True, False, False, False, False, False, None, None]


def test_load_profile_counts(spark):
    rows = [row("1"), row("2", cancelled="T"), row("3", tailnum=None), row("4", tailnum="NKNO")]
    p = cleaning.load_profile(frame(spark, rows)).first()
    assert (p.raw_rows, p.cancelled_rows, p.null_tailnum_rows, p.sentinel_tailnum_rows, p.clean_rows) == (4, 1, 1, 1, 1)
