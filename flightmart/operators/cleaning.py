"""Cleaning of the raw flights feed (row filters, name/distance parsing, typing).

Everything is a narrow projection or filter: one pass, no shuffle, inside one
whole-stage-codegen span. Rules that make the source system reject the whole
batch are expressed with ``raise_error`` inside the same pass, so a bad file
fails the job before any table is swapped and no extra validation scan runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flightmart.functions import (
    first_word, na_to_null, part_after_first, part_before, pg_bool_or_null, py_lstrip,
)
from flightmart.schemas import FLAG_TRUE_TOKENS, FLIGHTS, NA_TOKENS, TAILNUM_SENTINELS

DATE_MASK = "yyyyMMdd"


def _fail(message: str, value: Column | None = None) -> Column:
    text = F.lit(message) if value is None else F.concat(F.lit(message), F.coalesce(value, F.lit("NULL")))
    return F.raise_error(text)


def normalize_na(df: DataFrame) -> DataFrame:
    """Null out missing-value tokens in every text column (reader default)."""
    return df.select(*[
        na_to_null(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
        for f in df.schema.fields
    ])


def _flag_set(c: str) -> Column:
    # A NULL flag never equals a token, so the row is kept.
    return F.coalesce(F.col(c).isin(*FLAG_TRUE_TOKENS), F.lit(False))


def drop_cancelled(df: DataFrame) -> DataFrame:
    return df.where(~_flag_set("cancelled"))


def drop_diverted(df: DataFrame) -> DataFrame:
    return df.where(~_flag_set("diverted"))


def drop_bad_tailnum(df: DataFrame, sentinels: tuple[str, ...] = TAILNUM_SENTINELS) -> DataFrame:
    t = F.col("tailnum")
    return df.where(t.isNotNull() & ~t.isin(*sentinels))


def clean_airline_name(c: Column) -> Column:
    return F.when(c.isNull(), _fail("missing AIRLINENAME")).otherwise(part_before(c, ":"))


def clean_airport_name(c: Column, label: str) -> Column:
    """Second ':'-separated part, leading whitespace removed; no ':' rejects the batch."""
    bad = c.isNull() | (F.instr(c, ":") == 0)
    return F.when(bad, _fail(f"no ':' in {label}: ", c)).otherwise(py_lstrip(part_after_first(c, ":")))


def clean_names(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "airlinename": clean_airline_name(F.col("airlinename")),
        "origairportname": clean_airport_name(F.col("origairportname"), "ORIGAIRPORTNAME"),
        "destairportname": clean_airport_name(F.col("destairportname"), "DESTAIRPORTNAME"),
    })


def with_raw_columns(df: DataFrame) -> DataFrame:
    """Bind raw columns by name: the file header may hold any subset of them."""
    present = {c.lower() for c in df.columns}
    missing = [F.lit(None).cast("string").alias(c) for c in FLIGHTS.fieldNames() if c not in present]
    return df.select("*", *missing) if missing else df


def _missing(c: str) -> Column:
    """NULL after the reader's NA handling (NULL or an NA token)."""
    return F.col(c).isNull() | F.col(c).isin(*NA_TOKENS)


def _kept(sentinels: tuple[str, ...]) -> Column:
    # NA tokens are never flag values, so the flags need no NA handling.
    t = F.col("tailnum")
    return (~_flag_set("cancelled")) & (~_flag_set("diverted")) & ~_missing("tailnum") & ~t.isin(*sentinels)


def _bad_bool(c: str) -> Column:
    # No NA token parses as a boolean, so a NULL parse is missing or bad text;
    # the source writes missing flags as empty text, which its boolean column refuses.
    return pg_bool_or_null(F.col(c)).isNull()


def _depdelay() -> Column:
    return F.col("depdelay").try_cast("double").try_cast("int")


def _distance() -> Column:
    return first_word(F.col("distance")).try_cast("int")


# Rules that reject the whole batch when a kept row breaks them. No NA token
# contains ':', so the ':' rules need no NA handling either.
_BATCH_RULES = (
    (lambda: _missing("flightdate"), "missing FLIGHTDATE"),
    (lambda: _depdelay().isNull(), "missing or non-numeric DEPDELAY"),
    (lambda: _missing("airlinename"), "missing AIRLINENAME"),
    (lambda: F.instr(F.col("origairportname"), ":") == 0, "no ':' in ORIGAIRPORTNAME"),
    (lambda: F.instr(F.col("destairportname"), ":") == 0, "no ':' in DESTAIRPORTNAME"),
    (lambda: _distance().isNull(), "missing or non-numeric DISTANCE"),
    (lambda: _bad_bool("cancelled"), "missing or invalid CANCELLED"),
    (lambda: _bad_bool("diverted"), "missing or invalid DIVERTED"),
)


def _row_gate(sentinels: tuple[str, ...]) -> Column:
    """Keep/drop decision with all batch rejections folded in.

    The date is parsed before any row is dropped (an unreadable date anywhere
    rejects the batch); the other rules apply to kept rows only. The message
    stays short on purpose: the fused stage must stay under the JIT's method
    size limit. :func:`batch_violations` reports which rules a file breaks.
    """
    d = F.col("flightdate")
    bad_date = ~_missing("flightdate") & F.try_to_date(d, DATE_MASK).isNull()
    any_bad = None
    for rule, _ in _BATCH_RULES:
        c = F.coalesce(rule(), F.lit(True))
        any_bad = c if any_bad is None else any_bad | c
    return (
        F.when(bad_date, _fail("batch rejected: unparseable FLIGHTDATE, see batch_violations()").cast("boolean"))
        .when(~_kept(sentinels), F.lit(False))
        .when(any_bad, _fail("batch rejected: a kept row breaks a load rule, see batch_violations(); "
                             "transactionid ", F.col("transactionid")).cast("boolean"))
        .otherwise(F.lit(True))
    )


def batch_violations(raw: DataFrame, sentinels: tuple[str, ...] = TAILNUM_SENTINELS) -> DataFrame:
    """One row: how many rows break each rule that rejects a batch (one aggregate pass)."""
    df = with_raw_columns(raw)
    kept = _kept(sentinels)
    d = F.col("flightdate")
    aggs = [F.count_if(~_missing("flightdate") & F.try_to_date(d, DATE_MASK).isNull())
            .alias("unparseable FLIGHTDATE")]
    aggs += [F.count_if(kept & F.coalesce(rule(), F.lit(True))).alias(msg) for rule, msg in _BATCH_RULES]
    return df.agg(*aggs)


def clean_flights(raw: DataFrame, sentinels: tuple[str, ...] = TAILNUM_SENTINELS) -> DataFrame:
    """Raw text rows -> typed, filtered flight rows (extra columns pass through).

    One filter (keep rules + batch rejection) and one projection: a single
    narrow pass. The rules read the raw text and apply NA handling only where
    a token could change the outcome, so each raw value is tested against the
    NA set about once; duplicating that test into every rule made the fused
    stage too large for the JIT. Rows that reach the projection have passed the
    rules, so the typed columns parse the raw text directly. All parsing uses
    try_cast, so the session's ANSI setting changes nothing.
    """
    df = with_raw_columns(raw)
    return df.where(_row_gate(sentinels)).select(*_typed_columns(df))


def _typed_columns(df: DataFrame, only: set[str] | None = None) -> list[Column]:
    """Raw text columns as typed values, in the frame's order (``only``: some of them)."""
    typed = {
        "flightdate": F.try_to_date(F.col("flightdate"), DATE_MASK),
        "depdelay": _depdelay(),
        "airlinename": part_before(F.col("airlinename"), ":"),
        "origairportname": py_lstrip(part_after_first(F.col("origairportname"), ":")),
        "destairportname": py_lstrip(part_after_first(F.col("destairportname"), ":")),
        "distance": _distance(),
        "cancelled": pg_bool_or_null(F.col("cancelled")),
        "diverted": pg_bool_or_null(F.col("diverted")),
    }
    return [
        typed[f.name].alias(f.name) if f.name in typed
        else na_to_null(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType)
        else F.col(f.name)
        for f in df.schema.fields if only is None or f.name in only
    ]


def judged_flights(raw: DataFrame, sentinels: tuple[str, ...] = TAILNUM_SENTINELS) -> DataFrame:
    """Good and bad rows in one narrow pass, instead of rejecting the batch for one bad row.

    Rows the filters drop are left out, as in :func:`clean_flights`, but a row with an unreadable date
    is bad even then. The typed columns of the 31-column table hold NULL where a bad row's text can't be read;
    ``rules`` lists the rules a row breaks (empty for good rows), ``raw`` keeps a bad row's text
    columns as JSON, and ``rejected`` tells the two apart. The rules are those of
    :func:`batch_violations`, under the same names.
    """
    df = with_raw_columns(raw)
    kept = _kept(sentinels)
    bad_date = ~_missing("flightdate") & F.try_to_date(F.col("flightdate"), DATE_MASK).isNull()
    broken = [F.when(bad_date, F.lit("unparseable FLIGHTDATE"))]
    broken += [F.when(kept & F.coalesce(rule(), F.lit(True)), F.lit(name)) for rule, name in _BATCH_RULES]
    df = df.withColumn("rules", F.filter(F.array(*broken), lambda r: r.isNotNull()))
    df = df.where(kept | (F.size("rules") > 0)).withColumn("rejected", F.size("rules") > 0)
    text = F.to_json(F.struct(*[F.col(f.name) for f in FLIGHTS.fields]))
    return df.select(*_typed_columns(df, set(FLIGHTS.fieldNames())), F.when(F.col("rejected"), text).alias("raw"),
                     "rules", "rejected")


def rejects_by_rule(judged: DataFrame) -> DataFrame:
    """``rule, n_rows`` over the bad rows; a row counts under every rule it breaks."""
    bad = judged.where("rejected").select(F.explode("rules").alias("rule"))
    return bad.groupBy("rule").agg(F.count(F.lit(1)).alias("n_rows"))


def to_flights_table(clean: DataFrame) -> DataFrame:
    """Project a cleaned frame onto the 31-column FLIGHTS_DLT schema, by name
    (columns the file did not carry are NULL)."""
    present = {c.lower() for c in clean.columns}
    return clean.select(*[
        (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in FLIGHTS.fields
    ])


def load_profile(raw: DataFrame, by: tuple[str, ...] = (), sentinels: tuple[str, ...] = TAILNUM_SENTINELS) -> DataFrame:
    """Row counts before cleaning, per reject reason, and after — one aggregate pass."""
    df = normalize_na(with_raw_columns(raw))
    t = F.col("tailnum")
    kept = _kept(sentinels)
    aggs = [
        F.count(F.lit(1)).alias("raw_rows"),
        F.count_if(_flag_set("cancelled")).alias("cancelled_rows"),
        F.count_if(_flag_set("diverted")).alias("diverted_rows"),
        F.count_if(t.isNull()).alias("null_tailnum_rows"),
        F.count_if(F.coalesce(t.isin(*sentinels), F.lit(False))).alias("sentinel_tailnum_rows"),
        F.count_if(kept).alias("clean_rows"),
    ]
    return (df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs))


def first_rows(raw: DataFrame, n: int = 5) -> DataFrame:
    """The log sample of the first rows."""
    return raw.limit(n)
