"""DuckDB restatements of the queries of ``flightmart/plans/scenario_options.py``.

They build on the CTE chain of ``oracle_sql`` (the literal insert + update form of the loads), or
restate the option's own rule.
"""

from __future__ import annotations

import datetime as dt

from oracle_sql import (
    BASE, DIM_NAMES, DIMS, FEED_CTES, FLIGHTS_31, KEEP, LOADS, MEASURES_CTE, NA, NF_CTE, TEXT_COLUMNS, VIEW_BODY,
    _bool, _cols, _d, _dim_public, _fact_ctes, _joined, _lst, _numbering, _scd2, _with, dim_chain, stage_sql,
)

BUCKETS = 256


def _whole(d, alias: str = "") -> str:
    return " and ".join(f"{alias}{k} is not null" for k in d["keys"])


# -- sliced dimensions ---------------------------------------------------------------


def _slices() -> str:
    ctes, parts = list(BASE), []
    for dim, d in DIMS.items():
        chain, names = dim_chain(dim, 4)
        ctes += chain
        for i, ((as_of, _), n) in enumerate(zip(LOADS, names, strict=True), start=1):
            touched = f"(select efft_date from {dim}_exp{i} where {_whole(d)})"
            parts.append(
                f"select '{DIM_NAMES[dim]}' as dim, {i} as load_no, state, efft_date, count(*) as n_rows, "
                f"efft_date in {touched} or (state = 'open' and efft_date = {_d(as_of)} and "
                f"(select count(*) from {dim}_ins{i}) > 0) as written from "
                f"(select efft_date, case when expy_date = date '9999-12-31' then 'open' else 'closed' end as state from {n}) x "
                f"group by state, efft_date")
    return _with(ctes, " union all ".join(parts))


def _multi() -> str:
    ctes, parts = list(BASE), []
    for dim, d in DIMS.items():
        chain, names = dim_chain(dim, 4)
        ctes += chain
        keys = ", ".join(d["keys"])
        for i, ((as_of, _), n) in enumerate(zip(LOADS, names, strict=True), start=1):
            parts.append(f"select '{DIM_NAMES[dim]}' as dim, {i} as load_no, {_joined(d['keys'])} as natural_key from {n} "
                         f"where expy_date >= {_d(as_of)} and {_whole(d)} group by {keys} having count(*) > 1")
    return _with(ctes, " union all ".join(parts))


# -- one current row per key ------------------------------------------------------------


def _single(dim: str) -> str:
    d = DIMS[dim]
    keys, attrs, cols = list(d["keys"]), list(d["attrs"]), _cols(d)
    types = {"distance": "integer"}
    empty = ", ".join(f"cast(null as {types.get(c, 'varchar')}) as {c}" for c in cols)
    ctes = list(BASE) + [f"s0 as (select cast(null as integer) as skey, {empty}, cast(null as varchar) as current_flag, "
                         "cast(null as date) as efft_date, cast(null as date) as expy_date where false)"]
    pk = ", ".join(keys)
    best = ", ".join(f"{a} desc nulls last" for a in attrs)
    same = " and ".join(f"w.{k} is not distinct from c.{k}" for k in keys)
    text = "concat_ws('|', " + ", ".join(_numbering(dim)) + ")"
    order = ", ".join(f"x.{c} nulls first" for c in _numbering(dim))
    for i, (as_of, b) in enumerate(LOADS, start=1):
        A, p = _d(as_of), f"s{i - 1}"
        ctes.append(f"w{i} as (select {', '.join(cols)} from (select *, row_number() over (partition by {pk} order by {best}) as r "
                    f"from ({stage_sql(dim, b)}) g) y where r = 1)")
        ctes.append(f"c{i} as (select * from (select *, row_number() over (partition by {pk} order by efft_date desc, skey desc) as r "
                    f"from {p} where {A} between efft_date and expy_date) y where r = 1)")
        ctes.append(f"f{i} as (select {', '.join('w.' + c for c in cols)} from w{i} w left join c{i} c on {same} "
                    f"where c.skey is null or {d['content'].format(p='w.')} != {d['content'].format(p='c.')})")
        ctes.append(f"b{i} as (select *, cast(('0x' || substr(md5({text}), 1, 8)) as bigint) % {BUCKETS} as kb from f{i})")
        ctes.append(f"o{i} as (select kb, coalesce(sum(cnt) over (order by kb rows between unbounded preceding and 1 preceding), 0) "
                    f"as off from (select kb, count(*) as cnt from b{i} group by kb) c)")
        ctes.append(f"k{i} as (select cast((select coalesce(max(skey), 0) from {p}) + o.off + row_number() over "
                    f"(partition by x.kb order by {order}) as integer) as skey, {', '.join('x.' + c for c in cols)} "
                    f"from b{i} x join o{i} o on x.kb = o.kb)")
        hit = (f"({A} between c.efft_date and c.expy_date and exists (select 1 from k{i} w where {same}))")
        end = _d(as_of - dt.timedelta(days=d["offset"]))
        ctes.append(f"s{i} as (select skey, {', '.join(cols)}, case when {hit} then 'N' else current_flag end as current_flag, efft_date, "
                    f"case when {hit} then {end} else expy_date end as expy_date from {p} c union all "
                    f"select skey, {', '.join(cols)}, 'Y', {A}, date '9999-12-31' from k{i})")
    public = "skey, " + _dim_public(dim)
    return _with(ctes, " union all ".join(f"select {i} as load_no, {public} from s{i}" for i in range(1, 5)))


# -- fact and view -------------------------------------------------------------------------


def _fitting(table: str, dim: str, as_of: dt.date) -> str:
    """The version of every key that fits a date: the last valid one, else the last that started."""
    keys = ", ".join(DIMS[dim]["keys"])
    A = _d(as_of)
    return (f"(select * from (select *, row_number() over (partition by {keys} order by ({A} <= expy_date) desc, "
            f"efft_date desc, skey desc) as r from {table} where efft_date <= {A} and {_whole(DIMS[dim])}) y where r = 1)")


def _one_row_ctes() -> list[str]:
    ctes = BASE + [MEASURES_CTE]
    for dim in DIMS:
        ctes += dim_chain(dim, 2)[0]
    parts = []
    for i, (as_of, b) in enumerate(LOADS[:2], start=1):
        parts.append(
            f"select {_d(as_of)} as load_date, c.transactionid, c.distancegroup, c.depdelaygt15, c.nextdayarr, "
            f"r.skey as air_route_skey, a.skey as airplane_skey from ms c left join {_fitting(f'route_d{i}', 'route', as_of)} r "
            f"on r.flightnum = c.flightnum and r.originairportcode = c.originairportcode "
            f"and r.destairportcode = c.destairportcode and r.distance = c.distance "
            f"left join {_fitting(f'airplane_d{i}', 'airplane', as_of)} a on a.tailnum = c.tailnum where c.batch = {b}")
    return ctes + ["one as (" + " union all ".join(parts) + ")"]


def _view_one_row() -> str:
    parts = []
    for as_of, _ in LOADS[:2]:
        ports = _fitting("airport_d2", "airport", as_of)
        parts.append(
            f"select f.transactionid, f.distancegroup, f.depdelaygt15, f.nextdayarr, a.airlinename, d.airportname as origairportname, "
            f"e.airportname as destairportname from one f join airplane_d2 a on a.skey = f.airplane_skey "
            f"join route_d2 r on r.skey = f.air_route_skey join {ports} d on d.airportcode = r.originairportcode "
            f"join {ports} e on e.airportcode = r.destairportcode where f.load_date = {_d(as_of)}")
    return _with(_one_row_ctes(), " union all ".join(parts))


FACT_BODY = """select load_date, transactionid, distance, distancegroup, depdelay,
 depdelaygt15, nextdayarr, has_route, has_airplane from fact"""
FIRST_VIEW = VIEW_BODY.replace("airport_d2", "airport_d1") + f" and f.load_date = {_d(LOADS[0][0])}"


# -- inferred types ----------------------------------------------------------------------------

INTEGER = r"'^\s*[+-]?[0-9]+\s*$'"
FLOAT = r"'^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$'"


def _kind_ctes() -> list[str]:
    words = _lst(("True", "TRUE", "true", "False", "FALSE", "false"))

    def counts(c: str) -> str:
        whole = f"regexp_matches({c}, {INTEGER}) and try_cast(replace(trim({c}), '+', '') as bigint) is not null"
        return (f"select '{c}' as column_name, count(*) as n, count({c}) as known, count(*) filter (where {whole}) as integers, "
                f"count(*) filter (where regexp_matches({c}, {INTEGER})) as digits, "
                f"count(*) filter (where regexp_matches({c}, {FLOAT})) as floats, "
                f"count(*) filter (where {c} in ({words})) as booleans from nf")

    kind = ("case when known = 0 then 'empty' when integers = n then 'integer' when digits = n then 'text' when floats = known then 'float' "
            "when booleans = known then 'boolean' else 'text' end")
    return [FEED_CTES, NF_CTE, "counts as (" + " union all ".join(counts(c) for c in TEXT_COLUMNS) + ")",
            f"kinds as (select column_name, {kind} as kind from counts)"]


def _as_read() -> str:
    def text(c: str) -> str:
        kind = f"(select kind from kinds where column_name = '{c}')"
        return (f"case {kind} when 'integer' then cast(try_cast({c} as bigint) as varchar) "
                f"when 'float' then cast(try_cast({c} as double) as varchar) else {c} end as {c}")
    return _with(_kind_ctes(), f"select batch, {', '.join(text(c) for c in TEXT_COLUMNS)} from nf")


# -- rejects ----------------------------------------------------------------------------------

FAULTS = (
    ("depdelay", "%13", "'late'"), ("airlinename", "%27", "null"), ("origairportname", "%41", "'no colon'"),
    ("distance", "%55", "'far'"), ("flightdate", "%69", "'2002-13-45'"), ("cancelled", "%83", "'maybe'"),
    ("destairportname", "%97", "null"), ("depdelay", "%55", "'NaN'"), ("diverted", "%313", "''"),
)


def _faulty_ctes() -> list[str]:
    def value(c: str) -> str:
        out = c
        for column, like, v in FAULTS:
            if column == c:
                out = f"case when transactionid like '{like}' then {v} else {out} end"
        return f"{out} as {c}"

    bad = f"select batch, {', '.join(value(c) for c in TEXT_COLUMNS)} from feed"
    read = ", ".join(f"case when {c} in ({_lst(NA)}) then null else {c} end as {c}" for c in TEXT_COLUMNS)
    rules = {
        "unparseable FLIGHTDATE": "flightdate is not null and try_strptime(flightdate, '%Y%m%d') is null",
        "missing FLIGHTDATE": "kept and flightdate is null",
        "missing or non-numeric DEPDELAY": "kept and try_cast(depdelay as double) is null",
        "missing AIRLINENAME": "kept and airlinename is null",
        "no ':' in ORIGAIRPORTNAME": "kept and coalesce(strpos(origairportname, ':'), 0) = 0",
        "no ':' in DESTAIRPORTNAME": "kept and coalesce(strpos(destairportname, ':'), 0) = 0",
        "missing or non-numeric DISTANCE": "kept and try_cast(split_part(distance, ' ', 1) as integer) is null",
        "missing or invalid CANCELLED": f"kept and ({_bool('cancelled')}) is null",
        "missing or invalid DIVERTED": f"kept and ({_bool('diverted')}) is null",
    }
    listed = ", ".join("case when " + c + " then '" + n.replace("'", "''") + "' end" for n, c in rules.items())
    return [FEED_CTES, f"faulty as ({bad})", f"known as (select batch, {read} from faulty)",
            f"kept as (select *, ({KEEP}) as kept from known)",
            f"ruled as (select *, list_filter([{listed}], lambda r: r is not null) as rules from kept)",
            "judged as (select * from ruled where kept or len(rules) > 0)"]


def _tolerated() -> str:
    from oracle_sql import CL_CTE

    rows = "nf as (select * from judged where len(rules) = 0)"
    flights31 = ", ".join(c if c in TEXT_COLUMNS else f"cast(null as varchar) as {c}" for c in FLIGHTS_31)
    return _with(_faulty_ctes() + [rows, CL_CTE], f"select {flights31} from cl")


def _rejected() -> str:
    raw = ", ".join(f"f.{c}" for c in TEXT_COLUMNS)
    return _with(_faulty_ctes(), f"select {raw}, array_to_string(j.rules, '; ') as rules from judged j join faulty f "
                                 f"on f.transactionid = j.transactionid where len(j.rules) > 0")


def oracles() -> dict[str, str]:
    o = {f"scd2_sliced_{q}": _scd2(dim) for dim, q in (("airplane", "airplane"), ("airport", "airport"), ("route", "air_route"))}
    o |= {f"scd2_single_{q}": _single(dim) for dim, q in (("airplane", "airplane"), ("airport", "airport"), ("route", "air_route"))}
    o["dimension_slices"] = _slices()
    o["multi_version_keys"] = _multi()
    o["vw_flights_sliced"] = _with(_fact_ctes(), VIEW_BODY)
    o["fact_append_new_only"] = _with(_fact_ctes(), FACT_BODY)
    o["fact_one_row"] = _with(_one_row_ctes(), "select load_date, transactionid, air_route_skey, airplane_skey from one")
    o["vw_flights_one_row"] = _view_one_row()
    o["vw_flights_after_first_load"] = _with(_fact_ctes(), FIRST_VIEW)
    o["load_each_file_once"] = _with(_fact_ctes(), VIEW_BODY)
    two = "case when transactionid like '%7' then concat(destcityname, chr(10), '\"East|West\"') else destcityname end"
    o["column_kinds"] = _with(_kind_ctes(), "select column_name, kind from kinds")
    o["flights_as_read"] = _as_read()
    o["scan_quoted_lines"] = _with([FEED_CTES], "select cast(batch as varchar) as batch, " + ", ".join(
        f"{two} as destcityname" if c == "destcityname" else c for c in TEXT_COLUMNS) + " from feed")
    o["rejects_by_rule"] = _with(_faulty_ctes(), "select rule, count(*) as n_rows from "
                                 "(select unnest(rules) as rule from judged) x group by rule")
    o["tolerated_flights"] = _tolerated()
    o["rejected_flights"] = _rejected()
    return o
