"""Independent DuckDB oracles for the registered queries.

Each oracle restates the warehouse's own SQL in a single SELECT: the cleaning
rules as CASE/split_part, the SCD2 load as a literal "insert new UNION changed,
then UPDATE ... FROM (rank()=1 over count>1)" chain of CTEs (the update is a
correlated EXISTS), the fact and view as the source's joins. The first CTEs are
the derived feed of FIXTURES.md section 3, verbatim.
"""

from __future__ import annotations

import datetime as dt

# ---------------------------------------------------------------------------
# the derived feed (FIXTURES.md section 3)
# ---------------------------------------------------------------------------

FEED_CTES = """j as (
 select l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, cast(l.l_quantity as int) q,
  cast(round(l.l_extendedprice*100) as bigint) cents,
  year(o.o_orderdate)*10000+month(o.o_orderdate)*100+day(o.o_orderdate) ymd,
  case when o.o_orderdate >= timestamp '1998-01-01 00:00:00' then 1 else 0 end b2,
  cn.n_nationkey ok, sn.n_nationkey dk, l.l_partkey%50 fn, o.o_orderstatus st
 from lineitem l join orders o on l.l_orderkey=o.o_orderkey join customer c on o.o_custkey=c.c_custkey join nation cn on c.c_nationkey=cn.n_nationkey
 join supplier s on l.l_suppkey=s.s_suppkey join nation sn on s.s_nationkey=sn.n_nationkey),
k as (select *, (l_suppkey + case when b2=1 and l_suppkey%5=0 then 1 else 0 end)%7 al,
  500+(fn*37)%900 + case when b2=1 and fn%3=0 then 30 else 0 end + case when fn%10=7 then (l_linenumber%2)*5 else 0 end crs,
  (q*53+l_linenumber*101)%1440 dep, 30+(ok*131+dk*77)%330 el, 60*((ok*7+dk*3)%6) tz from j),
feed as (
select b2 as batch, concat_ws('-',cast(l_orderkey as string),cast(l_linenumber as string),cast(l_partkey as string),cast(l_suppkey as string),cast(cents as string)) as transactionid,
 cast(ymd as string) as flightdate,
 concat('C',cast(al as string)) as airlinecode,
 concat('Airline ',cast(al as string),': C',cast(al as string)) as airlinename,
 case when l_suppkey%17=3 then null when l_suppkey%17=4 and l_linenumber%2=0 then 'UNKNOW' when l_suppkey%17=4 then 'UNKNOWN' when l_suppkey%17=5 then 'NKNO' when l_suppkey%17=6 then '#NAME?' else concat('N',cast(l_suppkey as string)) end as tailnum,
 case when fn=49 and l_linenumber=7 then null else cast(fn as string) end as flightnum,
 concat('AP',cast(ok as string)) as originairportcode,
 concat('City',cast(ok as string),', S',cast(ok%10 as string),':',case when ok%10=1 then chr(9) else '  ' end,'Field ',cast(ok as string),case when b2=1 and ok%10=0 then ' Intl' else '' end) as origairportname,
 case when l_partkey%29=0 then 'NA' else concat('City',cast(ok as string)) end as origincityname,
 concat('AP',cast(dk as string),case when b2=1 and dk=24 then 'X' else '' end) as destairportcode,
 concat('City',cast(dk as string),', S',cast(dk%10 as string),':',case when dk%10=1 then chr(9) else '  ' end,'Field ',cast(dk as string),case when b2=1 and dk%10=0 then ' Intl' else '' end) as destairportname,
 case when l_partkey%37=1 then 'N/A' else concat('City',cast(dk as string)) end as destcityname,
 cast(cast(floor(crs/60) as int)*100+crs%60 as string) as crsdeptime,
 case when l_linenumber=7 and l_partkey%3=0 then 'NaN' else concat(cast(cast(floor(dep/60) as int)*100+dep%60 as string), case when l_linenumber%2=0 then '.0' when l_linenumber=5 then '.5' else '' end) end as deptime,
 concat(cast(q-10 as string),'.0') as depdelay,
 cast(cast(floor(((crs+el)%1440)/60) as int)*100+((crs+el)%1440)%60 as string) as crsarrtime,
 concat(cast(cast(floor(((dep+el-tz+1440)%1440)/60) as int)*100+((dep+el-tz+1440)%1440)%60 as string),'.0') as arrtime,
 concat(cast(el as string),'.0') as actualelapsedtime,
 case when st='P' and q%9=0 then 'T' when st='O' and q%11=0 then 'True' when st='F' and q%13=0 then '1' when q%2=0 then 'F' when q%3=0 then 'False' else '0' end as cancelled,
 case when l_linenumber=7 and q%5=0 then 'True' when l_linenumber=6 and q%7=0 then '1' when l_linenumber=5 and q%8=0 then 'T' else 'False' end as diverted,
 concat(cast(1+(ok*131+dk*77)%2500 as string),' miles') as distance
from k)"""

TEXT_COLUMNS = (
    "transactionid", "flightdate", "airlinecode", "airlinename", "tailnum", "flightnum",
    "originairportcode", "origairportname", "origincityname", "destairportcode",
    "destairportname", "destcityname", "crsdeptime", "deptime", "depdelay", "crsarrtime",
    "arrtime", "actualelapsedtime", "cancelled", "diverted", "distance",
)
FEED_COLUMNS = ("batch",) + TEXT_COLUMNS

# Reader NA tokens, flag tokens and tail-number sentinels (fixed values).
NA = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
      "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")
FLAGS = ("True", "T", "1")
SENTINELS = ("NKNO", "UNKNOW")
BOOL_T = ("t", "tr", "tru", "true", "y", "ye", "yes", "on", "1")
BOOL_F = ("f", "fa", "fal", "fals", "false", "n", "no", "of", "off", "0")


def _lst(vals) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in vals)


def _d(x: dt.date) -> str:
    return f"date '{x.isoformat()}'"


NF_CTE = "nf as (select batch, " + ", ".join(
    f"case when {c} in ({_lst(NA)}) then null else {c} end as {c}" for c in TEXT_COLUMNS) + " from feed)"


def _bool(c: str) -> str:
    return (f"case when lower(trim({c})) in ({_lst(BOOL_T)}) then true "
            f"when lower(trim({c})) in ({_lst(BOOL_F)}) then false end")


KEEP = (f"coalesce(cancelled not in ({_lst(FLAGS)}), true) and coalesce(diverted not in ({_lst(FLAGS)}), true) "
        f"and tailnum is not null and tailnum not in ({_lst(SENTINELS)})")

CL_CTE = f"""cl as (select batch, transactionid, cast(strptime(flightdate, '%Y%m%d') as date) as flightdate,
 airlinecode, split_part(airlinename, ':', 1) as airlinename, tailnum, flightnum,
 originairportcode, regexp_replace(split_part(origairportname, ':', 2), '^\\s+', '') as origairportname, origincityname,
 destairportcode, regexp_replace(split_part(destairportname, ':', 2), '^\\s+', '') as destairportname, destcityname,
 crsdeptime, deptime, cast(trunc(cast(depdelay as double)) as integer) as depdelay, crsarrtime, arrtime, actualelapsedtime,
 {_bool('cancelled')} as cancelled, {_bool('diverted')} as diverted,
 cast(split_part(distance, ' ', 1) as integer) as distance
 from nf where {KEEP})"""

BASE = [FEED_CTES, NF_CTE, CL_CTE]


def _clock(c: str) -> str:
    return f"cast(round(try_cast({c} as decimal(38,18))) as integer)"


MEASURES_CTE = f"""ms as (select *,
 case when distance <= 100 then '0-100 miles' else concat(cast((distance-1)//100*100+1 as varchar), '-',
   cast((distance-1)//100*100+100 as varchar), ' miles') end as distancegroup,
 case when depdelay > 15 then 1 else 0 end as depdelaygt15,
 case when dep_i > arr_i and (dep_i//100*60 + (dep_i//100*60) % 100 + ela_i - (arr_i//100*60 + arr_i % 100)) > 300
   then 1 else 0 end as nextdayarr,
 case when dep_i > arr_i and (dep_i//100*60 + dep_i % 100 + ela_i - (arr_i//100*60 + arr_i % 100)) > 300
   then 1 else 0 end as nextdayarr_fixed
 from (select *, {_clock('deptime')} as dep_i, {_clock('arrtime')} as arr_i, {_clock('actualelapsedtime')} as ela_i from cl) x)"""


def _with(ctes: list[str], body: str) -> str:
    return "with " + ",\n".join(ctes) + "\n" + body


# ---------------------------------------------------------------------------
# dimensions
# ---------------------------------------------------------------------------

DIMS = {
    "airplane": dict(keys=("tailnum",), attrs=("airlinecode", "airlinename"),
                     content="md5(concat_ws('-', {p}airlinecode, {p}airlinename))", offset=1),
    "airport": dict(keys=("airportcode",), attrs=("airportname", "cityname"),
                    content="md5(concat('_', {p}airportname, {p}cityname))", offset=0),
    "route": dict(keys=("flightnum", "originairportcode", "destairportcode", "distance"),
                  attrs=("crsdeptime", "crsarrtime"),
                  content="md5(concat('_', {p}crsdeptime, {p}crsarrtime))", offset=1),
}
LOADS = ((dt.date(2024, 1, 1), 0), (dt.date(2024, 2, 1), 1), (dt.date(2024, 2, 1), 1), (dt.date(2024, 3, 1), 0))
BUCKETS = 256


def _cols(d) -> list[str]:
    return list(d["keys"]) + list(d["attrs"])


def _numbering(dim: str) -> list[str]:
    """Columns in the order of the stage table, which new keys follow."""
    if dim == "route":
        return ["flightnum", "originairportcode", "destairportcode", "crsdeptime", "crsarrtime", "distance"]
    return _cols(DIMS[dim])


def stage_sql(dim: str, batch: int) -> str:
    if dim == "airplane":
        return f"select tailnum, airlinecode, airlinename from cl where batch = {batch} group by tailnum, airlinecode, airlinename"
    if dim == "airport":
        return (f"select originairportcode as airportcode, origairportname as airportname, origincityname as cityname "
                f"from cl where batch = {batch} group by 1, 2, 3 union "
                f"select destairportcode, destairportname, destcityname from cl where batch = {batch} group by 1, 2, 3")
    return (f"select flightnum, originairportcode, destairportcode, crsdeptime, crsarrtime, distance from cl "
            f"where batch = {batch} group by 1, 2, 3, 4, 5, 6")


def _empty_dim(dim: str) -> str:
    d = DIMS[dim]
    cols = ", ".join(
        f"cast(null as {'integer' if c == 'distance' else 'varchar'}) as {c}" for c in _cols(d))
    return (f"select cast(null as integer) as skey, {cols}, cast(null as varchar) as current_flag, "
            f"cast(null as date) as efft_date, cast(null as date) as expy_date where false")


def dim_chain(dim: str, n_loads: int, with_keys: bool = False) -> tuple[list[str], list[str]]:
    """CTEs for ``n_loads`` loads of one dimension; returns (ctes, names of d_i)."""
    d = DIMS[dim]
    keys, attrs, cols = list(d["keys"]), list(d["attrs"]), _cols(d)
    ctes = [f"{dim}_d0 as ({_empty_dim(dim)})"]
    names = []
    for i, (as_of, b) in enumerate(LOADS[:n_loads], start=1):
        p, n, A = f"{dim}_d{i-1}", f"{dim}_", _d(as_of)
        on = " and ".join(f"dlt.{k} = dim.{k}" for k in keys)
        nulls = " or ".join(f"dim.{k} is null" for k in keys)
        ctes.append(f"{n}stg{i} as ({stage_sql(dim, b)})")
        ctes.append(f"{n}cur{i} as (select * from {p} where {A} between efft_date and expy_date)")
        ctes.append(
            f"{n}new{i} as (select {', '.join('dlt.' + c for c in cols)} from {n}stg{i} dlt "
            f"left join {n}cur{i} dim on {on} where {nulls})")
        ctes.append(
            f"{n}chg{i} as (select {', '.join('dlt.' + c for c in cols)} from "
            f"(select *, {d['content'].format(p='')} as content from {n}stg{i}) dlt join "
            f"(select {', '.join(keys)}, {d['content'].format(p='')} as content from {n}cur{i}) dim "
            f"on {on} where dlt.content != dim.content)")
        ctes.append(f"{n}ins{i} as (select * from {n}new{i} union select * from {n}chg{i})")
        text = "concat_ws('|', " + ", ".join(_numbering(dim)) + ")"
        ctes.append(
            f"{n}kb{i} as (select *, cast(('0x' || substr(md5({text}), 1, 8)) as bigint) % {BUCKETS} as kb "
            f"from {n}ins{i})")
        ctes.append(
            f"{n}ko{i} as (select kb, coalesce(sum(cnt) over (order by kb rows between unbounded preceding "
            f"and 1 preceding), 0) as off from (select kb, count(*) as cnt from {n}kb{i} group by kb) c)")
        ctes.append(
            f"{n}kk{i} as (select {', '.join('x.' + c for c in cols)}, cast((select coalesce(max(skey), 0) from {p})"
            f" + o.off + row_number() over (partition by x.kb order by {', '.join('x.' + c + ' nulls first' for c in _numbering(dim))})"
            f" as integer) as skey from {n}kb{i} x join {n}ko{i} o on x.kb = o.kb)")
        ctes.append(
            f"{n}u{i} as (select skey, {', '.join(cols)}, 'Y' as current_flag, {A} as efft_date, "
            f"date '9999-12-31' as expy_date from {n}kk{i} union all select * from {p})")
        pk = ", ".join(keys)
        ctes.append(
            f"{n}exp{i} as (select {pk}, efft_date from (select {pk}, efft_date, rank() over (partition by {pk} "
            f"order by efft_date) as efft_rank from (select {pk}, efft_date, count(*) over (partition by {pk}) as cnt "
            f"from {n}u{i} where {A} between efft_date and expy_date) a where cnt > 1) b where efft_rank = 1)")
        hit = (f"exists (select 1 from {n}exp{i} e where "
               + " and ".join(f"e.{k} = u.{k}" for k in keys) + " and e.efft_date = u.efft_date)")
        exp_date = _d(as_of - dt.timedelta(days=d["offset"]))
        ctes.append(
            f"{n}d{i} as (select skey, {', '.join('u.' + c for c in cols)}, "
            f"case when {hit} then 'N' else current_flag end as current_flag, efft_date, "
            f"case when {hit} then {exp_date} else expy_date end as expy_date from {n}u{i} u)")
        names.append(f"{n}d{i}")
    return ctes, names


def _dim_public(dim: str) -> str:
    return ", ".join(_cols(DIMS[dim]) + ["current_flag", "efft_date", "expy_date"])


# ---------------------------------------------------------------------------
# oracle texts
# ---------------------------------------------------------------------------


def _second_load(dim: str) -> list[str]:
    ctes, _ = dim_chain(dim, 2)
    return BASE + ctes


def _fact_ctes() -> list[str]:
    ctes = BASE + [MEASURES_CTE]
    for dim in ("airplane", "airport", "route"):
        ctes += dim_chain(dim, 2)[0]
    parts = []
    for i, (as_of, b) in enumerate(LOADS[:2], start=1):
        parts.append(
            f"select {_d(as_of)} as load_date, c.transactionid, c.distance, c.distancegroup, c.depdelay, "
            f"c.depdelaygt15, c.nextdayarr, a.efft_date is not null as has_route, bb.efft_date is not null as has_airplane, "
            f"bb.airlinename as p_airlinename, a.originairportcode as p_origin, a.destairportcode as p_dest "
            f"from ms c left join route_d{i} a on a.flightnum = c.flightnum and a.originairportcode = c.originairportcode "
            f"and a.destairportcode = c.destairportcode and a.distance = c.distance "
            f"left join airplane_d{i} bb on bb.tailnum = c.tailnum where c.batch = {b}")
    ctes.append("fact as (" + " union all ".join(parts) + ")")
    return ctes


VIEW_BODY = ("select f.transactionid, f.distancegroup, f.depdelaygt15, f.nextdayarr, f.p_airlinename as airlinename, "
             "d.airportname as origairportname, e.airportname as destairportname from fact f "
             "join airport_d2 d on d.airportcode = f.p_origin join airport_d2 e on e.airportcode = f.p_dest "
             "where f.has_route and f.has_airplane")


def _scd2(dim: str) -> str:
    ctes, names = dim_chain(dim, 4)
    body = " union all ".join(f"select {i} as load_no, {_dim_public(dim)} from {n}" for i, n in enumerate(names, 1))
    return _with(BASE + ctes, body)


def _stage(dim: str) -> str:
    cols = {"airplane": "tailnum, airlinecode, airlinename", "airport": "airportcode, airportname, cityname",
            "route": "flightnum, originairportcode, destairportcode, crsdeptime, crsarrtime, distance"}[dim]
    body = " union all ".join(f"select {b} as batch, {cols} from ({stage_sql(dim, b)}) s{b}" for b in (0, 1))
    return _with(BASE, body)


DIM_NAMES = {"airplane": "dim_airplane", "airport": "dim_airport", "route": "dim_air_route"}


def _joined(cols) -> str:
    return "concat_ws('|', " + ", ".join(f"coalesce(cast({c} as varchar), '~')" for c in cols) + ")"


def _each(table: str, extra: str, where: str = "", attrs: bool = True) -> str:
    """The same SELECT over every dimension; ``{d}`` is its short name, ``{k}`` its keys."""
    parts = []
    for name, d in DIMS.items():
        about = f", {_joined(d['attrs'])} as attributes" if attrs else ""
        parts.append(f"select '{DIM_NAMES[name]}' as dim, {_joined(d['keys'])} as natural_key{about}, "
                     f"{extra.format(k=', '.join(d['keys']))} from {table.format(d=name)} {where}")
    return " union all ".join(parts)


def _new(dim: str) -> str:
    return _with(_second_load(dim), f"select * from {dim}_new2")


def _changed(dim: str) -> str:
    return _with(_second_load(dim), f"select * from {dim}_chg2")


FLIGHTS_31 = (
    "transactionid", "flightdate", "airlinecode", "airlinename", "tailnum", "flightnum", "originairportcode",
    "origairportname", "origincityname", "originstate", "originstatename", "destairportcode", "destairportname",
    "destcityname", "deststate", "deststatename", "crsdeptime", "deptime", "depdelay", "taxiout", "wheelsoff",
    "wheelson", "taxiin", "crsarrtime", "arrtime", "arrdelay", "crselapsedtime", "actualelapsedtime",
    "cancelled", "diverted", "distance",
)


def oracles() -> dict[str, str]:
    feed_cols = ", ".join(FEED_COLUMNS)
    o: dict[str, str] = {}
    o["scan_pipe_file"] = _with([FEED_CTES], "select cast(batch as varchar) as batch, "
                                + ", ".join(TEXT_COLUMNS) + " from feed")
    o["na_tokens"] = _with([FEED_CTES, NF_CTE], "select * from nf")
    o["drop_cancelled"] = _with([FEED_CTES, NF_CTE], f"select * from nf where coalesce(cancelled not in ({_lst(FLAGS)}), true)")
    o["drop_diverted"] = _with([FEED_CTES, NF_CTE], f"select * from nf where coalesce(diverted not in ({_lst(FLAGS)}), true)")
    o["drop_bad_tailnum"] = _with([FEED_CTES, NF_CTE],
                                  f"select * from nf where tailnum is not null and tailnum not in ({_lst(SENTINELS)})")
    o["clean_names"] = _with([FEED_CTES, NF_CTE], """select batch, transactionid, split_part(airlinename, ':', 1) as airlinename,
 regexp_replace(split_part(origairportname, ':', 2), '^\\s+', '') as origairportname,
 regexp_replace(split_part(destairportname, ':', 2), '^\\s+', '') as destairportname from nf""")
    o["clock_to_int"] = _with([FEED_CTES, NF_CTE], f"""select transactionid, {_clock('deptime')} as deptime_int,
 {_clock('arrtime')} as arrtime_int, {_clock('actualelapsedtime')} as actualelapsedtime_int from nf""")
    o["clean_flights"] = _with(BASE, f"select {feed_cols} from cl")
    o["load_profile"] = _with([FEED_CTES, NF_CTE], f"""select batch, count(*) as raw_rows,
 count(*) filter (where cancelled in ({_lst(FLAGS)})) as cancelled_rows,
 count(*) filter (where diverted in ({_lst(FLAGS)})) as diverted_rows,
 count(*) filter (where tailnum is null) as null_tailnum_rows,
 count(*) filter (where tailnum in ({_lst(SENTINELS)})) as sentinel_tailnum_rows,
 count(*) filter (where {KEEP}) as clean_rows from nf group by batch""")
    o["distance_group"] = _with(BASE + [MEASURES_CTE], "select transactionid, distance, distancegroup from ms")
    o["dep_delay_gt15"] = _with(BASE + [MEASURES_CTE], "select transactionid, depdelay, depdelaygt15 from ms")
    o["next_day_arrival"] = _with(BASE + [MEASURES_CTE], "select transactionid, nextdayarr from ms")
    o["next_day_arrival_fixed"] = _with(BASE + [MEASURES_CTE],
                                        "select transactionid, nextdayarr_fixed as nextdayarr from ms")
    o["stage_airplane"] = _stage("airplane")
    o["stage_airport"] = _stage("airport")
    o["stage_air_route"] = _stage("route")
    all_dims = BASE + [c for dim in DIMS for c in dim_chain(dim, 2)[0]]
    o["surrogate_keys"] = _with(all_dims, _each("{d}_d2", "skey, efft_date"))
    o["current_as_of"] = _with(all_dims, _each(
        "{d}_d2", "current_flag, efft_date, expy_date", "where date '2024-02-01' between efft_date and expy_date"))
    for dim, q in (("airplane", "airplanes"), ("airport", "airports"), ("route", "routes")):
        o[f"new_{q}"] = _new(dim)
        o[f"changed_{q}"] = _changed(dim)
    o["version_counts"] = _with(all_dims, _each(
        "{d}_u2", "current_flag, efft_date, expy_date, cast(count(*) over (partition by {k}) as integer) as cnt",
        "where date '2024-02-01' between efft_date and expy_date"))
    o["expiry_candidates"] = _with(all_dims, _each("{d}_exp2", "efft_date", attrs=False))
    o["scd2_airplane"] = _scd2("airplane")
    o["scd2_airport"] = _scd2("airport")
    o["scd2_air_route"] = _scd2("route")
    o["fact_route_lookup"] = _with(BASE + dim_chain("route", 2)[0], " union all ".join(
        f"""select {i} as load_no, c.transactionid, a.crsdeptime as route_crsdeptime, a.crsarrtime as route_crsarrtime,
 a.efft_date as route_efft_date from cl c left join route_d{i} a on a.flightnum = c.flightnum
 and a.originairportcode = c.originairportcode and a.destairportcode = c.destairportcode
 and a.distance = c.distance where c.batch = {b}""" for i, (_, b) in enumerate(LOADS[:2], start=1)))
    o["fact_airplane_lookup"] = _with(BASE + dim_chain("airplane", 2)[0], " union all ".join(
        f"""select {i} as load_no, c.transactionid, a.airlinecode as airplane_airlinecode,
 a.airlinename as airplane_airlinename, a.efft_date as airplane_efft_date
 from cl c left join airplane_d{i} a on a.tailnum = c.tailnum where c.batch = {b}"""
        for i, (_, b) in enumerate(LOADS[:2], start=1)))
    o["fact_flights"] = _with(_fact_ctes(), """select load_date, transactionid, distance, distancegroup, depdelay,
 depdelaygt15, nextdayarr, has_route, has_airplane from fact""")
    o["vw_flights"] = _with(_fact_ctes(), VIEW_BODY)
    flights31 = ", ".join(
        c if c in TEXT_COLUMNS else f"cast(null as varchar) as {c}" for c in FLIGHTS_31)
    o["flights_refresh"] = _with(BASE, f"select {flights31} from cl where batch = 1")
    o["two_batch_load"] = o["vw_flights"]
    return o
