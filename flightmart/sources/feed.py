"""A raw flights feed derived from the driver's TPC-H-style tables.

No driver table holds flights, so the feed maps lineitem x orders x customer x
supplier x nation to the raw text columns of a flights file (all STRING, like
the pipe-delimited input). ``batch`` 0 holds orders before 1998, batch 1 the
rest. The mapping is the one specified in FIXTURES.md section 3, written with
DataFrame joins; its expressions are plain SQL so both engines agree.

At scale this is one shuffle join lineitem x orders on the order key; the
customer/supplier/nation sides are small dimension tables that AQE broadcasts
when their runtime size is under the broadcast threshold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FEED_COLUMNS = (
    "batch", "transactionid", "flightdate", "airlinecode", "airlinename", "tailnum",
    "flightnum", "originairportcode", "origairportname", "origincityname",
    "destairportcode", "destairportname", "destcityname", "crsdeptime", "deptime",
    "depdelay", "crsarrtime", "arrtime", "actualelapsedtime", "cancelled", "diverted",
    "distance",
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _clock(minutes: str) -> str:
    return f"cast(cast(cast(floor(({minutes})/60) as int)*100+({minutes})%60 as bigint) as string)"


def _nations(spark: SparkSession, sf_dir: str, side: str) -> DataFrame:
    """The nations' keys and the texts of their airports, for one end of a flight (``o`` or ``d``)."""
    k = f"{side}k"
    name = (f"concat('City',cast({k} as string),', S',cast({k}%10 as string),':',"
            f"case when {k}%10=1 then chr(9) else '  ' end,'Field ',cast({k} as string)")
    return _table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias(k)).selectExpr(
        k, f"concat('AP',cast({k} as string)) as {side}code", f"{name}) as {side}name",
        f"{name},case when {k}%10=0 then ' Intl' else '' end) as {side}name_intl",
        f"concat('City',cast({k} as string)) as {side}city")


def raw_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All raw rows of both batches; column ``batch`` marks the load they belong to."""
    li = _table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    od = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    cu = _table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    su = _table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    # A nation's texts are made once a nation and joined last; orders find their customer before lineitem,
    # the largest table, is shuffled.
    od = od.join(cu, od.o_custkey == cu.c_custkey).selectExpr(
        "o_orderkey", "c_nationkey", "o_orderstatus as st",
        "cast(year(o_orderdate)*10000+month(o_orderdate)*100+day(o_orderdate) as string) as flightdate",
        "case when o_orderdate >= timestamp '1998-01-01 00:00:00' then 1 else 0 end as b2")
    j = (
        li.join(od, li.l_orderkey == od.o_orderkey)
        .join(su, li.l_suppkey == su.s_suppkey)
        .join(_nations(spark, sf_dir, "o"), F.col("c_nationkey") == F.col("ok"))
        .join(_nations(spark, sf_dir, "d"), F.col("s_nationkey") == F.col("dk"))
        .selectExpr(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
            "cast(l_quantity as int) as q",
            "cast(round(l_extendedprice*100) as bigint) as cents",
            "flightdate", "b2", "ok", "dk", "l_partkey % 50 as fn", "st",
            "ocode", "oname", "oname_intl", "ocity", "dcode", "dname", "dname_intl", "dcity",
        )
        .selectExpr(
            "*",
            "(l_suppkey + case when b2=1 and l_suppkey%5=0 then 1 else 0 end) % 7 as al",
            "500+(fn*37)%900 + case when b2=1 and fn%3=0 then 30 else 0 end"
            " + case when fn%10=7 then (l_linenumber%2)*5 else 0 end as crs",
            "(q*53+l_linenumber*101)%1440 as dep",
            "30+(ok*131+dk*77)%330 as el",
            "60*((ok*7+dk*3)%6) as tz",
        )
    )
    return j.selectExpr(
        "b2 as batch",
        "concat_ws('-',cast(l_orderkey as string),cast(l_linenumber as string),cast(l_partkey as string),"
        "cast(l_suppkey as string),cast(cents as string)) as transactionid",
        "flightdate",
        "concat('C',cast(al as string)) as airlinecode",
        "concat('Airline ',cast(al as string),': C',cast(al as string)) as airlinename",
        "case when l_suppkey%17=3 then null when l_suppkey%17=4 and l_linenumber%2=0 then 'UNKNOW'"
        " when l_suppkey%17=4 then 'UNKNOWN' when l_suppkey%17=5 then 'NKNO'"
        " when l_suppkey%17=6 then '#NAME?' else concat('N',cast(l_suppkey as string)) end as tailnum",
        "case when fn=49 and l_linenumber=7 then null else cast(fn as string) end as flightnum",
        "ocode as originairportcode",
        "case when b2=1 then oname_intl else oname end as origairportname",
        "case when l_partkey%29=0 then 'NA' else ocity end as origincityname",
        "case when b2=1 and dk=24 then concat(dcode,'X') else dcode end as destairportcode",
        "case when b2=1 then dname_intl else dname end as destairportname",
        "case when l_partkey%37=1 then 'N/A' else dcity end as destcityname",
        f"{_clock('crs')} as crsdeptime",
        f"case when l_linenumber=7 and l_partkey%3=0 then 'NaN' else concat({_clock('dep')},"
        " case when l_linenumber%2=0 then '.0' when l_linenumber=5 then '.5' else '' end) end as deptime",
        "concat(cast(q-10 as string),'.0') as depdelay",
        f"{_clock('(crs+el)%1440')} as crsarrtime",
        f"concat({_clock('(dep+el-tz+1440)%1440')},'.0') as arrtime",
        "concat(cast(el as string),'.0') as actualelapsedtime",
        "case when st='P' and q%9=0 then 'T' when st='O' and q%11=0 then 'True' when st='F' and q%13=0 then '1'"
        " when q%2=0 then 'F' when q%3=0 then 'False' else '0' end as cancelled",
        "case when l_linenumber=7 and q%5=0 then 'True' when l_linenumber=6 and q%7=0 then '1'"
        " when l_linenumber=5 and q%8=0 then 'T' else 'False' end as diverted",
        "concat(cast(1+(ok*131+dk*77)%2500 as string),' miles') as distance",
    )


def batch_feed(spark: SparkSession, sf_dir: str, batch: int) -> DataFrame:
    """Raw rows of one batch, without the ``batch`` column (what one file holds)."""
    return raw_feed(spark, sf_dir).where(F.col("batch") == batch).drop("batch")
