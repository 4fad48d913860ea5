"""Table schemas, dimension specs and the fixed values the warehouse must honour.

Column names are lower case: the warehouse DDL uses unquoted identifiers, which
SQL folds to lower case, so these are the names the tables really carry.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import types as T

S = T.StringType()
I = T.IntegerType()

# ---------------------------------------------------------------------------
# FIXED VALUES — these must equal the source system's behaviour for results
# to match. They are stated here once, in natural order.
# ---------------------------------------------------------------------------

# Tokens the default pandas text reader turns into missing values.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)
# CANCELLED / DIVERTED values that mark a row for removal (case-sensitive).
FLAG_TRUE_TOKENS = ("True", "T", "1")
# Tail numbers dropped as meaningless (exact, case-sensitive match).
TAILNUM_SENTINELS = ("NKNO", "UNKNOW")
# Open-ended expiry date of a current dimension version.
OPEN_END = _dt.date(9999, 12, 31)
CURRENT_FLAG_OPEN = "Y"
CURRENT_FLAG_CLOSED = "N"
# Measures on the fact table.
DISTANCE_BAND_WIDTH = 100
DISTANCE_FIRST_BAND = "0-100 miles"
DISTANCE_SUFFIX = " miles"
DEP_DELAY_THRESHOLD = 15
NEXT_DAY_GAP_MINUTES = 5 * 60

# ---------------------------------------------------------------------------
# Table schemas (column order as in the warehouse DDL)
# ---------------------------------------------------------------------------

FLIGHTS = T.StructType([
    T.StructField("transactionid", S), T.StructField("flightdate", T.DateType()),
    T.StructField("airlinecode", S), T.StructField("airlinename", S),
    T.StructField("tailnum", S), T.StructField("flightnum", S),
    T.StructField("originairportcode", S), T.StructField("origairportname", S),
    T.StructField("origincityname", S), T.StructField("originstate", S),
    T.StructField("originstatename", S), T.StructField("destairportcode", S),
    T.StructField("destairportname", S), T.StructField("destcityname", S),
    T.StructField("deststate", S), T.StructField("deststatename", S),
    T.StructField("crsdeptime", S), T.StructField("deptime", S),
    T.StructField("depdelay", I), T.StructField("taxiout", S),
    T.StructField("wheelsoff", S), T.StructField("wheelson", S),
    T.StructField("taxiin", S), T.StructField("crsarrtime", S),
    T.StructField("arrtime", S), T.StructField("arrdelay", S),
    T.StructField("crselapsedtime", S), T.StructField("actualelapsedtime", S),
    T.StructField("cancelled", T.BooleanType()), T.StructField("diverted", T.BooleanType()),
    T.StructField("distance", I),
])

# The raw file is read as text; its header names a subset of these columns.
RAW_COLUMNS = tuple(f.name for f in FLIGHTS.fields)

STG_AIRPLANE = T.StructType([
    T.StructField("tailnum", S), T.StructField("airlinecode", S), T.StructField("airlinename", S),
])
STG_AIRPORT = T.StructType([
    T.StructField("airportcode", S), T.StructField("airportname", S), T.StructField("cityname", S),
])
STG_AIR_ROUTE = T.StructType([
    T.StructField("flightnum", S), T.StructField("originairportcode", S),
    T.StructField("destairportcode", S), T.StructField("crsdeptime", S),
    T.StructField("crsarrtime", S), T.StructField("distance", I),
])

_SCD_TAIL = [
    T.StructField("current_flag", S), T.StructField("efft_date", T.DateType()),
    T.StructField("expy_date", T.DateType()),
]


def _dim(skey: str, stage: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(skey, I)] + list(stage.fields) + _SCD_TAIL)


DIM_AIRPLANE = _dim("airplane_skey", STG_AIRPLANE)
DIM_AIRPORT = _dim("airport_skey", STG_AIRPORT)
DIM_AIR_ROUTE = _dim("air_route_skey", STG_AIR_ROUTE)

FACT_FLIGHTS = T.StructType([
    T.StructField("air_route_skey", I), T.StructField("airplane_skey", I),
    T.StructField("transactionid", S), T.StructField("distance", I),
    T.StructField("distancegroup", S), T.StructField("depdelay", I),
    T.StructField("depdelaygt15", T.ShortType()), T.StructField("nextdayarr", T.ShortType()),
])

VW_FLIGHTS_COLUMNS = (
    "transactionid", "distancegroup", "depdelaygt15", "nextdayarr",
    "airlinename", "origairportname", "destairportname",
)

# ---------------------------------------------------------------------------
# Dimension specs: the three SCD2 dimensions differ in key, hash and offset.
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class DimSpec:
    name: str                      # table name
    skey: str                      # surrogate key column
    keys: tuple[str, ...]          # natural key
    attrs: tuple[str, ...]         # tracked attributes
    hash_style: str                # "concat_ws_dash" | "underscore_prefix"
    expire_offset_days: int        # expiry date = as_of - offset
    schema: T.StructType

    @property
    def stage_columns(self) -> tuple[str, ...]:
        return tuple(f.name for f in self.schema.fields[1:-3])


AIRPLANE = DimSpec(
    name="dim_airplane", skey="airplane_skey", keys=("tailnum",),
    attrs=("airlinecode", "airlinename"), hash_style="concat_ws_dash",
    expire_offset_days=1, schema=DIM_AIRPLANE,
)
AIRPORT = DimSpec(
    name="dim_airport", skey="airport_skey", keys=("airportcode",),
    attrs=("airportname", "cityname"), hash_style="underscore_prefix",
    expire_offset_days=0, schema=DIM_AIRPORT,
)
AIR_ROUTE = DimSpec(
    name="dim_air_route", skey="air_route_skey",
    keys=("flightnum", "originairportcode", "destairportcode", "distance"),
    attrs=("crsdeptime", "crsarrtime"), hash_style="underscore_prefix",
    expire_offset_days=1, schema=DIM_AIR_ROUTE,
)
DIMS = {d.name: d for d in (AIRPLANE, AIRPORT, AIR_ROUTE)}

# Every warehouse table and its schema (used by the table store).
TABLES: dict[str, T.StructType] = {
    "flights_dlt": FLIGHTS,
    "stg_airplane_dlt": STG_AIRPLANE,
    "stg_airport_dlt": STG_AIRPORT,
    "stg_air_route_dlt": STG_AIR_ROUTE,
    "dim_airplane": DIM_AIRPLANE,
    "dim_airport": DIM_AIRPORT,
    "dim_air_route": DIM_AIR_ROUTE,
    "fact_flights": FACT_FLIGHTS,
}
