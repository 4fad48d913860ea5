"""Fact build: flights looked up against the route and airplane dimensions.

The lookups join on natural keys against *every* version of a dimension (the
warehouse's semantics), so a flight yields one fact row per matching route
version x airplane version. ``as_of`` restricts both lookups to the versions
valid on the load date instead (one version per key in a clean dimension).

Only the columns each side needs enter the joins. Dimensions are orders of
magnitude smaller than the flights, so AQE turns these into broadcast hash
joins when the runtime size is under the threshold; above it, sort-merge with
AQE skew splitting of hot keys on the flights side.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightmart.functions import dep_delay_gt15, distance_group, next_day_arrival
from flightmart.operators.scd2 import current_as_of
from flightmart.schemas import AIR_ROUTE, AIRPLANE, FACT_FLIGHTS


def _versions(dim: DataFrame, as_of: dt.date | None) -> DataFrame:
    return dim if as_of is None else current_as_of(dim, as_of)


def route_lookup(flights: DataFrame, dim_route: DataFrame, as_of: dt.date | None = None,
                 extra: tuple[str, ...] = ()) -> DataFrame:
    """Left join flights -> route versions on flight number, origin, destination, distance."""
    r = _versions(dim_route, as_of).select(AIR_ROUTE.skey, *AIR_ROUTE.keys, *extra)
    return flights.join(r, on=list(AIR_ROUTE.keys), how="left")


def airplane_lookup(flights: DataFrame, dim_airplane: DataFrame, as_of: dt.date | None = None,
                    extra: tuple[str, ...] = ()) -> DataFrame:
    """Left join flights -> airplane versions on tail number."""
    a = _versions(dim_airplane, as_of).select(AIRPLANE.skey, *AIRPLANE.keys, *extra)
    return flights.join(a, on=list(AIRPLANE.keys), how="left")


def measures(df: DataFrame, fixed_next_day: bool = False) -> DataFrame:
    return df.withColumns({
        "distancegroup": distance_group(F.col("distance")),
        "depdelaygt15": dep_delay_gt15(F.col("depdelay")),
        "nextdayarr": next_day_arrival(F.col("deptime"), F.col("arrtime"), F.col("actualelapsedtime"),
                                       fixed=fixed_next_day),
    })


def build_fact(flights: DataFrame, dim_route: DataFrame, dim_airplane: DataFrame,
               as_of: dt.date | None = None, fixed_next_day: bool = False) -> DataFrame:
    """FACT_FLIGHTS rows for one load (8 columns, warehouse order)."""
    f = flights.select(
        "transactionid", "tailnum", *AIR_ROUTE.keys, "depdelay", "deptime", "arrtime", "actualelapsedtime")
    f = measures(f, fixed_next_day)
    f = route_lookup(f, dim_route, as_of)
    f = airplane_lookup(f, dim_airplane, as_of)
    return f.select(*[F.col(c.name).cast(c.dataType).alias(c.name) for c in FACT_FLIGHTS.fields])
