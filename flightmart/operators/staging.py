"""Stage tables: the distinct dimension rows a load carries.

Each is one ``distinct``: a partial HashAggregate on the map side, so only the
distinct values of each task cross the shuffle. Airports come from both ends
of a flight; one scan feeds both through ``inline`` of a two-element array
instead of scanning the flights twice for the UNION.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightmart.schemas import STG_AIR_ROUTE, STG_AIRPLANE


def stage_airplane(flights: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    return flights.select(*by, *STG_AIRPLANE.fieldNames()).distinct()


def stage_airport(flights: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    ends = F.array(
        F.struct(F.col("originairportcode").alias("airportcode"),
                 F.col("origairportname").alias("airportname"),
                 F.col("origincityname").alias("cityname")),
        F.struct(F.col("destairportcode").alias("airportcode"),
                 F.col("destairportname").alias("airportname"),
                 F.col("destcityname").alias("cityname")),
    )
    return flights.select(*by, F.inline(ends)).distinct()


def stage_air_route(flights: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    return flights.select(*by, *STG_AIR_ROUTE.fieldNames()).distinct()


STAGERS = {
    "dim_airplane": stage_airplane,
    "dim_airport": stage_airport,
    "dim_air_route": stage_air_route,
}
