"""The two gold tables, both derived from one rollup of the trips.

The rollup is the only aggregate that sees trips. Its groups number months x services x zones x
payment types, so partial aggregation shrinks the data before the shuffle whatever the skew, and
the zone join happens after it on a few thousand rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripstrata.operators.zones import attach_zones
from tripstrata.schemas import PAYMENT_METRICS_SCHEMA, ZONE_METRICS_SCHEMA

_GROUP = ("pickup_year", "pickup_month", "service_type")
_AVERAGED = {"revenue": "total_amount", "distance": "trip_distance", "duration": "trip_duration_minutes"}


def trip_rollup(trips: DataFrame) -> DataFrame:
    """Additive sums and counts by month, service, pickup zone and payment type."""
    sums = [F.sum(source).alias(f"{name}_sum") for name, source in _AVERAGED.items()]
    counts = [F.count(source).alias(f"{name}_rows") for name, source in _AVERAGED.items()]
    return trips.groupBy(*_GROUP, "pu_location_id", "payment_type").agg(
        F.count(F.lit(1)).alias("trips"),
        *sums,
        *counts,
        F.sum(F.coalesce("passenger_count", F.lit(0))).alias("passengers"),
    )


def _average(name: str) -> Column:
    return F.try_divide(F.sum(f"{name}_sum").cast("double"), F.sum(f"{name}_rows"))


def monthly_zone_metrics(rollup: DataFrame, zones: DataFrame) -> DataFrame:
    """Trips, revenue, averages and passengers by month, service and pickup zone."""
    by_location = rollup.groupBy(*_GROUP, "pu_location_id").agg(
        F.sum("trips").alias("trip_count"),
        F.sum("revenue_sum").alias("total_revenue"),
        _average("revenue").alias("avg_trip_revenue"),
        _average("distance").alias("avg_trip_distance"),
        _average("duration").alias("avg_trip_duration_minutes"),
        F.sum("passengers").alias("total_passengers"),
    )
    return attach_zones(by_location, zones).select(*ZONE_METRICS_SCHEMA.names)


def payment_type_metrics(rollup: DataFrame) -> DataFrame:
    """Trips and revenue by month, service and payment type; a missing type is its own group."""
    return (
        rollup.groupBy(*_GROUP, "payment_type")
        .agg(
            F.sum("trips").alias("trip_count"),
            F.sum("revenue_sum").alias("total_revenue"),
            _average("revenue").alias("avg_trip_revenue"),
        )
        .select(*PAYMENT_METRICS_SCHEMA.names)
    )
