"""Reports a consumer runs on the gold tables and the silver trips."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tripstrata.operators.quality import percent
from tripstrata.operators.zones import attach_zones
from tripstrata.schemas import SERVICES

_MONTH = ("pickup_year", "pickup_month")


def _top(df: DataFrame, keys: Sequence[str], source: str, total: str, rows: int) -> DataFrame:
    ranked = [F.col(total).desc(), *[F.col(key).asc() for key in keys]]
    return df.groupBy(*keys).agg(F.sum(source).alias(total)).orderBy(*ranked).limit(rows)


def top_zones_by_revenue(zone_metrics: DataFrame, rows: int = 5) -> DataFrame:
    return _top(zone_metrics, ["zone"], "total_revenue", "zone_revenue", rows)


def top_month_zones_by_revenue(zone_metrics: DataFrame, rows: int = 10) -> DataFrame:
    return _top(zone_metrics, [*_MONTH, "zone"], "total_revenue", "total_revenue", rows)


def top_zones_by_trips(zone_metrics: DataFrame, rows: int = 10) -> DataFrame:
    return _top(zone_metrics, [*_MONTH, "zone"], "trip_count", "trip_count", rows)


def payment_type_share(payment_metrics: DataFrame) -> DataFrame:
    """Share of each payment type among the trips of its month and service."""
    all_types = F.sum("trip_count").over(Window.partitionBy(*_MONTH, "service_type"))
    return payment_metrics.select(
        *_MONTH,
        "service_type",
        "payment_type",
        "trip_count",
        F.round(F.col("trip_count") / all_types, 6).alias("trip_share"),
    )


def monthly_trip_trend(zone_metrics: DataFrame) -> DataFrame:
    """Trips per month and service with the change from the month before in the data."""
    earlier = Window.partitionBy("service_type").orderBy(*_MONTH)
    months = zone_metrics.groupBy("service_type", *_MONTH).agg(
        F.sum("trip_count").alias("trip_count")
    )
    return months.withColumn(
        "change", F.col("trip_count") - F.lag("trip_count").over(earlier)
    )


def service_by_borough(zone_metrics: DataFrame) -> DataFrame:
    """Trips and revenue of each service side by side, per borough."""
    return (
        zone_metrics.groupBy("borough")
        .pivot("service_type", sorted(SERVICES))
        .agg(F.sum("trip_count").alias("trips"), F.sum("total_revenue").alias("revenue"))
    )


def hourly_demand(trips: DataFrame) -> DataFrame:
    """Trips and revenue by service and hour of pickup."""
    return trips.groupBy("service_type", F.hour("pickup_datetime").alias("pickup_hour")).agg(
        F.count(F.lit(1)).alias("trip_count"), F.sum("total_amount").alias("total_revenue")
    )


def unmatched_trip_percent(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Share of trips whose pickup zone is unknown; trips are counted before the join."""
    by_location = trips.groupBy("pu_location_id").agg(F.count(F.lit(1)).alias("trips"))
    unknown = F.when(F.col("zone") == "Unknown", F.col("trips")).otherwise(0)
    return (
        attach_zones(by_location, zones)
        .agg(
            F.coalesce(F.sum("trips"), F.lit(0)).alias("total_trips"),
            F.coalesce(F.sum(unknown), F.lit(0)).alias("unmatched_trips"),
        )
        .withColumn("unmatched_pct", percent("unmatched_trips", "total_trips"))
    )


def contract_check(dataset: str, df: DataFrame, contract: T.StructType) -> DataFrame:
    """One row per promised column: promised and actual type, filled and total rows, and `ok`.

    A column is fine when it exists with the promised type and the table has rows.
    """
    actual = {field.name: field.dataType.simpleString() for field in df.schema.fields}

    def filled(name: str) -> Column:
        return F.count(name) if name in actual else F.lit(0).cast("bigint")

    measured = df.agg(
        F.count(F.lit(1)).alias("total_rows"), *[filled(n).alias(f"in_{n}") for n in contract.names]
    )
    entries = [
        F.struct(
            F.lit(field.name).alias("column_name"),
            F.lit(field.dataType.simpleString()).alias("expected_type"),
            F.lit(actual.get(field.name)).cast("string").alias("actual_type"),
            F.col(f"in_{field.name}").alias("filled_rows"),
        )
        for field in contract.fields
    ]
    same_type = F.coalesce(F.col("expected_type") == F.col("actual_type"), F.lit(False))
    return (
        measured.select("total_rows", F.inline(F.array(*entries)))
        .withColumn("ok", same_type & (F.col("total_rows") > 0))
        .select(F.lit(dataset).alias("dataset"), "*")
    )


def contract_checks(tables: dict[str, tuple[DataFrame, T.StructType]]) -> DataFrame:
    checks = [contract_check(name, df, contract) for name, (df, contract) in tables.items()]
    return reduce(DataFrame.unionByName, checks)
