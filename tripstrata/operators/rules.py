"""The silver quality rules, read as a filter, as reject reasons and as violation counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The ordered keep rules. A row stays when every predicate is true.
KEEP_RULES = {
    "pickup_missing": "pickup_datetime IS NOT NULL",
    "dropoff_missing": "dropoff_datetime IS NOT NULL",
    "pickup_after_dropoff": "pickup_datetime <= dropoff_datetime",
    "distance_missing": "trip_distance IS NOT NULL",
    "distance_negative": "trip_distance >= 0",
    "distance_over_cap": "trip_distance <= 300",
    "amount_missing": "total_amount IS NOT NULL",
    "amount_not_positive": "total_amount > 0",
    "amount_over_cap": "total_amount <= 1000",
    "pickup_location_missing": "pu_location_id IS NOT NULL",
    "dropoff_location_missing": "do_location_id IS NOT NULL",
    "duration_out_of_range": "trip_duration_minutes BETWEEN 1 AND 720",
}

_ALL_RULES = " AND ".join(f"({rule})" for rule in KEEP_RULES.values())

# The violations counted on a silver table. A NULL comparison is no violation.
VIOLATIONS = {
    "null_pickup_or_dropoff": "pickup_datetime IS NULL OR dropoff_datetime IS NULL",
    "pickup_after_dropoff": "pickup_datetime > dropoff_datetime",
    "negative_trip_distance": "trip_distance < 0",
    "invalid_total_amount": "total_amount <= 0",
    "null_location_ids": "pu_location_id IS NULL OR do_location_id IS NULL",
    "invalid_duration_range": "NOT (trip_duration_minutes BETWEEN 1 AND 720)",
    "distance_over_cap": "trip_distance > 300",
    "amount_over_cap": "total_amount > 1000",
}


def keep_compliant(trips: DataFrame) -> DataFrame:
    """Rows that pass every rule, as one conjunction that Spark splits and pushes to the scan."""
    return trips.filter(_ALL_RULES)


def is_compliant() -> Column:
    """All rules as one boolean that is never NULL."""
    return F.coalesce(F.expr(_ALL_RULES), F.lit(False))


def _fails(rule: str) -> Column:
    return ~F.coalesce(F.expr(rule), F.lit(False))


def failed_rules() -> Column:
    """Names of the rules a row fails, in rule order; an empty array for a compliant row."""
    flags = [F.when(_fails(rule), F.lit(name)) for name, rule in KEEP_RULES.items()]
    return F.array_compact(F.array(*flags))


def reject_summary(trips: DataFrame) -> DataFrame:
    """Rows per service and combination of failed rules, named with commas between.

    Rows are grouped by one bit per rule; the names are spelled out on the few groups.
    """
    bits = [
        F.when(_fails(rule), F.lit(1 << bit)).otherwise(0)
        for bit, rule in enumerate(KEEP_RULES.values())
    ]
    failed = reduce(lambda a, b: a.bitwiseOR(b), bits)
    names = [
        F.when(F.col("failed").bitwiseAND(1 << bit) != 0, name)
        for bit, name in enumerate(KEEP_RULES)
    ]
    return (
        trips.groupBy("service_type", failed.alias("failed"))
        .agg(F.count(F.lit(1)).alias("row_count"))
        .select("service_type", F.concat_ws(",", *names).alias("failed_rules"), "row_count")
    )


def violation_counts() -> list[Column]:
    """One count per violation, for a single-pass aggregate."""
    return [F.count_if(F.expr(test)).alias(name) for name, test in VIOLATIONS.items()]
