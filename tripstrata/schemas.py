"""Services, source columns, layer schemas and the published contract."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

SERVICES = ("yellow", "green")

PARTITION_COLUMNS = ("service_type", "pickup_year", "pickup_month")
MONTH_COLUMNS = ("pickup_year", "pickup_month")


_TYPES = {
    "int": IntegerType(),
    "bigint": LongType(),
    "double": DoubleType(),
    "string": StringType(),
    "timestamp": TimestampType(),
}


def _struct(columns: str) -> StructType:
    """A schema from "name type, ..." text; unlike the DDL parser it needs no session."""
    schema = StructType()
    for column in columns.split(","):
        name, kind = column.split()
        schema.add(name, _TYPES[kind])
    return schema


@dataclass(frozen=True)
class TripField:
    """A silver column and where each service's raw file keeps it (no entry: the service lacks it)."""

    name: str
    kind: str
    raw_kind: str
    source: dict[str, str]
    required: bool = False


def _same(column: str) -> dict[str, str]:
    return {service: column for service in SERVICES}


# Silver name, silver type, raw type in bronze, raw column per service, needed by a rule.
TRIP_FIELDS = (
    TripField("vendor_id", "int", "bigint", _same("VendorID")),
    TripField(
        "pickup_datetime", "timestamp", "timestamp",
        {"yellow": "tpep_pickup_datetime", "green": "lpep_pickup_datetime"}, required=True,
    ),
    TripField(
        "dropoff_datetime", "timestamp", "timestamp",
        {"yellow": "tpep_dropoff_datetime", "green": "lpep_dropoff_datetime"}, required=True,
    ),
    TripField("passenger_count", "int", "double", _same("passenger_count")),
    TripField("trip_distance", "double", "double", _same("trip_distance"), required=True),
    TripField("rate_code_id", "int", "double", _same("RatecodeID")),
    TripField("store_and_fwd_flag", "string", "string", _same("store_and_fwd_flag")),
    TripField("pu_location_id", "int", "bigint", _same("PULocationID"), required=True),
    TripField("do_location_id", "int", "bigint", _same("DOLocationID"), required=True),
    TripField("payment_type", "int", "double", _same("payment_type")),
    TripField("fare_amount", "double", "double", _same("fare_amount")),
    TripField("extra", "double", "double", _same("extra")),
    TripField("mta_tax", "double", "double", _same("mta_tax")),
    TripField("tip_amount", "double", "double", _same("tip_amount")),
    TripField("tolls_amount", "double", "double", _same("tolls_amount")),
    TripField("improvement_surcharge", "double", "double", _same("improvement_surcharge")),
    TripField("total_amount", "double", "double", _same("total_amount"), required=True),
    TripField("congestion_surcharge", "double", "double", _same("congestion_surcharge")),
    TripField("airport_fee", "double", "double", {"yellow": "Airport_fee"}),
)

# Raw column -> type it has in bronze, over all services.
RAW_TYPES = {column: field.raw_kind for field in TRIP_FIELDS for column in field.source.values()}

# Columns a bronze read needs: every known raw column and the lineage columns.
BRONZE_SCHEMA = _struct(
    ", ".join(f"{column} {kind}" for column, kind in RAW_TYPES.items())
    + ", source_file_name string, ingested_at_utc timestamp"
    + ", service_type string, pickup_year int, pickup_month int"
)

SILVER_SCHEMA = _struct(
    "service_type string, "
    + ", ".join(f"{field.name} {field.kind}" for field in TRIP_FIELDS)
    + ", source_file_name string, pickup_year int, pickup_month int, trip_duration_minutes int"
)

REJECTED_SCHEMA = StructType([*SILVER_SCHEMA.fields, StructField("failed_rules", ArrayType(StringType()))])

ZONE_LOOKUP_SCHEMA = _struct(
    "LocationID string, Borough string, Zone string, service_zone string"
)

ZONE_METRICS_SCHEMA = _struct(
    "pickup_year int, pickup_month int, service_type string, pu_location_id int, borough string, "
    "zone string, trip_count bigint, total_revenue double, avg_trip_revenue double, "
    "avg_trip_distance double, avg_trip_duration_minutes double, total_passengers bigint"
)

ZONE_GRAIN = (*MONTH_COLUMNS, "service_type", "pu_location_id")

PAYMENT_METRICS_SCHEMA = _struct(
    "pickup_year int, pickup_month int, service_type string, payment_type int, "
    "trip_count bigint, total_revenue double, avg_trip_revenue double"
)

# The additive rollup behind both gold tables.
ROLLUP_SCHEMA = _struct(
    "pu_location_id int, payment_type int, trips bigint, revenue_sum double, distance_sum double, duration_sum bigint, "
    "revenue_rows bigint, distance_rows bigint, duration_rows bigint, passengers bigint, "
    "service_type string, pickup_year int, pickup_month int"
)

FILE_EVENT_SCHEMA = _struct(
    "event_type string, service_type string, year int, month int, file_path string"
)

# The stored reports: counts and checks by name, and one record per metric with details where it has any.
_COUNTS = MapType(StringType(), LongType())
METRIC_RECORD = StructType(
    [
        StructField("metric_name", StringType()),
        StructField("metric_definition", StringType()),
        StructField("current_value", DoubleType()),
        StructField("expected_threshold", StringType()),
        StructField("update_cadence", StringType()),
        StructField("unit", StringType()),
        StructField("meets_threshold", BooleanType()),
        StructField("details", StructType([StructField("violations", _COUNTS)])),
    ]
)
REPORT_SCHEMA = StructType(
    [
        StructField("generated_at_utc", StringType()),
        StructField("row_counts", _COUNTS),
        StructField("silver_rule_violations", _COUNTS),
        StructField("gold_unmatched_zone_rows", LongType()),
        StructField("critical_checks", MapType(StringType(), BooleanType())),
        StructField("data_product_quality_metrics", ArrayType(METRIC_RECORD)),
        StructField("data_product_quality_metrics_path", StringType()),
    ]
)
PRODUCT_REPORT_SCHEMA = StructType(
    [
        StructField("generated_at_utc", StringType()),
        StructField("primary_data_product", StringType()),
        StructField("supporting_dataset", ArrayType(StringType())),
        StructField("metrics", ArrayType(METRIC_RECORD)),
    ]
)
