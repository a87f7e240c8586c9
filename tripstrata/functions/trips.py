"""Derived trip columns: file period, duration and record hash."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The period in a file name, and the names accepted in the incoming folder.
PERIOD_PATTERN = r"\d{4}-\d{2}"
INCOMING_NAME_PATTERN = r"^(yellow|green)_tripdata_(\d{4})-(\d{2})\.parquet$"

# What the record hash covers, in order, and how it is joined.
HASH_SEPARATOR = "||"
HASH_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
HASH_TIME_COLUMNS = ("pickup_datetime", "dropoff_datetime")
HASH_VALUE_COLUMNS = (
    "passenger_count",
    "trip_distance",
    "rate_code_id",
    "pu_location_id",
    "do_location_id",
    "payment_type",
    "total_amount",
)


def file_period(file_name: Column, default_year: int, default_month: int) -> tuple[Column, Column]:
    """(year, month) of the first `YYYY-MM` in the name, or the defaults if there is none."""
    period = F.regexp_extract(file_name, PERIOD_PATTERN, 0)
    year = F.substring(period, 1, 4).try_cast("int")
    month = F.substring(period, 6, 2).try_cast("int")
    return F.coalesce(year, F.lit(default_year)), F.coalesce(month, F.lit(default_month))


def trip_duration_minutes() -> Column:
    """Whole minutes from pickup to dropoff, truncated towards zero."""
    minutes = F.expr("(unix_timestamp(dropoff_datetime) - unix_timestamp(pickup_datetime)) div 60")
    return minutes.try_cast("int")


def record_hash() -> Column:
    """SHA-256 over the trip's identifying values.

    `concat_ws` skips NULL, so a missing vendor or time leaves no slot while the other missing
    values leave an empty one.
    """
    times = [F.date_format(F.col(name), HASH_TIME_FORMAT) for name in HASH_TIME_COLUMNS]
    values = [F.coalesce(F.col(name).cast("string"), F.lit("")) for name in HASH_VALUE_COLUMNS]
    parts = [F.col("service_type"), F.col("vendor_id").cast("string"), *times, *values]
    return F.sha2(F.concat_ws(HASH_SEPARATOR, *parts), 256)
