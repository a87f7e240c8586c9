"""Trips, zones, file listings and file events derived from the star-schema test tables.

Every rule, duplicates, missing values and unmatched zones occur in the derived trips. Each frame
covers its whole tables, so its size follows theirs.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripstrata.operators.standardize import standardize
from tripstrata.schemas import SERVICES, TRIP_FIELDS
from tripstrata.sources.layers import evenly_by_partition
from tripstrata.sources.trip_files import enrich

# Fixed inputs: the times of a trip, then its raw columns.
_PICKUP = "CASE WHEN l_partkey % 97 <> 0 THEN timestampadd(MINUTE, l_partkey % 2880, ordered_at) END"
_DROPOFF = (
    "CASE WHEN l_partkey % 89 <> 0 THEN timestampadd(MINUTE, l_partkey % 2880"
    " + datediff(l_shipdate, o_orderdate), ordered_at) END"
)

_RAW_TRIP = {
    "VendorID": "nullif(l_suppkey % 3, 0)",
    "tpep_pickup_datetime": "CASE WHEN service_type = 'yellow' THEN pickup END",
    "tpep_dropoff_datetime": "CASE WHEN service_type = 'yellow' THEN dropoff END",
    "lpep_pickup_datetime": "CASE WHEN service_type = 'green' THEN pickup END",
    "lpep_dropoff_datetime": "CASE WHEN service_type = 'green' THEN dropoff END",
    "passenger_count": "CAST(nullif(l_linenumber, 7) AS DOUBLE)",
    "trip_distance": "CASE WHEN l_partkey % 83 <> 0 THEN l_quantity * 8 - 20 END",
    "RatecodeID": "CAST(l_linenumber AS DOUBLE)",
    "store_and_fwd_flag": "l_linestatus",
    "PULocationID": "nullif(l_partkey % 28, 13)",
    "DOLocationID": "nullif(l_partkey % 31, 30)",
    "payment_type": "CAST(nullif(l_partkey % 7, 6) AS DOUBLE)",
    "fare_amount": "l_extendedprice + copy",
    "extra": "l_discount",
    "mta_tax": "l_tax",
    "tip_amount": "l_quantity",
    "tolls_amount": "l_tax",
    "improvement_surcharge": "l_discount",
    "total_amount": (
        "CASE WHEN l_partkey % 79 <> 0 THEN CAST(floor(l_extendedprice / 100) - 20 AS DOUBLE) END"
    ),
    "congestion_surcharge": "l_quantity",
    "Airport_fee": "CASE WHEN service_type = 'yellow' THEN l_tax END",
}

# What the raw columns are computed from.
_LINE = (
    "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linestatus",
    "l_shipdate", "o_orderdate",
)

# The text is the same in both engines, so that both validate the same messages.
EVENT_PAYLOAD = """
CASE WHEN event_id % 20 = 18 THEN '[{"event_type": "new_raw_file"}]'
     WHEN event_id % 20 = 19 THEN 'not json'
     ELSE concat(
       '{"event_type": "', CASE WHEN event_id % 20 = 12 THEN 'deleted_file' ELSE 'new_raw_file' END,
       '", "service_type": "', CASE WHEN event_id % 20 = 11 THEN 'fhv'
                                    WHEN user_id % 2 = 0 THEN 'yellow' ELSE 'green' END, '"',
       CASE WHEN event_id % 20 = 16 THEN '' WHEN event_id % 20 = 6 THEN ', "year": "2025"'
            WHEN event_id % 20 = 9 THEN ', "year": 1999' WHEN event_id % 20 = 10 THEN ', "year": 2101'
            ELSE ', "year": 2025' END,
       ', "month": ', CASE WHEN event_id % 20 = 7 THEN '0' WHEN event_id % 20 = 8 THEN '13'
                           WHEN event_id % 20 = 17 THEN '"abc"'
                           ELSE CAST(1 + user_id % 12 AS STRING) END,
       CASE WHEN event_id % 20 = 13 THEN '' WHEN event_id % 20 = 14 THEN ', "file_path": ""'
            WHEN event_id % 20 = 15 THEN ', "file_path": null'
            ELSE concat(', "file_path": "incoming/', CAST(event_id AS STRING), '.parquet"') END,
       '}')
END
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _joined(spark: SparkSession, sf_dir: str, years_later: int) -> DataFrame:
    """Lines with their orders, `service_type`, and the `source_file_name` they belong to."""
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    period = F.substring(F.add_months("o_orderdate", 12 * years_later).cast("string"), 1, 7)
    service = F.when(F.col("l_returnflag") == "R", "green").otherwise("yellow")
    return (
        lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"])
        .withColumns({"service_type": service, "ordered_at": F.col("o_orderdate").cast("timestamp")})
        .withColumn("source_file_name", F.concat("service_type", F.lit("_tripdata_"), period, F.lit(".parquet")))
    )


def raw_trips(spark: SparkSession, sf_dir: str, years_later: int = 0) -> DataFrame:
    """Raw trips of both services in one frame, with `service_type` and `source_file_name`.

    `years_later` moves the months in the file names (events are accepted from 2000 on). The second copies of some trips come from exploding an array, so the join runs once.
    """
    # The times are part of the exploded struct: computed once per trip, not once per rule.
    one, two = [
        F.struct(
            F.lit(copy).alias("copy"),
            F.expr(_PICKUP).alias("pickup"),
            F.expr(_DROPOFF).alias("dropoff"),
        )
        for copy in (0, 1)
    ]
    copies = F.when(F.col("l_orderkey") % 50 == 0, F.array(one, two)).otherwise(F.array(one))
    trips = _joined(spark, sf_dir, years_later).select("*", F.inline(copies))
    return trips.select(
        "service_type",
        *[F.expr(text).alias(column) for column, text in _RAW_TRIP.items()],
        "source_file_name",
    )


def grouped_lines(spark: SparkSession, sf_dir: str, years_later: int = 0) -> DataFrame:
    """What raw trips are made of, a row per trip, grouped by `source_file_name`.

    These rows have about half the bytes of raw trips, and what is written from them needs no further shuffle.
    """
    copies = F.when(F.col("l_orderkey") % 50 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    lines = _joined(spark, sf_dir, years_later).select("service_type", "source_file_name", *_LINE, F.explode(copies).alias("copy"))
    return evenly_by_partition(lines, ("source_file_name",))


@contextlib.contextmanager
def lines_by_file(spark: SparkSession, sf_dir: str, years_later: int = 0) -> Iterator[DataFrame]:
    """`grouped_lines` in the order of their files, on the executors' disks until the block ends.

    Queries that write many sets of trips join and shuffle once. For one set a service that costs more than it saves.
    """
    grouped = grouped_lines(spark, sf_dir, years_later).sortWithinPartitions("source_file_name")
    kept = grouped.persist(StorageLevel.DISK_ONLY)
    try:
        yield kept
    finally:
        kept.unpersist()


def trips_of(lines: DataFrame) -> DataFrame:
    """The rows of `raw_trips` from `grouped_lines`."""
    times = lines.withColumn("ordered_at", F.col("o_orderdate").cast("timestamp"))
    times = times.withColumns({"pickup": F.expr(_PICKUP), "dropoff": F.expr(_DROPOFF)})
    columns = [F.expr(text).alias(column) for column, text in _RAW_TRIP.items()]
    return times.select("service_type", *columns, "source_file_name")


def service_trips_of(lines: DataFrame, service: str) -> DataFrame:
    """The rows of `raw_service_trips` from `grouped_lines`."""
    return _of_service(trips_of(lines), service)


def bronze_trips_of(lines: DataFrame) -> DataFrame:
    """The rows of `bronze_trips` from `grouped_lines`."""
    return enrich(trips_of(lines), F.col("service_type"), 1900, 1)


def _of_service(trips: DataFrame, service: str) -> DataFrame:
    columns = [field.source[service] for field in TRIP_FIELDS if service in field.source]
    return trips.filter(F.col("service_type") == service).select(*columns, "source_file_name")


def raw_service_trips(
    spark: SparkSession, sf_dir: str, service: str, years_later: int = 0
) -> DataFrame:
    """One service's raw trips with that service's own columns."""
    return _of_service(raw_trips(spark, sf_dir, years_later), service)


def bronze_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trips with the lineage columns; every file name carries its period."""
    return enrich(raw_trips(spark, sf_dir), F.col("service_type"), 1900, 1)


def standard_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Standardized, unfiltered trips of all services, in one pass."""
    return standardize(bronze_trips(spark, sf_dir), SERVICES)


def raw_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The zone lookup as text: ids without a match and an "Unknown" borough occur."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).select(
        F.col("n_nationkey").cast("string").alias("LocationID"),
        F.when(F.col("n_nationkey") == 24, "Unknown").otherwise(F.col("r_name")).alias("Borough"),
        F.col("n_name").alias("Zone"),
        F.lit("Boro Zone").alias("service_zone"),
    )


def listed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`path` of one file per order, good and bad names, and `published` for earlier ones."""
    order = F.col("o_orderkey")
    period = F.date_format("o_orderdate", "yyyy-MM")
    kind = order % 8
    name = (
        F.when(kind <= 2, F.concat(F.lit("yellow_tripdata_"), period, F.lit(".parquet")))
        .when(kind <= 4, F.concat(F.lit("green_tripdata_"), period, F.lit(".parquet")))
        .when(kind == 5, F.concat(F.lit("fhv_tripdata_"), period, F.lit(".parquet")))
        .when(kind == 6, F.concat(F.lit("x_"), period, F.lit("_copy.parquet")))
        .when(order % 16 == 7, F.lit("junk.parquet"))
        .otherwise(F.concat(F.lit("green_tripdata_"), F.year("o_orderdate"), F.lit("-13.parquet")))
    )
    folder = F.concat(F.lit("/landing/"), order.cast("string"), F.lit("/"))
    return table(spark, sf_dir, "orders").select(
        F.concat(folder, name).alias("path"), (F.col("o_orderstatus") == "F").alias("published")
    )


def event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_id, payload): one JSON message per event row, valid and broken ones."""
    return table(spark, sf_dir, "events").select("event_id", F.expr(EVENT_PAYLOAD).alias("payload"))


def land_files(trips: DataFrame, folder: str) -> None:
    """Write raw trips, grouped by file (`grouped_lines`), as monthly files under `folder`, each a folder of part files."""
    trips.write.mode("append").partitionBy("source_file_name").parquet(folder)


def land_zones(spark: SparkSession, sf_dir: str, path: str) -> None:
    raw_zones(spark, sf_dir).write.mode("overwrite").option("header", True).csv(path)


