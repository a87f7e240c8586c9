"""The layer tables on storage: layout, pruned reads and partition overwrites."""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripstrata.schemas import (
    BRONZE_SCHEMA,
    MONTH_COLUMNS,
    PARTITION_COLUMNS,
    PAYMENT_METRICS_SCHEMA,
    REJECTED_SCHEMA,
    ROLLUP_SCHEMA,
    SILVER_SCHEMA,
    ZONE_LOOKUP_SCHEMA,
    ZONE_METRICS_SCHEMA,
)

Partition = tuple[str, int, int]


@dataclass(frozen=True)
class Layers:
    """Paths of all tables under one root; the lookup lies apart from the bronze trips."""

    root: str

    def path(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    @property
    def bronze_trips(self) -> str:
        return self.path("bronze", "trips")

    @property
    def bronze_zones(self) -> str:
        return self.path("bronze", "zone_lookup")

    @property
    def silver_trips(self) -> str:
        return self.path("silver", "trips")

    @property
    def rejected_trips(self) -> str:
        return self.path("quality", "rejected_trips")

    @property
    def file_catalog(self) -> str:
        return self.path("quality", "file_catalog")

    @property
    def partition_measures(self) -> str:
        return self.path("quality", "partition_measures")

    @property
    def accepted_events(self) -> str:
        return self.path("quality", "accepted_events")

    @property
    def rejected_events(self) -> str:
        return self.path("quality", "rejected_events")

    @property
    def published_files(self) -> str:
        return self.path("quality", "published_files")

    @property
    def trip_rollup(self) -> str:
        return self.path("gold", "trip_rollup")

    @property
    def zone_metrics(self) -> str:
        return self.path("gold", "monthly_zone_metrics")

    @property
    def payment_metrics(self) -> str:
        return self.path("gold", "payment_type_metrics")

    @property
    def rejected_files(self) -> str:
        return self.path("quality", "rejected_files")

    @property
    def failed_files(self) -> str:
        return self.path("quality", "failed_files")

    @property
    def quality_metrics(self) -> str:
        return self.path("quality", "data_product_quality_metrics")

    @property
    def validation_report(self) -> str:
        return self.path("quality", "validation_report")


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table by its fixed schema: no footer is read to infer one, and `_metadata` stays usable."""
    return spark.read.schema(schema).parquet(path)


def read_bronze(spark: SparkSession, layers: Layers) -> DataFrame:
    return _read(spark, layers.bronze_trips, BRONZE_SCHEMA)


def read_zones(spark: SparkSession, layers: Layers) -> DataFrame:
    return _read(spark, layers.bronze_zones, ZONE_LOOKUP_SCHEMA)


def read_silver(spark: SparkSession, layers: Layers) -> DataFrame:
    return _read(spark, layers.silver_trips, SILVER_SCHEMA)


def read_rejected_trips(spark: SparkSession, layers: Layers) -> DataFrame:
    return _read(spark, layers.rejected_trips, REJECTED_SCHEMA)


def read_rollup(spark: SparkSession, layers: Layers) -> DataFrame:
    return _read(spark, layers.trip_rollup, ROLLUP_SCHEMA)


def read_zone_metrics(spark: SparkSession, layers: Layers) -> DataFrame:
    return _read(spark, layers.zone_metrics, ZONE_METRICS_SCHEMA)


def read_payment_metrics(spark: SparkSession, layers: Layers) -> DataFrame:
    return _read(spark, layers.payment_metrics, PAYMENT_METRICS_SCHEMA)


def one_of(keys: Iterable[str], values: Iterable[tuple]) -> Column:
    """True for rows whose partition columns `keys` equal one of `values`.

    It reads partition columns only, so Spark prunes folders with it.
    """
    wanted = ["/".join(str(part) for part in value) for value in values]
    return F.concat_ws("/", *[F.col(key).cast("string") for key in keys]).isin(wanted)


@dataclass(frozen=True)
class Written:
    """What a write did: row count and the partitions that received rows."""

    row_count: int
    partitions: frozenset[tuple]


def overwrite_partitions(df: DataFrame, path: str, keys: tuple[str, ...]) -> Written:
    """Replace the partitions present in `df`, leave all others, in one write.

    Row count and partitions come from the write itself, not from a second run of the plan.
    """
    seen = Observation()
    observed = df.observe(
        seen,
        F.count(F.lit(1)).alias("row_count"),
        F.collect_set(F.struct(*keys)).alias("partitions"),
    )
    (
        observed.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*keys)
        .parquet(path)
    )
    result = seen.get
    return Written(
        result.get("row_count", 0), frozenset(tuple(p) for p in result.get("partitions", []))
    )


def clear_partitions(
    spark: SparkSession, path: str, keys: tuple[str, ...], schema: T.StructType, values: Iterable[tuple]
) -> None:
    """Leave the given partitions empty: a dynamic overwrite never touches one without new rows."""
    columns = T.StructType([field for field in schema.fields if field.name not in keys])
    empty = spark.createDataFrame([], columns).coalesce(1)

    def clear(value: tuple) -> None:
        folder = "/".join(f"{key}={part}" for key, part in zip(keys, value))
        empty.write.mode("overwrite").parquet(f"{path}/{folder}")

    with ThreadPoolExecutor(max_workers=16) as pool:  # small jobs without rows, one a partition
        list(pool.map(clear, sorted(values)))


def replace_trip_partitions(
    df: DataFrame, path: str, schema: T.StructType, touched: Iterable[Partition]
) -> Written:
    """Make the touched trip partitions hold exactly the rows of `df`, empty ones included."""
    written = overwrite_partitions(df, path, PARTITION_COLUMNS)
    emptied = set(touched) - written.partitions
    clear_partitions(df.sparkSession, path, PARTITION_COLUMNS, schema, emptied)
    return written


def evenly_by_partition(df: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Group rows by table partition for the write, so each writes few, well-sized files.

    Unlike a plain repartition, `rebalance` lets Spark split a partition that holds most of the
    rows over many tasks.
    """
    return df.hint("rebalance", *keys)


def stored_partitions(spark: SparkSession, path: str, keys: tuple[str, ...], schema: T.StructType) -> DataFrame:
    """Distinct partition values of a table that have rows; no data column is read. A table that is not there has none."""
    try:
        return _read(spark, path, schema).select(*keys).distinct()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema).select(*keys)


def months_of(partitions: Iterable[Partition]) -> list[tuple[int, int]]:
    """Sorted distinct (year, month) over all services."""
    return sorted({(year, month) for _, year, month in partitions})
