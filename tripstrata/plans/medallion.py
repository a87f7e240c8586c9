"""The batch run: raw files to bronze, silver, gold and validation.

Each step is one Spark write over all touched partitions. The driver sees only file names,
touched (service, year, month) lists and one-row measures.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass
from datetime import UTC, datetime
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripstrata.operators.dedup import deduplicate
from tripstrata.operators.metrics import monthly_zone_metrics, payment_type_metrics, trip_rollup
from tripstrata.operators.quality import critical_checks, data_freshness, metric_records, quality_metrics
from tripstrata.operators.rules import VIOLATIONS, failed_rules, is_compliant, keep_compliant
from tripstrata.operators.standardize import standardize
from tripstrata.operators.zones import zone_lookup
from tripstrata.plans.measures import store_measures, totals_of
from tripstrata.schemas import (
    BRONZE_SCHEMA,
    MONTH_COLUMNS,
    PARTITION_COLUMNS,
    PRODUCT_REPORT_SCHEMA,
    REJECTED_SCHEMA,
    REPORT_SCHEMA,
    ROLLUP_SCHEMA,
    SILVER_SCHEMA,
)
from tripstrata.sources import catalog, trip_files
from tripstrata.sources import layers as tables
from tripstrata.sources.layers import Layers, Partition
from tripstrata.sources.scope import Scope, in_scope, out_of_scope


#: Files of a month that may stay as many. More are dealt out anew, since they may be small.
FEW_FILES = 16


class DataQualityError(ValueError):
    """A critical check failed; the report has been written."""


@dataclass(frozen=True)
class BronzeResult:
    processed_files: int
    skipped_files: int
    touched_partitions: list[Partition]


@dataclass(frozen=True)
class SilverResult:
    row_count: int
    touched_months: list[tuple[int, int]]


@dataclass(frozen=True)
class GoldResult:
    zone_rows: int
    payment_rows: int

    @property
    def row_count(self) -> int:
        return self.zone_rows + self.payment_rows


def silver_from_standard(standard: DataFrame) -> DataFrame:
    """Rules and de-duplication on standardized trips; filters run before the shuffle."""
    return deduplicate(keep_compliant(standard)).select(*SILVER_SCHEMA.names)


def write_zone_lookup(raw_zones: DataFrame, layers: Layers) -> None:
    raw_zones.write.mode("overwrite").parquet(layers.bronze_zones)


def write_bronze(trips: DataFrame, layers: Layers, touched: Iterable[Partition]) -> tables.Written:
    return tables.replace_trip_partitions(trips, layers.bronze_trips, BRONZE_SCHEMA, touched)


def store_monthly_files(
    spark: SparkSession,
    files: Iterable[tuple[str, int, int, str]],
    layers: Layers,
    default_year: int,
    default_month: int,
    known: trip_files.Schemas | None = None,
) -> list[Partition]:
    """Replace the bronze months that the files, given as (service, year, month, path), belong to.

    A task that reads whole files, or large pieces, writes as few of them: trips are grouped by month for the write only
    where some month has many files.
    """
    files = list(files)
    by_partition = Counter((service, year, month) for service, year, month, _ in files)
    touched = sorted(by_partition)
    if files:
        found = [(service, path) for service, _, _, path in files]
        trips = trip_files.scan_trips(spark, found, default_year, default_month, known)
        if max(by_partition.values()) > FEW_FILES:
            trips = tables.evenly_by_partition(trips, PARTITION_COLUMNS)
        write_bronze(trips, layers, touched)
    return touched


def build_bronze(
    spark: SparkSession, files: DataFrame, scope: Scope, layers: Layers
) -> BronzeResult:
    """Store the monthly files of the scope; `files` is a listing. Only files in scope are opened, and only the
    footers of those that the catalogue lacks."""
    year, month = scope.years[0], scope.months[0]
    listed = trip_files.monthly_files(files, year, month)
    grid = scope.grid(spark)
    parts = in_scope(trip_files.monthly_parts(files, year, month), grid)
    known = catalog.file_schemas(spark, files.join(parts.select("path"), "path", "left_semi"), layers.file_catalog)
    chosen = [
        (row.service_type, row.pickup_year, row.pickup_month, row.path)
        for row in parts.collect()
    ]
    processed = in_scope(listed, grid).count()
    skipped = out_of_scope(listed, grid).count()
    touched = store_monthly_files(spark, chosen, layers, year, month, known)
    return BronzeResult(processed, skipped, touched)


def standard_trips(spark: SparkSession, layers: Layers, touched: list[Partition]) -> DataFrame:
    """The touched bronze partitions in the silver schema, unfiltered."""
    bronze = tables.read_bronze(spark, layers)
    return reduce(
        DataFrame.unionByName,
        [
            standardize(
                bronze.filter(F.col("service_type") == service).filter(
                    tables.one_of(MONTH_COLUMNS, tables.months_of(p for p in touched if p[0] == service))
                ),
                [service],
            )
            for service in sorted({service for service, _, _ in touched})
        ],
    )


def build_rejects(spark: SparkSession, layers: Layers, touched: list[Partition]) -> int:
    """Rebuild the touched partitions of the rejected trips, each with the rules it fails; returns their number.

    They lie in the partitions that bronze has, whose files are few, so each task writes what it reads.
    """
    if not touched:
        return 0
    rejects = standard_trips(spark, layers, touched).filter(~is_compliant()).withColumn("failed_rules", failed_rules())
    rows = rejects.select(*REJECTED_SCHEMA.names)
    return tables.replace_trip_partitions(rows, layers.rejected_trips, REJECTED_SCHEMA, touched).row_count


def build_silver(spark: SparkSession, layers: Layers, touched: list[Partition]) -> SilverResult:
    """Rebuild the touched silver partitions from bronze.

    Each service reads only its own folders, so rule filters on its columns reach the parquet scan.
    A touched partition whose rows all fail the rules is left empty.
    """
    if not touched:
        return SilverResult(0, [])
    standard = standard_trips(spark, layers, touched)
    silver = tables.evenly_by_partition(silver_from_standard(standard), PARTITION_COLUMNS)
    written = tables.replace_trip_partitions(silver, layers.silver_trips, SILVER_SCHEMA, touched)
    return SilverResult(written.row_count, tables.months_of(touched))


def write_gold(table: DataFrame, path: str) -> tables.Written:
    """Replace the months in a gold table. A month has at most zones x services rows, so one task
    per month is safe, and the default parallelism spreads the months' files over the tasks."""
    tasks = table.sparkSession.sparkContext.defaultParallelism
    by_month = table.repartition(tasks, *MONTH_COLUMNS)
    return tables.overwrite_partitions(by_month, path, MONTH_COLUMNS)


def rollups_to_build(spark: SparkSession, layers: Layers, months: list[tuple[int, int]], touched: Iterable[Partition]) -> list[Partition]:
    """The touched partitions, and partitions of the months that have silver rows but no stored rollup."""
    of_months = tables.one_of(MONTH_COLUMNS, months)
    have = tables.stored_partitions(spark, layers.trip_rollup, PARTITION_COLUMNS, ROLLUP_SCHEMA)
    silver = tables.stored_partitions(spark, layers.silver_trips, PARTITION_COLUMNS, SILVER_SCHEMA)
    lacking = silver.filter(of_months).join(have, list(PARTITION_COLUMNS), "left_anti")
    return sorted({tuple(row) for row in lacking.select(*PARTITION_COLUMNS).collect()} | set(touched))


def rollup_of(spark: SparkSession, layers: Layers, partitions: list[Partition]) -> DataFrame:
    """The rollup of silver partitions; only they are read."""
    trips = tables.read_silver(spark, layers).filter(tables.one_of(PARTITION_COLUMNS, partitions))
    return trip_rollup(trips).select(*ROLLUP_SCHEMA.names)


def build_gold(
    spark: SparkSession, layers: Layers, months: list[tuple[int, int]], touched: Iterable[Partition] | None = None
) -> GoldResult:
    """Rebuild both gold tables for whole months, all services together.

    Both tables derive from an additive rollup that is stored per service and month. Only the rollups of `touched`
    (default: all partitions of the months) are made from trips; those of the other services are read as stored.
    A month without silver rows keeps its earlier gold rows.
    """
    if not months:
        return GoldResult(0, 0)
    if touched is None:
        there = tables.stored_partitions(spark, layers.silver_trips, PARTITION_COLUMNS, SILVER_SCHEMA)
        kept = tables.stored_partitions(spark, layers.trip_rollup, PARTITION_COLUMNS, ROLLUP_SCHEMA)
        both = there.union(kept).filter(tables.one_of(MONTH_COLUMNS, months)).distinct()
        touched = [tuple(row) for row in both.select(*PARTITION_COLUMNS).collect()]
    rebuilt = rollups_to_build(spark, layers, months, touched)
    rows = tables.evenly_by_partition(rollup_of(spark, layers, rebuilt), PARTITION_COLUMNS)
    tables.replace_trip_partitions(rows, layers.trip_rollup, ROLLUP_SCHEMA, rebuilt)
    zones = zone_lookup(tables.read_zones(spark, layers))
    rollup = tables.read_rollup(spark, layers).filter(tables.one_of(MONTH_COLUMNS, months))
    by_zone = write_gold(monthly_zone_metrics(rollup, zones), layers.zone_metrics)
    by_payment = write_gold(payment_type_metrics(rollup), layers.payment_metrics)
    return GoldResult(by_zone.row_count, by_payment.row_count)


def _write_report(report: DataFrame, path: str) -> None:
    """One row as one JSON document."""
    report.coalesce(1).write.mode("overwrite").json(path)


def validate(spark: SparkSession, layers: Layers, touched: Iterable[Partition] | None = None) -> dict:
    """Check all stored layers, write metrics and report, then raise if a critical check failed.

    The measures of each partition are stored. Given the `touched` (service, year, month), only they are measured
    again, and the checks still cover everything: the stored measures of the rest are summed. Without it all
    partitions are measured, which is needed after a table was changed by other means.
    """
    store_measures(spark, layers, touched)
    rows, silver, gold = totals_of(spark, layers)
    product_files = trip_files.list_files(spark, layers.zone_metrics).unionByName(
        trip_files.list_files(spark, layers.validation_report, names="part-*")
    )
    metrics = metric_records(quality_metrics(silver, gold, data_freshness(product_files))).collect()
    checks = {row.check_name: row.passed for row in critical_checks(silver, gold).collect()}
    on_silver, on_gold = silver.first(), gold.first()
    described = [row.asDict(recursive=True) for row in metrics]
    report = {
        "generated_at_utc": datetime.now(UTC).isoformat(),
        "row_counts": {
            "bronze_rows": rows["bronze"],
            "bronze_zone_rows": tables.read_zones(spark, layers).count(),
            "gold_payment_rows": rows["gold_payments"],
            "silver_rows": rows["silver"],
            "gold_monthly_rows": rows["gold_zones"],
        },
        "silver_rule_violations": {name: on_silver[name] for name in VIOLATIONS},
        "gold_unmatched_zone_rows": on_gold.unmatched_zone_rows,
        "critical_checks": checks,
        "data_product_quality_metrics": described,
        "data_product_quality_metrics_path": layers.quality_metrics,
    }
    product = {
        "generated_at_utc": report["generated_at_utc"],
        "primary_data_product": "gold.monthly_zone_metrics",
        "supporting_dataset": ["gold.payment_type_metrics"],
        "metrics": described,
    }
    _write_report(spark.createDataFrame([product], PRODUCT_REPORT_SCHEMA), layers.quality_metrics)
    _write_report(spark.createDataFrame([report], REPORT_SCHEMA), layers.validation_report)
    if not all(checks.values()):
        raise DataQualityError(f"Critical checks failed; see {layers.validation_report}")
    return report


def read_report(spark: SparkSession, layers: Layers) -> DataFrame:
    """The stored validation report under its fixed schema: one row. Stops when no report has been written."""
    return _read_json(spark, layers.validation_report, REPORT_SCHEMA)


def read_product_report(spark: SparkSession, layers: Layers) -> DataFrame:
    """The stored metrics of the data product under their fixed schema: one row."""
    return _read_json(spark, layers.quality_metrics, PRODUCT_REPORT_SCHEMA)


def _read_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    try:
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        raise FileNotFoundError(f"No report at {path}; run the validation first") from error


def run_batch(
    spark: SparkSession, raw_roots: list[str], zone_csv: str, layers: Layers, scope: Scope
) -> dict:
    """Raw folders to validated gold for one scope. Returns what each step did."""
    files = trip_files.list_files(spark, *raw_roots)
    listed = trip_files.monthly_files(files, scope.years[0], scope.months[0])
    trip_files.require_input_files(spark, listed, scope, zone_csv)
    bronze = build_bronze(spark, files, scope, layers)
    write_zone_lookup(trip_files.read_zone_lookup(spark, zone_csv), layers)
    silver = build_silver(spark, layers, bronze.touched_partitions)
    build_rejects(spark, layers, bronze.touched_partitions)
    gold = build_gold(spark, layers, silver.touched_months, bronze.touched_partitions)
    validation = validate(spark, layers, bronze.touched_partitions)
    return {"bronze": bronze, "silver": silver, "gold": gold, "validation": validation}
