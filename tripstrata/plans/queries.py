"""The registered queries: one per operator, each over whole tables (or data derived from them).

A query is called with (spark, folder of the parquet tables) and returns a DataFrame.
"""

from __future__ import annotations

import contextlib
import functools
from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripstrata.functions.trips import record_hash
from tripstrata.operators import dedup, metrics, product, quality, rules
from tripstrata.operators.standardize import standardize
from tripstrata.operators.zones import zone_lookup
from tripstrata.plans.contract import contract_violations
from tripstrata.plans.medallion import (
    build_bronze,
    build_gold,
    build_rejects,
    build_silver,
    read_product_report,
    read_report,
    silver_from_standard,
    validate,
    write_bronze,
    write_gold,
    write_zone_lookup,
)
from tripstrata.schemas import (
    MONTH_COLUMNS,
    PARTITION_COLUMNS,
    PAYMENT_METRICS_SCHEMA,
    SERVICES,
    ZONE_GRAIN,
    ZONE_METRICS_SCHEMA,
)
from tripstrata.sources import catalog, star_trips, trip_files
from tripstrata.sources import layers as tables
from tripstrata.sources.layers import Layers
from tripstrata.sources.scope import (
    Scope,
    in_scope,
    out_of_scope,
    scope_grid,
    services_without_files,
)
from tripstrata.sources.workdir import set_file_times, work_dir
from tripstrata.streaming import arrivals, events, payloads
from tripstrata.streaming.arrivals import start_arrivals, take_arrivals

Query = Callable[[SparkSession, str], DataFrame]

RUN_SCOPE = Scope.of(SERVICES, range(1995, 2001), range(1, 13))
# The tables start in 1995; the stream accepts files from 2000 on.
STREAM_YEARS_LATER = 10
SCAN_SCOPE = Scope.of(SERVICES, [1995, 1996, 1997], range(1, 7))


# Derived inputs -------------------------------------------------------------------------------


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_from_standard(star_trips.standard_trips(spark, sf_dir))


def _trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """De-duplicated trips with the columns rules and gold need."""
    return dedup.distinct_trips(rules.keep_compliant(star_trips.standard_trips(spark, sf_dir)))


def _zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zone_lookup(star_trips.raw_zones(spark, sf_dir))


def _zone_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rollup = metrics.trip_rollup(_trips(spark, sf_dir))
    return metrics.monthly_zone_metrics(rollup, _zones(spark, sf_dir))


def _payment_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.payment_type_metrics(metrics.trip_rollup(_trips(spark, sf_dir)))


# Projections, rules and de-duplication --------------------------------------------------------


def trip_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        star_trips.standard_trips(spark, sf_dir)
        .groupBy("service_type", "trip_duration_minutes")
        .agg(F.count(F.lit(1)).alias("trips"))
    )


def record_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        star_trips.standard_trips(spark, sf_dir)
        .groupBy(*PARTITION_COLUMNS, record_hash().alias("record_hash"))
        .agg(F.count(F.lit(1)).alias("copies"))
    )


def standardize_yellow(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = star_trips.raw_service_trips(spark, sf_dir, "yellow")
    return standardize(trip_files.with_period(raw, 1900, 1), ["yellow"])


def standardize_green(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = star_trips.raw_service_trips(spark, sf_dir, "green")
    return standardize(trip_files.with_period(raw, 1900, 1), ["green"])


def bronze_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star_trips.bronze_trips(spark, sf_dir).drop("ingested_at_utc")


def silver_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver(spark, sf_dir)


def silver_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = rules.keep_compliant(star_trips.standard_trips(spark, sf_dir))
    return dedup.duplicate_summary(kept)


def reject_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.reject_summary(star_trips.standard_trips(spark, sf_dir))


# Gold -----------------------------------------------------------------------------------------


def gold_monthly_zone_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _zone_metrics(spark, sf_dir)


def gold_payment_type_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _payment_metrics(spark, sf_dir)


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _zones(spark, sf_dir)


def unmatched_trip_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return product.unmatched_trip_percent(_trips(spark, sf_dir), _zones(spark, sf_dir))


# Scope, listings and events -------------------------------------------------------------------


def data_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scope covering all bronze trips; the three sets stay small whatever the row count."""
    lists = star_trips.bronze_trips(spark, sf_dir).agg(
        F.collect_set("service_type").alias("services"),
        F.collect_set("pickup_year").alias("years"),
        F.collect_set("pickup_month").alias("months"),
    )
    return scope_grid(lists)


def filename_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = star_trips.listed_files(spark, sf_dir)
    named = files.select("path", events.file_name_of(F.col("path")).alias("source_file_name"))
    return trip_files.with_period(named, RUN_SCOPE.years[0], RUN_SCOPE.months[0])


def bronze_scan_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files and rows the scan takes and skips, per service."""
    per_file = (
        star_trips.bronze_trips(spark, sf_dir)
        .groupBy(*PARTITION_COLUMNS, "source_file_name")
        .agg(F.count(F.lit(1)).alias("row_count"))
    )
    grid = SCAN_SCOPE.grid(spark)
    scanned = in_scope(per_file, grid).withColumn("scanned", F.lit(True))
    skipped = out_of_scope(per_file, grid).withColumn("scanned", F.lit(False))
    return (
        scanned.unionByName(skipped)
        .groupBy("service_type", "scanned")
        .agg(F.count(F.lit(1)).alias("file_count"), F.sum("row_count").alias("row_count"))
    )


def touched_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = star_trips.bronze_trips(spark, sf_dir).select(*PARTITION_COLUMNS).distinct()
    return found.orderBy(*PARTITION_COLUMNS)


def touched_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = star_trips.bronze_trips(spark, sf_dir).select(*MONTH_COLUMNS).distinct()
    return found.orderBy(*MONTH_COLUMNS)


def missing_input_services(spark: SparkSession, sf_dir: str) -> DataFrame:
    requested = spark.sql("SELECT explode(array('fhv', 'green', 'yellow')) AS service_type")
    files = events.classify_files(star_trips.listed_files(spark, sf_dir))
    return services_without_files(requested, files.filter("reject_reason IS NULL"))


def incoming_files_classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.classify_files(star_trips.listed_files(spark, sf_dir))


def new_files_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = star_trips.listed_files(spark, sf_dir)
    return events.unpublished(files, files.filter("published")).select("path")


def event_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.parse_events(star_trips.event_messages(spark, sf_dir)).drop("payload")


# Quality --------------------------------------------------------------------------------------


def silver_rule_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """On the unfiltered trips, where there is something to count."""
    return quality.rule_violations(star_trips.standard_trips(spark, sf_dir))


def silver_rule_compliance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.rule_compliance(star_trips.standard_trips(spark, sf_dir))


def zone_mapping_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.zone_completeness(_zone_metrics(spark, sf_dir))


def gold_unmatched_zone_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.gold_measures(_zone_metrics(spark, sf_dir)).select("unmatched_zone_rows")


def layer_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = _trips(spark, sf_dir)
    rollup = metrics.trip_rollup(trips)
    return quality.layer_row_counts(
        {
            "bronze_rows": star_trips.bronze_trips(spark, sf_dir),
            "bronze_zone_rows": star_trips.raw_zones(spark, sf_dir),
            "silver_rows": trips,
            "gold_monthly_rows": metrics.monthly_zone_metrics(rollup, _zones(spark, sf_dir)),
            "gold_payment_rows": metrics.payment_type_metrics(rollup),
        }
    )


def _measures(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The one-row measures of silver and of gold; both read the same shuffled trips."""
    trips = _trips(spark, sf_dir)
    by_zone = metrics.monthly_zone_metrics(metrics.trip_rollup(trips), _zones(spark, sf_dir))
    return quality.silver_measures(trips), quality.gold_measures(by_zone)


def quality_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without freshness, which depends on the clock; violations as JSON text."""
    found = quality.quality_metrics(*_measures(spark, sf_dir))
    return found.withColumn("violations", F.to_json("violations"))


def quality_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_status(quality.quality_metrics(*_measures(spark, sf_dir)))


def quality_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_overall(quality.quality_metrics(*_measures(spark, sf_dir)))


def critical_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.critical_checks(*_measures(spark, sf_dir))


def data_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours from the newest order or event, taken for files of the gold table and the report, to a given instant."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_orderkey").cast("string").alias("path"), F.col("o_orderdate").cast("timestamp").alias("modified"))
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("event_id").cast("string").alias("path"), F.col("ts").cast("timestamp").alias("modified"))
    return quality.data_freshness(orders.unionByName(events), F.lit("2030-01-01 00:00:00").cast("timestamp"))


# Product --------------------------------------------------------------------------------------


def top5_zones_by_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return product.top_zones_by_revenue(_zone_metrics(spark, sf_dir))


def top10_month_zones_by_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return product.top_month_zones_by_revenue(_zone_metrics(spark, sf_dir))


def top_zones_by_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return product.top_zones_by_trips(_zone_metrics(spark, sf_dir))


def payment_type_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return product.payment_type_share(_payment_metrics(spark, sf_dir))


def monthly_trip_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return product.monthly_trip_trend(_zone_metrics(spark, sf_dir))


def service_by_borough(spark: SparkSession, sf_dir: str) -> DataFrame:
    return product.service_by_borough(_zone_metrics(spark, sf_dir))


def hourly_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return product.hourly_demand(_trips(spark, sf_dir))


def contract_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    rollup = metrics.trip_rollup(_trips(spark, sf_dir))
    by_zone = metrics.monthly_zone_metrics(rollup, _zones(spark, sf_dir))
    return product.contract_checks(
        {
            "monthly_zone_metrics": (by_zone, ZONE_METRICS_SCHEMA),
            "payment_type_metrics": (metrics.payment_type_metrics(rollup), PAYMENT_METRICS_SCHEMA),
        }
    )


# Sinks and runs over files --------------------------------------------------------------------


def _partition_counts(df: DataFrame) -> DataFrame:
    return df.groupBy(*PARTITION_COLUMNS).agg(F.count(F.lit(1)).alias("row_count"))


def bronze_overwrite_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All months written, then those of one year again with other amounts: these are replaced, the rest stays."""
    layers = Layers(work_dir(spark, "bronze"))
    with star_trips.lines_by_file(spark, sf_dir) as lines:
        bronze = star_trips.bronze_trips_of(lines)
        write_bronze(bronze, layers, [])
        changed = bronze.filter("pickup_year = 1997 AND PULocationID % 2 = 0").withColumn("total_amount", F.lit(0.25))
        write_bronze(changed, layers, [])
    return tables.read_bronze(spark, layers).groupBy(*PARTITION_COLUMNS).agg(
        F.count(F.lit(1)).alias("row_count"), F.count_if(F.col("total_amount") == 0.25).alias("changed_rows")
    )


def _stored_layers(spark: SparkSession, sf_dir: str, lines: DataFrame, label: str) -> Layers:
    """Bronze, silver and gold tables built from the derived trips in a fresh folder."""
    layers = Layers(work_dir(spark, label))
    written = write_bronze(star_trips.bronze_trips_of(lines), layers, [])
    write_zone_lookup(star_trips.raw_zones(spark, sf_dir), layers)
    silver = build_silver(spark, layers, sorted(written.partitions))
    build_gold(spark, layers, silver.touched_months)
    return layers


def _after_bad_january(spark: SparkSession, sf_dir: str, lines: DataFrame, label: str) -> Layers:
    """Built layers, then every January arrives again with only unacceptable amounts."""
    layers = _stored_layers(spark, sf_dir, lines, label)
    bad = star_trips.bronze_trips_of(lines).filter("pickup_month = 1")
    written = write_bronze(bad.withColumn("total_amount", F.lit(-1.0)), layers, [])
    silver = build_silver(spark, layers, sorted(written.partitions))
    build_gold(spark, layers, silver.touched_months)
    return layers


def silver_overwrite_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partitions whose rows all fail are emptied, others stay."""
    with star_trips.lines_by_file(spark, sf_dir) as lines:
        layers = _after_bad_january(spark, sf_dir, lines, "silver")
    return _partition_counts(tables.read_silver(spark, layers))


def rejected_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected trips as stored, counted by partition and failed rules; January arrives twice and counts once."""
    layers = Layers(work_dir(spark, "rejects"))
    with star_trips.lines_by_file(spark, sf_dir) as lines:
        touched = sorted(write_bronze(star_trips.bronze_trips_of(lines), layers, []).partitions)
    build_rejects(spark, layers, touched)
    build_rejects(spark, layers, [partition for partition in touched if partition[2] == 1])
    reasons = F.concat_ws(",", "failed_rules").alias("failed_rules")
    return (
        tables.read_rejected_trips(spark, layers)
        .groupBy(*PARTITION_COLUMNS, reasons)
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


def gold_overwrite_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months without silver rows keep their earlier gold rows; a month that arrives with other rows is replaced."""
    with star_trips.lines_by_file(spark, sf_dir) as lines:
        layers = _after_bad_january(spark, sf_dir, lines, "gold")
        fewer = star_trips.bronze_trips_of(lines).filter("pickup_month = 2 AND PULocationID % 2 = 0")
        written = write_bronze(fewer, layers, [])
    silver = build_silver(spark, layers, sorted(written.partitions))
    build_gold(spark, layers, silver.touched_months)
    return tables.read_zone_metrics(spark, layers)


def _land_services(lines: DataFrame, folder: str) -> None:
    for service in SERVICES:
        star_trips.land_files(star_trips.service_trips_of(lines, service), f"{folder}/{service}")


def _landed(spark: SparkSession, sf_dir: str, label: str, years_later: int = 0) -> str:
    """Monthly files of both services and the zone CSV in a fresh folder."""
    root = work_dir(spark, label)
    _land_services(star_trips.grouped_lines(spark, sf_dir, years_later), f"{root}/raw")
    star_trips.land_zones(spark, sf_dir, f"{root}/taxi_zone_lookup.csv")
    return root


def run_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a batch run over landed files reports; the last year is out of its scope."""
    root = _landed(spark, sf_dir, "run")
    layers = Layers(f"{root}/layers")
    bronze = build_bronze(spark, trip_files.list_files(spark, f"{root}/raw"), RUN_SCOPE, layers)
    write_zone_lookup(trip_files.read_zone_lookup(spark, f"{root}/taxi_zone_lookup.csv"), layers)
    silver = build_silver(spark, layers, bronze.touched_partitions)
    gold = build_gold(spark, layers, silver.touched_months)
    stats = {
        "processed_files": bronze.processed_files,
        "skipped_files": bronze.skipped_files,
        "touched_partitions": len(bronze.touched_partitions),
        "touched_months": len(silver.touched_months),
        "silver_rows": silver.row_count,
        "gold_rows": gold.row_count,
    }
    return spark.createDataFrame(list(stats.items()), "stat string, stat_value bigint")


def schema_drift_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly files whose schemas differ: types, letter case, missing and extra columns."""
    root = work_dir(spark, "drift")
    month = F.substring_index(F.substring_index("source_file_name", ".", 1), "-", -1).cast("int")
    with star_trips.lines_by_file(spark, sf_dir) as lines:
        for service in SERVICES:
            trips = star_trips.service_trips_of(lines, service)
            variants = [
                trips.withColumn("passenger_count", F.col("passenger_count").cast("bigint")),
                trips.withColumnRenamed("Airport_fee", "airport_fee"),
                trips.drop("congestion_surcharge"),
                trips.withColumn("cbd_congestion_fee", F.lit(0.75)),
            ]
            for position, variant in enumerate(variants):
                of_months = variant.filter(month % len(variants) == position)
                star_trips.land_files(of_months, f"{root}/raw/{service}")
    listed = trip_files.monthly_files(trip_files.list_files(spark, f"{root}/raw"), 1900, 1)
    files = [(row.service_type, row.path) for row in listed.collect()]
    bronze = trip_files.scan_trips(spark, files, 1900, 1)
    return (
        standardize(bronze, SERVICES)
        .groupBy(*PARTITION_COLUMNS)
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.sum("passenger_count").alias("passengers"),
            F.count("congestion_surcharge").alias("with_congestion"),
            F.count("airport_fee").alias("with_airport_fee"),
        )
    )


def _streamed(spark: SparkSession, sf_dir: str, label: str) -> Layers:
    """Layers built by the arrival stream from the landed files of both services: one file is in flight at a time, and
    each is moved to the archive."""
    root = _landed(spark, sf_dir, label, STREAM_YEARS_LATER)
    layers = Layers(f"{root}/layers")
    take_arrivals(spark, f"{root}/raw", f"{root}/taxi_zone_lookup.csv", layers, f"{root}/checkpoint", f"{root}/archive")
    return layers


def stream_ingest_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    layers = _streamed(spark, sf_dir, "stream-bronze")
    return (
        tables.read_bronze(spark, layers)
        .groupBy(*PARTITION_COLUMNS, "source_file_name")
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.sum("total_amount").alias("total_amount"),
        )
    )


def stream_medallion_equals_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold of a stream that takes all files in one micro-batch."""
    root = _landed(spark, sf_dir, "stream-gold", STREAM_YEARS_LATER)
    layers = Layers(f"{root}/layers")
    start_arrivals(
        spark, f"{root}/raw", f"{root}/taxi_zone_lookup.csv", layers, f"{root}/checkpoint"
    ).awaitTermination()
    return tables.read_zone_metrics(spark, layers)


def stream_idempotent_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yellow files, a restart with green files, and a restart with nothing new; files are archived."""
    root = work_dir(spark, "stream-replay")
    layers, lookup = Layers(f"{root}/layers"), f"{root}/taxi_zone_lookup.csv"
    star_trips.land_zones(spark, sf_dir, lookup)
    lines = star_trips.grouped_lines(spark, sf_dir, STREAM_YEARS_LATER)
    for service in (*reversed(SERVICES), None):
        if service is not None:
            star_trips.land_files(star_trips.service_trips_of(lines, service), f"{root}/incoming")
        start_arrivals(
            spark, f"{root}/incoming", lookup, layers, f"{root}/checkpoint", archive=f"{root}/archive"
        ).awaitTermination()
    return tables.read_payment_metrics(spark, layers)


def _corrected(trips: DataFrame) -> DataFrame:
    """The first month's amounts doubled, as a publisher's correction of its file."""
    return trips.filter("source_file_name LIKE '%-01.parquet'").withColumn("total_amount", F.col("total_amount") * 2)


def stream_redelivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """January files arrive again, corrected, under another path, while the first ones are archived."""
    root = work_dir(spark, "stream-redelivery")
    layers, lookup = Layers(f"{root}/layers"), f"{root}/taxi_zone_lookup.csv"
    star_trips.land_zones(spark, sf_dir, lookup)
    with star_trips.lines_by_file(spark, sf_dir, STREAM_YEARS_LATER) as lines:
        for place in ("first", "again"):
            for service in SERVICES:
                trips = star_trips.service_trips_of(lines, service)
                star_trips.land_files(trips if place == "first" else _corrected(trips), f"{root}/incoming/{place}")
            start_arrivals(
                spark, f"{root}/incoming", lookup, layers, f"{root}/checkpoint", archive=f"{root}/archive"
            ).awaitTermination()
    return tables.read_bronze(spark, layers).groupBy(*PARTITION_COLUMNS).agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("total_amount").alias("total_amount")
    )


def _announced(lines: DataFrame) -> DataFrame:
    """`payload`: an event for every monthly file that the trips make, with the path relative to the landing folder."""
    names = lines.select("service_type", "source_file_name").distinct()
    year, month = trip_files.file_period(F.col("source_file_name"), 2000, 1)
    event = F.struct(
        F.lit(events.NEW_FILE).alias("event_type"), "service_type", year.alias("year"), month.alias("month"),
        F.concat(F.lit("incoming/source_file_name="), "source_file_name").alias("file_path"),
    )
    return names.select(F.to_json(event).alias("payload"))


def stream_event_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages as text files, all sent twice and the query restarted between: each is taken once."""
    root = work_dir(spark, "payloads")
    layers = Layers(f"{root}/layers")
    messages = star_trips.event_messages(spark, sf_dir).select("payload")
    for round_ in ("first", "again"):
        messages.write.text(f"{root}/messages/{round_}")
        payloads.start_messages(spark, f"{root}/messages", layers, f"{root}/checkpoint").awaitTermination()
    nothing = F.lit(None).cast("string")
    accepted = payloads.read_accepted(spark, layers).drop("query", "batch").withColumns({"payload": nothing, "reject_reason": nothing})
    rejected = payloads.read_rejected(spark, layers).drop("query", "batch")
    return accepted.unionByName(rejected, allowMissingColumns=True)


def stream_missing_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events for every monthly file, of which January's are in neither folder, and odd months' were moved before."""
    root = work_dir(spark, "stream-missing")
    layers, lookup = Layers(f"{root}/layers"), f"{root}/taxi_zone_lookup.csv"
    star_trips.land_zones(spark, sf_dir, lookup)
    month = F.substring_index(F.substring_index("source_file_name", ".", 1), "-", -1).cast("int")
    with star_trips.lines_by_file(spark, sf_dir, STREAM_YEARS_LATER) as lines:
        for service in SERVICES:
            trips = star_trips.service_trips_of(lines, service).filter(month > 1)
            star_trips.land_files(trips.filter(month % 2 == 0), f"{root}/incoming")
            star_trips.land_files(trips.filter(month % 2 == 1), f"{root}/archive{arrivals.plain(root)}/incoming")
        _announced(lines).write.text(f"{root}/messages")
    build = payloads.month_builder(f"{root}/incoming", f"{root}/archive", lookup, layers, root)
    payloads.start_messages(spark, f"{root}/messages", layers, f"{root}/checkpoint", handle=build).awaitTermination()
    failed = spark.read.schema("path string, reason string").parquet(layers.failed_files)
    lost = failed.select(events.file_name_of(F.col("path")).alias("source_file_name"), F.col("reason").alias("outcome"), F.lit(0).cast("bigint").alias("row_count"))
    stored = tables.read_bronze(spark, layers).groupBy("source_file_name").agg(F.lit("handled").alias("outcome"), F.count(F.lit(1)).alias("row_count"))
    return lost.unionByName(stored)


def stream_file_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The green service's files published one a batch, the oldest first; half of them before a restart."""
    root = work_dir(spark, "stream-order")
    layers = Layers(f"{root}/layers")
    trips = star_trips.raw_service_trips(spark, sf_dir, "green", STREAM_YEARS_LATER)
    trips = trips.groupBy("source_file_name").agg(F.count(F.lit(1)).alias("trips"))
    year = F.substring_index(F.substring_index("source_file_name", "-", 1), "_", -1).cast("int")
    for half in (year < 2008, year >= 2008):
        star_trips.land_files(trips.filter(half).coalesce(1), f"{root}/incoming")
        set_file_times(spark, f"{root}/incoming", lambda path: 1_000 * int(path.split("_tripdata_")[1][:7].replace("-", "")))
        payloads.start_publisher(spark, f"{root}/incoming", layers, f"{root}/checkpoint").awaitTermination()
    payloads.start_publisher(spark, f"{root}/incoming", layers, f"{root}/checkpoint").awaitTermination()
    return payloads.read_published(spark, layers).select("file_name", "batch")


def stream_crash_recovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold of a stream whose batch fails between silver and gold, and is started again from its checkpoint."""
    root = _landed(spark, sf_dir, "stream-crash", STREAM_YEARS_LATER)
    layers = Layers(f"{root}/layers")
    arguments = (spark, f"{root}/raw", f"{root}/taxi_zone_lookup.csv", layers, f"{root}/checkpoint")

    def fail(layer: str) -> None:
        if layer == "silver":
            raise RuntimeError("stopped between silver and gold")

    with contextlib.suppress(StreamingQueryException):
        start_arrivals(*arguments, after=fail).awaitTermination()
    if not tables.stored_partitions(spark, layers.zone_metrics, MONTH_COLUMNS, ZONE_METRICS_SCHEMA).isEmpty():
        raise RuntimeError("the first run was to stop before gold")
    start_arrivals(*arguments).awaitTermination()
    return tables.read_zone_metrics(spark, layers)


def stream_three_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored report after three batches (all files, Januaries again with bad amounts, green Februaries corrected).

    Each batch measures its own partitions; the report is the one that measuring everything would give.
    """
    root = work_dir(spark, "stream-measures")
    layers, lookup = Layers(f"{root}/layers"), f"{root}/taxi_zone_lookup.csv"
    star_trips.land_zones(spark, sf_dir, lookup)
    with star_trips.lines_by_file(spark, sf_dir, STREAM_YEARS_LATER) as lines:
        _land_services(lines, f"{root}/raw")
        for k in range(3):
            if k == 1:
                for service in SERVICES:
                    trips = star_trips.service_trips_of(lines, service)
                    star_trips.land_files(trips.filter("source_file_name LIKE '%-01.parquet'").withColumn("total_amount", F.lit(-1.0)), f"{root}/raw/second")
            if k == 2:
                trips = star_trips.service_trips_of(lines, "green")
                star_trips.land_files(trips.filter("source_file_name LIKE '%-02.parquet' AND PULocationID % 2 = 0"), f"{root}/raw/third")
            start_arrivals(spark, f"{root}/raw", lookup, layers, f"{root}/checkpoint").awaitTermination()
    report = read_report(spark, layers)
    counts = report.select(F.explode("row_counts").alias("name", "counted"))
    violations = report.select(F.explode("silver_rule_violations").alias("name", "counted"))
    return counts.unionByName(violations).unionByName(report.select(F.lit("gold_unmatched_zone_rows").alias("name"), F.col("gold_unmatched_zone_rows").alias("counted")))


# Files and stored reports ---------------------------------------------------------------------


def file_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files whose footers each of three runs reads: all; none, as nothing changed; Januaries that came again."""
    root = work_dir(spark, "catalog")
    store, name = f"{root}/catalog", events.file_name_of(F.col("path")).alias("source_file_name")
    found = []
    with star_trips.lines_by_file(spark, sf_dir) as lines:
        _land_services(lines, f"{root}/raw")
        for run in (1, 2, 3):
            if run == 3:
                for service in SERVICES:
                    star_trips.land_files(_corrected(star_trips.service_trips_of(lines, service)), f"{root}/raw/again/{service}")
            read = catalog.update_catalog(spark, trip_files.list_files(spark, f"{root}/raw"), store)
            found.append(spark.createDataFrame([(run, path) for path in read], "run int, path string").select("run", name))
    entries = catalog.read_catalog(spark, store).select(F.lit(0).alias("run"), name)
    return entries.unionByName(functools.reduce(DataFrame.unionByName, found)).distinct()


def _dated_gold(spark: SparkSession, sf_dir: str, label: str) -> str:
    """The gold table by month in a fresh folder, its files dated to the first of their month."""
    path = f"{work_dir(spark, label)}/zone_metrics"
    write_gold(_zone_metrics(spark, sf_dir), path)

    def first_of_month(file: str) -> int:
        year, month = (int(file.split(f"{key}=")[1].split("/")[0]) for key in MONTH_COLUMNS)
        return int(datetime(year, month, 1, tzinfo=UTC).timestamp() * 1000)

    set_file_times(spark, path, first_of_month)
    return path


def product_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours from the newest file of a written gold table to a given instant: all of it, one year, and no files at all."""
    path = _dated_gold(spark, sf_dir, "freshness")
    now = F.lit("2030-01-01 00:00:00").cast("timestamp")
    parts = {"table": path, "1996": f"{path}/pickup_year=1996", "nothing": f"{path}/pickup_year=1066"}
    hours = [quality.data_freshness(trip_files.list_files(spark, folder, names="part-*"), now).select(F.lit(part).alias("part"), "*") for part, folder in parts.items()]
    return functools.reduce(DataFrame.unionByName, hours)


def stored_report_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status lines and overall status, read from the report that a validation wrote; without the value of freshness."""
    with star_trips.lines_by_file(spark, sf_dir) as lines:
        layers = _stored_layers(spark, sf_dir, lines, "report")
    validate(spark, layers)
    lines = quality.reported_status(read_product_report(spark, layers), "metrics")
    value = F.when(F.col("metric_title") != "Data Freshness Hours", F.col("value_text"))
    return lines.withColumn("value_text", value)


def stored_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored gold table of which one month has other types and one came twice."""
    path = f"{work_dir(spark, 'contract')}/zone_metrics"
    gold = _zone_metrics(spark, sf_dir).persist()
    try:
        write_gold(gold, path)
        drifted = gold.filter("pickup_year = 1996 AND pickup_month = 3").withColumn("trip_count", F.col("trip_count").cast("string"))
        write_gold(drifted.drop("total_revenue"), path)
        doubled = gold.filter("pickup_year = 1997 AND pickup_month = 5")
        doubled.coalesce(1).write.mode("append").partitionBy(*MONTH_COLUMNS).parquet(path)
    finally:
        gold.unpersist()
    return contract_violations(spark, path, ZONE_METRICS_SCHEMA, MONTH_COLUMNS, ZONE_GRAIN)


def gold_from_rollups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold after the yellow service's first halves of years came again with other amounts, green trips not read again."""
    with star_trips.lines_by_file(spark, sf_dir) as lines:
        layers = _stored_layers(spark, sf_dir, lines, "rollups")
        again = star_trips.bronze_trips_of(lines).filter("service_type = 'yellow' AND pickup_month <= 6")
        written = write_bronze(again.withColumn("total_amount", F.lit(7.5)), layers, [])
    silver = build_silver(spark, layers, sorted(written.partitions))
    build_gold(spark, layers, silver.touched_months, sorted(written.partitions))
    return tables.read_zone_metrics(spark, layers)


def stream_failed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """January files lack a column the rules need: they are recorded, and all other months are handled."""
    root = work_dir(spark, "stream-failed")
    layers, lookup = Layers(f"{root}/layers"), f"{root}/taxi_zone_lookup.csv"
    star_trips.land_zones(spark, sf_dir, lookup)
    with star_trips.lines_by_file(spark, sf_dir, STREAM_YEARS_LATER) as lines:
        for service in SERVICES:
            trips = star_trips.service_trips_of(lines, service)
            star_trips.land_files(trips.filter("source_file_name NOT LIKE '%-01.parquet'"), f"{root}/incoming")
            star_trips.land_files(trips.filter("source_file_name LIKE '%-01.parquet'").drop("trip_distance"), f"{root}/incoming")
    start_arrivals(spark, f"{root}/incoming", lookup, layers, f"{root}/checkpoint").awaitTermination()
    failed = spark.read.schema("path string, reason string").parquet(layers.failed_files)
    name = events.file_name_of(F.col("path")).alias("source_file_name")
    handled = tables.read_bronze(spark, layers).select("source_file_name", F.lit("handled").alias("outcome"))
    return failed.select(name, F.col("reason").alias("outcome")).unionByName(handled).distinct()


QUERIES: dict[str, Query] = {
    "trip_duration": trip_duration,
    "record_hash": record_hashes,
    "standardize_yellow": standardize_yellow,
    "standardize_green": standardize_green,
    "bronze_enriched": bronze_enriched,
    "silver_trips": silver_trips,
    "silver_dedup": silver_dedup,
    "reject_reasons": reject_reasons,
    "gold_monthly_zone_metrics": gold_monthly_zone_metrics,
    "gold_payment_type_metrics": gold_payment_type_metrics,
    "zone_lookup": zones,
    "unmatched_trip_pct": unmatched_trip_pct,
    "scope_grid": data_scope,
    "filename_period": filename_period,
    "bronze_scan_scope": bronze_scan_scope,
    "touched_partitions": touched_partitions,
    "touched_months": touched_months,
    "missing_input_services": missing_input_services,
    "incoming_files_classified": incoming_files_classified,
    "new_files_anti_join": new_files_anti_join,
    "event_validation": event_validation,
    "silver_rule_violations": silver_rule_violations,
    "silver_rule_compliance": silver_rule_compliance,
    "zone_mapping_completeness": zone_mapping_completeness,
    "gold_unmatched_zone_rows": gold_unmatched_zone_rows,
    "layer_row_counts": layer_row_counts,
    "quality_metrics": quality_metrics,
    "quality_status": quality_status,
    "quality_overall": quality_overall,
    "critical_checks": critical_checks,
    "data_freshness": data_freshness,
    "top5_zones_by_revenue": top5_zones_by_revenue,
    "top10_month_zones_by_revenue": top10_month_zones_by_revenue,
    "top_zones_by_trips": top_zones_by_trips,
    "payment_type_share": payment_type_share,
    "monthly_trip_trend": monthly_trip_trend,
    "service_by_borough": service_by_borough,
    "hourly_demand": hourly_demand,
    "contract_check": contract_check,
    "bronze_overwrite_partitions": bronze_overwrite_partitions,
    "silver_overwrite_partitions": silver_overwrite_partitions,
    "rejected_trips": rejected_trips,
    "gold_overwrite_months": gold_overwrite_months,
    "run_stats": run_stats,
    "schema_drift_union": schema_drift_union,
    "stream_ingest_bronze": stream_ingest_bronze,
    "stream_medallion_equals_batch": stream_medallion_equals_batch,
    "stream_idempotent_replay": stream_idempotent_replay,
    "stream_redelivery": stream_redelivery,
    "stream_failed_files": stream_failed_files,
    "stream_event_payloads": stream_event_payloads,
    "stream_missing_file": stream_missing_file,
    "stream_file_order": stream_file_order,
    "stream_crash_recovery": stream_crash_recovery,
    "stream_three_batches": stream_three_batches,
    "file_catalog": file_catalog,
    "product_freshness": product_freshness,
    "stored_report_status": stored_report_status,
    "stored_contract": stored_contract,
    "gold_from_rollups": gold_from_rollups,
}
