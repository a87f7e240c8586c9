"""Validation measures kept per partition, so that a batch reads what it changed and sums the rest.

Every measure of the report is a count over rows of one table, and every row lies in one partition. A stored row holds
the counts of one (layer, service, year, month); gold rows have the service `all`, as their tables have no service
folders. Totals over the stored rows are the counts over the whole tables.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripstrata.operators.quality import gold_columns, silver_columns
from tripstrata.operators.rules import VIOLATIONS
from tripstrata.schemas import MONTH_COLUMNS, PARTITION_COLUMNS
from tripstrata.sources import layers as tables
from tripstrata.sources.layers import Layers, Partition

MEASURES = ("total_rows", "compliant_rows", *VIOLATIONS, "mapped_rows", "unmatched_zone_rows")
KEYS = ("layer", *PARTITION_COLUMNS)
ALL_SERVICES = "all"
_SCHEMA = T.StructType(
    [T.StructField(name, T.LongType()) for name in MEASURES]
    + [T.StructField(k, T.StringType() if k in ("layer", "service_type") else T.IntegerType()) for k in KEYS]
)
_STORED = T.StructType([*_SCHEMA.fields, T.StructField("version", T.LongType())])


def _rows() -> list:
    return [F.count(F.lit(1)).alias("total_rows")]


def measure_partitions(spark: SparkSession, layers: Layers, touched: Iterable[Partition] | None) -> DataFrame:
    """Measures of the touched partitions, or of all; the filters reach the scans as partition filters."""
    touched = None if touched is None else list(touched)
    months = None if touched is None else tables.months_of(touched)

    def of(table: DataFrame, layer: str, keys: tuple[str, ...], wanted: list | None, measures: list) -> DataFrame:
        rows = table if wanted is None else table.filter(tables.one_of(keys, wanted))
        found = rows.groupBy(*keys).agg(*measures)
        service = F.col("service_type") if "service_type" in keys else F.lit(ALL_SERVICES).alias("service_type")
        have = [F.col(m) if m in found.columns else F.lit(None).cast("bigint").alias(m) for m in MEASURES]
        return found.select(*have, F.lit(layer).alias("layer"), service, *MONTH_COLUMNS)

    return reduce(
        DataFrame.unionByName,
        [
            of(tables.read_bronze(spark, layers), "bronze", PARTITION_COLUMNS, touched, _rows()),
            of(tables.read_silver(spark, layers), "silver", PARTITION_COLUMNS, touched, silver_columns()),
            of(tables.read_zone_metrics(spark, layers), "gold_zones", MONTH_COLUMNS, months, gold_columns()),
            of(tables.read_payment_metrics(spark, layers), "gold_payments", MONTH_COLUMNS, months, _rows()),
        ],
    )


def read_measures(spark: SparkSession, layers: Layers) -> DataFrame:
    """The stored rows, of which the one with the highest version counts; none if nothing has been measured."""
    try:
        return spark.read.schema(_STORED).parquet(layers.partition_measures)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _STORED)


def store_measures(spark: SparkSession, layers: Layers, touched: Iterable[Partition] | None) -> None:
    """Bring the stored measures up to date: those of the touched partitions, or all of them.

    A batch appends one row per touched partition, of zeros where no rows are left; a repeated batch appends the same
    again. Measuring everything replaces the table by one row a partition. Without stored measures all are taken.
    """
    last = None if touched is None else read_measures(spark, layers).agg(F.max("version")).first()[0]
    if last is None:
        found = measure_partitions(spark, layers, None).withColumn("version", F.lit(0).cast("bigint"))
        found.coalesce(1).write.mode("overwrite").parquet(layers.partition_measures)
        return
    touched = list(touched)
    expected = [(layer, *p) for layer in ("bronze", "silver") for p in touched]
    expected += [(layer, ALL_SERVICES, *m) for layer in ("gold_zones", "gold_payments") for m in tables.months_of(touched)]
    keys = spark.createDataFrame(expected, T.StructType([f for f in _SCHEMA if f.name in KEYS])).coalesce(1)
    found = keys.join(measure_partitions(spark, layers, touched), list(KEYS), "left").fillna(0, list(MEASURES))
    rows = found.select(*_SCHEMA.names).withColumn("version", F.lit(last + 1))
    rows.coalesce(1).write.mode("append").parquet(layers.partition_measures)


def stored_totals(spark: SparkSession, layers: Layers) -> DataFrame:
    """One row per layer with the sums of all measures over its partitions."""
    newest = read_measures(spark, layers).groupBy(*KEYS).agg(F.max_by(F.struct(*MEASURES), "version").alias("m"))
    return newest.groupBy("layer").agg(*[F.sum(f"m.{m}").alias(m) for m in MEASURES])


def totals_of(spark: SparkSession, layers: Layers) -> tuple[dict[str, int], DataFrame, DataFrame]:
    """Row counts by layer, and the one-row measures of silver and of gold."""
    by_layer = {row.layer: row for row in stored_totals(spark, layers).collect()}

    def of(layer: str, names: tuple[str, ...]) -> dict[str, int]:
        return {m: (by_layer[layer][m] if layer in by_layer else None) or 0 for m in names}

    def one_row(counts: dict[str, int]) -> DataFrame:
        return spark.range(1, numPartitions=1).select(*[F.lit(n).cast("bigint").alias(m) for m, n in counts.items()])

    counts = {layer: of(layer, ("total_rows",))["total_rows"] for layer in ("bronze", "silver", "gold_zones", "gold_payments")}
    silver = of("silver", ("total_rows", "compliant_rows", *VIOLATIONS))
    gold = of("gold_zones", ("total_rows", "mapped_rows", "unmatched_zone_rows"))
    return counts, one_row(silver), one_row(gold)
