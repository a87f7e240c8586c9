"""Quality measures, metrics, statuses and checks; one aggregate per table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripstrata.operators.rules import VIOLATIONS, is_compliant, violation_counts
from tripstrata.operators.zones import UNKNOWN
from tripstrata.schemas import METRIC_RECORD

# Cadence and overall texts; metric, definition, threshold text, unit, and the test of `current_value`.
CADENCE = "Every pipeline run"
ALL_PASS = "ALL METRICS PASS"
METRICS = {
    "zone_mapping_completeness": (
        "Percent of records in gold.monthly_zone_metrics where borough and zone are not Unknown.",
        ">= 99.5", "percent", "current_value >= 99.5",
    ),
    "silver_rule_compliance": (
        "Percent of silver records compliant with business quality rules.",
        "100", "percent", "current_value = 100.0",
    ),
    "gold_row_count": (
        "Total number of records in gold.monthly_zone_metrics.",
        "> 0", "rows", "current_value > 0",
    ),
    "data_freshness_hours": (
        "Hours since last modification of gold.monthly_zone_metrics or validation report artifact.",
        "< 168", "hours", "current_value < 168",
    ),
}

SOME_FAIL = "SOME METRICS NEED ATTENTION"


def percent(part: str, whole: str) -> Column:
    """`part` of `whole` in percent to 4 digits; 0 when there are no rows."""
    share = F.round(F.try_divide(F.col(part), F.col(whole)) * 100, 4)
    return F.coalesce(share, F.lit(0.0))


def silver_columns() -> list[Column]:
    """All rows, compliant rows and the violation counts, as additive aggregates."""
    return [F.count(F.lit(1)).alias("total_rows"), F.count_if(is_compliant()).alias("compliant_rows"), *violation_counts()]


def gold_columns() -> list[Column]:
    """All rows, rows with a mapped zone, rows whose zone is unknown, as additive aggregates."""
    mapped = (F.col("borough") != UNKNOWN) & (F.col("zone") != UNKNOWN)
    return [
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(mapped).alias("mapped_rows"),
        F.count_if(F.col("zone") == UNKNOWN).alias("unmatched_zone_rows"),
    ]


def silver_measures(trips: DataFrame) -> DataFrame:
    """One row with the counts over all silver trips, in one pass."""
    return trips.agg(*silver_columns())


def gold_measures(zone_metrics: DataFrame) -> DataFrame:
    """One row with the counts over the gold zone table."""
    return zone_metrics.agg(*gold_columns())


def rule_violations(trips: DataFrame) -> DataFrame:
    """(violation, violating_rows), one row per violation."""
    measures = silver_measures(trips).select(*VIOLATIONS)
    return measures.unpivot([], list(VIOLATIONS), "violation", "violating_rows")


def rule_compliance(trips: DataFrame) -> DataFrame:
    """The compliance percentage beside the exact counts, which rounding can hide."""
    return silver_measures(trips).select(
        percent("compliant_rows", "total_rows").alias("silver_rule_compliance"),
        "compliant_rows",
        (F.col("total_rows") - F.col("compliant_rows")).alias("non_compliant_rows"),
    )


def zone_completeness(zone_metrics: DataFrame) -> DataFrame:
    return gold_measures(zone_metrics).select(
        percent("mapped_rows", "total_rows").alias("zone_mapping_completeness"),
        "mapped_rows",
        "total_rows",
    )


def layer_row_counts(layers: dict[str, DataFrame]) -> DataFrame:
    """(layer, row_count), one row per table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("layer"), "row_count")
        for name, df in layers.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def _metric_value(
    measures: DataFrame, name: str, value: Column, details: Column | None = None
) -> DataFrame:
    no_details = F.lit(None).cast("map<string,bigint>")
    return measures.select(
        F.lit(name).alias("metric_name"),
        value.cast("double").alias("current_value"),
        (no_details if details is None else details).alias("violations"),
    )


def quality_metrics(
    silver: DataFrame, gold: DataFrame, freshness: DataFrame | None = None
) -> DataFrame:
    """One row per metric: value, threshold, unit and whether the value meets it.

    Takes the one-row results of `silver_measures`, `gold_measures` and `data_freshness`; without
    the last one that metric is left out.
    """
    violation_map = F.create_map(
        *[part for name in VIOLATIONS for part in (F.lit(name), F.col(name))]
    )
    compliance = percent("compliant_rows", "total_rows")
    both = F.array(
        F.struct(
            F.lit("zone_mapping_completeness").alias("metric_name"),
            percent("mapped_rows", "total_rows").alias("current_value"),
        ),
        F.struct(
            F.lit("gold_row_count").alias("metric_name"),
            F.col("total_rows").cast("double").alias("current_value"),
        ),
    )
    gold_values = gold.select(F.inline(both)).withColumn(
        "violations", F.lit(None).cast("map<string,bigint>")
    )
    values = gold_values.unionByName(
        _metric_value(silver, "silver_rule_compliance", compliance, violation_map)
    )
    if freshness is not None:
        hours = F.col("data_freshness_hours")
        values = values.unionByName(_metric_value(freshness, "data_freshness_hours", hours))
    return _describe(values)


def _by_metric(position: int) -> Column:
    return F.coalesce(
        *[
            F.when(F.col("metric_name") == name, F.lit(fixed[position]))
            for name, fixed in METRICS.items()
        ]
    )


def _describe(values: DataFrame) -> DataFrame:
    tests = [
        F.when(F.col("metric_name") == name, F.coalesce(F.expr(fixed[3]), F.lit(False)))
        for name, fixed in METRICS.items()
    ]
    return values.select(
        "metric_name",
        _by_metric(0).alias("metric_definition"),
        "current_value",
        _by_metric(1).alias("expected_threshold"),
        F.lit(CADENCE).alias("update_cadence"),
        _by_metric(2).alias("unit"),
        F.coalesce(*tests).alias("meets_threshold"),
        "violations",
    )


def metric_records(metrics: DataFrame) -> DataFrame:
    """The metrics as the report stores them: violations, where a metric has them, are its details."""
    details = F.when(F.col("violations").isNotNull(), F.struct("violations"))
    return metrics.withColumn("details", details).select(*METRIC_RECORD.names)


def reported_metrics(report: DataFrame, records: str) -> DataFrame:
    """The metrics of a stored report, one row each, as `quality_metrics` gives them."""
    return report.select(F.inline(records)).withColumn("violations", F.col("details.violations")).drop("details")


def reported_status(report: DataFrame, records: str) -> DataFrame:
    """`quality_status` of a stored report's metrics, with the overall status beside every line."""
    overall = F.when(F.forall(records, lambda r: r["meets_threshold"]), ALL_PASS).otherwise(SOME_FAIL)
    lines = report.select(overall.alias("overall_status"), F.inline(records))
    return quality_status(lines, "overall_status")


def missing_metrics(metrics: DataFrame) -> DataFrame:
    """`metric_name` of every promised metric the given metrics lack."""
    promised = metrics.sparkSession.createDataFrame([(name,) for name in METRICS], "metric_name string")
    return promised.join(metrics, "metric_name", "left_anti")


def quality_status(metrics: DataFrame, *also: str) -> DataFrame:
    """Report lines: title, PASS or FAIL, and the value with its unit; other columns as asked for."""
    whole = F.col("unit") == "rows"
    number = F.when(whole, F.col("current_value").cast("bigint").cast("string")).otherwise(
        F.col("current_value").cast("string")
    )
    return metrics.select(
        F.initcap(F.replace("metric_name", F.lit("_"), F.lit(" "))).alias("metric_title"),
        F.when(F.col("meets_threshold"), "PASS").otherwise("FAIL").alias("status"),
        F.concat_ws(" ", F.coalesce(number, F.lit("None")), F.col("unit")).alias("value_text"),
        F.col("expected_threshold").alias("threshold_text"),
        *also,
    )


def quality_overall(metrics: DataFrame) -> DataFrame:
    return metrics.agg(
        F.coalesce(F.bool_and("meets_threshold"), F.lit(True)).alias("all_metrics_pass")
    ).withColumn(
        "overall_status", F.when(F.col("all_metrics_pass"), ALL_PASS).otherwise(SOME_FAIL)
    )


def critical_checks(silver: DataFrame, gold: DataFrame) -> DataFrame:
    """(check_name, passed) from the one-row measures; violations decide, not compliance."""
    violated = reduce(lambda a, b: a + b, [F.col(name) for name in VIOLATIONS])
    of_silver = silver.select(
        (F.col("total_rows") > 0).alias("silver_non_empty"),
        (violated == 0).alias("silver_rules_no_violations"),
    ).unpivot([], ["silver_non_empty", "silver_rules_no_violations"], "check_name", "passed")
    of_gold = gold.select((F.col("total_rows") > 0).alias("gold_monthly_non_empty")).unpivot(
        [], ["gold_monthly_non_empty"], "check_name", "passed"
    )
    return of_silver.unionByName(of_gold)


def data_freshness(files: DataFrame, now: Column | None = None) -> DataFrame:
    """Hours from the newest `modified` of the product's and the report's files to `now`; NULL without files."""
    newest = files.agg(F.max("modified").alias("newest"))
    micros = F.unix_micros(F.current_timestamp() if now is None else now) - F.unix_micros("newest")
    return newest.select(F.round(micros / F.lit(3.6e9), 4).alias("data_freshness_hours"))
