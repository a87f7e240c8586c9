from __future__ import annotations

from collections import Counter
from datetime import timedelta

import pytest
from pyspark.sql import functions as F
from tests.trips import GOOD, START, silver_rows

from tripstrata.functions.trips import file_period, record_hash, trip_duration_minutes
from tripstrata.functions.values import typed_value
from tripstrata.operators import dedup, metrics, product, quality, rules
from tripstrata.operators.standardize import standardize
from tripstrata.operators.zones import attach_zones, zone_lookup
from tripstrata.schemas import SILVER_SCHEMA, ZONE_METRICS_SCHEMA

NAN = float("nan")

EDGES = [
    ({}, []),
    ({"trip_distance": -0.01}, ["distance_negative"]),
    ({"trip_distance": 0.0}, []),
    ({"trip_distance": 300.0}, []),
    ({"trip_distance": 300.01}, ["distance_over_cap"]),
    ({"trip_distance": NAN}, ["distance_over_cap"]),
    ({"trip_distance": None}, ["distance_missing", "distance_negative", "distance_over_cap"]),
    ({"total_amount": 0.0}, ["amount_not_positive"]),
    ({"total_amount": 0.01}, []),
    ({"total_amount": 1000.0}, []),
    ({"total_amount": 1000.01}, ["amount_over_cap"]),
    ({"total_amount": NAN}, ["amount_over_cap"]),
    ({"total_amount": None}, ["amount_missing", "amount_not_positive", "amount_over_cap"]),
    ({"trip_duration_minutes": 0}, ["duration_out_of_range"]),
    ({"trip_duration_minutes": 1}, []),
    ({"trip_duration_minutes": 720}, []),
    ({"trip_duration_minutes": 721}, ["duration_out_of_range"]),
    ({"dropoff_datetime": START}, []),
    ({"dropoff_datetime": START - timedelta(seconds=1)}, ["pickup_after_dropoff"]),
    ({"pickup_datetime": None}, ["pickup_missing", "pickup_after_dropoff"]),
    ({"dropoff_datetime": None}, ["dropoff_missing", "pickup_after_dropoff"]),
    ({"pu_location_id": None}, ["pickup_location_missing"]),
    ({"do_location_id": None}, ["dropoff_location_missing"]),
]


def test_rule_edges(spark):
    changes = [{**change, "vendor_id": i} for i, (change, _) in enumerate(EDGES)]
    trips = silver_rows(spark, *changes)
    found = {r.vendor_id: r.failed for r in trips.select("vendor_id", rules.failed_rules().alias("failed")).collect()}
    assert found == {i: failed for i, (_, failed) in enumerate(EDGES)}
    summary = {r.failed_rules: r.row_count for r in rules.reject_summary(trips).collect()}
    assert summary == Counter(",".join(failed) for _, failed in EDGES)
    kept = {r.vendor_id for r in rules.keep_compliant(trips).collect()}
    assert kept == {i for i, (_, failed) in enumerate(EDGES) if not failed}
    compliant = {r.vendor_id for r in trips.filter(rules.is_compliant()).collect()}
    assert compliant == kept


def test_violations_skip_null_but_compliance_does_not(spark):
    trips = silver_rows(spark, {"trip_distance": None}, {"total_amount": None}, {"trip_duration_minutes": None})
    counts = {r.violation: r.violating_rows for r in quality.rule_violations(trips).collect()}
    assert set(counts.values()) == {0}
    assert quality.rule_compliance(trips).first().compliant_rows == 0


def test_nan_distance_counts_as_over_cap(spark):
    counts = quality.silver_measures(silver_rows(spark, {"trip_distance": NAN})).first()
    assert (counts.distance_over_cap, counts.compliant_rows) == (1, 0)


@pytest.mark.parametrize("seconds, minutes", [(59, 0), (60, 1), (720 * 60 + 59, 720), (721 * 60, 721), (-59, 0), (-61, -1)])
def test_duration_truncates(spark, seconds, minutes):
    trips = silver_rows(spark, {"dropoff_datetime": START + timedelta(seconds=seconds)})
    assert trips.select(trip_duration_minutes().alias("m")).first().m == minutes


def test_dedup_cases(spark):
    trips = silver_rows(
        spark,
        {"fare_amount": 12.0},
        {"fare_amount": 11.0},  # same trip, other fare: one survivor, the smaller fare
        {"pickup_month": 2, "source_file_name": "yellow_tripdata_2025-02.parquet"},  # other file month
        {"vendor_id": None},
        {"vendor_id": None, "tip_amount": 9.0},
        {"pickup_datetime": START + timedelta(milliseconds=400), "fare_amount": 1.0},  # same second
        {"trip_distance": 0.0},
        {"trip_distance": -0.0},
        {"passenger_count": None},
        {"service_type": "green"},
    )
    kept = dedup.deduplicate(trips)
    assert kept.columns == SILVER_SCHEMA.names
    assert kept.count() == 7
    survivor = kept.filter("vendor_id = 1 AND pickup_month = 1 AND trip_distance = 3.5 AND passenger_count = 2")
    assert [r.fare_amount for r in survivor.filter("service_type = 'yellow'").collect()] == [11.0]
    assert dedup.distinct_trips(trips).count() == 7
    summary = dedup.duplicate_summary(trips).agg(F.sum("rows_before"), F.sum("rows_after"), F.max("most_copies"))
    assert tuple(summary.first()) == (10, 7, 3)


def test_identity_equals_hash(spark):
    """The identity columns and the record hash split rows into the same groups."""
    trips = silver_rows(
        spark, {}, {}, {"vendor_id": None}, {"vendor_id": 2025}, {"trip_distance": -0.0}, {"trip_distance": 0.0},
        {"passenger_count": None}, {"payment_type": None}, {"rate_code_id": None},
        {"pickup_datetime": START + timedelta(microseconds=5)},
    )
    by_hash = trips.groupBy("pickup_year", "pickup_month", record_hash()).count().count()
    assert by_hash == dedup.distinct_trips(trips).count() == dedup.deduplicate(trips).count() == 8


def test_hot_trip_is_cut_before_the_shuffle(spark):
    copies = F.explode(F.sequence(F.lit(1), F.lit(20_000)))
    trips = silver_rows(spark, {}).withColumn("copy", copies).repartition(8).drop("copy")
    kept = dedup.deduplicate(trips)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # before and after the exchange
    assert kept.count() == 1


def test_typed_values(spark):
    df = spark.sql("SELECT CAST('NaN' AS DOUBLE) AS nan, 2.9D AS d, 3000000000L AS big, '2025.9' AS t, 'x' AS bad, '2025-01-02 03:04:05' AS ts")
    types = {f.name: f.dataType for f in df.schema.fields}

    def value(name, target):
        return df.select(typed_value(F.col(name), types[name], target).alias("v")).first().v

    assert [value(n, "int") for n in ("nan", "d", "big", "t", "bad")] == [0, 2, None, 2025, None]
    assert value("bad", "double") is None and value("bad", "timestamp") is None
    assert value("ts", "timestamp").year == 2025


def test_standardize_needs_rule_columns_and_known_services(spark):
    raw = spark.sql("SELECT 'f' AS source_file_name, 2025 AS pickup_year, 1 AS pickup_month")
    with pytest.raises(ValueError, match="missing"):
        standardize(raw, ["yellow"])
    with pytest.raises(ValueError, match="Unsupported service_type: fhv"):
        standardize(raw, ["fhv"])


def test_file_periods(spark):
    names = {
        "yellow_tripdata_2025-01.parquet": (2025, 1),
        "x_2025-01_copy.parquet": (2025, 1),
        "green_tripdata_2025-13.parquet": (2025, 13),
        "junk.parquet": (1999, 7),
        "12025-012_2024-02.parquet": (2025, 1),
        "a-b_2024-02.parquet": (2024, 2),
    }
    df = spark.createDataFrame([(n,) for n in names], "n string")
    year, month = file_period(F.col("n"), 1999, 7)
    assert {r.n: (r.y, r.m) for r in df.select("n", year.alias("y"), month.alias("m")).collect()} == names


def _raw_zones(spark, *rows):
    return spark.createDataFrame(list(rows), "LocationID string, Borough string, Zone string")


def test_zone_cases(spark):
    zones = zone_lookup(_raw_zones(spark, ("10", "Queens", None), ("x", "A", "B"), (None, "A", "B"), ("11", "Unknown", "N")))
    trips = silver_rows(spark, {"pu_location_id": 10}, {"pu_location_id": 11}, {"pu_location_id": 99})
    gold = metrics.monthly_zone_metrics(metrics.trip_rollup(trips), zones)
    assert gold.columns == ZONE_METRICS_SCHEMA.names
    assert {r.pu_location_id: (r.borough, r.zone) for r in gold.collect()} == {
        10: ("Queens", "Unknown"), 11: ("Unknown", "N"), 99: ("Unknown", "Unknown"),
    }
    assert quality.gold_measures(gold).first().asDict() == {"total_rows": 3, "mapped_rows": 0, "unmatched_zone_rows": 2}


def test_repeated_zone_id_stops_the_query(spark):
    zones = zone_lookup(_raw_zones(spark, ("10", "Queens", "A"), ("10", "Queens", "B")))
    with pytest.raises(Exception, match="repeats location_id 10"):
        attach_zones(silver_rows(spark, {}), zones).collect()


def test_gold_values(spark):
    trips = silver_rows(
        spark, {"total_amount": 10.0, "payment_type": None}, {"total_amount": 20.0, "passenger_count": None},
        {"total_amount": 6.0, "trip_distance": 0.5, "trip_duration_minutes": 4},
    )
    rollup = metrics.trip_rollup(trips)
    row = metrics.monthly_zone_metrics(rollup, zone_lookup(_raw_zones(spark, ("10", "Q", "Z")))).first()
    assert (row.trip_count, row.total_revenue, row.avg_trip_revenue, row.total_passengers) == (3, 36.0, 12.0, 4)
    assert (row.avg_trip_distance, row.avg_trip_duration_minutes) == (2.5, 8.0)
    by_payment = {r.payment_type: r.trip_count for r in metrics.payment_type_metrics(rollup).collect()}
    assert by_payment == {None: 1, 1: 2}


def test_metric_edges(spark):
    def metric(rows, good, mapped, gold_rows):
        counts = ", ".join(f"0L AS {name}" for name in rules.VIOLATIONS)
        silver = spark.sql(f"SELECT {rows}L AS total_rows, {good}L AS compliant_rows, {counts}")
        gold = spark.sql(f"SELECT {gold_rows}L AS total_rows, {mapped}L AS mapped_rows, 0L AS unmatched_zone_rows")
        found = quality.quality_metrics(silver, gold, spark.sql("SELECT CAST(NULL AS DOUBLE) AS data_freshness_hours"))
        return {r.metric_name: (r.current_value, r.meets_threshold) for r in found.collect()}

    none = metric(0, 0, 0, 0)
    assert none["zone_mapping_completeness"] == (0.0, False)
    assert none["silver_rule_compliance"] == (0.0, False)
    assert none["gold_row_count"] == (0.0, False)
    assert none["data_freshness_hours"] == (None, False)
    some = metric(3_000_000, 2_999_999, 199, 200)
    assert some["zone_mapping_completeness"] == (99.5, True)
    assert some["silver_rule_compliance"] == (100.0, True)  # rounding hides one row of three million


def test_missing_metrics(spark):
    published = spark.createDataFrame([("gold_row_count",), ("silver_rule_compliance",)], "metric_name string")
    missing = {r.metric_name for r in quality.missing_metrics(published).collect()}
    assert missing == {"zone_mapping_completeness", "data_freshness_hours"}


def test_status_texts(spark):
    found = quality.quality_status(
        spark.createDataFrame(
            [("gold_row_count", 469.0, "> 0", "rows", True), ("silver_rule_compliance", 99.5, "100", "percent", False)],
            "metric_name string, current_value double, expected_threshold string, unit string, meets_threshold boolean",
        )
    )
    assert [tuple(r) for r in found.collect()] == [
        ("Gold Row Count", "PASS", "469 rows", "> 0"),
        ("Silver Rule Compliance", "FAIL", "99.5 percent", "100"),
    ]


def test_contract_reports_missing_and_wrong_columns(spark):
    table = spark.sql("SELECT 2025L AS pickup_year, 'yellow' AS service_type")
    ok = {r.column_name: r.ok for r in product.contract_check("t", table, ZONE_METRICS_SCHEMA).collect()}
    assert ok["service_type"] and not ok["pickup_year"] and not ok["zone"] and len(ok) == 12


def test_good_row_is_complete():
    assert set(GOOD) == set(SILVER_SCHEMA.names)
