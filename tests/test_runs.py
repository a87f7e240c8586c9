"""Batch and streaming runs over real files."""

from __future__ import annotations

import json
import os
from datetime import timedelta

import pytest
from tests.trips import START, raw_file, zone_csv

from tripstrata.plans import medallion
from tripstrata.sources import layers as tables
from tripstrata.sources import trip_files
from tripstrata.sources.layers import Layers
from tripstrata.sources.scope import Scope
from tripstrata.streaming.arrivals import start_arrivals

SCOPE = Scope.of(["green", "yellow", "yellow"], [2025], [2, 1, 1])


def _rows(df):
    return sorted(map(tuple, df.drop("ingested_at_utc").collect()), key=str)


def _run(spark, root, scope=SCOPE):
    layers = Layers(str(root / "layers"))
    return layers, medallion.run_batch(spark, [str(root / "raw")], str(root / "zones.csv"), layers, scope)


def _land(root, folder="raw", by_service=True):
    def place(service, month):
        inner = f"{service}/" if by_service else ""
        return root / folder / f"{inner}{service}_tripdata_2025-{month:02d}.parquet"

    zone_csv(root / "zones.csv")
    raw_file(place("yellow", 1), {}, {}, {"PULocationID": 99}, {"total_amount": -1.0})
    raw_file(place("yellow", 2), {"passenger_count": 2.0}, {"passenger_count": None}, drop=("congestion_surcharge",))
    raw_file(place("green", 1), {}, {"fare_amount": 3.0}, service="green")


def test_scope():
    assert SCOPE == Scope(("green", "yellow"), (2025,), (1, 2))
    assert SCOPE.sample() == Scope(("green", "yellow"), (2025,), (1,))
    with pytest.raises(ValueError):
        Scope.of(["fhv"], [2025], [1])


def test_batch_run(spark, tmp_path):
    _land(tmp_path)
    raw_file(tmp_path / "raw" / "yellow" / "yellow_tripdata_2024-12.parquet", {})
    layers, result = _run(spark, tmp_path)
    assert (result["bronze"].processed_files, result["bronze"].skipped_files) == (3, 1)
    assert result["bronze"].touched_partitions == [("green", 2025, 1), ("yellow", 2025, 1), ("yellow", 2025, 2)]
    assert result["silver"] == medallion.SilverResult(5, [(2025, 1), (2025, 2)])
    assert (result["gold"].zone_rows, result["gold"].payment_rows) == (4, 3)
    report = result["validation"]
    assert report["row_counts"] == {
        "bronze_rows": 8, "bronze_zone_rows": 3, "silver_rows": 5, "gold_monthly_rows": 4, "gold_payment_rows": 3,
    }
    assert report["gold_unmatched_zone_rows"] == 1 and all(report["critical_checks"].values())
    stored = json.loads(spark.read.text(layers.validation_report).first().value)
    assert stored["row_counts"] == report["row_counts"]
    assert [m["metric_name"] for m in stored["data_product_quality_metrics"]].count("data_freshness_hours") == 1

    before = [_rows(read(spark, layers)) for read in (tables.read_bronze, tables.read_silver, tables.read_zone_metrics)]
    _run(spark, tmp_path)
    after = [_rows(read(spark, layers)) for read in (tables.read_bronze, tables.read_silver, tables.read_zone_metrics)]
    assert before == after


def test_emptied_month_clears_silver_and_keeps_gold(spark, tmp_path):
    _land(tmp_path)
    layers, _ = _run(spark, tmp_path)
    gold = _rows(tables.read_zone_metrics(spark, layers).filter("pickup_month = 2"))
    raw_file(tmp_path / "raw" / "yellow" / "yellow_tripdata_2025-02.parquet", {"total_amount": 0.0})
    _run(spark, tmp_path, Scope.of(["yellow"], [2025], [2]))
    silver = tables.read_silver(spark, layers)
    assert silver.filter("pickup_month = 2").count() == 0 and silver.count() == 3
    assert _rows(tables.read_zone_metrics(spark, layers).filter("pickup_month = 2")) == gold


def test_failed_check_raises_after_the_report(spark, tmp_path):
    zone_csv(tmp_path / "zones.csv")
    raw_file(tmp_path / "raw" / "yellow" / "yellow_tripdata_2025-01.parquet", {})
    scope = Scope.of(["yellow"], [2025], [1])
    layers, _ = _run(spark, tmp_path, scope)
    bad = tables.read_silver(spark, layers).selectExpr("* EXCEPT (total_amount)", "-1.0D AS total_amount").persist()
    bad.count()
    tables.overwrite_partitions(bad, layers.silver_trips, ("service_type", "pickup_year", "pickup_month"))
    bad.unpersist()
    with pytest.raises(medallion.DataQualityError):
        medallion.validate(spark, layers)
    stored = json.loads(spark.read.text(layers.validation_report).first().value)
    assert stored["critical_checks"]["silver_rules_no_violations"] is False
    assert stored["silver_rule_violations"]["invalid_total_amount"] == 1


def test_missing_inputs(spark, tmp_path):
    raw_file(tmp_path / "raw" / "yellow" / "yellow_tripdata_2025-01.parquet", {})
    with pytest.raises(FileNotFoundError, match="green"):
        _run(spark, tmp_path)
    with pytest.raises(FileNotFoundError, match="zone lookup"):
        _run(spark, tmp_path, Scope.of(["yellow"], [2025], [1]))


def test_schema_drift(spark, tmp_path):
    files = [
        raw_file(tmp_path / "raw/yellow/yellow_tripdata_2025-01.parquet", {"passenger_count": 4}),
        raw_file(tmp_path / "raw/yellow/yellow_tripdata_2025-02.parquet", {"passenger_count": 4.0}),
        raw_file(tmp_path / "raw/yellow/yellow_tripdata_2025-03.parquet", {"airport_fee": 1.5}, drop=("Airport_fee",)),
        raw_file(tmp_path / "raw/yellow/yellow_tripdata_2025-04.parquet", {"surge": 2}, drop=("congestion_surcharge",)),
        raw_file(tmp_path / "raw/yellow/yellow_tripdata_2025-05.parquet", {"surge": 2.5}),
    ]
    bronze = trip_files.scan_trips(spark, [("yellow", path) for path in files], 2025, 1)
    rows = {r.pickup_month: r for r in bronze.collect()}
    assert {m: (r.passenger_count, r.Airport_fee, r.congestion_surcharge, r.surge) for m, r in rows.items()} == {
        1: (4.0, 0.0, 0.0, None), 2: (4.0, 0.0, 0.0, None), 3: (2.0, 1.5, 0.0, None),
        4: (2.0, 0.0, None, 2.0), 5: (2.0, 0.0, 0.0, 2.5),
    }
    assert rows[3].source_file_name == "yellow_tripdata_2025-03.parquet"


def test_bronze_scan_prunes_and_pushes_filters(spark, tmp_path):
    _land(tmp_path)
    layers, _ = _run(spark, tmp_path)
    months = tables.read_silver(spark, layers).filter(tables.one_of(("pickup_year", "pickup_month"), [(2025, 1)]))
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    plan = months.select("total_amount").filter("total_amount > 3")._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "PartitionFilters: [(concat_ws(/" in plan
    assert "GreaterThan(total_amount,3.0)" in plan
    assert "ReadSchema: struct<total_amount:double>" in plan


def _stream(spark, root, **options):
    layers = Layers(str(root / "stream"))
    query = start_arrivals(
        spark, str(root / "incoming"), str(root / "zones.csv"), layers, str(root / "checkpoint"), **options
    )
    query.awaitTermination()
    return layers


@pytest.mark.parametrize("one_at_a_time", [False, True])
def test_stream_equals_batch_and_replay_adds_nothing(spark, tmp_path, one_at_a_time):
    _land(tmp_path)
    batch, _ = _run(spark, tmp_path)
    _land(tmp_path, "incoming", by_service=False)
    raw_file(tmp_path / "incoming" / "junk.parquet", {})
    options = {"archive": str(tmp_path / "archive"), "max_files_per_trigger": 1} if one_at_a_time else {}
    streamed = _stream(spark, tmp_path, **options)

    def same():
        readers = (tables.read_silver, tables.read_zone_metrics, tables.read_payment_metrics)
        return all(_rows(read(spark, batch)) == _rows(read(spark, streamed)) for read in readers)

    assert same()
    rejected = spark.read.parquet(streamed.rejected_files).collect()
    assert [r.reject_reason for r in rejected] == ["file_name_not_accepted"]
    _stream(spark, tmp_path, **options)
    assert same()


def test_second_file_of_a_month_keeps_the_first(spark, tmp_path):
    """Parts of one monthly file arriving in separate batches, the first archived meanwhile."""
    zone_csv(tmp_path / "zones.csv")
    folder = tmp_path / "incoming" / "yellow_tripdata_2025-01.parquet"
    later = {"tpep_dropoff_datetime": START + timedelta(minutes=30)}
    raw_file(folder / "part-0.parquet", {})
    options = {"archive": str(tmp_path / "archive")}
    _stream(spark, tmp_path, **options)
    raw_file(folder / "part-1.parquet", later)
    layers = _stream(spark, tmp_path, **options)
    assert tables.read_silver(spark, layers).count() == 2
    raw_file(tmp_path / "incoming" / "yellow_tripdata_2025-02.parquet", {})
    assert tables.read_silver(spark, _stream(spark, tmp_path, **options)).count() == 3


def test_months_as_folders_of_parts_that_differ(spark, tmp_path):
    """A plain folder is a month of its service; columns and types of every part count; odd characters in paths."""
    zone_csv(tmp_path / "zones.csv")
    yellow = tmp_path / "raw" / "a b%20c+" / "yellow"
    raw_file(yellow / "yellow_tripdata_2025-01.parquet" / "part-0.parquet", {"passenger_count": 4}, drop=("congestion_surcharge",))
    raw_file(yellow / "yellow_tripdata_2025-01.parquet" / "part-1.parquet", {"passenger_count": 4.0, "congestion_surcharge": 2.5, "PULocationID": 20})
    raw_file(yellow / "yellow_tripdata_2025-02.parquet", {})
    layers, result = _run(spark, tmp_path, Scope.of(["yellow"], [2025], [1, 2]))
    assert (result["bronze"].processed_files, result["bronze"].skipped_files) == (2, 0)
    silver = tables.read_silver(spark, layers)
    assert sorted(map(tuple, silver.select("pickup_month", "congestion_surcharge", "source_file_name").collect()), key=str) == sorted(
        [(1, None, "yellow_tripdata_2025-01.parquet"), (1, 2.5, "yellow_tripdata_2025-01.parquet"), (2, 0.0, "yellow_tripdata_2025-02.parquet")], key=str
    )


def test_missing_required_column_stops_the_run_before_bronze_changes(spark, tmp_path):
    _land(tmp_path)
    layers, _ = _run(spark, tmp_path)
    before = _rows(tables.read_bronze(spark, layers))
    raw_file(tmp_path / "raw" / "yellow" / "yellow_tripdata_2025-02.parquet", {}, drop=("trip_distance",))
    with pytest.raises(trip_files.BadFilesError, match="yellow_tripdata_2025-02.parquet: missing column trip_distance"):
        _run(spark, tmp_path)
    assert _rows(tables.read_bronze(spark, layers)) == before


def test_stream_takes_old_files_and_corrections(spark, tmp_path):
    zone_csv(tmp_path / "zones.csv")
    raw_file(tmp_path / "incoming" / "yellow_tripdata_2025-01.parquet", {})
    old = raw_file(tmp_path / "incoming" / "yellow_tripdata_2025-02.parquet", {})
    os.utime(old, (1_600_000_000, 1_600_000_000))
    options = {"archive": str(tmp_path / "archive")}
    layers = _stream(spark, tmp_path, **options)
    assert tables.read_silver(spark, layers).count() == 2
    raw_file(tmp_path / "incoming" / "corrected" / "yellow_tripdata_2025-01.parquet", {"total_amount": 99.0})
    layers = _stream(spark, tmp_path, **options)
    amounts = tables.read_silver(spark, layers).filter("pickup_month = 1").select("total_amount").collect()
    assert [r.total_amount for r in amounts] == [99.0]


def test_bad_files_do_not_stop_the_stream(spark, tmp_path):
    zone_csv(tmp_path / "zones.csv")
    raw_file(tmp_path / "incoming" / "yellow_tripdata_2025-01.parquet", {"total_amount": -1.0})
    layers = _stream(spark, tmp_path)
    raw_file(tmp_path / "incoming" / "yellow_tripdata_2025-02.parquet", {}, drop=("trip_distance",))
    (tmp_path / "incoming" / "yellow_tripdata_2025-03.parquet").write_bytes(b"no parquet")
    raw_file(tmp_path / "incoming" / "yellow_tripdata_2025-04.parquet", {})
    _stream(spark, tmp_path)
    failed = {r.path.rsplit("/", 1)[1][16:23]: r.reason for r in spark.read.parquet(layers.failed_files).collect()}
    assert failed == {"2025-01": "critical check failed", "2025-02": "missing column trip_distance", "2025-03": "unreadable"}
    assert [r.pickup_month for r in tables.read_silver(spark, layers).collect()] == [4]
    raw_file(tmp_path / "incoming" / "yellow_tripdata_2025-05.parquet", {})
    assert tables.read_silver(spark, _stream(spark, tmp_path)).count() == 2
