"""What runs keep on storage: the file catalogue, measures and rollups per partition, reports, and streams of events."""

from __future__ import annotations

import json
import os
import shutil

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from tests.trips import raw_file, zone_csv

from tripstrata.operators import quality
from tripstrata.plans import contract, measures, medallion
from tripstrata.schemas import MONTH_COLUMNS, PARTITION_COLUMNS, SILVER_SCHEMA, ZONE_GRAIN, ZONE_METRICS_SCHEMA
from tripstrata.sources import catalog, trip_files
from tripstrata.sources import layers as tables
from tripstrata.sources.layers import Layers
from tripstrata.streaming import payloads
from tripstrata.streaming.arrivals import start_arrivals

MONTHS = [("yellow", 1), ("yellow", 2), ("yellow", 3), ("green", 1), ("green", 2)]


def _place(root, service, month, folder="incoming"):
    return root / folder / f"{service}_tripdata_2025-{month:02d}.parquet"


def _land(root, months=MONTHS, folder="incoming", **change):
    zone_csv(root / "zones.csv")
    for service, month in months:
        raw_file(_place(root, service, month, folder), {"fare_amount": float(month), **change}, {"PULocationID": 99, **change}, service=service)


def _stream(spark, root, **options):
    layers = Layers(str(root / "layers"))
    start_arrivals(spark, str(root / "incoming"), str(root / "zones.csv"), layers, str(root / "checkpoint"), **options).awaitTermination()
    return layers


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def _plan(spark, df):
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    plan = df._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    return plan


# ---- Catalogue -----------------------------------------------------------------------------------------------


def test_catalogue_reads_each_footer_once(spark, tmp_path):
    store = str(tmp_path / "catalog")
    paths = [raw_file(_place(tmp_path, "yellow", m), {"passenger_count": 4 if m % 2 else 4.0}) for m in (1, 2, 3)]
    (tmp_path / "incoming" / "yellow_tripdata_2025-04.parquet").write_bytes(b"no parquet")
    (tmp_path / "incoming" / "yellow_tripdata_2025-05.parquet").write_bytes(b"PAR1 and no more")

    def listed():
        return trip_files.list_files(spark, str(tmp_path / "incoming"))

    assert len(catalog.update_catalog(spark, listed(), store)) == 5
    assert catalog.update_catalog(spark, listed(), store) == []
    schemas = {path.rsplit("/", 1)[1][16:23]: s for path, s in catalog.file_schemas(spark, listed(), store).items()}
    assert {m: s for m, s in schemas.items() if isinstance(s, str)} == {"2025-04": "unreadable", "2025-05": "unreadable"}
    for path in paths:
        assert schemas[path[-15:-8]] == spark.read.parquet(path).schema
    raw_file(_place(tmp_path, "yellow", 2), {"surge": 1.5}, {})
    os.utime(paths[0], (1, 1))
    assert {p[-15:-8] for p in catalog.update_catalog(spark, listed(), store)} == {"2025-01", "2025-02"}
    again = {path[-15:-8]: s for path, s in catalog.file_schemas(spark, listed(), store).items()}
    assert "surge" in again["2025-02"].names and len(again) == 5
    assert catalog.update_catalog(spark, trip_files.list_files(spark, str(tmp_path / "nowhere")), store) == []


def test_catalogued_types_are_those_that_spark_infers(spark, tmp_path):
    written = spark.sql(
        "SELECT 1 AS i, 2L AS l, CAST(3 AS SMALLINT) AS s, CAST(1.5 AS FLOAT) AS f, 2.5D AS d, 'x' AS t, true AS b,"
        " CAST(1.25 AS DECIMAL(9,2)) AS dec, DATE'2025-01-01' AS day, TIMESTAMP'2025-01-01 00:00:00' AS at,"
        " TIMESTAMP_NTZ'2025-01-01 00:00:00' AS ntz, array(1, 2) AS a, named_struct('x', 1, 'y', 'z') AS st"
    )
    written.write.parquet(str(tmp_path / "spark"))
    found = catalog.read_footers(trip_files.list_files(spark, str(tmp_path / "spark"))).collect()
    assert [json.loads(r.columns) for r in found] == [json.loads(spark.read.parquet(str(tmp_path / "spark")).schema.json())]
    # Times in nanoseconds are left to Spark, which refuses them.
    assert catalog._footer(raw_file(tmp_path / "plain.parquet", {}))[0] == spark.read.parquet(str(tmp_path / "plain.parquet")).schema.json()


# ---- Measures ------------------------------------------------------------------------------------------------


def test_measures_of_batches_equal_a_full_validation(spark, tmp_path):
    _land(tmp_path, MONTHS[:3])
    layers = _stream(spark, tmp_path)
    _land(tmp_path, MONTHS[3:])
    _stream(spark, tmp_path)
    _land(tmp_path, [("yellow", 2)], "incoming/corrected", total_amount=-1.0)  # empties a silver month
    _stream(spark, tmp_path)
    batch = medallion.read_report(spark, layers).first().asDict(recursive=True)
    full = medallion.validate(spark, layers)
    assert [batch[k] for k in ("row_counts", "silver_rule_violations", "gold_unmatched_zone_rows", "critical_checks")] == [
        full[k] for k in ("row_counts", "silver_rule_violations", "gold_unmatched_zone_rows", "critical_checks")
    ]
    assert batch["row_counts"] == {"bronze_rows": 10, "bronze_zone_rows": 3, "silver_rows": 8, "gold_monthly_rows": 8, "gold_payment_rows": 4}
    assert batch["gold_unmatched_zone_rows"] == 4


def test_a_batch_measures_touched_partitions_only(spark, tmp_path):
    _land(tmp_path)
    layers = _stream(spark, tmp_path)
    plan = _plan(spark, measures.measure_partitions(spark, layers, [("green", 2025, 2)]))
    assert plan.count("PartitionFilters: [(concat_ws(/") == 4
    # A file of another month that can no longer be read does not matter.
    for part in (tmp_path / "layers/silver/trips/service_type=yellow/pickup_year=2025/pickup_month=1").glob("*.parquet"):
        part.write_bytes(b"broken")
    measures.store_measures(spark, layers, [("green", 2025, 2)])
    counts, silver, _ = measures.totals_of(spark, layers)
    assert counts == {"bronze": 10, "silver": 10, "gold_zones": 10, "gold_payments": 5} and silver.first().compliant_rows == 10


# ---- Gold from rollups ---------------------------------------------------------------------------------------


def test_gold_reads_trips_of_the_touched_service_only(spark, tmp_path):
    _land(tmp_path)
    layers = _stream(spark, tmp_path)
    green = tables.read_zone_metrics(spark, layers).filter("service_type = 'green'")
    before = _rows(green)
    _land(tmp_path, [("yellow", 1)], "incoming/corrected", total_amount=50.0)
    plan = _plan(spark, medallion.rollup_of(spark, layers, [("yellow", 2025, 1)]))
    assert "PartitionFilters: [(concat_ws(/" in plan
    _stream(spark, tmp_path)
    assert _rows(tables.read_zone_metrics(spark, layers).filter("service_type = 'green'")) == before
    january = tables.read_zone_metrics(spark, layers).filter("service_type = 'yellow' AND pickup_month = 1")
    assert {r.total_revenue for r in january.collect()} == {50.0}
    # The same from nothing but trips, and when the rollups are lost.
    stored = _rows(tables.read_zone_metrics(spark, layers))
    shutil.move(layers.trip_rollup, str(tmp_path / "lost"))
    medallion.build_gold(spark, layers, [(2025, 1)], [("yellow", 2025, 1)])
    assert _rows(tables.read_zone_metrics(spark, layers)) == stored


# ---- Stored report and contract ------------------------------------------------------------------------------


def test_report_is_read_back(spark, tmp_path):
    layers = Layers(str(tmp_path / "layers"))
    with pytest.raises(FileNotFoundError, match="No report"):
        medallion.read_report(spark, layers)
    _land(tmp_path)
    _stream(spark, tmp_path)
    report = medallion.read_report(spark, layers).first()
    assert report.row_counts["silver_rows"] == 10 and report.critical_checks == {
        "silver_non_empty": True, "silver_rules_no_violations": True, "gold_monthly_non_empty": True,
    }
    lines = {r.metric_title: r for r in quality.reported_status(medallion.read_report(spark, layers), "data_product_quality_metrics").collect()}
    assert lines["Gold Row Count"].value_text == "10 rows" and lines["Zone Mapping Completeness"].status == "FAIL"
    assert {r.overall_status for r in lines.values()} == {quality.SOME_FAIL}
    document = json.loads(spark.read.text(layers.quality_metrics).first().value)
    details = {m["metric_name"]: m.get("details") for m in document["metrics"]}
    assert details["gold_row_count"] is None and set(details["silver_rule_compliance"]["violations"].values()) == {0}


def test_contract_of_stored_files(spark, tmp_path):
    path = str(tmp_path / "gold")
    columns = ["2025, {m}", "'yellow'", "{z}", "'Queens'", "'A'", "1L", "2.0D", "2.0D", "1.0D", "1.0D", "1L"]
    rows = [f"({', '.join(columns).format(m=m, z=z)})" for m in (1, 2, 3, 4) for z in (1, 2)]
    gold = spark.sql(f"SELECT * FROM VALUES {', '.join(rows)} AS t({', '.join(ZONE_METRICS_SCHEMA.names)})")

    def found():
        return _rows(contract.contract_violations(spark, path, ZONE_METRICS_SCHEMA, MONTH_COLUMNS, ZONE_GRAIN))

    assert found() == []  # no table is no departure of a file
    gold.repartition(1).write.partitionBy(*MONTH_COLUMNS).parquet(path)
    assert found() == []
    assert spark.createDataFrame([], "a int").count() == 0
    drifted = gold.withColumn("pu_location_id", F.col("pu_location_id").cast("string")).drop("zone")
    drifted.filter("pickup_month = 2").repartition(1).write.mode("append").partitionBy(*MONTH_COLUMNS).parquet(path)
    gold.filter("pickup_month = 3").withColumn("extra", F.lit(1)).repartition(1).write.mode("append").partitionBy(*MONTH_COLUMNS).parquet(path)
    (tmp_path / "gold/pickup_year=2025/pickup_month=4/part-x.parquet").write_bytes(b"nothing")
    assert found() == sorted(
        [
            (2025, 2, "type", "pu_location_id", "int", "string", 1),
            (2025, 2, "missing", "zone", "string", None, 1),
            (2025, 4, "unreadable", None, None, None, 1),
            (2025, 3, "repeated", None, None, None, 2),
        ],
        key=str,
    )


def test_freshness_follows_file_times(spark, tmp_path):
    now = F.lit("2025-01-02 00:00:00").cast("timestamp")
    files = [raw_file(tmp_path / "table" / f"part-{k}.parquet", {}) for k in range(3)]
    for k, path in enumerate(files):
        os.utime(path, (1735689600 + 3600 * k, 1735689600 + 3600 * k))  # 2025-01-01, then an hour later each
    listed = trip_files.list_files(spark, str(tmp_path / "table"))
    assert quality.data_freshness(listed, now).first()[0] == 22.0
    assert quality.data_freshness(trip_files.list_files(spark, str(tmp_path / "none")), now).first()[0] is None


# ---- Streams -------------------------------------------------------------------------------------------------


def _event(**change):
    event = {"event_type": "new_raw_file", "service_type": "yellow", "year": 2025, "month": 1, "file_path": "incoming/yellow_tripdata_2025-01.parquet"}
    return json.dumps({**event, **change})


def _send(root, name, *lines):
    (root / "messages").mkdir(exist_ok=True)
    (root / "messages" / name).write_text("\n".join(lines) + "\n")


def test_events_are_taken_once(spark, tmp_path):
    layers = Layers(str(tmp_path / "layers"))
    handled = []

    def run():
        handle = lambda _, events: handled.extend(sorted(r.file_path for r in events.collect()))
        payloads.start_messages(spark, str(tmp_path / "messages"), layers, str(tmp_path / "checkpoint"), handle=handle).awaitTermination()

    _send(tmp_path, "a.txt", _event(), _event(), _event(extra=1), "no json", _event(file_path="b"))
    run()
    _send(tmp_path, "b.txt", _event(year="2025"), "no json", "no json either", _event(month=13), _event(file_path="c"))
    run()
    run()
    assert handled == ["b", "incoming/yellow_tripdata_2025-01.parquet", "c"]
    assert sorted(r.file_path for r in payloads.read_accepted(spark, layers).collect()) == ["b", "c", "incoming/yellow_tripdata_2025-01.parquet"]
    assert sorted((r.reject_reason, r.batch) for r in payloads.read_rejected(spark, layers).collect()) == [("invalid_month", 1), ("not_json", 0), ("not_json", 1)]


def test_a_failed_batch_of_events_is_handled_again(spark, tmp_path):
    layers, calls = Layers(str(tmp_path / "layers")), []

    def handle(_, events):
        calls.append(sorted(r.file_path for r in events.collect()))
        if len(calls) == 1:
            raise RuntimeError("handler failed")

    _send(tmp_path, "a.txt", _event(file_path="a"), _event(file_path="b"))
    start = lambda: payloads.start_messages(spark, str(tmp_path / "messages"), layers, str(tmp_path / "checkpoint"), handle=handle).awaitTermination()
    with pytest.raises(StreamingQueryException):
        start()
    start()
    assert calls == [["a", "b"], ["a", "b"]] and payloads.read_accepted(spark, layers).count() == 2


def test_announced_files_in_either_folder_or_in_none(spark, tmp_path):
    layers = Layers(str(tmp_path / "layers"))
    _land(tmp_path, [("yellow", 1)])
    raw_file(tmp_path / "archive" / str(_place(tmp_path, "yellow", 2)).lstrip("/"), {})  # moved before
    _land(tmp_path, [("yellow", 4)])
    paths = ["incoming/yellow_tripdata_2025-01.parquet", str(_place(tmp_path, "yellow", 2)), "incoming/yellow_tripdata_2025-03.parquet", "incoming/again/yellow_tripdata_2025-04.parquet", "incoming/x.parquet"]
    _send(tmp_path, "a.txt", *(_event(file_path=p) for p in paths))
    build = payloads.month_builder(str(tmp_path / "incoming"), str(tmp_path / "archive"), str(tmp_path / "zones.csv"), layers, str(tmp_path))
    payloads.start_messages(spark, str(tmp_path / "messages"), layers, str(tmp_path / "checkpoint"), handle=build).awaitTermination()
    assert sorted(r.pickup_month for r in tables.read_silver(spark, layers).select("pickup_month").distinct().collect()) == [1, 2]
    failed = {r.path.rsplit("/", 2)[-2] + "/" + r.path[-15:-8]: r.reason for r in spark.read.parquet(layers.failed_files).collect()}
    # April's other delivery lies there, but the announced one does not: the month stays as it is.
    assert failed == {"incoming/2025-03": "missing", "again/2025-04": "missing"}
    assert [r.reject_reason for r in spark.read.parquet(layers.rejected_files).collect()] == ["file_name_not_accepted"]


@pytest.mark.parametrize("layer", ["bronze", "silver", "gold"])
def test_a_batch_that_fails_between_layers_is_repeated(spark, tmp_path, layer):
    _land(tmp_path, MONTHS[:2])

    def fail(written):
        if written == layer:
            raise RuntimeError("stopped")

    with pytest.raises(StreamingQueryException):
        _stream(spark, tmp_path, after=fail)
    layers = _stream(spark, tmp_path)
    assert tables.read_zone_metrics(spark, layers).count() == 4
    assert medallion.read_report(spark, layers).first().row_counts["silver_rows"] == 4
    assert not tables.stored_partitions(spark, layers.silver_trips, PARTITION_COLUMNS, SILVER_SCHEMA).isEmpty()


def test_files_are_published_one_by_one_in_order(spark, tmp_path):
    layers = Layers(str(tmp_path / "layers"))
    for k, month in enumerate((3, 1, 2)):
        os.utime(raw_file(_place(tmp_path, "yellow", month), {}), (1_700_000_000 + k, 1_700_000_000 + k))
    start = lambda: payloads.start_publisher(spark, str(tmp_path / "incoming"), layers, str(tmp_path / "checkpoint")).awaitTermination()
    start()
    os.utime(raw_file(_place(tmp_path, "green", 1), {}, service="green"), (1_600_000_000, 1_600_000_000))
    start()
    start()
    found = {r.batch: r.file_name for r in payloads.read_published(spark, layers).collect()}
    assert [found[k][:-8] for k in sorted(found)] == ["yellow_tripdata_2025-03", "yellow_tripdata_2025-01", "yellow_tripdata_2025-02", "green_tripdata_2025-01"]
