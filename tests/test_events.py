from __future__ import annotations

import json

from tripstrata.streaming.events import classify_files, parse_events, unpublished

GOOD = {
    "event_type": "new_raw_file", "service_type": "green", "year": 2025, "month": 1, "file_path": "a/b.parquet",
}
MESSAGES = {
    json.dumps(GOOD): None,
    json.dumps({**GOOD, "year": "2025"}): None,
    json.dumps({**GOOD, "year": 2000}): None,
    json.dumps({**GOOD, "year": 2100}): None,
    json.dumps({**GOOD, "extra": [1]}): None,
    json.dumps({**GOOD, "year": 1999}): "invalid_year",
    json.dumps({**GOOD, "year": 2101}): "invalid_year",
    json.dumps({**GOOD, "month": 0}): "invalid_month",
    json.dumps({**GOOD, "month": 13}): "invalid_month",
    json.dumps({**GOOD, "month": "x"}): "month_not_an_integer",
    json.dumps({**GOOD, "year": "2025.0"}): "year_not_an_integer",
    json.dumps({**GOOD, "service_type": "fhv"}): "unsupported_service_type",
    json.dumps({**GOOD, "event_type": "gone"}): "unsupported_event_type",
    json.dumps({**GOOD, "file_path": ""}): "empty_file_path",
    json.dumps({**GOOD, "file_path": None}): "missing_file_path",
    json.dumps([GOOD]): "not_an_object",
    "3": "not_an_object",
    "not json": "not_json",
    **{json.dumps({k: v for k, v in GOOD.items() if k != name}): f"missing_{name}" for name in GOOD},
}


def test_event_messages(spark):
    parsed = parse_events(spark.createDataFrame([(m,) for m in MESSAGES], "payload string"))
    assert {r.payload: r.reject_reason for r in parsed.collect()} == MESSAGES


def test_file_names(spark):
    paths = {
        "/in/yellow_tripdata_2025-01.parquet": ("yellow", 2025, 1, None),
        "/in/source_file_name=green_tripdata_2025-02.parquet/part-0.snappy.parquet": ("green", 2025, 2, None),
        "/in/green_tripdata_2025-13.parquet": ("green", 2025, 13, "invalid_month"),
        "/in/green_tripdata_1999-12.parquet": ("green", 1999, 12, "invalid_year"),
        "/in/x_2025-01_copy.parquet": (None, None, None, "file_name_not_accepted"),
        "/in/fhv_tripdata_2025-01.parquet": (None, None, None, "file_name_not_accepted"),
        "/in/junk.parquet": (None, None, None, "file_name_not_accepted"),
    }
    found = classify_files(spark.createDataFrame([(p,) for p in paths], "path string")).collect()
    assert {r.path: (r.service_type, r.year, r.month, r.reject_reason) for r in found} == paths


def test_unpublished(spark):
    files = spark.createDataFrame([("a",), ("b",)], "path string")
    ledger = spark.createDataFrame([("a",)], "path string")
    assert [r.path for r in unpublished(files, ledger).collect()] == ["b"]
