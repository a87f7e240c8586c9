"""Trips are joined and shuffled once for all files made of them; files are named once, not once a row."""

from __future__ import annotations

import glob
from datetime import datetime

import pytest
from tests.trips import raw_file

from tripstrata.plans import medallion
from tripstrata.sources import star_trips, trip_files
from tripstrata.sources.layers import Layers


@pytest.fixture
def star(spark, tmp_path):
    """Orders of three months, one without a date; keys that repeat and nulls."""
    orders = [(k, None if k == 7 else datetime(1996, 1 + k % 3, 5)) for k in (*range(1, 101), 3)]
    spark.createDataFrame(orders, "o_orderkey bigint, o_orderdate timestamp").write.parquet(f"{tmp_path}/orders.parquet")
    lines = [
        (k, None if k == 9 else k * 31, k * 7, k % 7 + 1, 3.0 + k, 1000.0 * k, 0.1, 0.2, "R" if k % 2 else None if k == 4 else "N", "O", datetime(1996, 3, 6))
        for k in (*range(1, 101), 50)
    ]
    spark.createDataFrame(
        lines,
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double,"
        " l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp",
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    return str(tmp_path)


def _rows(df):
    return sorted(map(str, df.collect()))


def test_lines_give_the_same_trips_without_another_join(spark, star):
    with star_trips.lines_by_file(spark, star, 10) as lines:
        for made, direct in [(star_trips.trips_of(lines), star_trips.raw_trips(spark, star, 10))] + [
            (star_trips.service_trips_of(lines, s), star_trips.raw_service_trips(spark, star, s, 10)) for s in ("green", "yellow")
        ]:
            plan = made._jdf.queryExecution().optimizedPlan().toString()
            assert "InMemoryRelation" in plan and plan.index("InMemoryRelation") < plan.index("Join")
            assert made.schema == direct.schema and _rows(made) == _rows(direct)
        assert made.count() > 40
    assert not lines.is_cached


def test_scan_takes_no_path_apart_per_row(spark, tmp_path):
    path = raw_file(tmp_path / "a b%20c+" / "yellow" / "yellow_tripdata_2025-03.parquet", {}, {"fare_amount": 2.0})
    part = raw_file(tmp_path / "x" / "source_file_name=yellow_tripdata_2025-04.parquet" / "part-0.parquet", {})
    scan = trip_files.scan_trips(spark, [("yellow", path), ("yellow", part)], 1900, 1)
    found = sorted((r.source_file_name, r.service_type, r.pickup_year, r.pickup_month) for r in scan.collect())
    assert found == [(f"yellow_tripdata_2025-0{m}.parquet", "yellow", 2025, m) for m in (3, 3, 4)]
    plan = scan._jdf.queryExecution().optimizedPlan().toString()
    assert "substring_index(_metadata" not in plan and "BroadcastHashJoin" in scan._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("parts", [2, medallion.FEW_FILES + 1])
def test_many_files_of_a_month_become_few(spark, tmp_path, parts):
    folder = tmp_path / "yellow" / "yellow_tripdata_2025-01.parquet"
    files = [("yellow", 2025, 1, raw_file(folder / f"part-{k}.parquet", {"fare_amount": float(k)})) for k in range(parts)]
    layers = Layers(str(tmp_path / "layers"))
    medallion.store_monthly_files(spark, files, layers, 2025, 1)
    assert spark.read.parquet(layers.bronze_trips).count() == parts
    assert len(glob.glob(f"{layers.bronze_trips}/*/*/*/part-*")) <= (parts if parts <= medallion.FEW_FILES else 1)
