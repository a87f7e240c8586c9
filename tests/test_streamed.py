"""The streamed queries hand over one file a micro-batch and move each handled file to the archive."""

from __future__ import annotations

import glob
import os
from datetime import datetime

import pyarrow.parquet as pq
from tests.trips import raw_file, zone_csv

from tripstrata.plans import queries
from tripstrata.sources import layers as tables
from tripstrata.sources.layers import Layers
from tripstrata.streaming.arrivals import take_arrivals


def _names(folder):
    return sorted(path.split("source_file_name=")[-1].split("/")[0] for path in glob.glob(f"{folder}/**/part-*", recursive=True))


def test_streamed_files_come_one_a_batch_and_end_in_the_archive(spark, tmp_path):
    """Lines of one month and both services, one order without a date."""
    place = str(tmp_path)
    orders = [(k, None if k == 7 else datetime(1996, 2, 5)) for k in range(1, 21)]
    spark.createDataFrame(orders, "o_orderkey bigint, o_orderdate timestamp").write.parquet(f"{place}/orders.parquet")
    lines = [(k, k * 31, k * 7, 1, 3.0 + k, 9000.0, 0.1, 0.2, "R" if k % 2 else "N", "O", datetime(1996, 2, 6)) for k in range(1, 21)]
    spark.createDataFrame(
        lines,
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double,"
        " l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp",
    ).write.parquet(f"{place}/lineitem.parquet")
    spark.createDataFrame([(1, 0, "FRANCE")], "n_nationkey int, n_regionkey int, n_name string").write.parquet(f"{place}/nation.parquet")
    spark.createDataFrame([(0, "EUROPE")], "r_regionkey int, r_name string").write.parquet(f"{place}/region.parquet")
    layers = queries._streamed(spark, place, "one-a-batch")
    root = os.path.dirname(layers.root)
    assert _names(f"{root}/raw") == []
    names = _names(f"{root}/archive")
    assert set(names) == {"__HIVE_DEFAULT_PARTITION__", "green_tripdata_2006-02.parquet", "yellow_tripdata_2006-02.parquet"}
    assert len(glob.glob(f"{root}/checkpoint/commits/[0-9]*")) == len(names) >= 3
    assert {(r.service_type, r["count"]) for r in tables.read_bronze(spark, layers).groupBy("service_type").count().collect()} == {
        ("green", 9), ("yellow", 10),
    }


def test_handled_files_are_archived_and_later_ones_wait(spark, tmp_path):
    """The second call moves its own file; odd characters in paths; a file dropped again under a handled path stays."""
    incoming = tmp_path / "incoming" / "a b%20c+"
    layers = Layers(str(tmp_path / "layers"))
    arguments = (str(tmp_path / "incoming"), zone_csv(tmp_path / "zones.csv"), layers, str(tmp_path / "checkpoint"), str(tmp_path / "archive"))
    for month in (1, 2):
        name = f"yellow_tripdata_2025-0{month}.parquet"
        raw_file(incoming / name, {})
        take_arrivals(spark, *arguments)
        assert os.listdir(incoming) == [] and os.path.exists(f"{tmp_path}/archive{incoming}/{name}")
    assert tables.read_silver(spark, layers).count() == 2
    again = raw_file(incoming / name, {"total_amount": 99.0})
    take_arrivals(spark, *arguments)
    archived = f"{tmp_path}/archive{incoming}/{name}"
    assert os.path.exists(again) and pq.read_table(archived)["total_amount"].to_pylist() == [15.3]
