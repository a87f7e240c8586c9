"""Hand-written trips for the edge cases."""

from __future__ import annotations

from datetime import datetime, timedelta

import pyarrow as pa
import pyarrow.parquet as pq

from tripstrata.schemas import SILVER_SCHEMA

START = datetime(2025, 1, 15, 10, 0, 0)

GOOD = {
    "service_type": "yellow",
    "vendor_id": 1,
    "pickup_datetime": START,
    "dropoff_datetime": START + timedelta(minutes=10),
    "passenger_count": 2,
    "trip_distance": 3.5,
    "rate_code_id": 1,
    "store_and_fwd_flag": "N",
    "pu_location_id": 10,
    "do_location_id": 20,
    "payment_type": 1,
    "fare_amount": 12.0,
    "extra": 0.5,
    "mta_tax": 0.5,
    "tip_amount": 2.0,
    "tolls_amount": 0.0,
    "improvement_surcharge": 0.3,
    "total_amount": 15.3,
    "congestion_surcharge": 0.0,
    "airport_fee": 0.0,
    "source_file_name": "yellow_tripdata_2025-01.parquet",
    "pickup_year": 2025,
    "pickup_month": 1,
    "trip_duration_minutes": 10,
}


def silver_rows(spark, *changes: dict):
    """Rows in the silver schema: a good trip with the given changes."""
    rows = [{**GOOD, **change} for change in changes]
    return spark.createDataFrame([tuple(r[n] for n in SILVER_SCHEMA.names) for r in rows], SILVER_SCHEMA)


RAW_YELLOW = {
    "VendorID": 1,
    "tpep_pickup_datetime": START,
    "tpep_dropoff_datetime": START + timedelta(minutes=10),
    "passenger_count": 2,
    "trip_distance": 3.5,
    "RatecodeID": 1.0,
    "store_and_fwd_flag": "N",
    "PULocationID": 10,
    "DOLocationID": 20,
    "payment_type": 1,
    "fare_amount": 12.0,
    "extra": 0.5,
    "mta_tax": 0.5,
    "tip_amount": 2.0,
    "tolls_amount": 0.0,
    "improvement_surcharge": 0.3,
    "total_amount": 15.3,
    "congestion_surcharge": 0.0,
    "Airport_fee": 0.0,
}


def raw_file(path, *changes: dict, service: str = "yellow", drop: tuple[str, ...] = ()) -> str:
    """One real monthly parquet file with raw rows, as a publisher would deliver it."""
    rows = [{**RAW_YELLOW, **change} for change in changes]
    if service == "green":
        rows = [
            {name.replace("tpep_", "lpep_"): value for name, value in row.items() if name != "Airport_fee"}
            for row in rows
        ]
    rows = [{name: value for name, value in row.items() if name not in drop} for row in rows]
    path.parent.mkdir(parents=True, exist_ok=True)
    table = pa.Table.from_pylist(rows)
    for index, field in enumerate(table.schema):
        if pa.types.is_timestamp(field.type):
            column = table.column(index).cast(pa.timestamp("us"))
            table = table.set_column(index, field.name, column)
    pq.write_table(table, path)
    return str(path)


def zone_csv(path) -> str:
    path.write_text(
        "LocationID,Borough,Zone,service_zone\n"
        "10,Queens,Baisley Park,Boro Zone\n20,Bronx,Bronx Park,Boro Zone\n264,Unknown,N/A,N/A\n"
    )
    return str(path)
