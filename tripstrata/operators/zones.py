"""The zone lookup and its join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripstrata.functions.values import typed_value

UNKNOWN = "Unknown"


def zone_lookup(raw_zones: DataFrame) -> DataFrame:
    """`location_id, borough, zone`; a location id that is no number becomes NULL."""
    id_type = raw_zones.schema["LocationID"].dataType
    return raw_zones.select(
        typed_value(F.col("LocationID"), id_type, "int").alias("location_id"),
        F.col("Borough").alias("borough"),
        F.col("Zone").alias("zone"),
    )


def _one_row_per_location(zones: DataFrame) -> DataFrame:
    """The lookup with unique ids; a repeated id, which would multiply trips, stops the query."""
    repeated = F.raise_error(
        F.concat(F.lit("Zone lookup repeats location_id "), F.col("location_id").cast("string"))
    ).cast("string")
    return (
        zones.filter("location_id IS NOT NULL")
        .groupBy("location_id")
        .agg(
            F.first("borough").alias("borough"),
            F.first("zone").alias("zone"),
            F.count(F.lit(1)).alias("entries"),
        )
        .select(
            "location_id",
            F.when(F.col("entries") > 1, repeated).otherwise(F.col("borough")).alias("borough"),
            F.when(F.col("entries") > 1, repeated).otherwise(F.col("zone")).alias("zone"),
        )
    )


def attach_zones(df: DataFrame, zones: DataFrame) -> DataFrame:
    """`df` with `borough` and `zone` of its `pu_location_id`, "Unknown" where the lookup has none.

    No broadcast is forced: Spark broadcasts the lookup when its size allows.
    """
    lookup = _one_row_per_location(zones)
    return (
        df.join(lookup, df["pu_location_id"] == lookup["location_id"], "left")
        .drop("location_id")
        .withColumns(
            {name: F.coalesce(F.col(name), F.lit(UNKNOWN)) for name in ("borough", "zone")}
        )
    )
