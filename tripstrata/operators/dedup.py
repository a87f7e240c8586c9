"""De-duplication of trips inside one service and file month."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tripstrata.functions.trips import HASH_TIME_COLUMNS, HASH_VALUE_COLUMNS
from tripstrata.schemas import PARTITION_COLUMNS, SILVER_SCHEMA


def trip_identity() -> dict[str, Column]:
    """The values the record hash covers, as plain columns.

    Two rows with known times share them exactly when their hashes are equal, and they spare the
    date formatting, the SHA-256 and 64 shuffled bytes per row. The pickup second comes first: it
    decides nearly every comparison of a sort. `zero_sign` parts -0.0 from 0.0, which are equal as
    numbers but not as hashed text.
    """
    zero = F.col("trip_distance") == 0
    return {
        **{name: F.date_trunc("second", name) for name in HASH_TIME_COLUMNS},
        **{name: F.col(name) for name in PARTITION_COLUMNS},
        "vendor_id": F.col("vendor_id"),
        **{name: F.col(name) for name in HASH_VALUE_COLUMNS},
        "zero_sign": F.when(zero, F.col("trip_distance").cast("string")),
    }


def deduplicate(trips: DataFrame) -> DataFrame:
    """One row per trip: the first by all values outside the identity, so reruns agree.

    `row_number() = 1` makes Spark keep one row per trip in each map task (WindowGroupLimit)
    before the shuffle, so any number of copies of one trip reaches the reducer as one row per task.
    """
    identity = trip_identity()
    rest = [
        name
        for name in SILVER_SCHEMA.names
        if name in HASH_TIME_COLUMNS or name not in (*identity, "trip_duration_minutes")
    ]
    first = Window.partitionBy(*identity.values()).orderBy(
        *[F.col(name).asc_nulls_first() for name in rest]
    )
    return (
        trips.withColumn("copy_rank", F.row_number().over(first))
        .filter("copy_rank = 1")
        .drop("copy_rank")
    )


def distinct_trips(trips: DataFrame) -> DataFrame:
    """De-duplicated trips reduced to the values all copies of a trip share, and their duration.

    Rules, gold tables and demand need nothing else, and for those values any survivor is as good
    as another: a plain `distinct` (partial aggregation, no sort, half the columns) replaces
    `deduplicate`. Its shuffle keeps every column, so several results in one query reuse it.
    """
    identity = [column.alias(name) for name, column in trip_identity().items()]
    return trips.select(*identity, "trip_duration_minutes").distinct()


def duplicate_summary(trips: DataFrame) -> DataFrame:
    """Rows, trips and removed copies per service and file month, from partial counts."""
    copies = trips.groupBy(*[c.alias(n) for n, c in trip_identity().items()]).agg(
        F.count(F.lit(1)).alias("copies")
    )
    return copies.groupBy(*PARTITION_COLUMNS).agg(
        F.sum("copies").alias("rows_before"),
        F.count(F.lit(1)).alias("rows_after"),
        (F.sum("copies") - F.count(F.lit(1))).alias("copies_removed"),
        F.max("copies").alias("most_copies"),
    )
