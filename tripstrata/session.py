"""Session settings the queries rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Trip times carry no zone and are read as UTC. HotSpot never compiles methods above 8000 bytes, so
# wide projections fused into a larger one would run interpreted; beyond that limit Spark compiles
# the operators one by one. A task that writes up to 32 partitions keeps a file of each open instead of sorting all its
# rows; beyond that Spark sorts.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.maxConcurrentOutputFileWriters": "32",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark
