"""Where queries that write put their tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

from tripstrata.sources.trip_files import list_files


def work_dir(spark: SparkSession, label: str) -> str:
    """A new folder path under the shared folder named by `spark.checkpoint.dir`.

    Only a local session without that setting falls back to a temporary folder of the machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("Set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="tripstrata-")
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def set_file_times(spark: SparkSession, folder: str, milliseconds: Callable[[str], int]) -> None:
    """Date the data files under a folder by their paths, as files that were delivered at some other time."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for row in list_files(spark, folder, names="part-*").select("path").collect():
        path = jvm.org.apache.hadoop.fs.Path(row.path)
        path.getFileSystem(conf).setTimes(path, milliseconds(row.path), -1)
