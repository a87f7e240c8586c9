"""A stored catalogue of raw files: what each file's footer says, read once.

A file is known by path, modification time and length; one that changes is a new file. New files are found by an anti
join of the listing with the catalogue, their footers are read by tasks, a few kilobytes each, and appended. Where
pyarrow cannot open a file in a task, or names a type otherwise, Spark's own reader infers the schema, a few files at a
time.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_schema

KEY = ["path", "modified", "length"]
CATALOG_SCHEMA = "path string, modified timestamp, length bigint, columns string, fault string"
UNREADABLE, GONE = "unreadable", "missing"

# Spark's error conditions, and Parquet's own text, for a file that is no readable Parquet file.
_NO_PARQUET = re.compile("CANNOT_READ_FILE_FOOTER|FAILED_READ_FILE|UNABLE_TO_INFER_SCHEMA|is not a Parquet file")

#: Where Spark's writers keep the schema of a file.
_SPARK_SCHEMA = b"org.apache.spark.sql.parquet.row.metadata"
#: Files whose footers one task reads.
_FILES_A_TASK = 200


def _opened(path: str) -> pa.NativeFile:
    scheme, rest = re.match(r"(?:([a-zA-Z][a-zA-Z0-9+.-]*):)?(.*)$", path).groups()
    if scheme in (None, "file"):
        return pa.fs.LocalFileSystem().open_input_file(re.sub("^//", "", rest))
    authority, inner = re.match(r"//([^/]*)(.*)$", rest).groups()
    if scheme in ("s3", "s3a", "s3n", "gs"):
        system, _ = pa.fs.FileSystem.from_uri(f"{'gs' if scheme == 'gs' else 's3'}://{authority}/")
        return system.open_input_file(authority + inner)
    system, _ = pa.fs.FileSystem.from_uri(f"{scheme}://{authority}/")
    return system.open_input_file(inner)


def _nullable(part: dict) -> dict:
    """Columns of files may be null whatever was written, as Spark takes them."""
    return {k: True if k in ("nullable", "containsNull", "valueContainsNull") else v for k, v in part.items()}


def _footer(path: str) -> tuple[str | None, str | None]:
    """(schema as JSON, fault) of a file; neither if only Spark can tell."""
    try:
        with _opened(path) as file:
            found = pq.ParquetFile(file)
            written = (found.metadata.metadata or {}).get(_SPARK_SCHEMA)
            if written:
                return json.dumps(json.loads(written, object_hook=_nullable)), None
            columns = found.schema_arrow
            if any(pa.types.is_timestamp(c.type) and c.type.unit == "ns" for c in columns):
                return None, None
            return from_arrow_schema(columns, prefer_timestamp_ntz=True).json(), None
    except FileNotFoundError:
        return None, GONE
    except pa.ArrowInvalid as error:
        return (None, UNREADABLE) if re.search("Parquet|footer", str(error)) else (None, None)
    except Exception:  # a type that Spark names otherwise, or a file system unknown to pyarrow
        return None, None


def _footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [_footer(path) for path in batch.column(0).to_pylist()]
        columns, faults = (pa.array([row[k] for row in found], pa.string()) for k in (0, 1))
        yield pa.RecordBatch.from_arrays([*batch.columns, columns, faults], names=[*KEY, "columns", "fault"])


def inferred_schema(spark: SparkSession, path: str) -> T.StructType | str:
    """The schema of a file, or of a folder of parts, as Spark reads it; a text says why it has none."""
    try:
        return spark.read.option("recursiveFileLookup", "true").parquet(path).schema
    except Exception as error:  # Spark tells of a bad footer by several classes, some from the JVM
        if _NO_PARQUET.search(str(error)):
            return UNREADABLE
        raise


def read_footers(files: DataFrame) -> DataFrame:
    """The listed files (`path, modified, length`) with `columns`, the schema as JSON, or `fault`; read by tasks."""
    spark = files.sparkSession
    keys = files.select(*KEY).persist()
    try:
        number = keys.count()
        tasks = max(1, min(number // 16, spark.sparkContext.defaultParallelism), number // _FILES_A_TASK)
        found = keys.repartition(tasks).mapInArrow(_footers, CATALOG_SCHEMA).persist()
        open_ = [row.path for row in found.filter("columns IS NULL AND fault IS NULL").select("path").collect()]
    finally:
        keys.unpersist()
    if not open_:
        return found
    with ThreadPoolExecutor(max_workers=16) as pool:
        schemas = list(pool.map(lambda path: inferred_schema(spark, path), open_))
    rows = [(p, None, x) if isinstance(x, str) else (p, x.json(), None) for p, x in zip(open_, schemas, strict=True)]
    inferred = spark.createDataFrame(rows, "path string, columns string, fault string")
    told = files.select(*KEY).join(inferred, "path").select(*KEY, "columns", "fault")
    return found.filter("columns IS NOT NULL OR fault IS NOT NULL").unionByName(told)


def read_catalog(spark: SparkSession, store: str) -> DataFrame:
    """All entries; none if nothing has been catalogued."""
    try:
        return spark.read.schema(CATALOG_SCHEMA).parquet(store)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], CATALOG_SCHEMA)


def update_catalog(spark: SparkSession, files: DataFrame, store: str) -> list[str]:
    """Add the footers of the listed files (`path, modified, length`) that the catalogue lacks; returns their paths.

    What vanished meanwhile is not recorded. A repeated call adds nothing; two calls at once may add an entry twice,
    which readers do not notice.
    """
    new = files.select(*KEY).join(read_catalog(spark, store).select(*KEY), KEY, "left_anti")
    paths = [row.path for row in new.select("path").collect()]
    if paths:
        read_footers(new).filter(f"columns IS NOT NULL OR fault = '{UNREADABLE}'").write.mode("append").parquet(store)
    return paths


def file_schemas(spark: SparkSession, files: DataFrame, store: str) -> dict[str, T.StructType | str]:
    """Schema of each listed file, or why it can't be read, by path."""
    update_catalog(spark, files, store)
    entries = read_catalog(spark, store).join(files.select(*KEY), KEY, "left_semi")
    return {
        row.path: T.StructType.fromJson(json.loads(row.columns)) if row.columns else row.fault
        for row in entries.select("path", "columns", "fault").distinct().collect()
    }
