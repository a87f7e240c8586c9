"""Listing and scanning raw monthly trip files.

A monthly file is one parquet file, or a folder of part files carrying the file's name. Its service
is the folder it lies in (`<service>/<name>` or `service_type=<service>/source_file_name=<name>`).
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripstrata.functions.trips import file_period
from tripstrata.functions.values import typed_value
from tripstrata.schemas import MONTH_COLUMNS, RAW_TYPES, TRIP_FIELDS, ZONE_LOOKUP_SCHEMA
from tripstrata.sources.catalog import inferred_schema
from tripstrata.sources.scope import Scope, services_without_files

# Path of a monthly file: its own path, its service folder and its name. A folder named like a file is no service.
_MONTHLY_FILE = (
    r"^(.*/(?:service_type=)?((?![^/]*\.parquet/)[^/=]+)/(?:source_file_name=)?([^/=]+\.parquet))(?:/[^/]+\.parquet)?$"
)
# The name of a monthly file in the path of the file or of one of its parts.
NAME_IN_PATH = r"(?:^|/)(?:source_file_name=)?([^/=]+\.parquet)(?:/[^/]+\.parquet)?$"

FILE_SCHEMA = "path string, modified timestamp, length bigint"


class BadFilesError(ValueError):
    """Monthly files that can't be stored: (path, reason) each."""

    def __init__(self, failures: list[tuple[str, str]]) -> None:
        super().__init__("; ".join(f"{path}: {reason}" for path, reason in failures))
        self.failures = failures


def _is_missing(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def list_files(spark: SparkSession, *roots: str, names: str = "*.parquet") -> DataFrame:
    """`path`, `modified` and `length` of every file so named under the roots; a root that does not exist holds none.

    The paths stay in Spark: this is the file index of a scan whose content column is not read.
    """
    listed = spark.createDataFrame([], FILE_SCHEMA)
    for root in roots:
        try:
            index = (
                spark.read.format("binaryFile")
                .option("recursiveFileLookup", "true")
                .option("pathGlobFilter", names)
                .load(root)
            )
        except AnalysisException as error:
            if not _is_missing(error):
                raise
            continue
        listed = listed.unionByName(index.select("path", F.col("modificationTime").alias("modified"), "length"))
    return listed


def monthly_files(files: DataFrame, default_year: int, default_month: int) -> DataFrame:
    """One row per monthly file: `path, service_type, source_file_name, pickup_year, pickup_month`."""
    named = files.select(
        F.regexp_extract("path", _MONTHLY_FILE, 1).alias("path"),
        F.regexp_extract("path", _MONTHLY_FILE, 2).alias("service_type"),
        F.regexp_extract("path", _MONTHLY_FILE, 3).alias("source_file_name"),
    ).distinct()
    return with_period(named.filter("source_file_name != ''"), default_year, default_month)


def monthly_parts(files: DataFrame, default_year: int, default_month: int) -> DataFrame:
    """One row per file on storage, which is a monthly file or a part of one: its own `path`, and as in `monthly_files`."""
    named = files.select(
        "path",
        F.regexp_extract("path", _MONTHLY_FILE, 2).alias("service_type"),
        F.regexp_extract("path", _MONTHLY_FILE, 3).alias("source_file_name"),
    ).distinct()
    return with_period(named.filter("source_file_name != ''"), default_year, default_month)


def with_period(df: DataFrame, default_year: int, default_month: int) -> DataFrame:
    """`df` with `pickup_year` and `pickup_month` of its `source_file_name`."""
    year, month = file_period(F.col("source_file_name"), default_year, default_month)
    return df.withColumns({"pickup_year": year, "pickup_month": month})


def enrich(trips: DataFrame, service: Column, default_year: int, default_month: int) -> DataFrame:
    """The bronze lineage columns on rows that carry `source_file_name`."""
    return with_period(
        trips.withColumns({"service_type": service, "ingested_at_utc": F.current_timestamp()}),
        default_year,
        default_month,
    )


def _with_lineage(trips: DataFrame, service: str, default_year: int, default_month: int) -> DataFrame:
    """Scanned rows with the bronze lineage columns.

    Name and period are worked out once per file and joined to the rows by its path: taking the path apart for every
    row cost more than reading and writing the row.
    """
    spark = trips.sparkSession
    # The listing that the scan holds, without another look at storage. It writes `file:///a` where rows have `file:/a`.
    listed = {written for path in trips.inputFiles() for written in (path, re.sub("^([^:/]+):///", r"\1:/", path))}
    paths = spark.createDataFrame([(path,) for path in sorted(listed)], "scanned_path string")
    folder = F.substring_index(F.substring_index("scanned_path", "/", -2), "/", 1)
    name = F.when(F.endswith(folder, F.lit(".parquet")), F.substring_index(folder, "=", -1)).otherwise(F.substring_index("scanned_path", "/", -1))
    named = with_period(paths.withColumn("source_file_name", name), default_year, default_month)
    unknown = F.raise_error(F.concat(F.lit("Not in the listing: "), "scanned_path")).cast("string")
    lineage = ("source_file_name", "service_type", "ingested_at_utc", *MONTH_COLUMNS)
    rows = trips.drop(*lineage).withColumn("scanned_path", F.col("_metadata.file_path"))
    return (
        rows.join(F.broadcast(named), "scanned_path", "left")
        .withColumns(
            {
                "source_file_name": F.coalesce("source_file_name", unknown),
                "service_type": F.lit(service),
                "ingested_at_utc": F.current_timestamp(),
            }
        )
        .drop("scanned_path")
    )


Schemas = Mapping[str, T.StructType | str]


def _schemas(spark: SparkSession, files: list[tuple[str, str]], known: Schemas) -> list[T.StructType | str]:
    """Schema of each (service, path), or why it can't be stored. Footers that `known` lacks are read a few at a time."""

    def schema(file: tuple[str, str]) -> T.StructType | str:
        service, path = file
        found = known[path] if path in known else inferred_schema(spark, path)
        if isinstance(found, str):
            return found
        names = {name.lower() for name in found.names}
        needed = [f.source[service] for f in TRIP_FIELDS if f.required and service in f.source]
        missing = [name for name in needed if name.lower() not in names]
        return f"missing column {', '.join(missing)}" if missing else found

    with ThreadPoolExecutor(max_workers=16) as pool:
        return list(pool.map(schema, files))


def bad_files(spark: SparkSession, files: Iterable[tuple[str, str]], known: Schemas | None = None) -> list[tuple[str, str]]:
    """(path, reason) of files, given as (service, path), that are unreadable or lack a column the rules need."""
    files = sorted(set(files))
    found = zip(files, _schemas(spark, files, known or {}), strict=True)
    return [(path, schema) for (_, path), schema in found if isinstance(schema, str)]


def _common_type(types: set[T.DataType]) -> str:
    if len(types) == 1:
        return next(iter(types)).simpleString()
    if all(isinstance(t, T.IntegralType) for t in types):
        return "bigint"
    if all(isinstance(t, T.NumericType) for t in types):
        return "double"
    return "string"


def scan_trips(
    spark: SparkSession,
    files: Iterable[tuple[str, str]],
    default_year: int,
    default_month: int,
    known: Schemas | None = None,
) -> DataFrame:
    """Bronze rows of monthly files, or of their parts, given as (service, path).

    A single parquet read fails on files that disagree on a type (passenger_count is bigint in
    some months, double in others). So files of equal service and schema are read together, known
    columns take their bronze type, and the few reads are united by name with NULL for columns a
    file lacks. Columns outside the known ones are kept. Parts of one month may differ as files do. A file that
    can't be read or lacks a column the rules need stops the scan before anything is written. `known` has schemas that
    are catalogued (`catalog.file_schemas`).
    """
    files = sorted(set(files))
    schemas = _schemas(spark, files, known or {})
    if failures := [(path, s) for (_, path), s in zip(files, schemas, strict=True) if isinstance(s, str)]:
        raise BadFilesError(failures)
    groups: dict[tuple[str, str], tuple[T.StructType, list[str]]] = {}
    for (service, path), schema in zip(files, schemas, strict=True):
        ordered = sorted((f.name.lower(), f.dataType.simpleString()) for f in schema.fields)
        groups.setdefault((service, str(ordered)), (schema, []))[1].append(path)
    return unite_trips(
        [
            _with_lineage(
                spark.read.option("recursiveFileLookup", "true").schema(schema).parquet(*paths),
                service,
                default_year,
                default_month,
            )
            for (service, _), (schema, paths) in groups.items()
        ]
    )


def unite_trips(frames: list[DataFrame]) -> DataFrame:
    """Raw frames of differing schemas as one, known columns in their bronze types."""
    known = {name.lower(): (name, kind) for name, kind in RAW_TYPES.items()}
    extra_types: dict[str, set[T.DataType]] = {}
    for df in frames:
        for field in df.schema.fields:
            if field.name.lower() not in known:
                extra_types.setdefault(field.name.lower(), set()).add(field.dataType)

    def bronze_column(field: T.StructField) -> Column:
        name, kind = known.get(field.name.lower(), (field.name.lower(), None))
        kind = kind or _common_type(extra_types[field.name.lower()])
        return typed_value(F.col(f"`{field.name}`"), field.dataType, kind).alias(name)

    typed = [df.select(*[bronze_column(field) for field in df.schema.fields]) for df in frames]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), typed)


def read_zone_lookup(spark: SparkSession, path: str) -> DataFrame:
    """The raw zone lookup CSV, every column as text."""
    return spark.read.schema(ZONE_LOOKUP_SCHEMA).option("header", True).csv(path)


def require_input_files(
    spark: SparkSession, files: DataFrame, scope: Scope, zone_lookup: str
) -> None:
    """Stop when a service of the scope has no file at all, or the zone lookup is missing."""
    requested = scope.grid(spark).select("service_type")
    missing = [row.service_type for row in services_without_files(requested, files).collect()]
    if missing:
        raise FileNotFoundError(f"No parquet files found for services: {', '.join(sorted(missing))}")
    try:
        read_zone_lookup(spark, zone_lookup)
    except AnalysisException as error:
        if not _is_missing(error):
            raise
        raise FileNotFoundError(f"Missing taxi zone lookup file: {zone_lookup}") from error
