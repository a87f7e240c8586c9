"""The published contract against the files of a stored table, as a consumer finds them.

Reads impose a fixed schema, under which a file of other types fails or, worse, reads as something else. So types are
taken from the files' own footers, and rows are read only where the columns of the grain are as promised.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripstrata.sources.catalog import read_footers
from tripstrata.sources.trip_files import list_files

_FIELDS = "struct<fields:array<struct<name:string,type:string>>>"
#: Names of types in schemas written as JSON, where they are not those of SQL.
_SQL_NAMES = {"long": "bigint", "integer": "int", "short": "smallint", "byte": "tinyint"}


def _partition_value(field: T.StructField) -> Column:
    return F.regexp_extract("path", f"/{field.name}=([^/]+)/", 1).try_cast(field.dataType).alias(field.name)


def stored_columns(spark: SparkSession, path: str) -> DataFrame:
    """`path, column_name, actual_type` of every column of every file under `path`, and `fault` of unreadable files."""
    footers = read_footers(list_files(spark, path))
    fields = footers.select("path", "fault", F.explode_outer(F.from_json("columns", _FIELDS)["fields"]).alias("field"))
    kind = F.col("field.type")
    named = F.coalesce(*[F.when(kind == json_name, name) for json_name, name in _SQL_NAMES.items()], kind)
    return fields.select("path", F.col("field.name").alias("column_name"), named.alias("actual_type"), "fault")


def contract_violations(
    spark: SparkSession, path: str, contract: T.StructType, partitioned_by: tuple[str, ...], grain: tuple[str, ...]
) -> DataFrame:
    """Where a stored table departs from its contract, by partition; no rows when it does not.

    (partition columns, problem, column_name, expected_type, actual_type, row_count): `type` and `missing` count files,
    `unreadable` files too, `repeated` the keys of the grain that occur more than once. Columns beyond the promised
    ones are no departure.
    """
    keys = [contract[name] for name in partitioned_by]
    promised = [f for f in contract.fields if f.name not in partitioned_by]
    found = stored_columns(spark, path).persist()
    try:
        files = found.groupBy("path").agg(
            F.map_from_entries(F.collect_list(F.when(F.col("column_name").isNotNull(), F.struct("column_name", "actual_type")))).alias("types"),
            F.max("fault").alias("fault"),
        )
        wanted = F.array(*[F.struct(F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("expected_type")) for f in promised])
        actual = F.col("types")[F.col("column_name")]
        checked = files.select("path", "types", "fault", F.inline(wanted)).withColumn("actual_type", actual)
        problem = F.when(F.col("fault").isNotNull(), F.col("fault")).when(actual.isNull(), "missing").when(actual != F.col("expected_type"), "type")
        departed = checked.withColumn("problem", problem).filter("problem IS NOT NULL")
        by_file = F.col("fault").isNotNull()  # one line for an unreadable file, not one a column
        listed = departed.select(
            *map(_partition_value, keys),
            "path",
            "problem",
            *(F.when(~by_file, F.col(c)).alias(c) for c in ("column_name", "expected_type", "actual_type")),
        )
        of_files = listed.groupBy(*partitioned_by, "problem", "column_name", "expected_type", "actual_type").agg(F.countDistinct("path").alias("row_count"))
        of_grain = departed.filter(F.col("column_name").isin(list(grain))).select("path").distinct()
        readable = [row.path for row in files.select("path").join(of_grain, "path", "left_anti").collect()]
        of_files = spark.createDataFrame(of_files.collect(), of_files.schema)  # at most a few lines a partition
    finally:
        found.unpersist()
    if not readable:
        return of_files
    types = T.StructType([contract[name] for name in dict.fromkeys((*grain, *partitioned_by))])
    rows = spark.read.schema(types).option("basePath", path).parquet(*readable)
    repeated = rows.groupBy(*grain).count().filter("count > 1").groupBy(*partitioned_by).agg(F.count(F.lit(1)).alias("row_count"))
    none = F.lit(None).cast("string")
    return of_files.unionByName(
        repeated.withColumns({"problem": F.lit("repeated"), "column_name": none, "expected_type": none, "actual_type": none})
    )
