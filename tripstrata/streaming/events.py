"""File events: from file names, and from JSON messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripstrata.functions.trips import INCOMING_NAME_PATTERN
from tripstrata.schemas import FILE_EVENT_SCHEMA, SERVICES
from tripstrata.sources.trip_files import NAME_IN_PATH

# The event type and the accepted ranges.
NEW_FILE = "new_raw_file"
MONTHS = (1, 12)
YEARS = (2000, 2100)

_INTEGER_TEXT = r"^\s*[+-]?\d+\s*$"


def file_name_of(path: Column) -> Column:
    """The monthly file's name in a path; part files answer with the name of their folder."""
    return F.regexp_extract(path, NAME_IN_PATH, 1)


def classify_files(files: DataFrame) -> DataFrame:
    """An event for each `path` whose file name is accepted; `reject_reason` for the others."""
    name = F.col("file_name")
    accepted = name.rlike(INCOMING_NAME_PATTERN)

    def part(group: int, kind: str) -> Column:
        return F.when(accepted, F.regexp_extract(name, INCOMING_NAME_PATTERN, group).cast(kind))

    # The name pattern guarantees type, service and path, so only the period can still be wrong.
    reason = F.when(F.col("month").isNull(), "file_name_not_accepted").otherwise(_period_reason())
    return (
        files.select("path", file_name_of(F.col("path")).alias("file_name"))
        .select(
            "path",
            "file_name",
            F.when(accepted, NEW_FILE).alias("event_type"),
            part(1, "string").alias("service_type"),
            part(2, "int").alias("year"),
            part(3, "int").alias("month"),
            F.when(accepted, F.col("path")).alias("file_path"),
        )
        .withColumn("reject_reason", reason)
    )


def _period_reason() -> Column:
    return F.when(~F.col("month").between(*MONTHS), "invalid_month").when(
        ~F.col("year").between(*YEARS), "invalid_year"
    )


def _value_reason() -> Column:
    """The first rule an event's values break, NULL when it is valid."""
    return F.coalesce(
        F.when(F.col("event_type") != NEW_FILE, "unsupported_event_type"),
        F.when(~F.col("service_type").isin(*SERVICES), "unsupported_service_type"),
        _period_reason(),
        F.when(F.col("file_path") == "", "empty_file_path"),
    )


def _integer(text: Column) -> Column:
    return F.when(text.rlike(_INTEGER_TEXT), F.trim(text).try_cast("int"))


def parse_events(messages: DataFrame, payload: str = "payload") -> DataFrame:
    """Decode and validate JSON events: the message's columns, the event's, and `reject_reason`.

    Numbers may come as JSON numbers or as text. A message that is no JSON object, lacks a field,
    or carries a bad value is kept with the first reason it fails, in the order of decoding.
    """
    fields = FILE_EVENT_SCHEMA.names
    numbers = ("year", "month")
    # Each message is parsed once; every field is read from the parsed value as text.
    raw = messages.withColumn("_json", F.try_parse_json(payload)).withColumns(
        {f"_{name}": F.try_variant_get("_json", f"$.{name}", "string") for name in fields}
    )
    typed = raw.withColumns(
        {name: _integer(F.col(f"_{name}")) if name in numbers else F.col(f"_{name}") for name in fields}
    )
    is_object = F.schema_of_variant("_json").startswith("OBJECT<")
    reason = F.when(F.col("_json").isNull(), "not_json").when(~is_object, "not_an_object")
    for name in fields:
        reason = reason.when(F.col(f"_{name}").isNull(), f"missing_{name}")
        if name in numbers:
            reason = reason.when(F.col(name).isNull(), f"{name}_not_an_integer")
    return typed.select(
        *messages.columns, *fields, reason.otherwise(_value_reason()).alias("reject_reason")
    )


def unpublished(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Listed paths that the ledger of published paths does not hold."""
    return files.join(ledger.select("path"), "path", "left_anti")
