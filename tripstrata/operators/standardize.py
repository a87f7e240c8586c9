"""Raw trips of any service to the one silver schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripstrata.functions.trips import trip_duration_minutes
from tripstrata.functions.values import typed_value
from tripstrata.schemas import SERVICES, TRIP_FIELDS, TripField


def check_services(services: Sequence[str]) -> None:
    unknown = sorted(set(services) - set(SERVICES))
    if unknown:
        raise ValueError(f"Unsupported service_type: {', '.join(unknown)}")


def _service_column(services: Sequence[str]) -> Column:
    if len(services) == 1:
        return F.lit(services[0])
    service = F.col("service_type")
    unsupported = F.raise_error(F.concat(F.lit("Unsupported service_type: "), service))
    return F.when(service.isin(*services), service).otherwise(unsupported.cast("string"))


def _field_value(trips: DataFrame, field: TripField, services: Sequence[str]) -> Column:
    types = {f.name.lower(): f.dataType for f in trips.schema.fields}

    def value(source: str | None) -> Column:
        if source is None or source.lower() not in types:
            if source is not None and field.required:
                raise ValueError(f"Source column {source} is missing; the silver rules need it")
            return F.lit(None).cast(field.kind)
        return typed_value(F.col(source), types[source.lower()], field.kind)

    by_source: dict[str | None, list[str]] = {}
    for service in services:
        by_source.setdefault(field.source.get(service), []).append(service)
    if len(by_source) == 1:
        return value(next(iter(by_source)))
    return F.coalesce(
        *[
            F.when(F.col("service_type").isin(*users), value(source))
            for source, users in by_source.items()
        ]
    )


def standardize(trips: DataFrame, services: Sequence[str] = SERVICES) -> DataFrame:
    """`trips` in the silver schema, unfiltered.

    With one service the frame needs no `service_type`. With several, the frame mixes their rows
    and `service_type` tells per row which source columns apply, so one pass serves all services.
    Optional source columns may be absent (NULL); columns the rules need may not.
    """
    check_services(services)
    return trips.select(
        _service_column(services).alias("service_type"),
        *[_field_value(trips, field, services).alias(field.name) for field in TRIP_FIELDS],
        F.col("source_file_name"),
        F.col("pickup_year").cast("int").alias("pickup_year"),
        F.col("pickup_month").cast("int").alias("pickup_month"),
    ).withColumn("trip_duration_minutes", trip_duration_minutes())
