"""The processing scope: which services, years and months a run covers."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripstrata.operators.standardize import check_services


@dataclass(frozen=True)
class Scope:
    services: tuple[str, ...]
    years: tuple[int, ...]
    months: tuple[int, ...]

    @classmethod
    def of(cls, services: Iterable[str], years: Iterable[int], months: Iterable[int]) -> Scope:
        """Lists in any order, with repeats, to a sorted scope without them."""
        scope = cls(*[tuple(sorted(set(values))) for values in (services, years, months)])
        if not (scope.services and scope.years and scope.months):
            raise ValueError("A scope needs at least one service, year and month")
        check_services(scope.services)
        return scope

    def sample(self) -> Scope:
        """The small trial scope: the first year's January."""
        return Scope(self.services, self.years[:1], (1,))

    def grid(self, spark: SparkSession) -> DataFrame:
        lists = {name: list(getattr(self, name)) for name in ("services", "years", "months")}
        return scope_grid(
            spark.range(1).select(*[F.lit(values).alias(name) for name, values in lists.items()])
        )


def scope_grid(lists: DataFrame) -> DataFrame:
    """Every (service_type, year, month) of rows holding `services`, `years` and `months` arrays."""
    return (
        lists.select(F.explode("services").alias("service_type"), "years", "months")
        .select("service_type", F.explode("years").alias("year"), "months")
        .select("service_type", "year", F.explode("months").alias("month"))
        .distinct()
    )


def in_scope(df: DataFrame, grid: DataFrame) -> DataFrame:
    """Rows whose service, pickup_year and pickup_month are in the scope grid."""
    return df.join(_as_partitions(grid), ["service_type", "pickup_year", "pickup_month"], "left_semi")


def out_of_scope(df: DataFrame, grid: DataFrame) -> DataFrame:
    """Rows of the scope's services whose period is outside it."""
    services = grid.select("service_type").distinct()
    return df.join(services, "service_type", "left_semi").join(
        _as_partitions(grid), ["service_type", "pickup_year", "pickup_month"], "left_anti"
    )


def _as_partitions(grid: DataFrame) -> DataFrame:
    return grid.select(
        "service_type", F.col("year").alias("pickup_year"), F.col("month").alias("pickup_month")
    )


def services_without_files(services: DataFrame, files: DataFrame) -> DataFrame:
    """Requested services that no listed file belongs to."""
    return services.select("service_type").distinct().join(files, "service_type", "left_anti")
