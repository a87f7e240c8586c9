"""Conversions of raw values to typed columns.

A value that cannot be converted becomes NULL whatever the session's ANSI setting. NaN becomes 0
and fractions are cut off where an integer is wanted, as in the classic integer cast.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INTEGERS = ("int", "bigint")
_DECIMAL_TEXT = r"^\s*[+-]?\d+(\.\d*)?\s*$"


def _whole_number(column: Column, data_type: T.DataType, target: str) -> Column:
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        return F.nanvl(column, F.lit(0.0)).try_cast(target)
    if isinstance(data_type, T.StringType):
        whole_part = F.substring_index(F.trim(column), ".", 1)
        return F.when(column.rlike(_DECIMAL_TEXT), whole_part.try_cast(target))
    return column.try_cast(target)


def typed_value(column: Column, data_type: T.DataType, target: str) -> Column:
    """`column`, whose type is `data_type`, as `target` (a type name used in `schemas`)."""
    if data_type.simpleString() == target:
        return column
    if target in _INTEGERS:
        return _whole_number(column, data_type, target)
    if target == "timestamp" and isinstance(data_type, T.StringType):
        return F.try_to_timestamp(column)
    if target == "timestamp" and isinstance(data_type, (T.TimestampNTZType, T.DateType)):
        return column.cast(target)
    return column.try_cast(target)
