"""Lenient casts: a value that does not parse becomes NULL, never an error."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def to_number(column: Column, source: T.DataType) -> Column:
    """Text to DOUBLE, NULL when it is no number."""
    if isinstance(source, T.StringType):
        return column.try_cast("double")
    return column.cast("double")


def to_moment(column: Column, source: T.DataType, formats: Sequence[str]) -> Column:
    """Text to a timestamp by the first format that fits; timestamps pass through."""
    if isinstance(source, (T.TimestampType, T.TimestampNTZType)):
        return column
    if isinstance(source, T.DateType):
        return column.cast("timestamp")
    return F.coalesce(*[F.try_to_timestamp(column.cast("string"), F.lit(f)) for f in formats])
