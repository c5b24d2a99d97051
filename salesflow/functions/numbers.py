"""Exact ratios, ranges and NaN handling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesflow.rules import MONEY, PERCENT

_WIDE = "decimal(28,2)"


def ratio_half_up(numerator: Column, denominator: Column, digits: int = 2) -> Column:
    """``numerator / denominator`` rounded half away from zero to ``digits`` places.

    A decimal division is itself rounded before ``round`` sees it, so a quotient
    next to a half can land on the wrong side. Integer division of scaled
    decimals has no such step. NULL when the denominator is NULL or zero.
    """
    top = numerator.cast(_WIDE)
    bottom = F.nullif(F.abs(denominator.cast(_WIDE)), F.lit(0))
    scaled = F.abs(top) * F.lit(2 * 10**digits) + bottom
    units = F.call_function("div", scaled, bottom * F.lit(2))
    sign = F.when((numerator < 0) != (denominator < 0), -1).otherwise(1)
    return (units * sign).cast("decimal(20,0)") * F.lit(10**-digits).cast(f"decimal({digits + 1},{digits})")


def average_money(total: Column, count: Column) -> Column:
    """Mean of a decimal total, to the cent."""
    return ratio_half_up(total, count).cast(MONEY)


def percent_of(part: Column, whole: Column) -> Column:
    """Share of a total in percent, two places."""
    return ratio_half_up(part.cast(_WIDE) * 100, whole).cast(PERCENT)


def growth_percent(current: Column, previous: Column) -> Column:
    """Change against a previous value in percent; NULL unless the previous value is positive."""
    return F.when(previous > 0, percent_of(current - previous, previous))


def clip(value: Column, low: float, high: float) -> Column:
    """Limit a value to ``[low, high]``; NULL stays NULL."""
    return F.when(value.isNotNull(), F.greatest(F.least(value, F.lit(high)), F.lit(low)))


def _finite(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        infinite = F.abs(value) == F.lit(float("inf"))
        return F.when(F.isnan(value) | infinite, None).otherwise(value)
    if isinstance(kind, T.ArrayType) and _has_float(kind):
        return F.transform(value, lambda item: _finite(item, kind.elementType))
    if isinstance(kind, T.StructType) and _has_float(kind):
        fields = [_finite(value[f.name], f.dataType).alias(f.name) for f in kind.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(kind, T.MapType) and _has_float(kind):
        return F.transform_values(value, lambda _, item: _finite(item, kind.valueType))
    return value


def _has_float(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _has_float(kind.elementType)
    if isinstance(kind, T.MapType):
        return _has_float(kind.valueType)
    if isinstance(kind, T.StructType):
        return any(_has_float(f.dataType) for f in kind.fields)
    return isinstance(kind, (T.DoubleType, T.FloatType))


def nan_to_null(df: DataFrame) -> DataFrame:
    """Replace NaN and infinities by NULL in every float, also inside arrays, structs and map values."""
    return df.select(*[_finite(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields])
