"""Keys, labels and display text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def padded_key(prefix: str, number: Column, width: int) -> Column:
    """``prefix`` followed by a zero-padded number; longer numbers are kept whole."""
    digits = number.cast("string")
    padded = F.when(F.length(digits) >= width, digits).otherwise(F.lpad(digits, width, "0"))
    return F.concat(F.lit(prefix), padded)


def month_label(year: Column, month: Column) -> Column:
    """``YYYY-MM``."""
    return F.concat(year.cast("string"), F.lit("-"), F.lpad(month.cast("string"), 2, "0"))


def growth_status(growth: Column) -> Column:
    """Trend word for a growth percentage."""
    return (
        F.when(growth > 0, "GROWTH")
        .when(growth < 0, "DECLINE")
        .when(growth == 0, "FLAT")
        .otherwise("BASELINE")
    )


def growth_direction(growth: Column) -> Column:
    """``up``, ``down`` or ``none``."""
    return F.when(growth > 0, "up").when(growth < 0, "down").otherwise("none")


def compact_currency(value: Column) -> Column:
    """``$1.23M``, ``$4.5K`` or ``$6.78``."""
    exact = value.cast("decimal(22,2)")
    return (
        F.when(exact >= 1_000_000, F.concat(F.lit("$"), F.round(exact / 1_000_000, 2).cast("decimal(20,2)").cast("string"), F.lit("M")))
        .when(exact >= 1_000, F.concat(F.lit("$"), F.round(exact / 1_000, 1).cast("decimal(20,1)").cast("string"), F.lit("K")))
        .otherwise(F.concat(F.lit("$"), exact.cast("string")))
    )


def thousands(value: Column) -> Column:
    """Whole number with thousands separators."""
    return F.format_number(value, 0)


def full_currency(value: Column) -> Column:
    """Money with thousands separators and two places."""
    return F.concat(F.lit("$"), F.format_number(value, 2))


def signed_percent(value: Column) -> Column:
    """``+1.25%`` or ``-0.40%``; a dash when there is no value."""
    text = F.concat(F.when(value >= 0, "+").otherwise(""), value.cast("decimal(20,2)").cast("string"), F.lit("%"))
    return F.coalesce(text, F.lit("—"))
