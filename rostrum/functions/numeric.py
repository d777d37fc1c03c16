"""Numeric expressions with explicit zero and rounding rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def guarded_ratio(numerator: Column, denominator: Column, digits: int | None = None) -> Column:
    """0 when the denominator is 0, NULL when it is NULL."""
    ratio = F.when(denominator == 0, F.lit(0.0)).otherwise(F.try_divide(numerator, denominator))
    return ratio if digits is None else F.round(ratio, digits)


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    """100 * part / whole, NULL when the whole is 0."""
    return F.round(100 * part / F.nullif(whole, F.lit(0)), digits)


def round_to_long(value: Column) -> Column:
    """Round half away from zero; a bare cast would cut the fraction off."""
    return F.round(value).cast("bigint")


def zero_unless(condition: Column, value: Column) -> Column:
    """The value where the condition holds, 0 where it is false or NULL."""
    return F.when(condition, value).otherwise(F.lit(0))
