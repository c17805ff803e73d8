"""Numeric expressions whose results must not depend on the engine's own rounding rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_away(value: Column, digits: int) -> Column:
    """Round the binary double half away from zero.

    The built-in ``round`` goes through the decimal text of the double (1.005 -> 1.01); money and
    rates here are defined on the binary value (1.005 -> 1.0).
    """
    x = value.cast("double")
    scale = F.lit(float(10**digits))
    rounded = F.signum(x) * F.floor(F.abs(x) * scale + F.lit(0.5)) / scale
    # From 2^52 on a double has no fraction left to round, and floor would leave the long range.
    return F.when(F.abs(x) * scale >= F.lit(float(1 << 52)), x).otherwise(rounded)


def steady_mean(value: Column) -> Column:
    """Mean of doubles to twelve places, the same in whatever order rows arrive: the sum is exact."""
    scaled = F.floor(value * F.lit(1e12) + F.lit(0.5)).cast("decimal(38, 0)")
    return F.sum(scaled).cast("double") / F.lit(1e12) / F.count(value)


def percent(part: Column, whole: Column, digits: int) -> Column:
    return round_half_away(F.lit(100.0) * part / F.nullif(whole.cast("double"), F.lit(0.0)), digits)


def decile_floor_then_clamp(ratio: Column) -> Column:
    """0.0 .. 1.0 in steps of a tenth; everything at or past the end lands in 1.0."""
    return F.least(F.floor(ratio * F.lit(10.0)) / F.lit(10.0), F.lit(1.0))


def decile_clamp_then_floor(ratio: Column) -> Column:
    return F.floor(F.least(ratio, F.lit(1.0)) * F.lit(10.0)) / F.lit(10.0)
