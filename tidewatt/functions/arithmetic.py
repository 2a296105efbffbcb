"""Exact money arithmetic and null-safe division."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """NULL instead of an ANSI division-by-zero error."""
    return numerator / F.nullif(denominator, F.lit(0))


def real_ratio(numerator: Column, denominator: Column) -> Column:
    return safe_ratio(numerator.cast("double"), denominator.cast("double"))


def rounded_ratio(numerator: Column, denominator: Column, digits: int) -> Column:
    """Quotient of two decimals, rounded half-up once; NULL when the denominator is 0.

    Spark cuts the scale of a wide decimal quotient before ``round`` sees it, which rounds
    twice. Here the scaled quotient is an exact integer division.
    """
    scale = F.lit(2 * 10**digits).cast(f"decimal({digits + 2},0)")
    twice = F.lit(2).cast("decimal(1,0)")
    over, under = F.abs(numerator), F.abs(F.nullif(denominator, F.lit(0)))
    whole = F.call_function("div", over * scale + under, under * twice).cast("decimal(19,0)")
    sign = F.when((numerator < 0) != (denominator < 0), F.lit(-1)).otherwise(F.lit(1))
    unit = F.lit(f"{10**-digits:.{digits}f}").cast(f"decimal({digits},{digits})")
    return whole * sign * unit


def rounded(value: Column, digits: int) -> Column:
    """Half-up rounding on decimals."""
    return F.round(value, digits)


def scaled(value: Column, factor: str, digits: int) -> Column:
    """Multiply by a decimal literal such as ``"1.05"`` and round half-up."""
    return rounded(value * F.lit(factor).cast("decimal(3,2)"), digits)
