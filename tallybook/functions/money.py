"""Money expressions: exact decimals, rounding half away from zero."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..sources.schemas import AMOUNT, REPORT


def amount(c: Column) -> Column:
    """Cast to the posting amount type (exact for every source value)."""
    return c.cast(AMOUNT)


def round2(c: Column) -> Column:
    """ROUND(x, 2) on decimals is HALF_UP in Spark, i.e. away from zero."""
    return F.round(c, 2).cast(REPORT)


def or_zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0).cast(AMOUNT))


def pct_change(value: Column, prev: Column) -> Column:
    """Percent change against |prev|, 2 places; NULL when the base is NULL or zero.

    Exact decimals: with these operand types Spark keeps the quotient to 10
    places (decimal(38,10)) before rounding half up to 2.
    """
    num = ((value - prev) * F.lit(100)).cast("decimal(28,2)")
    den = F.abs(prev).cast("decimal(20,2)")
    return F.when(prev.isNull() | (prev == 0), F.lit(None).cast(REPORT)).otherwise(
        F.round(num / den, 2).cast(REPORT))
