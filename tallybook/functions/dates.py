"""Date expressions shared by the operators (all JVM-side built-ins)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def cash_lag_date(date: Column, method: Column) -> Column:
    """Cash moves on ``date`` for cash deals, one month later otherwise.

    A NULL method is not 'cash', so it is lagged too.
    """
    return F.when(method == F.lit("cash"), date).otherwise(F.add_months(date, 1))


def month_start(c: Column) -> Column:
    return F.trunc(c, "MM")


def prior_month_start(c: Column) -> Column:
    """First day of the month before ``c`` (Jan 31 -> Dec 1, Mar 31 -> Feb 1)."""
    return F.trunc(F.add_months(c, -1), "MM")


def _runs(years: Iterable[int]) -> list[tuple[int, int]]:
    ys = sorted(set(int(y) for y in years))
    runs: list[tuple[int, int]] = []
    for y in ys:
        if runs and runs[-1][1] == y - 1:
            runs[-1] = (runs[-1][0], y)
        else:
            runs.append((y, y))
    return runs


def in_years(c: Column, years: Iterable[int]) -> Column:
    """``year(c) IN years`` written as date ranges, so Parquet can skip row groups.

    A predicate on ``year(col)`` only pushes IsNotNull to the scan; a range on
    the column itself pushes both bounds.
    """
    cond = None
    for lo, hi in _runs(years):
        part = (c >= F.lit(dt.date(lo, 1, 1))) & (c < F.lit(dt.date(hi + 1, 1, 1)))
        cond = part if cond is None else (cond | part)
    return cond if cond is not None else F.lit(False)


def year_at_most(c: Column, end_year: int) -> Column:
    """``year(c) <= end_year`` as a pushable range."""
    return c < F.lit(dt.date(end_year + 1, 1, 1))


def padded(c: Column, width: int = 9) -> Column:
    """Blank-pad a name to ``width``, as fixed-width month and day names are."""
    return F.rpad(c, width, " ")


def month_name(c: Column) -> Column:
    return padded(F.date_format(c, "MMMM"))


def weekday_name(c: Column) -> Column:
    return padded(F.date_format(c, "EEEE"))


def weekday_sunday0(c: Column) -> Column:
    """Day of week with Sunday = 0 (Spark's ``dayofweek`` has Sunday = 1)."""
    return F.dayofweek(c) - 1


def quarter_label(c: Column) -> Column:
    return F.concat(F.lit("Q"), F.quarter(c).cast("string"))
