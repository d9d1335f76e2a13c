"""Calendars and the date dimension (generated series of dates).

A calendar is ``explode(sequence(lo, hi, step))`` over a one-row span. The
span is either two literal dates (the reference defaults) or derived from the
ledger itself by one global min/max aggregate, so the same code serves both.
The output is bounded by the date range (at most 3.65 M days), never by the
number of ledger rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import (month_name, quarter_label, weekday_name, weekday_sunday0)
from ..sources.adapter import Ledger

# Fixed default ranges of the reference calendars.
YEARLY_START = dt.date(2020, 1, 1)
YEARLY_END = dt.date(2025, 12, 31)
MONTHLY_START = dt.date(2021, 1, 1)
MONTHLY_END = dt.date(2050, 12, 31)
DAILY_START = dt.date(2021, 1, 1)
DAILY_END = dt.date(2050, 12, 31)

_STEPS = {"day": "INTERVAL 1 DAY", "month": "INTERVAL 1 MONTH", "year": "INTERVAL 1 YEAR"}


def literal_span(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    return spark.range(1).select(F.lit(start).alias("lo"), F.lit(end).alias("hi"))


def activity_span(ledger: Ledger) -> DataFrame:
    """One row (lo, hi): the first and last date of any ledger activity."""
    parts = [
        ledger.sales.select(F.least("sale_at", "payment_at").alias("a"),
                            F.greatest("sale_at", "payment_at").alias("b")),
        ledger.purchases.select(F.least("purchase_at", "payment_at").alias("a"),
                                F.greatest("purchase_at", "payment_at").alias("b")),
        ledger.payments.select(F.col("payment_date").alias("a"), F.col("payment_date").alias("b")),
        ledger.loans.select(F.col("loan_at").alias("a"), F.col("loan_at").alias("b")),
    ]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    # one global aggregate: partial min/max per partition, one row each to the final
    return u.agg(F.min("a").alias("lo"), F.max("b").alias("hi"))


def series(span: DataFrame, step: str) -> DataFrame:
    """Inclusive series of dates from ``lo`` to ``hi`` (like generate_series)."""
    seq = F.sequence(F.col("lo"), F.col("hi"), F.expr(_STEPS[step]))
    return span.filter(F.col("lo") <= F.col("hi")).select(F.explode(seq).alias("calendar_at"))


def calendar_yearly(spark: SparkSession, start: dt.date = YEARLY_START,
                    end: dt.date = YEARLY_END, span: DataFrame | None = None) -> DataFrame:
    """Yearly calendar: one ``calendar_at`` per year (6 rows by default)."""
    if span is None:
        span = literal_span(spark, start, end)
    else:
        span = span.select(F.trunc("lo", "year").alias("lo"), F.col("hi"))
    return series(span, "year")


def calendar_monthly(spark: SparkSession, start: dt.date = MONTHLY_START,
                     end: dt.date = MONTHLY_END, span: DataFrame | None = None) -> DataFrame:
    """Monthly calendar with year and month columns (360 rows by default)."""
    if span is None:
        span = literal_span(spark, start, end)
    else:
        span = span.select(F.trunc("lo", "MM").alias("lo"), F.col("hi"))
    return series(span, "month").select(
        "calendar_at",
        F.year("calendar_at").alias("year"),
        F.month("calendar_at").alias("month"),
    )


def calendar_years(calendar: DataFrame) -> DataFrame:
    """Distinct years of a calendar: at most 9,999 rows (the DATE range)."""
    return calendar.select(F.year("calendar_at").alias("year")).distinct()


def date_dim(spark: SparkSession, start: dt.date = DAILY_START, end: dt.date = DAILY_END,
             span: DataFrame | None = None) -> DataFrame:
    """Daily date dimension: day, month, names padded to 9, weekday with Sunday=0."""
    if span is None:
        span = literal_span(spark, start, end)
    d = F.col("calendar_at")
    return series(span, "day").select(
        d.alias("date"),
        F.dayofmonth(d).alias("day"),
        F.month(d).alias("month"),
        month_name(d).alias("month_name"),
        F.year(d).alias("year"),
        F.date_format(d, "yyyy-MM").alias("year_month"),
        weekday_sunday0(d).alias("weekday"),
        weekday_name(d).alias("weekday_name"),
        quarter_label(d).alias("quarter"),
    )
