"""Depreciation and expense-accrual schedules derived from payments."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import in_years, prior_month_start
from ..sources.schemas import DEPRECIATION

# Straight line over 10 years with the half-year convention,
# i.e. 5 % of cost in the first and the eleventh year, 10 % in between.
LIFE_YEARS = 10
ACCRUAL_TYPES = ("wage", "utility", "tax")
ACCRUAL_YEARS = (2021, 2022, 2023)
EQUIPMENT = "equipment"


def depreciation_rate(i: Column, life: int = LIFE_YEARS) -> Column:
    """Share of cost depreciated in year ``start + i`` (i in 0..life)."""
    full = F.lit(1).cast("decimal(10,0)") / F.lit(life)
    half = full * F.lit("0.5").cast("decimal(2,1)")
    return F.when((i == 0) | (i == life), half).otherwise(full)


def depreciation_schedule(payments: DataFrame, years: DataFrame,
                          life: int = LIFE_YEARS) -> DataFrame:
    """One row per equipment payment and calendar year in [start, start + life].

    The range join against the calendar is an equi-join after generating the
    ``life + 1`` candidate years of each asset. ``years`` is the distinct years
    of a calendar: at most 9,999 rows whatever the data size, so it is safe to
    broadcast.
    """
    eq = payments.filter(F.col("payment_type") == EQUIPMENT).select(
        "id", F.year("payment_date").alias("start_year"), F.col("amount").alias("cost"))
    eq = eq.select("*", F.explode(F.sequence(F.lit(0), F.lit(life))).alias("i"))
    eq = eq.withColumn("year", (F.col("start_year") + F.col("i")).cast("int"))
    sched = eq.join(F.broadcast(years.select(F.col("year").cast("int").alias("year")).distinct()), "year")
    return sched.select(
        "id", "year",
        F.col("cost").alias("gross_val"),
        (F.col("cost") * depreciation_rate(F.col("i"), life)).cast(DEPRECIATION)
        .alias("annual_depreciation_expense"),
    )


def accruable(types: Iterable[str], years: Iterable[int] | None) -> Column:
    """The payments that accrue: of these types, paid in these years (``None``:
    at any date). The year filter is a date range, so it reaches the scan."""
    pd = F.col("payment_date")
    dated = pd.isNotNull() if years is None else in_years(pd, years)
    return F.col("payment_type").isin(list(types)) & dated


def accrual_schedule(payments: DataFrame, types: Iterable[str] = ACCRUAL_TYPES,
                     years: Iterable[int] | None = ACCRUAL_YEARS) -> DataFrame:
    """Wage/utility/tax payments of the given years, accrued to the prior month."""
    pd = F.col("payment_date")
    return payments.filter(accruable(types, years)).select(
        "id",
        F.col("payment_type").alias("account"),
        "amount",
        prior_month_start(pd).alias("accrual_date"),
        pd.alias("cash_payment_date"),
    )
