"""Reports over the statements: side-by-side years, year-over-year flux, CSV export."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import pct_change, year_at_most
from ..sources.schemas import REPORT

# The compared years and measures of the chart data feed.
COMPARE_YEARS = (2021, 2022)
PL_METRICS = ("revenue", "total_expenses", "net_income")
BALANCE_METRICS = ("cash", "debt_remaining", "inventory")
FLUX_MEASURES = ("revenue", "net_income", "cash", "accounts_receivable", "accounts_payable",
                 "debt_remaining", "inventory", "gross_ppe", "net_ppe")


def statement_compare(dashboard: DataFrame, years: Iterable[int] = COMPARE_YEARS) -> DataFrame:
    """P&L (revenue, total expenses = revenue - net income, net income) and
    balance-sheet measures (cash, debt, inventory), one column per year.

    One aggregate picks each measure of each year, NULL where the statements lack it;
    its one row is then turned, so the few rows of the statements are not shuffled.
    """
    years = list(years)
    d = dashboard.filter(F.col("year").isin(years)).withColumn(
        "total_expenses", (F.col("revenue") - F.col("net_income")).cast(REPORT))
    metrics = list(PL_METRICS) + list(BALANCE_METRICS)
    picked = d.agg(*[F.max(F.when(F.col("year") == y, F.col(m).cast(REPORT))).alias(f"{m}_{y}") for m in metrics for y in years])
    rows = [F.struct(F.lit(m).alias("metric"), F.lit("P&L" if m in PL_METRICS else "Balance Sheet").alias("section"),
                     *[F.col(f"{m}_{y}").alias(f"y{y}") for y in years]) for m in metrics]
    return picked.select(F.inline(F.array(*rows)))


def flux_yoy(dashboard: DataFrame, measures: Iterable[str] = FLUX_MEASURES) -> DataFrame:
    """Year-over-year change of each measure, in percent of |previous value|.

    NULL when there is no previous year or its value is NULL or zero. All measures
    look back in one window over the years (at most 9,999 rows); then each year's row is
    turned into one per measure.
    """
    measures = list(measures)
    by_year = Window.orderBy(F.col("year").asc_nulls_last())
    both = dashboard.select("year", *[F.col(m).cast(REPORT).alias(m) for m in measures],
                            *[F.lag(F.col(m).cast(REPORT)).over(by_year).alias(f"prev_{m}") for m in measures])
    rows = [F.struct(F.lit(m).alias("measure"), F.col("year"), F.col(m).alias("value"), F.col(f"prev_{m}").alias("prev_value"))
            for m in measures]
    return both.select(F.inline(F.array(*rows))).select(
        "measure", "year", "value", "prev_value", pct_change(F.col("value"), F.col("prev_value")).alias("yoy_pct"))


def export_rows(sales: DataFrame, end_year: int = 2023) -> DataFrame:
    """Sales of years up to ``end_year``; the filter is a pushable date range."""
    return sales.filter(year_at_most(F.col("sale_at"), end_year))


def export_csv(df: DataFrame, path: str, end_year: int | None = None,
               mode: str = "overwrite") -> None:
    """Write with a header row and no index column; one file per partition.

    With ``end_year``, only sales of years up to it are written (``df`` then
    needs ``sale_at``).
    """
    if end_year is not None:
        df = export_rows(df, end_year)
    df.write.mode(mode).option("header", True).csv(path)


def to_client(df: DataFrame):
    """A statement or report as a pandas frame for a client (the chart feed).

    These have a row per year or measure, at most 9,999 years. Write anything
    else to a table instead.
    """
    return df.toPandas()
