"""Reconciliation audits: statements against the raw records.

The reference audits one year with scalar queries and driver-side arithmetic.
Here every year is audited at once: each side is one aggregate, the sides are
full-joined on year, and the verdict is a column. Nothing is collected.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import amount, cash_lag_date, in_years
from ..sources.adapter import Ledger
from ..sources.schemas import REPORT
from .postings import AUDITED

TOLERANCE = 0.01


def _zero(c: str):
    return F.coalesce(F.col(c), F.lit(0)).cast(REPORT)


def _restrict(df: DataFrame, date_col: str, years: Iterable[int] | None) -> DataFrame:
    return df if years is None else df.filter(in_years(F.col(date_col), years))


def audit_revenue(dashboard: DataFrame, sales: DataFrame, years: Iterable[int] | None = None,
                  tol: float = TOLERANCE) -> DataFrame:
    """Revenue in the statements vs SUM(quantity x price) of the sales, per year.

    diff = statements - raw; is_match when |diff| < tol. Missing sides are 0. A
    year that the statements do not show has ``in_view`` false and no verdict.
    """
    years = None if years is None else list(years)
    view = dashboard.select("year", F.col("revenue").alias("view_revenue"), F.lit(True).alias("in_view"))
    if years is not None:
        view = view.filter(F.col("year").isin(years))
    raw = _restrict(sales, "sale_at", years).groupBy(F.year("sale_at").alias("year")).agg(
        F.sum(F.col("quantity") * F.col("price")).alias("raw_revenue"))
    j = view.join(raw, "year", "full")
    diff = _zero("view_revenue") - _zero("raw_revenue")
    return j.select(
        "year", _zero("view_revenue").alias("view_revenue"), _zero("raw_revenue").alias("raw_revenue"),
        diff.cast(REPORT).alias("diff"), *_verdict(diff, tol),
    ).orderBy(F.col("year").asc_nulls_last())


def _verdict(diff: Column, tol: float) -> list[Column]:
    in_view = F.coalesce("in_view", F.lit(False))
    return [in_view.alias("in_view"), F.when(in_view, F.abs(diff) < F.lit(tol)).alias("is_match")]


def _lagged(df: DataFrame, date_col: str, years: Iterable[int] | None) -> DataFrame:
    """Rows whose cash may move in ``years``: the lag reaches one month back."""
    if years is None:
        return df
    back = in_years(F.add_months(F.col(date_col), 1), years)
    lo, hi = dt.date(min(years) - 1, 12, 1), dt.date(max(years) + 1, 1, 1)
    # the plain range reaches the scan, the lagged one cannot
    return df.filter((F.col(date_col) >= F.lit(lo)) & (F.col(date_col) < F.lit(hi))
                     & (in_years(F.col(date_col), years) | back))


def cash_components(ledger: Ledger, years: Iterable[int] | None = None) -> DataFrame:
    """Per year: sales cash in, loans in, purchases out, all payments out.

    One scan per table, one aggregate over the union. With ``years`` the scans
    skip what cannot move cash in them.
    """
    years = None if years is None else list(years)
    s, p = _lagged(ledger.sales, "sale_at", years), _lagged(ledger.purchases, "purchase_at", years)
    loans, payments = _restrict(ledger.loans, "loan_at", years), _restrict(ledger.payments, "payment_date", years)
    parts = [
        s.select(F.year(cash_lag_date(F.col("sale_at"), F.col("payment_method"))).alias("year"),
                 F.lit("sales_cash_in").alias("c"), amount(F.col("quantity") * F.col("price")).alias("v")),
        loans.select(F.year("loan_at").alias("year"), F.lit("loan_in").alias("c"),
                            amount(F.col("value")).alias("v")),
        p.select(F.year(cash_lag_date(F.col("purchase_at"), F.col("payment_method"))).alias("year"),
                 F.lit("purchase_out").alias("c"), amount(F.col("quantity") * F.col("amount")).alias("v")),
        payments.select(F.year("payment_date").alias("year"), F.lit("expense_out").alias("c"),
                               amount(F.col("amount")).alias("v")),
    ]
    u = parts[0]
    for x in parts[1:]:
        u = u.unionByName(x)
    if years is not None:
        u = u.filter(F.col("year").isin(years))
    return u.groupBy("year").agg(*[
        F.sum(F.when(F.col("c") == k, F.col("v"))).alias(k)
        for k in ("sales_cash_in", "loan_in", "purchase_out", "expense_out")])


def audit_cash(dashboard: DataFrame, ledger: Ledger, years: Iterable[int] | None = None,
               tol: float = TOLERANCE, cash_column: str = "cash") -> DataFrame:
    """One-year cash flow (all payment types) vs the statements' cash balance.

    As in the reference, this compares a yearly flow with a cumulative balance
    and subtracts every payment type, so it flags a discrepancy whenever
    earlier years or equipment/loan payments exist: the components and the
    diff (calculated - statements) are the output. A year that the statements
    do not show has ``in_view`` false and no verdict.
    """
    years = None if years is None else list(years)
    comp = cash_components(ledger, years)
    view = dashboard.select("year", F.col(cash_column).alias("view_cash"), F.lit(True).alias("in_view"))
    if years is not None:
        view = view.filter(F.col("year").isin(years))
    j = comp.join(view, "year", "full")
    calc = (_zero("sales_cash_in") + _zero("loan_in") - _zero("purchase_out") - _zero("expense_out"))
    diff = calc - _zero("view_cash")
    return j.select(
        "year",
        *[_zero(k).alias(k) for k in ("sales_cash_in", "loan_in", "purchase_out", "expense_out")],
        calc.cast(REPORT).alias("net_cash_calculated"),
        _zero("view_cash").alias("view_cash"),
        diff.cast(REPORT).alias("diff"),
        *_verdict(diff, tol),
    ).orderBy(F.col("year").asc_nulls_last())


def _audited(summaries: DataFrame, end_year: int, years: Iterable[int] | None, view: str, measure: str,
             parts: tuple[str, ...]) -> DataFrame:
    """Per year the statements' measure, whether they show the year, and the components,
    from summaries that carry both (``AUDITED``): one aggregate over a row per year and
    account. Years that have neither are left out."""
    account, shown = F.col("account"), F.coalesce(F.col("year") <= end_year, F.lit(False))
    own = ~account.isin(list(AUDITED)) & shown
    # A year that only other components know has no row.
    s = summaries.filter(own | account.isin(list(parts)))
    if years is not None:
        s = s.filter(F.col("year").isin(list(years)))
    return s.groupBy("year").agg(
        F.max(F.when(own & (account == view), F.round(F.col(measure), 2))).alias("view"), F.max(own).alias("in_view"),
        *[F.max(F.when(account == p, F.col("annual_movement"))).alias(p) for p in parts])


def audit_revenue_of(summaries: DataFrame, end_year: int, years: Iterable[int] | None = None,
                     tol: float = TOLERANCE) -> DataFrame:
    """``audit_revenue`` of the statements up to ``end_year`` that the summaries make.

    The raw sums come from the same reading of the sales, so this checks what the
    statements make of the reduced rows. ``audit_revenue`` checks any dashboard, a stored
    one too, against a reading of its own."""
    j = _audited(summaries, end_year, years, "Revenue", "annual_movement", ("raw_revenue",))
    diff = _zero("view") - _zero("raw_revenue")
    return j.select("year", _zero("view").alias("view_revenue"), _zero("raw_revenue").alias("raw_revenue"),
                    diff.cast(REPORT).alias("diff"), *_verdict(diff, tol)).orderBy(F.col("year").asc_nulls_last())


def audit_cash_of(summaries: DataFrame, end_year: int, years: Iterable[int] | None = None, tol: float = TOLERANCE) -> DataFrame:
    """``audit_cash`` of the statements up to ``end_year`` that the summaries make; see ``audit_revenue_of``."""
    parts = ("sales_cash_in", "loan_in", "purchase_out", "expense_out")
    j = _audited(summaries, end_year, years, "Cash", "running_balance", parts)
    calc = _zero("sales_cash_in") + _zero("loan_in") - _zero("purchase_out") - _zero("expense_out")
    diff = calc - _zero("view")
    return j.select("year", *[_zero(k).alias(k) for k in parts], calc.cast(REPORT).alias("net_cash_calculated"),
                    _zero("view").alias("view_cash"), diff.cast(REPORT).alias("diff"),
                    *_verdict(diff, tol)).orderBy(F.col("year").asc_nulls_last())


def audit_report(audit: DataFrame) -> DataFrame:
    """Audit lines as labelled, formatted text: one row per (year, component).

    Labels are the column names with ``_`` as spaces in title case; amounts
    use thousands separators and 2 decimals, as the audit logs print them. A
    NULL ``is_match`` is a year outside the statements.
    """
    value_cols = [c for c, t in audit.dtypes if t.startswith("decimal")]
    long = audit.select("year", "is_match", *value_cols).unpivot(
        ["year", "is_match"], value_cols, "component", "value")
    return long.select(
        "year", "component",
        F.initcap(F.regexp_replace("component", "_", " ")).alias("label"),
        F.format_number(F.col("value"), 2).alias("formatted"),
        "is_match",
    )
