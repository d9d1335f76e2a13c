"""Yearly summaries and the dashboard (income statement + balance sheet)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import or_zero, round2
from .postings import PIPELINE, RuleSet


def running_total(value: Column, *partition: str, order: str = "year") -> Column:
    """SUM(value) OVER (PARTITION BY .. ORDER BY order NULLS LAST).

    The default frame with an ORDER BY is RANGE UNBOUNDED PRECEDING .. CURRENT
    ROW, so peer rows share the total. NULL keys sort last, so a NULL year never
    leaks into the balances of real years.
    """
    w = Window.orderBy(F.col(order).asc_nulls_last())
    if partition:
        w = Window.partitionBy(*partition).orderBy(F.col(order).asc_nulls_last())
    return F.sum(value).over(w)


def yearly_summaries(postings: DataFrame) -> DataFrame:
    """Annual movement per (year, account) and its running balance per account.

    ``postings`` are reduced rows, bounded by rules x years x accounts
    whatever the data size (years of a DATE are at most 9,999). They are summed
    before anything meets; the sums, a row per year and account, then go to a
    single partition, so that the window by account and any later pivot or sort
    by year need no further shuffle.
    """
    mov = postings.groupBy("year", "account").agg(F.sum("amt").alias("annual_movement")).repartition(1)
    return mov.select("year", "account", "annual_movement",
                      running_total(F.col("annual_movement"), "account").alias("running_balance"))


def _pick(account: str, col: str) -> Column:
    return F.max(F.when(F.col("account") == account, F.col(col)))


BALANCES = ("Cash", "Accounts_Receivable", "Accounts_Payable", "Loan_Principal", "Inventory",
            "Depr_Exp")


def dashboard(summaries: DataFrame, end_year: int | None, rules: RuleSet = PIPELINE,
              cash_name: str = "cash", inventory_name: str = "inventory",
              carry_forward: bool = False, ordered: bool = True) -> DataFrame:
    """One row per year <= end_year (``None``: every year): 9 rounded measures, ordered by year
    (unless a report follows, which has no use for the order).

    As in the reference, a balance account without movement in a year shows 0
    there. ``carry_forward=True`` shows its last balance instead (a window
    over the few year rows).
    """
    s = summaries.filter(F.col("year").isNotNull() if end_year is None else F.col("year") <= end_year)
    bal = {a: _pick(a, "running_balance") for a in BALANCES}
    wide = s.groupBy("year").agg(
        _pick("Revenue", "annual_movement").alias("_rev"),
        F.sum(F.when(F.col("account").isin(list(rules.pl_accounts)),
                     F.col("annual_movement"))).alias("_ni"),
        _pick("PPE_Snapshot", "annual_movement").alias("_ppe"),
        *[c.alias(f"_b_{a}") for a, c in bal.items()],
    )
    b = {a: F.col(f"_b_{a}") for a in BALANCES}
    if carry_forward:
        w = Window.orderBy(F.col("year").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
        b = {a: F.last(c, ignorenulls=True).over(w) for a, c in b.items()}
    ppe = or_zero(F.col("_ppe"))
    out = wide.select(
        "year",
        round2(or_zero(F.col("_rev"))).alias("revenue"),
        round2(F.col("_ni")).alias("net_income"),
        round2(or_zero(b["Cash"])).alias(cash_name),
        round2(or_zero(b["Accounts_Receivable"])).alias("accounts_receivable"),
        round2(or_zero(b["Accounts_Payable"])).alias("accounts_payable"),
        round2(or_zero(b["Loan_Principal"])).alias("debt_remaining"),
        round2(or_zero(b["Inventory"])).alias(inventory_name),
        round2(ppe).alias("gross_ppe"),
        round2(F.greatest(F.lit(0).cast("decimal(1,0)"), ppe + or_zero(b["Depr_Exp"]))).alias("net_ppe"),
    )
    return out.orderBy(F.col("year").asc_nulls_last()) if ordered else out


DASHBOARD_END_YEAR = 2023
LEGACY_END_YEAR = 2031

