"""Stand-alone account views: receivables, cash, monthly cash, inventory, loans.

Each one scans its tables once, reduces them with a map-side partial
aggregate to (year or month) rows, and only then runs the running-total
window, which therefore sees at most #years (or #months) rows.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import amount, cash_lag_date, month_start
from ..sources.adapter import Ledger
from ..sources.schemas import AMOUNT, MONEY, REPORT
from .postings import LEGACY
from .statements import running_total


def _flows(parts: list[tuple[DataFrame, Column, Column]], key: str) -> DataFrame:
    """Union of (key, amt) flows; key is a year or a month date."""
    out = None
    for df, k, amt in parts:
        f = df.select(k.alias(key), amount(amt).alias("amt"))
        out = f if out is None else out.unionByName(f)
    return out


def account_ar(sales: DataFrame) -> DataFrame:
    """Unpaid value of non-cash sales with a December payment date, by payment year.

    Annual, not cumulative. The reference spells the label column ``accont``;
    we name it ``account``.
    """
    s = sales.filter((F.col("payment_method") != "cash") & (F.month("payment_at") == 12))
    return s.groupBy(F.year("payment_at").alias("year")).agg(
        F.sum(F.col("price") * F.col("quantity")).cast(REPORT).alias("total_amount")
    ).select("year", F.lit("Accounts_Receivable").alias("account"), "total_amount")


def account_cash(ledger: Ledger, cash_types: Iterable[str] = LEGACY.cash_types) -> DataFrame:
    """Cumulative cash by year from four flows.

    Non-cash deals move one month after ``payment_at``. Includes equipment and
    loan payments by default (this view's own rule).
    """
    s, p = ledger.sales, ledger.purchases
    flows = _flows([
        (s, F.year(cash_lag_date(F.col("payment_at"), F.col("payment_method"))),
         F.col("quantity") * F.col("price")),
        (p, F.year(cash_lag_date(F.col("payment_at"), F.col("payment_method"))),
         -(F.col("quantity") * F.col("amount"))),
        (ledger.loans, F.year("loan_at"), F.col("value")),
        (ledger.payments.filter(F.col("payment_type").isin(list(cash_types))),
         F.year("payment_date"), -F.col("amount")),
    ], "year")
    per_year = flows.groupBy("year").agg(F.sum("amt").alias("amt"))
    return per_year.select(
        "year", F.lit("cash").alias("account_type"),
        running_total(F.col("amt")).cast(REPORT).alias("total_amount"))


def monthly_cash(ledger: Ledger) -> DataFrame:
    """Net cash flow and running balance per month, on unlagged payment dates.

    All payment types count. A NULL payment date forms a NULL month, which
    sorts last and so never enters the balance of a real month.
    """
    flows = _flows([
        (ledger.sales, month_start(F.col("payment_at")), F.col("quantity") * F.col("price")),
        (ledger.purchases, month_start(F.col("payment_at")),
         -(F.col("quantity") * F.col("amount"))),
        (ledger.loans, month_start(F.col("loan_at")), F.col("value")),
        (ledger.payments, month_start(F.col("payment_date")), -F.col("amount")),
    ], "month")
    per_month = flows.groupBy("month").agg(F.sum("amt").alias("amt"))
    return per_month.select(
        "month",
        F.col("amt").cast(REPORT).alias("monthly_net"),
        running_total(F.col("amt"), order="month").cast(REPORT).alias("running_balance"),
    ).orderBy(F.col("month").asc_nulls_last())


def account_inventory(ledger: Ledger) -> DataFrame:
    """Cumulative inventory: purchases at cost minus sales at the highest unit cost.

    Sales of products never purchased drop out. Both tables are read once and
    reduced together to (product, year) rows; the highest cost of a product is
    then a window over its years.
    """
    none = F.lit(None)
    moves = ledger.purchases.select(
        "product_name", F.year("purchase_at").alias("year"), F.lit(1).alias("bought"), none.cast("long").alias("sold"),
        amount(F.col("quantity") * F.col("amount")).alias("added"), F.col("amount").alias("unit_cost"),
    ).unionByName(ledger.sales.filter(F.col("product_name").isNotNull()).select(
        "product_name", F.year("sale_at").alias("year"), F.lit(0).alias("bought"),
        F.col("quantity").cast("long").alias("sold"),
        none.cast(AMOUNT).alias("added"), none.cast(MONEY).alias("unit_cost")))
    per = moves.groupBy("product_name", "year").agg(
        F.sum("bought").alias("bought"), F.sum("sold").alias("sold"), F.sum("added").alias("added"),
        F.max("unit_cost").alias("unit_cost"))
    product = Window.partitionBy("product_name")  # a row per year
    per = per.select("year", "added", F.sum("bought").over(product).alias("ever_bought"),
                     amount(-(F.col("sold") * F.max("unit_cost").over(product))).alias("removed"))
    per = per.filter(F.col("ever_bought") > 0)
    per_year = per.groupBy("year").agg(F.sum("added").alias("added"), F.sum("removed").alias("removed"))
    net = F.when(F.col("added").isNotNull() | F.col("removed").isNotNull(),
                 F.coalesce("added", F.lit(0)) + F.coalesce("removed", F.lit(0)))
    return per_year.select(
        "year", F.lit("Inventory").alias("account"),
        running_total(net).cast(REPORT).alias("total_amount"),
    ).orderBy(F.col("year").asc_nulls_last())


def account_loan(ledger: Ledger) -> DataFrame:
    """Loans taken minus loan payments, cumulative by year."""
    flows = _flows([
        (ledger.loans, F.year("loan_at"), F.col("value")),
        (ledger.payments.filter(F.col("payment_type") == "loan"),
         F.year("payment_date"), -F.col("amount")),
    ], "year")
    per_year = flows.groupBy("year").agg(F.sum("amt").alias("amt"))
    return per_year.select(
        "year", F.lit("Loan").alias("account"),
        running_total(F.col("amt")).cast(REPORT).alias("cumulative_loan_amount"),
    ).orderBy(F.col("year").asc_nulls_last())
