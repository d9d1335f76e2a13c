"""Retained-earnings detail: P&L lines per year in presentation order.

The reference query groups by (year, type, order) while selecting an
ungrouped amount, which is invalid SQL. Every line set is already unique per
(year, type, order), so the repair is to drop that last GROUP BY; the running
total is then a ROWS frame in presentation order within each year.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import round2
from ..sources.schemas import FINE
from ..sources.adapter import Ledger
from .calendars import calendar_years
from .postings import cogs_from, product_costs, sold_quantities
from .ppe import accumulated_depreciation_by_year, periodic_depreciation_by_year

# Line labels and their presentation order.
BEGIN_LINE = ("RE - Beginning Balance", 0)
REVENUE_LINE = ("Revenue", 1)
COGS_LINE = ("Cost of Goods Sold", 2)
DEPRECIATION_LINE = ("Depreciation", 3)
EXPENSE_LINES = {
    "interest": ("Interest Expense", 4),
    "wage": ("Wage Expense", 5),
    "tax": ("Tax Expense", 6),
    "rent": ("Operational Expense", 7),
    "utility": ("Operational Expense", 7),
}
END_LINE = ("RE - Ending Balance", 999)


def _line(df: DataFrame, label: tuple[str, int]) -> DataFrame:
    # One exact type for every line (depreciation carries 10 places), so the
    # union neither widens nor rounds and the output is rounded once.
    return df.select("year", F.lit(label[0]).alias("transaction_type"),
                     F.lit(label[1]).alias("order_process"), F.col("amt").cast(FINE).alias("amt"))


def retained_earnings(ledger: Ledger, calendar_monthly: DataFrame,
                      corrected: bool = False) -> DataFrame:
    """(year, transaction_type, total_amount, running_total), 2 decimals.

    Default as the reference: depreciation is the yearly sum of accumulated
    (not periodic) depreciation, shown positive. ``corrected=True`` books the
    depreciation of the year's months as an expense (negative).
    """
    # Revenue and COGS read one (product, year) aggregate of the sales.
    sold = sold_quantities(ledger.sales)
    revenue = sold.groupBy("year").agg(F.sum("value").alias("amt"))
    cogs = cogs_from(sold, product_costs(ledger.purchases))
    if corrected:
        dep = periodic_depreciation_by_year(ledger.payments, calendar_monthly)
        dep = dep.select("year", (-F.col("amt")).alias("amt"))
    else:
        dep = accumulated_depreciation_by_year(ledger.payments, calendar_monthly)

    ptype = F.col("payment_type")
    label = order = None
    for t, (name, pos) in EXPENSE_LINES.items():
        label = F.when(ptype == t, F.lit(name)) if label is None else label.when(ptype == t, F.lit(name))
        order = F.when(ptype == t, F.lit(pos)) if order is None else order.when(ptype == t, F.lit(pos))
    expenses = (ledger.payments.filter(ptype.isin(list(EXPENSE_LINES)))
                .groupBy(F.year("payment_date").alias("year"),
                         label.alias("transaction_type"), order.alias("order_process"))
                .agg((-F.sum("amount")).cast(FINE).alias("amt")))

    years = calendar_years(calendar_monthly)
    bounds = years.select("year", F.lit(0).cast("decimal(1,0)").alias("amt"))
    lines = (_line(revenue, REVENUE_LINE)
             .unionByName(_line(cogs, COGS_LINE))
             .unionByName(_line(dep, DEPRECIATION_LINE))
             .unionByName(expenses)
             .unionByName(_line(bounds, BEGIN_LINE))
             .unionByName(_line(bounds, END_LINE)))
    w = (Window.partitionBy("year").orderBy("order_process")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return lines.select(
        "year", "transaction_type",
        round2(F.col("amt")).alias("total_amount"),
        round2(F.sum("amt").over(w)).alias("running_total"),
    )
