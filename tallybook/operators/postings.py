"""Ledger postings: every source row becomes signed (year, account, amount) rows.

Design (Spark-first):

* Sales, loans and payments are read once, purchases twice (their own postings,
  and the distinct unit costs that COGS needs). Each read is first reduced to
  its distinct posting keys (the years each rule books to, the payment type,
  flags), summing the value: every rule is linear in the value, so this is one
  map-side aggregate update per source row.
* Every rule then contributes one struct ``(rule, year, account, amt, keep)``
  per reduced row; ``inline`` turns the array into rows, ``keep`` filters them,
  and postings are summed per (rule, year, account).
* Equipment is posted once per payment, keyed by its first year; the eleven
  depreciation years are generated after the aggregate (the schedule is linear
  in cost), so no per-asset fan-out reaches the shuffle.
* COGS: the reference joins each sale to every distinct (product, cost) pair.
  Summed, that is quantity x SUM(DISTINCT cost) per product, so sales are
  reduced to (product, years) with quantity and value, costs to one row per
  product, and after their join all sales rules come from the one result. The
  join never fans out and a hot product is a few rows per year.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import amount, cash_lag_date, prior_month_start
from ..sources.adapter import Ledger
from .schedules import ACCRUAL_TYPES, ACCRUAL_YEARS, EQUIPMENT, LIFE_YEARS, accruable, depreciation_rate

_EQ_RULE = "EQ"  # internal: equipment cost by first year, expanded into B7/B8


@dataclass(frozen=True)
class RuleSet:
    """Parameters that distinguish the two posting variants."""
    name: str
    cash_types: tuple[str, ...]
    rent_rule: bool
    ap_payment_requires_date: bool
    accrual_types: tuple[str, ...] = ACCRUAL_TYPES
    accrual_years: tuple[int, ...] | None = ACCRUAL_YEARS  # None: every year
    life: int = LIFE_YEARS
    pl_accounts: tuple[str, ...] = field(default=(
        "Revenue", "COGS", "Depr_Exp", "interest", "wage", "tax", "rent", "utility"))


# Fixed rule-set values.
PIPELINE = RuleSet(
    name="pipeline",
    cash_types=("interest", "wage", "utility", "tax", "rent"),
    rent_rule=True,
    ap_payment_requires_date=True,
)
LEGACY = RuleSet(
    name="legacy",
    cash_types=("equipment", "interest", "wage", "utility", "tax", "loan", "rent"),
    rent_rule=False,
    ap_payment_requires_date=False,
)


def _post(rule: str, year: Column, account: Column | str, amt: Column,
          keep: Column | None = None) -> Column:
    acc = F.lit(account) if isinstance(account, str) else account
    return F.struct(
        F.lit(rule).alias("rule"),
        year.cast("int").alias("year"),
        acc.alias("account"),
        amount(amt).alias("amt"),
        (keep if keep is not None else F.lit(True)).alias("keep"),
    )


def _explode_posts(reduced: DataFrame, posts: list[Column]) -> DataFrame:
    return (reduced.select(F.inline(F.array(*posts)))
                   .filter(F.col("keep"))
                   .select("rule", "year", "account", "amt"))


def _reduce(df: DataFrame, keys: list[Column], value: Column) -> DataFrame:
    """Sum a table's value per distinct posting key (years, type, flags).

    Every rule is linear in the row's value, so posting the reduced rows gives
    the same sums. Per source row this is one map-side aggregate update; the
    explode into postings runs on the few reduced rows.
    """
    return df.groupBy(*keys).agg(F.sum(value).alias("v"))


def sales_by_product(sales: DataFrame) -> DataFrame:
    """Quantity and value per product and the years that the sales rules book to."""
    method = F.col("payment_method")
    ar = (method != "cash") & (F.month("payment_at") == 12)
    return sales.groupBy(
        "product_name",
        F.year("sale_at").alias("y_sale"),
        F.year(cash_lag_date(F.col("sale_at"), method)).alias("y_cash"),
        F.when(ar, F.year("payment_at")).alias("y_ar"),
    ).agg(F.sum("quantity").alias("qty"), F.sum(F.col("quantity") * F.col("price")).alias("value"))


#: Components of the audits, carried beside the accounts as accounts of their own.
AUDITED = ("raw_revenue", "sales_cash_in", "loan_in", "purchase_out", "expense_out")


def sales_posts(by_product: DataFrame, costs: DataFrame, audit: bool = False) -> DataFrame:
    """B1, B2, B9 and, at the products' costs, B6 and B11: all sales rules."""
    r = (by_product.join(costs, "product_name", "left").groupBy("y_sale", "y_cash", "y_ar")
         .agg(F.sum("value").alias("v"), F.sum(-(F.col("qty") * F.col("cost_sum"))).alias("cogs")))
    v, cogs, y_sale, y_ar = F.col("v"), F.col("cogs"), F.col("y_sale"), F.col("y_ar")
    return _explode_posts(r, [
        _post("B1", y_sale, "Revenue", v),
        _post("B2", F.col("y_cash"), "Cash", v),
        _post("B9", y_ar, "Accounts_Receivable", v, y_ar.isNotNull()),
        _post("B6", y_sale, "COGS", cogs),
        _post("B11", y_sale, "Inventory", cogs),
        *([_post("A1", y_sale, "raw_revenue", v), _post("A2", F.col("y_cash"), "sales_cash_in", v)] if audit else []),
    ])


def purchases_posts(purchases: DataFrame, audit: bool = False) -> DataFrame:
    r = _reduce(purchases, [
        F.year(cash_lag_date(F.col("purchase_at"), F.col("payment_method"))).alias("y_cash"),
        F.year("purchase_at").alias("y_buy"),
    ], F.col("quantity") * F.col("amount"))
    return purchase_rules(r, audit)


def purchase_rules(r: DataFrame, audit: bool = False) -> DataFrame:
    """B4 and B10 from purchases reduced to (y_cash, y_buy, v)."""
    v = F.col("v")
    return _explode_posts(r, [
        _post("B4", F.col("y_cash"), "Cash", -v),
        _post("B10", F.col("y_buy"), "Inventory", v),
        *([_post("A4", F.col("y_cash"), "purchase_out", v)] if audit else []),
    ])


def loans_posts(loans: DataFrame, audit: bool = False) -> DataFrame:
    return loan_rules(_reduce(loans, [F.year("loan_at").alias("y_loan")], F.col("value")), audit)


def loan_rules(r: DataFrame, audit: bool = False) -> DataFrame:
    """B3 and B12 from loans reduced to (y_loan, v)."""
    v = F.col("v")
    return _explode_posts(r, [
        _post("B3", F.col("y_loan"), "Cash", v),
        _post("B12", F.col("y_loan"), "Loan_Principal", v),
        *([_post("A3", F.col("y_loan"), "loan_in", v)] if audit else []),
    ])


def payment_keys(rules: RuleSet) -> list[Column]:
    """What the payments rules depend on: type, year, and the accrual year, which is
    set only for accrued payments, so it doubles as the accrual flag."""
    pd = F.col("payment_date")
    accrued = accruable(rules.accrual_types, rules.accrual_years)
    return [F.col("payment_type").alias("ptype"), F.year(pd).alias("y_pay"),
            F.when(accrued, F.year(prior_month_start(pd))).alias("y_accr")]


def posted_types(rules: RuleSet) -> list[str]:
    """Payment types that some rule uses: every payments rule is conditioned on the type."""
    return sorted(set(rules.cash_types) | set(rules.accrual_types)
                  | {"loan", EQUIPMENT} | ({"rent"} if rules.rent_rule else set()))


def payments_posts(payments: DataFrame, rules: RuleSet, audit: bool = False) -> DataFrame:
    # Only the used types: Parquet skips the rest and odd values never reach the shuffle.
    # The cash audit counts payments of every type.
    if not audit:
        payments = payments.filter(F.col("payment_type").isin(posted_types(rules)))
    return payment_rules(_reduce(payments, payment_keys(rules), F.col("amount")), rules, audit)


def payment_rules(r: DataFrame, rules: RuleSet, audit: bool = False) -> DataFrame:
    """B5 and B13 to B17 and the equipment from payments reduced to (ptype, y_pay, y_accr, v)."""
    v, ptype, y_pay, y_accr = F.col("v"), F.col("ptype"), F.col("y_pay"), F.col("y_accr")
    is_accr = y_accr.isNotNull()
    posts = [
        _post("B5", y_pay, "Cash", -v, ptype.isin(list(rules.cash_types))),
        _post("B13", y_pay, "Loan_Principal", -v, ptype == "loan"),
        _post("B14", y_accr, ptype, -v, is_accr),
        _post("B16", y_accr, "Accounts_Payable", v, is_accr),
        _post("B17", y_pay, "Accounts_Payable", -v,
              (is_accr & y_pay.isNotNull()) if rules.ap_payment_requires_date else is_accr),
        _post(_EQ_RULE, y_pay, EQUIPMENT, v, ptype == EQUIPMENT),
    ]
    if rules.rent_rule:
        posts.append(_post("B15", y_pay, "rent", -v, ptype == "rent"))
    if audit:
        posts.append(_post("A5", y_pay, "expense_out", v))
    return _explode_posts(r, posts)


def product_costs(purchases: DataFrame) -> DataFrame:
    """Per product, the sum of its distinct unit costs (what the fan-out join sums)."""
    return purchases.groupBy("product_name").agg(F.sum_distinct("amount").alias("cost_sum"))


def sold_quantities(sales: DataFrame) -> DataFrame:
    """Sold quantity and value per (product, sale year): a hot product is a few rows here.

    Carries the sales value too, so a caller that needs revenue by year reads
    it from this aggregate instead of scanning the sales again.
    """
    return sales.groupBy("product_name", F.year("sale_at").alias("year")).agg(
        F.sum("quantity").alias("qty"), F.sum(F.col("quantity") * F.col("price")).alias("value"))


def cogs_from(sold: DataFrame, costs: DataFrame) -> DataFrame:
    """COGS per year from (product, year, qty) and (product, cost_sum).

    Both sides are aggregates keyed by product; Spark (with AQE) picks a
    broadcast or sort-merge join from their measured size.
    """
    j = sold.select("product_name", "year", "qty").join(costs, "product_name", "left")
    return j.groupBy("year").agg(
        amount(F.sum(-(F.col("qty") * F.col("cost_sum")))).alias("amt"))


def expand_equipment(agg: DataFrame, years: DataFrame, life: int = LIFE_YEARS) -> DataFrame:
    """Turn the EQ rows (cost by first year) into Depr_Exp and PPE_Snapshot rows.

    Runs on the reduced posting rows (a few per table partition), never on
    raw rows, and without splitting them (a filter would be pushed below the
    reduce and rescan the table).
    """
    is_eq = F.col("rule") == _EQ_RULE
    i = F.col("i")
    gen = F.when(is_eq, F.sequence(F.lit(0), F.lit(life))).otherwise(F.array(F.lit(-1)))
    x = agg.select("*", F.explode(gen).alias("i"))
    x = x.select(
        F.when(is_eq, (F.col("year") + i).cast("int")).otherwise(F.col("year")).alias("year"),
        "rule", "account", "amt", i.alias("i"), is_eq.alias("is_eq"),
    )
    cal = F.broadcast(years.select(F.col("year").cast("int").alias("cal_year")).distinct())
    x = x.join(cal, x.year == cal.cal_year, "left").filter(
        ~F.col("is_eq") | F.col("cal_year").isNotNull())
    rate = depreciation_rate(i, life)
    posts = F.when(F.col("is_eq"), F.array(
        F.struct(F.lit("B7").alias("rule"), F.col("year"), F.lit("Depr_Exp").alias("account"),
                 amount(-(F.col("amt") * rate)).alias("amt")),
        F.struct(F.lit("B8").alias("rule"), F.col("year"), F.lit("PPE_Snapshot").alias("account"),
                 amount(F.col("amt")).alias("amt")),
    )).otherwise(F.array(
        F.struct("rule", "year", "account", amount(F.col("amt")).alias("amt"))))
    return x.select(F.inline(posts))


def ledger_postings(ledger: Ledger, years: DataFrame, rules: RuleSet = PIPELINE,
                    end_year: int | None = None, by_rule: bool = True, audit: bool = False) -> DataFrame:
    """Postings summed per (rule, year, account): the union of the 17 rules.

    ``audit``: with the audits' components as rows of their own (``AUDITED``), from the
    same reading of each table.

    ``years`` are the calendar years that bound the depreciation schedule.
    With ``end_year`` set, later years are dropped before the shuffle; this is
    safe for running balances, which only look back. With ``by_rule=False``
    the posting rows are returned unsummed; they are already reduced (a few
    rows per table partition), for callers that aggregate them anyway.
    """
    raw = (sales_posts(sales_by_product(ledger.sales), product_costs(ledger.purchases), audit)
           .unionByName(purchases_posts(ledger.purchases, audit))
           .unionByName(loans_posts(ledger.loans, audit))
           .unionByName(payments_posts(ledger.payments, rules, audit)))
    return expanded(raw, years, rules, end_year, by_rule)


def expanded(raw: DataFrame, years: DataFrame, rules: RuleSet = PIPELINE, end_year: int | None = None,
             by_rule: bool = True) -> DataFrame:
    """Postings from reduced rows: the depreciation years generated, all summed."""
    if end_year is not None:
        raw = raw.filter(F.col("year") <= end_year)
    # The expansion is linear, so it runs on the reduced rows directly: one
    # aggregate (here, or the caller's) sums everything at the end.
    posted = expand_equipment(raw, years, rules.life)
    if end_year is not None:
        posted = posted.filter(F.col("year") <= end_year)
    if not by_rule:
        return posted
    return posted.groupBy("rule", "year", "account").agg(F.sum("amt").alias("amt"))
