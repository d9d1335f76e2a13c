"""Weighted ledger records: insertions and withdrawals through all posting rules.

A change is a ledger row with a weight ``w``: +1 puts the row in, -1 takes it
out, an update is both. Every posting rule is linear in the row's value, so a
table's effect on the statements is a small state: sums of ``w * value`` per
posting key. States of disjoint sets of changes add up, in any order, and a
day's changes cost a day's rows, not a full reading of the ledger.

Two things are not linear, so the state keeps the counts that decide them:

* a key whose rows have all been withdrawn is no posting: ``n``, the sum of weights;
* a sum over NULL values only is NULL, not 0: ``n_v``, the weights of rows with a value.

COGS sums the *distinct* unit costs of a product. The purchases' state is keyed by
(product, unit cost, years): a cost counts while its multiset count ``n`` over all
years is positive, so withdrawing one of two purchases at a cost keeps it, and
withdrawing the last one takes it out of all past COGS.

A change of any weight may arrive before or after another: counts may be negative
meanwhile. Rows of a table without ``w``, or with a NULL there, weigh +1.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import cash_lag_date
from .postings import (PIPELINE, RuleSet, expanded, loan_rules, payment_keys, payment_rules, posted_types,
                       product_costs, purchase_rules, sales_posts)

WEIGHT = "w"
#: Keys and measures of each table's state.
STATES = {
    "sales": "product_name string, y_sale int, y_cash int, y_ar int, "
             "n bigint, n_qty bigint, qty bigint, n_v bigint, v decimal(38,2)",
    "purchases": "product_name string, amount decimal(12,2), y_cash int, y_buy int, n bigint, n_v bigint, v decimal(38,2)",
    "payments": "ptype string, y_pay int, y_accr int, n bigint, n_v bigint, v decimal(38,2)",
    "loans": "y_loan int, n bigint, n_v bigint, v decimal(38,2)",
}
KEYS = {"sales": ["product_name", "y_sale", "y_cash", "y_ar"], "purchases": ["product_name", "amount", "y_cash", "y_buy"],
        "payments": ["ptype", "y_pay", "y_accr"], "loans": ["y_loan"]}


def weight(df: DataFrame) -> Column:
    return F.coalesce(F.col(WEIGHT).cast("long"), F.lit(1)) if WEIGHT in df.columns else F.lit(1).cast("long")


def weighted(df: DataFrame, w: int) -> DataFrame:
    """The rows with weight ``w`` each."""
    return df.withColumn(WEIGHT, F.lit(w).cast("long"))


def replaced(old: DataFrame, new: DataFrame) -> DataFrame:
    """The changes that turn the rows of ``old`` into those of ``new``."""
    return weighted(old, -1).unionByName(weighted(new, 1))


def _state_keys(table: str, rules: RuleSet) -> tuple[list[Column], Column]:
    """Posting keys, by name, and the value of a table's rows."""
    if table == "sales":
        method = F.col("payment_method")
        due = (method != "cash") & (F.month("payment_at") == 12)
        return ["product_name", F.year("sale_at").alias("y_sale"),
                F.year(cash_lag_date(F.col("sale_at"), method)).alias("y_cash"),
                F.when(due, F.year("payment_at")).alias("y_ar")], F.col("quantity") * F.col("price")
    if table == "purchases":
        lagged = cash_lag_date(F.col("purchase_at"), F.col("payment_method"))
        return ["product_name", "amount", F.year(lagged).alias("y_cash"),
                F.year("purchase_at").alias("y_buy")], F.col("quantity") * F.col("amount")
    if table == "payments":
        return payment_keys(rules), F.col("amount")
    return [F.year("loan_at").alias("y_loan")], F.col("value")


def state_of(table: str, changes: DataFrame, rules: RuleSet = PIPELINE) -> DataFrame:
    """The state that a set of changes adds: one map-side aggregate over its rows."""
    if table == "payments":
        changes = changes.filter(F.col("payment_type").isin(posted_types(rules)))
    keys, value = _state_keys(table, rules)
    w = weight(changes)
    quantity = [F.sum(F.when(F.col("quantity").isNotNull(), w)).alias("n_qty"),
                F.sum(w * F.col("quantity")).cast("long").alias("qty")] if table == "sales" else []
    return _zeros(table, changes.groupBy(*keys).agg(
        F.sum(w).alias("n"), *quantity, F.sum(F.when(value.isNotNull(), w)).alias("n_v"),
        F.sum(w * value).cast("decimal(38,2)").alias("v")))


def _zeros(table: str, state: DataFrame) -> DataFrame:
    """Measures without any value are 0: a NULL is decided by the counts when read."""
    return state.select(*KEYS[table], *(F.coalesce(c, F.lit(0)).cast(state.schema[c].dataType).alias(c)
                                        for c in state.columns if c not in KEYS[table]))


def merged(table: str, states: DataFrame) -> DataFrame:
    """Several states of a table, in one frame, added up. Keys that are out stay
    while any measure is not 0 (a withdrawal may come before its insertion)."""
    measures = [c for c in states.columns if c not in KEYS[table]]
    out = states.groupBy(*KEYS[table]).agg(*(F.sum(c).cast(states.schema[c].dataType).alias(c) for c in measures))
    some = F.lit(False)
    for c in measures:
        some = some | (F.col(c) != 0)
    return out.filter(some)


def _standing(state: DataFrame) -> DataFrame:
    """Reduced rows as the batch rules read them: keys that stand, NULL where no value does."""
    out = state.filter(F.col("n") > 0).withColumn("v", F.when(F.col("n_v") > 0, F.col("v")))
    return out.withColumn("qty", F.when(F.col("n_qty") > 0, F.col("qty"))) if "qty" in out.columns else out


def postings_from(states: dict[str, DataFrame], years: DataFrame, rules: RuleSet = PIPELINE,
                  end_year: int | None = None, by_rule: bool = True) -> DataFrame:
    """The 17 rules over merged states, as ``ledger_postings`` over the ledger."""
    at = {t: _standing(s) for t, s in states.items()}
    # A cost stands while its count over all years does.
    costs = states["purchases"].groupBy("product_name", "amount").agg(F.sum("n").alias("n")).filter("n > 0")
    raw = (sales_posts(at["sales"].withColumnRenamed("v", "value"), product_costs(costs))
           .unionByName(purchase_rules(at["purchases"].groupBy("y_cash", "y_buy").agg(F.sum("v").alias("v"))))
           .unionByName(loan_rules(at["loans"])).unionByName(payment_rules(at["payments"], rules)))
    return expanded(raw, years, rules, end_year, by_rule)
