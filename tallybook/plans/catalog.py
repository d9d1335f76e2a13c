"""Registered queries: one per operator, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the driver's tables (through the ledger adapter) and runs
over the whole tables. Reported money is decimal with 2 places (4 for raw
postings and summaries, which carry depreciation at 4 places); years are int.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import (accounts, audits, balances, calendars, changes, intervals, locate, ppe, reports, retained, schedules,
                         statements)
from ..operators.postings import PIPELINE
from ..operators.statements import DASHBOARD_END_YEAR
from ..refresh import keyed
from ..refresh import statements as kept
from ..session import shared_path
from ..sources.adapter import Ledger, ledger_from_driver
from ..sources.loader import OK, as_text, load_summary, records_from_lines, reject_summary
from ..sources.schemas import AMOUNT
from .pipeline import audit_summaries, build_legacy_statements, build_statements, default_years, postings_for

Query = Callable[[SparkSession, str], DataFrame]
LedgerQuery = Callable[[SparkSession, Ledger], DataFrame]


def q_load_ledger(spark, led):
    return load_summary(spark, {k: as_text(v) for k, v in led.tables().items()})


def damaged_lines(df: DataFrame, number: str, date: str, money: str, sep: str = "\t") -> DataFrame:
    """The rows as delimited text; of every 97 ids one has a bad number, a bad
    date, a field too few, a field too many, or a third decimal place."""
    k = F.col("id") % 97
    text = as_text(df).withColumns({"__k": k})
    text = text.withColumn(date, F.when(k == 1, F.lit("2021-13-45")).otherwise(F.col(date)))
    text = text.withColumn(number, F.when(k == 0, F.concat(F.lit("x"), F.col(number))).otherwise(F.col(number)))
    text = text.withColumn(money, F.when(k == 4, F.concat(F.col(money), F.lit("5"))).otherwise(F.col(money)))
    fields = [F.coalesce(F.col(c), F.lit("")) for c in df.columns]
    whole, short = F.concat_ws(sep, *fields), F.concat_ws(sep, *fields[:-1])
    return text.select(F.when(k == 2, short).when(k == 3, F.concat(whole, F.lit(sep + "z"))).otherwise(whole).alias("line"))


DAMAGED = {"sales": ("quantity", "sale_at", "price"), "purchases": ("quantity", "purchase_at", "amount"),
           "payments": ("amount", "payment_date", "amount"), "loans": ("value", "loan_at", "value")}


def q_load_rejects(spark, led):
    """The ledger as damaged text lines, loaded: records per table and reason."""
    return reject_summary({name: records_from_lines(damaged_lines(df, *DAMAGED[name]), df.columns, sep="\t")
                           for name, df in led.tables().items()})


def q_calendar_yearly(spark, led):
    return calendars.calendar_yearly(spark, span=calendars.activity_span(led))


def q_calendar_monthly(spark, led):
    return calendars.calendar_monthly(spark, span=calendars.activity_span(led))


def q_date_dim(spark, led):
    return calendars.date_dim(spark, span=calendars.activity_span(led))


def q_depreciation_schedule(spark, led):
    return schedules.depreciation_schedule(led.payments, default_years(spark))


def q_accrual_schedule(spark, led):
    return schedules.accrual_schedule(led.payments)


def q_ledger_postings(spark, led):
    p = postings_for(spark, led, PIPELINE)
    return p.select("rule", "year", "account", F.col("amt").cast(AMOUNT).alias("amt"))


def q_yearly_summaries(spark, led):
    s = statements.yearly_summaries(postings_for(spark, led, PIPELINE))
    return s.select("year", "account", F.col("annual_movement").cast(AMOUNT).alias("annual_movement"),
                    F.col("running_balance").cast(AMOUNT).alias("running_balance"))


def q_dashboard_flux(spark, led):
    return build_statements(spark, led)


def q_dashboard_flux_full(spark, led):
    """Every year of the ledger, with its depreciation and accruals."""
    return build_statements(spark, led, end_year=None)


def q_dashboard_aggregation(spark, led):
    return build_legacy_statements(spark, led)


def q_account_ar(spark, led):
    return accounts.account_ar(led.sales)


def q_account_cash(spark, led):
    return accounts.account_cash(led)


def q_monthly_cash(spark, led):
    return accounts.monthly_cash(led)


def q_account_inventory(spark, led):
    return accounts.account_inventory(led)


def q_account_loan(spark, led):
    return accounts.account_loan(led)


def q_ppe_monthly(spark, led):
    return ppe.ppe_monthly(led.payments, calendars.calendar_monthly(spark))


def q_ppe_monthly_shared_ids(spark, led):
    """The monthly schedule where assets share ids, a seventh of them the NULL id."""
    shared = F.when(F.expr("id div 16 % 7") != 0, F.col("id") % 1000)
    return ppe.ppe_monthly(led.payments.withColumn("id", shared), calendars.calendar_monthly(spark))


def q_ppe_monthly_corrected(spark, led):
    return ppe.ppe_monthly(led.payments, calendars.calendar_monthly(spark),
                           corrected=True)


def q_ppe_half_year(spark, led):
    return ppe.ppe_half_year(led.payments)


def q_retained_earnings(spark, led):
    return retained.retained_earnings(led, calendars.calendar_monthly(spark))


def q_retained_earnings_corrected(spark, led):
    return retained.retained_earnings(led, calendars.calendar_monthly(spark),
                                      corrected=True)


def q_audit_revenue(spark, led):
    return audits.audit_revenue_of(audit_summaries(spark, led), DASHBOARD_END_YEAR)


def q_audit_cash(spark, led):
    return audits.audit_cash_of(audit_summaries(spark, led), DASHBOARD_END_YEAR)


def q_audit_revenue_2021(spark, led):
    return audits.audit_revenue_of(audit_summaries(spark, led), DASHBOARD_END_YEAR, years=[2021])


def q_audit_cash_2021(spark, led):
    return audits.audit_cash_of(audit_summaries(spark, led), DASHBOARD_END_YEAR, years=[2021])


def q_statement_compare(spark, led):
    return reports.statement_compare(build_statements(spark, led, ordered=False))


def q_flux_yoy(spark, led):
    return reports.flux_yoy(build_statements(spark, led, ordered=False))


def q_export_rows(spark, led):
    return reports.export_rows(led.sales)


def edited(df: DataFrame, gone, changed: list[tuple]) -> tuple[DataFrame, DataFrame]:
    """Stand-in edits of a table: its rows that are deleted or changed, and the changed
    ones as they are afterwards. ``changed``: (condition, column, new value), the first
    that holds."""
    hit = gone
    for cond, _, _ in changed:
        hit = hit | cond
    new, taken = df.filter(hit & ~gone), F.lit(False)
    values: dict = {}
    for cond, name, value in changed:
        values[name] = F.when(cond & ~taken, value).otherwise(values.get(name, F.col(name)))
        taken = taken | cond
    return df.filter(hit), new.withColumns(values)


def ledger_edits(led: Ledger) -> dict[str, tuple[DataFrame, DataFrame]]:
    k = F.col("id")
    return {
        "sales": edited(led.sales, k % 13 == 0, [
            (k % 17 == 1, "quantity", F.col("quantity") + 3), (k % 19 == 2, "sale_at", F.add_months("sale_at", 12)),
            (k % 23 == 3, "payment_method", F.lit("cash")), (k % 29 == 4, "quantity", F.lit(None).cast("int"))]),
        "purchases": edited(led.purchases, k % 11 == 0, [
            (k % 7 == 1, "amount", (F.col("amount") + 1).cast("decimal(12,2)")),
            (k % 17 == 2, "purchase_at", F.add_months("purchase_at", -12))]),
        "payments": edited(led.payments, k % 10 == 3, [
            (k % 9 == 5, "amount", (F.col("amount") * 2).cast("decimal(12,2)")), (k % 14 == 1, "payment_type", F.lit("rent")),
            (k % 22 == 2, "payment_date", F.add_months("payment_date", 11))]),
        "loans": edited(led.loans, k % 9 == 0, [(k % 5 == 1, "value", F.lit(None).cast("decimal(14,2)"))]),
    }


def q_postings_after_edits(spark, led):
    """All posting rules from weighted records: the ledger put in, then the old rows of
    the edits taken out and the new ones put in; two states, added up."""
    edits = ledger_edits(led)
    states = {t: changes.merged(t, changes.state_of(t, df).unionByName(changes.state_of(t, changes.replaced(*edits[t]))))
              for t, df in led.tables().items()}
    p = changes.postings_from(states, default_years(spark))
    return p.select("rule", "year", "account", F.col("amt").cast(AMOUNT).alias("amt"))


def delivered(df: DataFrame, number: str, money: str) -> DataFrame:
    """Stand-in deliveries of a table as text, with the number of their load: 1 has most
    records, 2 new ones, updates and deletions, 3 more of these; 2 comes a second time,
    and some records come without a key or with a bad number."""
    def load(n, where, op=None, change=None):
        return F.when(where, F.struct(F.lit(op).cast("string").alias("_op"), F.lit(n).alias("load"), F.lit(change).cast("string").alias("change")))

    k = F.col("__k")
    two = [load(2, k % 5 == 4), load(2, k % 6 == 1, change="money"), load(2, k % 7 == 2, "D")]
    three = [load(3, k % 14 == 2), load(3, k % 12 == 1, "d"), load(3, k % 31 == 7, change="key")]
    one = [load(1, k % 5 != 4), load(1, k % 37 == 5, change="number")]
    # The rows become text once, and a delivery is its marks: the code stays of a size that the JVM compiles.
    text = df.select(*(F.col(c).cast("string").alias(c) for c in df.columns), F.col("id").cast("long").alias("__k"))
    each = text.select("*", F.explode(F.array(*three, *two, *one, *two)).alias("r")).filter("r is not null")
    change = F.coalesce(F.col("r.change"), F.lit(""))
    values = {c: F.col(c) for c in df.columns}
    values[number] = F.when(change == "number", F.lit("x")).otherwise(values[number])
    values[money] = F.when(change == "money", F.concat(F.lit("1"), F.col(money))).otherwise(values[money])
    values["id"] = F.when(change != "key", F.col("id"))
    return each.select(*(v.alias(c) for c, v in values.items()), "r._op", "r.load")


def q_keyed_load(spark, led):
    """Loads that come late and twice, merged by key: per table the rows that stand and
    their money, the keys that are deleted, the rejects of each load."""
    money = {"sales": "price", "purchases": "amount", "payments": "amount", "loans": "value"}
    rows = None
    for name, df in led.tables().items():
        number = "quantity" if name in ("sales", "purchases") else money[name]
        raw = delivered(df, number, money[name])
        settled = keyed.settled(keyed.typed_load(raw, df.schema, F.col("load")))
        won, gone, load = F.col("_status") == OK, F.col(keyed.DELETED), F.col(keyed.LOAD)
        one = settled.select(
            F.lit(name).alias("table_name"), F.when(won & ~gone, load).alias("live"), F.when(won, gone).alias("gone"),
            F.when(won & ~gone, F.col(money[name])).cast("decimal(38,2)").alias("money"), F.when(~won, load).alias("bad"))
        rows = one if rows is None else rows.unionByName(one)
    return rows.groupBy("table_name").agg(
        F.count("live").alias("live_rows"), F.sum("live").alias("load_numbers"), F.sum("money").cast("decimal(38,2)").alias("live_total"),
        F.count_if("gone").alias("deleted_keys"), *(F.count(F.when(F.col("bad") == n, 1)).alias(f"rejects_{n}") for n in (1, 2, 3)))


def q_postings_from_loads(spark, led):
    """All posting rules from the states that keyed loads have left behind: three numbered
    loads of each table, the first one last, each compared with the records of its keys, its
    changes reduced to a state, the states merged. Written below the shared folder."""
    folder = shared_path(spark, f"loads-{uuid.uuid4().hex}")
    for name, df in led.tables().items():
        raw = delivered(df, *{"sales": ("quantity", "price"), "purchases": ("quantity", "amount"),
                              "payments": ("amount", "amount"), "loans": ("value", "value")}[name])
        for n in (2, 3, 1):
            kept.apply_load(raw.filter(F.col("load") == n).drop("load"), folder, name, n)
    kept.compact_states(spark, folder, fanout=2)
    p = changes.postings_from(kept.current_states(spark, folder), default_years(spark))
    return p.select("rule", "year", "account", F.col("amt").cast(AMOUNT).alias("amt"))


def q_open_receivables(spark, led):
    """At the first of each calendar month, the credit sales that are not paid yet: number and
    value. A sale without payment date stays open."""
    open_until = F.coalesce("payment_at", F.lit(dt.date(9999, 12, 31))).alias("until")
    spans = (led.sales.filter(F.col("payment_method") != "cash").groupBy("sale_at", open_until)
             .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("quantity") * F.col("price")).alias("v")))
    months = calendars.calendar_monthly(spark).select(F.col("calendar_at").alias("month"))
    met = intervals.interval_join(months, spans, "month", "sale_at", "until")
    return met.groupBy("month").agg(F.sum("n").cast("long").alias("n_open"), F.sum("v").cast("decimal(38,2)").alias("open_value"))


def q_cash_by_record(spark, led):
    """Cash after every single record of all four tables, by its payment date."""
    def flow(df, name, date, amt):
        return df.select(F.lit(name).alias("source"), "id", F.col(date).alias("moved_at"), amt.cast("decimal(38,2)").alias("amt"))

    flows = (flow(led.sales, "sales", "payment_at", F.col("quantity") * F.col("price"))
             .unionByName(flow(led.purchases, "purchases", "payment_at", -(F.col("quantity") * F.col("amount"))))
             .unionByName(flow(led.loans, "loans", "loan_at", F.col("value")))
             .unionByName(flow(led.payments, "payments", "payment_date", -F.col("amount"))))
    return balances.running_records(flows, "amt", "moved_at").withColumn("balance", F.col("balance").cast("decimal(38,2)"))


def q_payments_by_type(spark, led):
    """What has been paid of a type after each payment."""
    out = balances.running_records(led.payments, "amount", "payment_date", ("payment_type",), out="paid")
    return out.withColumn("paid", F.col("paid").cast("decimal(38,2)"))


def q_locate_differences(spark, led):
    """The sales records in which a copy with stand-in damage differs from the ledger."""
    k = F.col("id")
    copy = led.sales.filter((k % 101 != 3) | k.isNull()).withColumns({
        "quantity": F.when(k % 997 == 5, F.col("quantity") + 1).otherwise(F.col("quantity")),
        "payment_at": F.when(k % 1009 == 7, F.lit(None)).otherwise(F.col("payment_at"))})
    out = locate.locate_differences(led.sales, copy.unionByName(led.sales.filter(k % 499 == 9)), "sale_at", "product_name")
    return out.select("year", "month", *led.sales.columns, "n_left", "n_right")


LEDGER_QUERIES: dict[str, LedgerQuery] = {
    "load_ledger": q_load_ledger,
    "load_rejects": q_load_rejects,
    "calendar_yearly": q_calendar_yearly,
    "calendar_monthly": q_calendar_monthly,
    "date_dim": q_date_dim,
    "depreciation_schedule": q_depreciation_schedule,
    "accrual_schedule": q_accrual_schedule,
    "ledger_postings": q_ledger_postings,
    "yearly_summaries": q_yearly_summaries,
    "dashboard_flux": q_dashboard_flux,
    "dashboard_flux_full": q_dashboard_flux_full,
    "dashboard_aggregation": q_dashboard_aggregation,
    "account_ar": q_account_ar,
    "account_cash": q_account_cash,
    "monthly_cash": q_monthly_cash,
    "account_inventory": q_account_inventory,
    "account_loan": q_account_loan,
    "ppe_monthly": q_ppe_monthly,
    "ppe_monthly_shared_ids": q_ppe_monthly_shared_ids,
    "ppe_monthly_corrected": q_ppe_monthly_corrected,
    "ppe_half_year": q_ppe_half_year,
    "retained_earnings": q_retained_earnings,
    "retained_earnings_corrected": q_retained_earnings_corrected,
    "audit_revenue": q_audit_revenue,
    "audit_cash": q_audit_cash,
    "audit_revenue_2021": q_audit_revenue_2021,
    "audit_cash_2021": q_audit_cash_2021,
    "statement_compare": q_statement_compare,
    "flux_yoy": q_flux_yoy,
    "export_rows": q_export_rows,
    "postings_after_edits": q_postings_after_edits,
    "keyed_load": q_keyed_load,
    "postings_from_loads": q_postings_from_loads,
    "open_receivables": q_open_receivables,
    "cash_by_record": q_cash_by_record,
    "payments_by_type": q_payments_by_type,
    "locate_differences": q_locate_differences,
}


def _on_driver_tables(fn: LedgerQuery) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(spark, ledger_from_driver(spark, sf_dir))
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


# The registered form: (spark, sf_dir) over the driver's tables.
QUERIES: dict[str, Query] = {k: _on_driver_tables(f) for k, f in LEDGER_QUERIES.items()}
