"""Hand-made fixtures for each rule and quirk (FIXTURES.md section 4)."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tallybook.operators import accounts, audits, calendars, ppe, schedules
from tallybook.operators.postings import PIPELINE
from tallybook.operators.statements import yearly_summaries
from tallybook.plans.pipeline import build_statements, postings_for
from tallybook.sources.loader import load_ledger
from tests.conftest import D, loan, make_ledger, payment, purchase, sale


def summaries(spark, led, years=None):
    s = yearly_summaries(postings_for(spark, led, PIPELINE, years=years))
    return {(r.year, r.account): (r.annual_movement, r.running_balance) for r in s.collect()}


def dash(spark, led, end_year=2023, years=None):
    return {r.year: r.asDict() for r in build_statements(spark, led, end_year, years).collect()}


def yr(spark, a, b):
    return calendars.calendar_years(calendars.calendar_yearly(spark, dt.date(a, 1, 1), dt.date(b, 12, 31)))


def test_credit_sale_in_december_lags_cash(spark):
    s = summaries(spark, make_ledger(spark, sales=[sale("2021-12-15", 10, 100, "credit")]))
    assert s[(2021, "Revenue")][0] == 1000
    assert s[(2022, "Cash")][0] == 1000
    assert (2021, "Cash") not in s


def test_cash_sale_books_cash_same_year(spark):
    s = summaries(spark, make_ledger(spark, sales=[sale("2021-12-15", 10, 100, "cash")]))
    assert s[(2021, "Revenue")][0] == 1000 and s[(2021, "Cash")][0] == 1000


def test_null_method_is_lagged_and_not_receivable(spark):
    s = summaries(spark, make_ledger(spark, sales=[sale("2021-12-15", 10, 100, None, paid="2021-12-20")]))
    assert s[(2022, "Cash")][0] == 1000
    assert not any(k[1] == "Accounts_Receivable" for k in s)


def test_receivable_needs_december_payment(spark):
    led = make_ledger(spark, sales=[sale("2021-12-15", 10, 100, "credit", paid="2021-12-20", id_=1),
                                    sale("2021-11-15", 1, 100, "credit", paid="2021-11-20", id_=2)])
    s = summaries(spark, led)
    assert s[(2021, "Accounts_Receivable")][0] == 1000
    ar = accounts.account_ar(led.sales).collect()
    assert [(r.year, r.total_amount) for r in ar] == [(2021, Decimal("1000.00"))]


def test_two_costs_fan_out_cogs_and_max_cost_inventory(spark):
    led = make_ledger(spark,
                      sales=[sale("2021-06-01", 10, 50, product="P")],
                      purchases=[purchase("2020-03-01", 1, 4, product="P", id_=1),
                                 purchase("2020-04-01", 1, 6, product="P", id_=2)])
    s = summaries(spark, led)
    assert s[(2021, "COGS")][0] == -100          # 10 x (4 + 6): one row per distinct cost
    inv = {r.year: r.total_amount for r in accounts.account_inventory(led).collect()}
    assert inv[2020] == 10 and inv[2021] == 10 - 60  # 10 x max cost 6


def test_product_without_cost(spark):
    led = make_ledger(spark, sales=[sale("2021-06-01", 10, 50, product="Q")],
                      purchases=[purchase("2020-03-01", 1, 4, product="P")])
    s = summaries(spark, led)
    assert s[(2021, "COGS")][0] is None
    inv = {r.year: r.total_amount for r in accounts.account_inventory(led).collect()}
    assert 2021 not in inv


def test_january_accrual_books_prior_year(spark):
    s = summaries(spark, make_ledger(spark, payments=[payment("2021-01-31", "wage", 50)]))
    assert s[(2020, "wage")][0] == -50
    assert s[(2020, "Accounts_Payable")][0] == 50
    assert s[(2021, "Accounts_Payable")][0] == -50
    assert s[(2021, "Cash")][0] == -50


def test_accrual_outside_years(spark):
    led = make_ledger(spark, payments=[payment("2024-01-10", "wage", 50)])
    assert schedules.accrual_schedule(led.payments).count() == 0
    s = summaries(spark, led)
    assert s[(2024, "Cash")][0] == -50
    assert not any(k[1] in ("wage", "Accounts_Payable") for k in s)


def test_month_end_accrual_date(spark):
    led = make_ledger(spark, payments=[payment("2021-03-31", "tax", 10)])
    r = schedules.accrual_schedule(led.payments).collect()[0]
    assert r.accrual_date == D("2021-02-01") and r.cash_payment_date == D("2021-03-31")


def test_depreciation_half_year_convention(spark):
    led = make_ledger(spark, payments=[payment("2021-05-05", "equipment", 1000)])
    rows = schedules.depreciation_schedule(led.payments, yr(spark, 2020, 2031)).collect()
    got = {r.year: r.annual_depreciation_expense for r in rows}
    assert got[2021] == 50 and got[2031] == 50
    assert all(got[y] == 100 for y in range(2022, 2031))
    assert sum(got.values()) == 1000 and all(r.gross_val == 1000 for r in rows)


def test_truncated_calendar(spark):
    led = make_ledger(spark, payments=[payment("2021-05-05", "equipment", 1000)])
    rows = schedules.depreciation_schedule(led.payments, yr(spark, 2020, 2025)).collect()
    assert len(rows) == 5 and sum(r.annual_depreciation_expense for r in rows) == 450


def test_net_ppe_floor(spark):
    led = make_ledger(spark, payments=[payment("2010-02-01", "equipment", 1000, id_=1),
                                       payment("2022-02-01", "equipment", 100, id_=2)])
    years = yr(spark, 2010, 2032)
    s = summaries(spark, led, years)
    assert s[(2022, "Depr_Exp")][1] == -1005
    d = dash(spark, led, 2032, years)
    assert d[2022]["gross_ppe"] == 100 and d[2022]["net_ppe"] == 0


def test_no_carry_forward_and_null_net_income(spark):
    led = make_ledger(spark, sales=[sale("2022-03-01", 1, 10)], loans=[loan("2021-05-01", 500)])
    d = dash(spark, led)
    assert d[2021]["debt_remaining"] == 500
    assert d[2022]["debt_remaining"] == 0
    assert d[2021]["net_income"] is None


def test_null_payment_date_sorts_last_in_monthly_cash(spark):
    led = make_ledger(spark, sales=[sale("2021-01-10", 1, 10, "credit", paid="2021-01-20", id_=1),
                                    sale("2021-02-10", 1, 7, "credit", paid=None, id_=2),
                                    sale("2021-03-10", 1, 5, "credit", paid="2021-03-20", id_=3)])
    rows = accounts.monthly_cash(led).collect()
    assert [r.month for r in rows] == [D("2021-01-01"), D("2021-03-01"), None]
    assert [r.running_balance for r in rows] == [10, 15, 22]


def test_peer_rows_share_running_total(spark):
    led = make_ledger(spark, payments=[payment("2021-01-01", "equipment", 1200)])
    rows = ppe.ppe_monthly(led.payments, calendars.calendar_monthly(spark)).collect()
    by_year = {}
    for r in rows:
        by_year.setdefault(r.year, []).append(r.total_amount)
    assert len(by_year[2021]) == 2 and by_year[2021][0] == by_year[2021][1]


def test_leap_day_range_end(spark):
    led = make_ledger(spark, payments=[payment("2024-02-29", "equipment", 1200)])
    months = ppe.equipment_months(ppe.schedule_groups(led.payments), calendars.calendar_monthly(spark))
    got = sorted(r.calendar_at for r in months.collect())
    assert got[0] == D("2024-03-01") and got[-1] == D("2034-02-01") and len(got) == 120


def test_date_dim_padding(spark):
    d = calendars.date_dim(spark, dt.date(2021, 5, 2), dt.date(2021, 5, 2)).collect()[0]
    assert d.month_name == "May      " and d.weekday_name == "Sunday   "
    assert d.weekday == 0 and d.year_month == "2021-05" and d.quarter == "Q2"
    assert (d.day, d.month, d.year) == (2, 5, 2021)


def test_calendars_default_sizes(spark):
    assert calendars.calendar_yearly(spark).count() == 6
    assert calendars.calendar_monthly(spark).count() == 360
    assert calendars.date_dim(spark).count() == 10957


def test_revenue_audit_matches(spark):
    led = make_ledger(spark, sales=[sale("2021-12-15", 10, 100, "credit")])
    rows = audits.audit_revenue(build_statements(spark, led), led.sales, years=[2021]).collect()
    assert len(rows) == 1 and rows[0].diff == 0 and rows[0].is_match


def test_audits_give_no_verdict_outside_the_view(spark):
    led = make_ledger(spark, sales=[sale("2021-12-15", 1, 5), sale("2026-12-15", 1, 5)])
    view = build_statements(spark, led)
    for audit in (audits.audit_revenue(view, led.sales), audits.audit_cash(view, led)):
        rows = {r.year: (r.in_view, r.is_match) for r in audit.collect()}
        assert rows[2021] == (True, True) and rows[2026] == (False, None)


def test_cash_audit_with_equipment(spark):
    led = make_ledger(spark, payments=[payment("2021-06-01", "equipment", 100)])
    rows = audits.audit_cash(build_statements(spark, led), led, years=[2021]).collect()
    assert rows[0].expense_out == 100 and rows[0].view_cash == 0
    assert rows[0].diff == -100 and not rows[0].is_match


def test_bad_row_goes_to_rejects(spark, tmp_path):
    raw = spark.createDataFrame(
        [("1", "2021-01-05", "wage", "10.50"), ("2", "2021-02-05", "rent", "ten"),
         ("3", "not a date", "tax", "3.00")],
        "id string, payment_date string, payment_type string, amount string")
    tables, rejects = load_ledger(spark, {"payments": raw}, target_dir=str(tmp_path / "ledger"))
    assert [r.id for r in tables["payments"].orderBy("id").collect()] == [1]
    rej = {r.reason for r in rejects.collect()}
    assert rej == {"amount", "payment_date"}
    assert "sales" not in tables  # absent sources are skipped silently


def test_prefilter_equals_postfilter(spark):
    led = make_ledger(spark, sales=[sale("2021-12-15", 10, 100, "credit"), sale("2024-01-15", 1, 5)],
                      payments=[payment("2022-01-31", "wage", 50)])
    pre = postings_for(spark, led, PIPELINE, end_year=2022)
    post = postings_for(spark, led, PIPELINE).filter(F.col("year") <= 2022)
    assert sorted(map(tuple, pre.collect())) == sorted(map(tuple, post.collect()))


def test_audit_report_formats_labels(spark):
    led = make_ledger(spark, payments=[payment("2021-06-01", "equipment", 1234.5)])
    rep = audits.audit_report(audits.audit_cash(build_statements(spark, led), led, years=[2021]))
    rows = {r.component: r for r in rep.collect()}
    assert rows["expense_out"].label == "Expense Out"
    assert rows["expense_out"].formatted == "1,234.50"


def test_materialize_and_reload(spark, tmp_path):
    from tallybook.sources.tables import materialize, read_tables
    led = make_ledger(spark, sales=[sale("2021-12-15", 10, 100, "credit", paid="2021-12-20")])
    ar = materialize(accounts.account_ar(led.sales), "account_ar", str(tmp_path / "account_ar"))
    assert spark.table("account_ar").count() == 1 and ar.count() == 1
    again = read_tables(spark, ["account_ar"], location=str(tmp_path))["account_ar"]
    assert [tuple(r) for r in again.collect()] == [tuple(r) for r in ar.collect()]


def test_export_csv_roundtrip(spark, tmp_path):
    from tallybook.operators.reports import export_csv, export_rows
    led = make_ledger(spark, sales=[sale("2021-12-15", 10, 100), sale("2024-01-02", 1, 5, id_=2)])
    export_csv(export_rows(led.sales, 2023), str(tmp_path / "out"))
    back = spark.read.option("header", True).csv(str(tmp_path / "out")).collect()
    assert len(back) == 1 and back[0].sale_at == "2021-12-15" and back[0].price == "100.00"
    export_csv(led.sales, str(tmp_path / "out2"), end_year=2023)
    assert spark.read.option("header", True).csv(str(tmp_path / "out2")).count() == 1


def test_carry_forward_option(spark):
    led = make_ledger(spark, sales=[sale("2022-03-01", 1, 10)], loans=[loan("2021-05-01", 500)])
    d = {r.year: r for r in build_statements(spark, led, carry_forward=True).collect()}
    assert d[2021].debt_remaining == 500 and d[2022].debt_remaining == 500
    assert d[2022].cash == 510


def test_create_insert_drop_table(spark, tmp_path):
    from tallybook.sources.schemas import LOANS
    from tallybook.sources.tables import create_table_if_not_exists, drop_table, insert_into
    path = str(tmp_path / "loans")
    assert create_table_if_not_exists(spark, path, LOANS).count() == 0
    insert_into(make_ledger(spark, loans=[loan("2021-05-01", 500)]).loans, path)
    assert create_table_if_not_exists(spark, path, LOANS).count() == 1  # kept
    drop_table(spark, path)
    drop_table(spark, path)  # silent when absent
    assert create_table_if_not_exists(spark, path, LOANS).count() == 0


def test_to_client(spark):
    from tallybook.operators.reports import statement_compare, to_client
    led = make_ledger(spark, sales=[sale("2021-12-15", 10, 100), sale("2022-01-15", 1, 5, id_=2)])
    pdf = to_client(statement_compare(build_statements(spark, led)))
    assert list(pdf.columns) == ["metric", "section", "y2021", "y2022"] and len(pdf) == 6


def test_materialize_defaults_to_shared_folder(spark):
    from tallybook.session import ensure_checkpoint_dir
    from tallybook.sources.tables import materialize
    led = make_ledger(spark, loans=[loan("2021-05-01", 500)])
    out = materialize(led.loans, "loans_snapshot")
    base = ensure_checkpoint_dir(spark).replace("file:", "")
    assert out.inputFiles() and all(base in f for f in out.inputFiles())


def test_legacy_rules_differ_as_documented(spark):
    from tallybook.plans.pipeline import build_legacy_statements
    led = make_ledger(spark, payments=[payment("2021-06-01", "equipment", 100, id_=1),
                                       payment("2021-07-01", "loan", 30, id_=2),
                                       payment("2021-08-01", "rent", 20, id_=3)])
    new = {r.year: r for r in build_statements(spark, led).collect()}
    old = {r.year: r for r in build_legacy_statements(spark, led).collect()}
    # pipeline: equipment and loan payments are not cash outflows; rent is, and is an expense
    assert new[2021].cash == -20
    # legacy: all seven types leave cash, and rent is never posted as an expense
    assert old[2021].cash_bal == -150
    assert new[2021].net_income < old[2021].net_income


def test_retained_earnings_lines(spark):
    from tallybook.operators.retained import retained_earnings
    led = make_ledger(spark, sales=[sale("2022-03-01", 2, 50)],
                      payments=[payment("2022-04-01", "rent", 10, id_=1),
                                payment("2022-05-01", "utility", 5, id_=2),
                                payment("2022-06-01", "wage", 7, id_=3)])
    rows = retained_earnings(led, calendars.calendar_monthly(spark)).collect()
    y = [r for r in rows if r.year == 2022]
    got = {r.transaction_type: (r.total_amount, r.running_total) for r in y}
    assert got["Revenue"] == (100, 100)
    assert got["Cost of Goods Sold"][0] is None          # no purchases: NULL, skipped in the total
    assert got["Wage Expense"] == (-7, 93)
    assert got["Operational Expense"] == (-15, 78)        # rent and utility on one line
    assert got["RE - Beginning Balance"] == (0, 0) and got["RE - Ending Balance"] == (0, 78)
    begins = [r for r in rows if r.transaction_type == "RE - Beginning Balance"]
    assert len(begins) == 30 and {r.year for r in begins} == set(range(2021, 2051))


def test_account_cash_lags_on_payment_date(spark):
    led = make_ledger(spark,
                      sales=[sale("2021-11-10", 1, 100, "credit", paid="2021-12-20", id_=1),
                             sale("2021-11-10", 1, 10, "cash", paid="2021-12-20", id_=2)],
                      payments=[payment("2021-06-01", "equipment", 30)])
    rows = {r.year: r.total_amount for r in accounts.account_cash(led).collect()}
    assert rows[2021] == 10 - 30 and rows[2022] == 10 - 30 + 100


def test_account_loan_is_cumulative(spark):
    led = make_ledger(spark, loans=[loan("2021-05-01", 500)],
                      payments=[payment("2022-05-01", "loan", 100)])
    rows = [(r.year, r.cumulative_loan_amount) for r in accounts.account_loan(led).collect()]
    assert rows == [(2021, 500), (2022, 400)]


def test_ppe_half_year_runs_down_to_zero(spark):
    led = make_ledger(spark, payments=[payment("2021-03-01", "equipment", 1000)])
    rows = {r.year: r.net_ppe_balance for r in ppe.ppe_half_year(led.payments).collect()}
    assert rows[2021] == 950 and rows[2022] == 850 and rows[2030] == 50 and rows[2031] == 0
    assert sorted(rows) == list(range(2021, 2032))


def test_flux_yoy_percent(spark):
    from tallybook.operators.reports import flux_yoy
    led = make_ledger(spark, sales=[sale("2021-06-01", 1, 100, id_=1), sale("2022-06-01", 1, 90, id_=2)])
    rev = {r.year: r for r in flux_yoy(build_statements(spark, led)).collect() if r.measure == "revenue"}
    assert rev[2021].yoy_pct is None and rev[2022].yoy_pct == Decimal("-10.00")


def test_statement_compare_values(spark):
    from tallybook.operators.reports import statement_compare
    led = make_ledger(spark, sales=[sale("2021-06-01", 1, 100, id_=1), sale("2022-06-01", 1, 90, id_=2)],
                      payments=[payment("2022-03-01", "rent", 40)], loans=[loan("2021-02-01", 500)])
    rows = {r.metric: r for r in statement_compare(build_statements(spark, led)).collect()}
    assert (rows["revenue"].y2021, rows["revenue"].y2022) == (100, 90)
    assert rows["net_income"].y2022 == 50 and rows["total_expenses"].y2022 == 40
    assert rows["cash"].y2021 == 600 and rows["cash"].y2022 == 650
    assert rows["debt_remaining"].section == "Balance Sheet" and rows["revenue"].section == "P&L"


def test_csv_load_names_every_bad_column(spark, tmp_path):
    raw = tmp_path / "sales"
    raw.mkdir()
    (raw / "part-0.csv").write_text(
        "id,sale_at,payment_at,payment_method,product_name,quantity,price\n"
        "1,2021-03-01,2021-03-08,cash,P,2,10.50\n"
        "2,2021-13-45,,credit,P,many,3.00\n")
    tables, rejects = load_ledger(spark, {"sales": str(raw)}, fmt="csv")
    ok = tables["sales"].collect()
    assert len(ok) == 1 and ok[0].quantity == 2 and ok[0].price == Decimal("10.50")
    bad = rejects.collect()
    assert len(bad) == 1 and bad[0].reason == "sale_at,quantity" and '"id":"2"' in bad[0].record


def _csv(tmp_path, name, text):
    folder = tmp_path / "raw" / name
    folder.mkdir(parents=True)
    (folder / "part-0.csv").write_text(text)
    return str(folder)


def test_load_rejects_wrong_field_counts_and_changed_values(spark, tmp_path):
    src = _csv(tmp_path, "sales", "id,sale_at,payment_at,payment_method,product_name,quantity,price\n"
               "1,2021-03-01,,cash,P,2,10.50\n"
               "2,2021-03-01\n"
               "3,2021-03-01,,cash,P,2,10.50,x,y\n"
               "4,2021-03-01,,cash,P,2,10.555\n"
               "5,2021-03-01 10:30:00,,cash,P,2,1\n"
               "6,2021-03-01,,cash,P,2,99999999999.00\n"
               "7,2021-03-01,,,,,\n")
    for target in (None, str(tmp_path / "ledger")):
        tables, rejects = load_ledger(spark, {"sales": src}, target_dir=target)
        assert sorted(r.id for r in tables["sales"].collect()) == [1, 7]
        got = sorted((r.reason, r.record) for r in rejects.collect())
        assert [g[0] for g in got] == ["field_count", "field_count", "price", "price", "sale_at"]
        assert got[0][1] == "2,2021-03-01" and got[1][1].startswith("3,") and "10.555" in got[2][1]


def test_empty_sources_load_and_refresh(spark, tmp_path):
    from tallybook.plans.pipeline import run_pipeline
    head = _csv(tmp_path, "sales", "id,sale_at,payment_at,payment_method,product_name,quantity,price\n")
    none = _csv(tmp_path, "loans", "")
    rent = _csv(tmp_path, "payments", "id,payment_date,payment_type,amount\n1,2021-03-01,rent,5.00\n")
    for k, sources in enumerate(({}, {"sales": head}, {"sales": head, "loans": none, "payments": rent})):
        out = run_pipeline(spark, sources, str(tmp_path / f"warehouse{k}"))
        assert out["rejects"].count() == 0 and out["sales"].count() == 0
        assert out["equipment_depreciation_schedule"].columns == ["id", "year", "gross_val", "annual_depreciation_expense"]
        assert out["equipment_depreciation_schedule"].count() == 0
        shown = [(r.year, r.net_income) for r in out["dashboard_flux_analysis"].collect()]
        assert shown == ([(2021, -5)] if "payments" in sources else [])


def test_stored_rows_that_do_not_fit_are_left_out(spark, tmp_path):
    from tallybook.sources.tables import read_ledger, read_ledger_rejects
    led = make_ledger(spark, sales=[sale("2021-12-15", 1, 5)])
    for name, df in led.tables().items():
        df.write.parquet(str(tmp_path / name))
    spark.createDataFrame([("1", "2021-02-01", "rent", 10.5), ("2", "2021-02-01", "rent", 1e15), ("3", "2021-02-30", "rent", 1.0)],
                          "id string, payment_date string, payment_type string, amount double").write.mode(
                              "overwrite").parquet(str(tmp_path / "payments"))
    assert [(r.id, r.amount) for r in read_ledger(spark, str(tmp_path)).payments.collect()] == [(1, Decimal("10.50"))]
    assert sorted(r.reason for r in read_ledger_rejects(spark, str(tmp_path)).collect()) == ["amount", "payment_date"]


def test_payments_without_an_id_column_keep_their_assets(spark):
    from tallybook.sources.loader import load_ledger as load
    raw = spark.createDataFrame([("2021-03-01", "equipment", "120.00"), ("2022-05-01", "equipment", "240.00")],
                                "payment_date string, payment_type string, amount string")
    payments = load(spark, {"payments": raw})[0]["payments"]
    rows = ppe.ppe_monthly(payments, calendars.calendar_monthly(spark)).collect()
    named = ppe.ppe_monthly(payments.withColumn("id", F.lit(7).cast("long")), calendars.calendar_monthly(spark)).collect()
    assert len(rows) > 10 and sorted(map(tuple, rows)) == sorted(map(tuple, named))


def test_a_new_file_is_seen_by_the_next_read(spark, tmp_path):
    import shutil

    from tallybook.sources.adapter import ledger_from_driver
    sf = "/root/testdata/sf0.001"
    for t in ("lineitem", "part", "supplier"):
        shutil.copy(f"{sf}/{t}.parquet", tmp_path / f"{t}.parquet")
    (tmp_path / "orders.parquet").mkdir()
    shutil.copy(f"{sf}/orders.parquet", tmp_path / "orders.parquet" / "a.parquet")
    assert ledger_from_driver(spark, str(tmp_path)).payments.count() == 1500
    shutil.copy(f"{sf}/orders.parquet", tmp_path / "orders.parquet" / "b.parquet")
    assert ledger_from_driver(spark, str(tmp_path)).payments.count() == 3000


def test_changed_rules_and_ranges_change_the_result(spark):
    import dataclasses
    led = make_ledger(spark, payments=[payment("2026-03-10", "wage", 100, id_=1), payment("2020-03-10", "equipment", 1000, id_=2)])
    late = dataclasses.replace(PIPELINE, accrual_years=(2026,))
    assert {r.rule for r in postings_for(spark, led, PIPELINE).collect()} == {"B5", "B7", "B8"}
    assert {"B14", "B16", "B17"} <= {r.rule for r in postings_for(spark, led, late).collect()}
    rows = {r.year: r for r in build_statements(spark, led, end_year=2027).collect()}
    assert rows[2026].net_income == -200 and rows[2027].gross_ppe == 1000      # wage accrued, asset still depreciating
    every = {r.year: r for r in build_statements(spark, led, end_year=None).collect()}
    assert every[2026].net_income == -200 and max(every) == 2026
    none = build_statements(spark, led, end_year=2027, accrual_years=()).collect()
    assert {r.year: r.net_income for r in none}[2026] == -100
