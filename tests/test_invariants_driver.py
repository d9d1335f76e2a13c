
from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tallybook.operators import audits, calendars, schedules
from tallybook.plans.pipeline import build_statements
from tallybook.sources.adapter import ledger_from_driver

SF = "/root/testdata/sf0.001"


def test_revenue_audit_matches_for_reported_years(spark):
    led = ledger_from_driver(spark, SF)
    rows = audits.audit_revenue(build_statements(spark, led), led.sales, years=range(2020, 2024)).collect()
    assert rows and all(r.is_match for r in rows)


def test_each_asset_depreciates_to_its_cost(spark):
    led = ledger_from_driver(spark, SF)
    years = calendars.calendar_years(calendars.calendar_yearly(spark, dt.date(2000, 1, 1), dt.date(2060, 1, 1)))
    sched = schedules.depreciation_schedule(led.payments, years)
    bad = (sched.groupBy("id").agg(F.sum("annual_depreciation_expense").alias("d"),
                                   F.max("gross_val").alias("cost"), F.count("*").alias("n"))
           .filter((F.col("d") != F.col("cost")) | (F.col("n") != 11)))
    assert bad.count() == 0
