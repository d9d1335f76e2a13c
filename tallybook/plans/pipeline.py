"""End-to-end plans: ledger -> schedules -> postings -> summaries -> statements.

Everything here is one lazy DataFrame plan; nothing is collected. The driver
only builds the plan, Catalyst optimises it and AQE sizes the shuffles.
"""

from __future__ import annotations

import datetime as dt
import os
from collections.abc import Iterable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.calendars import (YEARLY_END, YEARLY_START, activity_span, calendar_monthly,
                                   calendar_yearly, calendar_years)
from ..operators.schedules import ACCRUAL_YEARS, accrual_schedule, depreciation_schedule
from ..operators.postings import LEGACY, PIPELINE, RuleSet, ledger_postings
from ..operators.statements import (DASHBOARD_END_YEAR, LEGACY_END_YEAR, dashboard,
                                    yearly_summaries)
from ..refresh.graph import Derived, refresh
from ..sources.adapter import Ledger, ledger_from_driver
from ..sources.loader import OK, load_ledger
from ..sources.schemas import LEDGER_SCHEMAS
from ..sources.tables import create_or_replace_view
from ..sources.versions import read_version


DEFAULT = "default"


def default_years(spark: SparkSession, start: dt.date = YEARLY_START,
                  end: dt.date = YEARLY_END) -> DataFrame:
    return calendar_years(calendar_yearly(spark, start, end))


def activity_years(spark: SparkSession, ledger: Ledger) -> DataFrame:
    """Every year from the first to the last date of any ledger activity."""
    return calendar_years(calendar_yearly(spark, span=activity_span(ledger)))


def postings_for(spark: SparkSession, ledger: Ledger, rules: RuleSet = PIPELINE,
                 end_year: int | None = None, years: DataFrame | None = None,
                 by_rule: bool = True) -> DataFrame:
    """Postings of a ledger; ``years`` (default: the default calendar) bound the
    depreciation."""
    years = default_years(spark) if years is None else years
    return ledger_postings(ledger, years, rules, end_year=end_year, by_rule=by_rule)


def _statements(spark: SparkSession, ledger: Ledger, rules: RuleSet, end_year: int | None, default_end: int,
                years: DataFrame | None, accrual_years: Iterable[int] | None | str,
                carry_forward: bool = False, ordered: bool = True, **names: str) -> DataFrame:
    """Years beyond a rule set's own end have their depreciation and accruals
    too: the defaults of both ranges stretch to ``end_year``."""
    later = end_year is None or end_year > default_end
    if years is None:
        if end_year is None:
            years = activity_years(spark, ledger)
        elif later:
            years = default_years(spark, end=max(YEARLY_END, dt.date(end_year, 12, 31)))
    if accrual_years != DEFAULT:
        rules = replace(rules, accrual_years=None if accrual_years is None else tuple(accrual_years))
    elif end_year is None:
        rules = replace(rules, accrual_years=None)
    elif later:
        rules = replace(rules, accrual_years=tuple(range(min(rules.accrual_years), end_year + 1)))
    post = postings_for(spark, ledger, rules, end_year=end_year, years=years, by_rule=False)
    return dashboard(yearly_summaries(post), end_year, rules, carry_forward=carry_forward, ordered=ordered, **names)


def _as_ledger(spark: SparkSession, ledger: Ledger | str) -> Ledger:
    """A Ledger, or a folder of the driver's tables opened through the adapter."""
    return ledger_from_driver(spark, ledger) if isinstance(ledger, str) else ledger


def build_statements(spark: SparkSession, ledger: Ledger | str,
                     end_year: int | None = DASHBOARD_END_YEAR, years: DataFrame | None = None,
                     carry_forward: bool = False,
                     accrual_years: Iterable[int] | None | str = DEFAULT, ordered: bool = True) -> DataFrame:
    """The yearly dashboard (income statement and balance sheet measures).

    ``end_year`` is the last year shown, ``None`` every year of the ledger.
    ``years`` is the calendar that bounds depreciation, ``accrual_years`` the
    payment years that accrue (``None``: all); by default both are the
    reference's, stretched to a later ``end_year``.
    """
    return _statements(spark, _as_ledger(spark, ledger), PIPELINE, end_year, DASHBOARD_END_YEAR, years,
                       accrual_years, carry_forward, ordered)


def audit_summaries(spark: SparkSession, ledger: Ledger | str, years: DataFrame | None = None,
                    rules: RuleSet = PIPELINE) -> DataFrame:
    """Yearly summaries that carry the audits' components, one reading of each table:
    for ``audits.audit_revenue_of`` and ``audits.audit_cash_of``."""
    years = default_years(spark) if years is None else years
    return yearly_summaries(ledger_postings(_as_ledger(spark, ledger), years, rules, by_rule=False, audit=True))


def build_legacy_statements(spark: SparkSession, ledger: Ledger | str,
                            end_year: int | None = LEGACY_END_YEAR, years: DataFrame | None = None,
                            accrual_years: Iterable[int] | None | str = DEFAULT) -> DataFrame:
    """The older variant; arguments as in ``build_statements``."""
    return _statements(spark, _as_ledger(spark, ledger), LEGACY, end_year, LEGACY_END_YEAR, years, accrual_years,
                       cash_name="cash_bal", inventory_name="inventory_bal")


def run_pipeline(spark: SparkSession, sources: dict, target_dir: str,
                 end_year: int = DASHBOARD_END_YEAR, fmt: str = "csv",
                 options: dict | None = None, calendar_start: dt.date = YEARLY_START,
                 calendar_end: dt.date | None = None,
                 accrual_years: Iterable[int] | None = None) -> dict[str, DataFrame]:
    """The whole refresh: load the raw tables, rebuild what is stale, create the view.

    1. ``load_ledger``: typed tables and rejects, each the next version of its table
       below ``target_dir``, unless the records are the same as before;
    2. the calendars and the depreciation and accrual schedules (as the reference
       creates them), those only whose inputs or settings have changed (``refresh``);
    3. the statements as the live view ``dashboard_flux_analysis`` over the
       loaded tables.

    Every table is published when it is whole: a run that fails leaves the tables
    before readable and is made up for by the next one. The calendar ends with 2025,
    the accruals with 2023, or with a later ``end_year``, unless given. Tables that
    are absent or have no rows are empty ledger tables. Every step is a Spark job;
    nothing passes through the driver.
    """
    raw = os.path.join(target_dir, "raw")
    sources = {n: sources.get(n, spark.createDataFrame([], s)) for n, s in LEDGER_SCHEMAS.items()}
    tables, rejects = load_ledger(spark, sources, raw, fmt=fmt, options=options, versioned=True)
    ledger = Ledger(**tables)
    calendar_end = calendar_end or max(YEARLY_END, dt.date(end_year, 12, 31))
    accrual_years = tuple(accrual_years or range(min(ACCRUAL_YEARS), max(*ACCRUAL_YEARS, end_year) + 1))
    derived = derived_tables(calendar_start, calendar_end, accrual_years)
    refresh(spark, target_dir, derived, at={n: os.path.join(raw, n) for n in LEDGER_SCHEMAS})
    out = {"rejects": rejects}
    for t in derived:
        out[t.name] = create_or_replace_view(read_version(spark, os.path.join(target_dir, t.name)), t.name)
    years = calendar_years(out["calendar"])
    out["dashboard_flux_analysis"] = create_or_replace_view(
        build_statements(spark, ledger, end_year, years, accrual_years=accrual_years), "dashboard_flux_analysis")
    out.update(tables)
    return out


def derived_tables(calendar_start: dt.date, calendar_end: dt.date, accrual_years: tuple[int, ...]) -> list[Derived]:
    """The snapshot tables of ``run_pipeline`` and what they are made from. Raw
    payments hold their rejects too (``_status``)."""
    def loaded(payments: DataFrame) -> DataFrame:
        return payments.filter(F.col("_status") == OK)

    return [
        Derived("calendar", (), lambda spark, _: calendar_yearly(spark, calendar_start, calendar_end),
                settings=f"{calendar_start}..{calendar_end}"),
        Derived("calendar_monthly", (), lambda spark, _: calendar_monthly(spark)),
        Derived("equipment_depreciation_schedule", ("payments", "calendar"),
                lambda spark, t: depreciation_schedule(loaded(t["payments"]), calendar_years(t["calendar"])),
                partition_by=("year",)),  # at most 9,999 year folders; readers filter by year
        Derived("expense_accrual_schedule", ("payments",),
                lambda spark, t: accrual_schedule(loaded(t["payments"]), years=accrual_years),
                settings=",".join(map(str, accrual_years))),
    ]
