"""Property, plant & equipment: monthly straight-line and half-year views.

Monthly view (per asset, 10 years of calendar months):
    monthly     = amount / n,  n = the asset id's calendar months
    accumulated = running sum of monthly per id, by month (peers included)
    per year    = sum of accumulated over the year's rows, unioned with the
                  year's purchases, then a running total over years.

Scale: the equipment payments are first summed per (id, payment date), with
their count; everything later runs on these sums, so an id that holds a third
of all payments is as many rows as it has dates. A NULL id is an id like any
other. An id with a single payment has a schedule that depends only on its
date and is linear in its amount, so these ids are merged per date; an id with
several payments, whose months mix, gets its own month grid, reduced to
(id, month) before any window. The range join on the calendar is an equi-join
on the month bucket after generating the 121 candidate buckets; Spark sizes
that join. The division by n happens once per (year, n) group, in exact
decimals.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import amount, month_start, round2
from ..sources.schemas import FINE, REPORT
from .schedules import EQUIPMENT, LIFE_YEARS, depreciation_rate
from .statements import running_total

PPE_ACCOUNT = "Property, Plant & Equipment"
_KEYS = ["grp_id", "grp_date"]


def _equipment(payments: DataFrame) -> DataFrame:
    return payments.filter(F.col("payment_type") == EQUIPMENT).select(
        "id", "payment_date", "amount")


def schedule_groups(payments: DataFrame) -> DataFrame:
    """(grp_id, grp_date, payment_date, m, amount): one schedule per group.

    Single-payment ids are merged per payment date (grp_id NULL, m 1, the
    amounts summed: one asset stands for all). Other ids, NULL among them, keep
    a row per date (grp_date NULL) that stands for m payments. Null dates have
    no months, so their groups need no name of their own.
    """
    by_date = _equipment(payments).groupBy("id", "payment_date").agg(
        F.count(F.lit(1)).alias("m"), F.sum("amount").alias("amount"))
    # at most one row per date of an id in its window partition
    all_of_id = F.sum("m").over(Window.partitionBy("id"))
    single = F.col("of_id") == 1
    return (by_date.withColumn("of_id", all_of_id)
            .groupBy(F.when(~single, F.col("id")).alias("grp_id"),
                     F.when(single, F.col("payment_date")).alias("grp_date"), "payment_date",
                     single.alias("single"))
            .agg(F.sum("m").alias("m"), F.sum("amount").alias("amount"))
            .select(*_KEYS, "payment_date", F.when(F.col("single"), F.lit(1)).otherwise(F.col("m")).alias("m"),
                    "amount"))


def equipment_months(groups: DataFrame, calendar: DataFrame,
                     life_years: int = LIFE_YEARS) -> DataFrame:
    """Group rows x calendar dates in [payment, payment + life)."""
    months = 12 * life_years
    pd = F.col("payment_date")
    first = F.trunc(pd, "MM")
    g = groups.select(
        *_KEYS, "payment_date", "m", "amount",
        F.explode(F.sequence(first, F.add_months(first, months), F.expr("INTERVAL 1 MONTH")))
        .alias("bucket"))
    cal = calendar.select("calendar_at", "year", month_start(F.col("calendar_at")).alias("bucket"))
    rows = g.join(cal, "bucket")
    return rows.filter((F.col("calendar_at") >= pd) & (F.col("calendar_at") < F.add_months(pd, months)))


def _per_group_month(groups: DataFrame, calendar: DataFrame, life_years: int) -> DataFrame:
    """Per (group, month): m rows, amount sum a, the group's month count n, running A."""
    g = equipment_months(groups, calendar, life_years).groupBy(
        *_KEYS, "calendar_at", "year").agg(F.sum("m").alias("m"), F.sum("amount").alias("a"))
    whole = Window.partitionBy(*_KEYS)
    run = Window.partitionBy(*_KEYS).orderBy("calendar_at")
    return g.select("year", "m", "a",
                    F.sum("m").over(whole).alias("n"),
                    F.sum("a").over(run).alias("run_a"))


def _divide_by_n(df: DataFrame, numer: str) -> DataFrame:
    """sum over n of (sum of numer with that n) / n, per year; exact decimals."""
    per_n = df.groupBy("year", "n").agg(F.sum(numer).alias("s"))
    q = F.col("s").cast("decimal(30,2)") / F.col("n").cast("decimal(10,0)")
    return per_n.groupBy("year").agg(F.sum(q).alias("amt"))


def accumulated_depreciation_by_year(payments: DataFrame, calendar: DataFrame,
                                     life_years: int = LIFE_YEARS,
                                     groups: DataFrame | None = None) -> DataFrame:
    """Per year, the sum of every asset-month's accumulated depreciation (positive)."""
    groups = schedule_groups(payments) if groups is None else groups
    g = _per_group_month(groups, calendar, life_years)
    return _divide_by_n(g.withColumn("ma", F.col("m") * F.col("run_a")), "ma")


def periodic_depreciation_by_year(payments: DataFrame, calendar: DataFrame,
                                  life_years: int = LIFE_YEARS,
                                  groups: DataFrame | None = None) -> DataFrame:
    """Per year, the depreciation charged in that year's months (positive)."""
    groups = schedule_groups(payments) if groups is None else groups
    return _divide_by_n(_per_group_month(groups, calendar, life_years), "a")


def equipment_purchases_by_year(payments: DataFrame, groups: DataFrame | None = None) -> DataFrame:
    """Equipment bought per year. From the schedule groups when given: they
    carry every payment's amount (summed per date or per id and date), so the payments
    are not scanned again."""
    src = _equipment(payments) if groups is None else groups
    return src.groupBy(F.year("payment_date").alias("year")).agg(F.sum("amount").alias("amt"))


def ppe_monthly(payments: DataFrame, calendar: DataFrame, corrected: bool = False,
                life_years: int = LIFE_YEARS) -> DataFrame:
    """PP&E by year from the monthly schedule.

    As in the reference (default): accumulated depreciation is *added* to
    purchases and the rows are not grouped, so a year with both a purchase and
    depreciation appears twice and both rows carry the same running total.
    ``corrected=True``: one row per year, purchases minus the depreciation of
    that year's months, accumulated.
    """
    groups = schedule_groups(payments)
    # Cast before the union: Spark widens decimal(38,10) with decimal(38,2)
    # to decimal(38,2), which would round the depreciation to cents.
    buys = equipment_purchases_by_year(payments, groups).select(
        "year", F.col("amt").cast(FINE).alias("amt"))
    if not corrected:
        dep = accumulated_depreciation_by_year(payments, calendar, life_years, groups)
        u = dep.select("year", F.col("amt").cast(FINE).alias("amt")).unionByName(buys)
    else:
        dep = periodic_depreciation_by_year(payments, calendar, life_years, groups)
        u = buys.unionByName(dep.select("year", (-F.col("amt")).cast(FINE).alias("amt")))
        u = u.groupBy("year").agg(F.sum("amt").alias("amt"))
    return u.select(
        "year", F.lit(PPE_ACCOUNT).alias("account"),
        round2(running_total(F.col("amt"))).alias("total_amount"))


def ppe_half_year(payments: DataFrame, life_years: int = LIFE_YEARS) -> DataFrame:
    """Net PP&E: purchases minus half-year-convention depreciation, cumulative.

    Linear in cost, so equipment is summed per first year before the eleven
    depreciation events are generated: the fan-out runs on #years rows.
    """
    buys = equipment_purchases_by_year(payments)
    dep = buys.select(
        "year", "amt", F.explode(F.sequence(F.lit(0), F.lit(life_years))).alias("i")
    ).select((F.col("year") + F.col("i")).cast("int").alias("year"),
             amount(-(F.col("amt") * depreciation_rate(F.col("i"), life_years))).alias("amt"))
    events = buys.select("year", amount(F.col("amt")).alias("amt")).unionByName(dep)
    per_year = events.groupBy("year").agg(F.sum("amt").alias("amt"))
    return per_year.select(
        "year", F.lit(PPE_ACCOUNT).alias("account"),
        round2(running_total(F.col("amt"))).cast(REPORT).alias("net_ppe_balance"),
    ).orderBy(F.col("year").asc_nulls_last())
