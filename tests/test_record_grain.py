"""Interval joins, balances by record, located differences and clustered files."""

from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from plan_report import shape
from tallybook.operators import balances, intervals, locate
from tallybook.sources import clustered
from tallybook.sources.adapter import ledger_from_driver
from tallybook.sources.versions import current_version

SF = "/root/testdata/sf0.01"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# --- interval join -------------------------------------------------------------

def pairs_plain(points, spans):
    """points (id, key, x), spans (id, key, lo, hi)."""
    return sorted((p, s) for p, k, x in points for s, g, lo, hi in spans
                  if None not in (k, x, lo, hi) and k == g and lo <= x < hi)


@pytest.mark.parametrize("dense", [3, 500_000])
def test_intervals_of_all_lengths_against_the_theta_join(spark, dense):
    rnd = random.Random(1)
    points = [(k, rnd.choice("ab"), rnd.randrange(-3000, 3000)) for k in range(300)]
    points += [(1000 + k, "a", 77) for k in range(60)]  # one dense point
    points += [(2000, None, 5), (2001, "a", None)]
    spans = []
    for k in range(200):
        lo = rnd.randrange(-3000, 3000)
        spans.append((k, rnd.choice("ab"), lo, lo + rnd.choice([0, -5, 1, 1, 2, 7, 8, 9, 63, 64, 65, 500, 4000])))
    spans += [(900, "a", -10 ** 15, 10 ** 15), (901, "a", 77, 78), (902, "a", None, 5), (903, "a", 5, None), (904, None, 0, 9)]
    ps = spark.createDataFrame(points, "p long, k string, x long")
    ss = spark.createDataFrame(spans, "s long, k string, lo long, hi long")
    got = intervals.interval_join(ps, ss, "x", "lo", "hi", ("k",), dense=dense)
    assert got.columns == ["p", "k", "x", "s", "lo", "hi"]
    assert sorted((r["p"], r["s"]) for r in got.collect()) == pairs_plain(points, spans)
    assert shape(got)["nested_loop"] == 0
    # without keys, and with names that both sides have
    other = ss.withColumnRenamed("s", "p")
    got = intervals.interval_join(ps.select("p", "x"), other.drop("k"), "x", "lo", "hi", dense=dense)
    assert sorted((r[0], r[2]) for r in got.collect()) == pairs_plain([(p, 1, x) for p, _, x in points], [(s, 1, a, b) for s, _, a, b in spans])


def test_dates_and_timestamps(spark):
    day = dt.date(1969, 12, 30)
    ps = spark.createDataFrame([(k, day + dt.timedelta(k)) for k in range(60)], "p long, d date")
    ss = spark.createDataFrame([(0, day, day + dt.timedelta(1)), (1, day, dt.date(9999, 12, 31)), (2, day + dt.timedelta(1), day + dt.timedelta(31))],
                               "s long, a date, b date")
    want = sorted([(0, 0), *[(k, 1) for k in range(60)], *[(k, 2) for k in range(1, 31)]])
    got = intervals.interval_join(ps, ss, "d", "a", "b")
    assert sorted((r["p"], r["s"]) for r in got.collect()) == want
    stamped = [df.select(*(F.col(c).cast("timestamp").alias(c) if t == "date" else c for c, t in df.dtypes)) for df in (ps, ss)]
    got = intervals.interval_join(*stamped, "d", "a", "b")
    assert sorted((r["p"], r["s"]) for r in got.collect()) == want
    with pytest.raises(ValueError):
        intervals.interval_join(spark.createDataFrame([(1.0,)], "d double"), ss, "d", "a", "b")
    assert intervals.interval_join(ps, ss.limit(0), "d", "a", "b").collect() == []


def test_an_interval_lies_in_nine_bins_at_the_most(spark):
    lengths = [1, 2, 7, 8, 9, 63, 64, 100, 511, 512, 10 ** 6, 2 ** 40 + 3]
    df = spark.createDataFrame([(lo, lo + n) for n in lengths for lo in (-7, 0, 5, 123_456_789)], "lo long, hi long")
    level = intervals.level_of(F.col("lo"), F.col("hi"))
    bins = df.select("lo", "hi", level.alias("l"), (intervals._bin(F.col("hi") - 1, level) - intervals._bin(F.col("lo"), level) + 1).alias("n")).collect()
    assert all(1 <= r["n"] <= 9 for r in bins)
    assert all(8 ** r["l"] <= r["hi"] - r["lo"] < 8 ** (r["l"] + 1) for r in bins)


def test_a_dense_bin_is_dealt_to_many_tasks(spark):
    ps = spark.range(4000).selectExpr("id as p", "5L as x")
    ss = spark.createDataFrame([(0, 0, 10), (1, 5, 6)], "s long, lo long, hi long")
    got = intervals.interval_join(ps, ss, "x", "lo", "hi", dense=100)
    assert got.count() == 8000
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        per_task = intervals.interval_join(ps, ss, "x", "lo", "hi", dense=100).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(per_task) >= 6 and max(r["count"] for r in per_task) < 8000 / 2


# --- balances by record -----------------------------------------------------------

def balances_plain(rows, keyed):
    """(id, key, order, value) with the sum over all rows of the key up to and with its peers."""
    out = []
    for i, k, o, v in rows:
        upto = [x[3] for x in rows if (not keyed or x[1] == k) and x[3] is not None
                and (o is None or (x[2] is not None and x[2] <= o))]
        out.append((i, k, o, v, sum(upto, Decimal(0)) if upto else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("keyed", [False, True])
@pytest.mark.parametrize("ranges", [1, 5, 40])
def test_balances_with_ties_nulls_and_a_hot_day(spark, keyed, ranges):
    rnd = random.Random(ranges)
    days = [None, *[dt.date(2021, 1, 1) + dt.timedelta(k) for k in range(30)]]
    rows = [(k, rnd.choice(["a", "b", None]), rnd.choice(days), None if rnd.random() < 0.15 else Decimal(rnd.randrange(-900, 900)) / 100)
            for k in range(250)]
    rows += [(k, "a", dt.date(2021, 1, 9), Decimal("1.10")) for k in range(300, 500)]  # a third on one day, over many ranges
    rows += [(900, "a", dt.date(2021, 1, 9), Decimal("1.10"))] * 3 + [(901, "c", days[3], None), (902, "c", days[5], None)]
    df = spark.createDataFrame(rows, "id long, k string, d date, v decimal(12,2)")
    got = balances.running_records(df, "v", "d", ("k",) if keyed else (), ranges=ranges)
    assert sorted(((*r[:4], None if r[4] is None else r[4]) for r in map(tuple, got.collect())), key=repr) == \
        sorted(((*r[:4], None if r[4] is None else r[4].quantize(Decimal("0.0001"))) for r in balances_plain(rows, keyed)), key=repr)
    assert got.schema["balance"].dataType == DecimalType(38, 4)


def test_no_task_gets_all_records(spark):
    df = spark.range(20_000).selectExpr("id", "date_add(date'2021-01-01', cast(id % 3 as int)) as d", "cast(id as decimal(12,2)) as v")
    got = balances.running_records(df, "v", "d", ranges=16)
    plan = got._jdf.queryExecution().executedPlan().toString()
    # only sums of ranges meet in one partition
    for line in (x for x in plan.splitlines() if "SinglePartition" in x):
        assert "Exchange SinglePartition" in line
    below = plan.split("Exchange SinglePartition")[1:]
    assert below and all("HashAggregate" in x.split("FileScan")[0] or "SortAggregate" in x.split("FileScan")[0] for x in below)
    assert got.agg(F.max("balance")).first()[0] == sum(range(20_000))


def test_balances_of_nothing(spark):
    df = spark.createDataFrame([], "id long, d date, v decimal(12,2)")
    assert balances.running_records(df, "v", "d").collect() == []


# --- located differences ----------------------------------------------------------------

def test_planted_differences_are_found_exactly(spark):
    led = ledger_from_driver(spark, SF)
    left = led.sales
    right = left.filter("id % 3001 <> 5").withColumn("price", F.when(F.col("id") % 4003 == 8, F.col("price") + 1).otherwise(F.col("price")))
    planted = left.filter("id % 3001 = 5 or id % 4003 = 8")
    got = locate.locate_differences(left, right, "sale_at", "product_name")
    assert rows_of(got.filter("n_left > n_right").select(*left.columns)) == rows_of(planted)
    assert got.filter("n_right > n_left").count() == right.filter("id % 4003 = 8").count() > 0
    assert locate.locate_differences(left, left.repartition(3), "sale_at", "product_name").count() == 0


def test_null_dates_products_and_repeats(spark):
    ddl = "id long, d date, p string, n int"
    rows = [(1, None, "a", 1), (2, dt.date(2021, 5, 5), None, 1), (3, dt.date(2021, 5, 5), "a", None), (3, dt.date(2021, 5, 5), "a", None),
            (4, dt.date(2022, 1, 1), "b", 1)]
    left, right = spark.createDataFrame(rows, ddl), spark.createDataFrame(rows[1:3] + [(1, None, "a", 2)] + rows[4:], ddl)
    got = locate.locate_differences(left, right, "d", "p")
    assert rows_of(got) == sorted([(None, None, 1, None, "a", 1, 1, 0), (None, None, 1, None, "a", 2, 0, 1),
                                   (2021, 5, 3, dt.date(2021, 5, 5), "a", None, 2, 1)], key=repr)


def test_only_differing_months_are_read_again(spark, tmp_path):
    led = ledger_from_driver(spark, SF)
    led.sales.write.parquet(str(tmp_path / "l"))
    led.sales.filter("id <> 17").filter("not (month(sale_at) = 3 and year(sale_at) = 2021 and id % 5 = 0)").write.parquet(str(tmp_path / "r"))
    left, right = (spark.read.parquet(str(tmp_path / x)) for x in "lr")
    sides = locate.narrowed(left, right, "sale_at")
    seen = {(r[0], r[1]) for df in sides for r in df.select(F.year("sale_at"), F.month("sale_at")).distinct().collect()}
    of_17 = {(r[0], r[1]) for r in left.filter("id = 17").select(F.year("sale_at"), F.month("sale_at")).collect()}
    assert seen == {(2021, 3)} | of_17
    plan = sides[0]._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(sale_at,2021-03-01)" in plan and "LessThan(sale_at,2021-04-01)" in plan


def test_month_ranges():
    d = dt.date
    assert locate.month_ranges([(2021, 12), (2022, 1), (2022, 3)]) == [(d(2021, 12, 1), d(2022, 2, 1)), (d(2022, 3, 1), d(2022, 4, 1))]
    many = [(2000 + k, 1) for k in range(0, 60, 2)] + [(2000, 3)]
    few = locate.month_ranges(many, most=5)
    assert len(few) == 5 and all(any(a <= d(y, m, 1) < b for a, b in few) for y, m in many) and locate.month_ranges([]) == []


# --- clustered files ------------------------------------------------------------------------

def test_clustered_files_are_skipped_and_rows_whole(spark, tmp_path):
    led, table = ledger_from_driver(spark, SF), str(tmp_path / "sales")
    hot = led.sales.filter("id % 2 = 0").withColumn("product_name", F.lit("hot"))
    sales = led.sales.unionByName(hot).unionByName(led.sales.limit(50).withColumns({"sale_at": F.lit(None).cast("date"), "product_name": F.lit(None).cast("string")}))
    sales = sales.cache()
    version = clustered.write_clustered(sales, table, "sale_at", "product_name", files=64)
    assert version == current_version(spark, table)
    assert rows_of(clustered.read_clustered(spark, table)) == rows_of(sales)
    every = len(clustered.files_for(spark, table))
    assert 48 <= every <= 64
    product = sales.filter("product_name <> 'hot'").first()["product_name"]
    since, before = dt.date(2021, 1, 1), dt.date(2022, 1, 1)
    year = clustered.files_for(spark, table, since, before)
    one = clustered.files_for(spark, table, product=product)
    both = clustered.files_for(spark, table, since, before, product)
    # in the order of arrival each of these opens all files: at least 2.5, 4 and 8 times as many
    assert len(year) * 2.5 <= every and len(one) * 4 <= every and len(both) * 8 <= every
    cond = (F.col("sale_at") >= since) & (F.col("sale_at") < before)
    assert rows_of(clustered.read_clustered(spark, table, since, before)) == rows_of(sales.filter(cond))
    for p in (product, "hot", "no such"):
        assert rows_of(clustered.read_clustered(spark, table, since, before, p)) == rows_of(sales.filter(cond & (F.col("product_name") == p)))
    sizes = [r["n"] for r in clustered.file_stats(spark, table, version).collect()]
    assert max(sizes) < 6 * sum(sizes) / len(sizes)  # a third of the rows is one product
    sales.unpersist()
