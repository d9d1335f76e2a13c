"""Plan checks: what must hold at any scale, read from the physical plans."""

from __future__ import annotations

import re

import pytest

from plan_report import shape
from tallybook.plans.catalog import QUERIES
from tallybook.sources.adapter import ledger_from_driver
from tallybook.operators.postings import product_costs, sales_by_product, sales_posts
from tallybook.operators.schedules import accrual_schedule

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_nested_loop_or_cartesian_join(spark, name):
    assert shape(QUERIES[name](spark, SF))["nested_loop"] == 0


def test_postings_scan_is_pruned(spark):
    led = ledger_from_driver(spark, SF)
    plan = sales_by_product(led.sales).groupBy("y_sale").agg({"value": "sum"})._jdf.queryExecution().executedPlan().toString()
    line = [x for x in plan.splitlines() if "FileScan parquet" in x and "l_shipdate" in x][0]
    cols = line[line.index("[") + 1:line.index("]")].split(",")
    assert len(cols) <= 5          # 5 of lineitem's 11 columns
    assert "l_comment" not in line and "l_extendedprice" not in line


def test_year_filter_reaches_the_scan(spark, tmp_path):
    from tests.conftest import make_ledger, payment
    path = str(tmp_path / "payments")
    make_ledger(spark, payments=[payment("2022-05-01", "wage", 10)]).payments.write.parquet(path)
    df = accrual_schedule(spark.read.parquet(path))
    plan = spark.sparkContext._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    pushed = [x for x in plan.splitlines() if x.startswith("PushedFilters")][0]
    assert "GreaterThanOrEqual(payment_date,2021-01-01)" in pushed
    assert "LessThan(payment_date,2024-01-01)" in pushed


def test_dashboard_windows_follow_one_single_partition_exchange(spark):
    s = shape(QUERIES["dashboard_flux"](spark, SF))
    assert s["single"] == 1 and s["windows"] == 1


def test_postings_read_sales_once(spark):
    """Sales and purchases both are reads of lineitem, told apart by the return flag."""
    plan = QUERIES["ledger_postings"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    flags = [re.search(r"(Not\()?EqualTo\(l_returnflag,R\)", x)[0] for x in plan.splitlines()
             if "FileScan parquet" in x and "l_returnflag" in x]
    assert sorted(flags) == ["EqualTo(l_returnflag,R)", "EqualTo(l_returnflag,R)", "Not(EqualTo(l_returnflag,R)"]
    plan = QUERIES["account_inventory"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert sum("FileScan parquet" in x and "l_returnflag" in x for x in plan.splitlines()) == 2


def test_keyed_loads_are_made_and_read_once(spark):
    """Winners and rejects come from one reading of the loads: of sales and of purchases one of lineitem each."""
    plan = QUERIES["keyed_load"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert sum("FileScan parquet" in x and "l_returnflag" in x for x in plan.splitlines()) == 2


def test_keyed_loads_are_compiled(spark):
    """No method beyond the 8000 bytes up to which the JVM compiles; longer ones are interpreted."""
    was = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        code = spark.sparkContext._jvm.PythonSQLUtils.explainString(QUERIES["keyed_load"](spark, SF)._jdf.queryExecution(), "codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", was)
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", code)]
    assert len(sizes) > 8 and max(sizes) < 8000


def test_audited_years_reach_the_scans(spark):
    from tallybook.operators.audits import cash_components
    from tests.conftest import make_ledger, sale
    led = make_ledger(spark, sales=[sale("2020-12-15", 1, 5, "credit"), sale("2020-12-15", 1, 7), sale("2021-12-15", 1, 9, "credit"),
                                    sale("2021-06-15", 1, 11), sale("2020-11-30", 1, 13, "credit")])
    got = cash_components(led, [2021]).collect()
    assert [(r.year, r.sales_cash_in) for r in got] == [(2021, 16)]


@pytest.mark.parametrize("name", ["audit_revenue", "audit_cash", "audit_revenue_2021", "audit_cash_2021"])
def test_audits_read_each_table_once(spark, name):
    """Statements and components together: the scans of the dashboard alone."""
    assert shape(QUERIES[name](spark, SF))["scans"] == shape(QUERIES["dashboard_flux"](spark, SF))["scans"] <= 9


def test_audits_of_stored_statements_agree_with_the_shared_reading(spark):
    from tallybook.operators import audits
    from tallybook.plans.pipeline import build_statements
    led = ledger_from_driver(spark, SF)
    built = build_statements(spark, led)
    for name, own in (("audit_revenue", audits.audit_revenue(built, led.sales)), ("audit_cash", audits.audit_cash(built, led))):
        assert sorted(map(tuple, own.collect())) == sorted(map(tuple, QUERIES[name](spark, SF).collect()))


def _children_of(plan_text: str, node: str) -> list[str]:
    """Lines directly below each ``node`` line in an indented tree string."""
    lines = plan_text.splitlines()
    out = []
    for i, line in enumerate(lines):
        if node in line:
            depth = len(line) - len(line.lstrip(" :+-"))
            for nxt in lines[i + 1:]:
                d = len(nxt) - len(nxt.lstrip(" :+-"))
                if d <= depth:
                    break
                out.append(nxt.strip(" :+-"))
    return out


def test_product_join_reads_aggregates_only(spark):
    """A product with a third of all sales is a few rows at the join."""
    led = ledger_from_driver(spark, SF)
    df = sales_posts(sales_by_product(led.sales), product_costs(led.purchases))
    plan = df._jdf.queryExecution().executedPlan().treeString()
    plan = plan.split("== Initial Plan ==")[-1]
    joins = [x for x in plan.splitlines()
             if ("SortMergeJoin" in x or "BroadcastHashJoin" in x) and "product_name" in x]
    assert joins
    for line in joins:
        below = _children_of(plan, line.strip(" :+-"))
        # each side of the product join is a HashAggregate before any scan
        firsts = [x for x in below if x.startswith(("HashAggregate", "FileScan"))]
        assert firsts and firsts[0].startswith("HashAggregate"), firsts[:3]


def test_windows_never_read_raw_scans_directly(spark):
    for name in ("dashboard_flux", "ppe_monthly", "retained_earnings", "monthly_cash", "account_inventory"):
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().treeString()
        plan = plan.split("== Initial Plan ==")[-1]
        windows = [x for x in plan.splitlines() if x.strip(" :+-").startswith("Window ")]
        assert windows, name
        for line in windows:
            below = _children_of(plan, line.strip(" :+-"))
            firsts = [x for x in below if x.startswith(("HashAggregate", "FileScan"))]
            assert firsts and firsts[0].startswith("HashAggregate"), (name, firsts[:3])


def test_cluster_conf_sizes_the_shuffle():
    from tallybook.session import cluster_conf
    tb100 = cluster_conf(100 * 1024 ** 4)
    assert int(tb100["spark.sql.shuffle.partitions"]) == int(100 * 1024 ** 4 * 0.05 // (256 * 1024 ** 2))
    assert int(cluster_conf(10 * 1024 ** 5)["spark.sql.shuffle.partitions"]) == int(10 * 1024 ** 5 * 0.05 // (256 * 1024 ** 2))  # no ceiling
    assert tb100["spark.sql.adaptive.enabled"] == "true"
    assert tb100["spark.sql.adaptive.skewJoin.enabled"] == "true"
    assert int(cluster_conf(10)["spark.sql.shuffle.partitions"]) == 200  # floor for small inputs


def test_session_is_sized_from_the_files(spark):
    from tallybook.session import size_session
    keys = ("spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.skewJoin.skewedPartitionFactor",
            "spark.sql.autoBroadcastJoinThreshold")
    before = {k: spark.conf.get(k) for k in keys}
    try:
        size_session(spark, [SF])
        assert int(spark.conf.get("spark.sql.shuffle.partitions")) >= 8
        assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == str(128 * 1024 ** 2)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
