"""Refresh: weighted records, merged partials, versions, refresh order, keyed loads."""

from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallybook.operators import changes
from tallybook.operators.postings import ledger_postings
from tallybook.plans.pipeline import build_statements, default_years, run_pipeline
from tallybook.refresh import graph, keyed, partials, statements
from tallybook.sources import versions
from tallybook.sources.adapter import Ledger, ledger_from_driver
from tallybook.sources.loader import as_text
from tallybook.sources.schemas import LEDGER_SCHEMAS
from tallybook.streaming import compact_live_postings, live_statements, start_live_postings

from .conftest import make_ledger, purchase, sale

SF = "/root/testdata/sf0.001"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def rebuilt(spark, ledger):
    return rows_of(ledger_postings(ledger, default_years(spark)).select("rule", "year", "account", "amt"))


def from_states(spark, states):
    p = changes.postings_from(states, default_years(spark))
    return rows_of(p.select("rule", "year", "account", "amt"))


def states_of(parts):
    """Merged states of several ledgers of weighted rows."""
    out = {}
    for t in LEDGER_SCHEMAS:
        one = None
        for part in parts:
            s = changes.state_of(t, part[t])
            one = s if one is None else one.unionByName(s)
        out[t] = changes.merged(t, one)
    return out


def random_rows(rnd, n):
    def day():
        return None if rnd.random() < 0.08 else dt.date(2019, 1, 1) + dt.timedelta(rnd.randrange(2200))

    def money(hi):
        return None if rnd.random() < 0.1 else Decimal(rnd.randrange(1, hi)) / 100

    products = ["a", "b", "c", None]
    method = lambda: rnd.choice(["cash", "credit", None])
    quantity = lambda: None if rnd.random() < 0.1 else rnd.randrange(1, 9)
    return {
        "sales": [(k, day(), day(), method(), rnd.choice(products), quantity(), money(9000)) for k in range(n)],
        "purchases": [(k, day(), day(), method(), rnd.choice(products), quantity(),
                       rnd.choice([None, Decimal("1.00"), Decimal("2.50"), Decimal("3.10")])) for k in range(n)],
        "payments": [(k, day(), rnd.choice(["equipment", "wage", "tax", "utility", "loan", "rent", "interest", "odd", None]),
                      money(50_000)) for k in range(n)],
        "loans": [(k, day(), money(90_000)) for k in range(n // 3)],
    }


def ledger_of(spark, rows):
    return make_ledger(spark, **rows)


# --- weighted records -----------------------------------------------------------

@pytest.mark.parametrize("seed", range(3))
def test_withdrawals_equal_a_rebuild(spark, seed):
    rnd = random.Random(seed)
    rows, fresh = random_rows(rnd, 120), random_rows(rnd, 120)
    gone = {t: [r for r in rows[t] if rnd.random() < 0.4] for t in rows}
    if seed == 2:  # all of a table, and all of a product
        gone["loans"] = rows["loans"]
        gone["purchases"] = [r for r in rows["purchases"] if r[4] == "a" or rnd.random() < 0.3]
    new = {t: fresh[t][:len(gone[t])] for t in rows}
    left = {t: [r for r in rows[t] if r not in gone[t]] + new[t] for t in rows}
    base, out, put = (ledger_of(spark, x).tables() for x in (rows, gone, new))
    edits = {t: changes.replaced(out[t], put[t]) for t in rows}
    want = rebuilt(spark, ledger_of(spark, left))
    # withdrawals come before, between and after what they withdraw
    for parts in ([base, edits], [edits, base]):
        assert from_states(spark, states_of(parts)) == want


def test_a_cost_counts_while_one_purchase_has_it(spark):
    led = make_ledger(spark, sales=[sale("2021-05-01", 10, 9)],
                      purchases=[purchase("2021-01-01", 1, 2, id_=1), purchase("2020-01-01", 1, 2, id_=2),
                                 purchase("2021-01-01", 1, 3, id_=3), purchase("2021-01-01", 1, None, id_=4)])

    def cogs(*withdrawn):
        taken = changes.weighted(led.purchases.filter(F.col("id").isin(list(withdrawn))), -1)
        none = {t: changes.weighted(df.limit(0), 1) for t, df in led.tables().items()}
        states = states_of([led.tables(), {**none, "purchases": taken}])
        return {r[0]: r[3] for r in from_states(spark, states)}.get("B6")

    assert cogs() == -50 and cogs(1) == -50 and cogs(1, 2) == -30 and cogs(1, 2, 3) is None
    assert cogs(3) == -20 and cogs(1, 2, 3, 4) is None


def test_states_that_cancel_leave_nothing(spark):
    led = ledger_from_driver(spark, SF).tables()
    states = states_of([led, {t: changes.weighted(df, -1) for t, df in led.items()}])
    assert all(s.count() == 0 for s in states.values())


# --- versions -----------------------------------------------------------------------

def test_a_failed_write_leaves_the_old_version_readable(spark, tmp_path):
    table = str(tmp_path / "t")
    assert versions.read_version(spark, table) is None and versions.current_version(spark, table) is None
    versions.save_version(spark.range(5), table)
    old = versions.read_version(spark, table)
    broken = spark.range(100).select(F.when(F.col("id") == 99, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="broken"):
        versions.save_version(broken, table)
    assert versions.read_version(spark, table).count() == 5
    versions.save_version(spark.range(7), table)
    assert versions.read_version(spark, table).count() == 7 and old.count() == 5
    assert versions.read_version(spark, table, 0).count() == 5 and versions.read_version(spark, table, 9) is None


def test_a_writer_that_dies_before_publishing_is_not_seen(spark, tmp_path, monkeypatch):
    table = str(tmp_path / "t")
    versions.save_version(spark.range(5), table)

    def dies(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(versions, "publish", dies)
        with pytest.raises(KeyboardInterrupt):
            versions.save_version(spark.range(9), table)
    assert versions.read_version(spark, table).count() == 5
    versions.save_version(spark.range(6), table)
    assert versions.read_version(spark, table).count() == 6
    gone = versions.drop_old_versions(spark, table, keep=1)
    assert len(gone) == 2 and versions.read_version(spark, table).count() == 6
    assert versions.current_version(spark, table).number == 1


def test_a_materialized_view_is_rebuilt_unseen(spark, tmp_path):
    from tallybook.sources.tables import materialize, read_tables
    path = str(tmp_path / "mv")
    materialize(spark.range(4), "mv", path)
    broken = spark.range(100).select(F.when(F.col("id") == 99, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="broken"):
        materialize(broken, "mv", path)
    assert spark.table("mv").count() == 4 == read_tables(spark, ["mv"], location=str(tmp_path))["mv"].count()
    materialize(spark.range(6).selectExpr("id", "id % 2 as p"), "mv", path, ["p"])
    assert spark.table("mv").count() == 6 == read_tables(spark, ["mv"], location=str(tmp_path))["mv"].count()


def test_the_second_of_two_writers_is_refused(spark, tmp_path):
    table = str(tmp_path / "t")
    first = versions.save_version(spark.range(5), table)
    versions.save_version(spark.range(6), table, onto=first)
    with pytest.raises(versions.Conflict):
        versions.save_version(spark.range(7), table, onto=first)
    assert versions.read_version(spark, table).count() == 6


def test_equal_rows_are_no_new_version(spark, tmp_path):
    table = str(tmp_path / "t")
    df = spark.range(50).selectExpr("id", "id % 3 as p", "cast(null as string) as s")
    one = versions.save_version(df, table, ["p"], unless_same=True)
    assert versions.save_version(df.repartition(5), table, ["p"], unless_same=True) == one
    assert versions.save_version(df.where("id <> 7"), table, ["p"], unless_same=True).number == 1
    assert rows_of(versions.read_version(spark, table)) == rows_of(df.where("id <> 7"))
    assert versions.save_version(df.limit(0), table, ["p"], unless_same=True).number == 2
    assert versions.read_version(spark, table).columns == df.columns and versions.read_version(spark, table).count() == 0


# --- refresh order ---------------------------------------------------------------------

def test_only_what_is_stale_is_rebuilt_inputs_first(spark, tmp_path):
    at, built = str(tmp_path), []

    def table(name, *inputs, settings=""):
        def build(spark, t):
            built.append(name)
            assert set(t) == set(inputs)
            n = sum(df.count() for df in t.values())
            return spark.range(n + 1)
        return graph.Derived(name, inputs, build, settings=settings)

    tables = [table("c", "a", "b"), table("a", "raw1"), table("b", "raw2"), table("alone")]
    with pytest.raises(ValueError, match="raw"):
        graph.refresh(spark, at, tables)
    for r in ("raw1", "raw2"):
        versions.save_version(spark.range(3), f"{at}/{r}")
    built.clear()
    assert graph.refresh(spark, at, tables) == [t for t in built] and built.index("c") > max(built.index("a"), built.index("b"))
    assert graph.refresh(spark, at, tables) == []
    versions.save_version(spark.range(4), f"{at}/raw2")
    assert graph.refresh(spark, at, tables) == ["b", "c"]
    assert versions.read_version(spark, f"{at}/c").count() == 4 + 5 + 1
    tables[3] = table("alone", settings="other")
    assert graph.refresh(spark, at, tables) == ["alone"]
    with pytest.raises(ValueError):  # a cycle
        graph.refresh(spark, at, [table("x", "y"), table("y", "x")])


def test_a_refresh_goes_on_where_it_failed(spark, tmp_path):
    at, fail = str(tmp_path), [True]
    versions.save_version(spark.range(3), f"{at}/raw")

    def shaky(spark, t):
        if fail[0]:
            raise RuntimeError("lost")
        return t["a"]

    tables = [graph.Derived("a", ("raw",), lambda s, t: t["raw"]), graph.Derived("b", ("a",), shaky)]
    with pytest.raises(RuntimeError):
        graph.refresh(spark, at, tables)
    fail[0] = False
    assert graph.refresh(spark, at, tables) == ["b"]


def test_pipeline_rebuilds_schedules_of_changed_payments_only(spark, tmp_path):
    led = ledger_from_driver(spark, SF)
    target = str(tmp_path / "warehouse")

    def numbers():
        return {n: versions.current_version(spark, f"{target}/{n}").number for n in (
            "raw/sales", "raw/payments", "calendar", "calendar_monthly", "equipment_depreciation_schedule", "expense_accrual_schedule")}

    def text(led):
        return {n: as_text(df) for n, df in led.tables().items()}

    run_pipeline(spark, text(led), target)
    assert set(numbers().values()) == {0}
    run_pipeline(spark, text(led), target)
    assert set(numbers().values()) == {0}
    other = Ledger(led.sales, led.purchases, led.payments.filter("id % 5 <> 0"), led.loans)
    out = run_pipeline(spark, text(other), target)
    now = numbers()
    assert {n for n, v in now.items() if v} == {"raw/payments", "equipment_depreciation_schedule", "expense_accrual_schedule"}
    assert rows_of(out["dashboard_flux_analysis"]) == rows_of(build_statements(spark, other))
    # a load that fails half way leaves all as it is
    bad = text(led)
    bad["payments"] = bad["payments"].withColumn("amount", F.when(F.col("id") == "1", F.raise_error(F.lit("lost"))).otherwise(F.col("amount")))
    with pytest.raises(Exception, match="lost"):
        run_pipeline(spark, bad, target)
    assert numbers() == now and rows_of(spark.table("dashboard_flux_analysis")) == rows_of(build_statements(spark, other))


# --- partials -----------------------------------------------------------------------------

def add(df):
    return df.groupBy("k").agg(F.sum("n").alias("n"))


def batch(spark, table, number, rows):
    return partials.add_batch(spark.createDataFrame(rows, "k string, n long"), table, number)


def totals(spark, table):
    return {r["k"]: r["n"] for r in add(partials.read_partials(spark, table, "k string, n long")).collect()}


def test_levels_replays_and_gaps(spark, tmp_path):
    table, want = str(tmp_path / "p"), 0
    assert totals(spark, table) == {}
    for n in [0, 1, 2, 5, 6, 7, 8, 11, 12]:
        batch(spark, table, n, [("a", n + 1)])
        want += n + 1
        batch(spark, table, n, [("a", n + 1)])  # delivered again at once
    assert totals(spark, table) == {"a": want}
    assert partials.compact(spark, table, add, fanout=2) == 7  # 4 pairs, 2 of these, 1 of these
    at = partials.segments(versions.current_version(spark, table))
    assert [(s.lo, s.hi, s.level) for s in at] == [(0, 11, 3), (12, 12, 0)]
    assert totals(spark, table) == {"a": want} and partials.compact(spark, table, add, fanout=2) == 0
    batch(spark, table, 5, [("a", 100)])  # merged already
    batch(spark, table, 12, [("a", 3)])  # the newest is replaced
    assert totals(spark, table) == {"a": want - 13 + 3}


@pytest.mark.parametrize("where", ["writing", "publishing"])
def test_a_killed_merge_is_not_seen(spark, tmp_path, monkeypatch, where):
    table = str(tmp_path / "p")
    for n in range(5):
        batch(spark, table, n, [("a", 1), ("b", n)])
    before = versions.current_version(spark, table)

    def dies(*_):
        raise KeyboardInterrupt

    if where == "writing":
        broken = lambda df: add(df).withColumn("n", F.when(F.col("k") == "b", F.raise_error(F.lit("lost")).cast("long")).otherwise(F.col("n")))
        with pytest.raises(Exception, match="lost"):
            partials.compact(spark, table, broken, fanout=4)
    else:
        with monkeypatch.context() as m:
            m.setattr(partials, "publish", dies)
            with pytest.raises(KeyboardInterrupt):
                partials.compact(spark, table, add, fanout=4)
    assert versions.current_version(spark, table) == before and totals(spark, table) == {"a": 5, "b": 10}
    open_reader = partials.read_partials(spark, table, "k string, n long")
    assert partials.compact(spark, table, add, fanout=4) == 1
    assert totals(spark, table) == {"a": 5, "b": 10}
    assert {r["k"]: r["n"] for r in add(open_reader).collect()} == {"a": 5, "b": 10}  # of the version before


def test_a_batch_that_comes_during_a_merge_is_kept(spark, tmp_path):
    table = str(tmp_path / "p")
    for n in range(5):
        batch(spark, table, n, [("a", 1)])

    def merge(df):
        batch(spark, table, 5, [("a", 1)])  # a stream that is faster
        return add(df)

    assert partials.compact(spark, table, merge, fanout=4) == 1
    assert totals(spark, table) == {"a": 6}


def test_live_statements_with_withdrawals_and_merges(spark, tmp_path):
    led = ledger_from_driver(spark, SF)
    src, sink = {t: str(tmp_path / "raw" / t) for t in LEDGER_SCHEMAS}, str(tmp_path / "sink")
    for t, df in led.tables().items():
        df.repartition(3).write.mode("append").parquet(src[t])

    def refresh():
        for q in start_live_postings(spark, src, sink, available_now=True, files_per_trigger=1):
            q.awaitTermination()

    refresh()
    assert rows_of(live_statements(spark, sink)) == rows_of(build_statements(spark, led))
    gone = {t: F.col("id") % 7 == 3 for t in src}
    for t, df in led.tables().items():
        changes.weighted(df.filter(gone[t]), -1).repartition(2).write.mode("append").parquet(src[t])
    refresh()
    left = Ledger(**{t: df.filter(~gone[t]) for t, df in led.tables().items()})
    want = rows_of(build_statements(spark, left))
    assert rows_of(live_statements(spark, sink)) == want
    assert all(n >= 1 for n in compact_live_postings(spark, sink, fanout=2).values())
    assert rows_of(live_statements(spark, sink)) == want
    refresh()
    assert rows_of(live_statements(spark, sink)) == want


# --- keyed loads ---------------------------------------------------------------------------

PAY = "id string, payment_date string, payment_type string, amount string, _op string, _seq string"


def deliver(spark, table, number, rows):
    rows = [(*r, *[None] * (6 - len(r))) for r in rows]
    return keyed.add_load(spark.createDataFrame(rows, PAY), table, "payments", number)


def amounts(spark, table):
    return {r["id"]: str(r["amount"]) for r in keyed.read_live(spark, table, "payments").collect()}


ONE = [("1", "2021-01-01", "wage", "10"), ("2", "2021-01-01", "wage", "20"), ("3", "2021-01-01", "wage", "x"),
       (None, "2021-01-01", "wage", "5"), ("4", "2021-01-01", "tax", "40")]
TWO = [("2", "2021-02-01", "wage", "22"), ("3", "2021-02-01", "wage", "33"), ("1", None, None, None, "D")]
THREE = [("1", "2021-03-01", "wage", "111"), ("2", "2021-03-01", "rent", "1", None, "1"), ("2", "2021-03-01", "rent", "2", None, "2"), ("4", None, None, None, " d ")]
STANDS = {1: "111.00", 2: "2.00", 3: "33.00"}


@pytest.mark.parametrize("order", [(1, 2, 3), (3, 2, 1), (2, 3, 1, 1, 2, 3), (3, 1, 3, 2, 2)])
def test_loads_in_any_order_and_again(spark, tmp_path, order):
    table, loads = str(tmp_path / "t"), {1: ONE, 2: TWO, 3: THREE}
    assert keyed.read_live(spark, table, "payments").count() == 0
    for n in order:
        deliver(spark, table, n, loads[n])
    assert amounts(spark, table) == STANDS
    bad = keyed.read_rejects(spark, table, "payments").collect()
    assert sorted((r["load"], r["reason"]) for r in bad) == [(1, "amount"), (1, keyed.NO_KEY)]


def test_folding_and_what_comes_after(spark, tmp_path):
    table = str(tmp_path / "t")
    deliver(spark, table, 1, ONE)
    deliver(spark, table, 3, THREE)
    keyed.fold(spark, table)
    assert len(versions.current_version(spark, table).folders) == 1
    deliver(spark, table, 2, TWO)  # late, after the fold
    deliver(spark, table, 3, THREE)  # again
    assert amounts(spark, table) == STANDS
    keyed.fold(spark, table)
    assert amounts(spark, table) == STANDS and keyed.read_rejects(spark, table, "payments").count() == 2
    assert keyed.fold(spark, table) == versions.current_version(spark, table)


def test_a_load_writes_its_own_records_only(spark, tmp_path):
    table = str(tmp_path / "t")
    deliver(spark, table, 1, ONE)
    first = {p.name for p in (tmp_path / "t").glob("load=*/*.parquet")}
    deliver(spark, table, 2, TWO)
    later = {p.name for p in (tmp_path / "t").glob("load=*/*.parquet")}
    assert first < later
    assert spark.read.parquet(*[str(p) for p in (tmp_path / "t").glob("load=2-*")]).count() == len(TWO)


def test_settled_is_the_winners_and_the_rejects(spark):
    """Ties, deletions, records that come twice, and rejects with and without a key."""
    rnd, records = random.Random(5), None
    for n in (2, 1, 2, 3):
        rows = [(rnd.choice(["1", "2", "3", "4", None]), rnd.choice(["2021-01-01", None, "x"]), rnd.choice(["wage", "rent", None]),
                 rnd.choice(["1", "2.5", "y", None]), rnd.choice([None, None, "d"]), rnd.choice([None, "1"])) for _ in range(25)]
        one = keyed.typed_load(spark.createDataFrame(rows + rows[:5], PAY), LEDGER_SCHEMAS["payments"], n)
        records = one if records is None else records.unionByName(one)
    got = keyed.settled(records)
    assert got.columns == records.columns
    own = [*LEDGER_SCHEMAS["payments"].fieldNames(), keyed.LOAD, keyed.SEQ, keyed.DELETED]
    won, lost = keyed.winners(records).select(own).collect(), keyed.rejects(records, "payments").collect()
    assert {r["id"] for r in won} == {1, 2, 3, 4} and len(lost) > 5
    assert sorted(map(tuple, got.filter("_status = 'ok'").select(own).collect()), key=repr) == sorted(map(tuple, won), key=repr)
    assert sorted(map(tuple, keyed.rejects(got, "payments").collect())) == sorted(map(tuple, lost))
    assert got.count() == len(won) + len(lost)


def test_values_spelled_otherwise(spark):
    """A field is right if it keeps its value, however it is spelled."""
    right = [("2021-01-01", "10"), (" 2021-01-01 ", " 10.50 "), ("2021-1-1", "1e1"), ("2021-01-01 00:00:00", "10.500"), ("2021-01-01T00:00", "+10"),
             ("2021", "-0"), ("2021-02", ".5"), (None, None)]
    wrong = [("2021-01-01 10:00:00", "1", "payment_date"), ("2021-01-01T00:00:01", "1", "payment_date"), ("2021-02-30", "1", "payment_date"),
             ("2021-01-01", "10.501", "amount"), ("2021-01-01", "1e-3", "amount"), ("2021-01-01", "1e10", "amount"),
             ("x", "", "payment_date,amount")]
    raw = spark.createDataFrame([(str(i), d, "wage", a, None, None) for i, (d, a, *_) in enumerate(right + wrong)], PAY)
    got = keyed.typed_load(raw, LEDGER_SCHEMAS["payments"], 1).orderBy("id").collect()
    assert [r["_reason"] for r in got] == [None] * len(right) + [w[2] for w in wrong]


def test_load_changes_feed_the_states(spark, tmp_path):
    """Keyed loads -> weighted records -> states equal the statements of what stands."""
    table, rnd = str(tmp_path / "t"), random.Random(2)
    state = None
    for n in range(1, 5):
        rows = [(str(rnd.randrange(40)), f"{rnd.randrange(2020, 2024)}-0{rnd.randrange(1, 9)}-01",
                 rnd.choice(["wage", "rent", "equipment", "loan"]), str(rnd.randrange(100)), "D" if rnd.random() < 0.2 else None)
                for _ in range(30)]
        before = keyed.stored_records(spark, table)
        load = keyed.typed_load(spark.createDataFrame([(*r, None) for r in rows], PAY), LEDGER_SCHEMAS["payments"], n)
        made = keyed.load_changes(load.limit(0) if before is None else before, load)
        assert made.groupBy("id").agg(F.count_if(F.col("w") > 0).alias("p"), F.count_if(F.col("w") < 0).alias("m")).where("p > 1 or m > 1").count() == 0
        one = changes.state_of("payments", made)
        state = one if state is None else state.unionByName(one)
        deliver(spark, table, n, rows)
        again = keyed.load_changes(keyed.stored_records(spark, table), load)
        assert again.count() == 0
    live = keyed.read_live(spark, table, "payments")
    none = make_ledger(spark)
    states = {t: changes.state_of(t, df) for t, df in none.tables().items()}
    states["payments"] = changes.merged("payments", state)
    assert from_states(spark, states) == rebuilt(spark, Ledger(none.sales, none.purchases, live, none.loans))


# --- statements from keyed loads -----------------------------------------------------------------

def raw_load(spark, rnd, name, n):
    """Records of a load as text; some deletions, bad and repeated ones."""
    rows = random_rows(rnd, n)[name]
    text = [tuple(None if v is None else str(v) for v in r) for r in rows]
    text = [(str(rnd.randrange(25)), *r[1:], "D" if rnd.random() < 0.15 else None) for r in text]
    ddl = ", ".join(f"{f.name} string" for f in LEDGER_SCHEMAS[name].fields) + ", _op string"
    return spark.createDataFrame(text, ddl)


def as_rebuilt(spark, folder):
    return rebuilt(spark, statements.loaded_ledger(spark, folder))


def test_statements_follow_loads_late_again_and_changed(spark, tmp_path, monkeypatch):
    folder, rnd = str(tmp_path / "f"), random.Random(31)
    loads = {(t, n): raw_load(spark, rnd, t, 12) for t in ("purchases", "payments") for n in range(1, 5)}
    loads[("sales", 1)] = raw_load(spark, rnd, "sales", 25)
    assert rows_of(statements.current_statements(spark, folder, default_years(spark))) == []
    order = [("sales", 1), *[("purchases", n) for n in (2, 1, 4, 3)], *[("payments", n) for n in (1, 3, 2)]]
    for at in order:
        statements.apply_load(loads[at], folder, at[0], at[1])
    assert from_states(spark, statements.current_states(spark, folder)) == as_rebuilt(spark, folder)
    # again, and again with other records
    statements.apply_load(loads["purchases", 2], folder, "purchases", 2)
    statements.apply_load(raw_load(spark, rnd, "purchases", 15), folder, "purchases", 1)
    statements.apply_load(raw_load(spark, rnd, "payments", 15), folder, "payments", 3)
    want = as_rebuilt(spark, folder)
    assert from_states(spark, statements.current_states(spark, folder)) == want
    # a load that dies before it is published is not seen, one that dies after it is
    late = loads["payments", 4]

    def dies(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(statements, "publish", dies)
        with pytest.raises(KeyboardInterrupt):
            statements.apply_load(late, folder, "payments", 4)
    assert from_states(spark, statements.current_states(spark, folder)) == want == as_rebuilt(spark, folder)
    assert statements.compact_states(spark, folder, fanout=2)["purchases"] >= 2
    assert from_states(spark, statements.current_states(spark, folder)) == want
    with monkeypatch.context() as m:
        m.setattr(statements, "list_batches", dies)
        with pytest.raises(KeyboardInterrupt):
            statements.apply_load(late, folder, "payments", 4)
    at = f"{folder}/states/payments"
    assert len(statements._unlisted(spark, folder, "payments", versions.current_version(spark, at))) == 1
    want = as_rebuilt(spark, folder)
    assert from_states(spark, statements.current_states(spark, folder)) == want
    statements.compact_states(spark, folder, fanout=2)
    assert not statements._unlisted(spark, folder, "payments", versions.current_version(spark, at))
    assert from_states(spark, statements.current_states(spark, folder)) == want
    # folded records give further loads the same changes
    keyed.fold(spark, f"{folder}/raw/payments")
    statements.apply_load(raw_load(spark, rnd, "payments", 20), folder, "payments", 5)
    assert from_states(spark, statements.current_states(spark, folder)) == as_rebuilt(spark, folder) != want
    built = build_statements(spark, statements.loaded_ledger(spark, folder))
    assert rows_of(statements.current_statements(spark, folder, default_years(spark))) == rows_of(built)


def test_a_second_loader_that_comes_first(spark, tmp_path, monkeypatch):
    """Two loads start from one version: the slower one compares again with what stands."""
    folder, rnd = str(tmp_path / "f"), random.Random(33)
    first, second = (raw_load(spark, rnd, "payments", 20) for _ in range(2))
    real, raced = statements.publish, []

    def slower(spark_, table, version):
        if not raced:
            raced.append(1)
            statements.apply_load(second, folder, "payments", 2)
        return real(spark_, table, version)

    monkeypatch.setattr(statements, "publish", slower)
    statements.apply_load(first, folder, "payments", 1)
    assert from_states(spark, statements.current_states(spark, folder)) == as_rebuilt(spark, folder)
    assert versions.current_version(spark, f"{folder}/raw/payments").number == 1


def test_command_line_loads(spark, tmp_path, capsys):
    from tallybook.__main__ import main
    led = ledger_from_driver(spark, SF)
    once = {t: df.groupBy("id").count().filter("count = 1").select("id") for t, df in led.tables().items()}
    led = Ledger(**{t: df.join(once[t], "id", "left_semi") for t, df in led.tables().items()})  # ids that are keys
    for n, cond, op in ((1, "true", None), (2, "id % 5 = 2", "D")):
        for t, df in led.tables().items():
            as_text(df.filter(cond)).withColumn("_op", F.lit(op).cast("string")).write.option("header", True).csv(str(tmp_path / f"raw{n}" / t))
    target = str(tmp_path / "kept")

    def said(n):
        main(["load", "--raw", str(tmp_path / f"raw{n}"), "--target", target, "--load", str(n)])
        lines = capsys.readouterr().out.splitlines()
        assert all(x.endswith(" 0 rejected records") for x in lines[:4])
        return sorted(tuple(x.split("\t")) for x in lines[5:])

    def built(led):
        return sorted(tuple("" if v is None else str(v) for v in r) for r in build_statements(spark, led).collect())

    assert said(1) == built(led)
    assert said(2) == built(Ledger(**{t: df.filter("id % 5 <> 2") for t, df in led.tables().items()}))
    assert said(2) == said(1)  # both again: nothing changes
    statements.maintain(spark, target, fanout=2, most_folders=1)
    assert len(versions.current_version(spark, f"{target}/raw/sales").folders) == 1
    assert rows_of(statements.loaded_ledger(spark, target).loans) == rows_of(led.loans.filter("id % 5 <> 2"))
