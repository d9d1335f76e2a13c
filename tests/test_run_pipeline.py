"""End to end: raw CSV files -> load -> snapshots -> live statements view."""

from __future__ import annotations

from tallybook.plans.pipeline import build_statements, run_pipeline
from tallybook.sources.adapter import ledger_from_driver
from tallybook.sources.loader import as_text

SF = "/root/testdata/sf0.001"


def test_run_pipeline_from_csv(spark, tmp_path):
    led = ledger_from_driver(spark, SF)
    src = {}
    for name, df in led.tables().items():
        path = str(tmp_path / "dump" / name)
        as_text(df).write.option("header", True).csv(path)
        src[name] = path
    out = run_pipeline(spark, src, str(tmp_path / "warehouse"))
    assert out["rejects"].count() == 0
    assert out["expense_accrual_schedule"].count() == 375
    assert out["equipment_depreciation_schedule"].count() == 226
    assert spark.table("calendar").count() == 6
    view = sorted(tuple(r) for r in spark.table("dashboard_flux_analysis").collect())
    assert view == sorted(tuple(r) for r in build_statements(spark, led).collect())


def test_command_line_statements(spark, capsys):
    from tallybook.__main__ import main
    main(["statements", "--tables", SF])
    out = capsys.readouterr().out
    assert "12926904.40" in out and "net_income" in out


def test_read_ledger_from_stored_tables(spark, tmp_path):
    from tallybook.sources.tables import read_ledger
    led = ledger_from_driver(spark, SF)
    for name, df in led.tables().items():
        df.write.parquet(str(tmp_path / "ledger" / name))
    back = read_ledger(spark, str(tmp_path / "ledger"))
    assert sorted(tuple(r) for r in build_statements(spark, back).collect()) == \
        sorted(tuple(r) for r in build_statements(spark, led).collect())


def test_build_statements_from_a_folder(spark):
    by_dir = sorted(tuple(r) for r in build_statements(spark, SF).collect())
    assert by_dir == sorted(tuple(r) for r in build_statements(spark, ledger_from_driver(spark, SF)).collect())
