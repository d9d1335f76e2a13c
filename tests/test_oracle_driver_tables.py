"""Every registered query against its DuckDB oracle on the sf0.001 driver tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from tallybook.plans.catalog import QUERIES
from tests.oracle_compare import compare, duck_connection

SF = "/root/testdata/sf0.001"
_CON = {}


def _con():
    if "c" not in _CON:
        _CON["c"] = duck_connection(SF)
    return _CON["c"]


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.queries()) and set(QUERIES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, name):
    r = compare(spark, name, E.queries()[name], E.oracle_sql()[name], SF, _con())
    assert r["columns_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["values_match"], r


def test_entry_golden_sf0001(spark):
    """FIXTURES.md section 3, sf0.001."""
    rows = [tuple(r) for r in E.entry(spark).collect()]
    assert [r[0] for r in rows] == [2020, 2021, 2022, 2023]
    got = {r[0]: [str(x) for x in r[1:]] for r in rows}
    assert got[2021] == ["12926904.40", "-43150284.05", "-42922786.73", "449257.10", "1971287.27",
                         "-135362.15", "-721511.10", "4662413.34", "4429292.67"]
    assert got[2023] == ["13822923.20", "-27382923.55", "-112695580.04", "1346410.00", "0.00",
                         "-8818543.65", "-4336581.66", "11556414.90", "9759921.06"]
    assert got[2020][1] == "-2779695.61" and got[2020][4] == "2779695.61"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_arrow_types_match_oracle(spark, name):
    """Same Arrow type per column (decimal precision/scale, int width, date32)."""
    s = {f.name: str(f.type) for f in E.queries()[name](spark, SF).toArrow().schema}
    d = {f.name: str(f.type) for f in _con().sql(E.oracle_sql()[name]).arrow().schema}
    assert s == d
