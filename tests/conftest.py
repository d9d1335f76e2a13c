from __future__ import annotations

import datetime as dt
import os
import sys
from decimal import Decimal

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallybook.session import get_session  # noqa: E402
from tallybook.sources.adapter import Ledger  # noqa: E402
from tallybook.sources.schemas import LEDGER_SCHEMAS  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[*]", shuffle_partitions=8)
    yield s


def D(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def M(x) -> Decimal:
    return Decimal(str(x)).quantize(Decimal("0.01"))


def make_ledger(spark, sales=(), purchases=(), payments=(), loans=()) -> Ledger:
    """Ledger from hand-made rows (tuples in schema order)."""
    def df(name, rows):
        return spark.createDataFrame(list(rows), LEDGER_SCHEMAS[name])
    return Ledger(sales=df("sales", sales), purchases=df("purchases", purchases),
                  payments=df("payments", payments), loans=df("loans", loans))


def sale(d, q, p, method="cash", paid=None, product="P", id_=1):
    return (id_, D(d), D(paid) if paid else None, method, product, q, M(p))


def purchase(d, q, amount, method="cash", paid=None, product="P", id_=1):
    return (id_, D(d), D(paid) if paid else D(d), method, product, q,
            None if amount is None else M(amount))


def payment(d, ptype, amount, id_=1):
    return (id_, D(d) if d else None, ptype, M(amount))


def loan(d, value, id_=1):
    return (id_, D(d), Decimal(str(value)).quantize(Decimal("0.01")))


def duck_for(ledger: Ledger) -> duckdb.DuckDBPyConnection:
    """A DuckDB connection with the ledger's four tables (via Arrow)."""
    con = duckdb.connect()
    for name, df in ledger.tables().items():
        con.register(f"_{name}_arrow", df.toArrow())
        con.execute(f"CREATE TABLE {name} AS SELECT * FROM _{name}_arrow")
    return con
