"""DuckDB oracle SQL, one statement per registered query.

Each statement starts with the ledger adapter over the driver's views
(lineitem, part, orders, supplier) and then computes the operator in the
plain "one branch per rule" form: one SELECT per posting rule, the fan-out
join for COGS, per-row windows for the monthly schedule. It shares no code
with the Spark plans, so agreement checks the Spark design (single scans,
pre-aggregation, the SUM(DISTINCT) join) against the direct definition.
Money is cast to DECIMAL(38,2) (DECIMAL(38,4) for raw postings), years to
INTEGER, dates to DATE, on both sides.
"""

from __future__ import annotations

import re

# Fixed values (same as the Spark side): adapter, rule lists, defaults.
PIPELINE_CASH_TYPES = "('interest', 'wage', 'utility', 'tax', 'rent')"
LEGACY_CASH_TYPES = "('equipment', 'interest', 'wage', 'utility', 'tax', 'loan', 'rent')"
PL_ACCOUNTS = "('Revenue', 'COGS', 'Depr_Exp', 'interest', 'wage', 'tax', 'rent', 'utility')"

ADAPTER = """
lp AS (
    SELECT l.l_orderkey * 8 + l.l_linenumber AS id,
           CAST(CAST(l.l_shipdate AS DATE) + INTERVAL 312 MONTH AS DATE) AS d0,
           l.l_linenumber AS ln, l.l_returnflag AS rf, l.l_linestatus AS ls,
           CAST(l.l_quantity AS INTEGER) AS qty,
           p.p_name || ' / ' || p.p_brand AS product_name, p.p_brand AS brand,
           CAST(p.p_retailprice AS DECIMAL(12,2)) AS list_price
    FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
),
sales AS (
    SELECT id, d0 AS sale_at,
           CASE WHEN rf = 'N' AND ln = 6 THEN NULL ELSE d0 + 7 * ln END AS payment_at,
           CASE WHEN ln = 7 THEN NULL WHEN rf = 'N' THEN 'credit' ELSE 'cash' END AS payment_method,
           product_name, qty AS quantity, list_price AS price
    FROM lp WHERE rf <> 'R'
),
purchases AS (
    SELECT id, d0 AS purchase_at, d0 + 7 * ln AS payment_at,
           CASE WHEN ls = 'O' THEN 'credit' ELSE 'cash' END AS payment_method,
           product_name, qty * 2 AS quantity,
           CAST(list_price * CAST(0.60 AS DECIMAL(3,2)) AS DECIMAL(12,2)) AS amount
    FROM lp WHERE rf = 'R' AND brand <> 'Brand#13'
),
payments AS (
    SELECT o_orderkey AS id,
           CAST(CAST(o_orderdate AS DATE) + INTERVAL 312 MONTH AS DATE) AS payment_date,
           CASE o_orderkey % 16
                WHEN 0 THEN 'equipment' WHEN 1 THEN 'loan' WHEN 2 THEN 'interest'
                WHEN 3 THEN 'wage' WHEN 4 THEN 'wage' WHEN 5 THEN 'wage' WHEN 6 THEN 'wage'
                WHEN 7 THEN 'utility' WHEN 8 THEN 'utility' WHEN 9 THEN 'utility'
                WHEN 10 THEN 'tax' WHEN 11 THEN 'tax'
                WHEN 12 THEN 'rent' WHEN 13 THEN 'rent' WHEN 14 THEN 'rent'
                ELSE 'dividend' END AS payment_type,
           CAST(o_totalprice AS DECIMAL(12,2)) AS amount
    FROM orders
),
loans AS (
    SELECT s_suppkey AS id,
           DATE '2021-01-15' + CAST((s_suppkey * 37) % 2200 AS INTEGER) AS loan_at,
           CAST(CAST(abs(s_acctbal) AS DECIMAL(12,2)) * 100 AS DECIMAL(14,2)) AS value
    FROM supplier
)"""


_USE_ADAPTER = [True]


def _with(*ctes: str) -> str:
    head = [ADAPTER.strip()] if _USE_ADAPTER[0] else []
    parts = head + [c.strip() for c in ctes]
    return ("WITH " + ",\n".join(parts)) if parts else ""


def _lag(d: str) -> str:
    return f"CASE WHEN payment_method = 'cash' THEN {d} ELSE CAST({d} + INTERVAL 1 MONTH AS DATE) END"


YEARLY_CAL = """
ycal AS (
    SELECT DISTINCT CAST(year(g) AS INTEGER) AS y
    FROM generate_series(TIMESTAMP '2020-01-01', TIMESTAMP '2025-12-31', INTERVAL 1 YEAR) t(g)
)"""

MONTHLY_CAL = """
mcal AS (
    SELECT CAST(g AS DATE) AS calendar_at, CAST(year(g) AS INTEGER) AS year,
           CAST(month(g) AS INTEGER) AS month
    FROM generate_series(TIMESTAMP '2021-01-01', TIMESTAMP '2050-12-31', INTERVAL 1 MONTH) t(g)
)"""

DEP_SCHED = """
dep_sched AS (
    SELECT a.id, c.y AS year, a.amount AS gross_val,
           CAST(CASE WHEN c.y = a.y0 OR c.y = a.y0 + 10 THEN a.amount * 0.05
                     ELSE a.amount * 0.10 END AS DECIMAL(18,4)) AS annual_depreciation_expense
    FROM (SELECT id, CAST(year(payment_date) AS INTEGER) AS y0, amount
          FROM payments WHERE payment_type = 'equipment') a
    JOIN ycal c ON c.y BETWEEN a.y0 AND a.y0 + 10
)"""

ACCRUALS = """
accruals AS (
    SELECT id, payment_type AS account, amount,
           CAST(date_trunc('month', payment_date - INTERVAL 1 MONTH) AS DATE) AS accrual_date,
           payment_date AS cash_payment_date
    FROM payments
    WHERE payment_type IN ('wage', 'utility', 'tax') AND year(payment_date) IN (2021, 2022, 2023)
)"""

COSTS = """
costs AS (SELECT DISTINCT product_name, amount AS unit_cost FROM purchases)"""


def _posts(legacy: bool) -> str:
    cash_types = LEGACY_CASH_TYPES if legacy else PIPELINE_CASH_TYPES
    rent = "" if legacy else """
    UNION ALL SELECT 'B15', year(payment_date), 'rent', -amount FROM payments WHERE payment_type = 'rent'"""
    ap_filter = "" if legacy else " WHERE cash_payment_date IS NOT NULL"
    return f"""
posts AS (
    SELECT 'B1' AS rule, year(sale_at) AS year, 'Revenue' AS account,
           CAST(quantity * price AS DECIMAL(38,4)) AS amt FROM sales
    UNION ALL SELECT 'B2', year({_lag('sale_at')}), 'Cash', quantity * price FROM sales
    UNION ALL SELECT 'B3', year(loan_at), 'Cash', value FROM loans
    UNION ALL SELECT 'B4', year({_lag('purchase_at')}), 'Cash', -(quantity * amount) FROM purchases
    UNION ALL SELECT 'B5', year(payment_date), 'Cash', -amount FROM payments
              WHERE payment_type IN {cash_types}
    UNION ALL SELECT 'B6', year(s.sale_at), 'COGS', -(c.unit_cost * s.quantity)
              FROM sales s LEFT JOIN costs c ON s.product_name = c.product_name
    UNION ALL SELECT 'B7', year, 'Depr_Exp', -annual_depreciation_expense FROM dep_sched
    UNION ALL SELECT 'B8', year, 'PPE_Snapshot', gross_val FROM dep_sched
    UNION ALL SELECT 'B9', year(payment_at), 'Accounts_Receivable', quantity * price FROM sales
              WHERE payment_method <> 'cash' AND month(payment_at) = 12
    UNION ALL SELECT 'B10', year(purchase_at), 'Inventory', quantity * amount FROM purchases
    UNION ALL SELECT 'B11', year(s.sale_at), 'Inventory', -(c.unit_cost * s.quantity)
              FROM sales s LEFT JOIN costs c ON s.product_name = c.product_name
    UNION ALL SELECT 'B12', year(loan_at), 'Loan_Principal', value FROM loans
    UNION ALL SELECT 'B13', year(payment_date), 'Loan_Principal', -amount FROM payments
              WHERE payment_type = 'loan'
    UNION ALL SELECT 'B14', year(accrual_date), account, -amount FROM accruals{rent}
    UNION ALL SELECT 'B16', year(accrual_date), 'Accounts_Payable', amount FROM accruals
    UNION ALL SELECT 'B17', year(cash_payment_date), 'Accounts_Payable', -amount FROM accruals{ap_filter}
)"""


SUMMARIES = """
summ AS (
    SELECT CAST(year AS INTEGER) AS year, account, sum(amt) AS mov
    FROM posts GROUP BY year, account
),
summ2 AS (
    SELECT year, account, mov,
           sum(mov) OVER (PARTITION BY account ORDER BY year ASC NULLS LAST) AS bal
    FROM summ
)"""


def _dash(end_year: int | None, cash: str, inventory: str) -> str:
    def pick(acc: str, col: str) -> str:
        return f"max(CASE WHEN account = '{acc}' THEN {col} END)"

    def r2(x: str) -> str:
        return f"CAST(round({x}, 2) AS DECIMAL(38,2))"

    return f"""
dash AS (
    SELECT year,
        {r2("coalesce(" + pick('Revenue', 'mov') + ", 0)")} AS revenue,
        {r2(f"sum(CASE WHEN account IN {PL_ACCOUNTS} THEN mov END)")} AS net_income,
        {r2("coalesce(" + pick('Cash', 'bal') + ", 0)")} AS {cash},
        {r2("coalesce(" + pick('Accounts_Receivable', 'bal') + ", 0)")} AS accounts_receivable,
        {r2("coalesce(" + pick('Accounts_Payable', 'bal') + ", 0)")} AS accounts_payable,
        {r2("coalesce(" + pick('Loan_Principal', 'bal') + ", 0)")} AS debt_remaining,
        {r2("coalesce(" + pick('Inventory', 'bal') + ", 0)")} AS {inventory},
        {r2("coalesce(" + pick('PPE_Snapshot', 'mov') + ", 0)")} AS gross_ppe,
        {r2("greatest(0, coalesce(" + pick('PPE_Snapshot', 'mov') + ", 0) + coalesce("
            + pick('Depr_Exp', 'bal') + ", 0))")} AS net_ppe
    FROM summ2 WHERE {"year IS NOT NULL" if end_year is None else f"year <= {end_year}"}
    GROUP BY year
)"""


def _ledger_ctes(legacy: bool = False) -> list[str]:
    return [YEARLY_CAL, DEP_SCHED, ACCRUALS, COSTS, _posts(legacy), SUMMARIES]


def _flux_ctes() -> list[str]:
    return _ledger_ctes(False) + [_dash(2023, "cash", "inventory")]


SPAN = """
span AS (
    SELECT min(lo) AS lo, max(hi) AS hi FROM (
        SELECT least(sale_at, payment_at) AS lo, greatest(sale_at, payment_at) AS hi FROM sales
        UNION ALL SELECT least(purchase_at, payment_at), greatest(purchase_at, payment_at) FROM purchases
        UNION ALL SELECT payment_date, payment_date FROM payments
        UNION ALL SELECT loan_at, loan_at FROM loans)
)"""

ACTIVITY_CAL = """
ycal AS (
    SELECT CAST(y AS INTEGER) AS y FROM span, generate_series(year(lo), year(hi)) t(y)
)"""

ALL_ACCRUALS = ACCRUALS.replace("year(payment_date) IN (2021, 2022, 2023)", "payment_date IS NOT NULL")


def _reject_branch(table: str, number: str, date: str, money: str) -> str:
    kind = {"quantity": "INTEGER", "value": "DECIMAL(14,2)"}.get(number, "DECIMAL(12,2)")
    cents = "DECIMAL(14,2)" if money == "value" else "DECIMAL(12,2)"
    if number == money:
        num = f"CASE id % 97 WHEN 0 THEN 'x' || {money} WHEN 4 THEN {money} || '5' ELSE CAST({money} AS VARCHAR) END"
        mon = num
    else:
        num = f"CASE id % 97 WHEN 0 THEN 'x' || {number} ELSE CAST({number} AS VARCHAR) END"
        mon = f"CASE id % 97 WHEN 4 THEN {money} || '5' ELSE CAST({money} AS VARCHAR) END"
    return f"""
SELECT '{table}' AS table_name, reason, count(*) AS n_records FROM (
    SELECT CASE WHEN k IN (2, 3) THEN 'field_count'
                WHEN dat IS NOT NULL AND TRY_CAST(dat AS DATE) IS NULL THEN '{date}'
                WHEN num IS NOT NULL AND TRY_CAST(num AS {kind}) IS NULL THEN '{number}'
                WHEN TRY_CAST(mon AS DECIMAL(38,18)) <> TRY_CAST(mon AS {cents}) THEN '{money}'
                ELSE 'ok' END AS reason
    FROM (SELECT id % 97 AS k, {num} AS num, {mon} AS mon,
                 CASE id % 97 WHEN 1 THEN '2021-13-45' ELSE CAST({date} AS VARCHAR) END AS dat
          FROM {table})
) GROUP BY reason"""


def _div_n(s: str) -> str:
    """s / n as DECIMAL(38,10), rounded half away from zero, in integer arithmetic.

    DuckDB's decimal division yields a DOUBLE, whose sums depend on the
    (parallel) summation order; integers keep the oracle exact and repeatable.
    """
    c = f"CAST(round({s} * 100) AS HUGEINT)"
    q = f"((2 * abs({c}) * 100000000 + n) // (2 * n))"
    return (f"CAST(sign({c}) * {q} AS DECIMAL(38,0)) * CAST(0.0000000001 AS DECIMAL(38,10))")


EQUIPMENT_ID = "SELECT id, payment_date"
SHARED_ID = "SELECT CASE WHEN (id // 16) % 7 <> 0 THEN id % 1000 END AS id, payment_date"

MONTHLY_DEP = f"""
eq AS ({EQUIPMENT_ID}, amount FROM payments WHERE payment_type = 'equipment'),
asset_months AS (
    SELECT e.id, c.calendar_at, c.year, e.amount,
           count(*) OVER (PARTITION BY e.id) AS n
    FROM eq e JOIN mcal c
      ON c.calendar_at >= e.payment_date
     AND c.calendar_at < CAST(e.payment_date + INTERVAL 10 YEAR AS DATE)
),
asset_acc AS (
    -- accumulated amount per asset (peers included); its share is acc / n
    SELECT year, n, amount,
           sum(amount) OVER (PARTITION BY id ORDER BY calendar_at) AS acc
    FROM asset_months
),
per_n AS (
    -- sum of x / n over rows = (sum of x) / n for rows with the same n
    SELECT year, n, sum(acc) AS s_acc, sum(amount) AS s_per FROM asset_acc GROUP BY year, n
),
dep_acc AS (SELECT year, sum({_div_n('s_acc')}) AS amt FROM per_n GROUP BY year),
dep_per AS (SELECT year, sum({_div_n('s_per')}) AS amt FROM per_n GROUP BY year),
eq_buys AS (SELECT CAST(year(payment_date) AS INTEGER) AS year, sum(amount) AS amt FROM eq GROUP BY 1)"""


def _cash_lines() -> str:
    return f"""
comp AS (
    SELECT year, sum(CASE WHEN c = 'sales_cash_in' THEN v END) AS sales_cash_in,
                 sum(CASE WHEN c = 'loan_in' THEN v END) AS loan_in,
                 sum(CASE WHEN c = 'purchase_out' THEN v END) AS purchase_out,
                 sum(CASE WHEN c = 'expense_out' THEN v END) AS expense_out
    FROM (
        SELECT CAST(year({_lag('sale_at')}) AS INTEGER) AS year, 'sales_cash_in' AS c,
               quantity * price AS v FROM sales
        UNION ALL SELECT CAST(year(loan_at) AS INTEGER), 'loan_in', value FROM loans
        UNION ALL SELECT CAST(year({_lag('purchase_at')}) AS INTEGER), 'purchase_out',
               quantity * amount FROM purchases
        UNION ALL SELECT CAST(year(payment_date) AS INTEGER), 'expense_out', amount FROM payments
    ) GROUP BY year
)"""


#: The tables after the edits of the registered query; the first condition that holds counts.
EDITED = ["""
e_sales AS (
    SELECT id, CASE WHEN id % 17 = 1 THEN sale_at WHEN id % 19 = 2 THEN CAST(sale_at + INTERVAL 12 MONTH AS DATE) ELSE sale_at END AS sale_at,
           payment_at,
           CASE WHEN id % 17 = 1 OR id % 19 = 2 THEN payment_method WHEN id % 23 = 3 THEN 'cash' ELSE payment_method END AS payment_method,
           product_name,
           CASE WHEN id % 17 = 1 THEN quantity + 3 WHEN id % 19 = 2 OR id % 23 = 3 THEN quantity WHEN id % 29 = 4 THEN NULL
                ELSE quantity END AS quantity, price
    FROM sales WHERE (id % 13 = 0) IS NOT TRUE
)""", """
e_purchases AS (
    SELECT id, CASE WHEN id % 7 = 1 THEN purchase_at WHEN id % 17 = 2 THEN CAST(purchase_at - INTERVAL 12 MONTH AS DATE)
                    ELSE purchase_at END AS purchase_at, payment_at, payment_method, product_name, quantity,
           CAST(CASE WHEN id % 7 = 1 THEN amount + 1 ELSE amount END AS DECIMAL(12,2)) AS amount
    FROM purchases WHERE (id % 11 = 0) IS NOT TRUE
)""", """
e_payments AS (
    SELECT id, CASE WHEN id % 9 = 5 OR id % 14 = 1 THEN payment_date WHEN id % 22 = 2 THEN CAST(payment_date + INTERVAL 11 MONTH AS DATE)
                    ELSE payment_date END AS payment_date,
           CASE WHEN id % 9 = 5 THEN payment_type WHEN id % 14 = 1 THEN 'rent' ELSE payment_type END AS payment_type,
           CAST(CASE WHEN id % 9 = 5 THEN amount * 2 ELSE amount END AS DECIMAL(12,2)) AS amount
    FROM payments WHERE (id % 10 = 3) IS NOT TRUE
)""", """
e_loans AS (
    SELECT id, loan_at, CASE WHEN id % 5 = 1 THEN NULL ELSE value END AS value FROM loans WHERE (id % 9 = 0) IS NOT TRUE
)"""]

SALES_COLUMNS = ("id", "sale_at", "payment_at", "payment_method", "product_name", "quantity", "price")
PURCHASE_COLUMNS = ("id", "purchase_at", "payment_at", "payment_method", "product_name", "quantity", "amount")


def _records(table: str, columns: tuple[str, ...], number: str, money: str) -> str:
    """All delivered records of a table as text, ``wrong`` or not, ``gone`` or not, and
    their ``place``: 1 for the last writer of each id among the right ones."""
    def load(n: int, where: str, op: str = "NULL", **values: str) -> str:
        text = ", ".join(f"{values.get(c, f'CAST({c} AS VARCHAR)')} AS {c}" for c in columns)
        return f"SELECT {text}, {op} AS op, {n} AS load FROM {table} WHERE {where}"

    kind = {"quantity": "INTEGER", "value": "DECIMAL(14,2)"}
    deliveries = "\n    UNION ALL ".join([
        load(3, "id % 14 = 2"), load(3, "id % 12 = 1", "'d'"), load(3, "id % 31 = 7", id="NULL"),
        *2 * [load(2, "id % 5 = 4"), load(2, "id % 6 = 1", **{money: f"'1' || CAST({money} AS VARCHAR)"}), load(2, "id % 7 = 2", "'D'")],
        load(1, "id % 5 <> 4"), load(1, "id % 37 = 5", **{number: "'x'"})])
    typed = {c: f"TRY_CAST({c} AS {kind.get(c, 'DECIMAL(12,2)')})" for c in (number, money)}
    wrong = " OR ".join(f"({c} IS NOT NULL AND {typed[c]} IS NULL)" for c in sorted(typed))
    # Rows of an id in one load: the greatest, column by column.
    places = ", ".join(f"{typed.get(c, c)} DESC NULLS LAST" for c in columns if c != "id")
    return f"""
    SELECT *, row_number() OVER (PARTITION BY id, wrong ORDER BY load DESC, gone DESC, {places}) AS place
    FROM (SELECT *, id IS NULL OR {wrong} AS wrong, coalesce(upper(op) = 'D', false) AS gone FROM (
    {deliveries}))"""


def _keyed_branch(table: str, columns: tuple[str, ...], number: str, money: str) -> str:
    """The last writer of each id of one table over all deliveries, and the rejects."""
    cents = "DECIMAL(14,2)" if money == "value" else "DECIMAL(12,2)"
    own = ", ".join(columns)
    return f"""
SELECT '{table}' AS table_name, count(live) AS live_rows, CAST(sum(live) AS BIGINT) AS load_numbers,
       CAST(sum(money) AS DECIMAL(38,2)) AS live_total, count(CASE WHEN gone THEN 1 END) AS deleted_keys,
       {', '.join(f'count(CASE WHEN bad = {n} THEN 1 END) AS rejects_{n}' for n in (1, 2, 3))}
FROM (
    WITH records AS ({_records(table, columns, number, money)})
    SELECT CASE WHEN NOT gone THEN load END AS live, gone, CASE WHEN NOT gone THEN TRY_CAST({money} AS {cents}) END AS money, NULL AS bad
    FROM records WHERE NOT wrong AND place = 1
    UNION ALL SELECT NULL, NULL, NULL, load FROM (SELECT DISTINCT {own}, op, load FROM records WHERE wrong))"""


def _kept(table: str, columns: tuple[str, ...], number: str, money: str) -> str:
    """The table as it stands after all deliveries."""
    kinds = {"id": "BIGINT", "quantity": "INTEGER", "price": "DECIMAL(12,2)", "amount": "DECIMAL(12,2)", "value": "DECIMAL(14,2)",
             "payment_method": "VARCHAR", "product_name": "VARCHAR", "payment_type": "VARCHAR"}
    typed = ", ".join(f"CAST({c} AS {kinds.get(c, 'DATE')}) AS {c}" for c in columns)
    return f"""
e_{table} AS (SELECT {typed} FROM ({_records(table, columns, number, money)}) WHERE NOT wrong AND place = 1 AND NOT gone)"""


LOADED = (("sales", SALES_COLUMNS, "quantity", "price"), ("purchases", PURCHASE_COLUMNS, "quantity", "amount"),
          ("payments", ("id", "payment_date", "payment_type", "amount"), "amount", "amount"),
          ("loans", ("id", "loan_at", "value"), "value", "value"))


def _m(x: str) -> str:
    return f"CAST({x} AS DECIMAL(38,2))"


def _retained(corrected: bool) -> str:
    dep = "SELECT year, -amt AS amt FROM dep_per" if corrected else "SELECT year, amt FROM dep_acc"
    return _with(MONTHLY_CAL, COSTS, MONTHLY_DEP, f"""
lines AS (
    SELECT CAST(year(sale_at) AS INTEGER) AS year, 'Revenue' AS transaction_type, 1 AS order_process,
           CAST(sum(quantity * price) AS DECIMAL(38,10)) AS amt
    FROM sales GROUP BY 1
    UNION ALL
    SELECT CAST(year(s.sale_at) AS INTEGER), 'Cost of Goods Sold', 2,
           CAST(-sum(c.unit_cost * s.quantity) AS DECIMAL(38,10))
    FROM sales s LEFT JOIN costs c ON s.product_name = c.product_name GROUP BY 1
    UNION ALL
    SELECT year, 'Depreciation', 3, amt FROM ({dep})
    UNION ALL
    SELECT CAST(year(payment_date) AS INTEGER),
           CASE payment_type WHEN 'interest' THEN 'Interest Expense' WHEN 'wage' THEN 'Wage Expense'
                WHEN 'tax' THEN 'Tax Expense' ELSE 'Operational Expense' END,
           CASE payment_type WHEN 'interest' THEN 4 WHEN 'wage' THEN 5 WHEN 'tax' THEN 6 ELSE 7 END,
           CAST(-sum(amount) AS DECIMAL(38,10))
    FROM payments WHERE payment_type IN ('interest', 'wage', 'utility', 'tax', 'rent')
    GROUP BY 1, 2, 3
    UNION ALL
    SELECT DISTINCT year, 'RE - Beginning Balance', 0, 0.0 FROM mcal
    UNION ALL
    SELECT DISTINCT year, 'RE - Ending Balance', 999, 0.0 FROM mcal
)""") + f"""
SELECT year, transaction_type, {_m('round(amt, 2)')} AS total_amount,
       {_m('round(sum(amt) OVER (PARTITION BY year ORDER BY order_process '
           'ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 2)')} AS running_total
FROM lines"""


def _ppe_monthly(corrected: bool, shared: bool = False) -> str:
    schedule = MONTHLY_DEP.replace(EQUIPMENT_ID, SHARED_ID) if shared else MONTHLY_DEP
    if corrected:
        body = """
u AS (
    SELECT year, sum(amt) AS amt FROM (
        SELECT year, CAST(amt AS DECIMAL(38,10)) AS amt FROM eq_buys
        UNION ALL SELECT year, -amt FROM dep_per) GROUP BY year
)"""
    else:
        body = """
u AS (
    SELECT year, amt FROM dep_acc
    UNION ALL SELECT year, CAST(amt AS DECIMAL(38,10)) FROM eq_buys
)"""
    return _with(MONTHLY_CAL, schedule, body) + f"""
SELECT year, 'Property, Plant & Equipment' AS account,
       {_m('round(sum(amt) OVER (ORDER BY year), 2)')} AS total_amount
FROM u"""


def oracle_queries(adapter: bool = True) -> dict[str, str]:
    """SQL per query. ``adapter=False``: read ledger tables named sales,
    purchases, payments and loans directly (for hand-made fixtures)."""
    _USE_ADAPTER[0] = adapter
    try:
        return _oracle_queries()
    finally:
        _USE_ADAPTER[0] = True


def _oracle_queries() -> dict[str, str]:
    q: dict[str, str] = {}

    q["load_ledger"] = _with() + f"""
SELECT 'sales' AS table_name, CAST(count(*) AS BIGINT) AS loaded_rows, CAST(0 AS BIGINT) AS rejected_rows,
       {_m('sum(quantity * price)')} AS loaded_total FROM sales
UNION ALL SELECT 'purchases', count(*), 0, {_m('sum(quantity * amount)')} FROM purchases
UNION ALL SELECT 'payments', count(*), 0, {_m('sum(amount)')} FROM payments
UNION ALL SELECT 'loans', count(*), 0, {_m('sum(value)')} FROM loans"""

    q["calendar_yearly"] = _with(SPAN) + """
SELECT CAST(g AS DATE) AS calendar_at
FROM span, generate_series(CAST(date_trunc('year', lo) AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 YEAR) t(g)"""

    q["calendar_monthly"] = _with(SPAN) + """
SELECT CAST(g AS DATE) AS calendar_at, CAST(year(g) AS INTEGER) AS year, CAST(month(g) AS INTEGER) AS month
FROM span, generate_series(CAST(date_trunc('month', lo) AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 MONTH) t(g)"""

    q["date_dim"] = _with(SPAN) + """
SELECT d AS date, CAST(day(d) AS INTEGER) AS day, CAST(month(d) AS INTEGER) AS month,
       rpad(strftime(d, '%B'), 9, ' ') AS month_name, CAST(year(d) AS INTEGER) AS year,
       strftime(d, '%Y-%m') AS year_month, CAST(dayofweek(d) AS INTEGER) AS weekday,
       rpad(strftime(d, '%A'), 9, ' ') AS weekday_name, 'Q' || CAST(quarter(d) AS VARCHAR) AS quarter
FROM (SELECT CAST(g AS DATE) AS d
      FROM span, generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY) t(g))"""

    q["depreciation_schedule"] = _with(YEARLY_CAL, DEP_SCHED) + """
SELECT id, year, gross_val, annual_depreciation_expense FROM dep_sched"""

    q["accrual_schedule"] = _with(ACCRUALS) + """
SELECT id, account, amount, accrual_date, cash_payment_date FROM accruals"""

    q["ledger_postings"] = _with(*_ledger_ctes(False)[:-1]) + """
SELECT rule, CAST(year AS INTEGER) AS year, account, CAST(sum(amt) AS DECIMAL(38,4)) AS amt
FROM posts GROUP BY rule, year, account"""

    q["yearly_summaries"] = _with(*_ledger_ctes(False)) + """
SELECT year, account, CAST(mov AS DECIMAL(38,4)) AS annual_movement,
       CAST(bal AS DECIMAL(38,4)) AS running_balance FROM summ2"""

    q["dashboard_flux"] = _with(*_flux_ctes()) + "\nSELECT * FROM dash ORDER BY year"

    q["dashboard_flux_full"] = _with(SPAN, ACTIVITY_CAL, DEP_SCHED, ALL_ACCRUALS, COSTS, _posts(False), SUMMARIES,
                                     _dash(None, "cash", "inventory")) + "\nSELECT * FROM dash ORDER BY year"

    q["load_rejects"] = _with() + "\nUNION ALL ".join(
        _reject_branch(*b) for b in (("sales", "quantity", "sale_at", "price"),
                                     ("purchases", "quantity", "purchase_at", "amount"),
                                     ("payments", "amount", "payment_date", "amount"),
                                     ("loans", "value", "loan_at", "value")))

    q["dashboard_aggregation"] = _with(*(_ledger_ctes(True) + [_dash(2031, "cash_bal", "inventory_bal")])) \
        + "\nSELECT * FROM dash ORDER BY year"

    q["account_ar"] = _with() + f"""
SELECT CAST(year(payment_at) AS INTEGER) AS year, 'Accounts_Receivable' AS account,
       {_m('sum(price * quantity)')} AS total_amount
FROM sales WHERE payment_method <> 'cash' AND month(payment_at) = 12
GROUP BY 1"""

    q["account_cash"] = _with(f"""
flows AS (
    SELECT year({_lag('payment_at')}) AS year, quantity * price AS amt FROM sales
    UNION ALL SELECT year({_lag('payment_at')}), -(quantity * amount) FROM purchases
    UNION ALL SELECT year(loan_at), value FROM loans
    UNION ALL SELECT year(payment_date), -amount FROM payments WHERE payment_type IN {LEGACY_CASH_TYPES}
)""") + f"""
SELECT CAST(year AS INTEGER) AS year, 'cash' AS account_type,
       {_m('sum(sum(amt)) OVER (ORDER BY year ASC NULLS LAST)')} AS total_amount
FROM flows GROUP BY year"""

    q["monthly_cash"] = _with("""
flows AS (
    SELECT date_trunc('month', payment_at) AS m, quantity * price AS amt FROM sales
    UNION ALL SELECT date_trunc('month', payment_at), -(quantity * amount) FROM purchases
    UNION ALL SELECT date_trunc('month', loan_at), value FROM loans
    UNION ALL SELECT date_trunc('month', payment_date), -amount FROM payments
)""") + f"""
SELECT CAST(m AS DATE) AS month, {_m('sum(amt)')} AS monthly_net,
       {_m('sum(sum(amt)) OVER (ORDER BY m ASC NULLS LAST)')} AS running_balance
FROM flows GROUP BY m ORDER BY m ASC NULLS LAST"""

    q["account_inventory"] = _with("""
maxcost AS (SELECT product_name, max(amount) AS unit_cost FROM purchases GROUP BY product_name),
moves AS (
    SELECT year(purchase_at) AS year, quantity * amount AS amt FROM purchases
    UNION ALL
    SELECT year(s.sale_at), -(s.quantity * m.unit_cost)
    FROM sales s JOIN maxcost m ON s.product_name = m.product_name
)""") + f"""
SELECT CAST(year AS INTEGER) AS year, 'Inventory' AS account,
       {_m('sum(sum(amt)) OVER (ORDER BY year ASC NULLS LAST)')} AS total_amount
FROM moves GROUP BY year ORDER BY year"""

    q["account_loan"] = _with("""
moves AS (
    SELECT year(loan_at) AS year, value AS amt FROM loans
    UNION ALL SELECT year(payment_date), -amount FROM payments WHERE payment_type = 'loan'
)""") + f"""
SELECT CAST(year AS INTEGER) AS year, 'Loan' AS account,
       {_m('sum(sum(amt)) OVER (ORDER BY year ASC NULLS LAST)')} AS cumulative_loan_amount
FROM moves GROUP BY year ORDER BY year"""

    q["ppe_monthly"] = _ppe_monthly(False)
    q["ppe_monthly_shared_ids"] = _ppe_monthly(False, shared=True)
    q["ppe_monthly_corrected"] = _ppe_monthly(True)

    q["ppe_half_year"] = _with("""
eq AS (SELECT payment_date, amount FROM payments WHERE payment_type = 'equipment'),
ev AS (
    SELECT CAST(year(payment_date) AS INTEGER) AS year, CAST(amount AS DECIMAL(38,4)) AS amt FROM eq
    UNION ALL
    SELECT CAST(year(payment_date) AS INTEGER) + CAST(k AS INTEGER),
           -(amount * CASE WHEN k = 0 OR k = 10 THEN 0.05 ELSE 0.10 END)
    FROM eq, range(0, 11) r(k)
)""") + f"""
SELECT year, 'Property, Plant & Equipment' AS account,
       {_m('round(sum(sum(amt)) OVER (ORDER BY year), 2)')} AS net_ppe_balance
FROM ev GROUP BY year ORDER BY year"""

    q["retained_earnings"] = _retained(False)
    q["retained_earnings_corrected"] = _retained(True)

    calc = ("coalesce(c.sales_cash_in, 0) + coalesce(c.loan_in, 0) - coalesce(c.purchase_out, 0)"
            " - coalesce(c.expense_out, 0)")
    for suffix, only in (("", ""), ("_2021", "WHERE year = 2021")):
        q["audit_revenue" + suffix] = _with(*_flux_ctes(), """
raw AS (SELECT CAST(year(sale_at) AS INTEGER) AS year, sum(quantity * price) AS r FROM sales GROUP BY 1)""") + f"""
SELECT coalesce(d.year, r.year) AS year,
       {_m('coalesce(d.revenue, 0)')} AS view_revenue, {_m('coalesce(r.r, 0)')} AS raw_revenue,
       {_m('coalesce(d.revenue, 0) - coalesce(r.r, 0)')} AS diff, d.year IS NOT NULL AS in_view,
       CASE WHEN d.year IS NOT NULL THEN abs(coalesce(d.revenue, 0) - coalesce(r.r, 0)) < 0.01 END AS is_match
FROM (SELECT * FROM dash {only}) d FULL JOIN (SELECT * FROM raw {only}) r ON d.year = r.year ORDER BY 1"""
        q["audit_cash" + suffix] = _with(*_flux_ctes(), _cash_lines()) + f"""
SELECT coalesce(c.year, d.year) AS year,
       {_m('coalesce(c.sales_cash_in, 0)')} AS sales_cash_in, {_m('coalesce(c.loan_in, 0)')} AS loan_in,
       {_m('coalesce(c.purchase_out, 0)')} AS purchase_out, {_m('coalesce(c.expense_out, 0)')} AS expense_out,
       {_m(calc)} AS net_cash_calculated, {_m('coalesce(d.cash, 0)')} AS view_cash,
       {_m(f'{calc} - coalesce(d.cash, 0)')} AS diff, d.year IS NOT NULL AS in_view,
       CASE WHEN d.year IS NOT NULL THEN abs({calc} - coalesce(d.cash, 0)) < 0.01 END AS is_match
FROM (SELECT * FROM comp {only}) c FULL JOIN (SELECT * FROM dash {only}) d ON c.year = d.year ORDER BY 1"""

    metrics = [("revenue", "P&L", "revenue"), ("total_expenses", "P&L", "revenue - net_income"),
               ("net_income", "P&L", "net_income"), ("cash", "Balance Sheet", "cash"),
               ("debt_remaining", "Balance Sheet", "debt_remaining"),
               ("inventory", "Balance Sheet", "inventory")]
    sel = "\nUNION ALL ".join(
        f"SELECT '{m}' AS metric, '{s}' AS section, "
        f"{_m(f'max(CASE WHEN year = 2021 THEN {e} END)')} AS y2021, "
        f"{_m(f'max(CASE WHEN year = 2022 THEN {e} END)')} AS y2022 FROM dash"
        for m, s, e in metrics)
    q["statement_compare"] = _with(*_flux_ctes()) + "\n" + sel

    measures = ["revenue", "net_income", "cash", "accounts_receivable", "accounts_payable",
                "debt_remaining", "inventory", "gross_ppe", "net_ppe"]
    long = "\nUNION ALL ".join(f"SELECT '{m}' AS measure, year, {m} AS value FROM dash" for m in measures)
    # percent x 1e10, half away from zero, in integers: (v - p) * 100 / |p|
    dv = "CAST(round((value - prev_value) * 100) AS HUGEINT)"
    pc = "CAST(round(abs(prev_value) * 100) AS HUGEINT)"
    pct10 = (f"CAST(sign({dv}) * ((2 * abs({dv}) * 1000000000000 + {pc}) // (2 * {pc})) "
             f"AS DECIMAL(38,0)) * CAST(0.0000000001 AS DECIMAL(38,10))")
    q["flux_yoy"] = _with(*_flux_ctes(), f"""
long AS ({long}),
lagged AS (SELECT measure, year, value,
                  lag(value) OVER (PARTITION BY measure ORDER BY year ASC NULLS LAST) AS prev_value
           FROM long)""") + f"""
SELECT measure, year, value, prev_value,
       CASE WHEN prev_value IS NULL OR prev_value = 0 THEN NULL
            ELSE CAST(round({pct10}, 2) AS DECIMAL(38,2)) END AS yoy_pct
FROM lagged"""

    q["export_rows"] = _with() + """
SELECT id, sale_at, payment_at, payment_method, product_name, quantity, price
FROM sales WHERE year(sale_at) <= 2023"""

    after = [re.sub(r"\b(sales|purchases|payments|loans)\b", r"e_\1", x) for x in (DEP_SCHED, ACCRUALS, COSTS, _posts(False))]
    q["postings_after_edits"] = _with(*EDITED, YEARLY_CAL, *after) + """
SELECT rule, CAST(year AS INTEGER) AS year, account, CAST(sum(amt) AS DECIMAL(38,4)) AS amt
FROM posts GROUP BY rule, year, account"""

    q["open_receivables"] = _with(MONTHLY_CAL) + """
SELECT c.calendar_at AS month, count(*) AS n_open, CAST(sum(s.quantity * s.price) AS DECIMAL(38,2)) AS open_value
FROM mcal c JOIN sales s ON s.payment_method <> 'cash' AND s.sale_at <= c.calendar_at
     AND c.calendar_at < coalesce(s.payment_at, DATE '9999-12-31')
GROUP BY c.calendar_at"""

    q["cash_by_record"] = _with("""
flows AS (
    SELECT 'sales' AS source, id, payment_at AS moved_at, CAST(quantity * price AS DECIMAL(38,2)) AS amt FROM sales
    UNION ALL SELECT 'purchases', id, payment_at, -(quantity * amount) FROM purchases
    UNION ALL SELECT 'loans', id, loan_at, value FROM loans
    UNION ALL SELECT 'payments', id, payment_date, -amount FROM payments
)""") + """
SELECT source, id, moved_at, amt, CAST(sum(amt) OVER (ORDER BY moved_at ASC NULLS LAST) AS DECIMAL(38,2)) AS balance
FROM flows"""

    q["payments_by_type"] = _with() + """
SELECT id, payment_date, payment_type, amount,
       CAST(sum(amount) OVER (PARTITION BY payment_type ORDER BY payment_date ASC NULLS LAST) AS DECIMAL(38,2)) AS paid
FROM payments"""

    columns = ", ".join(SALES_COLUMNS)
    q["locate_differences"] = _with(f"""
copy AS (
    SELECT id, sale_at, CASE WHEN id % 1009 = 7 THEN NULL ELSE payment_at END AS payment_at, payment_method, product_name,
           CASE WHEN id % 997 = 5 THEN quantity + 1 ELSE quantity END AS quantity, price
    FROM sales WHERE id % 101 <> 3 OR id IS NULL
    UNION ALL SELECT {columns} FROM sales WHERE id % 499 = 9
),
two AS (SELECT {columns}, 1 AS l, 0 AS r FROM sales UNION ALL SELECT {columns}, 0, 1 FROM copy)""") + f"""
SELECT CAST(year(sale_at) AS INTEGER) AS year, CAST(month(sale_at) AS INTEGER) AS month, {columns},
       CAST(sum(l) AS BIGINT) AS n_left, CAST(sum(r) AS BIGINT) AS n_right
FROM two GROUP BY ALL HAVING sum(l) <> sum(r)"""

    q["keyed_load"] = _with() + "\nUNION ALL ".join(_keyed_branch(*t) for t in LOADED)

    q["postings_from_loads"] = _with(*(_kept(*t) for t in LOADED), YEARLY_CAL, *after) + """
SELECT rule, CAST(year AS INTEGER) AS year, account, CAST(sum(amt) AS DECIMAL(38,4)) AS amt
FROM posts GROUP BY rule, year, account"""
    return q
