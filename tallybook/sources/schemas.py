"""Ledger table schemas.

Money is decimal everywhere. Source amounts carry 2 decimals; posted amounts
carry 4 (depreciation is cost x 0.05), and reports round to 2.
"""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(12, 2)
LOAN_MONEY = T.DecimalType(14, 2)
# Posted amounts and sums. 38 digits leave room for 100 TB of sales.
AMOUNT = T.DecimalType(38, 4)
REPORT = T.DecimalType(38, 2)
# Results of a division by a month count (exact to 10 places, 28 integer digits).
FINE = T.DecimalType(38, 10)
DEPRECIATION = T.DecimalType(18, 4)

SALES = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("sale_at", T.DateType()),
    T.StructField("payment_at", T.DateType()),
    T.StructField("payment_method", T.StringType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("price", MONEY),
])

PURCHASES = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("purchase_at", T.DateType()),
    T.StructField("payment_at", T.DateType()),
    T.StructField("payment_method", T.StringType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("amount", MONEY),
])

PAYMENTS = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("payment_date", T.DateType()),
    T.StructField("payment_type", T.StringType()),
    T.StructField("amount", MONEY),
])

LOANS = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("loan_at", T.DateType()),
    T.StructField("value", LOAN_MONEY),
])

LEDGER_SCHEMAS = {
    "sales": SALES,
    "purchases": PURCHASES,
    "payments": PAYMENTS,
    "loans": LOANS,
}
