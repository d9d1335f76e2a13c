"""Map the driver's TPC-H-like tables onto the four ledger tables.

The mapping is fixed test-data plumbing (see FIXTURES.md section 2); the DuckDB
oracle uses the same mapping. Every ledger table is a lazy DataFrame over the
Parquet files, so Catalyst prunes columns and pushes filters into the scans.
"""

from __future__ import annotations

import datetime as dt
import os
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .schemas import LOAN_MONEY, MONEY

# Fixed values of the adapter (FIXTURES.md section 2).
SHIFT_MONTHS = 312
PURCHASE_COST_RATIO = "0.60"
UNCOSTED_BRAND = "Brand#13"
LOAN_EPOCH = dt.date(2021, 1, 15)
LOAN_DAY_STRIDE = 37
LOAN_DAY_SPAN = 2200
# payment_type by o_orderkey % 16
PAYMENT_TYPE_BY_SLOT = [
    (0, 0, "equipment"),
    (1, 1, "loan"),
    (2, 2, "interest"),
    (3, 6, "wage"),
    (7, 9, "utility"),
    (10, 11, "tax"),
    (12, 14, "rent"),
    (15, 15, "dividend"),
]


@dataclass
class Ledger:
    """The four raw ledger tables."""
    sales: DataFrame
    purchases: DataFrame
    payments: DataFrame
    loans: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return {"sales": self.sales, "purchases": self.purchases,
                "payments": self.payments, "loans": self.loans}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _shift(c: Column) -> Column:
    return F.add_months(c.cast("date"), SHIFT_MONTHS)


def _product_lines(lineitem: DataFrame, part: DataFrame, keep: Column) -> DataFrame:
    li = lineitem.filter(keep).select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity",
        "l_returnflag", "l_linestatus", "l_shipdate")
    pt = part.select("p_partkey", "p_name", "p_brand", "p_retailprice")
    # part grows with the data too: no hint, Spark sizes the join itself.
    return li.join(pt, li.l_partkey == pt.p_partkey)


def sales_from(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    j = _product_lines(lineitem, part, F.col("l_returnflag") != "R")
    sale_at = _shift(F.col("l_shipdate"))
    ln = F.col("l_linenumber")
    return j.select(
        (F.col("l_orderkey") * 8 + ln).alias("id"),
        sale_at.alias("sale_at"),
        F.when((F.col("l_returnflag") == "N") & (ln == 6), F.lit(None).cast("date"))
         .otherwise(F.date_add(sale_at, ln * 7)).alias("payment_at"),
        F.when(ln == 7, F.lit(None).cast("string"))
         .when(F.col("l_returnflag") == "N", F.lit("credit"))
         .otherwise(F.lit("cash")).alias("payment_method"),
        F.concat(F.col("p_name"), F.lit(" / "), F.col("p_brand")).alias("product_name"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("p_retailprice").cast(MONEY).alias("price"),
    )


def purchases_from(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    j = _product_lines(lineitem, part, F.col("l_returnflag") == "R")
    j = j.filter(F.col("p_brand") != UNCOSTED_BRAND)
    purchase_at = _shift(F.col("l_shipdate"))
    return j.select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"),
        purchase_at.alias("purchase_at"),
        F.date_add(purchase_at, F.col("l_linenumber") * 7).alias("payment_at"),
        F.when(F.col("l_linestatus") == "O", F.lit("credit")).otherwise(F.lit("cash"))
         .alias("payment_method"),
        F.concat(F.col("p_name"), F.lit(" / "), F.col("p_brand")).alias("product_name"),
        (F.col("l_quantity").cast("int") * 2).alias("quantity"),
        (F.col("p_retailprice").cast(MONEY) * F.lit(PURCHASE_COST_RATIO).cast("decimal(3,2)"))
         .cast(MONEY).alias("amount"),
    )


def payments_from(orders: DataFrame) -> DataFrame:
    slot = F.col("o_orderkey") % 16
    ptype = None
    for lo, hi, name in PAYMENT_TYPE_BY_SLOT:
        cond = slot.between(lo, hi)
        ptype = F.when(cond, F.lit(name)) if ptype is None else ptype.when(cond, F.lit(name))
    return orders.select(
        F.col("o_orderkey").alias("id"),
        _shift(F.col("o_orderdate")).alias("payment_date"),
        ptype.alias("payment_type"),
        F.col("o_totalprice").cast(MONEY).alias("amount"),
    )


def loans_from(supplier: DataFrame) -> DataFrame:
    days = ((F.col("s_suppkey") * LOAN_DAY_STRIDE) % LOAN_DAY_SPAN).cast("int")
    return supplier.select(
        F.col("s_suppkey").alias("id"),
        F.date_add(F.lit(LOAN_EPOCH), days).alias("loan_at"),
        (F.abs(F.col("s_acctbal")).cast(MONEY) * F.lit(100)).cast(LOAN_MONEY).alias("value"),
    )


def ledger_from_driver(spark: SparkSession, sf_dir: str) -> Ledger:
    """Lazy ledger over the driver's Parquet tables, with the files listed now."""
    lineitem = read_table(spark, sf_dir, "lineitem")
    part = read_table(spark, sf_dir, "part")
    return Ledger(
        sales=sales_from(lineitem, part),
        purchases=purchases_from(lineitem, part),
        payments=payments_from(read_table(spark, sf_dir, "orders")),
        loans=loans_from(read_table(spark, sf_dir, "supplier")),
    )
