"""Tables clustered by date and product, and reads that open only the files needed.

In the order of arrival every file holds all products, and most hold many dates, so a
filter opens them all. ``write_clustered`` deals the rows to files along a Z-curve over
two ranks: that of the date among the table's quantiles and that of the product's
hash, so a file covers a small rectangle of both. The least and greatest date and hash
of each file are kept beside the data, and ``read_clustered`` opens the files whose
rectangle meets the question, then filters the rows themselves.

A day or a product that very many rows share spreads over files by the other rank, and
by a salt where both are the same.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .versions import Version, current_version, frame_of, new_folder, next_number, publish

#: Ranks of a dimension: 2 ** BITS.
BITS = 8


def date_rank(df: DataFrame, date: str) -> Column:
    """Place of the date among 2 ** BITS - 1 quantiles of the table's dates; NULL: after all."""
    n = 1 << BITS
    days = df.select(F.unix_date(date).cast("double").alias("d"))
    bounds = days.approxQuantile("d", [k / n for k in range(1, n)], 0.25 / n)
    at = F.unix_date(date)
    rank = F.size(F.filter(F.array(*map(F.lit, sorted(set(bounds)))).cast("array<double>"), lambda b: b <= at))
    return F.when(at.isNull(), n - 1).otherwise(F.least(rank, F.lit(n - 1))).cast("int")


def product_rank(product: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(product), 64 - BITS).cast("int")


def z_value(a: Column, b: Column) -> Column:
    """The bits of both ranks in turn."""
    z = F.lit(0)
    for k in range(BITS):
        z = z + F.shiftleft(F.shiftright(a, k).bitwiseAND(1), 2 * k + 1) + F.shiftleft(F.shiftright(b, k).bitwiseAND(1), 2 * k)
    return z


def write_clustered(df: DataFrame, table: str, date: str, product: str, files: int) -> Version:
    """The next version of ``table`` (``sources.versions``) in ``files`` clustered files."""
    spark = df.sparkSession
    base = current_version(spark, table)
    number = next_number(base)
    folder = new_folder(number)
    dealt = (df.withColumn("__z", z_value(date_rank(df, date), product_rank(F.col(product))))
             .withColumn("__salt", F.monotonically_increasing_id()).repartitionByRange(files, "__z", "__salt"))
    dealt.drop("__z", "__salt").write.parquet(f"{table}/{folder}")
    version = Version(number, (folder,), df.schema.json(), tuple(df.columns), {"date": date, "product": product})
    rank = product_rank(F.col(product))
    stats = (frame_of(spark, table, version).withColumn("file", F.input_file_name())
             .groupBy("file").agg(F.min(date).alias("first"), F.max(date).alias("last"), F.min(rank).alias("least"),
                                  F.max(rank).alias("most"), F.count(F.lit(1)).alias("n")))
    # A hidden folder of the data's: seen by this module only, deleted with the data.
    stats.withColumn("file", F.substring_index("file", "/", -1)).coalesce(1).write.parquet(f"{table}/{folder}/_stats")
    return publish(spark, table, version)


def file_stats(spark: SparkSession, table: str, version: Version) -> DataFrame:
    ddl = "file string, first date, last date, least int, most int, n long"
    return spark.read.schema(ddl).parquet(f"{table}/{version.folders[0]}/_stats")


def files_for(spark: SparkSession, table: str, since: dt.date | None = None, before: dt.date | None = None,
              product: str | None = None) -> list[str]:
    """The files that may hold rows with ``since <= date < before`` and the product: their
    names come to the driver, as the table's own listing does."""
    version = current_version(spark, table)
    meets = F.lit(True)
    if since is not None:
        meets = meets & (F.col("last") >= F.lit(since))
    if before is not None:
        meets = meets & (F.col("first") < F.lit(before))
    if product is not None:
        rank = product_rank(F.lit(product))
        meets = meets & (F.col("least") <= rank) & (F.col("most") >= rank)
    return sorted(r["file"] for r in file_stats(spark, table, version).filter(meets).select("file").collect())


def read_clustered(spark: SparkSession, table: str, since: dt.date | None = None, before: dt.date | None = None,
                   product: str | None = None) -> DataFrame:
    """The rows of the current version with ``since <= date < before`` and the product."""
    version = current_version(spark, table)
    names = files_for(spark, table, since, before, product)
    part = Version(version.number, tuple(f"{version.folders[0]}/{n}" for n in names), version.schema, version.columns)
    rows, date = frame_of(spark, table, part), F.col(version.notes["date"])
    if since is not None:
        rows = rows.filter(date >= F.lit(since))
    if before is not None:
        rows = rows.filter(date < F.lit(before))
    if product is not None:
        rows = rows.filter(F.col(version.notes["product"]) == product)
    return rows
