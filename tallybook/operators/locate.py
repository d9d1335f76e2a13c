"""Locating differences between two copies of a table of dated records.

An audit says that two sums differ, not where. Here both sides are summed up over a tree
of buckets, year, then month, then product: the number of records and the sum of their
64-bit hashes, left minus right, in one aggregate over both. Only buckets that differ
are descended into: the years, then the months, become date ranges that reach the scans,
so files and row groups of other dates are not read again; the records of the
differing products are compared as multisets in the end. Sums of hashes that agree
by chance (about 2 ** -64 a bucket) would hide a difference of equally many records.

Years come to the driver (at most 9,999 and one for NULL dates), and months (at most
12 times as many); products and records never do.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Date ranges of a filter; more are joined where the gaps are least.
MOST_RANGES = 100


def _sides(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.withColumn("__w", F.lit(1).cast("long")).unionByName(right.withColumn("__w", F.lit(-1).cast("long")))


def differing_buckets(left: DataFrame, right: DataFrame, *keys: Column) -> DataFrame:
    """The buckets of ``keys`` whose records differ, with the surplus of the left side."""
    w = F.col("__w")
    check = F.sum(w * F.xxhash64(*left.columns).cast("decimal(20,0)")).alias("__check")
    return (_sides(left, right).groupBy(*keys).agg(F.sum(w).alias("surplus"), check)
            .filter((F.col("surplus") != 0) | (F.col("__check") != 0)).drop("__check"))


def month_ranges(months: list[tuple[int, int]], most: int = MOST_RANGES) -> list[tuple[dt.date, dt.date]]:
    """Half-open date ranges over (year, month) pairs: neighbours in one, and no more
    than ``most`` of them, which then cover some other months, too."""
    runs: list[list[int]] = []
    for k in sorted({12 * y + m - 1 for y, m in months}):
        if runs and runs[-1][1] == k:
            runs[-1][1] = k + 1
        else:
            runs.append([k, k + 1])
    while len(runs) > most:
        at = min(range(1, len(runs)), key=lambda i: runs[i][0] - runs[i - 1][1])
        runs[at - 1:at + 1] = [[runs[at - 1][0], runs[at][1]]]
    return [(dt.date(a // 12, a % 12 + 1, 1), dt.date(b // 12, b % 12 + 1, 1)) for a, b in runs]


def _within(date: Column, ranges: list[tuple[dt.date, dt.date]], nulls: bool) -> Column:
    cond = date.isNull() if nulls else F.lit(False)
    for lo, hi in ranges:
        cond = cond | ((date >= F.lit(lo)) & (date < F.lit(hi)))
    return cond


def narrowed(left: DataFrame, right: DataFrame, date: str) -> tuple[DataFrame, DataFrame]:
    """Both sides, restricted to the months that differ; two jobs of one aggregate each."""
    d = F.col(date)
    years = [r["y"] for r in differing_buckets(left, right, F.year(d).alias("y")).collect()]
    by_year = month_ranges([(y, m) for y in years if y is not None for m in range(1, 13)])
    sides = [df.filter(_within(d, by_year, None in years)) for df in (left, right)]
    months = differing_buckets(*sides, F.year(d).alias("y"), F.month(d).alias("m")).collect()
    ranges = month_ranges([(r["y"], r["m"]) for r in months if r["y"] is not None])
    cond = _within(d, ranges, any(r["y"] is None for r in months))
    return left.filter(cond), right.filter(cond)


def locate_differences(left: DataFrame, right: DataFrame, date: str, product: str) -> DataFrame:
    """The records that one side has more often: year, month, all columns, n_left, n_right.

    The sides have the same columns. Records of a product are compared only where
    the product's bucket differs.
    """
    sides = narrowed(left, right, date)
    y, m = F.year(date).alias("year"), F.month(date).alias("month")
    buckets = differing_buckets(*sides, y, m, F.col(product).alias("__product")).select(
        F.col("year").alias("__y"), F.col("month").alias("__m"), "__product")
    rows = _sides(*sides)
    here = (F.year(date).eqNullSafe(F.col("__y")) & F.month(date).eqNullSafe(F.col("__m"))
            & F.col(product).eqNullSafe(F.col("__product")))
    rows = rows.join(buckets, here, "left_semi")
    return (rows.groupBy(y, m, *left.columns)
            .agg(F.count_if(F.col("__w") > 0).alias("n_left"), F.count_if(F.col("__w") < 0).alias("n_right"))
            .filter("n_left <> n_right"))
