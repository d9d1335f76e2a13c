"""Running totals at record grain: a balance after every record.

``SUM(value) OVER (PARTITION BY keys ORDER BY order NULLS LAST)`` over raw records would
sort a whole group in one task (all records, without keys). Here the records are
dealt to ranges of (keys, order), each range is summed up by itself, and what all
ranges before it hold of the group is added:

1. Records go to ranges of (keys, order, salt). The salt splits an order value that
   very many records share.
2. Within a range, a running total per group, peers sharing it (the default frame);
   written with the number of the range.
3. Per (range, group) the sum, and the first and last order value: a row for each, so
   about as many as ranges and groups. Their running sum is what is added.
4. Peers that lie on both sides of a border, or fill whole ranges, take the total of
   the last range that has them.

NULL order values are peers of each other and come last; NULL values count as nothing,
and a total over NULL values only is NULL. Equal records are records of their own.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_path
from ..sources.schemas import AMOUNT

#: Records in a range, about.
RANGE_ROWS = 500_000


def running_records(records: DataFrame, value: str, order: str, keys: tuple[str, ...] = (), out: str = "balance",
                    ranges: int | None = None, name: str = "balances") -> DataFrame:
    """All columns of ``records`` and ``out``, the running total of ``value`` by ``order``.

    ``ranges``: how many there are; by default from the number of records.
    """
    spark = records.sparkSession
    at = shared_path(spark, f"{name}-{uuid.uuid4().hex}")
    plain = records.withColumn("__salt", F.monotonically_increasing_id())
    if ranges is None:
        ranges = max(-(-records.count() // RANGE_ROWS), int(spark.conf.get("spark.sql.shuffle.partitions")))
    by = [*(F.col(k).asc_nulls_first() for k in keys), F.col(order).asc_nulls_last(), F.col("__salt").asc()]
    group = ["__range", *keys]
    inside = Window.partitionBy(*group).orderBy(F.col(order).asc_nulls_last())  # a range's records at the most
    amount = F.col(value).cast(AMOUNT)
    dealt = plain.repartitionByRange(ranges, *by).withColumn("__range", F.spark_partition_id()).drop("__salt")
    local = dealt.withColumn("__local", F.sum(amount).over(inside))
    local.write.parquet(at)
    local = spark.read.schema(local.schema).parquet(at)

    # NULL order values are the last: a flag before the value says so. Peers share their
    # local total, so the least struct has the sum of a range's first value.
    place = F.struct(F.col(order).isNull().alias("none"), F.col(order).alias("v"))
    least = F.min(F.struct(place.alias("at"), F.col("__local").alias("s")))
    per = local.groupBy(*group).agg(F.sum(amount).alias("s"), least.alias("f"), F.max(place).alias("last"))
    per = per.select(*group, "s", "last", F.col("f.at").alias("first"), F.col("f.s").alias("s_first"))
    before = Window.partitionBy(*keys).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("base", F.sum("s").over(before))
    # The total of an order value that begins a range, in the last range that it begins.
    peers = Window.partitionBy(*keys, "first").orderBy("__range").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    begun = per.withColumn("total", F.last(_plus("base", "s_first")).over(peers)).withColumn("until", F.max("__range").over(peers))
    starts = begun.select(*(F.col(k).alias(f"__k_{k}") for k in keys), F.col("first").alias("__at"), F.col("total").alias("__total"),
                          F.col("until").alias("__until")).distinct()
    on = F.col("last") == F.col("__at")
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"__k_{k}"))
    borders = per.join(starts, on, "left").select(
        *(F.col(c).alias(f"__p_{c}") for c in group), "base", "last", "__total", "__until")
    joined = local.join(borders, _same(group))
    reaches = (place == F.col("last")) & (F.col("__until") > F.col("__range"))
    total = F.when(reaches, F.col("__total")).otherwise(_plus("base", "__local"))
    return joined.select(*records.columns, total.cast(AMOUNT).alias(out))


def _same(columns: list[str]):
    on = None
    for c in columns:
        one = F.col(c).eqNullSafe(F.col(f"__p_{c}"))
        on = one if on is None else on & one
    return on


def _plus(a: str, b: str):
    """The sum of what there is; NULL if there is nothing."""
    return F.when(F.col(a).isNotNull() & F.col(b).isNotNull(), F.col(a) + F.col(b)).otherwise(F.coalesce(a, b))
