"""Operator 11: shards of shuffled records by a two-pass external shuffle.

1. Scatter: every record, with all its columns, goes to one of the buckets by a
   seeded hash of its id and its place in the input. The number of buckets
   follows from the bytes of all records, so that one fits in a task's memory.
   The place keeps rows apart that are equal or share an id: a third of all rows
   under one id spreads like any others.
2. Each bucket is put in the order of its hashes (blocks of a shuffle arrive in
   any order), shuffled by Fisher-Yates, seeded by the bucket, and written to
   the shared folder with each record's place.

The shuffled buckets, one after the other, are the shuffled table. It is cut
into ``n_shards`` runs whose numbers of rows differ by one at the most: a
record's shard and its slot in there follow from its bucket's first row number
(sums over a count per bucket) and its place in the bucket. This is the law
``rows``; records of equal texts are no unit and spread over the shards.

The order depends on the seed and on how the input is cut into partitions
(the same for all attempts of a task over files or a written table; write a
table first whose rows come in another order each time it is made).

Defined results: null and empty texts are records like any other, with 8 bytes
of size and checksum 0. Null and repeated ids and repeated rows are records of
their own. With fewer rows than shards the first shards have a row each. An empty
table gives an empty result. Further columns, whatever their names, travel along.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallybook.llm.common import column, documents, numbered, stage

#: Bytes of records in a bucket, about: some times that is held by a task.
BUCKET_BYTES = 8 << 20
#: Up to so many buckets (24 bytes each) their offsets are broadcast.
MOST_SENT = 1 << 20


def fisher_yates(n: int, rng: np.random.Generator) -> np.ndarray:
    """0 .. n - 1 in a random order: from the last place down, each place is
    swapped with one at or below it."""
    order = np.arange(n)
    if n > 1:
        last = np.arange(n - 1, 0, -1)
        for i, j in zip(last.tolist(), rng.integers(0, last + 1).tolist()):
            order[i], order[j] = order[j], order[i]
    return order


def _record_bytes(docs: DataFrame) -> Column:
    size = F.lit(8)
    for name, kind in docs.dtypes:
        c = F.col(name)
        if kind in ("string", "binary") or kind.startswith(("array", "map", "struct")):
            text = c if kind in ("string", "binary") else c.cast("string")
            size = size + F.coalesce(F.octet_length(text), F.lit(0))
        else:
            size = size + F.lit(8)
    return F.sum(size.cast("long"))


def scattered(plain: DataFrame, id_name: str, n_buckets: int, seed: int) -> DataFrame:
    """Numbered columns with ``__at`` (place in the input), ``__key`` and ``__bucket``."""
    return (plain.withColumn("__at", F.monotonically_increasing_id())
            .withColumn("__key", F.xxhash64(F.lit(seed), id_name, "__at"))
            .withColumn("__bucket", F.pmod("__key", F.lit(n_buckets)).cast("long")))


def shuffled_buckets(docs: DataFrame, id_col: str, seed: int, bucket_bytes: int) -> DataFrame:
    """Numbered columns with ``__bucket`` and ``__place``, both passes done, written."""
    plain = numbered(docs)
    n_buckets = max(1, math.ceil((plain.agg(_record_bytes(plain)).first()[0] or 0) / bucket_bytes))
    names = [*plain.columns, "__bucket", "__place"]

    def shuffle(bucket: pa.Table) -> pa.Table:
        number = bucket["__bucket"][0].as_py()
        bucket = bucket.sort_by([("__key", "ascending"), ("__at", "ascending")])
        order = fisher_yates(bucket.num_rows, np.random.default_rng([seed, number]))
        return bucket.take(pa.array(order)).append_column("__place", pa.array(np.arange(len(order)))).select(names)

    ddl = ", ".join(f"{n} {t}" for n, t in plain.dtypes)
    made = (scattered(plain, column(docs, id_col), n_buckets, seed).groupBy("__bucket")
            .applyInArrow(shuffle, f"{ddl}, __bucket long, __place long"))
    return stage(made, "buckets")


def first_rows(buckets: DataFrame, together: int = 1024) -> DataFrame:
    """__bucket, __first: the number of rows in all buckets before it. Sums run
    within groups of ``together`` buckets, then over the groups."""
    per = buckets.groupBy("__bucket").agg(F.count("*").alias("n")).withColumn("__group", F.expr(f"__bucket div {together}"))
    before = Window.partitionBy("__group").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    groups = per.groupBy("__group").agg(F.sum("n").alias("n")).withColumn(
        "base", F.coalesce(F.sum("n").over(Window.orderBy("__group").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return (per.withColumn("inner", F.coalesce(F.sum("n").over(before), F.lit(0)))
            .join(groups.select("__group", "base"), "__group").selectExpr("__bucket", "base + inner as __first"))


def sharded(docs: DataFrame, n_shards: int = 24, id_col: str = "doc_id", seed: int = 7,
            bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """All columns of ``docs``, then ``__shard`` (0 ..) and ``__slot`` (0 .. in it)."""
    buckets = shuffled_buckets(docs, id_col, seed, bucket_bytes)
    firsts = first_rows(buckets)
    if (buckets.agg(F.max("__bucket")).first()[0] or 0) < MOST_SENT:
        firsts = F.broadcast(firsts)
    least, more = divmod(buckets.count(), n_shards)  # ``more`` shards have a row more
    numbers = buckets.join(firsts, "__bucket").withColumn("__row", F.expr("__first + __place"))
    big = f"__row < {more * (least + 1)}"
    rest = f"(__row - {more * (least + 1)})"
    return numbers.select(
        *(f"__c{k}" for k in range(len(docs.columns))),
        F.expr(f"int(if({big}, __row div {least + 1}, {more} + {rest} div {max(least, 1)}))"),
        F.expr(f"if({big}, __row % {least + 1}, {rest} % {max(least, 1)})")).toDF(*docs.columns, "__shard", "__slot")


def write_shards(docs: DataFrame, path: str, n_shards: int = 24, id_col: str = "doc_id", seed: int = 7,
                 bucket_bytes: int = BUCKET_BYTES) -> None:
    """Parquet below ``path``, a folder a shard, rows in order of their slots.

    A task writes the runs of shards that its buckets hold; nothing is shuffled again.
    """
    (sharded(docs, n_shards, id_col, seed, bucket_bytes).sortWithinPartitions("__shard", "__slot")
     .write.partitionBy("__shard").parquet(path))


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document, by the law of rows, with size and checksum of the shuffled text."""
    docs = documents(spark, sf_dir)
    doc_id, text, at = column(docs, "doc_id"), column(docs, "text"), len(docs.columns)
    return numbered(sharded(docs)).selectExpr(
        f"bigint({doc_id}) as doc_id", f"bigint(coalesce(octet_length({text}), 0) + 8) as size",
        f"crc32(encode(coalesce({text}, ''), 'UTF-8')) as text_crc32", "'rows' as law",
        f"__c{at} as shard", f"__c{at + 1} as slot", "cast(null as int) as grown_shard")
