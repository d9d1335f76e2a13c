"""Connected components of links between long ids, as repeated star joins.

Large and small star steps in turn: every node's greater (then smaller)
neighbours are tied to its least one. Neither step adds edges, and the edges
end as one star per component, whose centre is its least node. Each pair of
steps is written to the shared folder, so a lost executor repeats one of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm.common import release, stage


def _large(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("v"), F.col("b").alias("u")).unionAll(
        edges.select(F.col("b").alias("v"), F.col("a").alias("u")))
    least = both.groupBy("v").agg(F.min("u").alias("m")).select("v", F.least("m", "v").alias("m"))
    return both.where("u > v").join(least, "v").where("u <> m").select(F.col("u").alias("a"), F.col("m").alias("b")).distinct()


def _small(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u"))
    least = down.groupBy("v").agg(F.min("u").alias("m"))
    tied = down.join(least, "v").where("u <> m").select(F.col("u").alias("a"), F.col("m").alias("b"))
    return tied.unionAll(least.select(F.col("v").alias("a"), F.col("m").alias("b"))).distinct()


def stars(edges: DataFrame) -> DataFrame:
    """(a, b): each node but the least of its component, and that least node.

    ``edges``: (a long, b long), a <> b, in any order, repeated or not."""
    while True:
        before, edges = edges, stage(_small(_large(edges)), "stars")
        release(before)
        twice = edges.groupBy("a").count().where("count > 1").limit(1)
        chained = edges.join(edges.select(F.col("a").alias("c")), F.col("b") == F.col("c"), "left_semi").limit(1)
        if twice.isEmpty() and chained.isEmpty():
            return edges
