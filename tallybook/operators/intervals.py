"""Joining points with half-open intervals [lo, hi) of any length.

A join on ``lo <= point < hi`` has no equality to distribute by. Here every interval gets
a level by its length, and each level has bins of a width between an eighth of
its intervals' lengths and all of it: an interval lies in nine bins of its level at the
most, whatever its length, and a point in one bin of each level that occurs. The join is
an equi-join on (keys, level, bin), refined by the bounds themselves; a pair meets in
exactly one bin, so nothing has to be made distinct, and only the outer bins of an
interval hold points beyond it.

Skew: where many points share a bin (one dense day), its points are dealt to salts,
the few intervals of the bin repeated for each. The bins that need it follow from a
count of the points, one row a bin.

Points and bounds are dates, timestamps or whole numbers, all of one kind. A NULL point
or bound matches nothing, as in SQL; an interval with ``hi <= lo`` is empty; a missing
end is given by the caller as a far one (a long interval costs no more than a short).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Points of a bin in a task, about.
DENSE = 500_000
_STEP = 3  # a level's bins are 2 ** 3 times as wide as those of the level below


def as_number(c: Column, kind: str) -> Column:
    """Days, microseconds or the number itself."""
    if kind == "date":
        return F.unix_date(c).cast("long")
    if kind.startswith("timestamp"):
        return F.unix_micros(c.cast("timestamp"))
    if kind in ("tinyint", "smallint", "int", "bigint"):
        return c.cast("long")
    raise ValueError(f"points of type {kind} have no bins")


def level_of(lo: Column, hi: Column) -> Column:
    """The greatest level whose bins are no wider than the interval."""
    return F.floor((F.length(F.bin(hi - lo)) - 1) / _STEP).cast("int")


def _bin(x: Column, level: Column) -> Column:
    """Of numbers below zero as well: the shift keeps the sign."""
    return F.call_function("shiftright", x, level * _STEP)


def interval_join(points: DataFrame, spans: DataFrame, point: str, lo: str, hi: str, keys: tuple[str, ...] = (),
                  dense: int = DENSE) -> DataFrame:
    """All columns of ``points``, then those of ``spans`` without ``keys``, of every pair with
    ``lo <= point < hi`` and equal, non-null ``keys``."""
    p_kind, kinds = dict(points.dtypes)[point], dict(spans.dtypes)
    # Names of their own for what this join adds and for the spans' columns.
    ps = points.select("*", as_number(F.col(point), p_kind).alias("__x"))
    ss = spans.select("*", as_number(F.col(lo), kinds[lo]).alias("__lo"), as_number(F.col(hi), kinds[hi]).alias("__hi"))
    ss = ss.filter(F.col("__lo") < F.col("__hi")).withColumn("__level", level_of(F.col("__lo"), F.col("__hi")))
    level = F.col("__level")
    binned = ss.select("*", F.explode(F.sequence(_bin(F.col("__lo"), level), _bin(F.col("__hi") - 1, level))).alias("__bin"))
    # The levels that occur: 21 at the most, so a point is repeated as often at the most.
    levels = binned.agg(F.sort_array(F.collect_set("__level")).alias("__levels"))
    levels = [int(x) for x in levels.first()[0]]
    ps = ps.filter(F.col("__x").isNotNull()).select("*", F.explode(F.array(*map(F.lit, levels)).cast("array<int>")).alias("__level"))
    ps = ps.withColumn("__bin", _bin(F.col("__x"), F.col("__level")))
    at = [*keys, "__level", "__bin"]
    crowded = (ps.groupBy(*at).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > dense)
               .withColumn("__salts", F.ceil(F.col("__n") / dense).cast("int")).drop("__n"))
    salted = ps.join(crowded, at, "left").withColumn(
        "__salt", F.when(F.col("__salts").isNotNull(), F.pmod(F.xxhash64(*points.columns, F.monotonically_increasing_id()), F.col("__salts")))
        .otherwise(0).cast("int")).drop("__salts")
    dealt = binned.join(crowded, at, "left").withColumn(
        "__salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("__salts"), F.lit(1)) - 1))).drop("__salts")
    met = salted.join(dealt.withColumnsRenamed({c: f"__s_{c}" for c in spans.columns if c not in keys}), [*at, "__salt"])
    return (met.filter((F.col("__x") >= F.col("__lo")) & (F.col("__x") < F.col("__hi")))
            .select(*points.columns, *(F.col(f"__s_{c}").alias(c) for c in spans.columns if c not in keys)))
