"""Exact quantiles of groups of any size by two passes, with memory that doesn't depend on distinct values.

The first pass counts values by a monotone bin of their sign and the logarithm of their size: at most a few thousand bins a group, combined before the shuffle.  Cumulative counts tell in
which bins the wanted order statistics lie.  Only rows of bins that hold several different values are
read again, counted by value.  `percentile` would hold every distinct value of a group in one buffer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gatefold.functions.numeric import col, finite
from gatefold.functions.storage import cut

#: Bins of one power of two; rows of a table of wanted bins that may be broadcast, and that are named in a filter before its join.
STEPS, BROADCAST_ROWS, NAMED_ROWS = 256, 100_000, 500


def order_bin(x: Column) -> Column:
    """A whole number that never falls where x rises: the logarithm of its size in steps, which is monotone, with its sign."""
    b = F.floor((F.log2(F.abs(x)) + 1100) * STEPS)
    return F.when(x > 0, b).when(x < 0, -b).otherwise(F.lit(0)).cast("long")


def order_statistics(df: DataFrame, keys: list[str], value: Column | str, positions) -> DataFrame:
    """keys, n and at: a map from position (from 0) to the value there; positions: n -> array column of positions."""
    d = df.filter(finite(value)).select(*keys, col(value).cast("double").alias("_q_x"))
    d = d.withColumn("_q_b", order_bin(F.col("_q_x")))
    by = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(1))
    h = d.groupBy(*keys, "_q_b").agg(F.count(F.lit(1)).alias("_q_c"), F.min("_q_x").alias("_q_lo"), F.max("_q_x").alias("_q_hi"))
    h = h.withColumn("_q_upto", F.sum("_q_c").over(by.orderBy("_q_b"))).withColumn("n", F.sum("_q_c").over(by))
    h = h.withColumn("_q_before", F.col("_q_upto") - F.col("_q_c")).withColumn("_q_want", F.filter(positions(F.col("n")), lambda p: (p >= F.col("_q_before")) & (p < F.col("_q_upto"))))
    want = cut(h.filter(F.size("_q_want") > 0).select(*keys, "n", "_q_b", "_q_before", "_q_lo", "_q_hi", "_q_want"), "bins")
    known = want.filter("_q_lo = _q_hi").select(*keys, "n", F.explode("_q_want").alias("p"), F.col("_q_lo").alias("v"))
    mixed = want.filter("_q_lo < _q_hi")
    if rows := mixed.count():
        join_keys = [*keys, "_q_b"]
        side = mixed.select(*join_keys)
        if rows <= NAMED_ROWS:
            d = d.filter(F.col("_q_b").isin([r["_q_b"] for r in side.select("_q_b").distinct().collect()]))
        again = d.join(F.broadcast(side) if rows <= BROADCAST_ROWS else side, join_keys).groupBy(*join_keys, "_q_x").agg(F.count(F.lit(1)).alias("_q_c"))
        again = again.withColumn("_q_in", F.sum("_q_c").over(Window.partitionBy(*join_keys).orderBy("_q_x"))).join(mixed.select(*join_keys, "n", "_q_before", "_q_want"), join_keys)
        last = F.col("_q_before") + F.col("_q_in")
        hit = F.filter("_q_want", lambda p: (p < last) & (p >= last - F.col("_q_c")))
        known = known.unionByName(again.select(*keys, "n", F.explode(hit).alias("p"), F.col("_q_x").alias("v")))
    return known.groupBy(*keys, "n").agg(F.map_from_entries(F.collect_list(F.struct("p", "v"))).alias("at"))


def quantiles(df: DataFrame, keys: list[str], value: Column | str, probs: list[float]) -> DataFrame:
    """keys, n and q: interpolated quantiles (the usual h = (n - 1) p) of the finite values."""
    grid = F.array(*[F.lit(float(p)) for p in probs])
    both = lambda n: F.flatten(F.transform(grid, lambda p: F.array(F.floor((n - 1) * p), F.ceil((n - 1) * p))))
    s = order_statistics(df, keys, value, lambda n: F.array_distinct(both(n)))
    n, at = F.col("n"), F.col("at")

    def between(p: Column) -> Column:
        a, b = at[F.floor((n - 1) * p)], at[F.ceil((n - 1) * p)]
        return a + (b - a) * ((n - 1) * p - F.floor((n - 1) * p))

    return s.select(*keys, "n", F.transform(grid, between).alias("q"))
