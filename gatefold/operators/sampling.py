"""Deterministic sampling: systematic caps, quotas and hash-ordered draws that don't depend on partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gatefold.functions.quantiles import order_bin
from gatefold.functions.storage import cut, remove


def draw_key(seed: str | int, *columns: str) -> Column:
    """Hex digest of (seed, columns): the order of a draw."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in columns]).cast("binary"))


def on_grid(r: Column, n: Column, cap: int) -> Column:
    """Whether place r of n is one of round(1 + i (n - 1) / (cap - 1))."""
    if cap <= 1:
        return (n <= cap) | (r == 1)
    step = (n - 1) / F.lit(float(cap - 1))
    i = F.round((r - 1) / step)
    hit = F.lit(False)
    for k in (-1, 0, 1):
        hit = hit | (F.bround(1 + (i + k) * step).cast("long") == r)
    return (n <= cap) | hit


def systematic_cap(df: DataFrame, sample: str, index: str, cap: int) -> DataFrame:
    """At most cap evenly spaced rows a sample, in the order of index.

    Places come from counts by blocks of the index, so no sample is ranked in one task.
    """
    if cap <= 0:
        return df
    block = order_bin(F.col(index).cast("double"))
    d = df.withColumn("_b", block)
    sizes = d.groupBy(sample, "_b").agg(F.count(F.lit(1)).alias("_c"))
    by = Window.partitionBy(sample)
    sizes = sizes.withColumn("_n", F.sum("_c").over(by)).withColumn("_before", F.sum("_c").over(by.orderBy("_b")) - F.col("_c")).drop("_c")
    placed = d.join(sizes, [sample, "_b"]).withColumn("_r", F.col("_before") + F.row_number().over(Window.partitionBy(sample, "_b").orderBy(index)))
    return placed.filter(on_grid(F.col("_r"), F.col("_n"), cap)).select(*df.columns)


def systematic_positions(df: DataFrame, sample: str, index: str, cap: int) -> DataFrame:
    """The same where index is 1, 2, ... in every sample, as an event file numbers them: counts and arithmetic alone."""
    if cap <= 0:
        return df
    n = df.groupBy(sample).agg(F.max(index).alias("_n"))
    return df.join(n, sample).filter(on_grid(F.col(index), F.col("_n"), cap)).select(*df.columns)


def plan_subsample(counts: DataFrame, sample: str = "sample_id", n: str = "n", cap: int = 20_000, equalise: bool = True, total_cap: int = 200_000) -> DataFrame:
    """sample, take: the smallest sample's size (or the cap) for all, or each its own; scaled down to a total of at least one each."""
    one = counts.agg(F.min(n).alias("_min"))
    t = counts.join(F.broadcast(one)).withColumn("take", F.least(F.lit(cap), F.col("_min") if equalise else F.col(n)).cast("long"))
    total = t.agg(F.sum("take").alias("_total"))
    t = t.join(F.broadcast(total))
    scaled = F.greatest(F.lit(1), F.floor(F.col("take") * F.lit(float(total_cap)) / F.col("_total")))
    return t.select(sample, F.when(F.col("_total") > total_cap, scaled).otherwise(F.col("take")).cast("long").alias("take"))


#: Leading hex digits of a hash that select: rows are even over 16 ** DIGITS bins at any size.
DIGITS = 3


def mark_first(df: DataFrame, groups: list[str], digest: Column, key: str, take: Column, out: str, reads: tuple[str, ...] = ()) -> DataFrame:
    """df with out: whether a row is among the first `take` of its group in the order of digest and key.

    digest is a hex hash, take an expression of n (rows of the group) and of columns that the group decides (reads).  Rows are counted by the first
    digits of their hash; those before the bin that holds the place `take` are in, those after it out, and only
    the bin's own rows, one of 16 ** DIGITS of the group, are put in order.
    """
    d = df.withColumns({"_h": digest, "_b": F.substring(digest, 1, DIGITS)})
    bins = d.groupBy(*groups, *reads, "_b").agg(F.count(F.lit(1)).alias("_c"))
    by = Window.partitionBy(*groups)
    upto = bins.withColumns({"_upto": F.sum("_c").over(by.orderBy("_b")), "n": F.sum("_c").over(by)}).withColumn("_take", take)
    edge = upto.filter((F.col("_upto") >= F.col("_take")) | (F.col("_upto") == F.col("n"))).groupBy(*groups).agg(F.min(F.struct("_b", (F.col("_take") - F.col("_upto") + F.col("_c")).alias("left"))).alias("_e"))
    limits = cut(edge.select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(groups)], F.col("_e._b").alias("_edge"), F.col("_e.left").alias("_left")), "limits")
    match = F.lit(True)
    for i, g in enumerate(groups):
        match = match & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    placed = d.join(limits, match)
    row = F.row_number().over(Window.partitionBy(*[f"_g{i}" for i in range(len(groups))]).orderBy("_h", key))
    far = placed.filter("_b <> _edge").withColumn(out, F.col("_b") < F.col("_edge"))
    near = placed.filter("_b = _edge").withColumn(out, row <= F.col("_left"))
    return far.unionByName(near).select(*df.columns, out)


def draw_counted(df: DataFrame, group: str, sizes: dict[str, int], digest: Column, key: str, take: int, out: str) -> DataFrame:
    """The rows that mark_first would mark, with out, their digest, where the sizes of all groups are known: one pass instead of three.

    A hash below its expected place and some has the wanted rows nearly always; a group that has too few below its bound gets
    a bound four times as high, up to all its rows.
    """
    room = {g: (take + 6 * take**0.5 + 16) / max(1, n) for g, n in sizes.items()}
    while True:
        below = F.coalesce(*[F.when(F.col(group) == g, F.lit(True) if r >= 1 else F.substring(digest, 1, 8) < f"{int(r * 16**8):08x}") for g, r in room.items()], F.lit(False))
        near = cut(df.filter(below).withColumn(out, digest), "near")
        have = {r[group]: r["count"] for r in near.groupBy(group).count().collect()}  # one row a group
        short = [g for g, r in room.items() if r < 1 and have.get(g, 0) < take]
        if not short:
            break
        room |= {g: 4 * room[g] for g in short}
        remove(near)
    return near.withColumn("_r", F.row_number().over(Window.partitionBy(group).orderBy(out, key))).filter(F.col("_r") <= take).drop("_r")


def draw(df: DataFrame, quota: DataFrame, sample: str, key: str, seed: str | int = 42) -> DataFrame:
    """The first `take` rows of each sample in hash order."""
    d = df.join(quota.select(sample, F.col("take").alias("_quota")), sample)
    return mark_first(d, [sample], draw_key(seed, sample, key), key, F.col("_quota"), "_in", ("_quota",)).filter("_in").select(*df.columns)


def stratified_split(df: DataFrame, label: str, key: str, holdout: float = 0.3, seed: str | int = 42) -> DataFrame:
    """df with is_test: the first share of each label in hash order."""
    return mark_first(df, [label], draw_key(seed, key), key, F.floor(F.col("n") * F.lit(holdout)), "is_test")


def largest(df: DataFrame, label: str, n: int, min_size: int = 1) -> DataFrame:
    """The n largest labels of at least min_size rows."""
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n_cells")).filter(F.col("n_cells") >= min_size).orderBy(F.desc("n_cells"), label).limit(n)
