"""Rank statistics by windows: average ranks, rank-sum, Kruskal-Wallis, signed rank, Friedman, Spearman, Benjamini-Hochberg.

All inputs are per-sample values.  Statistics are window and aggregate expressions; only the p-values of
finished statistics (one row a test) go through an Arrow-batched function.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gatefold.functions.numeric import col, finite
from gatefold.functions.quantiles import order_bin
from gatefold.functions.storage import cut
from gatefold.functions.tails import p_chi2, p_normal, p_t


def avg_rank(partition: list[str], value: str) -> Column:
    """Rank with ties averaged."""
    order = Window.partitionBy(*partition).orderBy(value)
    ties = Window.partitionBy(*partition, value)
    return F.rank().over(order) + (F.count(F.lit(1)).over(ties) - 1) / 2.0


def tie_sum(ranked: DataFrame, keys: list[str], value: str) -> DataFrame:
    """keys, ties: sum of t**3 - t over runs of equal values."""
    t = ranked.groupBy(*keys, value).agg(F.count(F.lit(1)).cast("double").alias("_t"))
    return t.groupBy(*keys).agg(F.sum(F.col("_t") * F.col("_t") * F.col("_t") - F.col("_t")).alias("ties"))


def bh_adjust(df: DataFrame, p: str, family: list[str] | None = None, out: str = "p_adj_BH") -> DataFrame:
    """Benjamini-Hochberg within each family; nulls are no tests and stay null."""
    fam = family or []
    x = col(p)
    ok = F.when(finite(x), x)
    part = [*fam, F.isnull(ok)]
    n = F.count(ok).over(Window.partitionBy(*part))
    rank = F.row_number().over(Window.partitionBy(*part).orderBy(ok))
    d = df.withColumn("_raw", ok * n / rank).withColumn("_p", ok)
    down = Window.partitionBy(*fam, F.isnull("_p")).orderBy(F.desc("_p"), "_raw").rowsBetween(Window.unboundedPreceding, 0)
    return d.withColumn(out, F.when(F.col("_p").isNotNull(), F.least(F.lit(1.0), F.min("_raw").over(down)))).drop("_raw", "_p")


def against_reference(df: DataFrame, keys: list[str], group: str, value: str, reference: str | None = None) -> DataFrame:
    """keys, comparison, side (ref or cmp), value: the reference rows once for every other group.

    Without a reference, or where it is absent, the first group in sorted order stands in.
    """
    # without keys all rows are one family
    d = df.filter(finite(value) & col(group).isNotNull()).select(*keys, F.col(group).alias("_g"), F.col(value).alias("_v"), F.lit(1).alias("_one"))
    groups = d.select("_g").distinct()
    first = groups.agg(F.coalesce(F.max(F.when(F.col("_g") == (reference or ""), F.col("_g"))), F.min("_g")).alias("_ref"))
    d = d.join(F.broadcast(first))  # one row
    others = d.filter(F.col("_g") != F.col("_ref")).select(*keys, "_one", F.col("_g").alias("comparison")).distinct()
    ref = d.filter(F.col("_g") == F.col("_ref")).join(others, [*keys, "_one"])
    cmp_ = d.filter(F.col("_g") != F.col("_ref"))
    a = ref.select(*keys, F.col("_ref").alias("reference"), "comparison", F.lit("ref").alias("side"), "_v")
    b = cmp_.select(*keys, F.col("_ref").alias("reference"), F.col("_g").alias("comparison"), F.lit("cmp").alias("side"), "_v")
    return a.unionByName(b).withColumnRenamed("_v", value)


def rank_sum(sides: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Rank-sum statistics of each (keys, comparison): sizes, medians, means, sds, w, z, cliffs_delta, p_value.

    Normal approximation with continuity and tie correction.  Cliff's delta comes from the rank sum: no pairs are formed.
    """
    k = [*keys, "reference", "comparison"]
    r = sides.withColumn("_r", avg_rank(k, value))
    is_ref = F.col("side") == "ref"
    pick = lambda f, c, x: f(F.when(c, x))
    med = lambda c: F.percentile(F.when(c, col(value)), F.lit(0.5))
    s = r.groupBy(*k).agg(
        F.sum(is_ref.cast("long")).alias("n_reference"), F.sum((~is_ref).cast("long")).alias("n_comparison"), pick(F.sum, is_ref, F.col("_r")).alias("_rr"), pick(F.sum, ~is_ref, F.col("_r")).alias("_rc"),
        med(is_ref).alias("median_reference"), med(~is_ref).alias("median_comparison"), pick(F.avg, is_ref, col(value)).alias("mean_reference"), pick(F.avg, ~is_ref, col(value)).alias("mean_comparison"),
        pick(F.stddev_samp, is_ref, col(value)).alias("sd_reference"), pick(F.stddev_samp, ~is_ref, col(value)).alias("sd_comparison"),
    ).join(tie_sum(sides, k, value), k)
    n1, n2 = F.col("n_reference").cast("double"), F.col("n_comparison").cast("double")
    n = n1 + n2
    w = F.col("_rr") - n1 * (n1 + 1) / 2
    var = n1 * n2 / 12 * ((n + 1) - F.try_divide(F.col("ties"), n * (n - 1)))
    centred = w - n1 * n2 / 2
    z = F.try_divide(centred - F.signum(centred) * 0.5, F.sqrt(var))
    delta = 2 * (F.col("_rc") - n2 * (n2 + 1) / 2) / (n1 * n2) - 1
    s = s.withColumn("w", w).withColumn("z", F.when(var > 0, z)).withColumn("cliffs_delta", delta)
    return s.drop("_rr", "_rc", "ties").filter("n_reference > 0 and n_comparison > 0")


def rank_sum_counts(df: DataFrame, keys: list[str], group: str, value: str, reference: str | None = None) -> DataFrame:
    """rank_sum of tables whose groups may be as large as the data: ranks follow from counts of values.

    Equal values are counted first, by group; the reference's counts, not its rows, meet every other group.  A
    value's rank is what lies in lower bins of its key (a small window) plus what lies below it in its bin.
    """
    d = df.filter(finite(value) & col(group).isNotNull()).groupBy(*keys, F.col(group).alias("_g"), col(value).cast("double").alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    first = df.filter(col(group).isNotNull()).agg(F.coalesce(F.max(F.when(col(group) == (reference or ""), col(group))), F.min(group)).alias("_ref"))
    d = cut(d.join(F.broadcast(first)), "counts")  # one row
    is_ref = F.col("_g") == F.col("_ref")
    others = d.filter(~is_ref).select(*keys, "_ref", F.col("_g").alias("comparison")).distinct()
    ref = d.filter(is_ref).select(*keys, "_ref", "_v", F.col("_c").alias("a"), F.lit(0).cast("long").alias("b")).join(others, [*keys, "_ref"])
    both = ref.unionByName(d.filter(~is_ref).select(*keys, "_ref", "_v", F.lit(0).cast("long").alias("a"), F.col("_c").alias("b"), F.col("_g").alias("comparison")))
    k = [*keys, "reference", "comparison"]
    v = both.withColumnRenamed("_ref", "reference").groupBy(*k, "_v").agg(F.sum("a").alias("a"), F.sum("b").alias("b")).withColumn("_b", order_bin(F.col("_v"))).withColumn("t", F.col("a") + F.col("b"))
    v = cut(v, "values")
    per = v.groupBy(*k, "_b").agg(F.sum("t").alias("_t"))
    per = per.withColumn("_before", F.sum("_t").over(Window.partitionBy(*k).orderBy("_b")) - F.col("_t")).drop("_t")
    v = v.join(per, [*k, "_b"])
    t = F.col("t").cast("double")
    rank = F.col("_before") + F.sum("t").over(Window.partitionBy(*k, "_b").orderBy("_v")) - t + (t + 1) / 2
    v = v.withColumn("_r", rank)
    s = v.groupBy(*k).agg(F.sum("a").alias("n_reference"), F.sum("b").alias("n_comparison"), F.sum(F.col("a") * F.col("_r")).alias("_rr"), F.sum(F.col("b") * F.col("_r")).alias("_rc"), F.sum(t * t * t - t).alias("ties"))
    n1, n2 = F.col("n_reference").cast("double"), F.col("n_comparison").cast("double")
    n = n1 + n2
    w = F.col("_rr") - n1 * (n1 + 1) / 2
    var = n1 * n2 / 12 * ((n + 1) - F.try_divide(F.col("ties"), n * (n - 1)))
    c = w - n1 * n2 / 2
    s = s.withColumn("w", w).withColumn("z", F.when(var > 0, F.try_divide(c - F.signum(c) * 0.5, F.sqrt(var)))).withColumn("cliffs_delta", 2 * (F.col("_rc") - n2 * (n2 + 1) / 2) / (n1 * n2) - 1)
    return s.drop("_rr", "_rc", "ties").filter("n_reference > 0 and n_comparison > 0")


def kruskal(df: DataFrame, keys: list[str], group: str, value: str) -> DataFrame:
    """keys, n, n_groups, min_group, h and df of a tie-corrected Kruskal-Wallis test."""
    d = df.filter(finite(value) & col(group).isNotNull()).withColumn("_r", avg_rank(keys, value))
    g = d.groupBy(*keys, group).agg(F.sum("_r").alias("_s"), F.count(F.lit(1)).cast("double").alias("_n"))
    t = g.groupBy(*keys).agg(F.sum("_n").alias("n"), F.count(F.lit(1)).alias("n_groups"), F.min("_n").alias("min_group"), F.sum(F.col("_s") * F.col("_s") / F.col("_n")).alias("_q"))
    t = t.join(tie_sum(d, keys, value), keys) if keys else t.join(F.broadcast(tie_sum(d, keys, value)))
    n = F.col("n")
    raw = 12.0 * F.col("_q") / (n * (n + 1)) - 3 * (n + 1)
    h = F.try_divide(raw, 1 - F.try_divide(F.col("ties"), n * n * n - n))
    return t.select(*keys, n.cast("long").alias("n"), "n_groups", F.col("min_group").cast("long").alias("min_group"), F.when(F.col("n_groups") > 1, h).alias("h"), (F.col("n_groups") - 1).alias("df"))


def signed_rank(df: DataFrame, keys: list[str], diff: str) -> DataFrame:
    """keys, n_pairs, v, z and rank_biserial of a Wilcoxon signed-rank test; zero differences are dropped."""
    d = df.filter(finite(diff) & (col(diff) != 0)).withColumn("_a", F.abs(col(diff)))
    d = d.withColumn("_r", avg_rank(keys, "_a"))
    s = d.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_nonzero"), F.sum(F.when(col(diff) > 0, F.col("_r")).otherwise(0.0)).alias("v"), F.sum("_r").alias("_all")).join(tie_sum(d, keys, "_a"), keys)
    n = F.col("n_nonzero").cast("double")
    var = n * (n + 1) * (2 * n + 1) / 24 - F.col("ties") / 48
    c = F.col("v") - n * (n + 1) / 4
    z = F.when(var > 0, (c - F.signum(c) * 0.5) / F.sqrt(var))
    return s.select(*keys, "n_nonzero", "v", z.alias("z"), (2 * F.col("v") / F.col("_all") - 1).alias("rank_biserial"))


def friedman(df: DataFrame, keys: list[str], block: str, condition: str, value: str) -> DataFrame:
    """keys, n_blocks, n_conditions and q: tie-corrected Friedman statistic over complete blocks."""
    d = df.filter(finite(value))
    k = d.groupBy(*keys).agg(F.count_distinct(condition).alias("_k"))
    full = d.groupBy(*keys, block).agg(F.count_distinct(condition).alias("_c"))
    full = full.join(k, keys).filter("_c = _k").select(*keys, block)
    d = d.join(full, [*keys, block]).withColumn("_r", avg_rank([*keys, block], value))
    per = d.groupBy(*keys, condition).agg(F.sum("_r").alias("_s"), F.count(F.lit(1)).alias("_b"))
    q = per.groupBy(*keys).agg(F.sum(F.col("_s") * F.col("_s")).alias("_q"), F.max("_b").alias("n_blocks"), F.count(F.lit(1)).alias("n_conditions"))
    q = q.join(tie_sum(d, [*keys, block], value).groupBy(*keys).agg(F.sum("ties").alias("ties")), keys)
    b, c = F.col("n_blocks").cast("double"), F.col("n_conditions").cast("double")
    stat = F.try_divide(12 * F.col("_q") - 3 * b * b * c * (c + 1) * (c + 1), b * c * (c + 1) - F.try_divide(F.col("ties"), c - 1))
    return q.select(*keys, "n_blocks", "n_conditions", stat.alias("q"))


def spearman(df: DataFrame, keys: list[str], x: str, y: str) -> DataFrame:
    """keys, n, rho and t of Spearman's correlation."""
    d = df.filter(finite(x) & finite(y))
    d = d.withColumn("_x", avg_rank(keys, x)).withColumn("_y", avg_rank(keys, y))
    r = d.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.corr("_x", "_y").alias("rho"))
    rho = F.col("rho")
    return r.withColumn("t", F.when(F.abs(rho) < 1, rho * F.sqrt(F.try_divide(F.col("n") - 2, 1 - rho * rho))))


def compare_groups(freq: DataFrame, groups: DataFrame, value: str = "pct_of_cd45_pos", keys: list[str] | None = None, sample: str = "sample_id", group: str = "group", reference: str | None = None, min_n: int = 3, family: list[str] | None = None) -> DataFrame:
    """Every group against the reference, for each population: effect sizes, p_value, omnibus p and BH over the family."""
    keys = keys or ["population"]
    d = freq.join(groups.select(sample, group), sample)
    t = rank_sum(against_reference(d, keys, group, value, reference), keys, value).filter((F.col("n_reference") >= min_n) & (F.col("n_comparison") >= min_n))
    o = kruskal(d, keys, group, value).filter((F.col("n_groups") > 2) & (F.col("min_group") >= min_n)).select(*keys, "h", "df")
    t = t.join(o, keys, "left").withColumn("p_value", p_normal(F.col("z"))).withColumn("p_omnibus_kruskal", p_chi2(F.col("h"), F.col("df"))).drop("h", "df")
    t = t.withColumn("fold_change", F.when(F.col("median_reference") > 0, F.col("median_comparison") / F.col("median_reference"))).withColumn("cliffs_delta", F.bround("cliffs_delta", 3))
    t = bh_adjust(t, "p_value", family)
    return t.withColumn("test", F.lit("Wilcoxon rank-sum")).withColumn("significant_raw", F.col("p_value") < 0.05).withColumn("significant_BH", F.col("p_adj_BH") < 0.05).drop("w", "z").orderBy("p_value")


def abundance_measure(freq: DataFrame, prefer: str | None = None) -> str:
    """cells_per_ul where any value is finite, else the share of the parent."""
    if prefer:
        return prefer
    if "cells_per_ul" in freq.columns and freq.filter(finite("cells_per_ul")).limit(1).count():
        return "cells_per_ul"
    return "pct_of_cd45_pos"


def compare_paired(freq: DataFrame, pairs: DataFrame, value: str = "pct_of_cd45_pos", sample: str = "sample_id", reference: str | None = None, min_pairs: int = 5) -> DataFrame:
    """Conditions against the reference within pairs; pairs: (sample, pair, condition).  Replicates are averaged first."""
    d = freq.filter(finite(value)).join(pairs.select(sample, "pair", "condition"), sample)
    d = d.groupBy("population", "pair", "condition").agg(F.avg(value).alias("_v"))
    first = d.agg(F.coalesce(F.max(F.when(F.col("condition") == (reference or ""), F.col("condition"))), F.min("condition")).alias("_ref"))
    d = d.join(F.broadcast(first))  # one row
    ref = d.filter(F.col("condition") == F.col("_ref")).select("population", "pair", F.col("_v").alias("_a"))
    cmp_ = d.filter(F.col("condition") != F.col("_ref")).select("population", "pair", F.col("_ref").alias("reference_condition"), F.col("condition").alias("comparison_condition"), F.col("_v").alias("_b"))
    k = ["population", "reference_condition", "comparison_condition"]
    both = cmp_.join(ref, ["population", "pair"])
    all_pairs = cmp_.select("population", "pair", "comparison_condition").unionByName(ref.select("population", "pair").join(cmp_.select("population", "comparison_condition").distinct(), "population")).distinct()
    seen = all_pairs.groupBy("population", "comparison_condition").agg(F.count(F.lit(1)).alias("_pairs"))
    med = lambda c: F.percentile(c, F.lit(0.5))
    s = both.groupBy(*k).agg(F.count(F.lit(1)).alias("n_pairs"), med(F.col("_a")).alias("median_reference"), med(F.col("_b")).alias("median_comparison"), med(F.col("_b") - F.col("_a")).alias("median_paired_difference")).filter(F.col("n_pairs") >= min_pairs)
    t = s.join(signed_rank(both.withColumn("_d", F.col("_a") - F.col("_b")), k, "_d"), k, "left").join(seen, ["population", "comparison_condition"])
    t = t.withColumn("n_incomplete_pairs_dropped", F.col("_pairs") - F.col("n_pairs")).withColumn("rank_biserial", -F.col("rank_biserial")).withColumn("p_value", p_normal(F.col("z")))
    f = friedman(d, ["population"], "pair", "condition", "_v").filter("n_conditions > 2 and n_blocks > 1").select("population", p_chi2(F.col("q"), F.col("n_conditions") - 1).alias("p_omnibus_friedman"))
    t = t.join(f, "population", "left")
    return bh_adjust(t, "p_value").drop("_pairs", "v", "z", "n_nonzero").withColumn("significant_BH", F.col("p_adj_BH") < 0.05)


def spearman_p(df: DataFrame) -> DataFrame:
    return df.withColumn("p_value", F.when(F.abs("rho") >= 1, F.lit(0.0)).otherwise(p_t(F.col("t"), F.col("n") - 2)))
