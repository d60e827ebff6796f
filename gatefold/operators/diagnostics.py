"""Diagnostics that never change a result: threshold drift, batch mixing, guarded batch correction, differential state."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gatefold.functions.numeric import col, finite
from gatefold.functions.ordering import places
from gatefold.functions.quantiles import quantiles
from gatefold.functions.storage import cut
from gatefold.functions.tails import p_chi2, p_normal
from gatefold.operators.compositional import cramers_v, cramers_verdict
from gatefold.operators.neighbours import nearest
from gatefold.operators.ranks import against_reference, bh_adjust, kruskal, rank_sum, rank_sum_counts
from gatefold.operators.transforms import align_quantiles


def threshold_drift(thr: DataFrame, groups: DataFrame, spec: dict | None = None, sample: str = "sample_id", group: str = "group", min_n: int = 3) -> DataFrame:
    """Per marker: do thresholds differ by cohort, and how far apart are they in units of the usual spread within one."""
    d = thr.filter(finite("threshold")).join(groups.select(sample, group), sample).filter(col(group).isNotNull())
    per = d.groupBy("marker", group).agg(F.percentile("threshold", F.lit(0.5)).alias("med"), F.stddev_samp("threshold").alias("sd"), F.count(F.lit(1)).alias("n"))
    agg = per.groupBy("marker").agg((F.max("med") - F.min("med")).alias("gap"), F.percentile("sd", F.lit(0.5)).alias("within"), F.sum("n").alias("n_samples"), F.count(F.lit(1)).alias("n_groups"), F.min("n").alias("_least"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(group).alias("g"), "med"))), lambda s: F.format_string("%s=%.3f", s["g"], s["med"])), "; ").alias("medians_by_group"))
    agg = agg.filter((F.col("n_groups") >= 2) & (F.col("_least") >= min_n))
    k = kruskal(d, ["marker"], group, "threshold").select("marker", "h", "df")
    src = d.groupBy("marker", F.coalesce("source", F.lit("unknown")).alias("_s")).agg(F.count(F.lit(1)).alias("_c")) if "source" in d.columns else None
    out = agg.join(k, "marker")
    if src is not None:  # the most frequent source, the first by name among equals
        top = src.groupBy("marker").agg(F.min_by("_s", F.struct(-F.col("_c"), "_s")).alias("dominant_source"))
        out = out.join(top, "marker", "left")
    ratio = F.bround(F.col("gap") / F.greatest("within", F.lit(1e-9)), 2)
    out = bh_adjust(out.withColumn("p_value", p_chi2(F.col("h"), F.col("df"))), "p_value").withColumn("gap_over_sd", ratio)
    flag = F.when((F.col("p_adj_BH") < 0.05) & (F.col("gap_over_sd") >= 1), "FLAGGED").when(F.col("p_value") < 0.05, "watch").otherwise("")
    out = out.withColumn("drift_flag", flag).withColumn("median_gap_between_groups", F.bround("gap", 4)).withColumn("typical_within_group_sd", F.bround("within", 4)).withColumn("test", F.lit("Kruskal-Wallis"))
    if spec:
        uses: dict[str, list[str]] = {}
        for p, s in spec.items():
            for m in dict.fromkeys([*(x for x in s if x != "any_of"), *(s.get("any_of") or {})]):
                uses.setdefault(m, []).append(p)
        table = thr.sparkSession.createDataFrame([(m, "; ".join(sorted(p))) for m, p in uses.items()], "marker string, populations_using_this_marker string")
        out = out.join(F.broadcast(table), "marker", "left")  # from the configuration
    return out.drop("gap", "within", "_least", "h", "df").orderBy("p_value")


def differential_state(summary: DataFrame, groups: DataFrame, measures: tuple[str, ...] = ("median_asinh", "pct_positive"), sample: str = "sample_id", group: str = "group", reference: str | None = None, min_cells: int = 20, min_n: int = 3) -> DataFrame:
    """Population x marker x measure against the reference; differences, not ratios; BH within each measure."""
    keys = ["population", "marker", "measure"]
    long = summary.filter(F.col("n_cells") >= min_cells).select(sample, "population", "marker", "n_cells", F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), col(m).cast("double").alias("value")) for m in measures])).alias("r")).select(sample, "population", "marker", "n_cells", "r.*")
    d = long.join(groups.select(sample, group), sample)
    t = rank_sum(against_reference(d, keys, group, "value", reference), keys, "value").filter((F.col("n_reference") >= min_n) & (F.col("n_comparison") >= min_n))
    cells = d.groupBy(*keys, F.col(group).alias("_g")).agg(F.sum("n_cells").alias("cells"))
    ref = cells.select(*keys, F.col("_g").alias("reference"), F.col("cells").alias("cells_reference"))
    cmp_ = cells.select(*keys, F.col("_g").alias("comparison"), F.col("cells").alias("cells_comparison"))
    t = t.join(ref, [*keys, "reference"], "left").join(cmp_, [*keys, "comparison"], "left")
    o = kruskal(d, keys, group, "value").filter((F.col("n_groups") > 2) & (F.col("min_group") >= min_n)).select(*keys, p_chi2(F.col("h"), F.col("df")).alias("p_omnibus_kruskal"))
    t = t.join(o, keys, "left").withColumn("p_value", p_normal(F.col("z"))).withColumn("delta_median", F.col("median_comparison") - F.col("median_reference"))
    return bh_adjust(t, "p_value", ["measure"]).withColumn("significant_BH", F.col("p_adj_BH") < 0.05).drop("w", "z")


def subcluster_shifts(cells: DataFrame, markers: list[str], group: str, reference: str, population: str = "population_label", sub: str = "subcluster", min_cells: int = 20) -> DataFrame:
    """Effect sizes of markers and occupancy by (population, subcluster, study).  No p-value: cells aren't replicates.

    Cliff's delta uses the exact ranks of all cells, from counts of their values.
    """
    d = cells.filter(col(group).isNotNull() & col(population).isNotNull() & col(sub).isNotNull()).select(F.col(population).alias("population"), F.col(sub).alias("subcluster"), F.col(group).alias("_g"), *markers)
    size = d.groupBy("population", "subcluster", "_g").agg(F.count(F.lit(1)).alias("n"))
    occ = size.withColumn("occ", 100.0 * F.col("n") / F.sum("n").over(Window.partitionBy("population", "_g")))
    long = d.select("population", "subcluster", "_g", F.explode(F.array(*[F.struct(F.lit(m).alias("marker"), col(m).alias("x")) for m in markers])).alias("r")).select("population", "subcluster", "_g", "r.*")
    keys = ["population", "subcluster", "marker"]
    t = rank_sum_counts(long, keys, "_g", "x", reference).filter((F.col("n_reference") >= min_cells) & (F.col("n_comparison") >= min_cells))
    med = quantiles(long, [*keys, "_g"], "x", [0.5])
    of = lambda side: med.select(*keys, F.col("_g").alias(side), F.col("q")[0].alias(f"median_{side}"))
    t = t.join(of("reference"), [*keys, "reference"]).join(of("comparison"), [*keys, "comparison"])
    side = lambda name: occ.select("population", "subcluster", F.col("_g").alias(name), F.col("occ").alias(f"occupancy_pct_{name}"))
    t = t.join(side("reference"), ["population", "subcluster", "reference"]).join(side("comparison"), ["population", "subcluster", "comparison"])
    return t.select(
        *keys, F.col("comparison").alias("study"), "n_reference", F.col("n_comparison").alias("n_study"), F.bround("occupancy_pct_reference", 3).alias("occupancy_pct_reference"), F.bround("occupancy_pct_comparison", 3).alias("occupancy_pct_study"),
        F.bround(F.col("occupancy_pct_comparison") - F.col("occupancy_pct_reference"), 3).alias("occupancy_pct_delta"), F.bround("median_reference", 4).alias("median_reference"), F.bround("median_comparison", 4).alias("median_study"),
        F.bround(F.col("median_comparison") - F.col("median_reference"), 4).alias("median_delta"), F.bround("cliffs_delta", 4).alias("cliffs_delta"),
    )


def neighbours(points: DataFrame, key: str, coords: str, k: int) -> DataFrame:
    """key, neighbour, place: the k nearest other points of every point; coords is an array column."""
    return nearest(points, key, coords, k).drop("d2")


def lisi(edges: DataFrame, labels: DataFrame, key: str, label: str) -> DataFrame:
    """key, lisi: inverse Simpson index of the labels among each point's neighbours."""
    n = edges.join(labels.select(F.col(key).alias("neighbour"), F.col(label).alias("_l")), "neighbour").groupBy(key, "_l").agg(F.count(F.lit(1)).cast("double").alias("_c"))
    s = n.groupBy(key).agg(F.sum("_c").alias("_n"), F.sum(F.col("_c") * F.col("_c")).alias("_q"))
    return s.select(key, (F.col("_n") * F.col("_n") / F.col("_q")).alias("lisi"))


def batch_mixing(points: DataFrame, key: str, coords: str, batch: str, group: str | None = None, k: int = 30, n_perm: int = 20, min_cells: int = 100, seed: int = 42) -> tuple[DataFrame, DataFrame | None] | None:
    """Observed median LISI against permuted labels, and the confounding of batch with group, over all points.

    The neighbour graph is built once and written; every permutation only reassigns labels to it: the point at a place in
    the order of keys gets the label at that place in the order of hashes.
    """
    pts = points.filter(col(batch).isNotNull())
    edges = cut(neighbours(pts, key, coords, k), "edges")
    ids = edges.select(key).distinct()
    lab = cut(pts.join(ids, key).select(key, F.col(batch).alias("_b")), "labels")
    if lab.count() < min_cells:
        return None
    perms = lab.withColumn("perm", F.explode(F.sequence(F.lit(1), F.lit(n_perm)))).withColumn("_h", F.md5(F.concat_ws("|", F.lit(str(seed)), "perm", F.col(key).cast("string")).cast("binary")))
    a = places(perms, ["perm"], ["_h", key], "r").select("perm", "_b", "r")
    b = places(lab.select(key), [], [key], "r")
    shuffled = a.join(b, "r").select("perm", F.col(key).alias("neighbour"), "_b").unionByName(lab.select(F.lit(0).alias("perm"), F.col(key).alias("neighbour"), "_b"))
    c = edges.join(shuffled, "neighbour").groupBy("perm", key, "_b").agg(F.count(F.lit(1)).cast("double").alias("_c"))
    s = c.groupBy("perm", key).agg((F.sum("_c") * F.sum("_c") / F.sum(F.col("_c") * F.col("_c"))).alias("lisi"))
    med = s.groupBy("perm").agg(F.percentile("lisi", F.lit(0.5)).alias("m"))
    obs = F.max(F.when(F.col("perm") == 0, F.col("m")))
    r = med.agg(obs.alias("obs"), F.percentile(F.when(F.col("perm") > 0, F.col("m")), F.lit(0.5)).alias("null_median"), F.collect_list(F.when(F.col("perm") > 0, F.col("m"))).alias("_all"))
    p = (F.size(F.filter("_all", lambda x: x <= F.col("obs"))) + 1) / F.lit(float(n_perm + 1))
    n = lab.agg(F.count(F.lit(1)).alias("n_cells_scored"), F.count_distinct("_b").alias("n_batches"))
    verdict = F.when(F.col("p_empirical") > 0.05, "no detectable batch structure").when(F.col("obs") / F.col("null_median") > 0.9, "small batch structure").otherwise("SUBSTANTIAL batch structure")
    out = r.withColumn("p_empirical", F.round(p, 4)).join(F.broadcast(n)).select(F.lit(batch).alias("batch_column"), "n_cells_scored", F.lit(k).alias("k"), "n_batches", F.bround("obs", 3).alias("ilisi_observed_median"), F.bround("null_median", 3).alias("ilisi_null_median"), F.bround((F.col("obs") - 1) / F.greatest(F.col("null_median") - 1, F.lit(1e-9)), 3).alias("mixing_fraction"), F.lit(n_perm).alias("n_permutations"), "p_empirical", verdict.alias("verdict"))
    conf = None
    if group:
        v = cramers_v(pts, batch, group)
        conf = v.select(F.lit(batch).alias("batch_column"), F.lit(group).alias("group_column"), F.col("n_a").alias("n_batches"), F.col("n_b").alias("n_groups"), F.bround("v", 3).alias("cramers_v"), cramers_verdict("v").alias("verdict"))
    return out, conf


def correct_batch(df: DataFrame, batch: str, group: str, markers: list[str], max_v: float = 0.6, force: bool = False) -> tuple[DataFrame, str]:
    """df with markers aligned between batches, unless batch and group are too alike to tell apart."""
    v = cramers_v(df, batch, group).first()
    value = None if v is None else v["v"]
    if value is None:
        return df, "not corrected: one batch or one group"
    if value > max_v and not force:
        return df, f"not corrected: Cramer's V {value:.3f} over {max_v:g}"
    for m in markers:
        df = align_quantiles(df, m, batch, m)
    return df, f"corrected: Cramer's V {value:.3f}" + (" (forced)" if value > max_v else "")
