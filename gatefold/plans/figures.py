"""Data layers of figures: what a plot would draw, aggregated in Spark.  Nothing is rendered here."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gatefold.functions.numeric import col, finite
from gatefold.functions.quantiles import quantiles
from gatefold.functions.storage import cut


def density_curve(df: DataFrame, keys: list[str], value: str, points: int = 512, bins: int = 2048) -> DataFrame:
    """keys, x, density: a Gaussian kernel curve on the data's range, of Silverman's width.

    The width is 0.9 n**-0.2 times the lesser of the standard deviation and the interquartile range over 1.34, or the
    one of them that isn't 0.  The kernel is summed over a fine histogram, so a group costs bins x points however many events it has.
    """
    x = col(value)
    ok = df.filter(finite(x))
    s = ok.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min(x).alias("lo"), F.max(x).alias("hi"), F.stddev_samp(x).alias("sd")).filter("n > 1 and hi > lo")
    s = s.join(quantiles(ok, keys, x, [0.25, 0.75]).select(*keys, "q"), keys)
    spread = F.least(F.col("sd"), (F.col("q")[1] - F.col("q")[0]) / 1.34)
    s = s.withColumn("h", 0.9 * F.when(spread > 0, spread).otherwise(F.col("sd")) * F.pow(F.col("n").cast("double"), F.lit(-0.2))).drop("q", "sd")
    b = ok.join(s, keys).withColumn("bin", F.least(F.lit(bins - 1), F.floor((x - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins).cast("int")))
    b = b.groupBy(*keys, "n", "lo", "hi", "h", "bin").agg(F.count(F.lit(1)).alias("c")).withColumn("at", F.col("lo") + (F.col("bin") + 0.5) * (F.col("hi") - F.col("lo")) / bins)
    g = b.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(points - 1)))).withColumn("x", F.col("lo") + F.col("i") * (F.col("hi") - F.col("lo")) / (points - 1))
    z = (F.col("x") - F.col("at")) / F.col("h")
    return g.groupBy(*keys, "i", "x").agg((F.sum(F.col("c") * F.exp(-z * z / 2)) / F.max(F.col("n") * F.col("h") * 2.5066282746310002)).alias("density")).drop("i")


def hexbin(df: DataFrame, keys: list[str], x: str, y: str, n: int = 80) -> DataFrame:
    """keys, hx, hy, count: counts on a hexagonal grid of n columns over the data's range of each group."""
    r = df.filter(finite(x) & finite(y)).groupBy(*keys).agg(F.min(x).alias("x0"), F.max(x).alias("x1"), F.min(y).alias("y0"), F.max(y).alias("y1")).filter("x1 > x0 and y1 > y0")
    d = df.filter(finite(x) & finite(y)).join(r, keys)
    u = (col(x) - F.col("x0")) / (F.col("x1") - F.col("x0")) * n
    v = (col(y) - F.col("y0")) / (F.col("y1") - F.col("y0")) * n / 1.7320508075688772
    # two rectangular lattices, shifted by half a cell; the nearer centre owns the point
    a, b = F.round(u), F.round(v)
    c, e = F.floor(u) + 0.5, F.floor(v) + 0.5
    near = (u - a) * (u - a) + 3 * (v - b) * (v - b) <= (u - c) * (u - c) + 3 * (v - e) * (v - e)
    return d.select(*keys, F.when(near, a).otherwise(c).alias("hx"), F.when(near, b).otherwise(e).alias("hy")).groupBy(*keys, "hx", "hy").agg(F.count(F.lit(1)).alias("count"))


def marker_limits(df: DataFrame, markers: list[str]) -> DataFrame:
    """marker, low, high: colour limits at the 1st and 99th percentile."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(m).alias("marker"), col(m).cast("double").alias("v")) for m in markers])).alias("r")).select("r.*")
    return quantiles(long, ["marker"], "v", [0.01, 0.99]).select("marker", F.col("q")[0].alias("low"), F.col("q")[1].alias("high"))


def group_bars(freq: DataFrame, groups: DataFrame, value: str = "pct_of_cd45_pos", sample: str = "sample_id", group: str = "group") -> DataFrame:
    """population, group, n, mean, sd, median."""
    d = freq.filter(finite(value)).join(groups.select(sample, group), sample)
    return d.groupBy("population", group).agg(F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("sd"), F.percentile(value, F.lit(0.5)).alias("median"))


def marker_heatmap(summary: DataFrame, value: str = "median_asinh") -> DataFrame:
    """population, marker, value, z, n_samples: medians over samples, z-scores within a marker (0 where it is flat)."""
    m = summary.groupBy("population", "marker").agg(F.percentile(value, F.lit(0.5)).alias("value"), F.count_distinct("sample_id").alias("n_samples"))
    w = Window.partitionBy("marker")
    sd = F.stddev_samp("value").over(w)
    return m.withColumn("z", F.when(sd < 1e-8, 0.0).otherwise((F.col("value") - F.avg("value").over(w)) / sd))


ALL = "All samples"


def overview(cells: DataFrame, group: str) -> DataFrame:
    """Every cell of a known group twice: under its group and under "All samples"."""
    d = cells.filter(col(group).isNotNull() & (F.trim(col(group).cast("string")) != ""))
    return d.withColumn(group, F.explode(F.array(F.lit(ALL), col(group).cast("string"))))


def overlay_curves(cells: DataFrame, markers: list[str], group: str, population: str = "population_label", min_cells: int = 20, points: int = 256, bins: int = 2048) -> DataFrame:
    """population, marker, group, value, pct: density curves of each group on one grid a panel, their peaks at 100.

    The grid spans all groups of a panel; groups of fewer than min_cells have no curve.
    """
    ok = cells.filter(col(group).isNotNull() & (F.trim(col(group).cast("string")) != "") & col(population).isNotNull())
    values = F.array(*[F.struct(F.lit(m).alias("marker"), col(m).cast("double").alias("v")) for m in markers])
    long = ok.select(col(population).alias("population"), col(group).alias("group"), F.explode(values).alias("r")).select("population", "group", "r.*").filter(finite("v"))
    panel, keys = ["population", "marker"], ["population", "marker", "group"]
    s = long.groupBy(*keys).agg(F.count(F.lit(1)).cast("double").alias("n"), F.min("v").alias("_lo"), F.max("v").alias("_hi"), F.stddev_samp("v").alias("sd"))
    q = quantiles(long, keys, "v", [0.25, 0.75]).select(*keys, "q")
    by = Window.partitionBy(*panel)
    s = s.join(q, keys).withColumn("lo", F.min("_lo").over(by)).withColumn("hi", F.max("_hi").over(by)).filter((F.col("n") >= min_cells) & (F.col("hi") > F.col("lo")))
    spread = F.least(F.col("sd"), (F.col("q")[1] - F.col("q")[0]) / 1.34)
    s = cut(s.withColumn("h", 0.9 * F.when(spread > 0, spread).when(F.col("sd") > 0, F.col("sd")).otherwise(1.0) * F.pow("n", F.lit(-0.2))).select(*keys, "lo", "hi", "h"), "overlay")
    b = long.join(s, keys).groupBy(*keys, "lo", "hi", "h", F.least(F.lit(bins - 1), F.floor((F.col("v") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins).cast("int")).alias("bin")).agg(F.count(F.lit(1)).alias("c"))
    g = b.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(points - 1)))).withColumn("value", F.col("lo") + F.col("i") * (F.col("hi") - F.col("lo")) / (points - 1))
    z = (F.col("value") - (F.col("lo") + (F.col("bin") + 0.5) * (F.col("hi") - F.col("lo")) / bins)) / F.col("h")
    y = g.groupBy(*keys, "i", "value").agg(F.sum(F.col("c") * F.exp(-z * z / 2)).alias("_y"))
    return y.select(*keys, "value", (F.col("_y") / F.max("_y").over(Window.partitionBy(*keys)) * 100).alias("pct"))


def cluster_centroids(cells: DataFrame, cluster: str = "cluster", x: str = "umap_1", y: str = "umap_2") -> DataFrame:
    """cluster, x, y, n: the median position of each cluster, where its number is written."""
    d = cells.filter(col(cluster).isNotNull() & finite(x) & finite(y)).select(F.col(cluster).alias("cluster"), F.col(x).alias("_x"), F.col(y).alias("_y"))
    one = lambda c, out: quantiles(d, ["cluster"], c, [0.5]).select("cluster", "n", F.col("q")[0].alias(out))
    return one("_x", "x").join(one("_y", "y").drop("n"), "cluster").select("cluster", "x", "y", "n")


def counts_qc(counts: DataFrame, groups: DataFrame | None = None, sample: str = "sample_id") -> DataFrame:
    """sample, population, row_label, fill (log10 of at least one cell per uL), row_order and population_order of the tile plot.

    Controls and failed samples are marked, not dropped; populations go by their median, the largest first.
    """
    d = counts
    control = F.coalesce(F.col("is_control"), F.lit(False)) if "is_control" in d.columns else F.lit(False)
    failed = F.coalesce(F.col("qc_status") != "pass", F.lit(False)) if "qc_status" in d.columns else F.lit(False)
    d = d.withColumn("row_label", F.concat(F.col(sample).cast("string"), F.when(control, " [control]").when(failed, " [QC-failed]").otherwise("")))
    order = [sample]
    if groups is not None:
        d = d.join(groups.select(sample, F.col("group").alias("_grp")), sample, "left")
        order = ["_grp", sample]
    rows = d.groupBy(*order).agg(F.first("row_label").alias("_l"))
    rows = rows.withColumn("row_order", F.row_number().over(Window.orderBy(*order))).select(sample, "row_order")  # one row a sample
    pops = d.groupBy("population").agg(F.percentile("cells_per_ul", F.lit(0.5)).alias("_m"))
    pops = pops.withColumn("population_order", F.row_number().over(Window.orderBy(F.desc("_m"), "population"))).drop("_m")  # one row a population
    return d.join(rows, sample).join(pops, "population").select(sample, "population", "row_label", F.log10(F.greatest("cells_per_ul", F.lit(1.0))).alias("fill"), "row_order", "population_order")


def frequency_bars(freq_u: DataFrame) -> DataFrame:
    """sample_id, population, pct_of_cd45_pos, lo, hi, population_order and swamped: is the median uncertainty as wide as the spread between samples."""
    d = freq_u.filter(F.coalesce(F.col("qc_status"), F.lit("pass")) == "pass" if "qc_status" in freq_u.columns else F.lit(True)).filter(finite("pct_of_cd45_pos"))
    d = d.withColumn("u", F.when(finite("u_pct_points"), F.col("u_pct_points")).otherwise(0.0))
    q = F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))
    per = d.groupBy("population").agg(F.percentile("pct_of_cd45_pos", q).alias("_q"), F.percentile("u", F.lit(0.5)).alias("_u"))
    per = per.withColumn("swamped", (F.col("_u") > 0) & (F.col("_u") >= F.col("_q")[2] - F.col("_q")[0])).withColumn("population_order", F.row_number().over(Window.orderBy(F.col("_q")[1], "population"))).drop("_q", "_u")  # one row a population
    return d.join(per, "population").select("sample_id", "population", "pct_of_cd45_pos", F.greatest(F.lit(0.0), F.col("pct_of_cd45_pos") - F.col("u")).alias("lo"), (F.col("pct_of_cd45_pos") + F.col("u")).alias("hi"), "population_order", "swamped")


def uncertainty_budget(budget: DataFrame) -> DataFrame:
    """population, term, u_pct_points (median over samples), population_order by the sum of its terms."""
    m = budget.filter(finite("u_pct_points")).groupBy("population", "term").agg(F.percentile("u_pct_points", F.lit(0.5)).alias("u_pct_points"))
    t = m.groupBy("population").agg(F.sum("u_pct_points").alias("_t"))
    t = t.withColumn("population_order", F.row_number().over(Window.orderBy("_t", "population"))).drop("_t")  # one row a population
    return m.join(t, "population")


def palette(names: list[str], other: str = "^Other") -> dict[str, str]:
    """A colour for every name, evenly around the colour circle in sorted order; catch-all names are grey."""
    import colorsys
    import re

    named = sorted(n for n in set(names) if not re.search(other, n))
    hue = lambda i: "#%02x%02x%02x" % tuple(round(255 * v) for v in colorsys.hls_to_rgb(i / max(1, len(named)), 0.5, 0.6))
    return {n: hue(i) for i, n in enumerate(named)} | {n: "#bfbfbf" for n in set(names) - set(named)}
