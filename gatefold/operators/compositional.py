"""Compositional transforms, concordance of raw and log-ratio tests, confounding and covariate adjustment."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gatefold.functions.numeric import col, finite
from gatefold.functions.tails import f_sf, p_chi2
from gatefold.operators.ranks import avg_rank, bh_adjust, kruskal, spearman, spearman_p


def clr(freq: DataFrame, value: str = "pct_of_cd45_pos", sample: str = "sample_id", populations: list[str] | None = None, delta_frac: float = 0.65) -> DataFrame:
    """Rows of samples with two parts or more and clr: the centred log ratio.

    Zeros become delta, delta_frac of the least positive value of the table, and the positive parts of
    their sample shrink in proportion.
    """
    x = col(value)
    d = freq.filter(finite(x))
    if populations:
        d = d.filter(F.col("population").isin(populations))
    least = d.agg((delta_frac * F.min(F.when(x > 0, x))).alias("_delta"))
    d = d.join(F.broadcast(least))  # one row
    by = Window.partitionBy(sample)
    d = d.withColumns({"_zeros": F.sum((x <= 0).cast("long")).over(by), "_tot": F.sum(x).over(by), "_parts": F.count(F.lit(1)).over(by), "_some": F.max(x).over(by)})
    shrunk = x * (1 - F.col("_zeros") * F.col("_delta") / F.greatest("_tot", F.lit(2.220446049250313e-16)))
    y = F.when(F.col("_zeros") == 0, x).when(x <= 0, F.col("_delta")).when(shrunk <= 0, F.col("_delta")).otherwise(shrunk)
    d = d.filter("_parts >= 2 and _some > 0").withColumn("_l", F.log(y))
    return d.withColumn("clr", F.col("_l") - F.avg("_l").over(by)).drop("_zeros", "_tot", "_parts", "_some", "_delta", "_l")


def concordance(raw: DataFrame, log_ratio: DataFrame, alpha: float = 0.05, p: str = "p_value") -> DataFrame:
    """population, comparison: what both analyses say, and one of four verdicts."""
    k = ["population", "comparison"]
    a = raw.select(*k, F.col(p).alias("p_raw"), "median_reference", "median_comparison", F.col("cliffs_delta").alias("cliffs_delta_raw"))
    b = log_ratio.select(*k, F.col(p).alias("p_clr"), F.col("cliffs_delta").alias("cliffs_delta_clr"))
    sig = lambda c: F.coalesce(F.col(c) < alpha, F.lit(False))
    verdict = (
        F.when(sig("p_raw") & sig("p_clr"), "robust_to_composition").when(sig("p_raw"), "raw_only__possible_composition_artefact")
        .when(sig("p_clr"), "clr_only__was_masked_by_composition").otherwise("not_significant_either")
    )
    return a.join(b, k).withColumn("verdict", verdict).withColumn("p_column", F.lit(p)).withColumn("alpha", F.lit(alpha))


def cramers_v(df: DataFrame, a: str, b: str, keys: list[str] | None = None) -> DataFrame:
    """keys, n, n_a, n_b, chi2 and v, without continuity correction: counts and marginals, no pairs of rows."""
    keys = keys or []
    c = df.filter(col(a).isNotNull() & col(b).isNotNull()).groupBy(*keys, F.col(a).alias("_a"), F.col(b).alias("_b")).agg(F.count(F.lit(1)).cast("double").alias("o"))
    w = lambda *x: Window.partitionBy(*keys, *[F.col(i) for i in x]) if keys or x else Window.partitionBy(F.lit(1))
    c = c.withColumns({"_ra": F.sum("o").over(w("_a")), "_rb": F.sum("o").over(w("_b")), "_n": F.sum("o").over(w())})
    e = F.col("_ra") * F.col("_rb") / F.col("_n")
    # cells that don't occur add their expectation: sum(o^2 / e) - n covers all cells
    s = c.groupBy(*keys).agg(F.max("_n").alias("n"), F.count_distinct("_a").alias("n_a"), F.count_distinct("_b").alias("n_b"), (F.sum(F.col("o") * F.col("o") / e) - F.max("_n")).alias("chi2"))
    least = F.least("n_a", "n_b") - 1
    return s.withColumn("n", F.col("n").cast("long")).withColumn("v", F.when(least > 0, F.sqrt(F.greatest(F.try_divide(F.col("chi2"), F.col("n") * least), F.lit(0.0)))))


def cramers_verdict(v):
    return F.when(~finite(v), "not estimable").when(col(v) >= 0.8, "SEVERE").when(col(v) >= 0.5, "substantial").when(col(v) >= 0.3, "moderate").otherwise("low")


def fisher_simulated(table: np.ndarray, draws: int = 20_000, seed: int = 42) -> float:
    """p of independence in a small table, by permuting one margin: share of draws no likelier than the table."""
    from math import lgamma

    table = np.asarray(table, int)
    table = table[table.sum(1) > 0][:, table.sum(0) > 0]
    if min(table.shape) < 2:
        return 1.0
    rng = np.random.default_rng(seed)
    rows = np.repeat(np.arange(table.shape[0]), table.sum(1))
    cols = np.repeat(np.arange(table.shape[1]), table.sum(0))
    fact = np.array([lgamma(k + 1) for k in range(table.sum() + 1)])
    stat = lambda t: -fact[t].sum()
    own, hits = stat(table), 0
    for _ in range(draws):
        t = np.zeros_like(table)
        np.add.at(t, (rows, rng.permutation(cols)), 1)
        hits += stat(t) <= own + 1e-7
    return float((hits + 1) / (draws + 1))


def confounding(freq: DataFrame, covariates: DataFrame, groups: DataFrame, names: list[str], value: str = "pct_of_cd45_pos", sample: str = "sample_id", group: str = "group", alpha: float = 0.05, min_n: int = 6) -> DataFrame:
    """covariate, population (null: against the cohort), comparison, test, rho, p_value, n, p_adj_BH, confounder_risk.

    A covariate is a HIGH risk only where it differs between cohorts and goes with an outcome.
    covariates: one row a sample; numeric columns are ranked, others are categories.
    """
    kinds = dict(covariates.dtypes)
    base = groups.select(sample, group).join(covariates, sample)
    spark, out, collected = freq.sparkSession, None, []
    for c in names:
        numeric = kinds[c] in ("double", "float", "int", "bigint", "smallint")
        d = base.filter(col(c).isNotNull())
        if numeric:
            k = kruskal(d.withColumn("_x", col(c).cast("double")), [], group, "_x").filter(F.col("n") >= min_n)
            one = k.select(F.lit(c).alias("covariate"), F.lit(None).cast("string").alias("population"), F.lit("cohort").alias("comparison"), F.lit("Kruskal-Wallis").alias("test"), F.lit(None).cast("double").alias("rho"), p_chi2(F.col("h"), F.col("df")).alias("p_value"), "n")
            s = spearman_p(spearman(freq.join(d.select(sample, col(c).cast("double").alias("_x")), sample), ["population"], "_x", value)).filter(F.col("n") >= min_n)
            two = s.select(F.lit(c).alias("covariate"), "population", F.lit("outcome").alias("comparison"), F.lit("Spearman").alias("test"), "rho", "p_value", "n")
        else:
            counts = d.groupBy(group, c).count().collect()  # a table of cohorts by categories
            ga, gb = sorted({r[0] for r in counts}), sorted({r[1] for r in counts})
            t = np.zeros((len(ga), len(gb)), int)
            for r in counts:
                t[ga.index(r[0]), gb.index(r[1])] = r[2]
            collected.append((c, None, "cohort", "Fisher, simulated", None, fisher_simulated(t), int(t.sum())))
            one = None
            k = kruskal(freq.join(d.select(sample, F.col(c).alias("_c")), sample), ["population"], "_c", value).filter(F.col("n") >= min_n)
            two = k.select(F.lit(c).alias("covariate"), "population", F.lit("outcome").alias("comparison"), F.lit("Kruskal-Wallis").alias("test"), F.lit(None).cast("double").alias("rho"), p_chi2(F.col("h"), F.col("df")).alias("p_value"), "n")
        for part in (one, two):
            if part is not None:
                out = part if out is None else out.unionByName(part)
    if collected:
        t = spark.createDataFrame(collected, "covariate string, population string, comparison string, test string, rho double, p_value double, n long")
        out = t if out is None else out.unionByName(t)
    out = bh_adjust(out, "p_value")
    differs = out.filter((F.col("comparison") == "cohort") & (F.col("p_adj_BH") < alpha)).select(F.col("covariate").alias("_c")).distinct()
    out = out.join(F.broadcast(differs), out["covariate"] == differs["_c"], "left")  # at most one row a covariate name
    high = F.col("_c").isNotNull() & (F.col("comparison") == "outcome") & (F.col("p_adj_BH") < alpha)
    return out.withColumn("confounder_risk", F.when(high, "HIGH").when(F.col("comparison") == "outcome", "low")).drop("_c")


ANCOVA = "population string, n long, residual_df long, F_group double, p_group_adjusted double, status string"


def rank_ancova(freq: DataFrame, covariates: DataFrame, groups: DataFrame, names: list[str], value: str = "pct_of_cd45_pos", sample: str = "sample_id", group: str = "group", min_resid_df: int = 5, min_n: int = 8) -> DataFrame:
    """Partial F of the cohort on ranked outcomes, given covariates: two least-squares fits a population."""
    d = freq.filter(finite(value)).join(groups.select(sample, F.col(group).alias("_g")), sample).join(covariates.select(sample, *names), sample)
    d = d.dropna(subset=["_g", *names]).withColumn("_r", avg_rank(["population"], value))

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        n = len(pdf)
        parts = [np.ones((n, 1))]
        for c in names:
            x = pdf[c]
            parts.append(x.to_numpy(float)[:, None] if pd.api.types.is_numeric_dtype(x) else pd.get_dummies(x, drop_first=True).to_numpy(float))
        reduced = np.hstack(parts)
        full = np.hstack([reduced, pd.get_dummies(pdf["_g"], drop_first=True).to_numpy(float)])
        y = pdf["_r"].to_numpy(float)
        rss, rank = [], []
        for x in (reduced, full):
            b, _, k, _ = np.linalg.lstsq(x, y, rcond=None)
            rss.append(float(((y - x @ b) ** 2).sum()))
            rank.append(int(k))
        df1, df2 = rank[1] - rank[0], n - rank[1]
        row = {"population": pdf["population"].iloc[0], "n": n, "residual_df": df2, "F_group": None, "p_group_adjusted": None, "status": "fitted"}
        if n < min_n:
            row["status"] = "too few samples"
        elif df1 < 1:
            row["status"] = "cohort not estimable beside the covariates"
        elif df2 < min_resid_df:
            row["status"] = "too few residual degrees of freedom"
        elif rss[1] <= 1e-12 * max(rss[0], 1):
            row["status"] = "perfect fit"
        else:
            row["F_group"] = ((rss[0] - rss[1]) / df1) / (rss[1] / df2)
            row["p_group_adjusted"] = f_sf(row["F_group"], df1, df2)
        return pd.DataFrame([row])

    out = d.select("population", "_g", "_r", *names).groupBy("population").applyInPandas(fit, ANCOVA)
    return bh_adjust(out, "p_group_adjusted").withColumn("covariates", F.lit(",".join(names)))
