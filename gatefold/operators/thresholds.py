"""Thresholds: where each cut comes from, and how it compares with the cuts of its peers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatefold.functions.numeric import col, finite
from gatefold.functions.quantiles import quantiles
from gatefold.operators.valley import Valley, density_valley


def resolve(values: DataFrame, keys: list[str], value: str, config: DataFrame | None = None, control: DataFrame | None = None, control_q: float = 0.995, fallback_q: float = 0.90, settings: Valley = Valley(), min_control: int = 100, written: bool = False) -> DataFrame:
    """keys, threshold, source and needs_review.

    Priority: config (keys, cfg_value), the density valley unless it lies below the control's quantile,
    the control's quantile (value, and any of the keys; over min_control values), the group's own fallback quantile.
    A control with a column ctrl (and all keys) brings its quantiles.
    """
    x = col(value)
    t = density_valley(values, keys, value, settings, (fallback_q,), written).select(*keys, "cut", F.col("q0").alias("fallback"))
    if config is not None:
        t = t.join(config.select(*keys, "cfg_value"), keys, "left")
    else:
        t = t.withColumn("cfg_value", F.lit(None).cast("double"))
    if control is not None and "ctrl" in control.columns:
        t = t.join(control.select(*keys, "ctrl"), keys, "left")
    elif control is not None:
        own_keys = [k for k in keys if k in control.columns]
        c = quantiles(control, own_keys, x, [control_q]).filter(F.col("n") > min_control).select(*own_keys, F.col("q")[0].alias("ctrl"))
        # without keys of its own the control is one row for all groups
        t = t.join(c, own_keys, "left") if own_keys else t.join(F.broadcast(c), how="left")
    else:
        t = t.withColumn("ctrl", F.lit(None).cast("double"))
    return t.select(*keys, *decide())


def control_quantiles(long: DataFrame, qc: DataFrame, sample: str = "sample_id", panel: str = "panel", q: float = 0.995, min_control: int = 100) -> DataFrame:
    """sample, marker, ctrl: the quantile of each panel's control, for all other samples of the panel.

    long: (sample, marker, value) of single cells; qc: (sample, panel, qc_status).  The control of a panel is its first sample, in
    the order of names, that was declared or taken for one; a sample that failed is none.
    """
    first = qc.filter("qc_status = 'control'").groupBy(panel).agg(F.min(sample).alias("_control"))
    own = long.join(first.select(F.col("_control").alias(sample), panel), sample)
    c = quantiles(own, [panel, "marker"], "value", [q]).filter(F.col("n") > min_control).select(panel, "marker", F.col("q")[0].alias("ctrl"))
    return qc.select(sample, panel).join(first, panel).filter(F.col(sample) != F.col("_control")).join(c, panel).select(sample, "marker", "ctrl")


def decide() -> list:
    """threshold, source, needs_review from cfg_value, cut, ctrl and fallback."""
    cfg, cut, ctrl = F.col("cfg_value"), F.col("cut"), F.col("ctrl")
    has = lambda c: finite(c)
    rejected = has(cut) & has(ctrl) & (cut < ctrl)
    source = F.when(has(cfg), "config").when(rejected, "control_q995_valley_rejected").when(has(cut), "valley").when(has(ctrl), "control_q995").otherwise("quantile_fallback")
    value = F.when(has(cfg), cfg).when(rejected, ctrl).when(has(cut), cut).when(has(ctrl), ctrl).otherwise(F.col("fallback"))
    return [value.alias("threshold"), source.alias("source"), (source == "quantile_fallback").alias("needs_review")]


def peer_check(thr: DataFrame, by: list[str], sample: str = "sample_id", value: str = "threshold", z_limit: float = 3.5, min_finite: int = 4, min_peers: int = 3, floor: float = 0.25) -> DataFrame:
    """thr with peer_median, robust_z and scale_outlier: each sample against the others of its panel and marker.

    thr has one row a sample and marker, so a group is as large as a cohort; peers are all others.
    """
    ok = thr.filter(finite(value))
    a, b = ok.alias("a"), ok.alias("b")
    on = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in by] + [F.col(f"a.{sample}") != F.col(f"b.{sample}")]
    pairs = a.join(b, on).select(*[F.col(f"a.{c}").alias(c) for c in [*by, sample]], F.col(f"a.{value}").alias("own"), F.col(f"b.{value}").alias("peer"))
    med = pairs.groupBy(*by, sample, "own").agg(F.percentile("peer", F.lit(0.5)).alias("peer_median"), F.count(F.lit(1)).alias("n_peers"))
    dev = pairs.join(med.drop("own"), [*by, sample]).groupBy(*by, sample).agg(F.percentile(F.abs(F.col("peer") - F.col("peer_median")), F.lit(0.5)).alias("mad"))
    z = F.abs(F.col("own") - F.col("peer_median")) / F.greatest(1.4826 * F.col("mad"), F.lit(floor))
    enough = (F.col("n_peers") >= min_peers) & (F.col("n_peers") + 1 >= min_finite)
    got = med.join(dev, [*by, sample]).select(*by, sample, F.when(enough, F.col("peer_median")).alias("peer_median"), F.when(enough, z).alias("robust_z"))
    return thr.join(got, [*by, sample], "left").withColumn("scale_outlier", F.coalesce(F.col("robust_z") > z_limit, F.lit(False)))


def scale_qc(checked: DataFrame, by: list[str], value: str = "threshold") -> DataFrame:
    """Per panel and marker with an outlier: n, median, min, max, outliers and fallbacks."""
    x = col(value)
    agg = checked.groupBy(*by).agg(F.count(x).alias("n"), F.percentile(x, F.lit(0.5)).alias("median"), F.min(x).alias("min"), F.max(x).alias("max"), F.sum(F.col("scale_outlier").cast("long")).alias("n_outlier"), F.sum((F.col("source") == "quantile_fallback").cast("long")).alias("n_fallback"))
    return agg.filter("n_outlier > 0")
