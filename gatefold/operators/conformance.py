"""Baselines of a finished run, and the conformance of a later run with one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatefold.functions.numeric import col, finite
from gatefold.operators.gates import qc_pass
from gatefold.operators.populations import requirements


def fingerprint(spec: dict) -> dict[str, str]:
    """One order-free line of text for every population."""
    out = {}
    for p, s in spec.items():
        direct, some = requirements(s)
        line = "; ".join(f"{m}={d}" for m, d in sorted(direct.items()))
        if some:
            line += " | any of: " + "; ".join(f"{m}={d}" for m, d in sorted(some.items()))
        out[p] = line
    return out


def spec_changes(now: dict, was: dict[str, str]) -> list[tuple[str, str, str | None, str | None]]:
    """(population, change, baseline definition, current definition): added, removed and redefined populations."""
    cur = fingerprint(now)
    rows = [(p, "added", None, cur[p]) for p in cur if p not in was]
    rows += [(p, "removed", was[p], None) for p in was if p not in cur]
    return rows + [(p, "redefined", was[p], cur[p]) for p in cur if p in was and was[p] != cur[p]]


def centre_spread(df: DataFrame, keys: list[str], value: str, out: str) -> DataFrame:
    """keys, n, median_<out> and mad_<out> (scaled)."""
    x = col(value)
    m = df.filter(finite(x)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.percentile(x, F.lit(0.5)).alias(f"median_{out}"))
    d = df.filter(finite(x)).join(m, keys).groupBy(*keys).agg((1.4826 * F.percentile(F.abs(x - F.col(f"median_{out}")), F.lit(0.5))).alias(f"mad_{out}"))
    return m.join(d, keys)


def marker_baseline(thr: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Per panel and marker: n, median, MAD and the rate of quantile fallbacks."""
    k = keys or ["panel", "marker"]
    rate = thr.groupBy(*k).agg(F.avg((F.col("source") == "quantile_fallback").cast("double")).alias("fallback_rate"))
    return centre_spread(thr, k, "threshold", "threshold").join(rate, k)


def population_baseline(freq: DataFrame) -> DataFrame:
    return centre_spread(qc_pass(freq), ["population"], "pct_of_cd45_pos", "pct")


def verdict(z, qualify: float = 3.5, fail: float = 6.0):
    return F.when(~finite(z), "not comparable").when(z > fail, "fail").when(z > qualify, "qualify").otherwise("pass")


def marker_conformance(thr: DataFrame, base: DataFrame, keys: list[str] | None = None, scale_changed: bool = False, qualify: float = 3.5, fail: float = 6.0, floor: float = 0.25) -> DataFrame:
    k = keys or ["panel", "marker"]
    cur = thr.groupBy(*k).agg(F.count(F.lit(1)).alias("n_samples"), F.percentile(F.when(finite("threshold"), F.col("threshold")), F.lit(0.5)).alias("median_threshold"), F.avg((F.col("source") == "quantile_fallback").cast("double")).alias("fallback_rate"))
    b = base.select(*k, F.col("n").alias("n_samples_baseline"), F.col("median_threshold").alias("baseline_threshold"), F.col("mad_threshold").alias("baseline_mad"), F.col("fallback_rate").alias("baseline_fallback_rate"))
    m = cur.join(b, k, "left")
    z = F.abs(F.col("median_threshold") - F.col("baseline_threshold")) / F.greatest(F.col("baseline_mad"), F.lit(floor))
    note = F.when(F.col("baseline_threshold").isNull(), "absent from baseline")
    if scale_changed:
        note = note.otherwise("transform differs from baseline")
    else:
        note = note.when(F.col("fallback_rate") > F.col("baseline_fallback_rate") + 0.25, "more fallbacks than in the baseline")
    v = F.lit("not comparable") if scale_changed else verdict(z, qualify, fail)
    return m.withColumn("robust_z", F.bround(z, 2)).withColumn("verdict", v).withColumn("note", note)


def population_conformance(freq: DataFrame, base: DataFrame, redefined: list[str] | None = None, qualify: float = 3.5, fail: float = 6.0, floor: float = 0.5) -> DataFrame:
    cur = qc_pass(freq).groupBy("population").agg(F.count(F.lit(1)).alias("n_samples"), F.percentile(F.when(finite("pct_of_cd45_pos"), F.col("pct_of_cd45_pos")), F.lit(0.5)).alias("median_pct"))
    m = cur.join(base.select("population", F.col("n").alias("n_samples_baseline"), F.col("median_pct").alias("baseline_pct"), F.col("mad_pct").alias("baseline_mad")), "population", "left")
    changed = F.col("population").isin(redefined) if redefined else F.lit(False)
    z = F.when(~changed, F.abs(F.col("median_pct") - F.col("baseline_pct")) / F.greatest(F.col("baseline_mad"), F.lit(floor)))
    note = F.when(changed, "definition changed since the baseline").when(F.col("baseline_pct").isNull(), "absent from baseline")
    return m.withColumn("robust_z", F.bround(z, 2)).withColumn("verdict", verdict(z, qualify, fail)).withColumn("note", note)


class DriftError(RuntimeError):
    """Raised after a run has written everything, if it was asked to fail on drift."""


def fail_on_drift(*tables: DataFrame) -> None:
    n = sum(t.filter("verdict = 'fail'").count() for t in tables)
    if n:
        raise DriftError(f"{n} markers or populations fail conformance")
