"""The gate chain all -> leukocytes -> single cells -> live -> CD45+, its counts and the staining verdict.

Bounds are small per-sample tables.  Each is measured inside the gate before it, on a table of the chain's
channels that is written once; events meet all bounds in one join on the sample and are never moved for a gate.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatefold.functions.numeric import col, finite, log10_floor
from gatefold.functions.quantiles import quantiles
from gatefold.functions.storage import cut
from gatefold.operators.thresholds import resolve
from gatefold.operators.valley import SCATTER, Valley, density_valley, narrow
from gatefold.sources.defaults import VIABILITY

GATES = ("all_events", "leukocytes", "single_cells", "live_cells", "cd45_pos")


def scatter_bounds(df: DataFrame, sample: str, fsc: str, ssc: str, settings: Valley = SCATTER, fallback_q: float = 0.60, fsc_hi_q: float = 0.999, ssc_q: tuple[float, float] = (0.005, 0.995), written: bool = False) -> DataFrame:
    """sample, fsc_lo, fsc_hi, ssc_lo, ssc_hi on log10 scale, and whether fsc_lo is a fallback."""
    columns = [F.col(sample).alias("_s"), log10_floor(fsc).alias("_f"), log10_floor(ssc).alias("_y")]
    e = df.select(*columns) if written else narrow(df, columns)
    v = density_valley(e, ["_s"], "_f", settings, (fallback_q, fsc_hi_q), True)
    x = cut(v.select("_s", F.coalesce("cut", "q0").alias("fsc_lo"), F.col("q1").alias("fsc_hi"), F.col("cut").isNull().alias("fsc_fallback")), "scatter")
    inside = e.join(x, "_s").filter((F.col("_f") > F.col("fsc_lo")) & (F.col("_f") < F.col("fsc_hi"))).select("_s", "_y")
    y = quantiles(inside, ["_s"], "_y", list(ssc_q))
    return x.join(y, "_s", "left").select(F.col("_s").alias(sample), "fsc_lo", "fsc_hi", F.col("q")[0].alias("ssc_lo"), F.col("q")[1].alias("ssc_hi"), "fsc_fallback")


def singlet_bounds(df: DataFrame, sample: str, ratio: Column, k: float = 3.0, written: bool = False) -> DataFrame:
    """sample, median, mad, lo, hi: median -/+ k scaled MADs of the ratio (its sd where the MAD is 0)."""
    columns = [F.col(sample).alias("_s"), ratio.alias("_r")]
    e = (df.select(*columns) if written else narrow(df, columns)).filter(finite("_r"))
    med = cut(quantiles(e, ["_s"], "_r", [0.5]).select("_s", F.col("q")[0].alias("median")), "median")
    away = e.join(med, "_s").select("_s", F.abs(F.col("_r") - F.col("median")).alias("_d"))
    mad = quantiles(away, ["_s"], "_d", [0.5]).select("_s", (1.4826 * F.col("q")[0]).alias("_mad"))
    sd = e.groupBy("_s").agg(F.stddev_samp("_r").alias("_sd"))
    b = med.join(mad, "_s").join(sd, "_s").withColumn("mad", F.when(F.col("_mad") > 0, F.col("_mad")).otherwise(F.col("_sd")))
    return b.select(F.col("_s").alias(sample), "median", "mad", (F.col("median") - k * F.col("mad")).alias("lo"), (F.col("median") + k * F.col("mad")).alias("hi"))


def height_ratio(fsc_h: str, fsc_a: str) -> Column:
    return col(fsc_h) / F.greatest(col(fsc_a), F.lit(1.0))


def viability_marker(markers: list[str], explicit: str | None = None) -> str | None:
    """The explicit marker if it is there, else the first that looks like a viability dye."""
    if explicit in markers:
        return explicit
    return next((m for m in markers if re.search(VIABILITY, m, re.I)), None)


def gate_events(df: DataFrame, sample: str = "sample_id", fsc_a: str = "FSC-A", ssc_a: str = "SSC-A", fsc_h: str | None = "FSC-H", viability: str | None = None, cd45: str | None = "CD45", config: DataFrame | None = None, control: DataFrame | None = None, singlet_k: float = 3.0) -> tuple[DataFrame, DataFrame]:
    """Events with Boolean gate columns, and the thresholds of the viability dye and of CD45.

    df holds scatter channels raw and markers transformed; config: (sample, marker, cfg_value); control:
    (marker, value) of a reference sample.  A channel that is absent passes its gate.
    """
    # what bounds are measured on: the channels of the chain, written once; df itself is read for the result alone
    have = [c for c in dict.fromkeys([fsc_a, ssc_a, fsc_h, viability, cd45]) if c and c in df.columns]
    d = cut(df.select(sample, *[col(c) for c in have]), "channels")
    steps: list[tuple[str, str, DataFrame | None, Column]] = []
    lf, ls = log10_floor(fsc_a), log10_floor(ssc_a)
    s = cut(scatter_bounds(d, sample, fsc_a, ssc_a, written=True).drop("fsc_fallback"), "scatter")
    steps.append(("leukocytes", "", s, (lf > F.col("fsc_lo")) & (lf < F.col("fsc_hi")) & (ls > F.col("ssc_lo")) & (ls < F.col("ssc_hi"))))
    inside = d.join(s, sample).filter(steps[0][3]).drop("fsc_lo", "fsc_hi", "ssc_lo", "ssc_hi")
    r = height_ratio(fsc_h, fsc_a) if fsc_h in have else None
    if r is not None:
        b = cut(singlet_bounds(inside, sample, r, singlet_k, True).select(sample, F.col("lo").alias("_lo"), F.col("hi").alias("_hi")), "singlets")
        steps.append(("single_cells", "leukocytes", b, (r > F.col("_lo")) & (r < F.col("_hi"))))
        inside = inside.join(b, sample).filter(steps[-1][3]).drop("_lo", "_hi")
    else:
        steps.append(("single_cells", "leukocytes", None, F.lit(True)))
    used = None
    for gate, parent, marker, above in (("live_cells", "single_cells", viability, False), ("cd45_pos", "live_cells", cd45, True)):
        if marker not in have:
            steps.append((gate, parent, None, F.lit(True)))
            continue
        pick = lambda t: None if t is None else t.filter(F.col("marker") == marker)  # noqa: B023, E731
        t = cut(resolve(inside.select(sample, col(marker).alias("value")), [sample], "value", pick(config), pick(control), written=True), "thresholds")
        used = t.withColumn("marker", F.lit(marker)) if used is None else used.unionByName(t.withColumn("marker", F.lit(marker)))
        limit = f"_{gate}"
        hit = col(marker) > F.col(limit) if above else col(marker) < F.col(limit)
        b = t.select(sample, F.col("threshold").alias(limit))
        steps.append((gate, parent, b, hit))
        inside = inside.join(b, sample).filter(hit).drop(limit)
    # one row of bounds a sample, joined once
    bounds = None
    for _, _, b, _ in steps:
        if b is not None:
            bounds = b if bounds is None else bounds.join(b, sample, "left")
    out = df.join(bounds, sample).withColumn("all_events", F.lit(True))
    for gate, parent, _, hit in steps:
        out = out.withColumn(gate, F.coalesce(hit, F.lit(False)) & (F.col(parent) if parent else F.lit(True)))
    return out.drop(*[c for c in bounds.columns if c != sample]), used


def gate_counts(gated: DataFrame, sample: str = "sample_id", gates: tuple[str, ...] = GATES) -> DataFrame:
    """sample, gate, count, pct_of_parent and pct_of_all: one aggregation, then a row a gate."""
    n = gated.groupBy(sample).agg(*[F.sum(F.col(g).cast("long")).alias(g) for g in gates])
    rows = F.array(*[F.struct(F.lit(g).alias("gate"), F.col(g).alias("count"), (F.col(gates[i - 1]) if i else F.col(g)).alias("_p"), F.col(gates[0]).alias("_all")) for i, g in enumerate(gates)])
    e = n.select(sample, F.explode(rows).alias("r")).select(sample, "r.*")
    return e.select(sample, "gate", "count", (100.0 * F.col("count") / F.greatest("_p", F.lit(1))).alias("pct_of_parent"), (100.0 * F.col("count") / F.greatest("_all", F.lit(1))).alias("pct_of_all"))


def staining_verdict(df: DataFrame, declared: str = "is_control", source: str = "cd45_source", pct: str = "pct_cd45_of_live", min_pct: float = 5.0, force: bool = False) -> DataFrame:
    """df with verdict, qc_status and included.

    declared: true (control), false (sample) or null (unknown).  A sample without a CD45 population is failed if it
    was declared a sample, else taken for an unstained control; force keeps declared samples.
    """
    d, src = col(declared), col(source)
    poor = (src == "quantile_fallback") | ((src != "skipped") & ~(finite(pct) & (col(pct) >= min_pct)))
    is_sample = F.coalesce(d == F.lit(False), F.lit(False))
    declared_control = F.coalesce(d, F.lit(False))
    status = F.when(declared_control, "control").when(poor & is_sample & F.lit(force), "pass").when(poor & ~is_sample, "control").when(poor, "failed").otherwise("pass")
    verdict = (
        F.when(declared_control, "declared control").when(poor & is_sample & F.lit(force), "poor staining, kept by request").when(poor & ~is_sample, "poor staining, taken for a control")
        .when(poor, "poor staining, failed").when(src == "skipped", "staining not applicable").otherwise("stained")
    )
    return df.withColumn("verdict", verdict).withColumn("qc_status", status).withColumn("included", F.col("qc_status") == "pass")


def qc_pass(df: DataFrame) -> DataFrame:
    """Without controls and failed samples; columns that aren't there filter nothing."""
    out = df
    if "is_control" in df.columns:
        out = out.filter(~F.coalesce(F.col("is_control"), F.lit(False)))
    if "qc_status" in df.columns:
        out = out.filter(F.col("qc_status") == "pass")
    return out
