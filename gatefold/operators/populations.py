"""Declarative populations: specs compiled to Boolean columns, labels, frequencies and marker summaries.

A spec maps population names to requirements: {marker: above | below | intermediate}, and optionally
any_of: {marker: above | below}.  Thresholds are a small table (sample, marker, threshold), pivoted to one
row a sample and joined once; scoring is then a narrow stage over the events.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatefold.functions.numeric import all_of, any_of, col, finite
from gatefold.functions.quantiles import quantiles
from gatefold.operators.valley import INTERMEDIATE, Valley, density_valley, narrow

Spec = dict[str, dict]
ABOVE, BELOW, BETWEEN = "above", "below", "intermediate"
OTHER = "Other CD45+"


def requirements(spec: dict) -> tuple[dict[str, str], dict[str, str]]:
    """Direct requirements and alternatives of a population; unknown directions are an error."""
    direct = {m: d for m, d in spec.items() if m != "any_of"}
    some = dict(spec.get("any_of") or {})
    for m, d in direct.items():
        if d not in (ABOVE, BELOW, BETWEEN):
            raise ValueError(f"{m}: unknown direction {d}")
    for m, d in some.items():
        if d not in (ABOVE, BELOW):
            raise ValueError(f"any_of {m}: {d} isn't above or below")
    return direct, some


def depth(spec: dict) -> int:
    direct, some = requirements(spec)
    return len(direct) + bool(some)


def spec_markers(spec: Spec) -> list[str]:
    """Markers that any population reads, in order of appearance."""
    out: dict[str, None] = {}
    for p in spec.values():
        direct, some = requirements(p)
        out |= dict.fromkeys([*direct, *some])
    return list(out)


def positive_markers(spec: Spec) -> list[tuple[str, str]]:
    """(population, marker) pairs where the spec expects the marker to be up."""
    return [(p, m) for p, s in spec.items() for part in requirements(s) for m, d in part.items() if d in (ABOVE, BETWEEN)]


def thr(m: str) -> str:
    return f"thr_{m}"


def upper(m: str) -> str:
    return f"hi_{m}"


def wide_thresholds(t: DataFrame, markers: Iterable[str], sample: str = "sample_id", value: str = "threshold", name=thr) -> DataFrame:
    """One row a sample with a column a marker; conditional aggregation over the threshold table."""
    pick = lambda m: F.max(F.when((F.col("marker") == m) & finite(value), F.col(value)))
    return t.groupBy(sample).agg(*[pick(m).alias(name(m)) for m in markers])


def intermediate_bounds(events: DataFrame, thresholds: DataFrame, spec: Spec, sample: str = "sample_id", parent: str | None = None, settings: Valley = INTERMEDIATE) -> DataFrame:
    """(sample, marker, threshold): the valley among parent cells above the cut, for markers used as intermediate."""
    need = [m for p in spec.values() for m, d in requirements(p)[0].items() if d == BETWEEN]
    need = [m for m in dict.fromkeys(need) if m in events.columns]
    if not need:
        return thresholds.select(sample, "marker", "threshold").limit(0)
    e = events.filter(parent) if parent else events
    long = e.select(sample, F.explode(F.array(*[F.struct(F.lit(m).alias("marker"), col(m).alias("x")) for m in need])).alias("r")).select(sample, "r.*")
    up = long.join(thresholds.select(sample, "marker", "threshold"), [sample, "marker"]).filter(F.col("x") > F.col("threshold"))
    return density_valley(up, [sample, "marker"], "x", settings).filter(F.col("cut").isNotNull()).select(sample, "marker", F.col("cut").alias("threshold"))


def _test(m: str, d: str, at: dict[str, Column] | None = None, up: dict[str, Column] | None = None) -> Column:
    limit = (at or {}).get(m, col(thr(m)))
    if d == ABOVE:
        return col(m) > limit
    if d == BELOW:
        return col(m) < limit
    return (col(m) > limit) & (col(m) < (up or {}).get(m, col(upper(m))))


def _usable(m: str, d: str, have: set[str], up: dict[str, Column] | None = None) -> Column:
    if m not in have:
        return F.lit(False)
    return col(thr(m)).isNotNull() & ((up or {}).get(m, col(upper(m))).isNotNull() if d == BETWEEN else F.lit(True))


def availability(spec: dict, have: set[str], up: dict[str, Column] | None = None) -> Column:
    direct, some = requirements(spec)
    ok = [_usable(m, d, have, up) for m, d in direct.items()]
    if some:
        ok.append(any_of([_usable(m, d, have, up) for m, d in some.items()]))
    return all_of(ok)


def membership(spec: dict, have: set[str], at: dict[str, Column] | None = None, up: dict[str, Column] | None = None) -> Column:
    """Null where the population can't be scored, else whether the event belongs to it; at, up: thresholds and upper bounds in place of a marker's own."""
    direct, some = requirements(spec)
    if any(m not in have for m in direct) or (some and not any(m in have for m in some)):
        return F.lit(None).cast("boolean")
    parts = [F.coalesce(_test(m, d, at, up), F.lit(False)) for m, d in direct.items()]
    if some:
        parts.append(any_of([F.coalesce(_test(m, d, at, up), F.lit(False)) for m, d in some.items() if m in have]))
    return F.when(availability(spec, have, up), all_of(parts))


def score(events: DataFrame, thresholds: DataFrame, spec: Spec, parent: str, sample: str = "sample_id", bounds: DataFrame | None = None, prefix: str = "is_") -> DataFrame:
    """events with a Boolean column a population and population_label: the most specific one, ties in spec order."""
    have = {m for m in spec_markers(spec) if m in events.columns}
    wide = wide_thresholds(thresholds, sorted(have), sample)
    used = [thr(m) for m in have] + [upper(m) for m in have]
    if bounds is not None:
        wide = wide.join(wide_thresholds(bounds, sorted(have), sample, name=upper), sample, "left")
    else:
        wide = wide.withColumns({upper(m): F.lit(None).cast("double") for m in have})
    out = events.join(wide, sample, "left")
    inside = F.coalesce(col(parent), F.lit(False))
    out = out.withColumns({prefix + p: F.when(membership(s, have).isNotNull(), inside & membership(s, have)) for p, s in spec.items()})
    order = sorted(spec, key=lambda p: -depth(spec[p]))
    label = F.coalesce(*[F.when(F.coalesce(col(prefix + p), F.lit(False)), F.lit(p)) for p in order], F.lit(OTHER))
    return out.withColumn("population_label", F.when(inside, label)).drop(*used)


def unavailable(thresholds: DataFrame, spec: Spec, columns: list[str], sample: str = "sample_id", bounds: DataFrame | None = None) -> DataFrame:
    """sample, population, reason for every population that a sample can't be scored for."""
    markers = spec_markers(spec)
    have = {m for m in markers if m in columns}
    wide = wide_thresholds(thresholds, sorted(have), sample)
    wide = wide.join(wide_thresholds(bounds, sorted(have), sample, name=upper), sample, "left") if bounds is not None else wide.withColumns({upper(m): F.lit(None).cast("double") for m in have})
    rows = []
    for p, s in spec.items():
        direct, some = requirements(s)
        why = [F.when(~_usable(m, d, have), F.lit(f"{m} not in panel" if m not in have else f"no {'upper bound' if d == BETWEEN else 'threshold'} for {m}")) for m, d in direct.items()]
        if some:
            why.append(F.when(~any_of([_usable(m, d, have) for m, d in some.items()]), F.lit("no usable alternative")))
        rows.append(F.struct(F.lit(p).alias("population"), F.coalesce(*why, F.lit(None)).alias("reason")))
    return wide.select(sample, F.explode(F.array(*rows)).alias("r")).select(sample, "r.*").filter("reason is not null")


def frequencies(scored: DataFrame, populations: list[str], parent: str, sample: str = "sample_id", prefix: str = "is_") -> DataFrame:
    """sample, population, count and pct_of_cd45_pos: one conditional aggregation, then a row a population."""
    n = scored.groupBy(sample).agg(F.sum(F.coalesce(col(parent), F.lit(False)).cast("long")).alias("_n"), *[F.sum(col(prefix + p).cast("long")).alias(f"_{i}") for i, p in enumerate(populations)])
    rows = F.array(*[F.struct(F.lit(p).alias("population"), F.col(f"_{i}").alias("count")) for i, p in enumerate(populations)])
    e = n.select(sample, "_n", F.explode(rows).alias("r")).select(sample, "_n", "r.*").filter(F.col("count").isNotNull())
    return e.select(sample, "population", "count", (100.0 * F.col("count") / F.greatest("_n", F.lit(1))).alias("pct_of_cd45_pos"))


def marker_summary(scored: DataFrame, populations: list[str], markers: list[str], thresholds: DataFrame, sample: str = "sample_id", min_cells: int = 10, prefix: str = "is_") -> DataFrame:
    """sample, population, n_cells, marker, median_asinh and pct_positive of populations of at least min_cells.

    Events are unfolded only into the populations they belong to and then into markers; counts and medians
    are aggregates whose rows combine before the shuffle.
    """
    member = F.filter(F.array(*[F.when(F.coalesce(col(prefix + p), F.lit(False)), F.lit(p)) for p in populations]), lambda p: p.isNotNull())
    values = F.array(*[F.struct(F.lit(m).alias("marker"), col(m).alias("x")) for m in markers])
    base = narrow(scored, [sample, member.alias("_in"), values.alias("v")]).filter(F.size("_in") > 0)
    long = base.select(sample, F.explode("_in").alias("population"), "v").select(sample, "population", F.explode("v").alias("r")).select(sample, "population", "r.*")
    t = thresholds.select(sample, "marker", "threshold")
    g = long.join(t, [sample, "marker"], "left").filter(finite("x")).groupBy(sample, "population", "marker")
    out = g.agg(F.count(F.lit(1)).alias("n_cells"), (100.0 * F.avg((F.col("x") > F.col("threshold")).cast("double"))).alias("pct_positive"))
    med = quantiles(long, [sample, "population", "marker"], "x", [0.5]).select(sample, "population", "marker", F.col("q")[0].alias("median_asinh"))
    return out.filter(F.col("n_cells") >= min_cells).join(med, [sample, "population", "marker"]).select(sample, "population", "marker", "n_cells", "median_asinh", "pct_positive")


def block_populations(block: dict, spec: Spec, available: list[str]) -> list[str]:
    """Populations a functional block is about: the named ones, else those with a required marker up, else all but the excluded."""
    if block.get("populations"):
        return [p for p in block["populations"] if p in available]
    if block.get("require"):
        return [p for p in available if p in spec and requirements(spec[p])[0].get(block["require"]) == ABOVE]
    return [p for p in available if p not in set(block.get("exclude") or ())]


def functional(summary: DataFrame, blocks: dict[str, dict], spec: Spec) -> DataFrame:
    """Rows of a marker summary that belong to functional blocks, with the block: no second pass over events."""
    names = list(spec)
    rows = [(b, p, m) for b, s in blocks.items() for p in block_populations(s, spec, names) for m in s["markers"]]
    scope = summary.sparkSession.createDataFrame(rows, "block string, population string, marker string")
    return summary.join(F.broadcast(scope), ["population", "marker"])  # from the configuration


def ratios(freq: DataFrame, pairs: dict[str, tuple[str, str]], sample: str = "sample_id", value: str = "pct_of_cd45_pos") -> DataFrame:
    """sample, ratio, numerator, denominator, their values and value: null where the denominator is 0 or absent."""
    wanted = sorted({p for pair in pairs.values() for p in pair})
    w = freq.groupBy(sample).agg(*[F.max(F.when(F.col("population") == p, col(value))).alias(f"_{i}") for i, p in enumerate(wanted)])
    at = {p: F.col(f"_{i}") for i, p in enumerate(wanted)}
    rows = F.array(*[F.struct(F.lit(r).alias("ratio"), F.lit(n).alias("numerator"), F.lit(d).alias("denominator"), at[n].alias("numerator_pct"), at[d].alias("denominator_pct")) for r, (n, d) in pairs.items()])
    e = w.select(sample, F.explode(rows).alias("r")).select(sample, "r.*").filter("numerator_pct is not null and denominator_pct is not null")
    return e.withColumn("value", F.when(F.col("denominator_pct") > 0, F.col("numerator_pct") / F.col("denominator_pct")))
