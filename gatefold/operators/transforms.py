"""Intensity transforms as column expressions, and the parameters they need.

A transform is a value, not a closure over data: it emits columns, so scans, filters and aggregates
around it stay in one generated stage.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gatefold.functions.numeric import asinh_scaled, col, finite, sinh_scaled
from gatefold.functions.quantiles import order_statistics, quantiles
from gatefold.functions.storage import cut


# ---------------------------------------------------------------- logicle
@dataclass(frozen=True)
class Logicle:
    """Parameters of the biexponential display transform (Parks, Roederer and Moore 2006)."""

    w: float = 0.5
    t: float = 262144.0
    m: float = 4.5
    a: float = 0.0

    def coefficients(self) -> tuple[float, float, float, float, float]:
        """a, b, c, d, f of S(y) = a exp(by) - c exp(-dy) - f on y in [0, 1]."""
        w, x2 = self.w / (self.m + self.a), self.a / (self.m + self.a)
        x1 = x2 + w
        x0 = x1 + w
        b = (self.m + self.a) * math.log(10)
        d = b
        if w > 0:  # 2 (ln d - ln b) + w (d + b) = 0, by bisection
            lo, hi = 1e-12, b
            for _ in range(200):
                d = (lo + hi) / 2
                if 2 * (math.log(d) - math.log(b)) + w * (d + b) > 0:
                    hi = d
                else:
                    lo = d
        ca = math.exp(x0 * (b + d))
        mf = math.exp(b * x1) - ca / math.exp(d * x1)
        a = self.t / (math.exp(b) - mf - ca / math.exp(d))
        return a, b, ca * a, d, mf * a

    def inverse_array(self, y: np.ndarray) -> np.ndarray:
        """Intensities at scale positions y * m (decades)."""
        a, b, c, d, f = self.coefficients()
        z = np.asarray(y, float) / self.m
        x1 = (self.a + self.w) / (self.m + self.a)
        neg = z < x1
        r = np.where(neg, 2 * x1 - z, z)
        v = a * np.exp(b * r) - c * np.exp(-d * r) - f
        return np.where(neg, -v, v)

    def forward_array(self, x: np.ndarray) -> np.ndarray:
        """Scale positions of intensities, by vectorised bisection."""
        x = np.asarray(x, float)
        lo, hi = np.full(x.shape, -2.0 * self.m), np.full(x.shape, 2.0 * self.m)
        for _ in range(70):
            mid = (lo + hi) / 2
            low = self.inverse_array(mid) < x
            lo, hi = np.where(low, mid, lo), np.where(low, hi, mid)
        return (lo + hi) / 2


@dataclass(frozen=True)
class Transform:
    """method: arcsinh (one cofactor), logicle (parameters by marker) or none."""

    method: str = "arcsinh"
    cofactor: float = 150.0
    logicle: dict[str, Logicle] = field(default_factory=dict)
    knots: int = 4001

    def __post_init__(self) -> None:
        if self.method not in ("arcsinh", "logicle", "none"):
            raise ValueError(f"unknown transform {self.method}")

    def forward(self, c: Column | str, marker: str | None = None) -> Column:
        if self.method == "none":
            return col(c)
        if self.method == "arcsinh":
            return asinh_scaled(c, self.cofactor)
        p = self.logicle.get(marker or "", Logicle())
        y = np.linspace(-p.m, 1.5 * p.m, self.knots)
        return piecewise(col(c), p.inverse_array(y).tolist(), y.tolist())

    def inverse(self, c: Column | str, marker: str | None = None) -> Column:
        if self.method == "none":
            return col(c)
        if self.method == "arcsinh":
            return sinh_scaled(c, self.cofactor)
        p = self.logicle.get(marker or "", Logicle())
        a, b, cc, d, f = p.coefficients()
        x1 = (p.a + p.w) / (p.m + p.a)
        z = col(c) / p.m
        r = F.when(z < x1, 2 * x1 - z).otherwise(z)
        v = a * F.exp(b * r) - cc * F.exp(-d * r) - f
        return F.when(z < x1, -v).otherwise(v)

    def label(self) -> str:
        return {"arcsinh": f"arcsinh(x/{self.cofactor:g})", "logicle": "logicle", "none": "linear"}[self.method]


def piecewise(x: Column, xs: list[float], ys: list[float]) -> Column:
    """Linear interpolation through sorted knots, clamped at the ends; knots of equal x keep the first.

    Knots are an array literal; array_position by halving isn't built in, so the segment is found
    by a fold over the bits of its index: log2(knots) element reads a row.
    """
    keep = [i for i in range(len(xs)) if i == 0 or xs[i] > xs[i - 1]]
    xs, ys = [xs[i] for i in keep], [ys[i] for i in keep]
    if len(xs) < 2:
        return F.lit(ys[0]) if ys else x
    kx, ky = F.array(*map(F.lit, xs)), F.array(*map(F.lit, ys))
    return interpolate(x, kx, ky, len(xs))


def interpolate(x: Column, kx: Column, ky: Column, n: int | None = None) -> Column:
    """Piecewise-linear value of x on knot array columns of n > 1 strictly ascending knots."""
    size = F.lit(n) if n else F.size(kx)
    steps = [1 << b for b in range((n or 4096).bit_length() - 1, -1, -1)]
    halving = F.array(*map(F.lit, steps))
    at = F.aggregate(halving, F.lit(0), lambda p, s: F.when((p + s < size - 1) & (F.get(kx, p + s) <= x), p + s).otherwise(p))
    pair = F.transform(F.array(at), lambda i: F.struct(F.get(kx, i).alias("x0"), F.get(kx, i + 1).alias("x1"), F.get(ky, i).alias("y0"), F.get(ky, i + 1).alias("y1")))[0]
    inside = pair["y0"] + (x - pair["x0"]) * (pair["y1"] - pair["y0"]) / (pair["x1"] - pair["x0"])
    return F.when(x.isNull(), None).when(x <= F.get(kx, F.lit(0)), F.get(ky, F.lit(0))).when(x >= F.get(kx, size - 1), F.get(ky, size - 1)).otherwise(inside)


def logicle_parameters(df: DataFrame, keys: list[str], value: str, m: float = 4.5, a: float = 0.0, neg_q: float = 0.05) -> DataFrame:
    """keys, w, t, m, a: automatic logicle parameters of each group from its maximum and its negative tail."""
    x = col(value)
    got = df.filter(finite(x)).groupBy(*keys).agg(F.max(x).alias("top"))
    got = got.join(quantiles(df.filter(x < 0), keys, x, [neg_q]).select(*keys, F.col("q")[0].alias("r")), keys, "left")
    t = F.when(F.col("top") > 0, F.col("top")).otherwise(262144.0)
    w = F.when(F.col("r") < 0, F.greatest(F.lit(0.0), F.least((m - F.log10(t / F.abs("r"))) / 2, F.lit(m / 2)))).otherwise(0.0)
    return got.select(*keys, w.alias("w"), t.alias("t"), F.lit(m).alias("m"), F.lit(a).alias("a"))


# ---------------------------------------------------------------- cofactor
def cofactor_quartiles(df: DataFrame, keys: list[str], value: str, low: float = 0.05, high: float = 0.60) -> DataFrame:
    """keys, n and the order statistics around the quartiles of the background: values strictly between two quantiles.

    asinh(./c) is monotone, so the interquartile range at any cofactor follows from these four numbers:
    they are selected once by Spark, and a bisection needs no further pass over the data.
    """
    x = col(value)
    limits = cut(quantiles(df, keys, x, [low, high]).select(*keys, F.col("q").alias("_q")), "background")
    bg = df.filter(finite(x)).join(limits, keys).filter((x > F.col("_q")[0]) & (x < F.col("_q")[1])).select(*keys, x.alias("_v"))
    probe = lambda n, p, up: (F.ceil if up else F.floor)((n - 1) * p)
    s = order_statistics(bg, keys, "_v", lambda n: F.array_distinct(F.array(*[probe(n, p, up) for p in (0.25, 0.75) for up in (False, True)])))
    pick = lambda p, up: F.col("at")[probe(F.col("n"), p, up)]
    return s.select(*keys, "n", pick(0.25, False).alias("q25_lo"), pick(0.25, True).alias("q25_hi"), pick(0.75, False).alias("q75_lo"), pick(0.75, True).alias("q75_hi"))


def solve_cofactor(n: int, q25: tuple[float, float], q75: tuple[float, float], target: float = 0.5, lo: float = 1.0, hi: float = 5000.0, steps: int = 40) -> float | None:
    """The cofactor at which the background's asinh interquartile range is target, by geometric bisection."""
    if n < 100:
        return None
    w25, w75 = (n - 1) * 0.25 % 1, (n - 1) * 0.75 % 1
    at = lambda q, w, c: (1 - w) * math.asinh(q[0] / c) + w * math.asinh(q[1] / c)
    for _ in range(steps):
        mid = math.sqrt(lo * hi)
        if at(q75, w75, mid) - at(q25, w25, mid) > target:
            lo = mid
        else:
            hi = mid
    return math.sqrt(lo * hi)


def derive_cofactors(df: DataFrame, sample: str, marker: str, value: str, fallback: float = 150.0) -> dict[str, float]:
    """Cofactor by sample: the median over its markers.  Collects four numbers a (sample, marker)."""
    by: dict[str, list[float]] = {}
    for r in cofactor_quartiles(df, [sample, marker], value).collect():
        c = solve_cofactor(r["n"], (r["q25_lo"], r["q25_hi"]), (r["q75_lo"], r["q75_hi"]))
        by.setdefault(r[sample], [])
        if c is not None:
            by[r[sample]].append(c)
    return {s: float(np.median(v)) if v else fallback for s, v in by.items()}


def spaced(names: list, most: int) -> list:
    """At most `most` of the names, evenly spaced in their order."""
    return names if len(names) <= most else [names[i] for i in np.rint(np.linspace(0, len(names) - 1, most)).astype(int)]


def pooled_logicle(df: DataFrame, order: list[str], sample: str = "sample_id", marker: str = "marker", value: str = "value", max_samples: int = 8, m: float = 4.5, a: float = 0.0) -> DataFrame:
    """marker, w, t, m, a: logicle parameters of a panel, from all events of at most max_samples of its samples, evenly spaced in the given order."""
    use = spaced(list(order), max_samples)
    return logicle_parameters(df.filter(F.col(sample).isin(use)), [marker], value, m, a)


def pool_cofactor(by_sample: dict[str, float], max_samples: int = 8, warn_ratio: float = 2.0, order: list[str] | None = None) -> tuple[float, bool]:
    """One cofactor for a panel from at most max_samples samples, evenly spaced in the given order (by default that of their names), and whether they disagree."""
    names = spaced([s for s in order if s in by_sample] if order else sorted(by_sample), max_samples)
    v = [by_sample[s] for s in names]
    return float(np.median(v)), max(v) / min(v) > warn_ratio


# ---------------------------------------------------------------- compensation, scaling, alignment
def compensate(df: DataFrame, channels: list[str], spill: list[list[float]]) -> DataFrame:
    """Channels times the inverse of the spillover matrix; returned as given if it isn't a usable square matrix."""
    return compensate_by(df.withColumn("_spill", F.lit("")), "_spill", {"": (channels, spill)}).drop("_spill")


def compensate_by(df: DataFrame, key: str, matrices: dict[str, tuple[list[str], list[list[float]]]]) -> DataFrame:
    """df with each row's channels compensated by the matrix that its key names; rows of other keys stay as they are."""
    out = {}
    for k, (channels, spill) in matrices.items():
        m = np.array(spill, float)
        have = [c for c in channels if c in df.columns]
        if len(have) < 2 or m.ndim != 2 or m.shape != (len(channels), len(channels)) or not np.isfinite(m).all():
            continue
        j = [channels.index(c) for c in have]
        sub = m[np.ix_(j, j)]
        if abs(np.linalg.det(sub)) < 1e-12:
            continue
        inv = np.linalg.inv(sub)
        for i, c in enumerate(have):
            total = sum((col(x) * float(inv[n, i]) for n, x in enumerate(have) if inv[n, i] != 0), F.lit(0.0))
            out[c] = F.when(F.col(key) == k, total).otherwise(out.get(c, col(c)))
    return df.withColumns(out) if out else df


def scale_parameters(df: DataFrame, features: list[str], method: str = "robust") -> list[tuple[str, float, float]]:
    """(feature, centre, width) from two small aggregates: median and MAD (sd if the MAD is 0), mean and sd, or 0 and 1; constant features go."""
    if method not in ("robust", "zscore", "none"):
        raise ValueError(f"unknown scaling {method}")
    clean = [F.when(finite(c), col(c)) for c in features]
    one = df.agg(*[F.percentile(x, F.lit(0.5)).alias(f"m{i}") for i, x in enumerate(clean)], *[F.avg(x).alias(f"a{i}") for i, x in enumerate(clean)], *[F.stddev_samp(x).alias(f"s{i}") for i, x in enumerate(clean)]).first()
    live = [i for i in range(len(features)) if one[f"s{i}"] and one[f"s{i}"] > 0]
    mad = df.agg(*[F.percentile(F.abs(clean[i] - one[f"m{i}"]), F.lit(0.5)).alias(f"d{i}") for i in live]).first() if live and method == "robust" else None
    at = {"robust": lambda i: (one[f"m{i}"], 1.4826 * mad[f"d{i}"] or one[f"s{i}"]), "zscore": lambda i: (one[f"a{i}"], one[f"s{i}"]), "none": lambda i: (0.0, 1.0)}[method]
    return [(features[i], *map(float, at(i))) for i in live]


def scale_features(df: DataFrame, features: list[str], method: str = "robust", suffix: str = "_z", parameters: list[tuple[str, float, float]] | None = None) -> DataFrame:
    """df with (x - centre) / width for every feature of the parameters, by default its own; non-finite scaled values are 0."""
    out = {}
    for f, centre, width in parameters if parameters is not None else scale_parameters(df, features, method):
        z = (col(f) - centre) / width
        out[f + suffix] = F.when(finite(z), z).otherwise(0.0)
    return df.withColumns(out) if out else df


def align_quantiles(df: DataFrame, value: str, batch: str, out: str, grid: int = 101, min_n: int = 10) -> DataFrame:
    """df with `out`: value mapped, batch by batch, from the batch's quantile grid onto the pooled one.

    One pass makes the grids (an array a batch); rows meet their batch's grid by a join on batch.  It is meant for the
    bounded cell table: percentile holds a batch's distinct values.
    """
    x = col(value)
    probs = F.array(*[F.lit(i / (grid - 1)) for i in range(grid)])
    ok = df.filter(finite(x) & col(batch).isNotNull())
    ref = ok.agg(F.percentile(x, probs).alias("_ref"), F.count(F.lit(1)).alias("_all"))
    per = ok.groupBy(F.col(batch).alias("_b")).agg(F.percentile(x, probs).alias("_own"), F.count(F.lit(1)).alias("_n"))
    grids = per.join(F.broadcast(ref)).filter((F.col("_n") >= min_n) & (F.col("_all") >= min_n))  # ref is one row
    kept = F.filter(F.arrays_zip("_own", "_ref", F.sequence(F.lit(0), F.lit(grid - 1)).alias("i")), lambda z: (z["i"] == 0) | (z["_own"] > F.get(F.col("_own"), z["i"] - 1)))
    grids = grids.withColumn("_kept", kept).filter(F.size("_kept") > 1).select("_b", F.transform("_kept", lambda z: z["_own"]).alias("_kx"), F.transform("_kept", lambda z: z["_ref"]).alias("_ky"))
    both = df.join(grids, df[batch] == grids["_b"], "left")
    mapped = F.when(finite(x) & F.col("_kx").isNotNull(), interpolate(x, F.col("_kx"), F.col("_ky"))).otherwise(x)
    return both.withColumn(out, mapped).drop("_b", "_kx", "_ky")


def select_features(columns: list[str], prefer: list[str] | None = None, exclude: list[str] | None = None, lineage_only: bool = True) -> list[str]:
    """Feature columns: no scatter, time, event or height/width channels, not excluded; the preferred ones if two or more are there."""
    import re

    drop = re.compile(r"^(fsc|ssc|time|event)|[-_](h|w)$", re.I)
    have = [c for c in columns if not drop.search(c) and c not in set(exclude or ())]
    liked = [c for c in (prefer or []) if c in have]
    return liked if lineage_only and len(liked) >= 2 else have
