"""Density valley: the cut between two modes of a marker, for every group at once.

Events are touched by built-in aggregates alone: for the range of each group (two passes, see
functions/quantiles) and for its histogram, all with partial aggregation.  From then on a group is one row that holds its histogram as an array.  The
search over pairs of peaks runs on those arrays, Arrow-batched in numpy: as nested array functions it
is interpreted and took minutes for five groups with many peaks.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatefold.functions.numeric import col, finite
from gatefold.functions.quantiles import quantiles
from gatefold.functions.storage import cut


@dataclass(frozen=True)
class Valley:
    """Settings of the search; the defaults suit transformed marker intensities."""

    bins: int = 220
    smooth: int = 4
    peak_frac: float = 0.02
    min_gap_frac: float = 0.06
    low_q: float = 0.001
    high_q: float = 0.999
    min_rel_depth: float = 0.30
    min_upper_frac: float = 0.002
    min_n: int = 500


#: Variants for the scatter channel and for upper bounds of intermediate populations.
SCATTER = Valley(bins=240, smooth=5, min_gap_frac=0.10)
INTERMEDIATE = Valley(bins=180, min_gap_frac=0.08)


def setting_grid(base: Valley = Valley()) -> list[Valley]:
    """27 neighbouring settings, to see how far a cut depends on them."""
    return [replace(base, bins=b, smooth=s, min_rel_depth=d) for b in (160, 220, 300) for s in (3, 4, 6) for d in (0.22, 0.30, 0.38)]


def value_ranges(df: DataFrame, keys: list[str], value: str, s: Valley, extra: tuple[float, ...] = ()) -> DataFrame:
    """keys, n and the quantile range lo .. hi of the finite values; q0, q1, ...: extra quantiles of the same pass."""
    r = quantiles(df, keys, value, [s.low_q, s.high_q, *extra])
    # rounding keeps the last bit of an interpolation from moving a value to the next bin
    return r.select(*keys, "n", F.round(F.col("q")[0], 9).alias("lo"), F.round(F.col("q")[1], 9).alias("hi"), *[F.col("q")[2 + i].alias(f"q{i}") for i in range(len(extra))])


def histogram(df: DataFrame, keys: list[str], value: str, s: Valley, extra: tuple[float, ...] = ()) -> DataFrame:
    """keys, n, lo, hi, w and counts: an array of right-closed equal bins (the first one closed on both sides)."""
    x = col(value)
    ranges = cut(value_ranges(df, keys, value, s, extra), "ranges").withColumn("w", (F.col("hi") - F.col("lo")) / s.bins)
    bin_ = F.greatest(F.lit(1), F.least(F.lit(s.bins), F.ceil((x - F.col("lo")) / F.col("w")).cast("int")))
    binned = df.filter(finite(x)).select(*keys, x.alias(value)).join(ranges.filter("n >= " + str(s.min_n) + " and hi > lo"), keys).filter((x >= F.col("lo")) & (x <= F.col("hi")))
    per = binned.groupBy(*keys, bin_.alias("bin")).agg(F.count(F.lit(1)).alias("c")).groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("bin", "c"))).alias("_m"))
    dense = F.transform(F.sequence(F.lit(1), F.lit(s.bins)), lambda i: F.coalesce(F.try_element_at("_m", i), F.lit(0)))
    return ranges.join(per, keys, "left").select(*keys, "n", "lo", "hi", "w", *[f"q{i}" for i in range(len(extra))], F.when(F.col("_m").isNotNull(), dense).alias("counts"))


def smoothed(counts, bins: int, k: int):
    """Centred moving average of 2k + 1 bins; bins near the ends keep their counts."""
    mean = lambda i: F.aggregate(F.slice(counts, i - k + 1, F.lit(2 * k + 1)), F.lit(0).cast("long"), lambda a, c: a + c) / F.lit(float(2 * k + 1))
    return F.transform(counts, lambda c, i: F.when((i >= k) & (i < bins - k), mean(i)).otherwise(c.cast("double")))


def search(counts, s: Valley) -> tuple[int | None, float | None, int]:
    """(bin of the valley, its relative depth, number of peaks) of one histogram, bins counted from 0.

    Every pair of peaks far enough apart is a candidate: its valley is the first lowest bin between them,
    its depth is relative to the lower peak, and enough of the histogram must lie right of the valley.
    """
    counts = np.asarray(counts)
    k, n = max(1, int(s.smooth)), len(counts)
    ys = counts.astype(float)
    run = np.concatenate(([0], np.cumsum(counts)))
    ys[k : n - k] = (run[2 * k + 1 :] - run[: -2 * k - 1]) / (2 * k + 1)
    mid = ys[1:-1]
    peaks = np.flatnonzero((mid >= ys[:-2]) & (mid >= ys[2:]) & (mid > s.peak_frac * ys.max())) + 1
    tail = np.cumsum(ys[::-1])[::-1]
    best: tuple[float, int, float] | None = None
    for i, a in enumerate(peaks[:-1].tolist()):
        rest = peaks[i + 1 :]
        rest = rest[rest - a >= s.min_gap_frac * (n - 1)]
        if not len(rest):
            continue
        seg = ys[a : rest[-1] + 1]
        low = np.minimum.accumulate(seg)
        first = np.maximum.accumulate(np.where(np.append(True, low[1:] < low[:-1]), np.arange(len(seg)), 0))
        v = a + first[rest - a]
        lesser = np.minimum(ys[a], ys[rest])
        rel = (lesser - ys[v]) / lesser
        score = np.where((rel > 0) & (rel >= s.min_rel_depth) & (tail[v] >= s.min_upper_frac * tail[0]), rel + 0.05 * (rest - a) / (n - 1), -1.0)
        j = int(score.argmax())
        if score[j] > (best[0] if best else 0.0):
            best = (float(score[j]), int(v[j]), float(rel[j]))
    return (None, None, len(peaks)) if best is None else (best[1], best[2], len(peaks))


def narrow(df: DataFrame, columns: list) -> DataFrame:
    """The columns alone, written once, so that passes over them don't repeat the joins and expressions behind them."""
    return cut(df.select(*columns), "narrow")


def density_valley(df: DataFrame, keys: list[str], value: str, s: Valley = Valley(), extra: tuple[float, ...] = (), written: bool = False) -> DataFrame:
    """keys, n, cut, rel_depth, n_peaks and reason (why there is no cut), one row a group of df; q0, ...: extra quantiles.

    written: df is a table that is cheap to read three times.
    """
    if not written:
        df = narrow(df.filter(finite(value)), [*keys, col(value).alias(value)])
    h = histogram(df, keys, value, s, extra)

    @F.pandas_udf("bin int, rel double, peaks long")
    def find(counts: pd.Series) -> pd.DataFrame:
        got = [(None, None, None) if c is None else search(c, s) for c in counts]
        return pd.DataFrame(got, columns=["bin", "rel", "peaks"]).astype({"bin": "Int32", "rel": "float64", "peaks": "Int64"})

    h = h.withColumn("_v", find("counts"))
    reason = (
        F.when(F.col("n") < s.min_n, f"fewer than {s.min_n} finite values").when(~(F.col("hi") > F.col("lo")), "degenerate range")
        .when(F.col("_v.peaks") < 2, "unimodal: fewer than two peaks").when(F.col("_v.bin").isNull(), "no peak pair separates enough")
    )
    at = F.col("lo") + (F.col("_v.bin") + 0.5) * F.col("w")
    return h.select(*keys, "n", at.alias("cut"), F.col("_v.rel").alias("rel_depth"), F.col("_v.peaks").alias("n_peaks"), reason.alias("reason"), *[f"q{i}" for i in range(len(extra))])


def valley_numpy(x, s: Valley = Valley()) -> tuple[float | None, float | None]:
    """The same search on one numpy array, for resampling loops inside a task: cut and relative depth."""
    x = np.asarray(x, float)
    x = x[np.isfinite(x)]
    if len(x) < s.min_n:
        return None, None
    lo, hi = np.quantile(x, [s.low_q, s.high_q])
    if hi <= lo:
        return None, None
    x = x[(x >= lo) & (x <= hi)]
    w = (hi - lo) / s.bins
    counts = np.bincount(np.clip(np.ceil((x - lo) / w).astype(int), 1, s.bins) - 1, minlength=s.bins)
    v, rel, _ = search(counts, s)
    return (None, None) if v is None else (float(lo + (v + 0.5) * w), rel)
