"""Learned polygon gates: a soft convex gate fitted by gradient descent on bounded samples, sequences of gates, and their transfer between donors."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatefold.functions.numeric import any_of, col
from gatefold.functions.storage import cut, remove
from gatefold.operators.polygons import POLYGON, Level, inside, polygon_rows, rank_markers
from gatefold.operators.sampling import draw_counted, draw_key, largest, mark_first

FIXED, STEEP = 4, 800.0
#: Membership stays this far from 0 and 1, so that one cell far from the gate costs a bounded amount.
CLAMP = 1e-3
LAMBDAS = (0.0, 0.5, 1.0, 2.0, 4.0, 8.0)


def planes(theta: np.ndarray, fixed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Normals, offsets and free angles of a parameter vector (free angles, then offsets)."""
    free = theta[: len(theta) - (len(theta) - len(fixed)) // 2 - len(fixed)]
    w = np.vstack([fixed, np.column_stack([np.cos(free), np.sin(free)])])
    return w, theta[len(free) :], free


def objective(theta: np.ndarray, x: np.ndarray, y: np.ndarray, weight: np.ndarray, fixed: np.ndarray, centre: np.ndarray, steep: float = STEEP, lam: float = 0.0) -> tuple[float, np.ndarray]:
    """Weighted cross-entropy of the product of plane sigmoids, plus lam times the mean distance of planes to the centre; with its gradient."""
    w, b, free = planes(theta, fixed)
    z = np.clip(steep * (x @ w.T + b), -700, 700)
    logs = -np.logaddexp(0, -z)  # log sigmoid
    inner = (1 - 2 * CLAMP) * np.exp(logs.sum(1))
    p = CLAMP + inner
    n = weight.sum()
    loss = -(weight * np.log(np.where(y > 0, p, 1 - p))).sum() / n
    dlp = -(weight * np.where(y > 0, 1 / p, -1 / (1 - p))) * inner / n  # d loss / d log membership
    dz = dlp[:, None] * (1 - np.exp(logs)) * steep
    gb, gw = dz.sum(0), dz.T @ x
    d = w @ centre + b
    loss += lam * np.abs(d).mean()
    s = lam * np.sign(d) / len(b)
    gb = gb + s
    gw = gw + s[:, None] * centre
    k = len(fixed)
    ga = gw[k:, 0] * -np.sin(free) + gw[k:, 1] * np.cos(free)
    return float(loss), np.concatenate([ga, gb])


def lbfgs(f, x: np.ndarray, steps: int = 300, memory: int = 8) -> np.ndarray:
    """Limited-memory quasi-Newton descent with backtracking."""
    fx, g = f(x)
    s_list: list[np.ndarray] = []
    y_list: list[np.ndarray] = []
    for _ in range(steps):
        q, alphas = g.copy(), []
        for s, y in zip(reversed(s_list), reversed(y_list), strict=True):
            a = s @ q / (y @ s)
            alphas.append(a)
            q -= a * y
        if y_list:
            q *= (s_list[-1] @ y_list[-1]) / (y_list[-1] @ y_list[-1])
        for (s, y), a in zip(zip(s_list, y_list, strict=True), reversed(alphas), strict=True):
            q += s * (a - y @ q / (y @ s))
        slope, step = -(g @ q), 1.0 if y_list else min(1.0, 0.1 / max(np.abs(g).max(), 1e-12))
        if slope >= 0:
            q, slope = g, -(g @ g)
        while True:
            new = x - step * q
            fn, gn = f(new)
            if fn <= fx + 1e-4 * step * slope:
                break
            step /= 2
            if step < 1e-12:
                return x
        if (gn - g) @ (new - x) > 1e-12:
            s_list.append(new - x)
            y_list.append(gn - g)
            s_list, y_list = s_list[-memory:], y_list[-memory:]
        done = fx - fn < 1e-9 * max(1, abs(fx))
        x, fx, g = new, fn, gn
        if done:
            return x
    return x


def halfplane_polygon(w: np.ndarray, b: np.ndarray, tol: float = 1e-9) -> np.ndarray:
    """Vertices of {v: w v + b >= 0} in counter-clockwise order; empty if the region is empty or open."""
    pts = []
    for i in range(len(b)):
        for j in range(i + 1, len(b)):
            det = w[i, 0] * w[j, 1] - w[i, 1] * w[j, 0]
            if abs(det) < tol:
                continue
            v = np.array([-b[i] * w[j, 1] + b[j] * w[i, 1], -w[i, 0] * b[j] + w[j, 0] * b[i]]) / det
            if (w @ v + b >= -1e-7).all():
                pts.append(v)
    if len(pts) < 3:
        return np.zeros((0, 2))
    pts = np.unique(np.round(np.array(pts), 9), axis=0)
    if len(pts) < 3:
        return np.zeros((0, 2))
    c = pts.mean(0)
    pts = pts[np.argsort(np.arctan2(pts[:, 1] - c[1], pts[:, 0] - c[0]))]
    # normals of a closed region surround the origin: no gap between neighbouring directions reaches a half turn
    ang = np.sort(np.arctan2(w[:, 1], w[:, 0]))
    return pts if np.diff(np.append(ang, ang[0] + 2 * np.pi)).max() < np.pi - tol else np.zeros((0, 2))


def in_polygon(x: np.ndarray, poly: np.ndarray) -> np.ndarray:
    """Winding number test on arrays, with the edge rule of polygons.inside()."""
    out = np.zeros(len(x), int)
    for (x0, y0), (x1, y1) in zip(poly, np.roll(poly, -1, 0), strict=True):
        side = (x1 - x0) * (x[:, 1] - y0) - (x[:, 0] - x0) * (y1 - y0)
        out += ((x[:, 1] >= y0) & (x[:, 1] < y1) & (side > 0)).astype(int)
        out -= ((x[:, 1] >= y1) & (x[:, 1] < y0) & (side < 0)).astype(int)
    return out != 0


def f1_of(hit: np.ndarray, y: np.ndarray, total: float | None = None) -> tuple[float, float, float]:
    tp = float((hit & (y > 0)).sum())
    p = tp / hit.sum() if hit.any() else 0.0
    r = tp / (total or y.sum()) if (total or y.sum()) else 0.0
    return float(2 * p * r / (p + r) if p + r else 0.0), float(p), float(r)


def learn_gate(x: np.ndarray, y: np.ndarray, n_planes: int = 8, lambdas=LAMBDAS, holdout: float = 0.3, seed: int = 42, total: float | None = None, min_n: int = 20, refine: bool = True) -> dict | None:
    """A polygon on two markers: {polygon, f1, precision, recall, lam}, or None without enough cells of either kind.

    refine: after the lambdas, try half a step to either side of the best.
    """
    y = np.asarray(y, float)
    if y.sum() < min_n or (1 - y).sum() < min_n:
        return None
    lo, hi = np.quantile(x, 0.001, 0), np.quantile(x, 0.999, 0)
    span = np.where(hi > lo, hi - lo, 1.0)
    u = (x - lo) / span
    rng = np.random.default_rng(seed)
    test = np.zeros(len(y), bool)
    for c in (0, 1):
        k = np.flatnonzero(y == c)
        test[rng.permutation(k)[: int(len(k) * holdout)]] = True
    if y[~test].sum() < 10 or y[test].sum() < 5:
        train = test = np.ones(len(y), bool)
    else:
        train = ~test
    t = u[train & (y > 0)]
    centre = t.mean(0)
    _, _, axes = np.linalg.svd(t - centre, full_matrices=False)
    fixed = np.vstack([axes, -axes])
    n_free = n_planes - FIXED
    angle = np.pi / 4 + 2 * np.pi * np.arange(n_free) / max(1, n_free)
    w0 = np.vstack([fixed, np.column_stack([np.cos(angle), np.sin(angle)])])
    start = np.concatenate([angle, 0.25 - w0 @ centre])
    weight = np.where(y[train] > 0, max(1.0, (1 - y[train]).sum() / y[train].sum()), 1.0)
    pad = 0.02 * (u.max(0) - u.min(0))
    box_w = np.array([[1, 0], [-1, 0], [0, 1], [0, -1]], float)
    low, top = u.min(0) - pad, u.max(0) + pad
    box_b = np.array([-low[0], top[0], -low[1], top[1]])
    share = (total or y.sum()) / y.sum() * y[test].sum()

    def fit(lam: float) -> tuple[float, float, float, float, np.ndarray]:
        theta = start
        for steep in (20.0, 80.0, STEEP):  # a steep gate has no gradient away from its edges
            theta = lbfgs(lambda p: objective(p, u[train], y[train], weight, fixed, centre, steep, lam), theta, 120)  # noqa: B023
        w, b, _ = planes(theta, fixed)
        poly = halfplane_polygon(np.vstack([w, box_w]), np.concatenate([b, box_b]))
        return (*(f1_of(in_polygon(u[test], poly), y[test], share) if len(poly) else (0.0, 0.0, 0.0)), lam, poly)

    runs = [fit(v) for v in lambdas]
    best = max(runs, key=lambda r: r[0])
    for v in beside(best[3]) if refine else ():
        r = fit(v)
        best = r if r[0] > best[0] else best
    if not len(best[4]):
        return None
    return {"polygon": best[4] * span + lo, "f1": best[0], "precision": best[1], "recall": best[2], "lam": best[3]}


def beside(lam: float) -> list[float]:
    """The lambdas of the second search, around the best of the first."""
    step = max(np.diff(LAMBDAS)) / 2
    return sorted({max(0.0, lam - step), lam + step})


#: Partitions over which fits are dealt by target and lambda.
FIT_TASKS = 64
FIT = "target string, lam double, f1 double, precision double, recall double, px array<double>, py array<double>"


def _fits(sample: DataFrame, seed: int) -> list:
    """One task a target and lambda of sample (target, lam, total, x, y, hit): gates, the better first."""

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["h", "x", "y"])
        lam, total = float(pdf["lam"].iloc[0]), pdf["total"].iloc[0]
        hit = pdf["hit"].to_numpy(float)
        g = learn_gate(pdf[["x", "y"]].to_numpy(), hit, lambdas=(lam,), seed=seed, total=None if np.isnan(total) else total * hit.sum(), refine=False)
        if g is None:
            return pd.DataFrame(columns=["target", "lam", "f1", "precision", "recall", "px", "py"])
        return pd.DataFrame({"target": [pdf["target"].iloc[0]], "lam": [lam], **{k: [g[k]] for k in ("f1", "precision", "recall")}, "px": [g["polygon"][:, 0].tolist()], "py": [g["polygon"][:, 1].tolist()]})

    # a fit is the work here, not its rows: a stated number of partitions isn't coalesced, so that fits don't share a task for their few bytes
    dealt = sample.repartition(FIT_TASKS, "target", "lam")
    # a few dozen rows: targets by lambdas
    return sorted(dealt.groupBy("target", "lam").applyInPandas(fit, FIT).collect(), key=lambda r: (r["target"], -r["f1"], r["lam"]))


def explain_targets(df: DataFrame, label: str, targets: list[str], markers: list[str], key: str, max_depth: int = 4, min_gain: float = 0.02, max_cells: int = 20_000, seed: int = 42) -> dict[str, tuple[list[Level], list[dict]]]:
    """For each target (a value of label) a sequence of polygon gates that isolates its cells, all targets a depth at a time.

    A round counts every open target's rows inside its gates so far, ranks its markers by exact quantiles of all of them, draws at most max_cells
    of them (in hash order, the documented bound of a fit), and fits every target and lambda in a task of its own.  A deeper round reads only
    what lies inside the gates, which is written once.  A target closes when a gate gains less than min_gain in F1 (or none could gain
    as much, as F1 ends at 1) or no two markers are left.
    """
    found: dict[str, tuple[list[Level], list[dict]]] = {t: ([], []) for t in targets}
    best, left = dict.fromkeys(targets, 0.0), {t: list(markers) for t in targets}
    # one row a cell and open target, with the columns that any target may rank
    base = cut(df.select(F.col(key).alias("_key"), col(label).cast("string").alias("_label"), *[col(m).cast("double").alias(m) for m in markers]), "cells")
    n_target: dict[str, int] = {}
    open_ = [t for t in targets if len(markers) >= 2]
    written, rows = base, base.withColumn("target", F.lit(open_[0]) if len(open_) == 1 else F.explode(F.array(*[F.lit(t) for t in open_]).cast("array<string>")))
    rows = rows.select("target", "_key", *markers, F.coalesce(F.col("_label") == F.col("target"), F.lit(False)).alias("hit"))
    for depth in range(1, max_depth + 1):
        if not open_:
            break
        if depth > 1:
            last = {t: found[t][0][-1] for t in open_}
            older, written = written, cut(rows.filter(any_of([(F.col("target") == t) & inside(v.marker_x, v.marker_y, v.vertices) for t, v in last.items()])), "inside")
            rows = written
            remove(older)
        size = {r["target"]: (r["n"], r["hits"]) for r in rows.groupBy("target").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("hit").cast("long")).alias("hits")).collect()}  # one row a target
        n_target = n_target or {t: hits for t, (_, hits) in size.items()}
        scores: dict[str, list[str]] = {t: [] for t in open_}
        for r in rank_markers(rows, markers, "hit", by=["target"]).orderBy("target", F.desc("score"), "marker").collect():  # targets by markers
            if r["marker"] in left[r["target"]]:
                scores[r["target"]].append(r["marker"])
        open_ = [t for t in open_ if len(scores[t]) >= 2]
        if not open_:
            break
        axis = lambda i: F.coalesce(*[F.when(F.col("target") == t, F.col(scores[t][i])) for t in open_])  # noqa: B023, E731
        # targets lost in earlier gates still count as missed
        share = F.coalesce(*[F.when(F.col("target") == t, F.lit(n_target[t] / max(1, size[t][1]) if found[t][0] else None).cast("double")) for t in open_])
        narrow = rows.filter(F.col("target").isin(open_)).select("target", "_key", axis(0).alias("x"), axis(1).alias("y"), "hit", share.alias("total"))
        drawn = draw_counted(narrow, "target", {t: size[t][0] for t in open_}, draw_key(seed, "_key"), "_key", max_cells, "h")
        drawn = cut(drawn.select("target", "x", "y", "hit", "total", "h"), "drawn")
        first = _fits(drawn.withColumn("lam", F.explode(F.array(*[F.lit(v) for v in LAMBDAS]))), seed)
        top = {r["target"]: r for r in reversed(first)}
        if top:
            near = F.coalesce(*[F.when(F.col("target") == t, F.array(*[F.lit(v) for v in beside(r["lam"])])) for t, r in top.items()])
            for r in reversed(_fits(drawn.withColumn("lam", F.explode(near)), seed)):
                if r["f1"] > top[r["target"]]["f1"]:
                    top[r["target"]] = r
        going = []
        for t in open_:
            g = top.get(t)
            if g is None or g["f1"] < best[t] + min_gain:
                continue
            best[t] = g["f1"]
            levels, report = found[t]
            levels.append(Level(scores[t][0], scores[t][1], tuple(zip(g["px"], g["py"], strict=True))))
            report.append({"depth": depth, "marker_x": scores[t][0], "marker_y": scores[t][1], "f1": g["f1"], "precision": g["precision"], "recall": g["recall"], "lam": g["lam"]})
            left[t] = [m for m in left[t] if m not in scores[t][:2]]
            going.append(t)
        open_ = [t for t in going if len(left[t]) >= 2 and best[t] + min_gain <= 1]
    remove(written)
    return found


def explain(df: DataFrame, target: str, markers: list[str], key: str, **options) -> tuple[list[Level], list[dict]]:
    """The strategy of one target, a Boolean column."""
    named = df.withColumn("_named", F.when(F.coalesce(col(target), F.lit(False)), F.lit("target")).otherwise("other"))
    return explain_targets(named, "_named", ["target"], markers, key, **options)["target"]


def transferability(df: DataFrame, target: str, markers: tuple[str, str], donor: str, key: str, min_donors: int = 3, max_donors: int = 8, max_cells: int = 20_000, seed: int = 42) -> DataFrame | None:
    """Leave-one-donor-out: a gate learned without a donor, scored on all rows of that donor; one task a fit.

    max_cells bounds the training rows of a fold, by label: of a rare target at least 20, if there are.
    """
    donors = [r[0] for r in df.filter(col(donor).isNotNull()).select(donor).distinct().orderBy(draw_key(seed, donor)).limit(max_donors).collect()]
    if len(donors) < min_donors:
        return None
    d = df.filter(col(donor).isin(donors)).select(F.col(donor).cast("string").alias("d"), col(markers[0]).cast("double").alias("x"), col(markers[1]).cast("double").alias("y"), F.coalesce(col(target), F.lit(False)).alias("t"), draw_key(seed, key).alias("h"))
    names = [str(x) for x in donors]
    count = {(r["d"], r["t"]): r["count"] for r in d.groupBy("d", "t").count().collect()}  # two rows a donor
    take = {}
    for f in names:
        pos, neg = (sum(count.get((x, t), 0) for x in names if x != f) for t in (True, False))
        if pos + neg > max_cells:
            pos = min(pos, max(20, round(max_cells * pos / (pos + neg))))
            neg = min(neg, max_cells - pos)
        take[f] = (neg, pos)
    # the bound of a fold's training rows, by label; no label of a donor can give more than it
    pool = mark_first(d, ["d", "t"], F.col("h"), "x", F.lit(max_cells), "_in").filter("_in").drop("_in")
    folds = pool.withColumn("fold", F.explode(F.array(*[F.lit(x) for x in names]))).filter("fold <> d")

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        f = pdf["fold"].iloc[0]
        pdf = pdf.sort_values(["h", "d", "x", "y"])
        train = pd.concat([pdf[pdf["t"] == bool(t)].head(take[f][t]) for t in (0, 1)])
        g = None
        if train["t"].sum() >= 20 and count.get((f, True), 0) >= 10:
            g = learn_gate(train[["x", "y"]].to_numpy(), train["t"].to_numpy(float), seed=seed)
        return pd.DataFrame({"fold": [f], "n_train": [len(train)], "px": [g["polygon"][:, 0].tolist() if g else None], "py": [g["polygon"][:, 1].tolist() if g else None]})

    fits = {r["fold"]: r for r in folds.groupBy("fold").applyInPandas(fit, "fold string, n_train long, px array<double>, py array<double>").collect()}
    # the held-out donor is scored in full
    gates = {f: list(zip(r["px"], r["py"], strict=True)) for f, r in fits.items() if r["px"]}
    hit, known = F.lit(False), F.col("d").isin(list(gates))
    for f, polygon in gates.items():
        hit = F.when(F.col("d") == f, inside("x", "y", polygon)).otherwise(hit)
    n = d.groupBy("d").agg(F.count(F.lit(1)).alias("n_test"), F.sum(F.col("t").cast("long")).alias("n_target_test"), F.sum((hit & F.col("t")).cast("long")).alias("tp"), F.sum(hit.cast("long")).alias("n_in"))
    p, r = (F.coalesce(F.try_divide(F.col("tp"), of), F.lit(0.0)) for of in (F.col("n_in"), F.col("n_target_test")))
    n_train = F.coalesce(*[F.when(F.col("d") == f, F.lit(fits[f]["n_train"] if f in fits else 0)) for f in names]).cast("long")
    score = {"f1": F.coalesce(F.try_divide(2 * p * r, p + r), F.lit(0.0)), "precision": p, "recall": r}
    return n.select(F.col("d").alias("donor"), n_train.alias("n_train"), "n_test", "n_target_test", *[F.when(known, v).alias(k) for k, v in score.items()])


def explain_labels(df: DataFrame, label: str, markers: list[str], key: str, max_labels: int = 6, min_cells: int = 200, seed: int = 42) -> dict[str, tuple[list[Level], list[dict]]]:
    """Gate strategies of the largest labels."""
    names = [r[label] for r in largest(df.filter(col(label).isNotNull()), label, max_labels, min_cells).collect()]
    return explain_targets(df, label, [str(n) for n in names], markers, key, seed=seed)


PROPOSALS = "target string, depth int, marker_x string, marker_y string, f1 double, precision double, recall double, lam double"


def _tables(spark, found: dict[str, tuple[list[Level], list[dict]]]) -> tuple[DataFrame, DataFrame]:
    summary = [(name, *(r[k] for k in ("depth", "marker_x", "marker_y", "f1", "precision", "recall", "lam"))) for name, (_, report) in found.items() for r in report]
    polygons = [row for name, (levels, _) in found.items() for row in polygon_rows(name, levels)]
    return spark.createDataFrame(summary, PROPOSALS), spark.createDataFrame(polygons, POLYGON)


def explain_unmatched(cells: DataFrame, features: list[str], per_cluster: DataFrame, key: str, cluster: str = "cluster", max_clusters: int = 4, min_cells: int = 200, purity_max: float = 80.0, seed: int = 42, **options) -> tuple[DataFrame, DataFrame, int] | None:
    """Gate proposals for the largest clusters that no population describes: a summary, polygons, and how many clusters were left out.

    per_cluster: the first table of clusters.agreement.  None if every cluster is described.
    """
    open_ = per_cluster.filter((F.col("n_cells") >= min_cells) & (F.col("interpretation").startswith("UNDESCRIBED") | (F.col("purity_pct") <= purity_max)))
    n = open_.count()
    if not n or len([f for f in features if f in cells.columns]) < 2:
        return None
    names = [r["cluster"] for r in open_.orderBy(F.desc("n_cells"), "cluster").limit(max_clusters).collect()]
    have = [f for f in features if f in cells.columns]
    found = explain_targets(cells, cluster, [str(k) for k in names], have, key, seed=seed, **options)
    summary, polygons = _tables(cells.sparkSession, found)
    about = per_cluster.select(F.col("cluster").cast("string").alias("target"), "dominant_gate_label", F.col("purity_pct").alias("cluster_purity_pct"))
    return summary.join(F.broadcast(about), "target"), polygons, max(0, n - max_clusters)  # one row a cluster


def explain_external(cells: DataFrame, label: str, markers: list[str], key: str, donor: str = "sample_id", max_labels: int = 6, min_cells: int = 200, seed: int = 42) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """Strategies of the largest external labels: summary, polygons, and how well a gate carries over to unseen donors."""
    found = explain_labels(cells, label, markers, key, max_labels, min_cells, seed)
    transfer = None
    for name, (levels, _) in found.items():
        if levels:
            t = transferability(cells.withColumn("_target", F.coalesce(col(label).cast("string") == name, F.lit(False))), "_target", (levels[0].marker_x, levels[0].marker_y), donor, key, seed=seed)
            if t is not None:
                t = t.withColumn("target", F.lit(name))
                transfer = t if transfer is None else transfer.unionByName(t)
    return *_tables(cells.sparkSession, found), transfer


def join_labels(cells: DataFrame, labels: DataFrame, keys: tuple[str, str] = ("sample_id", "event_index"), min_match: int = 100) -> DataFrame:
    """cells with external_label by key, never by position; too few matches are an error."""
    out = cells.join(labels.select(*keys, "external_label"), list(keys), "left")
    n = out.filter("external_label is not null").limit(min_match).count()
    if n < min_match:
        raise ValueError(f"only {n} labels match a cell")
    return out
