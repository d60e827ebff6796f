"""Neighbour embedding (UMAP): a fuzzy graph of nearest neighbours, laid out in two dimensions by attraction and negative samples.

The graph comes from the exact neighbour join.  Each point's bandwidth is found by bisection, so that its weights sum to log2(k), and the
two directed weights of a pair are joined as a + b - ab.  The layout starts from principal components and runs in
rounds: vertices are dealt to blocks of BLOCK successive places, an edge gets its far end's coordinates by a join, and
a block runs a round's epochs on its own vertices.  Far ends in the block move with it, others stand still until the round ends.
Negative samples come from NEGATIVES hash-drawn vertices, whose coordinates are collected and broadcast: a bound that
doesn't grow.  A vertex whose coordinates aren't needed is never copied, so no step holds all of them.

Everything random is a hash of the seed and of places in the order of keys, and sums run in that order: the result doesn't depend
on partitions.  Points without coordinates aren't laid out; an empty table gives an empty layout.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gatefold.functions.ordering import places
from gatefold.functions.storage import cut, remove
from gatefold.operators import neighbours
from gatefold.operators.neighbours import coordinates, matrix

BLOCK, NEGATIVES = 4096, 1 << 16
#: Epochs of a round, negative samples of an edge, largest step of a coordinate, size of the first layout.
ROUND, SAMPLES, CLIP, SPAN = 20, 5, 4.0, 10.0
#: Coordinates are rounded to so many steps of the largest for their moments, which are then whole numbers and sum exactly.
STEPS = 1 << 12
VERSION = 1


def curve(min_dist: float, spread: float = 1.0) -> tuple[float, float]:
    """a and b of 1 / (1 + a d^2b) that come nearest to 1 up to min_dist and an exponential decay beyond."""
    x = np.linspace(0, 3 * spread, 300)[1:]
    y = np.where(x < min_dist, 1.0, np.exp(-(x - min_dist) / spread))
    p = np.array([1.0, 1.0])
    for _ in range(200):  # damped Gauss-Newton steps
        a, b = p
        t = x ** (2 * b)
        f = 1 / (1 + a * t)
        jac = np.stack([-t * f * f, -2 * a * t * np.log(x) * f * f], axis=1)
        p = np.maximum(p + 0.5 * np.linalg.lstsq(jac, y - f, rcond=None)[0], 1e-3)
    return float(p[0]), float(p[1])


def bandwidths(d: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Fuzzy weights of rows of ascending distances (inf where a row has fewer than the widest)."""
    real = np.isfinite(d)
    rho = np.where((d > 0) & real, d, np.inf).min(axis=1)
    rho = np.where(np.isfinite(rho), rho, 0.0)
    over = np.where(real, np.maximum(d - rho[:, None], 0), np.inf)
    target = np.log2(np.maximum(k, 2))
    lo, hi, mid = np.zeros(len(d)), np.full(len(d), np.inf), np.ones(len(d))
    with np.errstate(divide="ignore", over="ignore"):
        for _ in range(64):
            much = np.exp(-over / mid[:, None]).sum(axis=1) > target
            hi, lo = np.where(much, mid, hi), np.where(much, lo, mid)
            mid = np.where(np.isfinite(hi), (lo + hi) / 2, mid * 2)
        mean = np.where(real, d, 0).sum(axis=1) / np.maximum(real.sum(axis=1), 1)
        mid = np.maximum(mid, np.maximum(1e-3 * mean, 1e-12))
        return np.exp(-over / mid[:, None])


def fuzzy_graph(edges: DataFrame, key: str) -> DataFrame:
    """i, j and w, both ways, from the neighbours (key, neighbour, d2) of every point."""
    kind = dict(edges.dtypes)[key]
    lists = edges.groupBy(F.col(key).alias("i")).agg(F.array_sort(F.collect_list(F.struct(F.col("d2"), F.col("neighbour").alias("j")))).alias("n"))

    def run(it):
        for b in it:
            items = b.column(1)
            n = items.value_lengths().to_numpy(zero_copy_only=False)
            flat = items.flatten()
            d = np.full((len(n), int(n.max(initial=1))), np.inf)
            row = np.repeat(np.arange(len(n)), n)
            at = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            d[row, at] = np.sqrt(flat.field("d2").to_numpy())
            w = bandwidths(d, n)[row, at]
            yield pa.record_batch([b.column(0).take(pa.array(row)), flat.field("j"), pa.array(w)], ["i", "j", "w"])

    one = lists.mapInArrow(run, f"i {kind}, j {kind}, w double")
    both = one.unionByName(one.select(F.col("j").alias("i"), F.col("i").alias("j"), "w"))
    # of a pair there are one or two weights
    return both.groupBy("i", "j").agg(F.when(F.count(F.lit(1)) > 1, F.max("w") + F.min("w") - F.max("w") * F.min("w")).otherwise(F.max("w")).alias("w"))


def principal(points: DataFrame, coords: str) -> tuple[np.ndarray, np.ndarray]:
    """Mean and the two leading axes, from exact sums of rounded coordinates."""
    c = coordinates(coords)
    top = points.select(F.max(F.array_max(F.transform(c, F.abs)))).first()[0] or 1.0

    def sums(it):
        total = None
        for b in it:
            x = np.rint(matrix(b.column(0), len(b.column(0)[0])) / top * STEPS)
            x = np.concatenate([np.ones((len(x), 1)), x], axis=1)
            total = x.T @ x if total is None else total + x.T @ x
        if total is not None:
            yield pa.record_batch([pa.array([total.tobytes()], pa.binary())], ["m"])

    # a row a task, as large as the square of the dimensions; the numbers are whole, so their order doesn't matter
    parts = [np.frombuffer(r[0]) for r in points.select(c.alias("c")).mapInArrow(sums, "m binary").collect()]
    k = int(np.sqrt(len(parts[0])))
    m = sum(parts).reshape(k, k)
    mean = m[0, 1:] / m[0, 0]
    value, vector = np.linalg.eigh(m[1:, 1:] / m[0, 0] - np.outer(mean, mean))
    axes = vector[:, np.argsort(-value, kind="stable")[:2]].T
    axes = axes * np.where(np.take_along_axis(axes, np.abs(axes).argmax(1)[:, None], 1) < 0, -1, 1)
    return mean * top / STEPS, axes if len(axes) == 2 else np.concatenate([axes, np.zeros((1, k - 1))])


def scramble(*parts) -> np.ndarray:
    """A 64-bit hash of numbers."""
    h = np.uint64(0)
    with np.errstate(over="ignore"):
        for p in parts:
            h = (h ^ np.asarray(p).astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0xD1B54A32D192ED03)
            h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            h = h ^ (h >> np.uint64(31))
    return h


def settle(y: np.ndarray, first: int, i: np.ndarray, j: np.ndarray, share: np.ndarray, far: np.ndarray, others: np.ndarray, other_at: np.ndarray, a: float, b: float, start: int, epochs: int, total: int, seed: int) -> np.ndarray:
    """y after some epochs: vertex v is y[v - first]; edges (i, j) are in order, far has the coordinates of j, share of the epochs in which an edge acts.

    others are the coordinates of the vertices other_at, from which negative samples come.
    """
    here = (j >= first) & (j < first + len(y))
    for e in range(start, start + epochs):
        alpha = 1 - e / total
        act = np.flatnonzero(np.floor((e + 1) * share) > np.floor(e * share))
        if not len(act):
            continue
        # the edges of a vertex act in turn, one of each vertex at a time
        head = i[act]
        turn = np.arange(len(act)) - np.searchsorted(head, head)
        order = np.argsort(turn, kind="stable")
        for part in np.split(order, np.flatnonzero(np.diff(turn[order])) + 1):
            k = act[part]
            v, u = i[k] - first, j[k]
            inner = here[k]
            end = far[k].copy()
            end[inner] = y[u[inner] - first]
            diff = y[v] - end
            d2 = np.einsum("ij,ij->i", diff, diff)
            with np.errstate(divide="ignore", invalid="ignore"):
                pull = np.where(d2 > 0, -2 * a * b * d2 ** (b - 1) / (1 + a * d2**b), 0)
            # both ends of an edge act on this vertex, as the far end's own block moves it alone
            y[v] += alpha * np.clip(pull[:, None] * diff, -CLIP, CLIP)
            for s in range(SAMPLES):
                at = (scramble(seed, e, i[k], j[k], s) % np.uint64(len(others))).astype(np.int64)
                diff = y[v] - others[at]
                d2 = np.einsum("ij,ij->i", diff, diff)
                push = 2 * b / ((0.001 + d2) * (1 + a * d2**b))
                step = np.clip(push[:, None] * diff, -CLIP, CLIP)
                step[other_at[at] == i[k]] = 0
                y[v] += alpha * step
    return y


def layout(points: DataFrame, key: str, coords: str, k: int = 30, min_dist: float = 0.3, epochs: int = 200, seed: int = 42) -> DataFrame:
    """key, x and y of all points."""
    spark = points.sparkSession
    kind = dict(points.dtypes)[key]
    rows = points.select(F.col(key).alias("v"), coordinates(coords).alias("c")).filter("v is not null and c is not null and not exists(c, v -> v is null or isnan(v))")
    graph = fuzzy_graph(neighbours.nearest(points, key, coords, k), key)
    placed = cut(places(rows, [], ["v"], "at"), "vertices")
    n = placed.count()
    if not n:
        return spark.createDataFrame([], f"`{key}` {kind}, x double, y double")
    at = placed.select("v", "at")
    joined = graph.join(at.withColumnRenamed("v", "i").withColumnRenamed("at", "ia"), "i").join(at.withColumnRenamed("v", "j").withColumnRenamed("at", "ja"), "j")
    most = 0.0
    edges = cut(joined.select("ia", "ja", "w"), "edges")
    most = edges.agg(F.max("w")).first()[0] or 1.0
    # an edge that would act less than once is left out
    edges = edges.filter(F.col("w") * epochs >= most).select("ia", "ja", (F.col("w") / most).alias("share"))
    mean, axes = principal(rows, "c")
    shift = lambda ax: F.aggregate(F.zip_with("c", F.array(*[F.lit(float(m)) for m in mean]), lambda u, m: u - m), F.struct(F.lit(0.0).alias("s"), F.lit(0).alias("i")), lambda t, v: F.struct((t["s"] + v * F.get(F.array(*[F.lit(float(w)) for w in ax]), t["i"])).alias("s"), (t["i"] + 1).alias("i")), lambda t: t["s"])
    flat = cut(placed.select("at", shift(axes[0]).alias("x"), shift(axes[1]).alias("y")), "start")
    far = flat.agg(F.max(F.abs("x")).alias("x"), F.max(F.abs("y")).alias("y")).first()
    size = SPAN / max(far["x"], far["y"], 1e-12)
    # copies start apart
    jitter = lambda salt: F.pmod(F.xxhash64(F.lit(seed), F.lit(salt), F.col("at")), F.lit(1 << 20)) / float(1 << 20) * 1e-2
    now = cut(flat.select("at", (F.col("x") * size + jitter(1)).alias("x"), (F.col("y") * size + jitter(2)).alias("y")), "layout")
    remove(flat)
    a, b = curve(min_dist)
    drawn = F.pmod(F.xxhash64(F.lit(seed), F.col("at")), F.lit(max(1, n))) < NEGATIVES
    for start in range(0, epochs, ROUND):
        some = now.filter(drawn).orderBy("at").limit(2 * NEGATIVES).toPandas()  # about NEGATIVES rows at any size
        after = cut(_round(now, edges, (some[["x", "y"]].to_numpy(), some["at"].to_numpy()), (a, b, start, min(ROUND, epochs - start), epochs, seed)), "layout")
        remove(now)
        now = after
    return placed.join(now, "at").select(F.col("v").alias(key), "x", "y")


def _round(now: DataFrame, edges: DataFrame, negatives: tuple[np.ndarray, np.ndarray], setting: tuple) -> DataFrame:
    """Every vertex after a round."""
    shared = now.sparkSession.sparkContext.broadcast(negatives)
    ends = edges.join(now.select(F.col("at").alias("ja"), F.col("x").alias("fx"), F.col("y").alias("fy")), "ja")
    block = lambda c: F.floor(F.col(c) / BLOCK).alias("block")

    def run(v: pa.Table, e: pa.Table) -> pa.Table:
        at = v.column("at").to_numpy()
        order = np.argsort(at)
        at = at[order]
        y = np.stack([v.column("x").to_numpy()[order], v.column("y").to_numpy()[order]], axis=1)
        if e.num_rows:
            i, j = e.column("ia").to_numpy(), e.column("ja").to_numpy()
            o = np.lexsort((j, i))
            others, other_at = shared.value
            far = np.stack([e.column("fx").to_numpy()[o], e.column("fy").to_numpy()[o]], axis=1)
            y = settle(y, int(at[0]), i[o], j[o], e.column("share").to_numpy()[o], far, others, other_at, *setting)
        return pa.table({"at": at, "x": y[:, 0], "y": y[:, 1]})

    left = now.select("at", "x", "y", block("at")).groupBy("block")
    right = ends.select("ia", "ja", "share", "fx", "fy", block("ia")).groupBy("block")
    return left.cogroup(right).applyInArrow(run, "at long, x double, y double")


# ---------------------------------------------------------------- a saved layout
class NotUsable(ValueError):
    pass


@dataclass
class SavedLayout:
    """A layout with what projection needs: the features in order, their centre and scale, and the neighbour index."""

    features: list[str]
    centre: list[float]
    scale: list[float]
    k: int
    cells: neighbours.Cells
    layout: DataFrame


def scaled(df: DataFrame, features: list[str], centre: list[float], scale: list[float]) -> DataFrame:
    """df with _z: the scaled features, 0 where one isn't finite."""
    gone = [f for f in features if f not in df.columns]
    if gone:
        raise NotUsable(f"features of the model that are missing: {gone}")
    from gatefold.functions.numeric import col, finite

    return df.withColumn("_z", F.array(*[F.when(finite(f), (col(f).cast("double") - m) / s).otherwise(0.0) for f, m, s in zip(features, centre, scale, strict=True)]))


def save(df: DataFrame, key: str, made: DataFrame, features: list[str], centre: list[float], scale: list[float], path: str, k: int = 30) -> None:
    """Write the layout `made` (key, x, y) of df with its index to a new folder; the version file comes last."""
    spark = df.sparkSession
    cells = neighbours.index(scaled(df, features, centre, scale), key, "_z", k)
    if cells is None:
        raise NotUsable("a layout of no points")
    cells.placed.write.parquet(f"{path}/placed")
    made.select(F.col(key).alias("v"), "x", "y").write.parquet(f"{path}/layout")
    meta = {"version": VERSION, "features": features, "centre": centre, "scale": scale, "k": k, "pivots": cells.pivots.tolist(), "radius": cells.radius.tolist(), "size": cells.size.tolist()}
    spark.createDataFrame([(json.dumps(meta),)], "model string").coalesce(1).write.text(f"{path}/meta")


def load(spark: SparkSession, path: str) -> SavedLayout:
    try:
        meta = json.loads(spark.read.text(f"{path}/meta").first()[0])
    except Exception as error:
        raise NotUsable(f"no layout at {path}") from error
    if meta.get("version") != VERSION or not meta.get("centre"):
        raise NotUsable(f"a layout of version {meta.get('version')} without scaling, or of another version")
    cells = neighbours.Cells(np.array(meta["pivots"]), np.array(meta["radius"]), np.array(meta["size"]), spark.read.parquet(f"{path}/placed"), meta["k"])
    return SavedLayout(meta["features"], meta["centre"], meta["scale"], meta["k"], cells, spark.read.parquet(f"{path}/layout"))


def place_new(df: DataFrame, key: str, saved: SavedLayout) -> DataFrame:
    """key, x and y of new rows: the mean of their neighbours' places by fuzzy weight; a row that equals a stored one lands on it.

    A feature of the model that df lacks is an error: a place from fewer features would look right and mean nothing.
    """
    near = neighbours.nearest_of(saved.cells, scaled(df, saved.features, saved.centre, saved.scale), key, "_z", saved.k)
    kind = dict(near.dtypes)[key]
    lists = near.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("d2", F.col("neighbour").alias("j")))).alias("n"))

    def run(it):
        for b in it:
            items = b.column(1)
            n = items.value_lengths().to_numpy(zero_copy_only=False)
            flat = items.flatten()
            d = np.full((len(n), int(n.max(initial=1))), np.inf)
            row = np.repeat(np.arange(len(n)), n)
            at = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            d[row, at] = np.sqrt(flat.field("d2").to_numpy())
            w = bandwidths(d, n)
            w[:, 1:][d[:, :1].repeat(d.shape[1] - 1, 1) == 0] = 0  # on a stored point: that point, the one of the smallest key
            yield pa.record_batch([b.column(0).take(pa.array(row)), flat.field("j"), pa.array(w[row, at])], [key, "v", "w"])

    weights = lists.mapInArrow(run, f"`{key}` {kind}, v {dict(near.dtypes)['neighbour']}, w double").filter("w > 0")
    mean = lambda c: (F.sum(F.col("w") * F.col(c)) / F.sum("w")).alias(c)
    return weights.join(saved.layout, "v").groupBy(key).agg(mean("x"), mean("y"))
