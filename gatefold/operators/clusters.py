"""Clusters: self-organising maps over distributed sums, their metaclusters, agreement with gates and composition."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gatefold.functions.numeric import col
from gatefold.operators.sampling import draw_key, mark_first


def nearest(features: list[str], centres: np.ndarray):
    """Index of the nearest of a few centres as an expression: the least (squared distance, index)."""
    d2 = lambda c: sum(((col(f) - float(x)) * (col(f) - float(x)) for f, x in zip(features, c, strict=True)), F.lit(0.0))
    return F.array_min(F.array(*[F.struct(d2(c).alias("d"), F.lit(i).alias("i")) for i, c in enumerate(centres)]))["i"]


def som_sums(df: DataFrame, features: list[str], codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums and counts of the rows nearest to each code.  A task sends one row a node, however many rows it has."""
    shared = df.sparkSession.sparkContext.broadcast(codes)
    k = len(features)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = shared.value
        sums, counts = np.zeros((len(c), k)), np.zeros(len(c), np.int64)
        for b in it:
            x = np.column_stack([b.column(i).to_numpy(zero_copy_only=False) for i in range(k)]).astype(float)
            for s in range(0, len(x), 8192):
                part = x[s : s + 8192]
                best = ((c * c).sum(1) - 2 * part @ c.T).argmin(1)
                counts += np.bincount(best, minlength=len(c))
                np.add.at(sums, best, part)
        yield pa.record_batch([pa.array(range(len(c)), pa.int32()), pa.array(counts), pa.array(sums.tolist(), pa.list_(pa.float64()))], ["node", "n", "s"])

    rows = df.select(*features).mapInArrow(run, "node int, n long, s array<double>").groupBy("node").agg(F.sum("n").alias("n"), *[F.sum(F.get("s", F.lit(i))).alias(f"s{i}") for i in range(k)]).collect()
    sums, counts = np.zeros((len(codes), k)), np.zeros(len(codes))
    for r in rows:
        sums[r["node"]], counts[r["node"]] = [r[f"s{i}"] for i in range(k)], r["n"]
    return sums, counts


def train_som(df: DataFrame, features: list[str], key: str, side: int = 10, epochs: int = 10, seed: int = 42) -> np.ndarray:
    """Codes of a batch self-organising map: one distributed pass an epoch, Gaussian neighbourhoods shrinking to 1."""
    from gatefold.operators.sampling import draw_key

    n = side * side
    first = df.select(*features, key).orderBy(draw_key(seed, key), key).limit(n).select(*features).collect()
    if len(first) < n:
        raise ValueError(f"a {side} x {side} map needs at least {n} rows")
    codes = np.array([[float(v) for v in r] for r in first])
    grid = np.array([(i, j) for i in range(side) for j in range(side)], float)
    d2 = ((grid[:, None] - grid[None]) ** 2).sum(2)
    for r in np.linspace(max(side / 3, 1), 1, epochs):
        sums, counts = som_sums(df, features, codes)
        h = np.exp(-d2 / (2 * r * r))
        codes = (h @ sums) / np.maximum((h @ counts)[:, None], 1e-12)
    return codes


def ward(codes: np.ndarray, k: int) -> np.ndarray:
    """k clusters of at most a few hundred codes by Ward's criterion (Lance-Williams update)."""
    n = len(codes)
    d = ((codes[:, None] - codes[None]) ** 2).sum(2)
    np.fill_diagonal(d, np.inf)
    size, member, alive = np.ones(n), [[i] for i in range(n)], list(range(n))
    while len(alive) > max(1, k):
        sub = d[np.ix_(alive, alive)]
        a, b = divmod(int(sub.argmin()), len(alive))
        i, j = alive[min(a, b)], alive[max(a, b)]
        for m in alive:
            if m not in (i, j):
                t = size[i] + size[j] + size[m]
                d[i, m] = d[m, i] = ((size[i] + size[m]) * d[i, m] + (size[j] + size[m]) * d[j, m] - size[m] * d[i, j]) / t
        size[i] += size[j]
        member[i] += member[j]
        alive.remove(j)
    out = np.zeros(n, int)
    for c, i in enumerate(alive):
        out[member[i]] = c
    return out


def by_size(df: DataFrame, cluster: str) -> DataFrame:
    """Clusters renumbered 1, 2, ... by size, the largest first."""
    n = df.groupBy(cluster).agg(F.count(F.lit(1)).alias("_n"))
    order = n.withColumn("_new", F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(F.desc("_n"), cluster))).select(cluster, "_new")
    return df.join(order, cluster).withColumn(cluster, F.col("_new")).drop("_new")  # one row a cluster; its size decides the join


def unsupervised(df: DataFrame, features: list[str], key: str, n_clusters: int = 12, side: int = 10, epochs: int = 10, seed: int = 42) -> DataFrame:
    """df with som_node and cluster; needs five rows a node."""
    if df.limit(5 * side * side).count() < 5 * side * side:
        raise ValueError("too few rows for this map")
    codes = train_som(df, features, key, side, epochs, seed)
    meta = ward(codes, n_clusters)
    out = df.withColumn("som_node", nearest(features, codes))
    return by_size(out.withColumn("cluster", F.get(F.array(*map(F.lit, meta.tolist())), F.col("som_node"))), "cluster")


def agreement(cells: DataFrame, cluster: str = "cluster", label: str = "population_label", other: str = "^Other|unclassified") -> tuple[DataFrame, DataFrame]:
    """How clusters and gate labels describe each other: a table by cluster and one by population."""
    ok = cells.filter(col(cluster).isNotNull() & col(label).isNotNull() & (F.trim(col(label)) != ""))
    n = ok.groupBy(F.col(cluster).alias("cluster"), F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    c, p, all_ = Window.partitionBy("cluster"), Window.partitionBy("label"), Window.partitionBy(F.lit(1))
    n = n.withColumns({"_c": F.sum("n").over(c), "_p": F.sum("n").over(p), "_all": F.sum("n").over(all_)})
    n = n.withColumn("_rc", F.row_number().over(c.orderBy(F.desc("n"), "label"))).withColumn("_rp", F.row_number().over(p.orderBy(F.desc("n"), "cluster")))
    top = lambda k, x: F.max(F.when(F.col("_rc") == k, x))
    per = n.groupBy("cluster").agg(F.max("_c").alias("n_cells"), F.max("_all").alias("_all"), top(1, F.col("label")).alias("dominant_gate_label"), top(1, F.col("n")).alias("_n1"), top(1, F.col("_p")).alias("_p1"), top(2, F.col("label")).alias("second_label"), top(2, F.col("n")).alias("_n2"), F.count(F.lit(1)).alias("n_labels_present"))
    purity = F.col("_n1") / F.col("n_cells")
    said = F.when(F.col("dominant_gate_label").rlike(other), "UNDESCRIBED").when(purity >= 0.8, "clean").when(purity >= 0.5, "mixed").otherwise("fragmented")
    clusters = per.select("cluster", "n_cells", F.bround(100.0 * F.col("n_cells") / F.col("_all"), 2).alias("pct_of_all_cells"), "dominant_gate_label", F.bround(100.0 * purity, 1).alias("purity_pct"), "second_label", F.bround(100.0 * F.col("_n2") / F.col("n_cells"), 1).alias("second_pct"), "n_labels_present", F.bround(100.0 * F.col("_n1") / F.col("_p1"), 1).alias("pct_of_that_label_captured"), said.alias("interpretation"))
    first = lambda x: F.max(F.when(F.col("_rp") == 1, x))
    pop = n.groupBy("label").agg(F.max("_p").alias("n_cells"), first(F.col("cluster")).alias("dominant_cluster"), first(F.col("n")).alias("_n1"), first(F.col("_c")).alias("dominant_cluster_total_cells"), (1.0 / F.sum((F.col("n") / F.col("_p")) * (F.col("n") / F.col("_p")))).alias("eff"))
    captured = 100.0 * F.col("_n1") / F.col("dominant_cluster_total_cells")
    told = F.when(F.col("eff") >= 3, "fragmented").when((captured < 40) & (F.col("dominant_cluster_total_cells") > F.col("n_cells")), "SUSPECT THRESHOLD").otherwise("coherent")
    populations = pop.select(F.col("label").alias("population"), "n_cells", "dominant_cluster", F.bround(100.0 * F.col("_n1") / F.col("n_cells"), 1).alias("pct_in_dominant_cluster"), F.bround("eff", 2).alias("effective_n_clusters"), "dominant_cluster_total_cells", F.bround(captured, 1).alias("pct_of_dominant_cluster_captured"), told.alias("interpretation"))
    return clusters, populations


def composition(cells: DataFrame, group: str, population: str) -> DataFrame:
    """population, group, pct: shares of equally large cohorts, 100 a population."""
    ok = cells.filter(col(group).isNotNull() & (F.trim(col(group)) != "") & col(population).isNotNull() & (F.trim(col(population)) != ""))
    n = ok.groupBy(F.col(population).alias("population"), F.col(group).alias("group")).agg(F.count(F.lit(1)).cast("double").alias("n"))
    share = n.withColumn("_e", F.col("n") / F.sum("n").over(Window.partitionBy("group")))
    return share.select("population", "group", (100.0 * F.col("_e") / F.sum("_e").over(Window.partitionBy("population"))).alias("pct"))


# ---------------------------------------------------------------- subclusters
def kmeans(x: np.ndarray, k: int, seed: int, starts: int = 5, steps: int = 50) -> tuple[np.ndarray, np.ndarray]:
    """Lloyd's algorithm with k-means++ starts on a bounded array: centres and labels of the best start."""
    rng, best = np.random.default_rng(seed), None
    for _ in range(starts):
        c = x[rng.integers(len(x))][None]
        while len(c) < k:
            d = ((x[:, None] - c[None]) ** 2).sum(2).min(1)
            c = np.vstack([c, x[rng.choice(len(x), p=d / d.sum())] if d.sum() > 0 else x[rng.integers(len(x))]])
        for _ in range(steps):
            lab = ((c * c).sum(1) - 2 * x @ c.T).argmin(1)
            new = np.array([x[lab == i].mean(0) if (lab == i).any() else c[i] for i in range(k)])
            if np.allclose(new, c):
                break
            c = new
        cost = ((x - c[lab]) ** 2).sum()
        if best is None or cost < best[0]:
            best = (cost, c, lab)
    return best[1], best[2]


def silhouette(x: np.ndarray, lab: np.ndarray) -> float:
    """Mean silhouette with Euclidean distances."""
    d = np.sqrt(np.maximum(((x[:, None] - x[None]) ** 2).sum(2), 0))
    ks = np.unique(lab)
    mean = np.column_stack([d[:, lab == k].sum(1) for k in ks])
    size = np.array([(lab == k).sum() for k in ks])
    own = np.searchsorted(ks, lab)
    a = mean[np.arange(len(x)), own] / np.maximum(size[own] - 1, 1)
    other = mean / size
    other[np.arange(len(x)), own] = np.inf
    b = other.min(1)
    s = np.where(size[own] > 1, (b - a) / np.maximum(np.maximum(a, b), 1e-300), 0.0)
    return float(s.mean())


def _reference(cells: DataFrame, group: str, reference: str, population: str, key: str, min_ref: int, sample_n: int, seed: int) -> DataFrame:
    """Reference cells of populations of at least min_ref of them (_n), sample_n a population in hash order."""
    ref = cells.filter((col(group) == reference) & col(population).isNotNull())
    n = ref.groupBy(population).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= min_ref)
    return mark_first(ref.join(n, population), [population], draw_key(seed, key), key, F.lit(sample_n), "_in").filter("_in")


def choose_k(cells: DataFrame, features: list[str], group: str, reference: str, key: str, population: str = "population_label", ks: tuple[int, ...] = (2, 3, 4, 5, 6), min_ref: int = 150, sample_n: int = 1500, seed: int = 42) -> DataFrame:
    """population, k, mean_silhouette, chosen: k by silhouette on a bounded draw (sample_n) of reference cells."""
    ref = _reference(cells, group, reference, population, key, min_ref, sample_n, seed)

    def fit(pdf):
        import pandas as pd

        x, n = pdf[features].to_numpy(float), int(pdf["_n"].iloc[0])
        rows = [(k, silhouette(x, kmeans(x, k, seed)[1])) for k in ks if k <= n / 75]
        top = max(rows, key=lambda r: r[1])[0] if rows else None
        return pd.DataFrame([(pdf[population].iloc[0], k, s, k == top, n) for k, s in rows], columns=["population", "k", "mean_silhouette", "chosen", "n_reference_cells"])

    return ref.select(population, "_n", *features).groupBy(population).applyInPandas(fit, "population string, k int, mean_silhouette double, chosen boolean, n_reference_cells long")


def subclusters(cells: DataFrame, features: list[str], group: str, reference: str, key: str, k: dict[str, int] | int = 3, population: str = "population_label", order_by: str | None = None, min_ref: int = 150, sample_n: int = 20_000, seed: int = 42) -> DataFrame:
    """cells with subcluster: 1, 2, ... by the median of order_by, centres fitted on reference cells and assigned to all.

    Fits run in one task a population on at most sample_n reference cells; the assignment is an
    expression over broadcast centres, one small array a population.
    """
    ref = _reference(cells, group, reference, population, key, min_ref, sample_n, seed)

    def fit(pdf):
        import pandas as pd

        p = pdf[population].iloc[0]
        want = k if isinstance(k, int) else k.get(p, 1)
        c, _ = kmeans(pdf[features].to_numpy(float), max(1, want), seed)
        return pd.DataFrame({"_p": [p], "_centres": [c.tolist()]})

    centres = ref.select(population, *features).groupBy(population).applyInPandas(fit, "_p string, _centres array<array<double>>")
    x = F.array(*[col(f).cast("double") for f in features])
    d2 = lambda c: F.aggregate(F.zip_with(x, c, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda t, v: t + v)
    out = cells.join(centres, cells[population] == centres["_p"], "left").withColumn("_s", F.array_min(F.transform("_centres", lambda c, i: F.struct(d2(c).alias("d"), i.alias("i"))))["i"]).drop("_p", "_centres")
    med = out.filter("_s is not null").groupBy(population, "_s").agg(F.percentile(col(order_by or features[0]), F.lit(0.5)).alias("_m"))
    rank = med.withColumn("subcluster", F.row_number().over(Window.partitionBy(population).orderBy("_m", "_s"))).drop("_m")
    return out.join(rank, [population, "_s"], "left").drop("_s")
