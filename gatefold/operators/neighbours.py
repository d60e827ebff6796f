"""Exact nearest neighbours of all points, by cells around pivots.

Points with equal coordinates are one vertex with the smallest k + 1 of their keys, so copies cost nothing.  Pivots are a hash-drawn
sample of vertices (at most PIVOTS, which the driver holds); every vertex belongs to the cell of its nearest
pivot.  A query first searches that cell, which bounds the distance of its k-th neighbour; then it visits each cell that the triangle
inequality (by the cell's radius, and by the plane between two pivots) can't exclude.  Large cells are searched
in blocks, and a block that many queries visit is copied for batches of queries, so a task compares bounded numbers of both.

Distances are sums of squares in the order of the coordinates, ties go to the smaller key.  What is pruned can't be a neighbour, so
the result is exact in any number of dimensions; in many, few cells are excluded and the work approaches that of all pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gatefold.functions.storage import cut, remove

#: Vertices of a cell on average, pivots at most, vertices of a block and queries of a batch.
CELL, PIVOTS, BLOCK, BATCH = 512, 4096, 4096, 8192
#: Distances that are compared at a time; relative and absolute slack of a bound, for rounding.
MATRIX, SLACK = 1 << 21, 1e-9


def matrix(column: pa.ListArray | pa.ChunkedArray, dims: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of all rows of a and b, to be compared with slack."""
    d = (a * a).sum(1)[:, None] + (b * b).sum(1) - 2 * (a @ b.T)
    return np.sqrt(np.maximum(d, 0))


def coordinates(coords: str) -> Column:
    return F.transform(F.col(coords), lambda v: v.cast("double"))


class Cells:
    """The index of a point table: pivots, radius and size of their cells, and the vertices placed in them."""

    def __init__(self, pivots: np.ndarray, radius: np.ndarray, size: np.ndarray, placed: DataFrame, k: int) -> None:
        self.pivots, self.radius, self.size, self.placed, self.k = pivots, radius, size, placed, k
        self.between = distances(pivots, pivots)

    def table(self, spark: SparkSession, **columns: np.ndarray) -> DataFrame:
        """One row a cell."""
        rows = [(i, *[int(c[i]) for c in columns.values()]) for i in range(len(self.pivots))]
        return spark.createDataFrame(rows, ", ".join(["cell int", *[f"{c} int" for c in columns]]))


def vertices(points: DataFrame, key: str, coords: str, k: int) -> DataFrame:
    """c and ids: the smallest k of the keys at each place."""
    rows = points.select(F.col(key).alias("_j"), coordinates(coords).alias("c")).filter("_j is not null and c is not null and not exists(c, v -> v is null or isnan(v))")
    first = rows.withColumn("_r", F.row_number().over(Window.partitionBy("c").orderBy("_j"))).filter(F.col("_r") <= k)
    return first.groupBy("c").agg(F.array_sort(F.collect_list("_j")).alias("ids"))


def nearest_pivot(rows: DataFrame, pivots: np.ndarray) -> DataFrame:
    """rows (c first) with cell and dist."""
    shared = rows.sparkSession.sparkContext.broadcast(pivots)
    names = rows.columns

    def run(it):
        p = shared.value
        step = max(1, MATRIX // len(p))
        for b in it:
            x = matrix(b.column(0), p.shape[1])
            cell, dist = np.zeros(len(x), np.int32), np.zeros(len(x))
            for i in range(0, len(x), step):
                d = distances(x[i : i + step], p)
                cell[i : i + step] = d.argmin(1)
                dist[i : i + step] = d.min(1)
            yield pa.record_batch([*b.columns, pa.array(cell), pa.array(dist)], [*names, "cell", "dist"])

    return rows.mapInArrow(run, ", ".join([*[f"{c} {t}" for c, t in rows.dtypes], "cell int", "dist double"]))


def index(points: DataFrame, key: str, coords: str, k: int) -> Cells | None:
    """Cells of the points, for up to k neighbours; None if there are no points."""
    if not 0 < k < 1000:
        raise ValueError("k must be from 1 to 999")
    v = cut(vertices(points, key, coords, k), "vertices")
    n = v.count()
    if not n:
        remove(v)
        return None
    drawn = v.orderBy(F.xxhash64("c"), F.col("ids")[0]).limit(max(1, min(PIVOTS, n // CELL))).select("c").collect()
    pivots = np.array([r[0] for r in drawn], float)
    placed = cut(nearest_pivot(v, pivots), "placed")
    remove(v)
    radius, size = np.zeros(len(pivots)), np.zeros(len(pivots), np.int64)
    for r in placed.groupBy("cell").agg(F.max("dist").alias("r"), F.count(F.lit(1)).alias("n")).collect():  # one row a pivot
        radius[r["cell"]], size[r["cell"]] = r["r"], r["n"]
    return Cells(pivots, radius, size, placed, k)


def in_block(q: np.ndarray, bound: np.ndarray, p: np.ndarray, ids: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, squared distance, key) of the k nearest points of a block within the bound, by query, distance and key."""
    out = []
    step = max(1, MATRIX // max(1, len(p)))
    scale = np.abs(p).max(initial=0) ** 2 * p.shape[1]
    for i in range(0, len(q), step):
        part = q[i : i + step]
        near = (part * part).sum(1)[:, None] + (p * p).sum(1) - 2 * (part @ p.T)
        most = np.square(bound[i : i + step] * (1 + SLACK))
        if len(p) > k:
            most = np.minimum(most, np.partition(near, k - 1, axis=1)[:, k - 1])
        slack = 1e-12 * (scale + np.square(part).sum(1))
        row, at = np.nonzero(near <= (most + slack)[:, None])
        exact = np.zeros(len(row))
        for t in range(p.shape[1]):
            d = part[row, t] - p[at, t]
            exact += d * d
        many = first[at + 1] - first[at]
        flat = np.arange(many.sum()) + np.repeat(first[at] - (np.cumsum(many) - many), many)
        row, exact, name = np.repeat(row, many), np.repeat(exact, many), ids[flat]
        order = np.lexsort((name, exact, row))
        row, exact, name = row[order], exact[order], name[order]
        start = np.searchsorted(row, row)
        top = np.arange(len(row)) - start < k
        out.append((row[top] + i, exact[top], name[top]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def search(cells: Cells, visits: DataFrame, k: int) -> DataFrame:
    """q and found (d2, id) for every visit (q, c, bound, cell) and block of its cell."""
    spark = visits.sparkSession
    dims, spread = cells.pivots.shape[1], np.zeros(len(cells.size), np.int64)
    for r in visits.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect():  # one row a pivot
        spread[r["cell"]] = r["n"]
    blocks = cells.table(spark, _blocks=-(-cells.size // BLOCK), _batches=-(-spread // BATCH))
    pick = lambda c, n: F.pmod(F.xxhash64(c), F.greatest(F.col(n), F.lit(1))).cast("int")
    side = visits.join(F.broadcast(blocks), "cell")  # a row for each of at most PIVOTS cells
    side = side.select("q", "c", "bound", "cell", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("block"), pick("q", "_batches").alias("batch"))
    data = cells.placed.join(F.broadcast(blocks), "cell").filter("_batches > 0")
    data = data.select("c", "ids", "cell", pick("c", "_blocks").alias("block"), F.explode(F.sequence(F.lit(0), F.col("_batches") - 1)).alias("batch"))
    kind = dict(cells.placed.dtypes)["ids"][6:-1]
    form = f"q {dict(visits.dtypes)['q']}, found array<struct<d2: double, id: {kind}>>"

    def run(a: pa.Table, b: pa.Table) -> pa.Table:
        q = a.column("q").combine_chunks()
        lists = b.column("ids").combine_chunks()
        if not a.num_rows or not b.num_rows:
            inner = pa.struct([("d2", pa.float64()), ("id", lists.type.value_type)])
            return pa.table({"q": pa.array([], q.type), "found": pa.array([], pa.list_(inner))})
        ids = lists.flatten()
        first = np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))))
        plain = np.array(ids.to_pylist()) if pa.types.is_string(ids.type) else ids.to_numpy(zero_copy_only=False)
        row, d2, name = in_block(matrix(a.column("c"), dims), a.column("bound").to_numpy(), matrix(b.column("c"), dims), plain, first, k)
        at = np.searchsorted(row, np.arange(a.num_rows + 1)).astype(np.int32)
        items = pa.StructArray.from_arrays([pa.array(d2), pa.array(name.tolist() if name.dtype.kind == "U" else name, ids.type)], names=["d2", "id"])
        return pa.table({"q": q, "found": pa.ListArray.from_arrays(pa.array(at), items)})

    by = ["cell", "block", "batch"]
    return side.groupBy(*by).cogroup(data.groupBy(*by)).applyInArrow(run, form)


def candidates(cells: Cells, queries: DataFrame, k: int) -> DataFrame:
    """q and found: the k nearest points of each query (q, c), by distance and key."""
    spark = queries.sparkSession
    start = nearest_pivot(queries.select("c", "q"), cells.pivots)
    start = cut(start.select("q", "c", "cell", F.lit(float("inf")).alias("bound")), "queries")
    own = search(cells, start, k).groupBy("q").agg(F.slice(F.array_sort(F.flatten(F.collect_list("found"))), 1, k).alias("found"))
    reach = F.when(F.size("found") == k, F.sqrt(F.col("found")[k - 1]["d2"])).otherwise(float("inf"))
    first = cut(start.drop("bound").join(own, "q").withColumn("bound", reach), "first")
    remove(start)
    shared = spark.sparkContext.broadcast((cells.pivots, cells.radius, cells.size, cells.between))

    def others(it):
        p, radius, size, between = shared.value
        step = max(1, MATRIX // len(p))
        for b in it:
            x, home, bound = matrix(b.column(1), p.shape[1]), b.column(2).to_numpy(), b.column(3).to_numpy()
            for i in range(0, len(x), step):
                d, h = distances(x[i : i + step], p), home[i : i + step]
                slack = SLACK * (1 + d)
                with np.errstate(divide="ignore", invalid="ignore"):
                    plane = (d * d - np.square(d[np.arange(len(h)), h])[:, None]) / (2 * between[h])
                least = np.maximum(d - radius, np.where(between[h] > 0, plane, 0))
                go = (least <= bound[i : i + step, None] + slack) & (size > 0)
                go[np.arange(len(h)), h] = False
                row, cell = np.nonzero(go)
                at = pa.array(row + i)
                yield pa.record_batch([b.column(0).take(at), b.column(1).take(at), b.column(3).take(at), pa.array(cell.astype(np.int32))], ["q", "c", "bound", "cell"])

    form = f"q {dict(queries.dtypes)['q']}, c array<double>, bound double, cell int"
    visits = cut(first.select("q", "c", "cell", "bound").mapInArrow(others, form), "visits")
    more = search(cells, visits, k)
    both = more.unionByName(first.select("q", "found"))
    return both.groupBy("q").agg(F.slice(F.array_sort(F.flatten(F.collect_list("found"))), 1, k).alias("found"))


EDGES = ("neighbour", "place", "d2")


def nearest(points: DataFrame, key: str, coords: str, k: int) -> DataFrame:
    """key, neighbour, place (from 1) and d2 of the k nearest other points of every point.

    coords is an array column of one length.  Points with a null key, null coordinates or a NaN among them have no neighbours
    and are none; keys are distinct.  With fewer than k others, all of them are neighbours.
    """
    cells = index(points, key, coords, k + 1)
    kind = dict(points.dtypes)[key]
    if cells is None:
        return points.sparkSession.createDataFrame([], f"`{key}` {kind}, neighbour {kind}, place int, d2 double")
    found = candidates(cells, cells.placed.select("c", F.col("ids")[0].alias("q")), k + 1)
    # copies of a point share its list; a place may hold a third of all points, whose lists are one row: AQE splits that join
    lists = cells.placed.select("c", F.col("ids")[0].alias("q")).join(found, "q").select("c", "found")
    each = points.select(F.col(key).alias("_j"), coordinates(coords).alias("c")).join(lists, "c")
    own = F.slice(F.filter("found", lambda f: f["id"] != F.col("_j")), 1, k)
    out = each.select("_j", F.posexplode(own).alias("place", "n"))
    return out.select(F.col("_j").alias(key), F.col("n.id").alias("neighbour"), (F.col("place") + 1).alias("place"), F.col("n.d2").alias("d2"))


def nearest_of(cells: Cells, queries: DataFrame, key: str, coords: str, k: int) -> DataFrame:
    """key, neighbour, place and d2: the k nearest indexed points of every query, itself included where it is indexed."""
    if k > cells.k:
        raise ValueError(f"the index holds {cells.k} keys a place")
    rows = queries.select(coordinates(coords).alias("c"), F.col(key).alias("q")).filter("q is not null and c is not null and not exists(c, v -> v is null or isnan(v))")
    out = candidates(cells, rows, k).select("q", F.posexplode("found").alias("place", "n"))
    return out.select(F.col("q").alias(key), F.col("n.id").alias("neighbour"), (F.col("place") + 1).alias("place"), F.col("n.d2").alias("d2"))
