"""Exact neighbours against brute force, and the neighbour embedding made from them."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from gatefold.functions.ordering import places
from gatefold.operators import layout, neighbours


def frame(spark, pts, keys, parts=5):
    kind = "string" if keys and isinstance(keys[0], str) else "long"
    rows = [(k, None if p is None else [float(x) for x in p]) for k, p in zip(keys, pts, strict=True)]
    return spark.createDataFrame(rows, f"key {kind}, xy array<double>").repartition(parts)


def brute(pts, keys, k, queries=None):
    p = np.array(pts, float)
    out = {}
    for name, q in queries or list(zip(keys, p, strict=True)):
        d = np.zeros(len(p))
        for c in range(p.shape[1]):
            d += (p[:, c] - q[c]) ** 2
        rest = sorted((j for j in range(len(p)) if queries or keys[j] != name), key=lambda j: (d[j], keys[j]))
        out[name] = [keys[j] for j in rest[:k]]
    return out


def listed(df):
    got = {}
    for r in sorted(df.collect(), key=lambda r: r.place):
        got.setdefault(r.key, []).append(r.neighbour)
    return got


@pytest.fixture
def small_cells(monkeypatch):
    monkeypatch.setattr(neighbours, "CELL", 40)
    monkeypatch.setattr(neighbours, "BLOCK", 30)
    monkeypatch.setattr(neighbours, "BATCH", 25)


@pytest.mark.parametrize("kind", ["spread", "copies", "lattice", "names", "many dimensions"])
def test_nearest_equals_brute_force(spark, small_cells, kind):
    rng = np.random.default_rng(4)
    pts = {
        "spread": rng.normal(size=(400, 3)), "copies": np.concatenate([np.zeros((150, 2)), rng.normal(size=(150, 2))]), "lattice": rng.integers(0, 12, (400, 2)),
        "names": rng.normal(size=(120, 2)), "many dimensions": rng.normal(size=(150, 40)),
    }[kind]
    keys = [f"k{i}" for i in range(len(pts))] if kind == "names" else list(range(len(pts)))
    assert listed(neighbours.nearest(frame(spark, pts, keys), "key", "xy", 9)) == brute(pts, keys, 9)


def test_few_null_and_no_points(spark):
    pts = [[0.0, 0.0], [1.0, 0.0], [0.0, 3.0]]
    df = frame(spark, [*pts, None, [float("nan"), 1.0]], [0, 1, 2, 3, 4])
    assert listed(neighbours.nearest(df, "key", "xy", 7)) == {0: [1, 2], 1: [0, 2], 2: [0, 1]}
    assert neighbours.nearest(df.limit(0), "key", "xy", 7).count() == 0
    with pytest.raises(ValueError):
        neighbours.nearest(df, "key", "xy", 1000)


def test_queries_against_an_index(spark, small_cells):
    rng = np.random.default_rng(5)
    pts, new = rng.normal(size=(300, 3)), rng.normal(size=(60, 3)) * 3
    cells = neighbours.index(frame(spark, pts, list(range(300))), "key", "xy", 8)
    got = listed(neighbours.nearest_of(cells, frame(spark, new, list(range(1000, 1060))), "key", "xy", 8))
    assert got == brute(pts, list(range(300)), 8, list(zip(range(1000, 1060), new, strict=True)))


def test_places_need_no_group_in_one_task(spark):
    rows = [(g, i * 7 % 101) for g in ("a", "b", None) for i in range(101)]
    df = spark.createDataFrame(rows, "g string, v int").repartition(6)
    got = places(df, ["g"], ["v"])
    assert {(r.g, r.v, r.place) for r in got.collect()} == {(g, v, v) for g in ("a", "b", None) for v in range(101)}


# ---------------------------------------------------------------- layout
def trustworthiness(x, y, k):
    n = len(x)
    d = ((x[:, None] - x[None]) ** 2).sum(-1)
    np.fill_diagonal(d, -1)
    rank = d.argsort(1, kind="stable").argsort(1)
    e = ((y[:, None] - y[None]) ** 2).sum(-1)
    np.fill_diagonal(e, np.inf)
    r = np.take_along_axis(rank, e.argsort(1)[:, :k], 1)
    return 1 - 2 / (n * k * (2 * n - 3 * k - 1)) * np.maximum(r - k, 0).sum()


def test_curve_and_bandwidths():
    a, b = layout.curve(0.1)
    assert abs(a - 1.577) < 0.01 and abs(b - 0.895) < 0.01  # the published values of these settings
    d = np.sort(np.random.default_rng(1).random((20, 15)), axis=1)
    w = layout.bandwidths(d, np.full(20, 15))
    assert np.allclose(w.sum(1), np.log2(15), atol=1e-3) and np.allclose(w[:, 0], 1)


def rolled(n=500):
    rng = np.random.default_rng(7)
    t = rng.uniform(1.5 * np.pi, 4.5 * np.pi, n)
    return np.stack([t * np.cos(t), t * np.sin(t), rng.uniform(0, 20, n)], 1)


def test_layout_keeps_neighbours_and_ignores_partitions(spark):
    x = rolled()
    a = layout.layout(frame(spark, x, list(range(len(x))), 3), "key", "xy", 15, epochs=100).orderBy("key").toPandas()
    b = layout.layout(frame(spark, x[::-1], list(range(len(x)))[::-1], 7), "key", "xy", 15, epochs=100).orderBy("key").toPandas()
    assert (a.to_numpy() == b.to_numpy()).all()
    flat = x - x.mean(0)
    linear = flat @ np.linalg.svd(flat, full_matrices=False)[2][:2].T
    t = trustworthiness(x, a[["x", "y"]].to_numpy(), 15)
    assert t > 0.97 > trustworthiness(x, linear, 15)


def test_layout_in_blocks_is_as_good(spark, monkeypatch):
    monkeypatch.setattr(layout, "BLOCK", 100)
    monkeypatch.setattr(layout, "NEGATIVES", 200)
    x = rolled()
    y = layout.layout(frame(spark, x, list(range(len(x)))), "key", "xy", 15, epochs=100).orderBy("key").toPandas()
    assert trustworthiness(x, y[["x", "y"]].to_numpy(), 15) > 0.95
    assert layout.layout(frame(spark, [], []), "key", "xy").count() == 0


def test_saved_layout_places_new_points(spark, tmp_path):
    rng = np.random.default_rng(3)
    centre = np.array([[0, 0, 0], [9, 0, 0], [0, 9, 9]], float)
    x = np.concatenate([c + rng.normal(size=(80, 3)) * 0.3 for c in centre])
    df = spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(x)], "key long, a double, b double, c double")
    made = spark.createDataFrame([(i, float(10 * (i // 80)), float(i % 80) / 80) for i in range(240)], "key long, x double, y double")
    layout.save(df, "key", made, ["a", "b", "c"], [0.0] * 3, [1.0, 2.0, 1.0], f"{tmp_path}/m", k=10)
    saved = layout.load(spark, f"{tmp_path}/m")
    own = layout.place_new(df, "key", saved).join(made.withColumnsRenamed({"x": "ox", "y": "oy"}), "key")
    assert own.count() == 240 and own.filter("abs(x - ox) > 1e-9 or abs(y - oy) > 1e-9").count() == 0
    new = spark.createDataFrame([(i, *map(float, centre[i % 3] + rng.normal(size=3) * 0.3)) for i in range(30)], "key long, a double, b double, c double")
    assert {(r.key, round(r.x)) for r in layout.place_new(new, "key", saved).collect()} == {(i, 10 * (i % 3)) for i in range(30)}
    with pytest.raises(layout.NotUsable):
        layout.place_new(new.drop("b"), "key", saved)
    with pytest.raises(layout.NotUsable):
        layout.load(spark, f"{tmp_path}/none")
    spark.createDataFrame([('{"version": 0}',)], "model string").write.text(f"{tmp_path}/old/meta")
    with pytest.raises(layout.NotUsable):
        layout.load(spark, f"{tmp_path}/old")
    assert new.select(F.count("*")).first()[0] == 30
