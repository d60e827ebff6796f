"""Distribution tails, transforms and the valley on numbers that are known."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from gatefold.functions import tails
from gatefold.operators import transforms
from gatefold.operators.valley import Valley, density_valley, setting_grid, valley_numpy


def test_tails():
    assert tails.normal_two_sided(1.959963984540054) == pytest.approx(0.05, abs=1e-12)
    assert tails.chi2_sf(5.991464547107979, 2) == pytest.approx(0.05, abs=1e-10)
    assert tails.chi2_sf(0, 3) == 1.0
    assert tails.f_sf(5.317655071578714, 1, 8) == pytest.approx(0.05, abs=1e-9)
    assert tails.t_two_sided(2.306004135204166, 8) == pytest.approx(0.05, abs=1e-9)


def test_tail_columns(spark):
    r = spark.createDataFrame([(1.96, 5.99, 2.0), (None, float("nan"), None)], "z double, x double, d double").select(tails.p_normal(F.col("z")).alias("a"), tails.p_chi2(F.col("x"), F.col("d")).alias("b"), tails.normal_tail_expr(F.col("z")).alias("c")).collect()
    assert r[0].a == pytest.approx(0.05, abs=1e-4) and r[0].b == pytest.approx(0.05, abs=1e-4) and r[0].c == pytest.approx(r[0].a, abs=1e-6)
    assert r[1].a is None and r[1].b is None


def test_arcsinh_keeps_large_negatives(spark):
    x = [-1e9, -1e7, -5.0, 0.0, 5.0, 1e7, 1e9]
    t = transforms.Transform("arcsinh", 150.0)
    rows = spark.createDataFrame([(v,) for v in x], "x double").select("x", t.forward("x").alias("y")).withColumn("back", t.inverse("y")).collect()
    for r in rows:
        assert r.y == pytest.approx(math.asinh(r.x / 150), rel=1e-12) and r.back == pytest.approx(r.x, rel=1e-9, abs=1e-9)


def test_logicle_is_monotone_and_inverts(spark):
    p = transforms.Logicle(w=0.7, t=20_000.0)
    x = np.linspace(-500, 20_000, 400)
    y = p.forward_array(x)
    assert (np.diff(y) > 0).all() and np.allclose(p.inverse_array(y), x, atol=1e-6)
    assert p.inverse_array(np.array([p.m]))[0] == pytest.approx(p.t, rel=1e-6)
    t = transforms.Transform("logicle", logicle={"m": p})
    got = spark.createDataFrame([(float(v),) for v in x], "x double").select(t.forward("x", "m").alias("y")).toPandas().y.to_numpy()
    assert np.abs(got - y).max() < 2e-3


def test_unknown_transform():
    with pytest.raises(ValueError):
        transforms.Transform("sqrt")


@pytest.mark.parametrize("n", [101, 1000, 5003])
@pytest.mark.parametrize("c", [1.0, 7.3, 150.0])
def test_order_statistics_carry_the_quartile_range(spark, n, c):
    """The quartile range of asinh(x / c) follows from four order statistics, whatever c is."""
    x = np.random.default_rng(n).exponential(200, n)
    if c == 1.0:
        df = spark.createDataFrame([("s", float(v)) for v in x], "s string, v double")
        r = transforms.cofactor_quartiles(df, ["s"], "v").first()
        lo, hi = np.quantile(x, [0.05, 0.60])
        b = np.sort(x[(x > lo) & (x < hi)])
        assert r.n == len(b)
        h = (len(b) - 1) * 0.25
        assert (r.q25_lo, r.q25_hi) == (b[math.floor(h)], b[math.ceil(h)])
    lo, hi = np.quantile(x, [0.05, 0.60])
    b = np.sort(x[(x > lo) & (x < hi)])
    at = lambda p: (b[math.floor((len(b) - 1) * p)], b[math.ceil((len(b) - 1) * p)], (len(b) - 1) * p % 1)
    q = [(1 - w) * math.asinh(u / c) + w * math.asinh(v / c) for u, v, w in (at(0.25), at(0.75))]
    assert q[1] - q[0] == pytest.approx(np.subtract(*np.quantile(np.arcsinh(b / c), [0.75, 0.25])), abs=1e-12)


def test_cofactor_grows_with_scale():
    x = np.abs(np.random.default_rng(1).normal(0, 250, 5000))
    q = lambda v: (tuple(np.quantile(v, [0.25, 0.25])), tuple(np.quantile(v, [0.75, 0.75])))
    a, b = transforms.solve_cofactor(5000, *q(x)), transforms.solve_cofactor(5000, *q(4 * x))
    assert b == pytest.approx(4 * a, rel=1e-6)
    assert transforms.solve_cofactor(99, *q(x)) is None
    assert transforms.pool_cofactor({"a": 100.0, "b": 110.0, "c": 900.0}) == (110.0, True)


def test_compensation(spark):
    df = spark.createDataFrame([(100.0, 15.0, 1.0)], "a double, b double, c double")
    assert transforms.compensate(df, ["a", "b"], [[1.0, 0.0], [0.0, 1.0]]).first() == df.first()
    r = transforms.compensate(df, ["a", "b"], [[1.0, 0.1], [0.0, 1.0]]).first()
    assert (r.a, r.b, r.c) == (100.0, pytest.approx(5.0), 1.0)
    for bad in ([[1.0, 1.0], [1.0, 1.0]], [[1.0, 0.0]]):
        assert transforms.compensate(df, ["a", "b"], bad).first() == df.first()


def test_robust_scaling_drops_constants(spark):
    df = spark.createDataFrame([(float(i), 1.0, None if i == 0 else float(i)) for i in range(11)], "x double, k double, y double")
    out = transforms.scale_features(df, ["x", "k", "y"])
    assert "k_z" not in out.columns
    r = {x.x: x for x in out.collect()}
    assert r[5.0].x_z == 0 and r[8.0].x_z == pytest.approx(3 / (1.4826 * 3)) and r[0.0].y_z == 0


def test_quantile_alignment_removes_a_shift_and_keeps_order(spark):
    rng = np.random.default_rng(4)
    rows = [("a", float(v)) for v in rng.normal(0, 1, 1500)] + [("b", float(v)) for v in rng.normal(2.5, 1, 1500)] + [("c", 9.0)]
    out = transforms.align_quantiles(spark.createDataFrame(rows, "batch string, x double"), "x", "batch", "y").toPandas()
    med = out.groupby("batch").y.median()
    assert abs(med["a"] - med["b"]) < 0.1 and med["c"] == 9.0
    for b in "ab":
        d = out[out.batch == b].sort_values("x")
        assert (np.diff(d.y) >= -1e-9).all()


def bimodal(gap: float, n: int = 8000, sd: float = 0.6, seed: int = 3) -> np.ndarray:
    rng = np.random.default_rng(seed)
    return np.concatenate([rng.normal(0, sd, n), rng.normal(gap, sd, n)])


def test_valley_in_spark_equals_numpy(spark):
    groups = {"deep": bimodal(7), "mid": bimodal(4), "flat": np.random.default_rng(1).uniform(0, 1, 4000), "few": np.arange(100.0), "same": np.ones(1000)}
    df = spark.createDataFrame([(g, float(v)) for g, x in groups.items() for v in [*x, float("nan")]], "g string, x double")
    got = {r.g: r for r in density_valley(df, ["g"], "x").collect()}
    for g, x in groups.items():
        cut, rel = valley_numpy(x)
        if cut is None:
            assert got[g].cut is None and got[g].reason
        else:
            assert got[g].cut == pytest.approx(cut, abs=1e-6) and got[g].rel_depth == pytest.approx(rel, abs=1e-9)
    assert 2.5 < got["deep"].cut < 4.5 and 1 < got["mid"].cut < 3
    assert got["few"].reason.startswith("fewer") and got["same"].reason == "degenerate range"


def test_valley_finds_a_small_upper_mode():
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(0, 0.5, 19_000), rng.normal(5, 0.4, 1000)])
    assert 1.5 < valley_numpy(x)[0] < 4.5


def test_setting_grid():
    g = setting_grid()
    assert len(set(g)) == 27 and all(isinstance(s, Valley) for s in g)


@pytest.mark.parametrize("kind", ["spread", "ties", "signs", "outliers"])
def test_quantiles_are_exact(spark, kind):
    from gatefold.functions.quantiles import order_bin, quantiles

    rng = np.random.default_rng(3)
    make = {
        "spread": lambda n: rng.lognormal(3, 2, n), "ties": lambda n: rng.integers(0, 7, n).astype(float), "signs": lambda n: np.concatenate([rng.normal(0, 1, n - 3), [0.0, -0.0, 1e-300]]),
        "outliers": lambda n: np.concatenate([rng.normal(5, 1e-6, n - 2), [1e12, -1e12]]),
    }[kind]
    data = {g: make(n) for g, n in (("a", 1), ("b", 2), ("c", 1001), ("d", 5000)) if n > 3 or kind in ("spread", "ties")}
    rows = [(g, float(v)) for g, x in data.items() for v in x] + [("a", None), ("c", float("nan")), ("e", None)]
    df = spark.createDataFrame(rows, "g string, x double").repartition(5)
    probs = [0.0, 0.001, 0.25, 0.5, 0.9, 0.999, 1.0]
    got = {r.g: r for r in quantiles(df, ["g"], "x", probs).collect()}
    assert set(got) == set(data)
    for g, x in data.items():
        assert got[g].n == len(x) and np.allclose(got[g].q, np.quantile(x, probs), rtol=1e-12, atol=1e-300)
    whole = np.concatenate(list(data.values()))
    assert np.allclose(quantiles(df, [], "x", [0.5]).first().q, [np.quantile(whole, 0.5)], rtol=1e-12)
    ordered = [r.b for r in df.filter("x is not null and not isnan(x)").select("x", order_bin(F.col("x")).alias("b")).orderBy("x").collect()]
    assert ordered == sorted(ordered)


def test_pooled_scales_follow_the_given_order(spark):
    assert transforms.spaced(list("abcdefghij"), 4) == ["a", "d", "g", "j"]
    by = {"b": 300.0, "a": 100.0, "c": 200.0}
    assert transforms.pool_cofactor(by, 2)[0] == 150.0 and transforms.pool_cofactor(by, 2, order=["b", "a", "c"])[0] == 250.0
    rows = [(s, "m", v * k) for k, s in enumerate("abc", 1) for v in (-10.0, -5.0, 100.0, 2000.0)]
    p = transforms.pooled_logicle(spark.createDataFrame(rows, "sample_id string, marker string, value double"), ["c", "a", "b"], max_samples=2).first()
    assert p.t == 6000.0  # c and b


def test_rank_sums_from_counts_equal_rank_sums(spark):
    from gatefold.operators import ranks

    rng = np.random.default_rng(1)
    rows = [(k, g, float(v)) for k in "xy" for g, n in (("a", 40), ("b", 30), ("c", 25)) for v in rng.integers(-4, 5, n) * 1.5 + (g == "b")]
    df = spark.createDataFrame(rows, "k string, g string, v double")
    one = {(r.k, r.comparison): r for r in ranks.rank_sum(ranks.against_reference(df, ["k"], "g", "v"), ["k"], "v").collect()}
    two = {(r.k, r.comparison): r for r in ranks.rank_sum_counts(df, ["k"], "g", "v").collect()}
    assert set(one) == set(two) and len(one) == 4
    for key, r in one.items():
        for c in ("n_reference", "n_comparison", "w", "z", "cliffs_delta"):
            assert two[key][c] == pytest.approx(r[c], rel=1e-12)
