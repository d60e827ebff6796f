"""Gates, populations, statistics, diagnostics and learning on planted data."""

from __future__ import annotations

import re

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from gatefold.operators import clusters, compositional, conformance, diagnostics, embedding, gate_learning, gates, polygons, populations, ranks, sampling, thresholds, uncertainty
from gatefold.operators.valley import INTERMEDIATE, setting_grid, valley_numpy

MARKERS, POPS = ["CD3", "CD4", "CD8", "CD19"], ["CD4 T", "CD8 T", "B"]
SPEC = {"T": {"CD3": "above"}, "CD4 T": {"CD3": "above", "CD4": "above", "CD8": "below"}, "lymph": {"any_of": {"CD3": "above", "CD19": "above"}}, "mid": {"CD4": "intermediate"}, "gone": {"CD99": "above"}}


@pytest.fixture(scope="module")
def groups(spark):
    return spark.createDataFrame([(f"S{i:02}", "HC" if i < 6 else "S1" if i < 11 else "S2") for i in range(16)], "sample_id string, group string").cache()


@pytest.fixture(scope="module")
def mfi(spark):
    rng = np.random.default_rng(7)
    rows = []
    for i in range(16):
        for p in POPS:
            for m in MARKERS:
                up = 1.5 if (p, m) == ("CD4 T", "CD4") and 6 <= i < 11 else 0.0
                rows.append((f"S{i:02}", p, m, 500, float(2 + up + rng.normal(0, 0.25)), float(50 + 12 * up + rng.normal(0, 4)), False, "pass"))
    rows.append(("S99", "B", "CD3", 500, 99.0, 99.0, True, "control"))
    return spark.createDataFrame(rows, "sample_id string, population string, marker string, n_cells long, median_asinh double, pct_positive double, is_control boolean, qc_status string")


# ---------------------------------------------------------------- gates
def test_gate_chain_on_planted_events(spark):
    rng = np.random.default_rng(3)
    rows = []
    for s in ("A", "B"):
        n = 6000
        debris = rng.random(n) < 0.4
        fsc = np.where(debris, rng.lognormal(8, 0.25, n), rng.lognormal(11, 0.15, n))
        ssc = rng.lognormal(9, 0.3, n)
        doublet = ~debris & (rng.random(n) < 0.1)
        h = fsc * np.where(doublet, 0.3, 0.56) * rng.normal(1, 0.01, n)
        dead = rng.random(n) < 0.15
        live = np.where(dead, rng.normal(6, 0.4, n), rng.normal(1, 0.4, n))
        cd45 = np.where(rng.random(n) < 0.8, rng.normal(5, 0.4, n), rng.normal(1, 0.4, n))
        rows += [(s, *map(float, v)) for v in zip(fsc, ssc, h, live, cd45, strict=True)]
    df = spark.createDataFrame(rows, ["sample_id", "FSC-A", "SSC-A", "FSC-H", "Zombie", "CD45"])
    assert gates.viability_marker(["CD3", "Zombie"]) == "Zombie" and gates.viability_marker(["CD3"]) is None
    gated, used = gates.gate_events(df, viability="Zombie")
    n = {(r.sample_id, r.gate): r for r in gates.gate_counts(gated).collect()}
    for s in ("A", "B"):
        assert n[s, "all_events"]["count"] == 6000 and n[s, "all_events"].pct_of_parent == 100
        assert 55 < n[s, "leukocytes"].pct_of_all < 62
        assert 86 < n[s, "single_cells"].pct_of_parent < 92
        assert 82 < n[s, "live_cells"].pct_of_parent < 88
        assert 76 < n[s, "cd45_pos"].pct_of_parent < 84
    assert {r.source for r in used.collect()} == {"valley"}


def test_missing_channels_pass(spark):
    df = spark.createDataFrame([("A", float(10 ** (3 + (i % 50) / 20)), float(i % 37 + 1)) for i in range(800)], ["sample_id", "FSC-A", "SSC-A"])
    gated, used = gates.gate_events(df)
    assert used is None and gated.filter("leukocytes <> cd45_pos").count() == 0


@pytest.mark.parametrize(("declared", "source", "pct", "force", "status"), [
    (True, "valley", 90.0, True, "control"), (False, "valley", 90.0, False, "pass"), (False, "quantile_fallback", 90.0, False, "failed"), (None, "quantile_fallback", 90.0, False, "control"),
    (False, "quantile_fallback", 90.0, True, "pass"), (None, "quantile_fallback", 90.0, True, "control"), (False, "skipped", None, False, "pass"), (False, "valley", 1.0, False, "failed"), (None, "valley", None, False, "control"),
])
def test_staining_verdict(spark, declared, source, pct, force, status):
    d = spark.createDataFrame([(declared, source, pct)], "is_control boolean, cd45_source string, pct_cd45_of_live double")
    r = gates.staining_verdict(d, force=force).first()
    assert r.qc_status == status and r.included == (status == "pass")


def test_qc_pass_without_columns(spark, mfi):
    assert gates.qc_pass(mfi).count() == mfi.count() - 1
    assert gates.qc_pass(mfi.drop("is_control", "qc_status")).count() == mfi.count()


# ---------------------------------------------------------------- thresholds
def test_threshold_sources(spark):
    rng = np.random.default_rng(2)
    two = np.concatenate([rng.normal(0, 0.5, 3000), rng.normal(5, 0.5, 3000)])
    one = rng.exponential(1, 3000)
    df = spark.createDataFrame([("two", float(v)) for v in two] + [("one", float(v)) for v in one], "sample_id string, x double")
    get = lambda **k: {r.sample_id: r for r in thresholds.resolve(df, ["sample_id"], "x", **k).collect()}
    r = get()
    assert r["two"].source == "valley" and 1 < r["two"].threshold < 4
    assert r["one"].source == "quantile_fallback" and r["one"].needs_review and r["one"].threshold == pytest.approx(np.quantile(one, 0.9))
    control = spark.createDataFrame([(float(v),) for v in rng.normal(6, 0.1, 500)], "x double")
    r = get(control=control)
    assert r["two"].source == "control_q995_valley_rejected" and r["one"].source == "control_q995" and r["one"].threshold > 6
    assert get(control=control.limit(100))["one"].source == "quantile_fallback"
    r = get(config=spark.createDataFrame([("two", 1.25)], "sample_id string, cfg_value double"))
    assert (r["two"].threshold, r["two"].source) == (1.25, "config")


def test_peer_check(spark):
    rows = [(f"S{i}", "m", 2.0 + 0.01 * i, "valley") for i in range(6)] + [("S9", "m", 9.0, "valley"), ("a", "k", 1.0, "valley"), ("b", "k", 5.0, "valley"), ("c", "k", None, "valley")]
    t = thresholds.peer_check(spark.createDataFrame(rows, "sample_id string, marker string, threshold double, source string"), ["marker"])
    got = {(r.marker, r.sample_id): r for r in t.collect()}
    assert [k for k, r in got.items() if r.scale_outlier] == [("m", "S9")]
    assert got["k", "a"].robust_z is None and got["k", "c"].peer_median is None
    q = thresholds.scale_qc(t, ["marker"]).collect()
    assert [(r.marker, r.n_outlier) for r in q] == [("m", 1)]


# ---------------------------------------------------------------- populations
@pytest.fixture(scope="module")
def scored(spark):
    ev = spark.createDataFrame([("A", True, 3.0, 3.0, 0.0, 0.0), ("A", True, 3.0, 0.0, 3.0, 0.0), ("A", True, 0.0, 0.0, 0.0, 3.0), ("A", True, 0.0, 9.0, 0.0, 0.0), ("A", False, 3.0, 3.0, 0.0, 0.0), ("B", True, 3.0, 3.0, None, 0.0)], "sample_id string, parent boolean, CD3 double, CD4 double, CD8 double, CD19 double")
    thr = spark.createDataFrame([(s, m, 1.0) for s in "AB" for m in MARKERS if (s, m) != ("B", "CD8")], "sample_id string, marker string, threshold double")
    hi = spark.createDataFrame([("A", "CD4", 5.0)], "sample_id string, marker string, threshold double")
    return populations.score(ev, thr, SPEC, "parent", bounds=hi), thr, hi, ev


def test_population_scoring(scored):
    s, thr, hi, ev = scored
    rows = s.orderBy("sample_id", F.desc("CD3"), F.desc("CD4")).collect()
    lab = [(r.sample_id, r.population_label) for r in rows]
    assert ("A", "CD4 T") in lab and ("B", "T") in lab and ("A", None) in lab and ("A", populations.OTHER) in lab and ("A", "lymph") in lab
    a = [r for r in rows if r.sample_id == "A" and r.CD4 == 9.0][0]
    assert a["is_mid"] is False and a["is_gone"] is None
    b = [r for r in rows if r.sample_id == "B"][0]
    assert b["is_CD4 T"] is None and b["is_mid"] is None
    u = {(r.sample_id, r.population): r.reason for r in populations.unavailable(thr, SPEC, ev.columns, bounds=hi).collect()}
    assert u == {("A", "gone"): "CD99 not in panel", ("B", "gone"): "CD99 not in panel", ("B", "CD4 T"): "no threshold for CD8", ("B", "mid"): "no upper bound for CD4"}


def test_frequencies_and_ratios(scored):
    s = scored[0]
    f = populations.frequencies(s, list(SPEC), "parent")
    got = {(r.sample_id, r.population): (r["count"], r.pct_of_cd45_pos) for r in f.collect()}
    assert got["A", "T"] == (2, 50.0) and got["A", "CD4 T"] == (1, 25.0) and ("B", "CD4 T") not in got
    r = {x.sample_id: x for x in populations.ratios(f, {"q": ("T", "mid"), "z": ("T", "CD4 T")}).collect() if x.ratio == "q"}
    assert r["A"].value == 2.0 and "B" not in r


def test_unknown_direction_is_an_error():
    with pytest.raises(ValueError):
        populations.requirements({"CD3": "sideways"})
    with pytest.raises(ValueError):
        populations.requirements({"any_of": {"CD3": "intermediate"}})


def test_blocks_and_positive_markers():
    assert populations.block_populations({"require": "CD3"}, SPEC, list(SPEC)) == ["T", "CD4 T"]
    assert populations.block_populations({"populations": ["T", "x"]}, SPEC, list(SPEC)) == ["T"]
    assert populations.block_populations({"exclude": ["T"]}, SPEC, list(SPEC))[0] == "CD4 T"
    assert ("lymph", "CD19") in populations.positive_markers(SPEC)


# ---------------------------------------------------------------- statistics
def test_planted_state_shift(mfi, groups):
    t = diagnostics.differential_state(gates.qc_pass(mfi), groups, reference="HC").toPandas()
    hit = t[(t.population == "CD4 T") & (t.marker == "CD4") & (t.comparison == "S1") & (t.measure == "median_asinh")].iloc[0]
    assert hit.cliffs_delta == 1 and hit.p_value < 0.01 and 1 < hit.delta_median < 2 and (hit.n_reference, hit.n_comparison) == (6, 5)
    assert t[t.measure == "median_asinh"].sort_values("p_value").iloc[0].marker == "CD4"
    assert not t.population.isna().any() and 99.0 not in t.median_reference.to_numpy()
    one = t[t.measure == "pct_positive"].sort_values("p_value")
    want = np.minimum.accumulate((one.p_value * len(one) / np.arange(1, len(one) + 1))[::-1])[::-1].clip(upper=1)
    assert np.allclose(one.p_adj_BH, want)


def test_rank_sum_by_hand(spark):
    a, b = [1.0, 2.0, 2.0, 5.0], [2.0, 6.0, 7.0]
    df = spark.createDataFrame([("r", v) for v in a] + [("s", v) for v in b], "g string, v double")
    r = ranks.rank_sum(ranks.against_reference(df, [], "g", "v", "r"), [], "v").first()
    delta = sum((y > x) - (y < x) for x in a for y in b) / 12
    assert r.cliffs_delta == pytest.approx(delta) and (r.n_reference, r.n_comparison) == (4, 3)
    u = sum((x > y) + 0.5 * (x == y) for x in a for y in b)
    assert r.w == u
    var = 12 / 12 * (8 - (27 - 3) / 42)
    assert r.z == pytest.approx((u - 6 + 0.5) / var**0.5)


def test_kruskal_of_two_groups_is_the_squared_rank_sum(spark):
    df = spark.createDataFrame([("r", float(v)) for v in (1, 4, 6, 8)] + [("s", float(v)) for v in (2, 9, 11)], "g string, v double")
    h = ranks.kruskal(df, [], "g", "v").first().h
    r = ranks.rank_sum(ranks.against_reference(df, [], "g", "v"), [], "v").first()
    assert h == pytest.approx(((r.w - 6) ** 2) / (12 / 12 * 8))


def test_paired_comparison_drops_incomplete_pairs(spark):
    rows = [(f"{p}{c}", "B", 10.0 + p + (3 if c == "post" else 0)) for p in range(8) for c in ("pre", "post") if (p, c) != (0, "post")]
    pairs = [(f"{p}{c}", f"P{p}", c) for p in range(8) for c in ("pre", "post")]
    t = ranks.compare_paired(spark.createDataFrame(rows, "sample_id string, population string, v double"), spark.createDataFrame(pairs, "sample_id string, pair string, condition string"), "v", reference="pre").first()
    assert (t.n_pairs, t.n_incomplete_pairs_dropped, t.median_paired_difference) == (7, 1, 3.0)
    assert t.rank_biserial == 1.0 and t.p_value < 0.05


def test_spearman_of_a_monotone_relation(spark):
    r = ranks.spearman_p(ranks.spearman(spark.createDataFrame([("k", float(i), float(i) ** 3) for i in range(10)], "k string, x double, y double"), ["k"], "x", "y")).first()
    assert r.rho == pytest.approx(1) and r.p_value == pytest.approx(0, abs=1e-6)


def test_clr_sums_to_zero_and_keeps_zeros(spark):
    rows = [("a", "p", 60.0), ("a", "q", 40.0), ("a", "r", 0.0), ("b", "p", 10.0), ("b", "q", 90.0), ("c", "p", 5.0)]
    out = compositional.clr(spark.createDataFrame(rows, "sample_id string, population string, pct_of_cd45_pos double")).toPandas()
    assert set(out.sample_id) == {"a", "b"} and np.allclose(out.groupby("sample_id").clr.sum(), 0)
    d = 0.65 * 5
    x = np.log([60 * (1 - d / 100), 40 * (1 - d / 100), d])
    assert np.allclose(out[out.sample_id == "a"].sort_values("population").clr, x - x.mean())


def test_concordance_verdicts(spark):
    f = lambda rows: spark.createDataFrame(rows, "population string, comparison string, p_value double, median_reference double, median_comparison double, cliffs_delta double")
    raw = f([(p, "s", v, 1.0, 2.0, 0.5) for p, v in zip("abcd", (0.01, 0.01, 0.5, 0.5), strict=True)])
    clr = f([(p, "s", v, 1.0, 2.0, 0.5) for p, v in zip("abcd", (0.01, 0.5, 0.01, None), strict=True)])
    v = {r.population: r.verdict.split("_")[0] for r in compositional.concordance(raw, clr).collect()}
    assert v == {"a": "robust", "b": "raw", "c": "clr", "d": "not"}


def test_confounding_needs_both_facts(spark, groups):
    rng = np.random.default_rng(19)
    n = 16
    age = [40 + rng.normal(0, 2) if i < 6 else 12 + rng.normal(0, 2) for i in range(n)]
    cov = spark.createDataFrame([(f"S{i:02}", float(age[i]), "FM"[i % 2]) for i in range(n)], "sample_id string, age double, sex string")
    freq = spark.createDataFrame([(f"S{i:02}", p, float(age[i] + rng.normal(0, 0.5)) if p == "B" else float(rng.normal())) for i in range(n) for p in ("B", "T")], "sample_id string, population string, pct_of_cd45_pos double")
    t = {(r.covariate, r.population): r for r in compositional.confounding(freq, cov, groups, ["age", "sex"]).collect()}
    assert t["age", "B"].confounder_risk == "HIGH" and t["age", "T"].confounder_risk == "low" and t["sex", "B"].confounder_risk == "low"
    a = {r.population: r for r in compositional.rank_ancova(freq, cov, groups, ["sex"]).collect()}
    assert a["B"].status == "fitted" and a["B"].p_group_adjusted < 0.01 < a["T"].p_group_adjusted


# ---------------------------------------------------------------- diagnostics
def test_drift_flags_the_planted_marker(spark, groups):
    rng = np.random.default_rng(15)
    rows = [(f"S{i:02}", m, float(1.5 + rng.normal(0, 0.02) + (0.9 if m == "CD4" and i >= 6 else 0)), "valley") for i in range(16) for m in MARKERS]
    t = {r.marker: r for r in diagnostics.threshold_drift(spark.createDataFrame(rows, "sample_id string, marker string, threshold double, source string"), groups, SPEC).collect()}
    assert t["CD4"].drift_flag == "FLAGGED" and t["CD4"].gap_over_sd > 10 and all(r.gap_over_sd < 5 for m, r in t.items() if m != "CD4")
    assert t["CD4"].populations_using_this_marker == "CD4 T; mid" and t["CD4"].dominant_source == "valley"


def test_cramers_v_bounds(spark):
    same = spark.createDataFrame([(i % 3, i % 3) for i in range(90)], "a int, b int")
    free = spark.createDataFrame([(i % 3, i // 3 % 3) for i in range(90)], "a int, b int")
    assert compositional.cramers_v(same, "a", "b").first().v == pytest.approx(1)
    assert compositional.cramers_v(free, "a", "b").first().v == pytest.approx(0, abs=1e-9)
    assert compositional.cramers_v(same.withColumn("b", F.lit(1)), "a", "b").first().v is None


def test_batch_correction_refuses_confounded_batches(spark):
    rng = np.random.default_rng(1)
    rows = [("x" if i % 2 else "y", "g" if i % 2 else "h", "u" if i // 2 % 2 else "v", float(rng.normal(3 * (i % 2), 1))) for i in range(400)]
    df = spark.createDataFrame(rows, "batch string, grp string, other string, m double")
    same, why = diagnostics.correct_batch(df, "batch", "grp", ["m"])
    assert same is df and why.startswith("not corrected")
    assert diagnostics.correct_batch(df, "batch", "grp", ["m"], force=True)[1].endswith("(forced)")
    good, why = diagnostics.correct_batch(df, "batch", "other", ["m"])
    assert why.startswith("corrected")
    m = {r.batch: r.v for r in good.groupBy("batch").agg(F.percentile("m", F.lit(0.5)).alias("v")).collect()}
    assert abs(m["x"] - m["y"]) < 0.3


def test_lisi_bounds_and_batch_report(spark):
    rng = np.random.default_rng(2)
    pts = [(i, [float(rng.normal(8 * (i % 2), 0.5)), float(rng.normal())], "ab"[i % 2], "ab"[i // 2 % 2]) for i in range(240)]
    df = spark.createDataFrame(pts, "id long, xy array<double>, far string, mixed string")
    e = diagnostics.neighbours(df, "id", "xy", 15)
    assert e.count() == 240 * 15 and e.filter("id = neighbour").count() == 0
    assert {round(r.lisi, 6) for r in diagnostics.lisi(e, df, "id", "far").collect()} == {1.0}
    r, _ = diagnostics.batch_mixing(df, "id", "xy", "far", "mixed", k=15, n_perm=5)
    assert r.first().ilisi_observed_median == 1.0 and r.first().ilisi_null_median > 1.5
    assert diagnostics.batch_mixing(df.limit(20), "id", "xy", "far") is None


# ---------------------------------------------------------------- clusters and embedding
def test_agreement_names_undescribed_clusters(spark):
    rows = [(1, "B")] * 90 + [(1, "T")] * 10 + [(2, "Other CD45+")] * 50 + [(3, "T")] * 30 + [(3, "B")] * 30 + [(None, "B")]
    c, p = clusters.agreement(spark.createDataFrame(rows, "cluster int, population_label string"))
    got = {r.cluster: r for r in c.collect()}
    assert got[1].interpretation == "clean" and got[1].purity_pct == 90.0 and got[2].interpretation == "UNDESCRIBED" and got[3].interpretation == "mixed"
    assert {r.population: r.dominant_cluster for r in p.collect()} == {"B": 1, "T": 3, "Other CD45+": 2}


def test_composition_sums_to_100(spark):
    df = spark.createDataFrame([("a", "x")] * 10 + [("a", "y")] * 30 + [("b", "y")] * 5 + [(None, "x"), ("a", " ")], "population string, g string")
    t = clusters.composition(df, "g", "population").toPandas()
    assert np.allclose(t.groupby("population").pct.sum(), 100)


def test_som_is_deterministic_and_ordered_by_size(spark):
    rng = np.random.default_rng(6)
    rows = [(i, *map(float, rng.normal([0, 0] if i % 3 else [9, 9], 0.5))) for i in range(600)]
    df = spark.createDataFrame(rows, "id long, x double, y double")
    a = clusters.unsupervised(df, ["x", "y"], "id", 2, 4, 4)
    n = {r.cluster: r.n for r in a.groupBy("cluster").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert n == {1: 400, 2: 200}
    b = clusters.unsupervised(df.repartition(3), ["x", "y"], "id", 2, 4, 4)
    assert a.join(b.select("id", F.col("cluster").alias("c2")), "id").filter("cluster <> c2").count() == 0
    with pytest.raises(ValueError):
        clusters.unsupervised(df.limit(20), ["x", "y"], "id")


def test_silhouette_and_kmeans():
    rng = np.random.default_rng(0)
    x = np.vstack([rng.normal(c, 0.2, (60, 2)) for c in (0, 4, 8)])
    s = {k: clusters.silhouette(x, clusters.kmeans(x, k, 1)[1]) for k in (2, 3, 5)}
    assert max(s, key=s.get) == 3 and s[3] > 0.8


def test_embedding_model_round_trip(spark, tmp_path):
    rng = np.random.default_rng(1)
    df = spark.createDataFrame([(i, *map(float, rng.normal(0, [3, 1, 0.1]))) for i in range(300)], "id long, a double, b double, c double")
    m = embedding.fit_pca(df, ["a", "b", "c"])
    embedding.save_model(spark, m, f"{tmp_path}/m")
    again = embedding.load_model(spark, f"{tmp_path}/m")
    assert again == m and embedding.project(df, again).select("pc_1").first() == embedding.project(df, m).select("pc_1").first()
    with pytest.raises(embedding.MissingFeatures):
        embedding.project(df.drop("b"), m)


# ---------------------------------------------------------------- polygons and learning
def test_point_in_polygon_equals_numpy(spark):
    rng = np.random.default_rng(3)
    poly = np.array([[0.0, 0.0], [4.0, 0.5], [3.0, 4.0], [1.5, 1.5], [0.2, 3.0]])
    x = np.round(rng.uniform(-1, 5, (800, 2)), 2)
    df = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(x)] + [(-1, None, 1.0)], "id long, x double, y double")
    got = {r.id: r.h for r in df.select("id", polygons.inside("x", "y", poly.tolist()).alias("h")).collect()}
    want = gate_learning.in_polygon(x, poly)
    assert [got[i] for i in range(800)] == want.tolist() and got[-1] is False


def test_gradient_is_analytic():
    rng = np.random.default_rng(5)
    x, y = rng.uniform(0, 1, (150, 2)), (rng.random(150) < 0.4).astype(float)
    fixed = np.array([[1.0, 0], [0, 1], [-1, 0], [0, -1]])
    f = lambda t: gate_learning.objective(t, x, y, np.ones(150), fixed, np.array([0.5, 0.5]), 6.0, 0.4)
    t = rng.normal(size=12)
    num = np.array([(f(t + 1e-6 * e)[0] - f(t - 1e-6 * e)[0]) / 2e-6 for e in np.eye(12)])
    assert np.abs(num - f(t)[1]).max() < 1e-4


def test_halfplanes():
    w, b = np.array([[1, 0], [-1, 0], [0, 1], [0, -1.0]]), np.array([0, 1, 0, 1.0])
    assert sorted(map(tuple, np.abs(gate_learning.halfplane_polygon(w, b)).tolist())) == [(0, 0), (0, 1), (1, 0), (1, 1)]
    assert not len(gate_learning.halfplane_polygon(w[:2], b[:2]))


def test_gate_beats_the_bounding_box():
    rng = np.random.default_rng(7)
    x = rng.uniform(0, 2, (3000, 2))
    y = ((x.sum(1) > 1.6) & (np.abs(x[:, 0] - x[:, 1]) < 0.5)).astype(float)
    g = gate_learning.learn_gate(x, y)
    lo, hi = x[y > 0].min(0), x[y > 0].max(0)
    box = gate_learning.f1_of(((x >= lo) & (x <= hi)).all(1), y)[0]
    assert g["f1"] > 0.9 > box
    assert gate_learning.learn_gate(x, np.zeros(3000)) is None


def test_loss_is_clamped():
    """One far cell costs at most -log(clamp), and the gradient is that of the loss."""
    rng = np.random.default_rng(2)
    x, y = rng.normal(size=(60, 2)), (rng.random(60) < 0.5).astype(float)
    fixed = np.array([[1, 0], [0, 1], [-1, 0], [0, -1]], float)
    theta = np.concatenate([rng.normal(size=3), rng.normal(1, 0.2, 7)])
    of = lambda t, pts=x, lab=y, steep=9.0: gate_learning.objective(t, pts, lab, np.ones(len(lab)), fixed, np.zeros(2), steep, 0.7)
    loss, grad = of(theta)
    step = 1e-6 * np.eye(len(theta))
    assert np.allclose(grad, [(of(theta + s)[0] - of(theta - s)[0]) / 2e-6 for s in step], atol=1e-5)
    far = [gate_learning.objective(theta, np.array([[d, 0.0]]), np.ones(1), np.ones(1), fixed, np.zeros(2), 80.0, 0.0)[0] for d in (50.0, 5000.0)]
    assert far[0] == far[1] == pytest.approx(-np.log(gate_learning.CLAMP))


def test_strategies_of_several_labels_at_once(spark):
    rng = np.random.default_rng(12)
    rows = []
    for i in range(1500):
        k = i % 3
        centre = ([5, 1, 1, 1], [1, 5, 1, 5], [1, 1, 1, 1])[k]
        rows.append((i, "xyz"[k], *map(float, rng.normal(centre, 0.5))))
    df = spark.createDataFrame(rows, "key long, label string, A double, B double, C double, D double")
    both = gate_learning.explain_targets(df, "label", ["x", "y"], ["A", "B", "C", "D"], "key")
    for t in ("x", "y"):
        levels, report = both[t]
        alone = gate_learning.explain(df.withColumn("t", F.col("label") == t), "t", ["A", "B", "C", "D"], "key")
        assert levels and report[0]["f1"] > 0.97 and [r["marker_x"] for r in report] == [r["marker_x"] for r in alone[1]]
        assert report[0]["f1"] == pytest.approx(alone[1][0]["f1"], abs=0.03)


def test_learnable_keys_are_of_lines(spark, tmp_path):
    """Lines of equal values have keys of their own: a draw by values took all copies of a few hundred cells, and the gate missed targets."""
    from gatefold.plans.queries_gates import _learnable

    src = "/root/testdata/sf0.001"
    for t in ("supplier", "nation", "region"):
        spark.read.parquet(f"{src}/{t}.parquet").write.parquet(f"{tmp_path}/{t}.parquet")
    li = spark.read.parquet(f"{src}/lineitem.parquet")
    li.unionByName(li.withColumn("l_orderkey", F.col("l_orderkey") + 10_000_000)).write.parquet(f"{tmp_path}/lineitem.parquet")
    assert _learnable(spark, f"{tmp_path}").select("key").distinct().count() == 2 * li.count()


def test_draw_of_counted_groups_equals_mark_first(spark):
    df = spark.range(40_000).select(F.when(F.col("id") % 8 == 0, "b").when(F.col("id") < 20, "c").otherwise("a").alias("g"), "id")
    sizes = {r.g: r["count"] for r in df.groupBy("g").count().collect()}
    digest = sampling.draw_key(3, "id")
    for n in (40, 900):
        want = sampling.mark_first(df, ["g"], digest, "id", F.lit(n), "_in").filter("_in").select("g", "id")
        assert sorted(sampling.draw_counted(df, "g", sizes, digest, "id", n, "h").select("g", "id").collect()) == sorted(want.collect())
    # sizes that are too large make bounds too low at first
    many = {g: 50 * n for g, n in sizes.items()}
    assert sorted(sampling.draw_counted(df, "g", many, digest, "id", 40, "h").select("g", "id").collect()) == sorted(sampling.mark_first(df, ["g"], digest, "id", F.lit(40), "_in").filter("_in").select("g", "id").collect())


def test_strategy_labels_and_transfer(spark):
    rng = np.random.default_rng(11)
    rows = []
    for d in range(4):
        for i in range(500):
            t = i < 150
            rows.append((f"D{d}", d * 1000 + i, bool(t), *map(float, rng.normal([4, 3.5, 1] if t else [1, 1, 1], 0.5))))
    df = spark.createDataFrame(rows, "sample_id string, event_index long, target boolean, CD3 double, CD4 double, CD8 double")
    levels, report = gate_learning.explain(df, "target", ["CD3", "CD4", "CD8"], "event_index")
    assert levels and report[0]["f1"] > 0.95 and {levels[0].marker_x, levels[0].marker_y} == {"CD3", "CD4"}
    m = polygons.gate_metrics(polygons.apply_strategy(df, levels), "in_gate", "target").first()
    assert m.f1 > 0.95
    t = gate_learning.transferability(df, "target", ("CD3", "CD4"), "sample_id", "event_index").collect()
    assert len(t) == 4 and min(r.f1 for r in t) > 0.9
    assert gate_learning.transferability(df.filter("sample_id < 'D2'"), "target", ("CD3", "CD4"), "sample_id", "event_index") is None
    lab = df.select("sample_id", "event_index", F.when(F.col("target"), "x").alias("external_label")).orderBy(F.rand(1))
    j = gate_learning.join_labels(df, lab)
    assert j.filter("target <> (external_label is not null)").count() == 0
    with pytest.raises(ValueError):
        gate_learning.join_labels(df, lab.limit(50).filter("event_index < 0"))


def test_gating_ml(spark):
    import xml.etree.ElementTree as ET

    from gatefold.operators.transforms import Transform

    sq = ((0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0))
    rows = polygons.polygon_rows('CD4<T> & "cells"', [polygons.Level("a", "b", sq), polygons.Level("c", "d", sq)])
    lin = polygons.linear_table(spark.createDataFrame(rows, polygons.POLYGON), Transform("arcsinh", 150.0), 4)
    assert lin.count() == 32
    root = ET.fromstring(polygons.gating_ml([r.asDict() for r in lin.collect()]))
    ids = [(g.get(f"{{{polygons.GATING}}}id"), g.get(f"{{{polygons.GATING}}}parent_id")) for g in root]
    assert ids[1][1] == ids[0][0] and ids[0][1] is None and "<" not in ids[0][0]


# ---------------------------------------------------------------- uncertainty, conformance, sampling
def fine(x):
    """The histogram of one group as fine_histograms() counts it."""
    lo, hi = np.quantile(x, uncertainty.SPAN)
    width = (hi - lo) / uncertainty.FINE
    at = np.clip(np.floor((x - lo) / width), 0, uncertainty.FINE - 1).astype(int) if width > 0 else np.zeros(len(x), int)
    return np.bincount(at, minlength=uncertainty.FINE), lo, width


def test_shallow_valleys_are_less_certain():
    from test_functions import bimodal

    of = lambda x, source, **k: uncertainty.of_histogram(*fine(np.asarray(x, float)), source, **k)
    deep, shallow = (of(bimodal(g, 3000), "valley", boots=30) for g in (7, 2.6))
    assert (deep["u_sampling"] or 0) < (shallow["u_combined"] or 9)
    assert of(bimodal(5), "config")["u_combined"] == 0
    assert of(bimodal(5), "control_q995")["u_combined"] is None
    assert of(np.ones(10), "valley")["basis"].startswith("fewer")
    assert of(np.random.default_rng(1).normal(size=2000), "quantile_fallback", boots=30)["u_combined"] > 0


@pytest.mark.parametrize("cap", [20_000, 1000])
def test_bootstrap_of_counts_spreads_like_one_of_events(spark, cap):
    """Against resampled values, for a valley and for a quantile, with as many events a draw."""
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(0, 1, 3000), rng.normal(5, 1, 2500)])
    one = rng.normal(0, 1, 4000)
    m = min(cap, len(x))
    cuts = [c for c in (valley_numpy(rng.choice(x, m))[0] for _ in range(300)) if c is not None]
    high = [np.quantile(rng.choice(one, min(cap, len(one))), 0.9) for _ in range(300)]
    rows = [("S", "A", float(v)) for v in x] + [("S", "B", float(v)) for v in one] + [("S", "B", None)]
    thr = spark.createDataFrame([("S", "A", 2.0, "valley"), ("S", "B", 1.0, "quantile_fallback")], "sample_id string, marker string, threshold double, source string")
    got = {r.marker: r for r in uncertainty.thresholds(spark.createDataFrame(rows, "sample_id string, marker string, value double"), thr, boots=300, max_events=cap).collect()}
    assert got["A"].u_sampling == pytest.approx(np.std(cuts, ddof=1), rel=0.25)
    assert got["B"].u_sampling == pytest.approx(np.std(high, ddof=1), rel=0.25)
    other = [c for c in (valley_numpy(x, s)[0] for s in setting_grid()) if c is not None]
    assert got["A"].u_method == pytest.approx(np.std(other, ddof=1), abs=0.05)
    assert (got["A"].n_parent_events, got["B"].n_parent_events) == (5500, 4000)


def test_displaced_cuts_equal_scoring_again(spark):
    """An intermediate bound found again above each displaced cut, and a parent that moves, against numpy."""
    rng = np.random.default_rng(6)
    n = 9000
    a = np.concatenate([rng.normal(c, 0.5, n // 3) for c in (0, 4, 8)])
    b, p = rng.normal(2, 1, n), rng.normal(3, 1, n)
    live = rng.random(n) < 0.9
    t, u, cut, cut_u = {"A": 2.0, "B": 2.0}, {"A": 0.6, "B": 0.3}, 2.5, 0.2
    spec = {"mid": {"A": "intermediate", "B": "above"}, "up": {"A": "above"}, "low": {"B": "below"}}

    def pct(t, parent):
        hi = valley_numpy(a[parent & (a > t["A"])], INTERMEDIATE)[0]
        hits = {"mid": (a > t["A"]) & (a < hi) & (b > t["B"]), "up": a > t["A"], "low": b < t["B"]}
        return {k: 100 * (v & parent).sum() / parent.sum() for k, v in hits.items()}

    parent = live & (p > cut)
    want = {}
    for m, names in (("A", ("mid", "up")), ("B", ("mid", "low"))):
        lo, hi = (pct(t | {m: t[m] + s * u[m]}, parent) for s in (-1, 1))
        want |= {(k, m): abs(hi[k] - lo[k]) / 2 for k in names}
    lo, hi = (pct(t, live & (p > cut + s * cut_u)) for s in (-1, 1))
    want |= {(k, uncertainty.PARENT): abs(hi[k] - lo[k]) / 2 for k in spec}
    ev = spark.createDataFrame([("S", *map(float, r), bool(l), bool(q)) for *r, l, q in zip(a, b, p, live, parent, strict=True)], "sample_id string, A double, B double, P double, live boolean, parent boolean")
    thr = spark.createDataFrame([("S", m, t[m], u[m]) for m in "AB"], "sample_id string, marker string, threshold double, u_combined double")
    gate = spark.createDataFrame([("S", cut, cut_u)], "sample_id string, threshold double, u_combined double")
    bounds = populations.intermediate_bounds(ev, thr, spec, parent="parent")
    got = uncertainty.frequency_uncertainty(ev, thr, thr, spec, "parent", bounds=bounds, gate=("live", "P", gate))
    rows = {(r.population, r.term): r.u_pct_points for r in got.collect()}
    assert rows.keys() == want.keys() and all(rows[k] == pytest.approx(v, abs=1e-6) for k, v in want.items())
    none = thr.withColumn("u_combined", F.when(F.col("marker") == "A", F.col("u_combined")))
    miss = {r.population: (r.u_n_terms, r.n_terms_missing) for r in uncertainty.combine(uncertainty.frequency_uncertainty(ev, thr, none, spec, "parent", bounds=bounds, gate=("live", "P", gate)), missing=uncertainty.missing_terms(spec, none)).collect()}
    assert miss == {"mid": (2, 1), "up": (2, 0), "low": (1, 1)}


def test_displacement_without_a_bound_is_no_count_of_zero(spark):
    """The parent's lower cut lets cells in that fill the valley above A's cut: only one displacement finds a bound again."""
    rng = np.random.default_rng(7)
    a = np.concatenate([rng.normal(4, 0.5, 3000), rng.normal(8, 0.5, 3000), rng.normal(6, 1.2, 30_000), np.full(50, 5.0)])
    # the wide mode lies between the parent's displaced cut and its own, the last cells outside of every parent
    p = np.concatenate([np.full(6000, 3.0), np.full(30_000, 2.0), np.full(50, 1.0)])
    assert valley_numpy(a[:6000], INTERMEDIATE)[0] and valley_numpy(a[:36_000], INTERMEDIATE)[0] is None
    ev = spark.createDataFrame([("S", float(x), float(y), True, bool(y > 2.4)) for x, y in zip(a, p, strict=True)], "sample_id string, A double, P double, live boolean, parent boolean")
    thr = spark.createDataFrame([("S", "A", 0.5, 0.1)], "sample_id string, marker string, threshold double, u_combined double")
    gate = spark.createDataFrame([("S", 2.4, 0.5)], "sample_id string, threshold double, u_combined double")
    bounds = spark.createDataFrame([("S", "A", 6.0)], "sample_id string, marker string, threshold double")
    spec = {"mid": {"A": "intermediate"}, "up": {"A": "above"}, "other": {"B": "above"}}
    of = lambda **k: {(r.population, r.term): r.u_pct_points for r in uncertainty.frequency_uncertainty(ev, thr, thr, spec, "parent", bounds=bounds, gate=("live", "P", gate), **k).collect()}
    got = of()
    # mid has no term of the parent, and a population of an absent marker has none at all
    assert got.keys() == {("mid", "A"), ("up", "A"), ("up", uncertainty.PARENT)}
    both = of(lone=True)
    assert both[("mid", uncertainty.PARENT)] == both[("up", uncertainty.PARENT)] == 0 and both[("mid", "A")] == got["mid", "A"]


def test_uncertainty_seed_depends_on_names_alone():
    assert uncertainty.seed_of(1, "a", "b") == uncertainty.seed_of(1, "a", "b") != uncertainty.seed_of(1, "b", "a")


def test_conformance(spark):
    f = lambda shift: spark.createDataFrame([(f"S{i}", m, 2.0 + 0.05 * i + (shift if m == "CD3" else 0), "valley") for i in range(8) for m in MARKERS], "sample_id string, marker string, threshold double, source string")
    base = conformance.marker_baseline(f(0), ["marker"])
    assert {r.verdict for r in conformance.marker_conformance(f(0), base, ["marker"]).collect()} == {"pass"}
    t = {r.marker: r.verdict for r in conformance.marker_conformance(f(3), base, ["marker"]).collect()}
    assert t["CD3"] == "fail" and {v for m, v in t.items() if m != "CD3"} == {"pass"}
    assert {r.verdict for r in conformance.marker_conformance(f(0), base, ["marker"], scale_changed=True).collect()} == {"not comparable"}
    with pytest.raises(conformance.DriftError):
        conformance.fail_on_drift(conformance.marker_conformance(f(3), base, ["marker"]))


def test_fingerprint_is_order_free():
    a, b = {"p": {"x": "above", "y": "below"}}, {"p": {"y": "below", "x": "above"}}
    assert conformance.fingerprint(a) == conformance.fingerprint(b)
    assert conformance.spec_changes({"p": {"x": "above"}, "q": {"y": "above"}}, conformance.fingerprint(a))[0][1] == "added"


def test_draws_do_not_depend_on_partitions(spark):
    df = spark.range(500).select((F.col("id") % 4).alias("s"), "id")
    q = df.select("s").distinct().withColumn("take", F.lit(7))
    a = sampling.draw(df, q, "s", "id").collect()
    b = sampling.draw(df.repartition(7), q, "s", "id").collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b)) and len(a) == 28


def test_draws_put_only_one_bin_in_order(spark):
    """The same rows as ranking all of a group, while no window sorts events before the filter on their bin."""
    df = spark.range(20_000).select((F.col("id") % 3).alias("s"), "id")
    q = spark.createDataFrame([(0, 1), (1, 2500), (2, 10**6)], "s long, take long")
    got = sampling.draw(df, q, "s", "id")
    r = F.row_number().over(Window.partitionBy("s").orderBy(sampling.draw_key(42, "s", "id"), "id"))
    want = df.withColumn("r", r).join(q, "s").filter("r <= take").select("s", "id")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    window = plan[plan.index("Window [row_number()") :]
    assert plan.count("Window [") == 1 and re.search(r"Filter .*_b#\d+ = _edge#\d+|Join Inner, .*_b#\d+ = _edge#\d+", window)
    none = sampling.draw(df, q.limit(0), "s", "id")
    assert none.count() == 0 and sampling.stratified_split(df, "s", "id", 0.25).filter("is_test").count() == 3 * 1666


@pytest.mark.parametrize(("n", "cap"), [(10, 25), (100, 7), (101, 50), (5, 1)])
def test_systematic_cap(spark, n, cap):
    got = sorted(r.id for r in sampling.systematic_cap(spark.range(n).select(F.lit("s").alias("s"), "id"), "s", "id", cap).collect())
    want = list(range(n)) if n <= cap else (np.unique(np.rint(np.linspace(1, n, cap)).astype(int)) - 1).tolist()
    assert got == want


def test_subsample_plan(spark):
    c = spark.createDataFrame([("a", 100), ("b", 40)], "sample_id string, n long")
    take = lambda **k: {r.sample_id: r["take"] for r in sampling.plan_subsample(c, **k).collect()}
    assert take() == {"a": 40, "b": 40} and take(equalise=False) == {"a": 100, "b": 40} and take(equalise=False, total_cap=14) == {"a": 10, "b": 4} and take(total_cap=1) == {"a": 1, "b": 1}


def test_transfer_scores_held_out_donors_in_full(spark):
    """The cap binds on training rows alone and leaves enough of a rare target."""
    rng = np.random.default_rng(12)
    rows = [(f"D{d}", d * 2000 + i, i < 15, *map(float, rng.normal([4, 3.5] if i < 15 else [1, 1], 0.5))) for d in range(4) for i in range(1000)]
    df = spark.createDataFrame(rows, "sample_id string, event_index long, target boolean, CD3 double, CD4 double")
    t = gate_learning.transferability(df, "target", ("CD3", "CD4"), "sample_id", "event_index", max_cells=300).collect()
    assert len(t) == 4 and {(r.n_train, r.n_test, r.n_target_test) for r in t} == {(300, 1000, 15)}
    assert min(r.f1 for r in t) > 0.7
