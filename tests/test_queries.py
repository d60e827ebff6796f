"""Every registered query of the core against its SQL, the batch pipeline and the stream."""

from __future__ import annotations

import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from gatefold.plans import QUERIES, SQL

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def norm(v):
    return repr(v + 0.0) if isinstance(v, float) and not math.isnan(v) else str(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '/root/testdata/sf0.01/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", [n for n in QUERIES if n in SQL])
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, "/root/testdata/sf0.01")
    cols = sorted(df.columns)
    res = duck.execute(SQL[name])
    have = [d[0] for d in res.description]
    assert sorted(have) == cols
    want = sorted(tuple(norm(r[have.index(c)]) for c in cols) for r in res.fetchall())
    assert sorted(tuple(norm(r[c]) for c in cols) for r in df.collect()) == want


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in SQL])
def test_query_runs(spark, name):
    assert QUERIES[name](spark, "/root/testdata/sf0.01").count() > 0


def test_batch_mixing_scores_all_vectors(spark):
    n = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").count()
    assert QUERIES["batch_mixing"](spark, "/root/testdata/sf0.01").first().n_cells_scored == n


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0 and set(QUERIES) <= set(e.queries()) and set(SQL) <= set(e.oracle_sql())


def planted(spark, n=6000):
    rng = np.random.default_rng(8)
    rows, samples = [], []
    for s in range(8):
        group = "HC" if s < 4 else "S1"
        samples.append((f"S{s}", group, 30.0 + s, "FM"[s % 2]))
        fsc = rng.lognormal(11, 0.2, n)
        cd3 = rng.random(n) < (0.5 if group == "HC" else 0.7)
        lift = lambda hit: np.where(hit, rng.lognormal(9, 0.3, n), rng.lognormal(4, 0.4, n))  # noqa: B023, E731
        cols = (fsc, fsc * rng.normal(0.56, 0.01, n), rng.lognormal(9, 0.3, n), lift(rng.random(n) < 0.9), lift(cd3), lift(cd3 & (rng.random(n) < 0.6)))
        rows += [(f"S{s}", i, *map(float, v)) for i, v in enumerate(zip(*cols, strict=True))]
    return spark.createDataFrame(rows, ["sample_id", "event_index", "FSC-A", "FSC-H", "SSC-A", "CD45", "CD3", "CD4"]), spark.createDataFrame(samples, "sample_id string, cohort string, age_years double, sex string")


def test_pipeline_finds_the_planted_difference(spark, tmp_path):
    from gatefold.plans import pipeline
    from gatefold.sources.metadata import RunConfig

    ev, samples = planted(spark)
    cfg = RunConfig(populations={"T": {"CD3": "above"}, "CD4 T": {"CD3": "above", "CD4": "above"}, "not T": {"CD3": "below"}}, ratios={"CD4/T": ("CD4 T", "T")}, functional_blocks={"b": {"markers": ["CD4"], "require": "CD3"}}, reference_group="HC", cofactor=150.0, uncertainty=False, embedding=False, clusters=False, figures=False)
    done = pipeline.run(ev, cfg, samples, ["CD45", "CD3", "CD4"])
    assert done.manifest.data["status"] == "completed" and not done.manifest.data["skipped"]
    g = {r.population: r for r in done.tables["group_comparison_stats"].collect()}
    assert g["T"].cliffs_delta == 1 and 45 < g["T"].median_reference < 55 and 65 < g["T"].median_comparison < 75
    assert done.tables["population_ratios"].count() == 8 and done.tables["staining_qc"].filter("included").count() == 8
    base = pipeline.baseline_of(done)
    again = pipeline.run(ev, cfg, samples, ["CD45", "CD3", "CD4"], baseline=base)
    assert {r.verdict for r in again.tables["specification_conformance"].collect()} == {"pass"}
    done.save(f"{tmp_path}/out")
    done.manifest.save(tmp_path / "m.json")
    assert pipeline.load_session(spark, f"{tmp_path}/out", ["gate_counts"])["gate_counts"].count() == 40


def test_pipeline_makes_every_table(spark, tmp_path):
    """Patients, counts, pairs, uncertainty, clusters, batches, labels and exports of one planted run."""
    from gatefold.plans import pipeline
    from gatefold.sources.metadata import RunConfig

    ev, samples = planted(spark)
    n = samples.count()
    ids = [r.sample_id for r in samples.orderBy("sample_id").collect()]
    smap = spark.createDataFrame([(s, f" p{i} ", f"{s}.fcs", "ab"[i % 2], f"pair{i // 2}", ["pre", "post"][i % 2]) for i, s in enumerate(ids)], "sample_id string, patient_id string, file string, batch string, pair string, timepoint string")
    smap = smap.join(samples.select("sample_id", "cohort"), "sample_id")
    patients = spark.createDataFrame([(f"P{i}", 30.0 + i, "FM"[i % 2]) for i in range(n)], "patient_id string, age_years double, sex string")
    counts = spark.createDataFrame([(f"p{i}", "T", 800.0 + i) for i in range(n)], "sample_key string, population string, cells_per_ul double")
    labels = ev.select("sample_id", "event_index", F.when(F.col("CD3") > 1000, "t").otherwise("other").alias("external_label"))
    cfg = RunConfig(
        populations={"T": {"CD3": "above"}, "CD4 T": {"CD3": "above", "CD4": "above"}}, ratios={"CD4/T": ("CD4 T", "T")}, functional_blocks={"b": {"markers": ["CD4"], "require": "CD3"}}, reference_group="HC", pair_column="pair",
        condition_column="timepoint", uncertainty_boot=12, n_clusters=4, som_side=3, cells_per_sample=400, export_fcs=True, subclusters=False, max_explained=1, umap_epochs=20, explain_max_depth=2, external_max_labels=2,
    )
    done = pipeline.run(ev, cfg, smap, ["CD45", "CD3", "CD4"], patients=patients, counts=counts, labels=labels, spill=(["CD45", "CD3", "CD4"], [[1.0, 0.0, 0.0], [0.0, 1.0, 0.02], [0.0, 0.0, 1.0]]))
    assert done.manifest.data["status"] == "completed" and not done.manifest.data["skipped"], done.manifest.data["skipped"]
    want = {"patient_completeness", "absolute_counts_qc", "threshold_uncertainty", "uncertainty_budget", "population_frequencies_uncertainty", "group_comparison_stats", "functional_marker_stats", "ratio_stats", "confounding_diagnostics",
            "covariate_adjusted_stats", "batch_group_confounding", "cells", "cluster_agreement", "population_cluster_agreement", "cluster_centroids", "cohort_composition", "batch_mixing", "external_label_gates", "population_codes", "fcs_files"}
    assert want <= set(done.tables), want - set(done.tables)
    assert "cofactor" in " ".join(done.manifest.data["notes"])
    f = done.tables["population_frequencies"]
    assert f.filter("population = 'T' and cells_per_ul is not null").count() == n
    assert done.tables["cells"].groupBy("sample_id").count().agg(F.max("count")).first()[0] <= 400
    assert done.tables["fcs_files"].count() == n


def test_command_line_reaches_every_setting(spark, tmp_path):
    from gatefold.plans import pipeline
    from gatefold.sources.metadata import RunConfig

    plain = [k for k, f in RunConfig.__dataclass_fields__.items() if "dict" not in str(f.type)]
    a = pipeline.options().parse_args(["--events", "e.parquet", "--samples", "s.csv", "--config", "c.yaml", "--markers", "A,B", "--singlet-mad-k", "2.5", "--no-clusters", "--covariates", "age,sex", "--seed", "7"])
    assert all(hasattr(a, k) for k in plain) and (a.singlet_mad_k, a.clusters, a.covariates, a.seed, a.embedding) == (2.5, False, ("age", "sex"), 7, None)
    pipeline.put_text(spark, f"file://{tmp_path}/out/manifest.json", "{}")
    assert (tmp_path / "out/manifest.json").read_text() == "{}"


def test_stream_scores_landed_samples(spark, tmp_path):
    from gatefold.streaming.landing import score_stream, stream_samples

    rows = [(s, True, float(i % 4)) for s in ("A", "B") for i in range(40)]
    df = spark.createDataFrame(rows, "sample_id string, parent boolean, CD3 double")
    for s in ("A", "B"):
        df.filter(df.sample_id == s).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    thr = spark.createDataFrame([(s, "CD3", 1.5) for s in ("A", "B")], "sample_id string, marker string, threshold double")
    seen = {}
    q = score_stream(stream_samples(spark, f"{tmp_path}/in", df.schema, 1), thr, {"T": {"CD3": "above"}}, "parent", lambda d, e: seen.update({r.sample_id: r.pct_of_cd45_pos for r in d.collect()}), f"{tmp_path}/ck")
    q.awaitTermination(120)
    assert seen == {"A": 50.0, "B": 50.0}


def test_pipeline_controls_panels_and_unmapped_samples(spark, tmp_path):
    """A planted cohort: an unstained control, a second panel, a sample without a row, per-file spillover."""
    from gatefold.plans import pipeline
    from gatefold.sources import metadata
    from gatefold.sources.metadata import RunConfig

    from statistics import NormalDist

    rng = np.random.default_rng(21)
    rows, n = [], 6000
    even = np.array([NormalDist().inv_cdf((i + 0.5) / n) for i in range(n)])  # without noise, in which a small sample shows valleys
    one = lambda mean: np.exp(mean + 0.4 * rng.permutation(even))
    for s in range(7):
        fsc = rng.lognormal(11, 0.2, n)
        stained = s < 6
        high = lambda share: np.where(rng.random(n) < share, rng.lognormal(9, 0.3, n), rng.lognormal(4, 0.4, n))
        cd45 = high(0.97) if stained else one(4)
        cd3 = one(6) if stained else one(4)  # one mode: only a control can place its cut
        cd4 = one(4) if not stained else high(0.5) if s not in (4, 5) else [None] * n  # two samples lack a marker: another panel
        for i, v in enumerate(zip(fsc, fsc * rng.normal(0.56, 0.01, n), rng.lognormal(9, 0.3, n), cd45, cd3, cd4, strict=True)):
            rows.append((f"S{s}", i, *[None if x is None else float(x) for x in v]))
    schema = "sample_id string, event_index long, `FSC-A` double, `FSC-H` double, `SSC-A` double, CD45 double, CD3 double, CD4 double"
    ev = spark.createDataFrame(rows, schema).cache()
    cfg = RunConfig(populations={"T": {"CD3": "above"}, "CD4": {"CD4": "above"}}, cofactor=150.0, embedding=False, clusters=False, uncertainty=False, figures=False, fail_on_drift=True)
    plain = spark.createDataFrame([(f"S{s}", "ab"[s % 2]) for s in range(7)], "sample_id string, cohort string")
    done = pipeline.run(ev, cfg, plain, ["CD45", "CD3", "CD4"])
    qc = {r.sample_id: r for r in done.tables["staining_qc"].collect()}
    assert qc["S6"].qc_status == "control" and qc["S6"].is_control and all(qc[f"S{s}"].included for s in range(6))  # undeclared, so taken for a control
    assert qc["S6"].panel == "panel_1" and qc["S4"].panel == qc["S5"].panel == "panel_2"
    src = {(r.sample_id, r.marker): (r.source, r.threshold) for r in done.tables["thresholds_used"].collect()}
    by_control = {k for k, (how, _) in src.items() if how.startswith("control_q995")}
    assert {k for k in by_control if k[1] == "CD3"} == {(f"S{s}", "CD3") for s in range(4)}  # of the control's panel, but not the control
    assert src["S0", "CD4"][0] == "valley"
    limit = np.arcsinh(np.array([r[6] for r in rows if r[0] == "S6"]) / 150)
    assert abs(src["S0", "CD3"][1] - np.quantile(limit, 0.995)) < 0.15  # the control's single cells
    base = pipeline.baseline_of(done)
    assert {(r.panel, r.marker) for r in base["markers"].collect()} >= {("panel_1", "CD3"), ("panel_2", "CD3")}
    # declared a sample: failed, and no reference
    declared = plain.withColumn("is_control", F.lit(None).cast("boolean"))
    again = pipeline.run(ev, cfg, declared, ["CD45", "CD3", "CD4"], baseline={"markers": base["markers"].withColumn("median_threshold", F.col("median_threshold") + 9), "populations": base["populations"]})
    assert {r.sample_id: r.qc_status for r in again.tables["staining_qc"].collect()}["S6"] == "failed"
    assert again.tables["thresholds_used"].filter("source like 'control%'").count() == 0
    again.save(f"{tmp_path}/out")  # everything is saved before drift is an error
    with pytest.raises(pipeline.conformance.DriftError):
        again.raise_on_drift()
    with pytest.raises(metadata.SampleMapError, match="S3"):
        pipeline.run(ev, cfg, plain.filter("sample_id <> 'S3'"), ["CD45", "CD3", "CD4"])


def test_command_line_from_files(spark, tmp_path):
    """Event files with a spillover keyword and dates, a sample map, a saved layout, exported files."""
    from gatefold.plans import pipeline
    from gatefold.sources import fcs, metadata

    rng = np.random.default_rng(22)
    (tmp_path / "in").mkdir()
    ch = [("FSC-A", ""), ("FSC-H", ""), ("SSC-A", ""), ("B1-A", "CD45"), ("B2-A", "CD3"), ("B3-A", "CD4")]
    for s in range(4):
        n = 2500
        fsc = rng.lognormal(11, 0.2, n)
        high = lambda share: np.where(rng.random(n) < share, rng.lognormal(9, 0.3, n), rng.lognormal(4, 0.4, n))  # noqa: B023, E731
        clean = np.column_stack([fsc, fsc * rng.normal(0.56, 0.01, n), rng.lognormal(9, 0.3, n), high(0.9), high(0.5), high(0.5)])
        mixed = clean.copy()
        mixed[:, 5] += 0.2 * clean[:, 4]
        (tmp_path / "in" / f"s{s}.fcs").write_bytes(fcs.write(ch, mixed, {"$DATE": f"0{1 + s % 2}-JAN-2024", "$SPILLOVER": "2,B2-A,B3-A,1,0.2,0,1"}))
    (tmp_path / "map.csv").write_text("File,sample_id,cohort\n" + "".join(f"s{s}.fcs,S{s},{'HC' if s < 2 else 'X'}\n" for s in range(4)))
    (tmp_path / "run.yaml").write_text("populations:\n  T: {CD3: above}\n  CD4 T: {CD3: above, CD4: above}\ncofactor: 150\ncells_per_sample: 150\nclusters: false\nuncertainty_boot: 12\numap_epochs: 20\nmin_group_n: 2\n")
    common = ["--events", f"file://{tmp_path}/in", "--config", f"{tmp_path}/run.yaml", "--markers", "CD45,CD3,CD4", "--cd45", "CD45"]
    assert pipeline.main([*common, "--samples", f"{tmp_path}/map.csv", "--outdir", f"{tmp_path}/one", "--save-umap-model", f"{tmp_path}/model", "--export-events", f"{tmp_path}/cells", "--no-explain-clusters"]) == 0
    t = pipeline.load_session(spark, f"{tmp_path}/one", ["cells", "batch_group_confounding", "population_frequencies", "uncertainty_budget", "figure_marker_curves", "figure_overlay"])
    assert {"umap_1", "umap_2"} <= set(t["cells"].columns) and t["cells"].filter("umap_1 is null").count() == 0 and t["batch_group_confounding"].count() == 1
    share = {(r.sample_id, r.population): r.pct_of_cd45_pos for r in t["population_frequencies"].collect()}
    assert "compensated by 1 matrices" in (tmp_path / "one/manifest.json").read_text()
    assert 20 < np.median([share[f"S{s}", "CD4 T"] for s in range(4)]) < 30  # planted: 25 %
    assert t["uncertainty_budget"].filter("term = 'parent_CD45'").count() > 0
    kept = {(r.sample_id, r.group) for r in t["cells"].select("sample_id", "group").distinct().collect()}  # samples whose staining passes
    assert len(kept) >= 2 and len(list((tmp_path / "cells").glob("*.fcs"))) == len(kept) + len({g for _, g in kept}) + 1
    assert pipeline.main([*common, "--samples", "none", "--write-sample-map", f"{tmp_path}/template"]) == 0
    assert spark.read.option("header", True).csv(f"{tmp_path}/template").count() == 4
    (tmp_path / "short.csv").write_text("file,sample_id\ns0.fcs,S0\n")
    with pytest.raises(metadata.SampleMapError):
        pipeline.main([*common, "--samples", f"{tmp_path}/short.csv", "--outdir", f"{tmp_path}/none"])


def test_stream_of_conformance_keeps_state(spark, tmp_path):
    """A sample that lands in parts ends with the cut of all its events; the baseline tells which marker drifted."""
    from gatefold.operators.uncertainty import valley_of
    from gatefold.streaming import conformance as sc
    from gatefold.streaming.landing import stream_samples

    from statistics import NormalDist

    even = np.array([NormalDist().inv_cdf((i + 0.5) / 1500) for i in range(1500)])  # without noise, which has valleys of its own
    two = lambda at: np.concatenate([at + even / 2, at + 3 + even / 2])
    data = {"A": (two(1), two(1)), "B": (two(1), two(7))}
    schema = "sample_id string, CD3 double, CD4 double"
    for part in range(3):
        rows = [(s, float(x[i]), None if i == 0 else float(y[i])) for s, (x, y) in data.items() for i in range(part, 3000, 3)]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    base = spark.createDataFrame([("panel_1", "CD3", 2.5, 0.4), ("panel_1", "CD4", 2.5, 0.4)], "panel string, marker string, median_threshold double, mad_threshold double")
    events = stream_samples(spark, f"{tmp_path}/in", spark.createDataFrame([], schema).schema, 1)
    seen: list = []
    out = sc.against_baseline(sc.running_cuts(events, ["CD3", "CD4"]), base)
    q = out.writeStream.outputMode("update").foreachBatch(lambda d, e: seen.extend((e, r) for r in d.collect())).option("checkpointLocation", f"{tmp_path}/ck").trigger(availableNow=True).start()
    q.awaitTermination(120)
    q.stop()
    assert q.exception() is None and len({e for e, _ in seen}) == 3
    last = {(r.sample_id, r.marker): r for e, r in sorted(seen, key=lambda x: x[0])}
    assert [r.n for e, r in sorted(seen, key=lambda x: x[0]) if (r.sample_id, r.marker) == ("A", "CD3")] == [1000, 2000, 3000]
    assert last["A", "CD4"].n == 2999
    for (s, m), r in last.items():
        x = data[s][("CD3", "CD4").index(m)]
        x = x[1:] if m == "CD4" else x
        counts = np.bincount(np.clip(np.floor((x - sc.LOW) / (sc.HIGH - sc.LOW) * sc.BINS), 0, sc.BINS - 1).astype(int), minlength=sc.BINS)
        assert r.cut == sc.LOW + (sc.HIGH - sc.LOW) / sc.BINS * valley_of(counts)[0]
    assert {k: r.verdict for k, r in last.items()} == {("A", "CD3"): "pass", ("A", "CD4"): "pass", ("B", "CD3"): "pass", ("B", "CD4"): "fail"}
