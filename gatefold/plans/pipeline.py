"""The batch pipeline: events to gates, thresholds, populations, per-sample tables, tests and diagnostics.

One lazily built plan a table.  Gated events with their transformed markers, and small per-sample tables (bounds,
thresholds, frequencies), are written once and read by everything after them; events are never cached raw.  Optional analyses fail alone and are listed in the manifest.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import logging
import time
from dataclasses import replace
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gatefold.functions.numeric import col, functional_key, log10_floor
from gatefold.functions.storage import cut
from gatefold.operators import clusters, compositional, conformance, diagnostics, gate_learning, gates, layout, polygons, populations, ranks, sampling, thresholds, uncertainty
from gatefold.operators.transforms import Logicle, Transform, compensate, compensate_by, derive_cofactors, pool_cofactor, pooled_logicle, scale_features, scale_parameters, select_features, spaced
from gatefold.plans import figures
from gatefold.sources import defaults, fcs, fcs_source, metadata
from gatefold.sources.events import event_files, fingerprint_panels
from gatefold.sources.metadata import COVARIATES, RunConfig

LOG = logging.getLogger("gatefold")


class Manifest:
    """What a run did: status running, then completed or failed, with its tables and skipped analyses."""

    def __init__(self, config: RunConfig, inputs: list[str]) -> None:
        self.data: dict = {"status": "running", "started": dt.datetime.now(dt.UTC).isoformat(), "inputs": inputs, "tables": [], "skipped": {}, "notes": [], "config": {k: getattr(config, k) for k in config.__dataclass_fields__}}

    def __enter__(self) -> Manifest:
        return self

    def __exit__(self, kind, error, trace) -> None:
        self.data["status"] = "failed" if kind else "completed"
        if kind:
            self.data["error"] = f"{kind.__name__}: {error}"
        self.data["ended"] = dt.datetime.now(dt.UTC).isoformat()

    def save(self, path: str | Path) -> None:
        Path(path).write_text(json.dumps(self.data, indent=1, default=str))


class Run:
    """Tables of a run by name."""

    def __init__(self, config: RunConfig, inputs: list[str] | None = None) -> None:
        self.config, self.tables, self.manifest = config, {}, Manifest(config, inputs or [])
        self.gating_ml: str | None = None
        self.fresh: tuple | None = None  # cells, layout and scales of a layout that this run made

    def put(self, name: str, df: DataFrame, write: bool = True) -> DataFrame:
        self.tables[name] = cut(df, name) if write else df
        self.manifest.data["tables"].append(name)
        return self.tables[name]

    def attempt(self, name: str, make) -> None:
        """An optional analysis: its failure is noted and changes nothing else; the manifest has the seconds it took."""
        began = time.perf_counter()
        try:
            df = make()
            if df is not None:
                self.put(name, df)
        except Exception as e:  # noqa: BLE001
            LOG.warning("%s skipped: %s", name, e)
            self.manifest.data["skipped"][name] = str(e)[:300]
        self.manifest.data.setdefault("seconds", {})[name] = round(time.perf_counter() - began, 1)

    def save_layout(self, path: str) -> None:
        """Keep this run's layout for later ones; a run that placed its cells in a saved one has none of its own."""
        if self.fresh:
            cells, spots, scales = self.fresh
            layout.save(cells, "_cell", spots, [f for f, _, _ in scales], [m for _, m, _ in scales], [w for _, _, w in scales], path, self.config.n_neighbors)

    def raise_on_drift(self) -> None:
        """Raise DriftError if the run was asked to and a marker or population fails its baseline; for after everything is saved."""
        if self.config.fail_on_drift:
            conformance.fail_on_drift(*[self.tables[n] for n in ("specification_conformance", "specification_conformance_populations") if n in self.tables])

    def save(self, root: str, fmt: str = "parquet") -> None:
        for n, df in self.tables.items():
            flat = df.drop(*[c for c, t in df.dtypes if t == "binary" or t.startswith(("array", "map"))]) if fmt == "csv" else df
            (flat.write.option("header", True) if fmt == "csv" else flat.write).format(fmt).mode("overwrite").save(f"{root.rstrip('/')}/{n}")


def load_session(spark: SparkSession, root: str, names: list[str]) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{root.rstrip('/')}/{n}") for n in names}


def prepared(events: DataFrame, config: RunConfig, samples: DataFrame, markers: list[str], spill: tuple[list[str], list[list[float]]] | None, out: Run, keywords: DataFrame | None = None) -> tuple[DataFrame, Transform]:
    """events compensated and transformed on one scale for all samples, which evenly spaced samples decide where none is configured.

    Without a matrix of its own a run takes each file's from its keywords.
    """
    if spill:
        events = compensate(events, *spill)
    elif keywords is not None:
        events = _compensated(events, keywords, out)
    have = [m for m in markers if m in events.columns]
    tr = Transform(config.transform, config.cofactor or 150.0)
    if config.transform != "none" and not (config.transform == "arcsinh" and config.cofactor):
        order = [r[0] for r in samples.select("sample_id").orderBy("sample_id").collect()]  # a cohort's samples
        use = spaced(order, config.pool_samples)
        long = events.filter(F.col("sample_id").isin(use)).select("sample_id", F.explode(F.array(*[F.struct(F.lit(m).alias("marker"), col(m).cast("double").alias("value")) for m in have])).alias("r")).select("sample_id", "r.*")
        if config.transform == "arcsinh":
            by = derive_cofactors(long, "sample_id", "marker", "value")
            cofactor, apart = pool_cofactor(by, config.pool_samples, order=use) if by else (150.0, False)
            tr = Transform("arcsinh", cofactor)
            out.manifest.data["notes"].append(f"cofactor {cofactor:.4g} from {len(by)} samples" + (", which disagree" if apart else ""))
        else:
            p = {r["marker"]: Logicle(w=r["w"], t=r["t"], m=r["m"], a=r["a"]) for r in pooled_logicle(long, use, max_samples=config.pool_samples).collect()}  # one row a marker
            tr = Transform("logicle", logicle=p)
    return events.withColumns({m: tr.forward(m, m) for m in have}), tr


def _compensated(events: DataFrame, keywords: DataFrame, out: Run) -> DataFrame:
    """events by the spillover matrices of their files: as many expressions as there are different matrices."""
    text = F.coalesce(*[F.try_element_at("keywords", F.lit(k)) for k in ("$SPILLOVER", "SPILL", "$SPILL", "SPILLOVER")])
    named = F.map_from_entries(F.transform("channels", lambda c: F.struct(c["name"], F.when(c["role"] == "marker", c["symbol"]).otherwise(c["name"])))) if "channels" in keywords.columns else F.create_map().cast("map<string,string>")
    k = keywords.select("sample_id", text.alias("_t"), named.alias("_n")).filter("_t is not null").withColumn("_spill", F.md5(F.concat_ws("|", "_t", F.to_json("_n"))))
    matrices = {}
    for r in k.groupBy("_spill").agg(F.first("_t").alias("t"), F.first("_n").alias("n")).collect():  # one row a different matrix
        got = fcs.spill_matrix({"$SPILLOVER": r["t"]})
        if got:
            matrices[r["_spill"]] = ([(r["n"] or {}).get(c, c) for c in got[0]], got[1])
    if not matrices:
        return events
    out.manifest.data["notes"].append(f"compensated by {len(matrices)} matrices of the files")
    return compensate_by(events.join(k.select("sample_id", "_spill"), "sample_id", "left"), "_spill", matrices).drop("_spill")


def panels_of(events: DataFrame, markers: list[str]) -> DataFrame:
    """sample_id, marker_set and panel: samples with the same markers are one panel, by one aggregation of which columns hold values."""
    seen = events.groupBy("sample_id").agg(*[F.max(col(m).isNotNull()).alias(f"_{i}") for i, m in enumerate(markers)])
    each = seen.select("sample_id", F.explode(F.filter(F.array(F.lit(""), *[F.when(F.col(f"_{i}"), F.lit(m)) for i, m in enumerate(markers)]), lambda m: m.isNotNull())).alias("symbol"))
    p = fingerprint_panels(each.withColumn("seen", F.col("sample_id")), "seen")
    return p.select("sample_id", F.ltrim(F.col("marker_set"), F.lit("|")).alias("marker_set"), F.concat(F.lit("panel_"), F.col("panel_i").cast("string")).alias("panel"))


def run(events: DataFrame, config: RunConfig, samples: DataFrame, markers: list[str], scatter: tuple[str, str, str] = ("FSC-A", "SSC-A", "FSC-H"), cd45: str = "CD45", baseline: dict[str, DataFrame] | None = None, batch: str | None = None, patients: DataFrame | None = None, counts: DataFrame | None = None, labels: DataFrame | None = None, spill: tuple[list[str], list[list[float]]] | None = None, keywords: DataFrame | None = None, model: layout.SavedLayout | None = None) -> Run:
    """All tables of a run.

    events: sample_id, event_index, raw scatter and marker channels; samples: sample_id and optionally file, patient_id, the
    group column, is_control, covariates, pairs and a batch column; patients: by patient_id; counts: (sample_key, population,
    cells_per_ul); labels: (sample_id, event_index, external_label); spill: channels and their spillover matrix; keywords: (sample_id,
    keywords, channels) of event files; model: a saved layout that cells are placed in.

    Samples with the same markers are a panel, whose first control sets the cuts of markers without a valley; thresholds are compared with
    peers and baselines within a panel.  A sample of events that samples doesn't name is an error.
    """
    out = Run(config)
    c = config
    with out.manifest:
        if patients is not None and "patient_id" in samples.columns:
            own = [x for x in samples.columns if x not in patients.columns or x == "patient_id"]
            samples = cut(metadata.attach_patients(samples.select(*[x for x in own if x != "patient_id"]), samples, patients), "samples")
            out.attempt("patient_completeness", lambda: metadata.completeness(patients))
        have = [m for m in markers if m in events.columns]
        panels = out.put("panels", panels_of(events, have))
        gone = [r[0] for r in panels.join(samples.select("sample_id"), "sample_id", "left_anti").select("sample_id").orderBy("sample_id").limit(5).collect()]
        if gone:
            raise metadata.SampleMapError(f"samples of the events that the sample table doesn't name: {gone}")
        e, tr = prepared(events, c, samples, markers, spill, out, keywords)
        viability = gates.viability_marker(have, c.viability_marker)
        rows = c.threshold_rows()
        spark = events.sparkSession
        cfg = None
        if rows:
            names = spark.createDataFrame(rows, "marker string, cfg_value double")
            cfg = samples.select("sample_id").join(F.broadcast(names))  # the configuration's few markers
        gated, used = gates.gate_events(e, fsc_a=scatter[0], ssc_a=scatter[1], fsc_h=scatter[2], viability=viability, cd45=cd45, config=cfg, singlet_k=c.singlet_mad_k)
        # transformed markers and gates, written once: thresholds, scores, uncertainty and cells all read them
        gated = cut(gated.select("sample_id", *[x for x in ("event_index",) if x in events.columns], *have, *gates.GATES), "gated")
        chain = out.put("gate_counts", gates.gate_counts(gated))
        pct = chain.filter("gate = 'cd45_pos'").select("sample_id", F.col("pct_of_parent").alias("pct_cd45_of_live"))
        src = used.filter(F.col("marker") == cd45).select("sample_id", F.col("source").alias("cd45_source")) if used is not None else pct.select("sample_id", F.lit("skipped").alias("cd45_source"))
        # without the column nothing is declared; with it, a sample that it doesn't call a control is declared a sample
        known = samples.withColumn("is_control", F.coalesce("is_control", F.lit(False)) if "is_control" in samples.columns else F.lit(None).cast("boolean"))
        qc = known.join(panels.select("sample_id", "panel"), "sample_id").join(pct, "sample_id").join(src, "sample_id", "left").withColumn("cd45_source", F.coalesce("cd45_source", F.lit("skipped")))
        qc = out.put("staining_qc", gates.staining_verdict(qc, min_pct=c.min_cd45_pct, force=c.include_qc_failed).select("sample_id", "panel", "pct_cd45_of_live", "verdict", "qc_status", "included", (F.col("qc_status") == "control").alias("is_control")))
        status = qc.select("sample_id", "is_control", "qc_status")
        spec = c.populations or defaults.POPULATIONS
        need = [m for m in populations.spec_markers(spec) if m in have]
        inside = gated.filter("cd45_pos")
        long = inside.select("sample_id", F.explode(F.array(*[F.struct(F.lit(m).alias("marker"), col(m).alias("value")) for m in need])).alias("r")).select("sample_id", "r.*")
        control = None
        if qc.filter("qc_status = 'control'").limit(1).count():
            single = gated.filter("single_cells").join(qc.filter("qc_status = 'control'").select("sample_id"), "sample_id", "left_semi")
            single = single.select("sample_id", F.explode(F.array(*[F.struct(F.lit(m).alias("marker"), col(m).alias("value")) for m in need])).alias("r")).select("sample_id", "r.*")
            control = cut(thresholds.control_quantiles(single, qc), "control")
        thr = thresholds.resolve(long, ["sample_id", "marker"], "value", cfg, control)
        thr = thresholds.peer_check(cut(thr.join(panels.select("sample_id", "panel"), "sample_id")), ["panel", "marker"])
        thr = out.put("thresholds_used", thr.join(status, "sample_id", "left"))
        out.attempt("threshold_scale_qc", lambda: thresholds.scale_qc(thr, ["panel", "marker"]))
        bounds = cut(populations.intermediate_bounds(gated, thr, spec, parent="cd45_pos"))
        scored = populations.score(gated, thr, spec, "cd45_pos", bounds=bounds)
        pops = list(spec)
        freq = populations.frequencies(scored, pops, "cd45_pos").join(status, "sample_id")
        if counts is not None and {"patient_id", "file"} <= set(samples.columns):
            matched = metadata.match_counts(counts, samples)
            freq = freq.join(matched, ["sample_id", "population"], "left")
        elif "wbc_per_ul" in samples.columns:
            freq = metadata.absolute_from_wbc(freq, samples.withColumn("wbc_per_ul", F.col("wbc_per_ul").cast("double")))
        freq = out.put("population_frequencies", freq)
        if "cells_per_ul" in freq.columns:
            out.attempt("absolute_counts_qc", lambda: figures.counts_qc(freq.filter("cells_per_ul is not null")))
        out.put("populations_unavailable", populations.unavailable(thr, spec, events.columns, bounds=bounds))
        mfi = out.put("population_marker_mfi", populations.marker_summary(scored, pops, need, thr).join(status, "sample_id"))
        blocks = c.functional_blocks or ({} if c.populations else defaults.FUNCTIONAL_BLOCKS)
        if blocks:
            out.attempt("functional_markers", lambda: populations.functional(mfi, blocks, spec))
        if c.ratios:
            out.attempt("population_ratios", lambda: populations.ratios(freq, c.ratios))
        groups = samples.select("sample_id", F.col(c.group_column).alias("group")) if c.group_column in samples.columns else None
        ok = gates.qc_pass(freq)
        spread = None
        if c.uncertainty:
            spread = _uncertainty(out, c, inside, gated, thr, spec, need, freq, bounds, used, cd45)
        if groups is not None:
            value = ranks.abundance_measure(freq)
            compared = lambda: ranks.compare_groups(ok, groups, value, reference=c.reference_group, min_n=c.min_group_n)
            out.attempt("group_comparison_stats", lambda: uncertainty.annotate(compared(), spread, value == "pct_of_cd45_pos") if spread is not None else compared())
            if c.differential_state:
                out.attempt("marker_state_stats", lambda: diagnostics.differential_state(gates.qc_pass(mfi), groups, reference=c.reference_group, min_cells=c.min_cells, min_n=c.min_group_n))
            if "functional_markers" in out.tables:
                out.attempt("functional_marker_stats", lambda: ranks.compare_groups(gates.qc_pass(out.tables["functional_markers"]).withColumn("population", functional_key()), groups, "pct_positive", reference=c.reference_group))
            if "population_ratios" in out.tables:
                out.attempt("ratio_stats", lambda: ranks.compare_groups(gates.qc_pass(out.tables["population_ratios"].withColumnRenamed("ratio", "population").join(status, "sample_id")), groups, "value", reference=c.reference_group))
            if c.compositional:
                out.attempt("compositional_concordance", lambda: compositional.concordance(ranks.compare_groups(ok, groups, reference=c.reference_group), ranks.compare_groups(compositional.clr(ok), groups, "clr", reference=c.reference_group)))
            if c.threshold_drift:
                out.attempt("threshold_drift_stats", lambda: diagnostics.threshold_drift(gates.qc_pass(thr), groups, spec))
            names = [n for n in (COVARIATES.get(v, v) for v in c.covariates) if n in samples.columns]
            if names and c.confounding:
                out.attempt("confounding_diagnostics", lambda: compositional.confounding(ok, samples.select("sample_id", *names), groups, names))
                out.attempt("covariate_adjusted_stats", lambda: compositional.rank_ancova(ok, samples.select("sample_id", *names), groups, names))
        if c.pair_column in samples.columns and c.condition_column in samples.columns:
            pairs = samples.select("sample_id", F.col(c.pair_column).alias("pair"), F.col(c.condition_column).alias("condition"))
            out.attempt("paired_comparison_stats", lambda: ranks.compare_paired(ok, pairs, reference=c.reference_condition))
        by_batch = metadata.batch_of(batch or c.batch_column or "batch", samples, patients, keywords)
        if by_batch is not None and groups is not None:
            v = compositional.cramers_v(by_batch.join(groups, "sample_id"), "batch", "group")
            out.attempt("batch_group_confounding", lambda: v.withColumn("verdict", compositional.cramers_verdict("v")))
        if c.embedding or c.clusters:
            _cells(out, c, scored, samples, groups, by_batch, labels, status, have, tr, model)
        if c.figures:
            _figures(out, c, gated, groups, scatter, cd45, have, e)
        if baseline:
            out.attempt("specification_conformance", lambda: conformance.marker_conformance(thr, baseline["markers"], ["panel", "marker"]))
            out.attempt("specification_conformance_populations", lambda: conformance.population_conformance(freq, baseline["populations"]))
    return out


def _uncertainty(out: Run, c: RunConfig, inside: DataFrame, gated: DataFrame, thr: DataFrame, spec: dict, need: list[str], freq: DataFrame, bounds: DataFrame, used: DataFrame | None, cd45: str) -> DataFrame | None:
    """Threshold and frequency uncertainty tables; the combined one, if it could be made.

    The parent's cut has a row of its own, measured on live cells.
    """
    settings = {"boots": c.uncertainty_boot, "seed": c.seed, "max_events": c.uncertainty_max_events}
    values = inside.select("sample_id", F.explode(F.array(*[F.struct(F.lit(m).alias("marker"), col(m).alias("value")) for m in need])).alias("r")).select("sample_id", "r.*")
    parent = f"{cd45} (parent gate)"
    cuts = None if used is None else used.filter(F.col("marker") == cd45).withColumn("marker", F.lit(parent))
    live = gated.filter("live_cells").select("sample_id", F.lit(parent).alias("marker"), col(cd45).alias("value")) if cuts is not None and cd45 in gated.columns else None

    def measured() -> DataFrame:
        u = uncertainty.thresholds(values, thr, **settings)
        return u if live is None else u.unionByName(uncertainty.thresholds(live, cuts, **settings))

    out.attempt("threshold_uncertainty", measured)
    if "threshold_uncertainty" not in out.tables:
        return None
    u = out.tables["threshold_uncertainty"]
    own = u.filter(F.col("marker") != parent)
    gate = ("live_cells", cd45, u.filter(F.col("marker") == parent)) if live is not None else None
    out.attempt("uncertainty_budget", lambda: uncertainty.frequency_uncertainty(gated, thr, own, spec, "cd45_pos", bounds=bounds, gate=gate))
    if "uncertainty_budget" not in out.tables:
        return None
    out.attempt("population_frequencies_uncertainty", lambda: freq.join(uncertainty.combine(out.tables["uncertainty_budget"], missing=uncertainty.missing_terms(spec, own)), ["sample_id", "population"], "left"))
    made = out.tables.get("population_frequencies_uncertainty")
    return None if made is None else gates.qc_pass(made).filter("u_pct_points is not null")


def _figures(out: Run, c: RunConfig, gated: DataFrame, groups: DataFrame | None, scatter: tuple[str, str, str], cd45: str, have: list[str], events: DataFrame) -> None:
    """The numbers behind the figures of a run."""
    t = out.tables
    if {scatter[0], scatter[1]} <= set(events.columns):
        log = events.select("sample_id", log10_floor(scatter[0]).alias("fsc_log10"), log10_floor(scatter[1]).alias("ssc_log10"))
        out.attempt("figure_scatter_density", lambda: figures.hexbin(log, ["sample_id"], "fsc_log10", "ssc_log10"))
    if cd45 in have:
        out.attempt("figure_cd45_curve", lambda: figures.density_curve(gated.filter("live_cells"), ["sample_id"], cd45))
    long = gated.filter("cd45_pos").select("sample_id", F.explode(F.array(*[F.struct(F.lit(m).alias("marker"), col(m).alias("value")) for m in have])).alias("r")).select("sample_id", "r.*")
    out.attempt("figure_marker_curves", lambda: figures.density_curve(long, ["sample_id", "marker"], "value", points=256))
    if c.heatmaps:
        out.attempt("figure_marker_heatmap", lambda: figures.marker_heatmap(gates.qc_pass(t["population_marker_mfi"])))
    if groups is not None:
        out.attempt("figure_group_bars", lambda: figures.group_bars(gates.qc_pass(t["population_frequencies"]), groups))
    if "population_frequencies_uncertainty" in t:
        out.attempt("figure_uncertainty", lambda: figures.frequency_bars(gates.qc_pass(t["population_frequencies_uncertainty"]).filter("u_pct_points is not null")))
        out.attempt("figure_uncertainty_budget", lambda: figures.uncertainty_budget(t["uncertainty_budget"]))
    if "cells" in t:
        out.attempt("figure_marker_limits", lambda: figures.marker_limits(t["cells"], have))
        if "group" in t["cells"].columns:
            out.attempt("figure_overlay", lambda: figures.overlay_curves(t["cells"], have, "group"))
            out.attempt("figure_overview", lambda: figures.overview(t["cells"], "group"))
    names = sorted({*(c.populations or defaults.POPULATIONS), populations.OTHER})
    colours = {**figures.palette(names), **{k: v for k, v in c.colors.items() if k in names}}
    out.attempt("figure_palette", lambda: gated.sparkSession.createDataFrame(sorted(colours.items()), "population string, colour string"))


def _cells(out: Run, c: RunConfig, scored: DataFrame, samples: DataFrame, groups: DataFrame | None, by_batch: DataFrame | None, labels: DataFrame | None, status: DataFrame, have: list[str], tr: Transform, model: layout.SavedLayout | None = None) -> None:
    """The cell table, a bounded draw of each included sample (cells_per_sample, max_cells), and what is done on it."""
    if "event_index" not in scored.columns:
        out.manifest.data["skipped"]["cells"] = "events have no event_index"
        return
    ok = gates.qc_pass(scored.filter("cd45_pos").join(status, "sample_id"))
    sizes = cut(ok.groupBy("sample_id").agg(F.count(F.lit(1)).alias("n")), "sizes")
    quota = sampling.plan_subsample(sizes, cap=c.cells_per_sample, total_cap=c.max_cells)
    keep = ["sample_id", "event_index", "population_label", *have]
    cells = sampling.draw(ok.select(*keep), quota, "sample_id", "event_index", c.seed)
    if groups is not None:
        cells = cells.join(groups, "sample_id", "left")
    if by_batch is not None:
        cells = cells.join(by_batch, "sample_id", "left")
    cells = cut(cells, "cells")
    if c.correct_batch and groups is not None and by_batch is not None:
        cells, said = diagnostics.correct_batch(cells, "batch", "group", have, c.batch_max_cramers_v, c.force_batch_correction)
        out.manifest.data["notes"].append(f"batches {said}")
    features = select_features(have, defaults.LINEAGE)
    scales = scale_parameters(cells, features)
    scaled = scale_features(cells, features, parameters=scales)
    z = [f + "_z" for f in features if f + "_z" in scaled.columns]
    if c.embedding and len(z) >= 2:
        try:
            scaled = cut(_placed(out, c, scaled, scales, model), "placed")
        except ValueError as error:
            out.manifest.data["skipped"]["embedding"] = str(error)
    if c.clusters and len(z) >= 2:
        try:
            scaled = clusters.unsupervised(scaled.withColumn("_key", F.concat_ws("|", "sample_id", "event_index")), z, "_key", c.n_clusters, c.som_side, seed=c.seed).drop("_key")
        except ValueError as error:
            out.manifest.data["skipped"]["clusters"] = str(error)
    cells = out.put("cells", scaled.drop(*z))
    if "cluster" in cells.columns:
        per, pop = clusters.agreement(cells)
        out.attempt("cluster_agreement", lambda: per)
        out.attempt("population_cluster_agreement", lambda: pop)
        if "umap_1" in cells.columns:
            out.attempt("cluster_centroids", lambda: figures.cluster_centroids(cells))
        if c.explain_clusters:
            out.attempt("cluster_gate_proposals", lambda: _proposals(out, c, cells.withColumn("_key", F.xxhash64("sample_id", "event_index")), features, per, tr))
    if groups is not None:
        out.attempt("cohort_composition", lambda: clusters.composition(cells, "group", "population_label"))
        if c.subclusters and c.reference_group:
            keyed = cells.withColumn("_key", F.concat_ws("|", "sample_id", "event_index"))
            out.attempt("subcluster_k_selection", lambda: clusters.choose_k(keyed, features, "group", c.reference_group, "_key", seed=c.seed))
            out.attempt("subcluster_shifts", lambda: diagnostics.subcluster_shifts(clusters.subclusters(keyed, features, "group", c.reference_group, "_key", seed=c.seed), features, "group", c.reference_group, min_cells=c.min_cells))
    if "batch" in cells.columns and "umap_1" in cells.columns:
        points = cells.withColumn("_key", F.concat_ws("|", "sample_id", "event_index")).withColumn("_xy", F.array("umap_1", "umap_2"))
        out.attempt("batch_mixing", lambda: (diagnostics.batch_mixing(points, "_key", "_xy", "batch", k=c.mixing_k, n_perm=c.mixing_permutations, seed=c.seed) or (None,))[0])
    if labels is not None:
        out.attempt("external_label_gates", lambda: _external(out, c, cells, labels, features))
    if c.export_fcs:
        coded, legend = fcs.category_codes(cells, "population_label", "Population")
        out.attempt("population_codes", lambda: legend)
        raw = coded.withColumns({m: tr.inverse(m, m) for m in have})
        out.attempt("fcs_files", lambda: fcs.export(raw, "sample_id", [*have, "Population"]))


def _placed(out: Run, c: RunConfig, scaled: DataFrame, scales: list[tuple[str, float, float]], model: layout.SavedLayout | None) -> DataFrame:
    """Cells with umap_1 and umap_2: their places in the saved layout, or in a new one where there is none that fits."""
    keyed = scaled.withColumn("_cell", F.concat_ws("|", "sample_id", "event_index"))
    spots = None
    if model is not None:
        try:
            spots = layout.place_new(keyed, "_cell", model)
            out.manifest.data["notes"].append("cells are placed in the saved layout")
        except layout.NotUsable as error:
            out.manifest.data["notes"].append(f"the saved layout isn't used: {error}")
    if spots is None:
        names = [f for f, _, _ in scales]
        points = keyed.select("_cell", F.array(*[F.col(f + "_z") for f in names]).alias("_z"))
        spots = cut(layout.layout(points, "_cell", "_z", c.n_neighbors, c.min_dist, c.umap_epochs, c.seed), "layout")
        out.fresh = (keyed.select("_cell", *names), spots, scales)
    return keyed.join(spots.select("_cell", F.col("x").alias("umap_1"), F.col("y").alias("umap_2")), "_cell", "left").drop("_cell")


def _external(out: Run, c: RunConfig, cells: DataFrame, labels: DataFrame, features: list[str]) -> DataFrame:
    """Summary of the gates of external labels; their polygons and how they carry over to unseen donors are tables too."""
    joined = gate_learning.join_labels(cells, labels, min_match=c.external_labels_min_match).withColumn("_key", F.xxhash64("sample_id", "event_index"))
    summary, shapes, transfer = gate_learning.explain_external(joined, "external_label", features, "_key", max_labels=c.external_max_labels, seed=c.seed)
    out.put("external_label_polygons", shapes)
    if transfer is not None:
        out.put("external_label_transfer", transfer)
    return summary


def _proposals(out: Run, c: RunConfig, cells: DataFrame, features: list[str], per: DataFrame, tr: Transform) -> DataFrame | None:
    found = gate_learning.explain_unmatched(cells, features, per, "_key", max_clusters=c.max_explained, seed=c.seed, max_depth=c.explain_max_depth)
    if found is None:
        return None
    summary, shapes, left = found
    out.manifest.data["notes"].append(f"{left} undescribed clusters without a gate proposal")
    linear = out.put("cluster_gate_polygons", polygons.linear_table(shapes, tr))
    if c.export_gating_ml:
        out.gating_ml = polygons.gating_ml([r.asDict() for r in linear.collect()])  # a few polygons
    return summary


def baseline_of(done: Run) -> dict[str, DataFrame]:
    """Summaries that a later run is compared with; no event leaves a run."""
    return {"markers": conformance.marker_baseline(done.tables["thresholds_used"], ["panel", "marker"]), "populations": conformance.population_baseline(done.tables["population_frequencies"])}


def options() -> argparse.ArgumentParser:
    """Inputs, outputs and every field of the configuration as a flag of its own."""
    p = argparse.ArgumentParser(description="Cohort event analytics")
    p.add_argument("--events", required=True, help="Parquet of events, or a folder of FCS files")
    p.add_argument("--samples", required=True, help="CSV: sample_id, file, group column, covariates")
    p.add_argument("--config", required=True)
    p.add_argument("--markers", required=True, help="comma-separated marker columns")
    p.add_argument("--outdir", default="results")
    p.add_argument("--format", default="parquet", choices=["parquet", "csv"])
    p.add_argument("--max-events-per-file", type=int, default=0)
    p.add_argument("--recursive", action="store_true", help="event files of subfolders too")
    p.add_argument("--pattern", help="regular expression of event files to take")
    p.add_argument("--exclude", help="regular expression of event files to leave out; by default compensation controls")
    p.add_argument("--reference-date", help="date (YYYY-MM-DD) at which ages are taken")
    p.add_argument("--umap-model", help="folder of a saved layout to place cells in")
    p.add_argument("--save-umap-model", help="new folder for this run's layout")
    p.add_argument("--write-sample-map", help="CSV folder for a sample map to fill in; nothing else is done")
    p.add_argument("--export-events", help="folder for event files of the cells: one a sample, one a group, one of all")
    p.add_argument("--patients", help="CSV of patients by patient_id")
    p.add_argument("--absolute-counts", help="CSV or workbook of absolute counts")
    p.add_argument("--labels", help="CSV of external labels by sample and event")
    p.add_argument("--spillover", help="CSV: channel names, then the matrix")
    p.add_argument("--baseline", help="folder of a baseline that --write-baseline wrote")
    p.add_argument("--write-baseline", help="folder for this run's baseline")
    p.add_argument("--save-config", help="YAML with the run's settings and thresholds")
    p.add_argument("--scatter", default="FSC-A,SSC-A,FSC-H")
    p.add_argument("--cd45", default="CD45")
    for k, f in RunConfig.__dataclass_fields__.items():
        if "dict" in str(f.type):
            continue  # tables belong in the configuration file
        flag, kind = "--" + k.replace("_", "-"), str(f.type).split(" ")[0]
        if kind == "bool":
            p.add_argument(flag, dest=k, default=None, action=argparse.BooleanOptionalAction)
        elif kind.startswith("tuple"):
            p.add_argument(flag, dest=k, type=lambda v: tuple(v.split(",")))
        else:
            p.add_argument(flag, dest=k, type={"int": int, "float": float}.get(kind, str))
    return p


def main(argv: list[str] | None = None) -> int:
    a = options().parse_args(argv)
    spark = SparkSession.builder.appName("gatefold").getOrCreate()
    markers = a.markers.split(",")
    config = RunConfig.load(a.config)
    config = replace(config, **{k: getattr(a, k) for k in RunConfig.__dataclass_fields__ if getattr(a, k, None) is not None})
    keywords = None
    if a.events.lower().endswith(".parquet"):
        events = spark.read.parquet(a.events)
        samples = metadata.read_table(spark, a.samples)
        if "is_control" in samples.columns:
            samples = samples.withColumn("is_control", metadata.truth("is_control"))
    else:
        found = event_files(spark, a.events, a.recursive, a.pattern, a.exclude).withColumn("file", F.regexp_extract("path", r"([^/]+)$", 1))
        if a.write_sample_map:
            metadata.sample_map_template(found.select("file")).coalesce(1).write.option("header", True).mode("overwrite").csv(a.write_sample_map)
            return 0
        # a file that the map doesn't cover is an error
        samples = metadata.load_sample_map(spark, a.samples, found)
        paths = [r["path"] for r in found.select("path").collect()]  # a cohort's files
        events = fcs.scan(spark, paths, markers, max_events=a.max_events_per_file).withColumn("file", F.regexp_extract("file", r"([^/]+)$", 1)).join(samples.select("file", "sample_id"), "file")
        heads = fcs.headers(spark, paths).withColumn("file", F.regexp_extract("file", r"([^/]+)$", 1))
        keywords = cut(heads.join(samples.select("file", "sample_id"), "file").select("sample_id", "keywords", "channels"), "keywords")
    spill = None
    if a.spillover:
        m = metadata.read_table(spark, a.spillover)
        spill = (m.columns, [[float(v) for v in r] for r in m.collect()])  # channels by channels
    done = run(
        events, config, samples, markers, tuple(a.scatter.split(",")), a.cd45, load_session(spark, a.baseline, ["markers", "populations"]) if a.baseline else None,
        patients=metadata.load_patients(spark, a.patients, dt.date.fromisoformat(a.reference_date) if a.reference_date else None) if a.patients else None, counts=metadata.read_counts(spark, a.absolute_counts) if a.absolute_counts else None,
        labels=metadata.read_labels(spark, a.labels) if a.labels else None, spill=spill, keywords=keywords,
        model=layout.load(spark, a.umap_model) if a.umap_model else None,
    )
    done.save(a.outdir, a.format)
    if a.write_baseline:
        for n, t in baseline_of(done).items():
            t.write.mode("overwrite").parquet(f"{a.write_baseline.rstrip('/')}/{n}")
    if a.save_config:
        config.save(a.save_config, [r.asDict() for r in done.tables["thresholds_used"].orderBy("sample_id", "marker").collect()])  # samples by markers
    if a.save_umap_model:
        done.save_layout(a.save_umap_model)
    if a.export_events and "cells" in done.tables:
        fcs_source.export_files(done.tables["cells"], a.export_events, markers, ["sample_id", *(["group"] if "group" in done.tables["cells"].columns else []), None])
    texts = {"manifest.json": json.dumps(done.manifest.data, indent=1, default=str)} | ({"gates.xml": done.gating_ml} if done.gating_ml else {})
    for name, text in texts.items():
        put_text(spark, f"{a.outdir.rstrip('/')}/{name}", text)
    done.raise_on_drift()
    return 0


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text in any store that Spark reaches."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    stream = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(at, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


if __name__ == "__main__":
    raise SystemExit(main())
