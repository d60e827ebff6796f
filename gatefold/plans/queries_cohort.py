"""Queries: metadata joins, counts, labels, quality filters, conformance of populations, strategies and figure data over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from gatefold.functions.numeric import functional_key, norm_id, pretty_label, state_key
from gatefold.operators import clusters, conformance, diagnostics, gate_learning, gates, polygons, ranks, sampling, thresholds, transforms
from gatefold.operators.polygons import Level
from gatefold.plans import figures
from gatefold.plans.inputs import CELLS_SQL, SUPPLIER_SQL, cells, embedding_columns, supplier_values, table
from gatefold.plans.queries_gates import TRIANGLE, _wind
from gatefold.plans.queries_gating import _MFI, _SCORED, POPS, _scored, r6
from gatefold.plans.registry import query
from gatefold.sources import events as ev
from gatefold.sources import metadata


# ---------------------------------------------------------------- sample map and patients
def _map(spark, sf):
    """Customers as samples, their nations as patients, spelled differently in either table."""
    c = table(spark, sf, "customer").join(F.broadcast(table(spark, sf, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))
    return c.select(F.col("c_custkey").alias("sample_id"), F.concat(F.lit(" "), F.lower("n_name"), F.lit(" ")).alias("patient_id"), F.concat("c_name", F.lit(".FCS")).alias("file"), F.col("c_mktsegment").alias("plate"))


def _patients(spark, sf):
    n = table(spark, sf, "nation").join(F.broadcast(table(spark, sf, "region")), F.col("n_regionkey") == F.col("r_regionkey"))
    return n.select(F.col("n_name").alias("patient_id"), F.when(F.col("r_name") != "ASIA", F.col("r_name")).alias("cohort"), (F.col("n_nationkey") * 3 + 20).cast("double").alias("age_years"))


@query("group_of_samples", "SELECT c_custkey AS sample_id, r_name AS \"group\" FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE r_name <> 'ASIA'")
def _(spark, sf):
    return metadata.group_of(_map(spark, sf), _patients(spark, sf), "cohort")


@query("batch_column_lookup", """
SELECT c_custkey AS sample_id, c_mktsegment AS plate, CAST(n_nationkey * 3 + 20 AS DOUBLE) AS age FROM customer JOIN nation ON c_nationkey = n_nationkey
""")  # fmt: skip
def _(spark, sf):
    m, p = _map(spark, sf), _patients(spark, sf)
    own, two = metadata.batch_of("plate", m, p), metadata.batch_of("age_years", m, p)
    return own.withColumnRenamed("batch", "plate").join(two, "sample_id").select("sample_id", "plate", F.col("batch").cast("double").alias("age"))


@query("date_batches", "SELECT event_id AS sample_id, strftime(ts, '%Y-%m-%d') AS batch FROM events")
def _(spark, sf):
    e = table(spark, sf, "events").select(F.col("event_id").alias("sample_id"), F.create_map(F.lit("$DATE"), F.date_format("ts", "yyyy-MM-dd")).alias("keywords"))
    return ev.date_batches(e)


@query("patient_attributes", """
SELECT c_custkey AS sample_id, c_acctbal AS v, CASE WHEN r_name <> 'ASIA' THEN r_name END AS cohort, CAST(n_nationkey * 3 + 20 AS DOUBLE) AS age_years
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
""")  # fmt: skip
def _(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("sample_id"), F.col("c_acctbal").alias("v"))
    return metadata.attach_patients(c, _map(spark, sf), _patients(spark, sf)).select("sample_id", "v", "cohort", "age_years")


@query("sample_map_template", "SELECT c_name || '.FCS' AS file, c_name AS sample_id, '' AS patient_id, '' AS well FROM customer")
def _(spark, sf):
    return metadata.sample_map_template(_map(spark, sf).select("file")).select("file", "sample_id", "patient_id", "well")


@query("table_completeness", """
WITH t AS (SELECT count(*) AS n, count(d.doc_id) AS a, count(l.quality) AS b, count(CASE WHEN n_chars > 500 THEN 1 END) AS c FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
SELECT unnest(['doc_id', 'quality', 'long']) AS "column", unnest([a, b, c]) AS n_present, n FROM t
""")  # fmt: skip
def _(spark, sf):
    d = table(spark, sf, "documents").join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "left")
    return metadata.completeness(d.select("doc_id", "quality", F.when(F.col("n_chars") > 500, F.lit(1)).alias("long")))


@query("identifier_forms", "SELECT c_custkey, upper(trim(' ' || c_name || ' ')) AS id, replace(c_name, '#', ' ') AS label FROM customer")
def _(spark, sf):
    c = table(spark, sf, "customer")
    return c.select("c_custkey", norm_id(F.concat(F.lit(" "), "c_name", F.lit(" "))).alias("id"), pretty_label(F.regexp_replace("c_name", "#", "__")).alias("label"))


@query("count_key_matching", """
WITH k AS (SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN lower(s_name) WHEN s_suppkey % 3 = 1 THEN 'x_' || s_suppkey ELSE 'nobody' || s_suppkey END AS key FROM supplier)
SELECT s_suppkey AS sample_id, 'T' AS population, s_suppkey / 2.0 AS cells_per_ul FROM k WHERE s_suppkey % 3 < 2
""")  # fmt: skip
def _(spark, sf):
    s = table(spark, sf, "supplier")
    i = F.col("s_suppkey").cast("string")
    key = F.when(F.col("s_suppkey") % 3 == 0, F.lower("s_name")).when(F.col("s_suppkey") % 3 == 1, F.concat(F.lit("x_"), i)).otherwise(F.concat(F.lit("nobody"), i))
    counts = s.select(key.alias("sample_key"), F.lit("T").alias("population"), (F.col("s_suppkey") / 2.0).alias("cells_per_ul"))
    smap = s.select(F.col("s_suppkey").alias("sample_id"), F.col("s_name").alias("patient_id"), F.concat(F.lit("plate x_"), i, F.lit(".fcs")).alias("file"))
    return metadata.match_counts(counts, smap)


@query("external_labels", "SELECT d.lang AS sample_id, d.doc_id AS event_index, l.quality::VARCHAR AS external_label FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def _(spark, sf):
    c = table(spark, sf, "documents").select(F.col("lang").alias("sample_id"), F.col("doc_id").alias("event_index"))
    lab = table(spark, sf, "labels").join(c, F.col("doc_id") == F.col("event_index")).select("sample_id", "event_index", F.col("quality").cast("string").alias("external_label"))
    return gate_learning.join_labels(c, lab).select("sample_id", "event_index", "external_label")


# ---------------------------------------------------------------- filters, draws, transforms
@query("qc_filter", "SELECT c_custkey, c_acctbal FROM customer WHERE c_custkey % 4 <> 0 AND c_custkey % 5 <> 0")
def _(spark, sf):
    k = F.col("c_custkey")
    c = table(spark, sf, "customer").select(k, "c_acctbal", F.when(k % 4 == 0, True).when(k % 4 == 1, False).alias("is_control"), F.when(k % 5 == 0, "failed").otherwise("pass").alias("qc_status"))
    return gates.qc_pass(c).select("c_custkey", "c_acctbal")


@query("largest_labels", "SELECT source, count(*) AS n_cells FROM documents GROUP BY 1 HAVING count(*) >= 20 ORDER BY 2 DESC, 1 LIMIT 5")
def _(spark, sf):
    return sampling.largest(table(spark, sf, "documents"), "source", 5, 20)


@query("systematic_positions", """
WITH e AS (SELECT l_suppkey, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice) AS i, count(*) OVER (PARTITION BY l_suppkey) AS n FROM lineitem)
SELECT l_suppkey, i FROM e WHERE n <= 40 OR i IN (SELECT unnest(list_transform(range(0, 40), lambda k: CAST(round_even(1 + k * ((n - 1) / 39.0), 0) AS BIGINT))))
""")  # fmt: skip
def _(spark, sf):
    n = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"))
    e = n.select("l_suppkey", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))).alias("i"))
    return sampling.systematic_positions(e, "l_suppkey", "i", 40)


@query("pooled_logicle", """
WITH s AS (SELECT DISTINCT user_id FROM events), o AS (SELECT user_id, row_number() OVER (ORDER BY user_id) - 1 AS i, count(*) OVER () AS n FROM s),
u AS (SELECT user_id FROM o WHERE n <= 8 OR i IN (SELECT unnest(list_transform(range(0, 8), lambda k: CAST(round_even(k * (n - 1) / 7.0, 0) AS BIGINT))))),
t AS (SELECT event_type AS marker, CASE WHEN max(value - 40) > 0 THEN max(value - 40) ELSE 262144.0 END AS t, quantile_cont(CASE WHEN value - 40 < 0 THEN value - 40 END, 0.05) AS r FROM events JOIN u USING (user_id) GROUP BY 1)
SELECT marker, round(CASE WHEN r < 0 THEN greatest(0.0, least((4.5 - log10(t / abs(r))) / 2, 2.25)) ELSE 0.0 END, 6) AS w, round(t, 6) AS t FROM t
""")  # fmt: skip
def _(spark, sf):
    e = table(spark, sf, "events").select(F.col("user_id").alias("sample_id"), F.col("event_type").alias("marker"), (F.col("value") - 40).alias("value"))
    order = [r[0] for r in e.select("sample_id").distinct().orderBy("sample_id").collect()]  # one row a sample
    return transforms.pooled_logicle(e, order).select("marker", r6("w"), r6("t"))


@query("batch_correction", f"""
WITH e AS (SELECT event_id, value, user_id % 2 AS batch FROM events), p AS (SELECT quantile_cont(value, {[i / 100 for i in range(101)]}) AS ref FROM e), b AS (SELECT batch, quantile_cont(value, {[i / 100 for i in range(101)]}) AS own FROM e GROUP BY 1),
k AS (SELECT batch, unnest(own) AS x, unnest(ref) AS y, unnest(range(0, 101)) AS i FROM b, p), u AS (SELECT batch, x, min_by(y, i) AS y FROM k GROUP BY 1, 2),
s AS (SELECT batch, x AS x0, y AS y0, lead(x) OVER w AS x1, lead(y) OVER w AS y1, max(x) OVER (PARTITION BY batch) AS hi, min(x) OVER (PARTITION BY batch) AS lo, max_by(y, x) OVER (PARTITION BY batch) AS yhi, min_by(y, x) OVER (PARTITION BY batch) AS ylo FROM u WINDOW w AS (PARTITION BY batch ORDER BY x))
SELECT event_id, round(CASE WHEN value >= hi THEN yhi WHEN value <= lo THEN ylo ELSE y0 + (value - x0) * (y1 - y0) / (x1 - x0) END + 0.00000000123, 5) AS value
FROM e JOIN s ON e.batch = s.batch AND ((value >= x0 AND value < x1) OR (value >= hi AND x0 = hi) OR (value < lo AND x0 = lo))
""")  # fmt: skip
def _(spark, sf):
    e = table(spark, sf, "events").select("event_id", "value", (F.col("user_id") % 2).alias("batch"), "event_type")
    return diagnostics.correct_batch(e, "batch", "event_type", ["value"])[0].select("event_id", F.round(F.col("value") + 0.00000000123, 5).alias("value"))


# ---------------------------------------------------------------- gates, thresholds, conformance
@query("strategy_application", f"""
WITH {CELLS_SQL}, h AS (SELECT sample_id, {_wind('m2', 'm3', TRIANGLE)} AS a, {_wind('m2', 'm4', TRIANGLE)} AS b FROM cells)
SELECT sample_id, CAST(sum(a::INT) AS BIGINT) AS level_1, CAST(sum((a AND b)::INT) AS BIGINT) AS level_2 FROM h GROUP BY 1
""")  # fmt: skip
def _(spark, sf):
    levels = [Level("m2", "m3", TRIANGLE), Level("m2", "m4", TRIANGLE)]
    c = polygons.apply_strategy(polygons.apply_strategy(cells(spark, sf), levels, "one", 1), levels, "two")
    return c.groupBy("sample_id").agg(F.sum(F.col("one").cast("long")).alias("level_1"), F.sum(F.col("two").cast("long")).alias("level_2"))


@query("threshold_scale_qc", f"""
WITH {CELLS_SQL}, t AS (SELECT sample_id, ls AS panel, quantile_cont(m2 * (CASE WHEN sample_id = 'CHINA' THEN 2 ELSE 1 END), 0.9) AS threshold, sample_id < 'F' AS fell FROM cells GROUP BY ALL),
p AS (SELECT a.sample_id, a.panel, a.threshold AS own, b.threshold AS peer FROM t a JOIN t b ON a.panel = b.panel AND a.sample_id <> b.sample_id), m AS (SELECT sample_id, panel, any_value(own) AS own, quantile_cont(peer, 0.5) AS med FROM p GROUP BY 1, 2),
d AS (SELECT p.sample_id, p.panel, abs(any_value(m.own) - any_value(med)) / greatest(1.4826 * quantile_cont(abs(peer - med), 0.5), 0.25) > 3.5 AS o FROM p JOIN m USING (sample_id, panel) GROUP BY 1, 2)
SELECT t.panel, count(*) AS n, round(quantile_cont(threshold, 0.5), 6) AS median, round(min(threshold), 6) AS min, round(max(threshold), 6) AS max, CAST(sum(o::INT) AS BIGINT) AS n_outlier, CAST(sum(fell::INT) AS BIGINT) AS n_fallback
FROM t JOIN d ON d.sample_id = t.sample_id AND d.panel = t.panel GROUP BY 1 HAVING sum(o::INT) > 0
""")  # fmt: skip
def _(spark, sf):
    x = F.col("m2") * F.when(F.col("sample_id") == "CHINA", 2).otherwise(1)
    t = cells(spark, sf).groupBy("sample_id", F.col("ls").alias("panel")).agg(F.percentile(x, F.lit(0.9)).alias("threshold")).withColumn("source", F.when(F.col("sample_id") < "F", "quantile_fallback").otherwise("valley"))
    q = thresholds.scale_qc(thresholds.peer_check(t, ["panel"]), ["panel"])
    return q.select("panel", "n", r6("median"), r6("min"), r6("max"), "n_outlier", "n_fallback")


@query("population_conformance", """
WITH f AS (SELECT l_suppkey % 4 AS population, l_linestatus AS half, l_suppkey, avg(l_quantity) + max(CASE WHEN l_suppkey % 4 = 1 AND l_linestatus = 'F' THEN 9 ELSE 0 END) AS pct FROM lineitem GROUP BY 1, 2, 3),
b AS (SELECT population, count(*) AS n, quantile_cont(pct, 0.5) AS med FROM f WHERE half = 'O' GROUP BY 1), d AS (SELECT f.population, 1.4826 * quantile_cont(abs(pct - med), 0.5) AS mad FROM f JOIN b ON b.population = f.population WHERE half = 'O' GROUP BY 1),
c AS (SELECT population, count(*) AS n, quantile_cont(pct, 0.5) AS med FROM f WHERE half = 'F' GROUP BY 1), z AS (SELECT c.population, c.n, b.n AS bn, c.med, b.med AS bmed, abs(c.med - b.med) / greatest(mad, 0.5) AS z FROM c JOIN b USING (population) JOIN d USING (population))
SELECT 'p' || population AS population, n AS n_samples, bn AS n_samples_baseline, round(med, 5) AS median_pct, round(bmed, 5) AS baseline_pct, CASE WHEN population = 3 THEN NULL ELSE round_even(z, 2) END AS robust_z,
       CASE WHEN population = 3 THEN 'not comparable' WHEN z > 6 THEN 'fail' WHEN z > 3.5 THEN 'qualify' ELSE 'pass' END AS verdict, CASE WHEN population = 3 THEN 'definition changed since the baseline' END AS note FROM z
""")  # fmt: skip
def _(spark, sf):
    k = F.col("l_suppkey")
    f = table(spark, sf, "lineitem").groupBy(F.concat(F.lit("p"), (k % 4).cast("string")).alias("population"), F.col("l_linestatus").alias("half"), k).agg(F.avg("l_quantity").alias("q"))
    f = f.withColumn("pct_of_cd45_pos", F.col("q") + F.when((k % 4 == 1) & (F.col("half") == "F"), 9.0).otherwise(0.0))
    m = conformance.population_conformance(f.filter("half = 'F'"), conformance.population_baseline(f.filter("half = 'O'")), ["p3"])
    return m.select("population", "n_samples", "n_samples_baseline", F.round("median_pct", 5).alias("median_pct"), F.round("baseline_pct", 5).alias("baseline_pct"), "robust_z", "verdict", "note")


@query("panel_keys", f"WITH {_SCORED}, {_MFI} SELECT DISTINCT 'up: ' || population || ', ' || marker AS functional, population || ', ' || marker AS state FROM s")
def _(spark, sf):
    from gatefold.operators import populations

    s, t = _scored(spark, sf)
    m = populations.marker_summary(s, POPS, ["m2", "m3"], t).withColumn("block", F.lit("up"))
    return m.select(functional_key().alias("functional"), state_key().alias("state")).distinct()


@query("clusters_by_size", "WITH n AS (SELECT source, count(*) AS n FROM documents GROUP BY 1), r AS (SELECT source, row_number() OVER (ORDER BY n DESC, source) AS cluster FROM n) SELECT CAST(cluster AS INTEGER) AS cluster, count(*) AS n FROM documents JOIN r USING (source) GROUP BY 1")
def _(spark, sf):
    return clusters.by_size(table(spark, sf, "documents").select("source"), "source").groupBy(F.col("source").alias("cluster")).agg(F.count(F.lit(1)).alias("n"))


@query("replicate_pairs", """
WITH a AS (SELECT o_custkey % 30 AS pair, o_orderstatus AS cond, avg(o_totalprice) AS v FROM orders GROUP BY 1, 2)
SELECT a.cond AS comparison_condition, count(*) AS n_pairs, round(quantile_cont(a.v - b.v, 0.5), 3) AS median_paired_difference FROM a JOIN a b ON a.pair = b.pair AND b.cond = 'F' AND a.cond <> 'F' GROUP BY 1 HAVING count(*) >= 5
""")  # fmt: skip
def _(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("sample_id"), (F.col("o_custkey") % 30).cast("string").alias("pair"), F.col("o_orderstatus").alias("condition"), F.lit("p").alias("population"), F.col("o_totalprice").alias("pct_of_cd45_pos"))
    t = ranks.compare_paired(o.select("sample_id", "population", "pct_of_cd45_pos"), o.select("sample_id", "pair", "condition"))
    return t.select("comparison_condition", "n_pairs", F.round("median_paired_difference", 3).alias("median_paired_difference"))


# ---------------------------------------------------------------- mixing of batches
@query("batch_mixing", """
WITH p AS (SELECT vec_id, CASE WHEN vec_id % 2 = 0 THEN 'a' ELSE 'b' END AS b, list_transform(embedding[1:4], lambda v: round(CAST(v AS DOUBLE), 4)) AS x FROM embeddings),
s AS (SELECT * FROM p),
d AS (SELECT a.vec_id, c.vec_id AS nb, row_number() OVER (PARTITION BY a.vec_id ORDER BY pow(a.x[1] - c.x[1], 2) + pow(a.x[2] - c.x[2], 2) + pow(a.x[3] - c.x[3], 2) + pow(a.x[4] - c.x[4], 2), c.vec_id) AS r FROM s a JOIN s c ON a.vec_id <> c.vec_id),
e AS (SELECT vec_id, nb FROM d WHERE r <= 30), q AS (SELECT vec_id, b, perm FROM s CROSS JOIN range(1, 21) AS t(perm)),
l1 AS (SELECT perm, b, row_number() OVER (PARTITION BY perm ORDER BY md5('42|' || perm || '|' || vec_id), vec_id) AS r FROM q), l2 AS (SELECT perm, vec_id, row_number() OVER (PARTITION BY perm ORDER BY vec_id) AS r FROM q),
lab AS (SELECT perm, l2.vec_id AS nb, l1.b FROM l1 JOIN l2 USING (perm, r) UNION ALL SELECT 0, vec_id, b FROM s),
c AS (SELECT perm, e.vec_id, b, CAST(count(*) AS DOUBLE) AS c FROM e JOIN lab ON e.nb = lab.nb GROUP BY ALL), i AS (SELECT perm, vec_id, sum(c) * sum(c) / sum(c * c) AS lisi FROM c GROUP BY 1, 2), m AS (SELECT perm, quantile_cont(lisi, 0.5) AS m FROM i GROUP BY 1),
o AS (SELECT (SELECT m FROM m WHERE perm = 0) AS obs, (SELECT quantile_cont(m, 0.5) FROM m WHERE perm > 0) AS nul, (SELECT count(*) FROM m WHERE perm > 0 AND m <= (SELECT m FROM m WHERE perm = 0)) AS below, (SELECT count(*) FROM s) AS n)
SELECT 'batch' AS batch_column, n AS n_cells_scored, round_even(obs, 3) AS ilisi_observed_median, round_even(nul, 3) AS ilisi_null_median, round_even((obs - 1) / greatest(nul - 1, 1e-9), 3) AS mixing_fraction, round((below + 1) / 21.0, 4) AS p_empirical,
       CASE WHEN (below + 1) / 21.0 > 0.05 THEN 'no detectable batch structure' WHEN obs / nul > 0.9 THEN 'small batch structure' ELSE 'SUBSTANTIAL batch structure' END AS verdict FROM o
""")  # fmt: skip
def _(spark, sf):
    from gatefold.plans.queries_stats import _points

    p = _points(spark, sf).withColumn("batch", F.when(F.col("vec_id") % 2 == 0, "a").otherwise("b"))
    return diagnostics.batch_mixing(p, "vec_id", "xy", "batch")[0].select("batch_column", "n_cells_scored", "ilisi_observed_median", "ilisi_null_median", "mixing_fraction", "p_empirical", "verdict")


# ---------------------------------------------------------------- figure data
@query("figure_overview", """
WITH d AS (SELECT CASE label % 3 WHEN 0 THEN 'x' WHEN 1 THEN 'y' END AS g, CAST(embedding[1] AS DOUBLE) AS e FROM embeddings), u AS (SELECT g, e FROM d WHERE g IS NOT NULL UNION ALL SELECT 'All samples', e FROM d WHERE g IS NOT NULL)
SELECT g, count(*) AS n, round(avg(e), 6) AS mean FROM u GROUP BY 1
""")  # fmt: skip
def _(spark, sf):
    e = embedding_columns(spark, sf, 1).withColumn("g", F.when(F.col("label") % 3 == 0, "x").when(F.col("label") % 3 == 1, "y"))
    return figures.overview(e, "g").groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("e0"), 6).alias("mean"))


@query("figure_overlay", f"""
WITH {CELLS_SQL}, l AS (SELECT rf AS population, grp, marker, v FROM (SELECT rf, grp, unnest(['m1', 'm2']) AS marker, unnest([m1, m2]) AS v FROM cells)),
s AS (SELECT population, marker, grp, CAST(count(*) AS DOUBLE) AS n, min(v) AS a, max(v) AS b, least(stddev_samp(v), (quantile_cont(v, 0.75) - quantile_cont(v, 0.25)) / 1.34) AS spread FROM l GROUP BY 1, 2, 3),
h AS (SELECT population, marker, grp, min(a) OVER w AS lo, max(b) OVER w AS hi, 0.9 * spread * pow(n, -0.2) AS h FROM s WINDOW w AS (PARTITION BY population, marker)),
b AS (SELECT l.population, l.marker, l.grp, lo, hi, h, least(2047, CAST(floor((v - lo) / (hi - lo) * 2048) AS INTEGER)) AS bin, count(*) AS c FROM l JOIN h ON l.population = h.population AND l.marker = h.marker AND l.grp = h.grp GROUP BY ALL),
g AS (SELECT population, marker, grp, i, any_value(lo + i * (hi - lo) / 31) AS value, sum(c * exp(-pow(((lo + i * (hi - lo) / 31) - (lo + (bin + 0.5) * (hi - lo) / 2048)) / h, 2) / 2)) AS y FROM b CROSS JOIN range(0, 32) AS r(i) GROUP BY 1, 2, 3, 4)
SELECT population, marker, grp AS "group", round(value, 6) AS value, round(y / max(y) OVER (PARTITION BY population, marker, grp) * 100, 5) AS pct FROM g
""")  # fmt: skip
def _(spark, sf):
    c = cells(spark, sf).withColumnRenamed("rf", "population_label")
    return figures.overlay_curves(c, ["m1", "m2"], "grp", points=32).select("population", "marker", "group", r6("value"), F.round("pct", 5).alias("pct"))


@query("figure_cluster_centroids", "SELECT label AS cluster, round(quantile_cont(CAST(embedding[1] AS DOUBLE), 0.5), 6) AS x, round(quantile_cont(CAST(embedding[2] AS DOUBLE), 0.5), 6) AS y, count(*) AS n FROM embeddings GROUP BY 1")
def _(spark, sf):
    return figures.cluster_centroids(embedding_columns(spark, sf, 2), "label", "e0", "e1").select("cluster", r6("x"), r6("y"), "n")


_COUNTS = """c AS (SELECT s_suppkey AS sample_id, r_name AS grp, population, s_acctbal / d AS cells_per_ul, s_suppkey % 7 = 0 AS is_control, CASE WHEN s_suppkey % 5 = 0 THEN 'failed' ELSE 'pass' END AS qc_status
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey CROSS JOIN (VALUES ('T', 1.0), ('B', 4.0), ('NK', 3.0)) AS t(population, d))"""


@query("figure_counts_qc", f"""
WITH {_COUNTS}, r AS (SELECT sample_id, row_number() OVER (ORDER BY grp, sample_id) AS row_order FROM (SELECT DISTINCT grp, sample_id FROM c)), p AS (SELECT population, row_number() OVER (ORDER BY quantile_cont(cells_per_ul, 0.5) DESC, population) AS population_order FROM c GROUP BY 1)
SELECT c.sample_id, c.population, c.sample_id || CASE WHEN is_control THEN ' [control]' WHEN qc_status <> 'pass' THEN ' [QC-failed]' ELSE '' END AS row_label, round(log10(greatest(cells_per_ul, 1.0)), 6) AS fill, CAST(row_order AS INTEGER) AS row_order, CAST(population_order AS INTEGER) AS population_order
FROM c JOIN r USING (sample_id) JOIN p USING (population)
""")  # fmt: skip
def _(spark, sf):
    k = F.col("s_suppkey")
    s = table(spark, sf, "supplier").join(F.broadcast(table(spark, sf, "nation")), F.col("s_nationkey") == F.col("n_nationkey")).join(F.broadcast(table(spark, sf, "region")), F.col("n_regionkey") == F.col("r_regionkey"))
    each = F.explode(F.array(*[F.struct(F.lit(p).alias("population"), (F.col("s_acctbal") / d).alias("cells_per_ul")) for p, d in (("T", 1.0), ("B", 4.0), ("NK", 3.0))]))
    c = s.select(k.alias("sample_id"), F.col("r_name").alias("group"), (k % 7 == 0).alias("is_control"), F.when(k % 5 == 0, "failed").otherwise("pass").alias("qc_status"), each.alias("r")).select("sample_id", "group", "is_control", "qc_status", "r.*")
    return figures.counts_qc(c.drop("group"), c.select("sample_id", "group").distinct()).select("sample_id", "population", "row_label", r6("fill"), "row_order", "population_order")


@query("figure_uncertainty", f"""
WITH {SUPPLIER_SQL}, d AS (SELECT sample_id, grp AS population, value / 1000 AS pct, qty / 4 AS u FROM sv), p AS (SELECT population, quantile_cont(pct, 0.5) AS m, quantile_cont(pct, 0.75) - quantile_cont(pct, 0.25) AS spread, quantile_cont(u, 0.5) AS u FROM d GROUP BY 1),
o AS (SELECT population, CAST(row_number() OVER (ORDER BY m, population) AS INTEGER) AS population_order, u > 0 AND u >= spread AS swamped FROM p)
SELECT sample_id, population, round(greatest(0, pct - u), 6) AS lo, round(pct + u, 6) AS hi, population_order, swamped FROM d JOIN o USING (population)
""")  # fmt: skip
def _(spark, sf):
    s = supplier_values(spark, sf).select("sample_id", F.col("group").alias("population"), (F.col("value") / 1000).alias("pct_of_cd45_pos"), (F.col("qty") / 4).alias("u_pct_points"))
    return figures.frequency_bars(s).select("sample_id", "population", r6("lo"), r6("hi"), "population_order", "swamped")


@query("figure_uncertainty_budget", f"""
WITH {SUPPLIER_SQL}, b AS (SELECT grp AS population, unnest(['CD3', 'CD4']) AS term, unnest([value / 1000, qty]) AS u FROM sv), m AS (SELECT population, term, quantile_cont(u, 0.5) AS u FROM b GROUP BY 1, 2),
t AS (SELECT population, CAST(row_number() OVER (ORDER BY sum(u), population) AS INTEGER) AS population_order FROM m GROUP BY 1) SELECT m.population, term, round(u, 6) AS u_pct_points, population_order FROM m JOIN t USING (population)
""")  # fmt: skip
def _(spark, sf):
    s = supplier_values(spark, sf)
    both = F.explode(F.array(F.struct(F.lit("CD3").alias("term"), (F.col("value") / 1000).alias("u_pct_points")), F.struct(F.lit("CD4").alias("term"), F.col("qty").alias("u_pct_points"))))
    b = s.select("sample_id", F.col("group").alias("population"), both.alias("r")).select("sample_id", "population", "r.*")
    return figures.uncertainty_budget(b).select("population", "term", r6("u_pct_points"), "population_order")


@query("unmatched_cluster_gates")
def _(spark, sf):
    c = cells(spark, sf).withColumn("key", F.xxhash64("sample_id", "m1", "m2", "m4")).withColumn("cluster", F.when((F.col("m2") + 4 * F.col("m4") > 50) & (F.col("m2") < 45), 1).otherwise(2)).withColumn("population_label", F.when(F.col("cluster") == 1, "Other CD45+").otherwise("known"))
    return gate_learning.explain_unmatched(c, ["m2", "m4", "m3"], clusters.agreement(c)[0], "key")[0].select("target", "depth", "marker_x", "marker_y", r6("f1"), "dominant_gate_label", "cluster_purity_pct")
