"""Queries: transforms, sampling, valleys, thresholds, gates and populations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatefold.functions.numeric import asinh_scaled, log10_floor, sinh_scaled
from gatefold.operators import gates, populations, sampling, thresholds, transforms
from gatefold.operators.valley import Valley, density_valley, histogram, setting_grid, smoothed
from gatefold.plans.inputs import CELLS_SQL, cells, table
from gatefold.plans.registry import query


def r6(c: str, name: str | None = None):
    return F.round(c, 6).alias(name or c)


# ---------------------------------------------------------------- transforms
@query("transform_arcsinh", "SELECT event_id, round(asinh((value - 30) / 5.0), 6) AS v FROM events")
def _(spark, sf):
    return table(spark, sf, "events").select("event_id", F.round(asinh_scaled(F.col("value") - 30, 5.0), 6).alias("v"))


@query("transform_log10", "SELECT event_id, round(log10(greatest(value, 1.0)), 6) AS v FROM events")
def _(spark, sf):
    return table(spark, sf, "events").select("event_id", F.round(log10_floor("value"), 6).alias("v"))


@query("transform_inverse", "SELECT event_id, round(value, 4) AS v FROM events")
def _(spark, sf):
    e = table(spark, sf, "events").withColumn("t", asinh_scaled("value", 5.0))
    return e.select("event_id", F.round(sinh_scaled("t", 5.0), 4).alias("v"))


@query("logicle_parameters", """
SELECT event_type, round(CASE WHEN r < 0 THEN greatest(0.0, least((4.5 - log10(t / abs(r))) / 2, 2.25)) ELSE 0.0 END, 6) AS w, round(t, 6) AS t
FROM (SELECT event_type, CASE WHEN max(value - 40) > 0 THEN max(value - 40) ELSE 262144.0 END AS t, quantile_cont(CASE WHEN value - 40 < 0 THEN value - 40 END, 0.05) AS r FROM events GROUP BY 1)
""")  # fmt: skip
def _(spark, sf):
    e = table(spark, sf, "events").select("event_type", (F.col("value") - 40).alias("x"))
    p = transforms.logicle_parameters(e, ["event_type"], "x")
    return p.select("event_type", r6("w"), r6("t"))


@query("logicle_round_trip", "SELECT event_id, CAST(TRUE AS BOOLEAN) AS near FROM events")
def _(spark, sf):
    t = transforms.Transform("logicle", logicle={"x": transforms.Logicle(w=0.8, t=10_000.0)})
    e = table(spark, sf, "events").withColumn("y", t.forward("value", "x"))
    return e.select("event_id", (F.abs(t.inverse("y", "x") - F.col("value")) < 0.05 + 0.002 * F.abs("value")).alias("near"))


@query("cofactor_quartiles", """
WITH q AS (SELECT event_type, quantile_cont(value, 0.05) AS a, quantile_cont(value, 0.60) AS b FROM events GROUP BY 1),
bg AS (SELECT e.event_type, value, row_number() OVER (PARTITION BY e.event_type ORDER BY value) - 1 AS r, count(*) OVER (PARTITION BY e.event_type) AS n
       FROM events e JOIN q ON e.event_type = q.event_type WHERE value > a AND value < b)
SELECT event_type, max(n) AS n, round(max(CASE WHEN r = floor((n - 1) * 0.25) THEN value END), 6) AS q25_lo, round(max(CASE WHEN r = ceil((n - 1) * 0.25) THEN value END), 6) AS q25_hi,
       round(max(CASE WHEN r = floor((n - 1) * 0.75) THEN value END), 6) AS q75_lo, round(max(CASE WHEN r = ceil((n - 1) * 0.75) THEN value END), 6) AS q75_hi
FROM bg GROUP BY 1
""")  # fmt: skip
def _(spark, sf):
    q = transforms.cofactor_quartiles(table(spark, sf, "events"), ["event_type"], "value")
    return q.select("event_type", "n", *[r6(c) for c in ("q25_lo", "q25_hi", "q75_lo", "q75_hi")])


@query("compensate", """
SELECT event_id, round((value - 0.1 * k) / (1 - 0.1 * 0.05), 6) AS a, round((k - 0.05 * value) / (1 - 0.1 * 0.05), 6) AS b
FROM (SELECT event_id, value, CAST(user_id AS DOUBLE) AS k FROM events)
""")  # fmt: skip
def _(spark, sf):
    e = table(spark, sf, "events").select("event_id", F.col("value").alias("a"), F.col("user_id").cast("double").alias("b"))
    return transforms.compensate(e, ["a", "b"], [[1.0, 0.05], [0.1, 1.0]]).select("event_id", r6("a"), r6("b"))


@query("robust_scale", """
WITH m AS (SELECT quantile_cont(value, 0.5) AS med FROM events), d AS (SELECT quantile_cont(abs(value - med), 0.5) * 1.4826 AS mad FROM events, m)
SELECT event_id, round((value - med) / mad, 6) AS value_z FROM events, m, d
""")  # fmt: skip
def _(spark, sf):
    e = table(spark, sf, "events").select("event_id", "value")
    return transforms.scale_features(e, ["value"]).select("event_id", r6("value_z"))


_GRID = [i / 100 for i in range(101)]


@query("quantile_align", f"""
WITH r AS (SELECT quantile_cont(value, {_GRID}) AS ref FROM events), b AS (SELECT event_type, quantile_cont(value, {_GRID}) AS own, count(*) AS n FROM events GROUP BY event_type),
k AS (SELECT event_type, unnest(own) AS x, unnest(ref) AS y, unnest(range(0, 101)) AS i FROM b, r WHERE n >= 10),
u AS (SELECT event_type, x, min_by(y, i) AS y FROM k GROUP BY 1, 2),
s AS (SELECT event_type, x AS x0, y AS y0, lead(x) OVER w AS x1, lead(y) OVER w AS y1, max(x) OVER (PARTITION BY event_type) AS hi, min(x) OVER (PARTITION BY event_type) AS lo,
             max_by(y, x) OVER (PARTITION BY event_type) AS yhi, min_by(y, x) OVER (PARTITION BY event_type) AS ylo FROM u WINDOW w AS (PARTITION BY event_type ORDER BY x))
SELECT event_id, round(CASE WHEN value >= hi THEN yhi WHEN value <= lo THEN ylo ELSE y0 + (value - x0) * (y1 - y0) / (x1 - x0) END + 0.00000000123, 6) AS aligned
FROM events e JOIN s ON e.event_type = s.event_type AND ((value >= x0 AND value < x1) OR (value >= hi AND x0 = hi) OR (value < lo AND x0 = lo))
""")  # fmt: skip
def _(spark, sf):
    out = transforms.align_quantiles(table(spark, sf, "events"), "value", "event_type", "aligned")
    return out.select("event_id", F.round(F.col("aligned") + 0.00000000123, 6).alias("aligned"))


# ---------------------------------------------------------------- sampling
@query("systematic_cap", """
WITH e AS (SELECT event_id, user_id, count(*) OVER (PARTITION BY user_id) AS n, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS r FROM events)
SELECT event_id, user_id FROM e WHERE n <= 25 OR r IN (SELECT unnest(list_transform(range(0, 25), lambda i: CAST(round_even(1 + i * ((n - 1) / 24.0), 0) AS BIGINT))))
""")  # fmt: skip
def _(spark, sf):
    return sampling.systematic_cap(table(spark, sf, "events").select("event_id", "user_id"), "user_id", "event_id", 25)


@query("subsample_plan", """
WITH c AS (SELECT event_type, count(*) AS n FROM events GROUP BY 1), t AS (SELECT event_type, least(5000, n) AS take FROM c), s AS (SELECT sum(take) AS total FROM t)
SELECT event_type, CAST(CASE WHEN total > 1000 THEN greatest(1, floor(take * 1000.0 / total)) ELSE take END AS BIGINT) AS take FROM t, s
""")  # fmt: skip
def _(spark, sf):
    c = table(spark, sf, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    return sampling.plan_subsample(c, "event_type", "n", 5000, False, 1000)


@query("hash_sample_quota", """
SELECT event_id, user_id FROM (SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY md5('42|' || user_id || '|' || event_id), event_id) AS r FROM events) WHERE r <= 10
""")  # fmt: skip
def _(spark, sf):
    e = table(spark, sf, "events").select("event_id", "user_id")
    quota = e.select("user_id").distinct().withColumn("take", F.lit(10))
    return sampling.draw(e, quota, "user_id", "event_id", 42).select("event_id", "user_id")


@query("stratified_split", """
WITH d AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY md5('7|' || doc_id), doc_id) AS r, count(*) OVER (PARTITION BY lang) AS n FROM documents)
SELECT doc_id, lang, r <= floor(n * 0.3) AS is_test FROM d
""")  # fmt: skip
def _(spark, sf):
    return sampling.stratified_split(table(spark, sf, "documents").select("doc_id", "lang"), "lang", "doc_id", 0.3, 7)


@query("panel_fingerprint", """
WITH s AS (SELECT user_id, string_agg(DISTINCT event_type, '|' ORDER BY event_type) AS marker_set, min(event_id) AS first FROM events GROUP BY 1),
f AS (SELECT marker_set, min(first) AS f FROM s GROUP BY 1), i AS (SELECT marker_set, CAST(row_number() OVER (ORDER BY f) AS INTEGER) AS panel_i FROM f)
SELECT user_id, marker_set, panel_i FROM s JOIN i USING (marker_set)
""")  # fmt: skip
def _(spark, sf):
    from gatefold.sources.events import fingerprint_panels

    ch = table(spark, sf, "events").select(F.col("user_id").alias("sample_id"), F.col("event_type").alias("symbol"), F.col("event_id").alias("seen"))
    return fingerprint_panels(ch, "seen").select(F.col("sample_id").alias("user_id"), "marker_set", "panel_i")


# ---------------------------------------------------------------- valley
HIST = Valley(bins=60, smooth=3)
_HISTOGRAM = """
v AS (SELECT {key}, {x} AS x FROM {src} WHERE {x} IS NOT NULL),
q AS (SELECT {key}, count(*) AS n, round(quantile_cont(x, {lq}), 9) AS lo, round(quantile_cont(x, {hq}), 9) AS hi FROM v GROUP BY {key}),
g AS (SELECT *, (hi - lo) / {bins} AS w FROM q WHERE n >= 500 AND hi > lo),
b AS (SELECT v.{key}, greatest(1, least({bins}, CAST(ceil((x - lo) / w) AS INTEGER))) AS bin, count(*) AS c FROM v JOIN g ON v.{key} = g.{key} WHERE x >= lo AND x <= hi GROUP BY ALL),
d AS (SELECT g.{key}, i AS bin, coalesce(c, 0) AS c, lo, w, n FROM g CROSS JOIN range(1, {bins} + 1) AS r(i) LEFT JOIN b ON b.{key} = g.{key} AND b.bin = i),
y AS (SELECT *, CASE WHEN bin > {k} AND bin <= {bins} - {k} THEN CAST(sum(c) OVER (PARTITION BY {key} ORDER BY bin ROWS BETWEEN {k} PRECEDING AND {k} FOLLOWING) AS DOUBLE) / {wide} ELSE CAST(c AS DOUBLE) END AS ys FROM d)"""
_VALLEY = """
z AS (SELECT *, lag(ys) OVER o AS pre, lead(ys) OVER o AS nxt, max(ys) OVER (PARTITION BY {key}) AS mx, sum(ys) OVER (PARTITION BY {key}) AS tot,
             sum(ys) OVER (PARTITION BY {key} ORDER BY bin DESC) AS tail FROM y WINDOW o AS (PARTITION BY {key} ORDER BY bin)),
pk AS (SELECT {key}, bin, ys, mx, tot FROM z WHERE bin BETWEEN 2 AND {bins} - 1 AND ys >= pre AND ys >= nxt AND ys > {peak} * mx),
np AS (SELECT {key}, count(*) AS n_peaks FROM pk GROUP BY {key}),
pr AS (SELECT a.{key}, a.bin AS a, b.bin AS b, least(a.ys, b.ys) AS lo2, a.tot FROM pk a JOIN pk b ON a.{key} = b.{key} AND b.bin - a.bin >= {gap} * ({bins} - 1) AND a.bin < b.bin),
cd AS (SELECT pr.{key}, a, b, any_value(lo2) AS lo2, any_value(pr.tot) AS tot, min_by(z.bin, z.ys * 100000 + z.bin / 1000.0) AS v, min(z.ys) AS low, min_by(z.tail, z.ys * 100000 + z.bin / 1000.0) AS upper
       FROM pr JOIN z ON z.{key} = pr.{key} AND z.bin BETWEEN a AND b GROUP BY pr.{key}, a, b),
sc AS (SELECT *, (lo2 - low) / lo2 AS rel, (lo2 - low) / lo2 + 0.05 * (b - a) / ({bins} - 1) AS score FROM cd),
ok AS (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY score DESC, a, b) AS r FROM sc WHERE rel > 0 AND rel >= {depth} AND upper >= 0.002 * tot)"""


def valley_sql(key: str, x: str, src: str, s: Valley) -> str:
    """CTEs v, q, g, b, d, y, z, pk, np, pr, cd, sc and ok (r = 1: the best pair) of a valley search."""
    k = max(1, int(s.smooth))
    f = dict(key=key, x=x, src=src, lq=s.low_q, hq=s.high_q, bins=s.bins, k=k, wide=float(2 * k + 1), peak=s.peak_frac, gap=s.min_gap_frac, depth=s.min_rel_depth)
    return (_HISTOGRAM + "," + _VALLEY).format(**f)


def histogram_sql(key: str, x: str, src: str, s: Valley) -> str:
    k = max(1, int(s.smooth))
    return _HISTOGRAM.format(key=key, x=x, src=src, lq=s.low_q, hq=s.high_q, bins=s.bins, k=k, wide=float(2 * k + 1))


@query("histogram_smooth", f"WITH {CELLS_SQL}, {histogram_sql('sample_id', 'm1', 'cells', HIST)} SELECT sample_id, CAST(bin AS INTEGER) AS bin, CAST(c AS BIGINT) AS n, round(ys, 6) AS ys FROM y")
def _(spark, sf):
    h = histogram(cells(spark, sf), ["sample_id"], "m1", HIST).filter("counts is not null")
    h = h.withColumn("ys", smoothed(F.col("counts"), HIST.bins, 3))
    return h.select("sample_id", F.posexplode(F.arrays_zip("counts", "ys")).alias("i", "z")).select("sample_id", (F.col("i") + 1).alias("bin"), F.col("z.counts").alias("n"), F.round("z.ys", 6).alias("ys"))


_CUT = "SELECT q.{key} AS {key}, q.n AS n, round(g.lo + (ok.v - 0.5) * g.w, 6) AS cut, round(ok.rel, 6) AS rel_depth FROM q LEFT JOIN g ON q.{key} = g.{key} LEFT JOIN ok ON ok.{key} = q.{key} AND ok.r = 1"


@query("density_valley", f"WITH {CELLS_SQL}, {valley_sql('sample_id', 'm1', 'cells', Valley())} " + _CUT.format(key="sample_id"))
def density_valley_query(spark, sf):
    v = density_valley(cells(spark, sf), ["sample_id"], "m1")
    return v.select("sample_id", "n", r6("cut"), r6("rel_depth"))


@query("density_valley_unimodal", f"WITH {CELLS_SQL}, {valley_sql('sample_id', 'm2', 'cells', Valley(bins=40))} " + _CUT.format(key="sample_id"))
def _(spark, sf):
    v = density_valley(cells(spark, sf).select("sample_id", "m2"), ["sample_id"], "m2", Valley(bins=40))
    return v.select("sample_id", "n", r6("cut"), r6("rel_depth"))


_SOME = [setting_grid()[i] for i in (0, 13, 26)]


def _grid_sql() -> str:
    parts = [f"(WITH {valley_sql('grp', 'm1', 'cells', s)} SELECT '{i}' AS setting, q.grp AS grp, round(g.lo + (ok.v - 0.5) * g.w, 6) AS cut FROM q LEFT JOIN g ON q.grp = g.grp LEFT JOIN ok ON ok.grp = q.grp AND ok.r = 1)" for i, s in enumerate(_SOME)]
    return f"WITH {CELLS_SQL} SELECT * FROM " + " UNION ALL SELECT * FROM ".join(parts)


@query("valley_setting_grid", _grid_sql())
def _(spark, sf):
    c, out = cells(spark, sf).select("grp", "m1"), None
    for i, s in enumerate(_SOME):
        one = density_valley(c, ["grp"], "m1", s).select(F.lit(str(i)).alias("setting"), "grp", r6("cut"))
        out = one if out is None else out.unionByName(one)
    return out


# ---------------------------------------------------------------- thresholds and gates
@query("resolve_threshold", f"""
WITH {CELLS_SQL}, cfg AS (SELECT 'FRANCE' AS sample_id, 9.5 AS cfg_value), ctl AS (SELECT quantile_cont(m1, 0.995) - 3 AS ctrl FROM cells WHERE grp = 'ASIA'),
{valley_sql('sample_id', 'm1', 'cells', Valley())}, cut AS (SELECT g.sample_id, g.lo + (ok.v - 0.5) * g.w AS cut FROM g JOIN ok ON ok.sample_id = g.sample_id AND ok.r = 1),
own AS (SELECT sample_id, quantile_cont(m1, 0.9) AS fb FROM cells GROUP BY 1),
t AS (SELECT own.sample_id, fb, cut, cfg_value, ctrl FROM own LEFT JOIN cut USING (sample_id) LEFT JOIN cfg USING (sample_id), ctl)
SELECT sample_id, round(CASE WHEN cfg_value IS NOT NULL THEN cfg_value WHEN cut < ctrl THEN ctrl WHEN cut IS NOT NULL THEN cut WHEN ctrl IS NOT NULL THEN ctrl ELSE fb END, 6) AS threshold,
       CASE WHEN cfg_value IS NOT NULL THEN 'config' WHEN cut < ctrl THEN 'control_q995_valley_rejected' WHEN cut IS NOT NULL THEN 'valley' WHEN ctrl IS NOT NULL THEN 'control_q995' ELSE 'quantile_fallback' END AS source,
       cfg_value IS NULL AND cut IS NULL AND ctrl IS NULL AS needs_review FROM t
""")  # fmt: skip
def _(spark, sf):
    c = cells(spark, sf)
    cfg = spark.createDataFrame([("FRANCE", 9.5)], "sample_id string, cfg_value double")
    # the control's values, three units lower, so that both branches occur
    ctl = c.filter("grp = 'ASIA'").select((F.col("m1") - 3).alias("m1"))
    return thresholds.resolve(c, ["sample_id"], "m1", cfg, ctl).select("sample_id", r6("threshold"), "source", "needs_review")


@query("peer_threshold_check", f"""
WITH {CELLS_SQL}, t AS (SELECT sample_id, ls AS panel, 'm2' AS marker, round(quantile_cont(m2 * (CASE WHEN sample_id = 'CHINA' THEN 2 ELSE 1 END), 0.9), 6) AS threshold FROM cells GROUP BY ALL),
p AS (SELECT a.sample_id, a.panel, a.threshold AS own, b.threshold AS peer FROM t a JOIN t b ON a.panel = b.panel AND a.sample_id <> b.sample_id),
m AS (SELECT sample_id, panel, any_value(own) AS own, quantile_cont(peer, 0.5) AS med, count(*) AS k FROM p GROUP BY 1, 2),
d AS (SELECT p.sample_id, p.panel, quantile_cont(abs(peer - med), 0.5) AS mad FROM p JOIN m USING (sample_id, panel) GROUP BY 1, 2)
SELECT sample_id, panel, own AS threshold, CASE WHEN k >= 3 THEN round(med, 6) END AS peer_median, CASE WHEN k >= 3 THEN round(abs(own - med) / greatest(1.4826 * mad, 0.25), 6) END AS robust_z,
       coalesce(k >= 3 AND abs(own - med) / greatest(1.4826 * mad, 0.25) > 3.5, FALSE) AS scale_outlier FROM m JOIN d USING (sample_id, panel)
""")  # fmt: skip
def _(spark, sf):
    c = cells(spark, sf)
    x = F.col("m2") * F.when(F.col("sample_id") == "CHINA", 2).otherwise(1)
    t = c.groupBy("sample_id", F.col("ls").alias("panel")).agg(F.round(F.percentile(x, F.lit(0.9)), 6).alias("threshold")).withColumn("marker", F.lit("m2"))
    p = thresholds.peer_check(t, ["panel", "marker"])
    return p.select("sample_id", "panel", "threshold", r6("peer_median"), r6("robust_z"), "scale_outlier")


@query("singlet_band", f"""
WITH {CELLS_SQL}, r AS (SELECT sample_id, m3 / greatest(m4, 1.0) AS r FROM cells), m AS (SELECT sample_id, quantile_cont(r, 0.5) AS med, stddev_samp(r) AS sd FROM r GROUP BY 1),
d AS (SELECT sample_id, 1.4826 * quantile_cont(abs(r - med), 0.5) AS mad FROM r JOIN m USING (sample_id) GROUP BY 1)
SELECT sample_id, round(med, 6) AS median, round(CASE WHEN mad > 0 THEN mad ELSE sd END, 6) AS mad, round(med - 3 * CASE WHEN mad > 0 THEN mad ELSE sd END, 6) AS lo, round(med + 3 * CASE WHEN mad > 0 THEN mad ELSE sd END, 6) AS hi
FROM m JOIN d USING (sample_id)
""")  # fmt: skip
def _(spark, sf):
    b = gates.singlet_bounds(cells(spark, sf), "sample_id", gates.height_ratio("m3", "m4"))
    return b.select("sample_id", *[r6(c) for c in ("median", "mad", "lo", "hi")])


@query("scatter_window", f"""
WITH {CELLS_SQL}, e AS (SELECT sample_id, round(log10(greatest(exp(m1), 1.0)), 9) AS f, log10(greatest(m2, 1.0)) AS s FROM cells),
{valley_sql('sample_id', 'f', 'e', Valley(bins=240, smooth=5, min_gap_frac=0.10))}, c AS (SELECT g.sample_id, g.lo + (ok.v - 0.5) * g.w AS cut FROM g JOIN ok ON ok.sample_id = g.sample_id AND ok.r = 1),
h AS (SELECT sample_id, quantile_cont(f, 0.6) AS fb, quantile_cont(f, 0.999) AS hi FROM e GROUP BY 1), k AS (SELECT h.sample_id, coalesce(cut, fb) AS lo, hi, cut IS NULL AS fell FROM h LEFT JOIN c USING (sample_id))
SELECT k.sample_id, round(any_value(k.lo), 5) AS fsc_lo, round(any_value(k.hi), 5) AS fsc_hi, round(quantile_cont(s, 0.005), 5) AS ssc_lo, round(quantile_cont(s, 0.995), 5) AS ssc_hi, any_value(fell) AS fsc_fallback
FROM k JOIN e ON e.sample_id = k.sample_id AND f > k.lo AND f < k.hi GROUP BY 1
""")  # fmt: skip
def _(spark, sf):
    c = cells(spark, sf).select("sample_id", F.pow(F.lit(10.0), F.round(F.log10(F.exp("m1")), 9)).alias("fsc"), F.col("m2").alias("ssc"))
    b = gates.scatter_bounds(c, "sample_id", "fsc", "ssc")
    return b.select("sample_id", *[F.round(x, 5).alias(x) for x in ("fsc_lo", "fsc_hi", "ssc_lo", "ssc_hi")], "fsc_fallback")


@query("gate_hierarchy_counts", f"""
WITH {CELLS_SQL}, g AS (SELECT sample_id, count(*) AS a, sum((m2 > 10)::INT) AS b, sum((m2 > 10 AND m3 < 9)::INT) AS c, sum((m2 > 10 AND m3 < 9 AND m4 < 7)::INT) AS d, sum((m2 > 10 AND m3 < 9 AND m4 < 7 AND m1 > 11)::INT) AS e FROM cells GROUP BY 1),
u AS (SELECT sample_id, a, unnest(['all_events', 'leukocytes', 'single_cells', 'live_cells', 'cd45_pos']) AS gate, unnest([a, b, c, d, e]) AS n, unnest([a, a, b, c, d]) AS p FROM g)
SELECT sample_id, gate, CAST(n AS BIGINT) AS count, round(100.0 * n / greatest(p, 1), 6) AS pct_of_parent, round(100.0 * n / greatest(a, 1), 6) AS pct_of_all FROM u
""")  # fmt: skip
def _(spark, sf):
    c = cells(spark, sf).withColumn("all_events", F.lit(True)).withColumn("leukocytes", F.col("m2") > 10)
    c = c.withColumn("single_cells", F.col("leukocytes") & (F.col("m3") < 9)).withColumn("live_cells", F.col("single_cells") & (F.col("m4") < 7)).withColumn("cd45_pos", F.col("live_cells") & (F.col("m1") > 11))
    return gates.gate_counts(c).select("sample_id", "gate", "count", r6("pct_of_parent"), r6("pct_of_all"))


@query("staining_verdict", """
WITH c AS (SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN TRUE WHEN 1 THEN FALSE END AS is_control, CASE c_custkey % 5 WHEN 0 THEN 'quantile_fallback' WHEN 1 THEN 'skipped' ELSE 'valley' END AS cd45_source,
           CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_acctbal / 100 END AS pct FROM customer),
p AS (SELECT *, coalesce(cd45_source = 'quantile_fallback' OR (cd45_source <> 'skipped' AND NOT coalesce(pct >= 5, FALSE)), FALSE) AS poor FROM c)
SELECT c_custkey, CASE WHEN coalesce(is_control, FALSE) THEN 'control' WHEN poor AND is_control IS NULL THEN 'control' WHEN poor THEN 'failed' ELSE 'pass' END AS qc_status,
       NOT coalesce(is_control, FALSE) AND NOT poor AS included FROM p
""")  # fmt: skip
def _(spark, sf):
    k = F.col("c_custkey")
    c = table(spark, sf, "customer").select(
        k, F.when(k % 3 == 0, True).when(k % 3 == 1, False).alias("is_control"), F.when(k % 5 == 0, "quantile_fallback").when(k % 5 == 1, "skipped").otherwise("valley").alias("cd45_source"),
        F.when(k % 7 != 0, F.col("c_acctbal") / 100).alias("pct"),
    )
    return gates.staining_verdict(c, pct="pct").select("c_custkey", "qc_status", "included")


def _cut_sql(x: str, src: str, settings: Valley = Valley()) -> str:
    """The valley cut of x by sample_id."""
    return f"(WITH {valley_sql('sample_id', x, src, settings)} SELECT g.sample_id, g.lo + (ok.v - 0.5) * g.w AS cut FROM g JOIN ok ON ok.sample_id = g.sample_id AND ok.r = 1)"


_CHAIN = f"""
c0 AS (SELECT sample_id, m2 * 1000 AS fa, m2 * (500 + m4) AS fh, m3 * 100 AS sa, m1 - 10 AS viab, m1 AS cd45, log10(greatest(m2 * 1000, 1.0)) AS lf, log10(greatest(m3 * 100, 1.0)) AS ls FROM cells),
q0 AS (SELECT sample_id, quantile_cont(lf, 0.6) AS fb, quantile_cont(lf, 0.999) AS hi FROM c0 GROUP BY 1), k0 AS (SELECT q0.sample_id, coalesce(v.cut, fb) AS flo, hi AS fhi FROM q0 LEFT JOIN {_cut_sql('lf', 'c0', gates.SCATTER)} v ON v.sample_id = q0.sample_id),
w0 AS (SELECT c0.sample_id, any_value(flo) AS flo, any_value(fhi) AS fhi, quantile_cont(ls, 0.005) AS slo, quantile_cont(ls, 0.995) AS shi FROM c0 JOIN k0 ON k0.sample_id = c0.sample_id AND lf > flo AND lf < fhi GROUP BY 1),
c1 AS (SELECT c0.*, fh / greatest(fa, 1.0) AS ratio FROM c0 JOIN w0 ON w0.sample_id = c0.sample_id AND lf > flo AND lf < fhi AND ls > slo AND ls < shi),
m1_ AS (SELECT sample_id, quantile_cont(ratio, 0.5) AS med, stddev_samp(ratio) AS sd FROM c1 GROUP BY 1), d1 AS (SELECT c1.sample_id, 1.4826 * quantile_cont(abs(ratio - med), 0.5) AS mad FROM c1 JOIN m1_ ON m1_.sample_id = c1.sample_id GROUP BY 1),
b1 AS (SELECT m1_.sample_id, med - 3 * CASE WHEN mad > 0 THEN mad ELSE sd END AS lo, med + 3 * CASE WHEN mad > 0 THEN mad ELSE sd END AS hi FROM m1_ JOIN d1 ON d1.sample_id = m1_.sample_id),
c2 AS (SELECT c1.* FROM c1 JOIN b1 ON b1.sample_id = c1.sample_id AND ratio > lo AND ratio < hi),
t2 AS (SELECT f.sample_id, coalesce(v.cut, f.fb) AS t FROM (SELECT sample_id, quantile_cont(viab, 0.9) AS fb FROM c2 GROUP BY 1) f LEFT JOIN {_cut_sql('viab', 'c2')} v ON v.sample_id = f.sample_id),
c3 AS (SELECT c2.* FROM c2 JOIN t2 ON t2.sample_id = c2.sample_id AND viab < t),
t3 AS (SELECT f.sample_id, coalesce(v.cut, f.fb) AS t FROM (SELECT sample_id, quantile_cont(cd45, 0.9) AS fb FROM c3 GROUP BY 1) f LEFT JOIN {_cut_sql('cd45', 'c3')} v ON v.sample_id = f.sample_id),
c4 AS (SELECT c3.* FROM c3 JOIN t3 ON t3.sample_id = c3.sample_id AND cd45 > t),
n AS (SELECT sample_id, 1 AS i, 'all_events' AS gate, count(*) AS n FROM c0 GROUP BY 1 UNION ALL SELECT sample_id, 2, 'leukocytes', count(*) FROM c1 GROUP BY 1 UNION ALL SELECT sample_id, 3, 'single_cells', count(*) FROM c2 GROUP BY 1
  UNION ALL SELECT sample_id, 4, 'live_cells', count(*) FROM c3 GROUP BY 1 UNION ALL SELECT sample_id, 5, 'cd45_pos', count(*) FROM c4 GROUP BY 1),
a AS (SELECT s.sample_id, g.i, g.gate, coalesce(n.n, 0) AS n FROM (SELECT DISTINCT sample_id FROM c0) s CROSS JOIN (SELECT DISTINCT i, gate FROM n) g LEFT JOIN n ON n.sample_id = s.sample_id AND n.i = g.i)"""


@query("gate_chain", f"""
WITH {CELLS_SQL}, {_CHAIN} SELECT sample_id, gate, CAST(n AS BIGINT) AS count, round(100.0 * n / greatest(coalesce(lag(n) OVER o, n), 1), 6) AS pct_of_parent, round(100.0 * n / greatest(first_value(n) OVER o, 1), 6) AS pct_of_all FROM a WINDOW o AS (PARTITION BY sample_id ORDER BY i)
""")  # fmt: skip
def _(spark, sf):
    c = cells(spark, sf).select("sample_id", (F.col("m2") * 1000).alias("FSC-A"), (F.col("m2") * (500 + F.col("m4"))).alias("FSC-H"), (F.col("m3") * 100).alias("SSC-A"), (F.col("m1") - 10).alias("viability"), F.col("m1").alias("CD45"))
    gated, _ = gates.gate_events(c, viability="viability")
    return gates.gate_counts(gated).select("sample_id", "gate", "count", r6("pct_of_parent"), r6("pct_of_all"))


# ---------------------------------------------------------------- populations
SPEC = {
    "A high": {"m1": "above"}, "A high B high": {"m1": "above", "m2": "above"}, "A low": {"m1": "below"}, "B mid": {"m2": "intermediate"},
    "C or D": {"m1": "above", "any_of": {"m3": "above", "m4": "above"}}, "missing": {"m9": "above"},
}
POPS = [p for p in SPEC if p != "missing"]
_SCORED = f"""{CELLS_SQL}, t AS (SELECT sample_id, round(quantile_cont(m1, 0.5), 6) AS t1, round(quantile_cont(m2, 0.4), 6) AS t2, 8.5 AS t3, 6.5 AS t4, 40.5 AS h2 FROM cells GROUP BY 1),
p AS (SELECT c.*, ls = 'O' AS parent, ls = 'O' AND m1 > t1 AS p0, ls = 'O' AND m1 > t1 AND m2 > t2 AS p1, ls = 'O' AND m1 < t1 AS p2, ls = 'O' AND m2 > t2 AND m2 < h2 AS p3, ls = 'O' AND m1 > t1 AND (m3 > t3 OR m4 > t4) AS p4, t1, t2, t3, t4
      FROM cells c JOIN t USING (sample_id))"""


def _thresholds(c: DataFrame) -> DataFrame:
    q = c.groupBy("sample_id").agg(F.round(F.percentile("m1", F.lit(0.5)), 6).alias("m1"), F.round(F.percentile("m2", F.lit(0.4)), 6).alias("m2"), F.lit(8.5).alias("m3"), F.lit(6.5).alias("m4"))
    return q.unpivot("sample_id", ["m1", "m2", "m3", "m4"], "marker", "threshold")


def _bounds(c: DataFrame) -> DataFrame:
    return c.select("sample_id").distinct().select("sample_id", F.lit("m2").alias("marker"), F.lit(40.5).alias("threshold"))


def _scored(spark, sf) -> tuple[DataFrame, DataFrame]:
    c = cells(spark, sf).withColumn("parent", F.col("ls") == "O")
    t = _thresholds(c)
    return populations.score(c, t, SPEC, "parent", bounds=_bounds(c)), t


@query("population_labels", f"""
WITH {_SCORED} SELECT sample_id, CASE WHEN NOT parent THEN NULL WHEN p1 THEN 'A high B high' WHEN p4 THEN 'C or D' WHEN p0 THEN 'A high' WHEN p2 THEN 'A low' WHEN p3 THEN 'B mid' ELSE 'Other CD45+' END AS population_label, count(*) AS n FROM p GROUP BY ALL
""")  # fmt: skip
def _(spark, sf):
    return _scored(spark, sf)[0].groupBy("sample_id", "population_label").agg(F.count(F.lit(1)).alias("n"))


_FREQ = "f AS (SELECT sample_id, unnest(['A high', 'A high B high', 'A low', 'B mid', 'C or D']) AS population, unnest([sum(p0::INT), sum(p1::INT), sum(p2::INT), sum(p3::INT), sum(p4::INT)]) AS n, greatest(sum(parent::INT), 1) AS d FROM p GROUP BY sample_id)"


@query("population_frequencies", f"WITH {_SCORED}, {_FREQ} SELECT sample_id, population, CAST(n AS BIGINT) AS count, round(100.0 * n / d, 6) AS pct_of_cd45_pos FROM f")
def _(spark, sf):
    return populations.frequencies(_scored(spark, sf)[0], POPS, "parent").select("sample_id", "population", "count", r6("pct_of_cd45_pos"))


@query("populations_unavailable", f"WITH {CELLS_SQL} SELECT DISTINCT sample_id, 'missing' AS population, 'm9 not in panel' AS reason FROM cells")
def _(spark, sf):
    c = cells(spark, sf)
    return populations.unavailable(_thresholds(c), SPEC, c.columns, bounds=_bounds(c))


_MFI = """x AS (SELECT sample_id, population, marker, v, v > th AS pos FROM (SELECT sample_id, unnest(['A high', 'A high B high', 'A low', 'B mid', 'C or D']) AS population, unnest([p0, p1, p2, p3, p4]) AS hit, m2, m3, t2, t3 FROM p),
 LATERAL (SELECT unnest(['m2', 'm3']) AS marker, unnest([m2, m3]) AS v, unnest([t2, t3]) AS th) WHERE hit),
s AS (SELECT sample_id, population, marker, count(*) AS n_cells, round(quantile_cont(v, 0.5), 6) AS median_asinh, round(100.0 * avg(pos::INT), 6) AS pct_positive FROM x GROUP BY 1, 2, 3 HAVING count(*) >= 10)"""


@query("population_marker_mfi", f"WITH {_SCORED}, {_MFI} SELECT * FROM s")
def _(spark, sf):
    s, t = _scored(spark, sf)
    m = populations.marker_summary(s, POPS, ["m2", "m3"], t)
    return m.select("sample_id", "population", "marker", "n_cells", r6("median_asinh"), r6("pct_positive"))


@query("functional_blocks", f"WITH {_SCORED}, {_MFI} SELECT s.*, 'up' AS block FROM s WHERE marker = 'm3' AND population IN ('A high', 'A high B high', 'C or D')")
def _(spark, sf):
    s, t = _scored(spark, sf)
    m = populations.marker_summary(s, POPS, ["m2", "m3"], t)
    f = populations.functional(m, {"up": {"markers": ["m3"], "require": "m1"}}, SPEC)
    return f.select("sample_id", "population", "marker", "n_cells", r6("median_asinh"), r6("pct_positive"), "block")


@query("population_ratios", f"""
WITH {_SCORED}, {_FREQ}, w AS (SELECT sample_id, max(CASE WHEN population = 'A high B high' THEN 100.0 * n / d END) AS a, max(CASE WHEN population = 'A low' THEN 100.0 * n / d END) AS b FROM f GROUP BY 1)
SELECT sample_id, 'up/down' AS ratio, round(a, 6) AS numerator_pct, round(b, 6) AS denominator_pct, CASE WHEN b > 0 THEN round(a / b, 6) END AS value FROM w
""")  # fmt: skip
def _(spark, sf):
    f = populations.frequencies(_scored(spark, sf)[0], POPS, "parent")
    r = populations.ratios(f, {"up/down": ("A high B high", "A low")})
    return r.select("sample_id", "ratio", r6("numerator_pct"), r6("denominator_pct"), r6("value"))


@query("population_intermediate", f"""
WITH {CELLS_SQL}, t AS (SELECT grp AS sample_id, round(quantile_cont(m1, 0.02), 6) AS t1 FROM cells GROUP BY 1), up AS (SELECT grp AS sample_id, m1 FROM cells JOIN t ON grp = t.sample_id WHERE m1 > t1),
{valley_sql('sample_id', 'm1', 'up', Valley(bins=180, min_gap_frac=0.08))} SELECT g.sample_id, 'm1' AS marker, round(g.lo + (ok.v - 0.5) * g.w, 6) AS threshold FROM g JOIN ok ON ok.sample_id = g.sample_id AND ok.r = 1
""")  # fmt: skip
def _(spark, sf):
    c = cells(spark, sf).select(F.col("grp").alias("sample_id"), "m1")
    t = c.groupBy("sample_id").agg(F.round(F.percentile("m1", F.lit(0.02)), 6).alias("threshold")).withColumn("marker", F.lit("m1"))
    return populations.intermediate_bounds(c, t, {"mid": {"m1": "intermediate"}}).select("sample_id", "marker", r6("threshold"))


