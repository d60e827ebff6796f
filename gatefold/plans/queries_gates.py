"""Queries: polygon gates, learned gates, uncertainty, metadata, files, figure data."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from gatefold.functions.storage import cut, storage_root
from gatefold.operators import embedding, gate_learning, layout, neighbours, polygons, populations, ranks, uncertainty
from gatefold.operators.polygons import Level
from gatefold.operators.transforms import Transform
from gatefold.operators.valley import INTERMEDIATE
from gatefold.plans import figures
from gatefold.plans.inputs import CELLS_SQL, SUPPLIER_SQL, cells, embedding_columns, supplier_values, table
from gatefold.plans.queries_gating import _MFI, _SCORED, POPS, SPEC, _scored, _thresholds, r6, valley_sql
from gatefold.plans.registry import query
from gatefold.sources import events as ev
from gatefold.sources import fcs, fcs_source, metadata

TRIANGLE = ((10.0, 0.5), (45.0, 2.5), (20.0, 9.5))


def _wind(x: str, y: str, v) -> str:
    out = []
    for (x0, y0), (x1, y1) in zip(v, v[1:] + v[:1], strict=True):
        side = f"(({x1} - {x0}) * ({y} - {y0}) - ({x} - {x0}) * ({y1} - {y0}))"
        out.append(f"CASE WHEN {y} >= {y0} AND {y} < {y1} AND {side} > 0 THEN 1 ELSE 0 END" if y1 > y0 else f"CASE WHEN {y} >= {y1} AND {y} < {y0} AND {side} < 0 THEN -1 ELSE 0 END")
    return "(" + " + ".join(out) + ") <> 0"


@query("point_in_polygon", f"WITH {CELLS_SQL} SELECT sample_id, count(*) AS n, CAST(sum(({_wind('m2', 'm3', TRIANGLE)})::INT) AS BIGINT) AS n_inside FROM cells GROUP BY 1")
def _(spark, sf):
    c = cells(spark, sf).withColumn("hit", polygons.inside("m2", "m3", TRIANGLE))
    return c.groupBy("sample_id").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("hit").cast("long")).alias("n_inside"))


@query("gate_metrics", f"""
WITH {CELLS_SQL}, h AS (SELECT {_wind('m2', 'm3', TRIANGLE)} AS g, rf = 'R' AS t FROM cells), n AS (SELECT sum((g AND t)::INT) AS tp, sum(g::INT) AS n_in, sum(t::INT) AS n_target FROM h)
SELECT CAST(tp AS BIGINT) AS tp, CAST(n_in AS BIGINT) AS n_in, CAST(n_target AS BIGINT) AS n_target, round(tp / n_in, 6) AS "precision", round(tp / n_target, 6) AS recall, round(2 * (tp / n_in) * (tp / n_target) / (tp / n_in + tp / n_target), 6) AS f1 FROM n
""")  # fmt: skip
def _(spark, sf):
    c = polygons.apply_strategy(cells(spark, sf), [Level("m2", "m3", TRIANGLE)]).withColumn("t", F.col("rf") == "R")
    m = polygons.gate_metrics(c, "in_gate", "t")
    return m.select("tp", "n_in", "n_target", r6("precision"), r6("recall"), r6("f1"))


_E4 = [f"CAST(embedding[{i + 1}] AS DOUBLE) AS e{i}" for i in range(4)]


@query("gate_marker_ranking", f"""
WITH e AS (SELECT label = 3 AS t, {', '.join(_E4)} FROM embeddings), u AS (SELECT t, unnest(['e0', 'e1', 'e2', 'e3']) AS marker, unnest([e0, e1, e2, e3]) AS x FROM e),
s AS (SELECT marker, max(x) - min(x) AS w, quantile_cont(CASE WHEN t THEN x END, [0.5, 0.01, 0.99]) AS a, quantile_cont(CASE WHEN NOT t THEN x END, [0.5, 0.01, 0.99]) AS b FROM u GROUP BY 1)
SELECT marker, round((pow((a[1] - b[1]) / w, 2) + pow((a[2] - b[2]) / w, 2) + pow((a[3] - b[3]) / w, 2)) / 3, 6) AS score FROM s
""")  # fmt: skip
def _(spark, sf):
    e = embedding_columns(spark, sf, 4).withColumn("t", F.col("label") == 3)
    return polygons.rank_markers(e, ["e0", "e1", "e2", "e3"], "t").select("marker", r6("score"))


#: One triangle a region over its cells: two corners of the data's box and a point between.
_SHAPES = f"""{CELLS_SQL}, box AS (SELECT grp, round(min(m1), 6) AS x0, round(max(m1), 6) AS x1, min(m2) AS y0, max(m2) AS y1 FROM cells GROUP BY 1),
v AS (SELECT grp AS label, unnest([1, 2, 3]) AS i, unnest([x0, x1, x0]) AS x, unnest([y0, y0, y1]) AS y FROM box),
n AS (SELECT *, coalesce(lead(x) OVER w, first(x) OVER w) AS nx, coalesce(lead(y) OVER w, first(y) OVER w) AS ny FROM v WINDOW w AS (PARTITION BY label ORDER BY i))"""


def _shapes(spark, sf):
    box = cells(spark, sf).groupBy("grp").agg(F.round(F.min("m1"), 6).alias("x0"), F.round(F.max("m1"), 6).alias("x1"), F.min("m2").alias("y0"), F.max("m2").alias("y1"))
    corner = F.array(*[F.struct(F.lit(i).alias("vertex"), F.col(x).alias("x_transformed"), F.col(y).cast("double").alias("y_transformed")) for i, (x, y) in enumerate((("x0", "y0"), ("x1", "y0"), ("x0", "y1")), 1)])
    return box.select(F.col("grp").alias("label"), F.lit(1).alias("depth"), F.lit("m1").alias("marker_x"), F.lit("m2").alias("marker_y"), F.explode(corner).alias("r")).select("label", "depth", "marker_x", "marker_y", "r.*")


@query("polygon_densify", f"""
WITH {_SHAPES}
SELECT label, CAST((i - 1) * 4 + k + 1 AS INTEGER) AS vertex, round(x + k / 4.0 * (nx - x), 6) AS x_transformed, round(y + k / 4.0 * (ny - y), 6) AS y_transformed,
       round(sinh((x + k / 4.0 * (nx - x)) / 10) * 150, 4) AS x_linear FROM n, range(0, 4) AS r(k)
""")  # fmt: skip
def _(spark, sf):
    d = polygons.densify(_shapes(spark, sf), 4).withColumn("x_linear", Transform("arcsinh", 150.0).inverse(F.col("x_transformed") / 10))
    return d.select("label", "vertex", r6("x_transformed"), r6("y_transformed"), F.round("x_linear", 4).alias("x_linear"))


def _learnable(spark, sf):
    """Cells with a planted corner on m2 and m4; the key is a line's own, so that a draw doesn't take cells of equal values as one."""
    line = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice")  # orders and numbers alone repeat in these tables
    return cells(spark, sf, line).withColumn("key", F.xxhash64(*line)).withColumn("target", (F.col("m2") + 4 * F.col("m4") > 50) & (F.col("m2") < 45))


@query("learn_convex_gate", f"""
WITH {CELLS_SQL}, t AS (SELECT count(*) FILTER (m2 + 4 * m4 > 50 AND m2 < 45) AS n FROM cells)
SELECT 1 AS depth, 'm2' AS marker_x, 'm4' AS marker_y, true AS finds_targets, true AS leaves_others, true AS in_the_box FROM t WHERE n > 20
""")  # fmt: skip
def _(spark, sf):
    """The planted corner is found: its markers, over 95 % of its cells, under 5 % others, by a polygon inside the data's box."""
    c = _learnable(spark, sf)
    levels, report = gate_learning.explain(c, "target", ["m1", "m2", "m3", "m4"], "key")
    rows = [(r["depth"], r["marker_x"], r["marker_y"], x, y) for r, v in zip(report, levels, strict=True) for x, y in v.vertices]
    p = spark.createDataFrame(rows, "depth int, marker_x string, marker_y string, x double, y double").groupBy("depth", "marker_x", "marker_y").agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"))
    box = c.agg(*[f(m).alias(f"{m}{k}") for m in ("m2", "m4") for k, f in enumerate((F.min, F.max))])
    wide = lambda a, b: 0.05 * (F.col(b) - F.col(a))
    inside = (F.col("x0") >= F.col("m20") - wide("m20", "m21")) & (F.col("x1") <= F.col("m21") + wide("m20", "m21")) & (F.col("y0") >= F.col("m40") - wide("m40", "m41")) & (F.col("y1") <= F.col("m41") + wide("m40", "m41"))
    m = polygons.gate_metrics(polygons.apply_strategy(c, levels), "in_gate", "target")  # over all cells
    one = p.join(F.broadcast(box)).join(F.broadcast(m))  # one row each
    return one.select("depth", "marker_x", "marker_y", (F.col("recall") > 0.95).alias("finds_targets"), (F.col("precision") > 0.95).alias("leaves_others"), inside.alias("in_the_box"))


@query("gate_transferability")
def _(spark, sf):
    return gate_learning.transferability(_learnable(spark, sf), "target", ("m2", "m4"), "sample_id", "key")


@query("gating_ml_export", f"""
WITH {_SHAPES} SELECT label, count(*) AS n_vertices, round(sum(sinh(x + k / 4.0 * (nx - x)) * 150), 1) AS x_total FROM n, range(0, 4) AS r(k) GROUP BY label
""")  # fmt: skip
def _(spark, sf):
    """The written text, read back: each gate's vertices and the sum of their first coordinates."""
    import xml.etree.ElementTree as ET

    rows = [r.asDict() for r in polygons.linear_table(_shapes(spark, sf), Transform("arcsinh", 150.0)).collect()]  # a gate a region
    out = []
    for gate in ET.fromstring(polygons.gating_ml(rows)):
        at = [[float(c.get(f"{{{polygons.TYPES}}}value")) for c in v] for v in gate.iter(f"{{{polygons.GATING}}}vertex")]
        out.append((gate.get(f"{{{polygons.GATING}}}id"), len(at), sum(x for x, _ in at)))
    names = [r["label"] for r in sorted(rows, key=lambda r: (r["label"], r["vertex"])) if r["vertex"] == 1]
    label = lambda i: next(n for n in names if n.replace(" ", "_") in i.replace(" ", "_"))
    return spark.createDataFrame([(label(i), n, round(t, 1)) for i, n, t in out], "label string, n_vertices long, x_total double")


# ---------------------------------------------------------------- uncertainty and embedding
@query("bootstrap_uncertainty")
def _(spark, sf):
    c = cells(spark, sf).select(F.col("grp").alias("sample_id"), F.lit("m1").alias("marker"), F.col("m1").alias("value"))
    t = c.select("sample_id", "marker").distinct().withColumn("threshold", F.lit(11.0)).withColumn("source", F.lit("valley"))
    return uncertainty.thresholds(c, t)


@query("frequency_uncertainty", f"""
WITH {CELLS_SQL}, t AS (SELECT sample_id, round(quantile_cont(m1, 0.5), 6) AS t1, round(quantile_cont(m2, 0.4), 6) AS t2 FROM cells GROUP BY 1),
n AS (SELECT c.sample_id, count(*) AS n, sum((m1 > t1 + 0.2 AND m2 > t2)::INT) AS a1, sum((m1 > t1 - 0.2 AND m2 > t2)::INT) AS b1, sum((m1 > t1 AND m2 > t2 + 0.2)::INT) AS a2, sum((m1 > t1 AND m2 > t2 - 0.2)::INT) AS b2 FROM cells c JOIN t USING (sample_id) WHERE ls = 'O' GROUP BY 1)
SELECT sample_id, unnest(['m1', 'm2']) AS term, unnest([round(100.0 * abs(a1 - b1) / 2 / n, 6), round(100.0 * abs(a2 - b2) / 2 / n, 6)]) AS u_pct_points FROM n
""")  # fmt: skip
def _(spark, sf):
    c = cells(spark, sf).withColumn("parent", F.col("ls") == "O")
    t = cut(_thresholds(c).filter("marker in ('m1', 'm2')"))
    u = t.select("sample_id", "marker", F.lit(0.2).alias("u_combined"))
    b = uncertainty.frequency_uncertainty(c, t, u, {"A high B high": SPEC["A high B high"]}, "parent")
    return b.select("sample_id", "term", r6("u_pct_points"))


@query("frequency_uncertainty_displaced", f"""
WITH {CELLS_SQL}, c AS (SELECT grp AS sample_id, m1, m2, m3, ls = 'O' AS live FROM cells), t AS (SELECT sample_id, round(quantile_cont(m1, 0.02), 6) AS t1 FROM c GROUP BY 1),
mv AS (SELECT * FROM (VALUES ('-', -1, 0), ('+', 1, 0), ('p-', 0, -1), ('p+', 0, 1)) AS v(s, k, pk)),
up AS (SELECT sample_id || s AS key, m1 FROM c JOIN t USING (sample_id) CROSS JOIN mv WHERE live AND m3 > 3.5 + pk AND m1 > t1 + k * 0.25),
{valley_sql('key', 'm1', 'up', INTERMEDIATE)},
hi AS (SELECT g.key, g.lo + (ok.v - 0.5) * g.w AS hi FROM g JOIN ok ON ok.key = g.key AND ok.r = 1),
n AS (SELECT c.sample_id, s, sum((live AND m3 > 3.5 + pk)::INT) AS n, sum((live AND m3 > 3.5 + pk AND m1 > t1 + k * 0.25 AND m1 < hi AND m2 > 20)::INT) AS mid, sum((live AND m3 > 3.5 + pk AND m1 > t1 + k * 0.25)::INT) AS high
      FROM c JOIN t USING (sample_id) CROSS JOIN mv JOIN hi ON hi.key = c.sample_id || s GROUP BY 1, 2),
m2 AS (SELECT c.sample_id, sum((live AND m3 > 3.5)::INT) AS n, sum((live AND m3 > 3.5 AND m1 > t1 AND m1 < 11.5 AND m2 > 15)::INT) AS a, sum((live AND m3 > 3.5 AND m1 > t1 AND m1 < 11.5 AND m2 > 25)::INT) AS b FROM c JOIN t USING (sample_id) GROUP BY 1),
p AS (SELECT sample_id, CASE WHEN s IN ('-', '+') THEN 'm1' ELSE 'parent_CD45' END AS term, unnest(['mid', 'high']) AS population, unnest([100.0 * mid / n, 100.0 * high / n]) AS pct FROM n)
SELECT sample_id, population, term, round((max(pct) - min(pct)) / 2, 6) AS u_pct_points FROM p GROUP BY ALL UNION ALL SELECT sample_id, 'mid', 'm2', round(50.0 * (a - b) / n, 6) FROM m2
""")  # fmt: skip
def _(spark, sf):
    c = cells(spark, sf).select(F.col("grp").alias("sample_id"), "m1", "m2", "m3", (F.col("ls") == "O").alias("live"), ((F.col("ls") == "O") & (F.col("m3") > 3.5)).alias("parent"))
    t1 = c.groupBy("sample_id").agg(F.round(F.percentile("m1", F.lit(0.02)), 6).alias("threshold"))
    rows = F.array(F.struct(F.lit("m1").alias("marker"), F.col("threshold"), F.lit(0.25).alias("u_combined")), F.struct(F.lit("m2").alias("marker"), F.lit(20.0).alias("threshold"), F.lit(5.0).alias("u_combined")))
    t = cut(t1.select("sample_id", F.explode(rows).alias("r")).select("sample_id", "r.*"))
    one = t.select("sample_id").distinct()
    bounds = one.select("sample_id", F.lit("m1").alias("marker"), F.lit(11.5).alias("threshold"))
    gate = one.select("sample_id", F.lit(3.5).alias("threshold"), F.lit(1.0).alias("u_combined"))
    b = uncertainty.frequency_uncertainty(c, t, t, {"mid": {"m1": "intermediate", "m2": "above"}, "high": {"m1": "above"}}, "parent", bounds=bounds, gate=("live", "m3", gate), lone=True)
    return b.select("sample_id", "population", "term", r6("u_pct_points"))


@query("pca_embedding", """
WITH e AS (SELECT list_transform(embedding[1:6], lambda v: CAST(v AS DOUBLE)) AS x FROM embeddings) SELECT count(*) AS n, true AS centred, true AS uncorrelated, true AS ordered, true AS of_largest_spread FROM e
""")  # fmt: skip
def _(spark, sf):
    """What makes two axes principal ones: centred, uncorrelated, in the order of their spread, which no scaled feature exceeds."""
    names = [f"e{i}" for i in range(6)]
    p = embedding.project(embedding_columns(spark, sf, 6), embedding.fit_pca(embedding_columns(spark, sf, 6), names))
    v1, v2 = F.var_samp("pc_1"), F.var_samp("pc_2")
    # features are scaled to a variance of 1, and the first axis has at least theirs
    return p.agg(F.count(F.lit(1)).alias("n"), ((F.abs(F.avg("pc_1")) < 1e-9) & (F.abs(F.avg("pc_2")) < 1e-9)).alias("centred"), (F.abs(F.corr("pc_1", "pc_2")) < 1e-6).alias("uncorrelated"), (v1 >= v2).alias("ordered"), (v1 >= 1 - 1e-9).alias("of_largest_spread"))


@query("nearest_neighbours", """
WITH p AS (SELECT vec_id, list_transform(embedding[1:4], lambda v: round(CAST(v AS DOUBLE), 4)) AS x FROM embeddings),
d AS (SELECT a.vec_id, b.vec_id AS neighbour, pow(a.x[1] - b.x[1], 2) + pow(a.x[2] - b.x[2], 2) + pow(a.x[3] - b.x[3], 2) + pow(a.x[4] - b.x[4], 2) AS d2 FROM p a JOIN p b ON a.vec_id <> b.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d2, neighbour) AS place FROM d)
SELECT vec_id, neighbour, CAST(place AS INTEGER) AS place, round(d2, 9) AS d2 FROM r WHERE place <= 10
""")  # fmt: skip
def _(spark, sf):
    return neighbours.nearest(_points(spark, sf), "vec_id", "xy", 10).select("vec_id", "neighbour", "place", F.round("d2", 9).alias("d2"))


def _points(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", F.transform(F.slice("embedding", 1, 4), lambda v: F.round(v.cast("double"), 4)).alias("xy"))


@query("neighbour_embedding")
def _(spark, sf):
    return layout.layout(_points(spark, sf), "vec_id", "xy", 15).select("vec_id", F.col("x").alias("umap_1"), F.col("y").alias("umap_2"))


@query("layout_projection", "SELECT vec_id, true AS lands_on_itself FROM embeddings WHERE embedding[1] IS NOT NULL")
def _(spark, sf):
    # places of a stored layout are given, so that the projection alone is at work
    p = embedding_columns(spark, sf, 4)
    made = p.select("vec_id", (F.col("e0") * 10).alias("x"), (F.col("e1") * 10).alias("y"))
    path = f"{storage_root(spark)}/layout-{uuid.uuid4().hex}"
    layout.save(p, "vec_id", made, ["e0", "e1", "e2", "e3"], [0.0] * 4, [1.0] * 4, path, k=15)
    new = layout.place_new(p, "vec_id", layout.load(spark, path)).withColumnsRenamed({"x": "nx", "y": "ny"})
    near = F.greatest(F.abs(F.col("x") - F.col("nx")), F.abs(F.col("y") - F.col("ny"))) < 1e-9
    return made.join(new, "vec_id").select("vec_id", near.alias("lands_on_itself"))


# ---------------------------------------------------------------- metadata and files
@query("abundance_absolute", f"""
WITH {SUPPLIER_SQL} SELECT sample_id, 'p' AS population, round(value / 1000.0, 6) AS pct_of_cd45_pos, round(value / 1000.0 / 100 * (4000 + sample_id), 6) AS cells_per_ul FROM sv
""")  # fmt: skip
def _(spark, sf):
    s = supplier_values(spark, sf)
    f = s.select("sample_id", F.lit("p").alias("population"), (F.col("value") / 1000).alias("pct_of_cd45_pos"))
    a = metadata.absolute_from_wbc(f, s.select("sample_id", (F.col("sample_id") + 4000).alias("wbc_per_ul")))
    return a.select("sample_id", "population", r6("pct_of_cd45_pos"), r6("cells_per_ul"))


@query("unpivot_absolute_counts", """
WITH w AS (SELECT s_suppkey, s_acctbal AS t, CASE WHEN s_suppkey % 4 <> 0 THEN floor(s_acctbal / 4) END AS b FROM supplier WHERE s_suppkey % 9 <> 0)
SELECT 'S' || s_suppkey AS sample_key, population, round(value / 1000.0, 6) AS cells_per_ul FROM (SELECT s_suppkey, unnest(['T', 'B']) AS population, unnest([t, b]) AS value FROM w) WHERE value IS NOT NULL
""")  # fmt: skip
def _(spark, sf):
    """A count sheet of text cells: a unit column, blank samples and cells, decimal commas."""
    k = F.col("s_suppkey")
    text = lambda c: F.regexp_replace(F.format_string("%.2f", c), "[.]", ",")
    raw = table(spark, sf, "supplier").select(
        F.when(k % 9 == 0, "").otherwise(F.concat(F.lit("S"), k.cast("string"))).alias("sample"), F.lit("").alias("in 1 mL blood"), text(F.col("s_acctbal")).alias("T"),
        F.when(k % 4 == 0, " ").otherwise(F.floor(F.col("s_acctbal") / 4).cast("string")).alias("B"),
    )
    return metadata.unpivot_counts(raw, "sample").select("sample_key", "population", r6("cells_per_ul"))


@query("date_order_inference", """
SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 6 THEN strftime(o_orderdate, '%Y-%m-%d') END AS parsed FROM orders
""")  # fmt: skip
def _(spark, sf):
    """Order dates as people write them: ISO, day first with slashes, dots and two-digit years, month names, and no date at all."""
    o, d = F.col("o_orderkey"), F.col("o_orderdate")
    forms = ["yyyy-MM-dd", "dd/MM/yyyy", "d.M.yyyy", "dd-MM-yy", "d MMM yyyy", "MMMM d, yyyy"]
    raw = F.coalesce(*[F.when(o % 7 == i, F.date_format(d, f)) for i, f in enumerate(forms)], F.lit("unknown"))
    t = table(spark, sf, "orders").select("o_orderkey", F.concat(F.lit(" "), raw).alias("raw"))
    return metadata.parse_dates(t, "raw", dt.date(2020, 1, 1), "d").select("o_orderkey", F.col("d").cast("string").alias("parsed"))


@query("sample_ids", """
SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'W' || (event_id % 10) WHEN event_id % 3 = 1 THEN 'B7' ELSE 'run_' || event_id END AS sample_id FROM events
""")  # fmt: skip
def _(spark, sf):
    e = table(spark, sf, "events")
    i = F.col("event_id")
    file = F.when(i % 3 == 1, F.lit("data/B7_x.fcs")).otherwise(F.concat(F.lit("data/run_"), i.cast("string"), F.lit(".FCS")))
    kw = F.when(i % 3 == 0, F.create_map(F.lit("$WELLID"), F.concat(F.lit(" W"), (i % 10).cast("string")))).otherwise(F.create_map(F.lit("$WELLID"), F.lit(" ")))
    return e.select("event_id", ev.sample_id(file, kw).alias("sample_id"))


@query("fcs_round_trip", "SELECT event_type AS grp, count(*) AS n, round(sum(round(value, 2)), 2) AS total FROM events GROUP BY 1")
def _(spark, sf):
    e = table(spark, sf, "events").select("event_type", F.col("event_id").alias("event_index"), F.round("value", 2).alias("value"), F.col("user_id").cast("double").alias("user"))
    path = f"{storage_root(spark)}/fcs-{uuid.uuid4().hex}"
    fcs_source.export_files(e, path, ["value", "user"], ["event_type"], ("event_index",))
    back = fcs.open_scan(spark, fcs.listed(spark, path), ["value"], ())
    name = F.regexp_extract("file", r"event_type_([^/]+)[.]fcs$", 1)
    return back.groupBy(name.alias("grp")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(F.round("value", 2)), 2).alias("total"))


@query("category_codes", "SELECT doc_id, CAST(dense_rank() OVER (ORDER BY lang) AS DOUBLE) AS code FROM documents")
def _(spark, sf):
    return fcs.category_codes(table(spark, sf, "documents").select("doc_id", "lang"), "lang", "c")[0].select("doc_id", F.col("c").alias("code"))


# ---------------------------------------------------------------- figure data
@query("figure_group_bars", f"""
WITH {SUPPLIER_SQL} SELECT 'p' AS population, grp AS "group", count(*) AS n, round(avg(value), 4) AS mean, round(stddev_samp(value), 4) AS sd, round(quantile_cont(value, 0.5), 4) AS median FROM sv GROUP BY grp
""")  # fmt: skip
def _(spark, sf):
    s = supplier_values(spark, sf)
    b = figures.group_bars(s.select("sample_id", F.lit("p").alias("population"), F.col("value").alias("v")), s.select("sample_id", "group"), "v")
    return b.select("population", "group", "n", *[F.round(c, 4).alias(c) for c in ("mean", "sd", "median")])


@query("figure_marker_limits", "SELECT 'value' AS marker, round(quantile_cont(value, 0.01), 6) AS low, round(quantile_cont(value, 0.99), 6) AS high FROM events")
def _(spark, sf):
    return figures.marker_limits(table(spark, sf, "events"), ["value"]).select("marker", r6("low"), r6("high"))


@query("figure_density_curve", f"""
WITH {CELLS_SQL}, s AS (SELECT grp, CAST(count(*) AS DOUBLE) AS n, min(m1) AS lo, max(m1) AS hi, least(stddev_samp(m1), (quantile_cont(m1, 0.75) - quantile_cont(m1, 0.25)) / 1.34) AS spread FROM cells GROUP BY 1),
h AS (SELECT *, 0.9 * spread * pow(n, -0.2) AS h FROM s), b AS (SELECT c.grp, n, lo, hi, h, least(2047, CAST(floor((m1 - lo) / (hi - lo) * 2048) AS INTEGER)) AS bin, count(*) AS c FROM cells c JOIN h ON c.grp = h.grp GROUP BY ALL),
g AS (SELECT *, lo + (bin + 0.5) * (hi - lo) / 2048 AS center, lo + i * (hi - lo) / 127 AS x FROM b CROSS JOIN range(0, 128) AS r(i))
SELECT grp, round(any_value(x), 6) AS x, round(sum(c * exp(-pow((x - center) / h, 2) / 2)) / any_value(n * h * 2.5066282746310002), 6) AS density FROM g GROUP BY grp, i
""")  # fmt: skip
def _(spark, sf):
    return figures.density_curve(cells(spark, sf), ["grp"], "m1", 128).select("grp", r6("x"), r6("density"))


@query("figure_hexbin", f"""
WITH {CELLS_SQL}, r AS (SELECT grp, min(m2) AS x0, max(m2) AS x1, min(m1) AS y0, max(m1) AS y1 FROM cells GROUP BY 1),
d AS (SELECT c.grp, (m2 - x0) / (x1 - x0) * 40 AS u, (m1 - y0) / (y1 - y0) * 40 / 1.7320508075688772 AS v FROM cells c JOIN r ON c.grp = r.grp),
n AS (SELECT *, (u - round(u)) * (u - round(u)) + 3 * (v - round(v)) * (v - round(v)) <= (u - (floor(u) + 0.5)) * (u - (floor(u) + 0.5)) + 3 * (v - (floor(v) + 0.5)) * (v - (floor(v) + 0.5)) AS near FROM d)
SELECT grp, CASE WHEN near THEN round(u) ELSE floor(u) + 0.5 END AS hx, CASE WHEN near THEN round(v) ELSE floor(v) + 0.5 END AS hy, count(*) AS count FROM n GROUP BY ALL
""")  # fmt: skip
def _(spark, sf):
    return figures.hexbin(cells(spark, sf), ["grp"], "m2", "m1", 40)


@query("figure_marker_heatmap", f"""
WITH {_SCORED}, {_MFI}, m AS (SELECT population, marker, quantile_cont(median_asinh, 0.5) AS value, count(DISTINCT sample_id) AS n_samples FROM s GROUP BY 1, 2)
SELECT population, marker, round(value, 6) AS value, n_samples, round(CASE WHEN stddev_samp(value) OVER w < 1e-8 THEN 0.0 ELSE (value - avg(value) OVER w) / stddev_samp(value) OVER w END, 5) AS z FROM m WINDOW w AS (PARTITION BY marker)
""")  # fmt: skip
def _(spark, sf):
    s, t = _scored(spark, sf)
    m = populations.marker_summary(s, POPS, ["m2", "m3"], t).withColumn("median_asinh", r6("median_asinh"))
    return figures.marker_heatmap(m).select("population", "marker", r6("value"), "n_samples", F.round("z", 5).alias("z"))


@query("figure_p_annotation", """
SELECT event_id, CASE WHEN value / 1000 < 0.0001 THEN '****' WHEN value / 1000 < 0.001 THEN '***' WHEN value / 1000 < 0.01 THEN '**' WHEN value / 1000 < 0.05 THEN '*' WHEN value / 1000 < 0.1 THEN 'trend' ELSE 'ns' END AS mark FROM events
""")  # fmt: skip
def _(spark, sf):
    from gatefold.functions.numeric import p_stars

    m = p_stars(F.col("value") / 1000)
    return table(spark, sf, "events").select("event_id", F.when(m.startswith("p:"), "trend").otherwise(m).alias("mark"))


@query("uncertainty_annotation", f"""
WITH {SUPPLIER_SQL}, m AS (SELECT grp, quantile_cont(value, 0.5) AS med FROM sv GROUP BY 1), u AS (SELECT quantile_cont(qty / 10, 0.5) AS u FROM sv), r AS (SELECT med AS ref FROM m WHERE grp = (SELECT min(grp) FROM m))
SELECT 'p' AS population, grp AS comparison, round(u, 6) AS gate_u_pct_points, round(abs(med - ref) / u, 4) AS difference_over_gate_u FROM m, u, r WHERE grp <> (SELECT min(grp) FROM m)
""")  # fmt: skip
def _(spark, sf):
    s = supplier_values(spark, sf)
    g = ranks.compare_groups(s.select("sample_id", F.lit("p").alias("population"), "value"), s.select("sample_id", "group"), "value")
    u = s.select("sample_id", F.lit("p").alias("population"), (F.col("qty") / 10).alias("u_pct_points"))
    return uncertainty.annotate(g, u).select("population", "comparison", r6("gate_u_pct_points"), F.round("difference_over_gate_u", 4).alias("difference_over_gate_u"))


