"""Polygon gates: membership as column expressions, densified edges, linear units and Gating-ML export."""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gatefold.functions.numeric import all_of, col, finite
from gatefold.functions.quantiles import quantiles
from gatefold.operators.transforms import Transform


@dataclass(frozen=True)
class Level:
    """One level of a gate strategy: a polygon on two markers."""

    marker_x: str
    marker_y: str
    vertices: tuple[tuple[float, float], ...]


def inside(x: Column | str, y: Column | str, polygon) -> Column:
    """Winding number test with half-open edges: a sum of one term an edge, in generated code."""
    px, py = col(x), col(y)
    terms = []
    v = list(polygon)
    for (x0, y0), (x1, y1) in zip(v, v[1:] + v[:1], strict=True):
        if y0 == y1:
            continue
        side = (x1 - x0) * (py - y0) - (px - x0) * (y1 - y0)
        if y1 > y0:
            terms.append(F.when((py >= y0) & (py < y1) & (side > 0), 1).otherwise(0))
        else:
            terms.append(F.when((py >= y1) & (py < y0) & (side < 0), -1).otherwise(0))
    winding = sum(terms, F.lit(0))
    return F.coalesce(finite(px) & finite(py) & (winding != 0), F.lit(False))


def apply_strategy(df: DataFrame, levels: list[Level], out: str = "in_gate", depth: int | None = None) -> DataFrame:
    """df with out: inside all levels down to depth."""
    return df.withColumn(out, all_of([inside(v.marker_x, v.marker_y, v.vertices) for v in levels[:depth]]))


def gate_metrics(df: DataFrame, gate: str, target: str, n_target_total: int | None = None) -> DataFrame:
    """precision, recall and f1; recall against n_target_total where earlier levels have lost targets."""
    g, t = F.coalesce(col(gate), F.lit(False)), F.coalesce(col(target), F.lit(False))
    n = df.agg(F.sum((g & t).cast("long")).alias("tp"), F.sum(g.cast("long")).alias("n_in"), F.sum(t.cast("long")).alias("n_target"))
    p = F.try_divide(F.col("tp"), F.col("n_in"))
    r = F.try_divide(F.col("tp"), F.lit(n_target_total) if n_target_total else F.col("n_target"))
    f = F.try_divide(2 * p * r, p + r)
    return n.select("tp", "n_in", "n_target", F.coalesce(p, F.lit(0.0)).alias("precision"), F.coalesce(r, F.lit(0.0)).alias("recall"), F.coalesce(f, F.lit(0.0)).alias("f1"))


def rank_markers(df: DataFrame, markers: list[str], target: str, min_n: int = 5, by: list[str] | None = None) -> DataFrame:
    """by (if any), marker, score: mean squared difference of (median, 1st, 99th percentile) between target and other cells, values scaled to [0, 1]."""
    t = F.coalesce(col(target), F.lit(False))
    by = by or []
    long = df.select(*by, t.alias("t"), F.explode(F.array(*[F.struct(F.lit(m).alias("marker"), col(m).cast("double").alias("x")) for m in markers])).alias("r")).select(*by, "t", "r.*").filter(finite("x"))
    q = quantiles(long, [*by, "marker", "t"], "x", [0.5, 0.01, 0.99, 0.0, 1.0])
    of = lambda c, v: F.max(F.when(c, v))
    three, t, n = F.slice("q", 1, 3), F.col("t"), F.col("n")
    s = q.groupBy(*by, "marker").agg(F.min(F.col("q")[3]).alias("lo"), F.max(F.col("q")[4]).alias("hi"), of(t, three).alias("a"), of(~t, three).alias("b"), of(t, n).alias("n1"), of(~t, n).alias("n0"))
    # percentiles commute with the scaling, so no second pass is needed
    d = F.aggregate(F.zip_with("a", "b", lambda a, b: ((a - b) / (F.col("hi") - F.col("lo"))) * ((a - b) / (F.col("hi") - F.col("lo")))), F.lit(0.0), lambda u, v: u + v) / 3.0
    return s.filter((F.col("hi") > F.col("lo")) & (F.col("n1") >= min_n) & (F.col("n0") >= min_n)).select(*by, "marker", d.alias("score"))


# ---------------------------------------------------------------- vertex tables
POLYGON = "label string, depth int, marker_x string, marker_y string, vertex int, x_transformed double, y_transformed double"


def polygon_rows(label: str, levels: list[Level]) -> list[tuple]:
    return [(label, d, v.marker_x, v.marker_y, i, float(x), float(y)) for d, v in enumerate(levels, 1) for i, (x, y) in enumerate(v.vertices, 1)]


def densify(polygons: DataFrame, n_per_edge: int = 1) -> DataFrame:
    """n_per_edge points an edge, from each vertex towards the next (the last towards the first).

    A straight edge on the transformed scale is curved in linear units; more points follow it.
    """
    by = ["label", "depth", "marker_x", "marker_y"]
    w = Window.partitionBy(*by).orderBy("vertex")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    d = polygons.withColumns({f"_{c}": F.coalesce(F.lead(f"{c}_transformed").over(w), F.first(f"{c}_transformed").over(whole)) for c in "xy"})
    d = d.withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(n_per_edge - 1)))).withColumn("_f", F.col("_k") / F.lit(float(n_per_edge)))
    mid = {f"{c}_transformed": F.col(f"{c}_transformed") + F.col("_f") * (F.col(f"_{c}") - F.col(f"{c}_transformed")) for c in "xy"}
    return d.withColumns(mid).withColumn("vertex", ((F.col("vertex") - 1) * n_per_edge + F.col("_k") + 1).cast("int")).drop("_x", "_y", "_k", "_f")


def linear_table(polygons: DataFrame, transform: Transform, n_per_edge: int = 4) -> DataFrame:
    """Densified vertices with x_linear and y_linear.  A logicle inverse depends on the marker: one expression a marker."""
    d = densify(polygons, n_per_edge)
    if transform.method != "logicle":
        return d.withColumn("x_linear", transform.inverse("x_transformed")).withColumn("y_linear", transform.inverse("y_transformed"))
    for a in "xy":
        cases = [F.when(F.col(f"marker_{a}") == m, transform.inverse(f"{a}_transformed", m)) for m in transform.logicle]
        d = d.withColumn(f"{a}_linear", F.coalesce(*cases, transform.inverse(f"{a}_transformed")))
    return d


GATING = "http://www.isac-net.org/std/Gating-ML/v2.0/gating"
TYPES = "http://www.isac-net.org/std/Gating-ML/v2.0/datatypes"


def gating_ml(linear_rows: list[dict], channels: dict[str, str] | None = None) -> str:
    """Gating-ML 2.0 of linear vertex rows: level n of a label is a child of level n - 1."""
    ET.register_namespace("gating", GATING)
    ET.register_namespace("data-type", TYPES)
    g, t = f"{{{GATING}}}", f"{{{TYPES}}}"
    root = ET.Element(f"{g}Gating-ML")
    safe = lambda s: "G_" + re.sub(r"[^A-Za-z0-9_.-]", "_", s)
    by: dict[tuple[str, int], list[dict]] = {}
    for r in linear_rows:
        by.setdefault((r["label"], r["depth"]), []).append(r)
    for (label, depth), rows in sorted(by.items()):
        gate = ET.SubElement(root, f"{g}PolygonGate", {f"{g}id": f"{safe(label)}_{depth}"})
        if (label, depth - 1) in by:
            gate.set(f"{g}parent_id", f"{safe(label)}_{depth - 1}")
        for m in (rows[0]["marker_x"], rows[0]["marker_y"]):
            dim = ET.SubElement(gate, f"{g}dimension", {f"{g}compensation-ref": "uncompensated"})
            ET.SubElement(dim, f"{t}fcs-dimension", {f"{t}name": (channels or {}).get(m, m)})
        for r in sorted(rows, key=lambda r: r["vertex"]):
            v = ET.SubElement(gate, f"{g}vertex")
            for c in ("x_linear", "y_linear"):
                ET.SubElement(v, f"{g}coordinate", {f"{t}value": repr(float(r[c]))})
    ET.indent(root)
    return ET.tostring(root, encoding="unicode", xml_declaration=True)
