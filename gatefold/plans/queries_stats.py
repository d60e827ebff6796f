"""Queries: rank statistics, compositional analysis, diagnostics, clusters, conformance."""

from __future__ import annotations


from pyspark.sql import functions as F

from gatefold.operators import clusters, compositional, conformance, diagnostics, ranks
from gatefold.functions.storage import cut
from gatefold.plans.inputs import SUPPLIER_SQL, embedding_columns, supplier_values, table
from gatefold.plans.queries_gating import _MFI, _SCORED, POPS, _scored, r6
from gatefold.plans.registry import query

#: Marker summaries of populations with at least 20 cells, a row a measure.
_STATE = """ms AS (SELECT population, marker, unnest(['median_asinh', 'pct_positive']) AS measure, unnest([median_asinh, pct_positive]) AS value, n_cells, r_name AS grp FROM s JOIN nation ON n_name = sample_id JOIN region ON n_regionkey = r_regionkey WHERE n_cells >= 20)"""
_RANK = "rank() OVER (PARTITION BY {k} ORDER BY {v}) + (count(*) OVER (PARTITION BY {k}, {v}) - 1) / 2.0"


@query("avg_rank", f"WITH {SUPPLIER_SQL} SELECT sample_id, grp AS \"group\", {_RANK.format(k='grp', v='floor(value / 500)')} AS rk FROM sv")
def _(spark, sf):
    s = supplier_values(spark, sf).withColumn("v", F.floor(F.col("value") / 500))
    return s.select("sample_id", "group", ranks.avg_rank(["group"], "v").alias("rk"))


_SIDES = f"""{SUPPLIER_SQL}, g AS (SELECT min(grp) AS r FROM sv), s AS (SELECT grp AS comparison, FALSE AS is_ref, sample_id, floor(value / 300) * 300 AS value FROM sv, g WHERE grp <> r
  UNION ALL SELECT o.grp, TRUE, sv.sample_id, floor(value / 300) * 300 FROM sv, g, (SELECT DISTINCT grp FROM sv, g WHERE grp <> r) o WHERE sv.grp = r),
k AS (SELECT *, {_RANK.format(k='comparison', v='value')} AS rk FROM s), t AS (SELECT comparison, sum(c * c * c - c) AS ties FROM (SELECT comparison, value, CAST(count(*) AS DOUBLE) AS c FROM s GROUP BY 1, 2) GROUP BY 1),
a AS (SELECT comparison, sum(is_ref::INT) AS n1, sum((NOT is_ref)::INT) AS n2, sum(CASE WHEN is_ref THEN rk END) AS r1, sum(CASE WHEN NOT is_ref THEN rk END) AS r2, quantile_cont(CASE WHEN is_ref THEN value END, 0.5) AS m1, quantile_cont(CASE WHEN NOT is_ref THEN value END, 0.5) AS m2 FROM k GROUP BY 1),
w AS (SELECT comparison, n1, n2, m1, m2, r1 - n1 * (n1 + 1) / 2.0 AS w, n1 * n2 / 12.0 * ((n1 + n2 + 1) - ties / ((n1 + n2) * (n1 + n2 - 1.0))) AS var, 2 * (r2 - n2 * (n2 + 1) / 2.0) / (n1 * n2) - 1 AS delta FROM a JOIN t USING (comparison)),
z AS (SELECT *, (w - n1 * n2 / 2.0 - sign(w - n1 * n2 / 2.0) * 0.5) / sqrt(var) AS z FROM w)"""


def _binned(spark, sf):
    return supplier_values(spark, sf).withColumn("value", F.floor(F.col("value") / 300).cast("double") * 300)


@query("rank_sum_stats", f"WITH {_SIDES} SELECT comparison, CAST(n1 AS BIGINT) AS n_reference, CAST(n2 AS BIGINT) AS n_comparison, round(m1, 6) AS median_reference, round(m2, 6) AS median_comparison, round(w, 6) AS w, round(z, 6) AS z, round(delta, 6) AS cliffs_delta FROM z")
def _(spark, sf):
    t = ranks.rank_sum(ranks.against_reference(_binned(spark, sf), [], "group", "value"), [], "value")
    return t.select("comparison", "n_reference", "n_comparison", r6("median_reference"), r6("median_comparison"), r6("w"), r6("z"), r6("cliffs_delta"))


def p_normal_sql(z: str) -> str:
    """Two-sided normal p by the series of positive terms z**(2n+1) / (2n+1)!!, exact to the last digits."""
    return f"(1 - sqrt(2 / pi()) * exp(-({z}) * ({z}) / 2) * list_sum(list_transform(range(0, 150), lambda n: exp((2 * n + 1) * ln(greatest(abs({z}), 1e-300)) + n * ln(2) + lgamma(n + 1) - lgamma(2 * n + 2)))))"


def p_chi4_sql(x: str) -> str:
    """Upper tail of chi-square with four degrees of freedom."""
    return f"exp(-({x}) / 2) * (1 + ({x}) / 2)"


def p_t_sql(t: str, df: str) -> str:
    """Two-sided p of Student's t with whole degrees of freedom: a finite sum in the angle atan(t / sqrt(df))."""
    th = f"atan(abs({t}) / sqrt({df}))"
    even = f"sin({th}) * list_sum(list_transform(range(0, ({df}) // 2), lambda k: exp(2 * k * ln(cos({th})) + lgamma(k + 0.5) - lgamma(k + 1)) / sqrt(pi())))"
    odd = f"2 / pi() * ({th} + sin({th}) * coalesce(list_sum(list_transform(range(0, ({df} - 1) // 2), lambda k: exp((2 * k + 1) * ln(cos({th})) + lgamma(k + 1) - lgamma(k + 1.5)) * sqrt(pi()) / 2)), 0))"
    return f"1 - CASE WHEN ({df}) % 2 = 0 THEN {even} ELSE {odd} END"


def bh_sql(src: str, p: str, by: str = "1", out: str = "p_adj_BH") -> str:
    """src with Benjamini-Hochberg values of p within by."""
    return f"""SELECT * EXCLUDE (_raw), CASE WHEN {p} IS NOT NULL THEN least(1.0, min(_raw) OVER (PARTITION BY {by}, {p} IS NULL ORDER BY {p} DESC, _raw ROWS UNBOUNDED PRECEDING)) END AS {out}
    FROM (SELECT *, {p} * count({p}) OVER (PARTITION BY {by}, {p} IS NULL) / row_number() OVER (PARTITION BY {by}, {p} IS NULL ORDER BY {p}) AS _raw FROM {src})"""


def rank_sum_sql(src: str, keys: str, group: str = "grp", value: str = "value", family: str = "1") -> str:
    """CTEs rs (rank-sum statistics, p_value, BH) and kw (Kruskal-Wallis of five groups) of src(keys, group, value), first group as reference."""
    k = keys
    on = lambda a, b: " AND ".join(f"{a}.{x.strip()} = {b}.{x.strip()}" for x in k.split(","))
    rank = lambda part: f"rank() OVER (PARTITION BY {part} ORDER BY v) + (count(*) OVER (PARTITION BY {part}, v) - 1) / 2.0"
    return f"""i0 AS (SELECT {k}, {group} AS g, {value} AS v, (SELECT min({group}) FROM {src}) AS ref FROM {src}),
i1 AS (SELECT {k}, ref AS reference, g AS comparison, FALSE AS r, v FROM i0 WHERE g <> ref UNION ALL
  SELECT {', '.join('a.' + x.strip() for x in k.split(','))}, a.ref, o.g, TRUE, a.v FROM i0 a JOIN (SELECT DISTINCT {k}, g FROM i0 WHERE g <> ref) o ON {on('a', 'o')} WHERE a.g = a.ref),
i2 AS (SELECT *, {rank(k + ', comparison')} AS rk FROM i1),
i3 AS (SELECT {k}, comparison, sum(c * c * c - c) AS ties FROM (SELECT {k}, comparison, v, CAST(count(*) AS DOUBLE) AS c FROM i1 GROUP BY ALL) GROUP BY {k}, comparison),
i4 AS (SELECT {k}, reference, comparison, CAST(sum(r::INT) AS DOUBLE) AS n1, CAST(sum((NOT r)::INT) AS DOUBLE) AS n2, sum(CASE WHEN r THEN rk END) AS r1, sum(CASE WHEN NOT r THEN rk END) AS r2,
  quantile_cont(CASE WHEN r THEN v END, 0.5) AS median_reference, quantile_cont(CASE WHEN NOT r THEN v END, 0.5) AS median_comparison, avg(CASE WHEN r THEN v END) AS mean_reference, avg(CASE WHEN NOT r THEN v END) AS mean_comparison,
  stddev_samp(CASE WHEN r THEN v END) AS sd_reference, stddev_samp(CASE WHEN NOT r THEN v END) AS sd_comparison FROM i2 GROUP BY {k}, reference, comparison HAVING sum(r::INT) >= 3 AND sum((NOT r)::INT) >= 3),
i5 AS (SELECT i4.*, r1 - n1 * (n1 + 1) / 2 - n1 * n2 / 2 AS w, n1 * n2 / 12 * ((n1 + n2 + 1) - ties / ((n1 + n2) * (n1 + n2 - 1))) AS var, 2 * (r2 - n2 * (n2 + 1) / 2) / (n1 * n2) - 1 AS delta FROM i4 JOIN i3 ON {on('i4', 'i3')} AND i4.comparison = i3.comparison),
i6 AS (SELECT *, CASE WHEN var > 0 THEN (w - sign(w) * 0.5) / sqrt(var) END AS z FROM i5), i7 AS (SELECT *, {p_normal_sql('z')} AS p_value FROM i6),
rs AS ({bh_sql('i7', 'p_value', family)}),
j0 AS (SELECT {k}, g, v, {rank(k)} AS rk FROM i0), j1 AS (SELECT {k}, g, sum(rk) AS s, CAST(count(*) AS DOUBLE) AS n FROM j0 GROUP BY {k}, g),
j2 AS (SELECT {k}, sum(c * c * c - c) AS ties FROM (SELECT {k}, v, CAST(count(*) AS DOUBLE) AS c FROM i0 GROUP BY {k}, v) GROUP BY {k}),
j3 AS (SELECT {k}, sum(n) AS n, count(*) AS k, min(n) AS least_n, sum(s * s / n) AS q FROM j1 GROUP BY {k}),
kw AS (SELECT {', '.join('j3.' + x.strip() for x in k.split(','))}, n, k, least_n, (12.0 * q / (n * (n + 1)) - 3 * (n + 1)) / nullif(1 - ties / (n * n * n - n), 0) AS h FROM j3 JOIN j2 ON {on('j3', 'j2')})"""


_TAIL = "(1.0 / (1.0 + 0.3275911 * abs(z) / sqrt(2.0)))"
_P = f"{_TAIL} * (0.254829592 + {_TAIL} * (-0.284496736 + {_TAIL} * (1.421413741 + {_TAIL} * (-1.453152027 + {_TAIL} * 1.061405429)))) * exp(-z * z / 2.0)"


@query("bh_adjust", f"""
WITH {_SIDES}, p AS (SELECT comparison, round({_P}, 9) AS p FROM z), r AS (SELECT *, p * count(*) OVER () / row_number() OVER (ORDER BY p, comparison) AS raw FROM p)
SELECT comparison, round(p, 6) AS p, round(least(1.0, min(raw) OVER (ORDER BY p DESC, raw ROWS UNBOUNDED PRECEDING)), 6) AS p_adj_BH FROM r
""")  # fmt: skip
def _(spark, sf):
    from gatefold.functions.tails import normal_tail_expr

    t = ranks.rank_sum(ranks.against_reference(_binned(spark, sf), [], "group", "value"), [], "value")
    return ranks.bh_adjust(t.select("comparison", F.round(normal_tail_expr(F.col("z")), 9).alias("p")), "p").select("comparison", r6("p"), r6("p_adj_BH"))


@query("kruskal_stats", f"""
WITH {SUPPLIER_SQL}, b AS (SELECT grp, floor(value / 300) AS v FROM sv), k AS (SELECT grp, v, {_RANK.format(k='1', v='v')} AS rk FROM b), g AS (SELECT grp, sum(rk) AS s, CAST(count(*) AS DOUBLE) AS n FROM k GROUP BY 1),
t AS (SELECT sum(c * c * c - c) AS ties FROM (SELECT CAST(count(*) AS DOUBLE) AS c FROM b GROUP BY v)), h AS (SELECT sum(n) AS n, count(*) AS k, sum(s * s / n) AS q FROM g)
SELECT CAST(n AS BIGINT) AS n, k AS n_groups, round((12.0 * q / (n * (n + 1)) - 3 * (n + 1)) / (1 - ties / (n * n * n - n)), 6) AS h, k - 1 AS df FROM h, t
""")  # fmt: skip
def _(spark, sf):
    s = supplier_values(spark, sf).withColumn("v", F.floor(F.col("value") / 300).cast("double"))
    return ranks.kruskal(s, [], "group", "v").select("n", "n_groups", r6("h"), "df")


_ORD = """o AS (SELECT o_custkey % 40 AS pair, o_orderpriority AS cond, round(avg(o_totalprice), 2) AS v FROM orders GROUP BY 1, 2)"""


def _orders(spark, sf):
    o = table(spark, sf, "orders").groupBy((F.col("o_custkey") % 40).alias("pair"), F.col("o_orderpriority").alias("cond"))
    return o.agg(F.round(F.avg("o_totalprice"), 2).alias("v"))


@query("signed_rank_stats", f"""
WITH {_ORD}, d AS (SELECT a.pair, round(floor((a.v - b.v) / 500.0), 2) AS d FROM o a JOIN o b ON a.pair = b.pair AND a.cond = '1-URGENT' AND b.cond = '5-LOW'), e AS (SELECT d, abs(d) AS a FROM d WHERE d <> 0),
k AS (SELECT d, a, {_RANK.format(k='1', v='a')} AS rk FROM e), t AS (SELECT sum(c * c * c - c) AS ties FROM (SELECT CAST(count(*) AS DOUBLE) AS c FROM e GROUP BY a)),
s AS (SELECT CAST(count(*) AS DOUBLE) AS n, sum(CASE WHEN d > 0 THEN rk ELSE 0 END) AS v, sum(rk) AS total FROM k)
SELECT CAST(n AS BIGINT) AS n_nonzero, round(v, 6) AS v, round((v - n * (n + 1) / 4 - sign(v - n * (n + 1) / 4) * 0.5) / sqrt(n * (n + 1) * (2 * n + 1) / 24 - ties / 48), 6) AS z, round(2 * v / total - 1, 6) AS rank_biserial FROM s, t
""")  # fmt: skip
def _(spark, sf):
    o = _orders(spark, sf)
    a, b = o.filter("cond = '1-URGENT'").select("pair", F.col("v").alias("a")), o.filter("cond = '5-LOW'").select("pair", F.col("v").alias("b"))
    d = a.join(b, "pair").select(F.lit("all").alias("k"), F.floor((F.col("a") - F.col("b")) / 500.0).cast("double").alias("d"))
    return ranks.signed_rank(d, ["k"], "d").select("n_nonzero", r6("v"), r6("z"), r6("rank_biserial"))


@query("friedman_stats", f"""
WITH {_ORD}, c AS (SELECT count(DISTINCT cond) AS k FROM o), f AS (SELECT pair FROM o, c GROUP BY pair, k HAVING count(DISTINCT cond) = k), x AS (SELECT pair, cond, floor(v / 5000) AS v FROM o JOIN f USING (pair)),
r AS (SELECT pair, cond, v, {_RANK.format(k='pair', v='v')} AS rk FROM x), p AS (SELECT cond, sum(rk) AS s, count(*) AS b FROM r GROUP BY 1), q AS (SELECT sum(s * s) AS q, CAST(max(b) AS DOUBLE) AS b, CAST(count(*) AS DOUBLE) AS k FROM p),
t AS (SELECT sum(c * c * c - c) AS ties FROM (SELECT CAST(count(*) AS DOUBLE) AS c FROM x GROUP BY pair, v))
SELECT CAST(b AS BIGINT) AS n_blocks, CAST(k AS BIGINT) AS n_conditions, round((12 * q - 3 * b * b * k * (k + 1) * (k + 1)) / (b * k * (k + 1) - ties / (k - 1)), 5) AS q FROM q, t
""")  # fmt: skip
def _(spark, sf):
    o = _orders(spark, sf).select(F.lit("all").alias("k"), "pair", "cond", F.floor(F.col("v") / 5000).cast("double").alias("v"))
    return ranks.friedman(o, ["k"], "pair", "cond", "v").select("n_blocks", "n_conditions", F.round("q", 5).alias("q"))


@query("spearman_rho", f"""
WITH {SUPPLIER_SQL}, r AS (SELECT grp, {_RANK.format(k='grp', v='value')} AS x, {_RANK.format(k='grp', v='qty')} AS y FROM sv)
SELECT grp AS "group", count(*) AS n, round(corr(x, y), 6) AS rho FROM r GROUP BY 1
""")  # fmt: skip
def _(spark, sf):
    return ranks.spearman(supplier_values(spark, sf), ["group"], "value", "qty").select("group", "n", r6("rho"))


# two populations, so that families and omnibus tests have more than one
_TWO = f"""{SUPPLIER_SQL}, tp AS (SELECT 'all' AS population, grp, value FROM sv UNION ALL SELECT 'qty', grp, qty FROM sv)"""


def _two(s):
    both = F.array(F.struct(F.lit("all").alias("population"), F.col("value").alias("v")), F.struct(F.lit("qty").alias("population"), F.col("qty").alias("v")))
    return s.select("sample_id", F.explode(both).alias("r")).select("sample_id", "r.population", F.col("r.v").alias("value"))


@query("group_comparison_stats", f"""
WITH {_TWO}, {rank_sum_sql('tp', 'population')}
SELECT rs.population, reference, comparison, CAST(n1 AS BIGINT) AS n_reference, CAST(n2 AS BIGINT) AS n_comparison, round(median_reference, 4) AS median_reference, round(median_comparison, 4) AS median_comparison, round(mean_reference, 4) AS mean_reference,
       round(mean_comparison, 4) AS mean_comparison, round(sd_reference, 4) AS sd_reference, round(sd_comparison, 4) AS sd_comparison, round_even(delta, 3) AS cliffs_delta, round(p_value, 6) AS p_value, round(p_adj_BH, 6) AS "p_adj_BH",
       round({p_chi4_sql('h')}, 6) AS p_omnibus_kruskal, round(median_comparison / median_reference, 6) AS fold_change, p_adj_BH < 0.05 AS "significant_BH" FROM rs JOIN kw USING (population)
""")  # fmt: skip
def _(spark, sf):
    s = supplier_values(spark, sf)
    t = ranks.compare_groups(_two(s), s.select("sample_id", "group"), "value")
    four = [F.round(c, 4).alias(c) for c in ("median_reference", "median_comparison", "mean_reference", "mean_comparison", "sd_reference", "sd_comparison")]
    return t.select("population", "reference", "comparison", "n_reference", "n_comparison", *four, "cliffs_delta", *[r6(c) for c in ("p_value", "p_adj_BH", "p_omnibus_kruskal", "fold_change")], "significant_BH")


@query("paired_comparison_stats", f"""
WITH {_ORD}, a AS (SELECT o.pair, o.cond, o.v, r.v AS ref FROM o LEFT JOIN o r ON r.pair = o.pair AND r.cond = '1-URGENT' WHERE o.cond <> '1-URGENT'), b AS (SELECT cond, pair, ref AS x, v AS y FROM a WHERE ref IS NOT NULL),
seen AS (SELECT cond, count(*) AS pairs FROM (SELECT DISTINCT c.cond, p.pair FROM (SELECT DISTINCT cond FROM a) c JOIN o p ON p.cond IN (c.cond, '1-URGENT')) GROUP BY 1),
m AS (SELECT cond, count(*) AS n_pairs, quantile_cont(x, 0.5) AS median_reference, quantile_cont(y, 0.5) AS median_comparison, quantile_cont(y - x, 0.5) AS median_paired_difference FROM b GROUP BY 1 HAVING count(*) >= 5),
e AS (SELECT cond, x - y AS d, abs(x - y) AS a FROM b WHERE x <> y), k AS (SELECT cond, d, a, {_RANK.format(k='cond', v='a')} AS rk FROM e), t AS (SELECT cond, sum(c * c * c - c) AS ties FROM (SELECT cond, a, CAST(count(*) AS DOUBLE) AS c FROM e GROUP BY 1, 2) GROUP BY 1),
s AS (SELECT cond, CAST(count(*) AS DOUBLE) AS n, sum(CASE WHEN d > 0 THEN rk ELSE 0 END) AS v, sum(rk) AS total FROM k GROUP BY 1),
z AS (SELECT m.*, seen.pairs, 1 - 2 * v / total AS rb, (v - n * (n + 1) / 4 - sign(v - n * (n + 1) / 4) * 0.5) / sqrt(n * (n + 1) * (2 * n + 1) / 24 - ties / 48) AS z FROM m JOIN s USING (cond) JOIN t USING (cond) JOIN seen USING (cond)),
p AS (SELECT *, {p_normal_sql('z')} AS p_value FROM z), h AS ({bh_sql('p', 'p_value')}),
f0 AS (SELECT pair FROM o GROUP BY 1 HAVING count(DISTINCT cond) = (SELECT count(DISTINCT cond) FROM o)), f1 AS (SELECT pair, cond, v, {_RANK.format(k='pair', v='v')} AS rk FROM o JOIN f0 USING (pair)),
f2 AS (SELECT cond, sum(rk) AS s, CAST(count(*) AS DOUBLE) AS b FROM f1 GROUP BY 1), f3 AS (SELECT sum(s * s) AS q, max(b) AS b, CAST(count(*) AS DOUBLE) AS c FROM f2), f4 AS (SELECT sum(c * c * c - c) AS ties FROM (SELECT CAST(count(*) AS DOUBLE) AS c FROM f1 GROUP BY pair, v)),
f AS (SELECT (12 * q - 3 * b * b * c * (c + 1) * (c + 1)) / (b * c * (c + 1) - ties / (c - 1)) AS q FROM f3, f4)
SELECT 'all' AS population, '1-URGENT' AS reference_condition, cond AS comparison_condition, n_pairs, CAST(pairs - n_pairs AS BIGINT) AS n_incomplete_pairs_dropped, round(median_reference, 3) AS median_reference, round(median_comparison, 3) AS median_comparison,
       round(median_paired_difference, 3) AS median_paired_difference, round(rb, 6) AS rank_biserial, round(p_value, 6) AS p_value, round(p_adj_BH, 6) AS "p_adj_BH", round({p_chi4_sql('q')}, 6) AS p_omnibus_friedman FROM h, f
""")  # fmt: skip
def _(spark, sf):
    o = _orders(spark, sf).withColumn("sample_id", F.concat_ws("/", "pair", "cond"))
    f = o.select("sample_id", F.lit("all").alias("population"), F.col("v").alias("pct_of_cd45_pos"))
    t = ranks.compare_paired(f, o.select("sample_id", F.col("pair").cast("string").alias("pair"), F.col("cond").alias("condition")))
    three = [F.round(c, 3).alias(c) for c in ("median_reference", "median_comparison", "median_paired_difference")]
    return t.select("population", "reference_condition", "comparison_condition", "n_pairs", "n_incomplete_pairs_dropped", *three, *[r6(c) for c in ("rank_biserial", "p_value", "p_adj_BH", "p_omnibus_friedman")])


# ---------------------------------------------------------------- composition
_CLR = """f AS (SELECT user_id AS sample_id, event_type AS population, 100.0 * sum((value > 60)::INT) / count(*) AS pct FROM events GROUP BY 1, 2),
m AS (SELECT 0.65 * min(CASE WHEN pct > 0 THEN pct END) AS delta FROM f), wc AS (SELECT *, sum((pct <= 0)::INT) OVER s AS z, sum(pct) OVER s AS tot, count(*) OVER s AS k FROM f, m WINDOW s AS (PARTITION BY sample_id)),
l AS (SELECT *, ln(CASE WHEN z = 0 THEN pct WHEN pct <= 0 THEN delta WHEN pct * (1 - z * delta / tot) <= 0 THEN delta ELSE pct * (1 - z * delta / tot) END) AS l FROM wc WHERE k >= 2 AND tot > 0)"""


def _freq(spark, sf):
    e = table(spark, sf, "events").groupBy(F.col("user_id").alias("sample_id"), F.col("event_type").alias("population"))
    return e.agg((100.0 * F.sum((F.col("value") > 60).cast("long")) / F.count(F.lit(1))).alias("pct_of_cd45_pos"))


@query("clr_transform", f"WITH {_CLR} SELECT sample_id, population, round(pct, 6) AS pct, round(l - avg(l) OVER (PARTITION BY sample_id), 6) AS clr FROM l")
def _(spark, sf):
    return compositional.clr(_freq(spark, sf)).select("sample_id", "population", r6("pct_of_cd45_pos", "pct"), r6("clr"))


@query("clr_concordance", f"""
WITH {_CLR}, c AS (SELECT sample_id, population, sample_id % 2 = 0 AS is_ref, round(pct, 9) AS a, round(l - avg(l) OVER (PARTITION BY sample_id), 9) AS b FROM l),
u AS (SELECT population, is_ref, 'raw' AS kind, a AS v FROM c UNION ALL SELECT population, is_ref, 'clr', b FROM c), k AS (SELECT *, {_RANK.format(k='population, kind', v='v')} AS rk FROM u),
t AS (SELECT population, kind, sum(c * c * c - c) AS ties FROM (SELECT population, kind, v, CAST(count(*) AS DOUBLE) AS c FROM u GROUP BY 1, 2, 3) GROUP BY 1, 2),
s AS (SELECT population, kind, CAST(sum(is_ref::INT) AS DOUBLE) AS n1, CAST(sum((NOT is_ref)::INT) AS DOUBLE) AS n2, sum(CASE WHEN is_ref THEN rk END) AS r1, sum(CASE WHEN NOT is_ref THEN rk END) AS r2 FROM k GROUP BY 1, 2),
w AS (SELECT population, kind, r1 - n1 * (n1 + 1) / 2 - n1 * n2 / 2 AS w, n1 * n2 / 12 * ((n1 + n2 + 1) - ties / ((n1 + n2) * (n1 + n2 - 1))) AS var, 2 * (r2 - n2 * (n2 + 1) / 2) / (n1 * n2) - 1 AS d FROM s JOIN t USING (population, kind)),
z AS (SELECT population, kind, d, (w - sign(w) * 0.5) / sqrt(var) AS z FROM w), p AS (SELECT population, kind, d, {_P} AS p FROM z)
SELECT a.population, round(a.p, 5) AS p_raw, round(b.p, 5) AS p_clr, round(a.d, 6) AS cliffs_delta_raw, round(b.d, 6) AS cliffs_delta_clr,
       CASE WHEN a.p < 0.05 AND b.p < 0.05 THEN 'robust_to_composition' WHEN a.p < 0.05 THEN 'raw_only__possible_composition_artefact' WHEN b.p < 0.05 THEN 'clr_only__was_masked_by_composition' ELSE 'not_significant_either' END AS verdict
FROM p a JOIN p b ON a.population = b.population AND a.kind = 'raw' AND b.kind = 'clr'
""")  # fmt: skip
def _(spark, sf):
    from gatefold.functions.tails import normal_tail_expr

    c = compositional.clr(_freq(spark, sf)).withColumn("group", F.when(F.col("sample_id") % 2 == 0, "a").otherwise("b"))

    def test(v):
        d = c.select("population", "group", F.round(v, 9).alias("v"))
        t = ranks.rank_sum(ranks.against_reference(d, ["population"], "group", "v", "a"), ["population"], "v")
        return t.withColumn("p_value", normal_tail_expr(F.col("z")))

    out = compositional.concordance(test("pct_of_cd45_pos"), test("clr"))
    return out.select("population", F.round("p_raw", 5).alias("p_raw"), F.round("p_clr", 5).alias("p_clr"), r6("cliffs_delta_raw"), r6("cliffs_delta_clr"), "verdict")


@query("contingency_cramers_v", """
WITH c AS (SELECT lang, source, CAST(count(*) AS DOUBLE) AS o FROM documents GROUP BY 1, 2), w AS (SELECT *, sum(o) OVER (PARTITION BY lang) AS a, sum(o) OVER (PARTITION BY source) AS b, sum(o) OVER () AS n FROM c),
s AS (SELECT max(n) AS n, count(DISTINCT lang) AS na, count(DISTINCT source) AS nb, sum(o * o / (a * b / n)) - max(n) AS chi2 FROM w)
SELECT CAST(n AS BIGINT) AS n, na AS n_a, nb AS n_b, round(chi2, 5) AS chi2, round(sqrt(greatest(chi2 / (n * (least(na, nb) - 1)), 0)), 6) AS v FROM s
""")  # fmt: skip
def _(spark, sf):
    return compositional.cramers_v(table(spark, sf, "documents"), "lang", "source").select("n", "n_a", "n_b", F.round("chi2", 5).alias("chi2"), r6("v"))


def _covariates(s):
    return s.select("sample_id", F.col("qty").alias("age"), (F.col("sample_id") % 13).cast("double").alias("load"), F.when(F.col("sample_id") % 2 == 0, "F").otherwise("M").alias("sex"))


_COV = f"{SUPPLIER_SQL}, cv AS (SELECT grp, value, unnest(['age', 'load']) AS covariate, unnest([qty, CAST(sample_id % 13 AS DOUBLE)]) AS x FROM sv)"


@query("confounding_diagnostics", f"""
WITH {_COV}, {rank_sum_sql('cv', 'covariate', 'grp', 'x')},
sr AS (SELECT covariate, {_RANK.format(k='covariate', v='x')} AS a, {_RANK.format(k='covariate', v='value')} AS b FROM cv), sp AS (SELECT covariate, CAST(count(*) AS BIGINT) AS n, corr(a, b) AS rho FROM sr GROUP BY 1),
st AS (SELECT *, rho * sqrt((n - 2) / (1 - rho * rho)) AS t FROM sp),
u AS (SELECT covariate, CAST(NULL AS VARCHAR) AS population, 'cohort' AS comparison, 'Kruskal-Wallis' AS test, CAST(NULL AS DOUBLE) AS rho, {p_chi4_sql('h')} AS p, CAST(n AS BIGINT) AS n FROM kw
  UNION ALL SELECT covariate, 'all', 'outcome', 'Spearman', rho, {p_t_sql('t', '(n - 2)')}, n FROM st), h AS ({bh_sql('u', 'p')})
SELECT covariate, population, comparison, test, round(rho, 6) AS rho, round(p, 6) AS p_value, n, round(p_adj_BH, 6) AS "p_adj_BH",
       CASE WHEN comparison = 'outcome' THEN CASE WHEN p_adj_BH < 0.05 AND covariate IN (SELECT covariate FROM h WHERE comparison = 'cohort' AND p_adj_BH < 0.05) THEN 'HIGH' ELSE 'low' END END AS confounder_risk FROM h
""")  # fmt: skip
def _(spark, sf):
    s = supplier_values(spark, sf)
    c = compositional.confounding(s.select("sample_id", F.lit("all").alias("population"), F.col("value").alias("pct_of_cd45_pos")), _covariates(s), s.select("sample_id", "group"), ["age", "load"])
    return c.select("covariate", "population", "comparison", "test", r6("rho"), r6("p_value"), "n", r6("p_adj_BH"), "confounder_risk")


@query("confounding_categorical")
def _(spark, sf):
    s = supplier_values(spark, sf)
    return compositional.confounding(s.select("sample_id", F.lit("all").alias("population"), F.col("value").alias("pct_of_cd45_pos")), _covariates(s), s.select("sample_id", "group"), ["age", "sex"])


def _rss(tag: str, by: str) -> str:
    """CTE: residual sum of squares of the ranked outcome on age and sex, all centred within by (Frisch-Waugh-Lovell)."""
    c = lambda x: f"{x} - avg({x}) OVER (PARTITION BY {by})"
    return f"""{tag}0 AS (SELECT {c('y')} AS y, {c('age')} AS a, {c('sex')} AS b FROM rk), {tag}1 AS (SELECT sum(y * y) AS yy, sum(a * a) AS aa, sum(b * b) AS bb, sum(a * b) AS ab, sum(a * y) AS ay, sum(b * y) AS byy FROM {tag}0),
{tag} AS (SELECT yy - (ay * (ay * bb - byy * ab) + byy * (byy * aa - ay * ab)) / (aa * bb - ab * ab) AS rss FROM {tag}1)"""


@query("rank_ancova", f"""
WITH {SUPPLIER_SQL}, rk AS (SELECT grp, qty AS age, CASE WHEN sample_id % 2 = 0 THEN 0.0 ELSE 1.0 END AS sex, {_RANK.format(k='1', v='value')} AS y FROM sv), {_rss('r', '1')}, {_rss('f', 'grp')},
n AS (SELECT count(*) AS n, count(DISTINCT grp) AS g FROM rk), t AS (SELECT n, n - g - 2 AS df2, g - 1 AS df1, ((r.rss - f.rss) / (g - 1)) / (f.rss / (n - g - 2)) AS fs FROM n, r, f),
x AS (SELECT *, df2 / (df2 + df1 * fs) AS x FROM t)
SELECT 'all' AS population, CAST(n AS BIGINT) AS n, CAST(df2 AS BIGINT) AS residual_df, round(fs, 5) AS "F_group", round(pow(x, df2 / 2.0) * (1 + df2 / 2.0 * (1 - x)), 6) AS p_group_adjusted, 'fitted' AS status, 'age,sex' AS covariates FROM x
""")  # fmt: skip
def _(spark, sf):
    s = supplier_values(spark, sf)
    a = compositional.rank_ancova(s.select("sample_id", F.lit("all").alias("population"), F.col("value").alias("pct_of_cd45_pos")), _covariates(s), s.select("sample_id", "group"), ["age", "sex"])
    return a.select("population", "n", "residual_df", F.round("F_group", 5).alias("F_group"), r6("p_group_adjusted"), "status", "covariates")


# ---------------------------------------------------------------- diagnostics
_DRIFT = f"""{SUPPLIER_SQL}, th AS (SELECT grp, sample_id, unnest(['price', 'qty']) AS marker, unnest([value, qty + CASE WHEN grp = 'ASIA' THEN 2 ELSE 0 END]) AS value, CASE WHEN sample_id % 3 = 0 THEN 'control_q995' ELSE 'valley' END AS source FROM sv)"""


@query("threshold_drift", f"""
WITH {_DRIFT}, {rank_sum_sql('th', 'marker')}, g AS (SELECT marker, grp, quantile_cont(value, 0.5) AS med, stddev_samp(value) AS sd, count(*) AS n FROM th GROUP BY 1, 2),
h AS (SELECT marker, max(med) - min(med) AS gap, quantile_cont(sd, 0.5) AS within_sd, sum(n) AS n, count(*) AS k FROM g GROUP BY 1), sc AS (SELECT marker, arg_max(source, c) AS dominant_source FROM (SELECT marker, source, count(*) AS c FROM th GROUP BY 1, 2) GROUP BY 1),
p AS (SELECT marker, {p_chi4_sql('h')} AS p FROM kw), b AS ({bh_sql('p', 'p')})
SELECT marker, CAST(h.n AS BIGINT) AS n_samples, h.k AS n_groups, round(gap, 3) AS gap, round(within_sd, 3) AS spread, round_even(gap / within_sd, 2) AS gap_over_sd, round(p, 6) AS p_value, round(p_adj_BH, 6) AS "p_adj_BH", dominant_source,
       CASE WHEN p_adj_BH < 0.05 AND round_even(gap / within_sd, 2) >= 1 THEN 'FLAGGED' WHEN p < 0.05 THEN 'watch' ELSE '' END AS drift_flag
FROM h JOIN b USING (marker) JOIN sc USING (marker)
""")  # fmt: skip
def _(spark, sf):
    s = supplier_values(spark, sf)
    moved = F.col("qty") + F.when(F.col("group") == "ASIA", 2).otherwise(0)
    t = s.select("sample_id", F.explode(F.array(F.struct(F.lit("price").alias("marker"), F.col("value").alias("threshold")), F.struct(F.lit("qty").alias("marker"), moved.alias("threshold")))).alias("r"), F.when(F.col("sample_id") % 3 == 0, "control_q995").otherwise("valley").alias("source"))
    d = diagnostics.threshold_drift(t.select("sample_id", "r.marker", "r.threshold", "source"), s.select("sample_id", "group"))
    return d.select("marker", "n_samples", "n_groups", F.round("median_gap_between_groups", 3).alias("gap"), F.round("typical_within_group_sd", 3).alias("spread"), "gap_over_sd", r6("p_value"), r6("p_adj_BH"), "dominant_source", "drift_flag")


@query("marker_state_stats", f"""
WITH {_SCORED}, {_MFI}, {_STATE}, {rank_sum_sql('ms', 'population, marker, measure', 'grp', 'value', 'measure')},
cc AS (SELECT population, marker, measure, grp, CAST(sum(n_cells) AS BIGINT) AS cells FROM ms GROUP BY ALL)
SELECT rs.population, rs.marker, rs.measure, reference, comparison, CAST(n1 AS BIGINT) AS n_reference, CAST(n2 AS BIGINT) AS n_comparison, a.cells AS cells_reference, b.cells AS cells_comparison, round(median_comparison - median_reference, 5) AS delta_median, round(delta, 6) AS cliffs_delta,
       round(p_value, 6) AS p_value, round(p_adj_BH, 6) AS "p_adj_BH", CASE WHEN kw.k > 2 AND kw.least_n >= 3 THEN round({p_chi4_sql('h')}, 6) END AS p_omnibus_kruskal
FROM rs JOIN kw ON kw.population = rs.population AND kw.marker = rs.marker AND kw.measure = rs.measure
JOIN cc a ON a.population = rs.population AND a.marker = rs.marker AND a.measure = rs.measure AND a.grp = reference JOIN cc b ON b.population = rs.population AND b.marker = rs.marker AND b.measure = rs.measure AND b.grp = comparison
""")  # fmt: skip
def _(spark, sf):
    from gatefold.operators import populations

    s, t = _scored(spark, sf)
    m = cut(populations.marker_summary(s, POPS, ["m2", "m3"], t), "summary")
    m = m.withColumns({"median_asinh": F.round("median_asinh", 6), "pct_positive": F.round("pct_positive", 6)})
    g = table(spark, sf, "nation").join(F.broadcast(table(spark, sf, "region")), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_name").alias("sample_id"), F.col("r_name").alias("group"))
    d = diagnostics.differential_state(m, g)
    return d.select("population", "marker", "measure", "reference", "comparison", "n_reference", "n_comparison", "cells_reference", "cells_comparison", F.round("delta_median", 5).alias("delta_median"), *[r6(c) for c in ("cliffs_delta", "p_value", "p_adj_BH", "p_omnibus_kruskal")])


@query("subcluster_shifts", f"""
WITH c AS (SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS e0, label % 2 AS population, CASE WHEN label < 5 THEN 1 ELSE 2 END AS sub, CASE WHEN vec_id % 3 = 0 THEN 'r' WHEN vec_id % 3 = 1 THEN 's' ELSE 't' END AS g FROM embeddings),
occ AS (SELECT population, sub, g, 100.0 * count(*) / sum(count(*)) OVER (PARTITION BY population, g) AS occ FROM c GROUP BY 1, 2, 3),
s AS (SELECT population, sub, g AS study, FALSE AS is_ref, e0 FROM c WHERE g <> 'r' UNION ALL SELECT population, sub, o.study, TRUE, e0 FROM c, (SELECT unnest(['s', 't']) AS study) o WHERE g = 'r'),
k AS (SELECT *, {_RANK.format(k='population, sub, study', v='e0')} AS rk FROM s),
a AS (SELECT population, sub, study, sum(is_ref::INT) AS n1, sum((NOT is_ref)::INT) AS n2, sum(CASE WHEN NOT is_ref THEN rk END) AS r2, quantile_cont(CASE WHEN is_ref THEN e0 END, 0.5) AS m1, quantile_cont(CASE WHEN NOT is_ref THEN e0 END, 0.5) AS m2 FROM k GROUP BY 1, 2, 3 HAVING sum(is_ref::INT) >= 20 AND sum((NOT is_ref)::INT) >= 20)
SELECT CAST(a.population AS INTEGER) AS population, CAST(a.sub AS INTEGER) AS subcluster, a.study, CAST(n1 AS BIGINT) AS n_reference, CAST(n2 AS BIGINT) AS n_study, round_even(r.occ, 3) AS occupancy_pct_reference, round_even(x.occ, 3) AS occupancy_pct_study,
       round_even(m2 - m1, 4) AS median_delta, round_even(2 * (r2 - n2 * (n2 + 1) / 2.0) / (n1 * n2) - 1, 4) AS cliffs_delta
FROM a JOIN occ r ON r.population = a.population AND r.sub = a.sub AND r.g = 'r' JOIN occ x ON x.population = a.population AND x.sub = a.sub AND x.g = a.study
""")  # fmt: skip
def _(spark, sf):
    e = embedding_columns(spark, sf, 1)
    c = e.select("e0", (F.col("label") % 2).alias("population_label"), F.when(F.col("label") < 5, 1).otherwise(2).alias("subcluster"), F.when(F.col("vec_id") % 3 == 0, "r").when(F.col("vec_id") % 3 == 1, "s").otherwise("t").alias("g"))
    s = diagnostics.subcluster_shifts(c, ["e0"], "g", "r")
    return s.select("population", "subcluster", "study", "n_reference", "n_study", "occupancy_pct_reference", "occupancy_pct_study", "median_delta", "cliffs_delta")


def _points(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", F.transform(F.slice("embedding", 1, 4), lambda v: F.round(v.cast("double"), 4)).alias("xy"), "label")


@query("lisi_scores", """
WITH p AS (SELECT vec_id, label, list_transform(embedding[1:4], lambda v: round(CAST(v AS DOUBLE), 4)) AS x FROM embeddings),
d AS (SELECT a.vec_id, b.label, row_number() OVER (PARTITION BY a.vec_id ORDER BY pow(a.x[1] - b.x[1], 2) + pow(a.x[2] - b.x[2], 2) + pow(a.x[3] - b.x[3], 2) + pow(a.x[4] - b.x[4], 2), b.vec_id) AS r FROM p a JOIN p b ON a.vec_id <> b.vec_id),
c AS (SELECT vec_id, label, CAST(count(*) AS DOUBLE) AS c FROM d WHERE r <= 30 GROUP BY 1, 2)
SELECT vec_id, round(sum(c) * sum(c) / sum(c * c), 6) AS lisi FROM c GROUP BY 1
""")  # fmt: skip
def _(spark, sf):
    p = _points(spark, sf)
    return diagnostics.lisi(diagnostics.neighbours(p, "vec_id", "xy", 30), p, "vec_id", "label").select("vec_id", r6("lisi"))


@query("batch_confounding", """
WITH c AS (SELECT label % 3 AS a, vec_id % 2 AS b, CAST(count(*) AS DOUBLE) AS o FROM embeddings GROUP BY 1, 2), w AS (SELECT *, sum(o) OVER (PARTITION BY a) AS ra, sum(o) OVER (PARTITION BY b) AS rb, sum(o) OVER () AS n FROM c),
s AS (SELECT sqrt(greatest((sum(o * o / (ra * rb / n)) - max(n)) / (max(n) * (least(count(DISTINCT a), count(DISTINCT b)) - 1)), 0)) AS v FROM w)
SELECT round(v, 6) AS v, CASE WHEN v >= 0.8 THEN 'SEVERE' WHEN v >= 0.5 THEN 'substantial' WHEN v >= 0.3 THEN 'moderate' ELSE 'low' END AS verdict FROM s
""")  # fmt: skip
def _(spark, sf):
    e = table(spark, sf, "embeddings").select((F.col("label") % 3).alias("batch"), (F.col("vec_id") % 2).alias("grp"))
    return compositional.cramers_v(e, "batch", "grp").select(r6("v"), compositional.cramers_verdict("v").alias("verdict"))


# ---------------------------------------------------------------- clusters
_AGREE = """c AS (SELECT CAST(vec_id % 7 % 4 AS INTEGER) AS cluster, CASE WHEN label = 9 THEN 'Other x' ELSE 'p' || (label % 4) END AS lab FROM embeddings),
n AS (SELECT cluster, lab, count(*) AS n FROM c GROUP BY 1, 2), w AS (SELECT *, sum(n) OVER (PARTITION BY cluster) AS c_n, sum(n) OVER (PARTITION BY lab) AS p_n, sum(n) OVER () AS all_n,
  row_number() OVER (PARTITION BY cluster ORDER BY n DESC, lab) AS rc, row_number() OVER (PARTITION BY lab ORDER BY n DESC, cluster) AS rp FROM n)"""


def _clustered(spark, sf):
    return table(spark, sf, "embeddings").select((F.col("vec_id") % 7 % 4).cast("int").alias("cluster"), F.when(F.col("label") == 9, "Other x").otherwise(F.concat(F.lit("p"), (F.col("label") % 4).cast("string"))).alias("population_label"))


@query("cluster_label_agreement", f"""
WITH {_AGREE} SELECT cluster, CAST(max(c_n) AS BIGINT) AS n_cells, max(CASE WHEN rc = 1 THEN lab END) AS dominant_gate_label, max(CASE WHEN rc = 2 THEN lab END) AS second_label, count(*) AS n_labels_present,
 CASE WHEN max(CASE WHEN rc = 1 THEN lab END) LIKE 'Other%' THEN 'UNDESCRIBED' WHEN max(CASE WHEN rc = 1 THEN n END) / max(c_n) >= 0.8 THEN 'clean' WHEN max(CASE WHEN rc = 1 THEN n END) / max(c_n) >= 0.5 THEN 'mixed' ELSE 'fragmented' END AS interpretation
FROM w GROUP BY cluster
""")  # fmt: skip
def _(spark, sf):
    return clusters.agreement(_clustered(spark, sf))[0].select("cluster", "n_cells", "dominant_gate_label", "second_label", "n_labels_present", "interpretation")


@query("population_cluster_agreement", f"""
WITH {_AGREE} SELECT lab AS population, CAST(max(p_n) AS BIGINT) AS n_cells, max(CASE WHEN rp = 1 THEN cluster END) AS dominant_cluster, CAST(max(CASE WHEN rp = 1 THEN c_n END) AS BIGINT) AS dominant_cluster_total_cells FROM w GROUP BY lab
""")  # fmt: skip
def _(spark, sf):
    return clusters.agreement(_clustered(spark, sf))[1].select("population", "n_cells", "dominant_cluster", "dominant_cluster_total_cells")


@query("cohort_composition", """
WITH n AS (SELECT lang AS population, source AS g, CAST(count(*) AS DOUBLE) AS n FROM documents GROUP BY 1, 2), e AS (SELECT population, g, n / sum(n) OVER (PARTITION BY g) AS e FROM n)
SELECT population, g AS "group", round(100.0 * e / sum(e) OVER (PARTITION BY population), 6) AS pct FROM e
""")  # fmt: skip
def _(spark, sf):
    return clusters.composition(table(spark, sf, "documents"), "source", "lang").select("population", "group", r6("pct"))


@query("som_clusters")
def _(spark, sf):
    e = embedding_columns(spark, sf, 4)
    return clusters.unsupervised(e, ["e0", "e1", "e2", "e3"], "vec_id", 6, 6, 5).groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))


@query("subcluster_k_selection")
def _(spark, sf):
    e = embedding_columns(spark, sf, 4).withColumn("cohort", F.lit("r")).withColumn("population_label", F.when(F.col("label") < 5, "low").otherwise("high"))
    return clusters.choose_k(e, ["e0", "e1", "e2", "e3"], "cohort", "r", "vec_id", ks=(2, 3))


@query("subcluster_by_reference")
def _(spark, sf):
    e = embedding_columns(spark, sf, 4).withColumn("cohort", F.when(F.col("vec_id") % 4 > 0, "r").otherwise("s")).withColumn("population_label", F.when(F.col("label") < 5, "low").otherwise("high"))
    return clusters.subclusters(e, ["e0", "e1", "e2", "e3"], "cohort", "r", "vec_id", 2, min_ref=100).groupBy("population_label", "subcluster").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- joins and conformance
@query("external_label_join", "SELECT d.doc_id, d.lang, CAST(l.quality AS VARCHAR) AS quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def _(spark, sf):
    from gatefold.operators.gate_learning import join_labels

    c = table(spark, sf, "documents").select(F.lit("all").alias("sample_id"), F.col("doc_id").alias("event_index"), "lang")
    lab = table(spark, sf, "labels").select(F.lit("all").alias("sample_id"), F.col("doc_id").alias("event_index"), F.col("quality").cast("string").alias("external_label"))
    return join_labels(c, lab).select(F.col("event_index").alias("doc_id"), "lang", F.col("external_label").alias("quality"))


_BASE = """m{h} AS (SELECT marker, count(*) AS n, quantile_cont(threshold, 0.5) AS med FROM {t} GROUP BY 1), s{h} AS (SELECT t.marker, 1.4826 * quantile_cont(abs(threshold - med), 0.5) AS mad FROM {t} t JOIN m{h} ON t.marker = m{h}.marker GROUP BY 1)"""


@query("conformance_verdicts", f"""
WITH t0 AS (SELECT 'p' || (l_suppkey % 5) AS marker, l_linestatus AS half, l_suppkey, round(avg(l_quantity), 6) + max(CASE WHEN l_suppkey % 5 = 1 AND l_linestatus = 'F' THEN 3 ELSE 0 END) AS threshold FROM lineitem GROUP BY 1, 2, 3),
b AS (SELECT * FROM t0 WHERE half = 'O'), c AS (SELECT * FROM t0 WHERE half = 'F'), {_BASE.format(h='b', t='b')}, {_BASE.format(h='c', t='c')}
SELECT mc.marker, mc.n AS n_samples, mb.n AS n_samples_baseline, round(mc.med, 5) AS median_threshold, round(mb.med, 5) AS baseline_threshold,
       CASE WHEN abs(mc.med - mb.med) / greatest(mad, 0.25) > 6 THEN 'fail' WHEN abs(mc.med - mb.med) / greatest(mad, 0.25) > 3.5 THEN 'qualify' ELSE 'pass' END AS verdict
FROM mc LEFT JOIN mb ON mc.marker = mb.marker LEFT JOIN sb ON sb.marker = mc.marker
""")  # fmt: skip
def _(spark, sf):
    k = F.col("l_suppkey")
    t = table(spark, sf, "lineitem").groupBy(F.concat(F.lit("p"), (k % 5).cast("string")).alias("marker"), F.col("l_linestatus").alias("half"), k).agg(F.round(F.avg("l_quantity"), 6).alias("threshold"))
    t = t.withColumn("threshold", F.col("threshold") + F.when((k % 5 == 1) & (F.col("half") == "F"), 3.0).otherwise(0.0)).withColumn("source", F.lit("valley"))
    base = conformance.marker_baseline(t.filter("half = 'O'"), ["marker"])
    m = conformance.marker_conformance(t.filter("half = 'F'"), base, ["marker"])
    return m.select("marker", "n_samples", "n_samples_baseline", F.round("median_threshold", 5).alias("median_threshold"), F.round("baseline_threshold", 5).alias("baseline_threshold"), "verdict")


@query("spec_changes", """
WITH d AS (SELECT user_id % 40 AS population, event_type AS marker, avg(value) FILTER (event_id % 2 = 0) AS a, avg(value) FILTER (event_id % 2 = 1) AS b FROM events GROUP BY 1, 2),
f AS (SELECT population, string_agg(marker || '=' || CASE WHEN a > 49 THEN 'above' ELSE 'below' END, '; ' ORDER BY marker) FILTER (a IS NOT NULL AND abs(a - 49) > 9) AS was, string_agg(marker || '=' || CASE WHEN b > 49 THEN 'above' ELSE 'below' END, '; ' ORDER BY marker) FILTER (b IS NOT NULL AND abs(b - 49) > 9) AS now FROM d GROUP BY 1)
SELECT 'P' || population AS population, CASE WHEN was IS NULL THEN 'added' WHEN now IS NULL THEN 'removed' ELSE 'redefined' END AS change, was AS baseline_definition, now AS current_definition FROM f WHERE was IS DISTINCT FROM now
""")  # fmt: skip
def _(spark, sf):
    """Definitions from the means of either half of the events: markers far from the middle are in them."""
    e = table(spark, sf, "events").select((F.col("user_id") % 40).alias("p"), F.col("event_type").alias("m"), (F.col("event_id") % 2).alias("half"), "value")
    mean = e.groupBy("p", "m", "half").agg(F.avg("value").alias("x")).filter(F.abs(F.col("x") - 49) > 9)
    halves: tuple[dict, dict] = ({}, {})
    for r in mean.collect():  # at most 40 populations by the event types
        halves[r["half"]].setdefault(f"P{r['p']}", {})[r["m"]] = "above" if r["x"] > 49 else "below"
    rows = conformance.spec_changes(halves[1], conformance.fingerprint(halves[0]))
    return spark.createDataFrame(rows, "population string, change string, baseline_definition string, current_definition string")


