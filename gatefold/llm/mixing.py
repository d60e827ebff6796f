"""Mixing to target weights by iterative proportional fitting, with DataFrame functions alone.

Tokens are summed by cell (source, language, topic).  The cell table, not the corpus, is raked: each
step scales one marginal to its target share, in turn, for a fixed number of sweeps; what a marginal
still misses by then is in the residual column.  All steps run in one task over the cell table without a
shuffle between them, and the fitted cells are a written table.  A document's probability is its
cell's fitted weight over the cell's tokens, scaled so that the largest is 1 (no document is ever
repeated) and compared with a number hashed from its doc_id, so the sample doesn't depend on
partitioning.

Targets: {dimension: {value: share}}; values not named split the rest of the share in proportion to
their tokens.  Without targets for a dimension its shares are tempered, tokens ** alpha.

Defined results: null source, language or topic is a value of its own; documents without words
(null, empty) carry no tokens and are kept; equal rows get equal decisions; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gatefold.llm.common import HOT_KEYS, join_hot, stored, table
from gatefold.llm.sharding import unit_hash

DIMS, ALPHA, SWEEPS, SEED = ("source", "lang", "topic"), 0.9, 12, "mix1"


def form_topic(text: str = "text") -> Column:
    """Topic stand-in where no topic column exists: the form of the text."""
    t = F.coalesce(F.col(text), F.lit(""))
    return (
        F.when(F.contains(t, F.lit("|")), "table").when(F.contains(t, F.lit("@")) | F.contains(t, F.lit("http")), "contact")
        .when(F.length(t) >= 4000, "long").when(F.contains(t, F.lit("\n")), "paragraphs").otherwise("short")
    )


def n_words(text: str = "text") -> Column:
    return F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def _target(dim: str, given: dict[str, float] | None, alpha: float) -> Column:
    """Target share of this row's value of dim; _m: tokens of the value, _rest: tokens of all unnamed values."""
    one = Window.partitionBy(F.lit(1))
    if not given:
        # every value counts once: its first cell carries the tempered weight
        return F.pow("_m", F.lit(alpha)) / F.greatest(F.sum(F.when(F.col("_first") == 1, F.pow("_m", F.lit(alpha))).otherwise(0.0)).over(one), F.lit(1.0))
    named = F.col(dim).isin(*given)
    share = F.coalesce(*[F.when(F.col(dim) == v, F.lit(float(s))) for v, s in given.items()], F.lit(0.0))
    rest = F.sum(F.when(named, 0.0).otherwise(F.col("_t"))).over(one)
    return F.when(named, share).otherwise(F.lit(max(0.0, 1 - sum(given.values()))) * F.col("_m") / F.greatest(rest, F.lit(1.0)))


def rake(cells: DataFrame, dims=DIMS, targets: dict[str, dict[str, float]] | None = None, alpha: float = ALPHA, sweeps: int = SWEEPS) -> DataFrame:
    """cells (dims, tokens, docs) with p: the sampling probability of the cell's documents; residual: the largest gap of a marginal share to its target."""
    t = cells.coalesce(1).withColumn("_t", F.col("tokens").cast("double"))
    for d in dims:
        by = Window.partitionBy(d)
        order = Window.partitionBy(d).orderBy(*[c for c in dims if c != d])
        t = t.withColumn("_m", F.sum("_t").over(by)).withColumn("_first", F.row_number().over(order))
        t = t.withColumn(f"_target_{d}", _target(d, (targets or {}).get(d), alpha)).drop("_m", "_first")
    t = t.withColumn("_w", F.col("_t") / F.greatest(F.sum("_t").over(Window.partitionBy(F.lit(1))), F.lit(1.0)))
    for _ in range(sweeps):
        for d in dims:
            now = F.sum("_w").over(Window.partitionBy(d))
            t = t.withColumn("_w", F.when(now > 0, F.col("_w") * F.col(f"_target_{d}") / now).otherwise(0.0))
    gap = F.greatest(*[F.abs(F.sum("_w").over(Window.partitionBy(d)) - F.col(f"_target_{d}")) for d in dims], F.lit(0.0))
    t = t.withColumn("_gap", gap)
    t = t.withColumn("residual", F.max(F.when(F.col("_t") > 0, F.col("_gap")).otherwise(0.0)).over(Window.partitionBy(F.lit(1))))
    ratio = F.when(F.col("_t") > 0, F.col("_w") / F.col("_t"))
    # documents without tokens weigh nothing and stay
    t = t.withColumn("p", F.coalesce(F.try_divide(ratio, F.max(ratio).over(Window.partitionBy(F.lit(1)))), F.lit(1.0)))
    return t.select(*dims, "tokens", "docs", "p", "residual")


def _key(dims) -> Column:
    """One string for a cell; the length before each value keeps cells apart, null has none."""
    return F.concat_ws("|", *[F.coalesce(F.concat(F.length(d).cast("string"), F.lit(":"), F.col(d)), F.lit("-")) for d in dims])


def mix(docs: DataFrame, dims=DIMS, targets=None, alpha: float = ALPHA, sweeps: int = SWEEPS, seed: str = SEED, doc_id: str = "doc_id", text: str = "text", topic: Column | None = None) -> DataFrame:
    """docs with topic, n_tokens, p and kept; columns of these names are replaced."""
    return _mixed(docs, dims, targets, alpha, sweeps, seed, doc_id, text, topic, True)


def mixed_sample(docs: DataFrame, dims=DIMS, targets=None, alpha: float = ALPHA, sweeps: int = SWEEPS, seed: str = SEED, doc_id: str = "doc_id", text: str = "text", topic: Column | None = None) -> DataFrame:
    """The rows and columns of docs that the sample keeps."""
    return _mixed(docs, dims, targets, alpha, sweeps, seed, doc_id, text, topic, False)


def _mixed(docs, dims, targets, alpha, sweeps, seed, doc_id, text, topic, report) -> DataFrame:
    # the row travels as one struct, so its column names meet no other
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    names = {d: (topic if topic is not None else form_topic(text)) if d == "topic" else F.col(f"`{d}`") for d in dims}
    rows = docs.select(row, F.col(doc_id).alias("_did"), n_words(text).alias("n_tokens"), *[v.alias(d) for d, v in names.items()]).withColumn("_cell", _key(dims))
    cells = rows.groupBy(*dims).agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("docs"))
    fitted = stored(rake(cells, dims, targets, alpha, sweeps).withColumn("_cell", _key(dims)).select("_cell", F.col("docs").alias("_docs"), "p"), "cells")
    u = unit_hash(F.coalesce(F.col("_did").cast("string"), F.lit("null")), seed)
    # a cell table of more keys than a broadcast may have is joined by shuffle, but for its heaviest cells
    met = rows.join(F.broadcast(fitted), "_cell") if fitted.count() <= HOT_KEYS else join_hot(rows, fitted, ["_cell"], "_docs")
    out = met.withColumn("kept", u < F.col("p"))
    extra = {c: F.col(c) for c in ("topic", "n_tokens", "p", "kept")} if report else {}
    own = [F.col("_row").getField(c).alias(c) for c in docs.columns if c not in extra]
    return (out if report else out.filter("kept")).select(*own, *extra.values())


def op10_mix_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its cell, tokens, sampling probability and whether the sample has it."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return mix(docs).select("doc_id", "source", "lang", "topic", "n_tokens", F.round("p", 9).alias("p"), "kept")


def _sql() -> str:
    """The same in SQL: one query per raking step."""
    out = r"""
WITH d AS (
  SELECT doc_id, source, lang, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS n_tokens,
         CASE WHEN contains(coalesce(text, ''), '|') THEN 'table'
              WHEN contains(coalesce(text, ''), '@') OR contains(coalesce(text, ''), 'http') THEN 'contact'
              WHEN length(coalesce(text, '')) >= 4000 THEN 'long'
              WHEN contains(coalesce(text, ''), chr(10)) THEN 'paragraphs' ELSE 'short' END AS topic
  FROM documents
), c AS (SELECT source, lang, topic, CAST(sum(n_tokens) AS DOUBLE) AS t FROM d GROUP BY ALL HAVING sum(n_tokens) > 0),
"""
    for x in DIMS:
        out += f"m_{x} AS (SELECT {x}, pow(sum(t), {ALPHA}) AS v FROM c GROUP BY {x}), g_{x} AS (SELECT {x}, v / sum(v) OVER () AS g FROM m_{x}),\n"
    out += "w0 AS (SELECT source, lang, topic, t, t / sum(t) OVER () AS w FROM c),\n"
    k = 0
    for _ in range(SWEEPS):
        for x in DIMS:
            out += f"w{k + 1} AS MATERIALIZED (SELECT a.source, a.lang, a.topic, t, w * g / sum(w) OVER (PARTITION BY a.{x}) AS w FROM w{k} a JOIN g_{x} b ON a.{x} IS NOT DISTINCT FROM b.{x}),\n"
            k += 1
    out += f"""f AS (SELECT source, lang, topic, (w / t) / max(w / t) OVER () AS p FROM w{k})
SELECT doc_id, d.source, d.lang, d.topic, CAST(n_tokens AS BIGINT) AS n_tokens, round(coalesce(p, 1.0), 9) AS p,
       (CAST(('0x' || substr(md5(doc_id || '|{SEED}'), 1, 13)) AS BIGINT) + 0.5) / 4503599627370496.0 < coalesce(p, 1.0) AS kept
FROM d LEFT JOIN f ON d.source IS NOT DISTINCT FROM f.source AND d.lang IS NOT DISTINCT FROM f.lang AND d.topic IS NOT DISTINCT FROM f.topic
"""
    return out


OP10_SQL = _sql()
