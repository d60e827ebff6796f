"""Exact line deduplication across documents, with DataFrame functions alone.

Lines are exploded, normalised and hashed; each hash keeps the smallest and largest doc_id that
hold it (partial aggregation, so a line of every document costs one row a task), and a hash held by
at least two documents loses its lines everywhere but in the smallest doc_id.  Only hashes are
shuffled for that; texts move once, to be reassembled by position.

Defined results: null or empty text is one empty line.  Lines whose key is shorter than min_chars
always stay.  Rows with a null doc_id are returned unchanged and don't count as holders.  Repeated
rows (same doc_id) are one document: each gets the same decisions.  An empty table gives an empty
table.  Other columns, whatever their names, pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gatefold.llm.common import hash128, join_hot, lower_ascii, stored, table

BLANKS = " \t\n\x0b\x0c\r"
MIN_CHARS = 10


def line_key(line):
    """Blanks stripped at both ends, A-Z lower-cased."""
    return lower_ascii(F.btrim(line, F.lit(BLANKS)))


def repeated_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """(_id, _th, pos) of every line to drop: position pos of rows with this doc_id and text hash."""
    src = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_t")).filter("_id is not null and _t is not null")
    lines = src.select("_id", F.xxhash64("_t").alias("_th"), F.posexplode(F.split("_t", "\n")).alias("pos", "line"))
    key = lines.select("_id", "_th", "pos", line_key(F.col("line")).alias("key")).filter(F.length("key") >= min_chars)
    a, b = hash128(F.col("key"))
    held = stored(key.select("_id", "_th", "pos", a.alias("h1"), b.alias("h2")), "lines")
    per = held.groupBy("h1", "h2").agg(F.min("_id").alias("keeper"), F.max("_id").alias("other"), F.count(F.lit(1)).alias("w"))
    shared = per.filter("keeper < other").select("h1", "h2", "keeper", "w")
    return join_hot(held, shared, ["h1", "h2"], "w").filter("_id <> keeper").select("_id", "_th", "pos")


def line_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS, stats: bool = False) -> DataFrame:
    """docs with repeated lines removed from text; with stats also n_lines and n_dropped."""
    gone = repeated_lines(docs, doc_id, text, min_chars).groupBy("_id", "_th").agg(F.collect_set("pos").alias("_gone"))
    # the row travels as one struct, so its column names meet no other
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    rows = docs.select(row, F.col(doc_id).alias("_lid"), F.xxhash64(text).alias("_lth"), F.split(F.coalesce(text, F.lit("")), "\n").alias("_lines"))
    both = rows.join(gone, (rows["_lid"] == gone["_id"]) & (rows["_lth"] == gone["_th"]), "left")
    # the lines that stay, by position; array_except hashes, so a long document costs no more than its lines
    keep = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_gone"))
    old = F.col("_row").getField(text)
    new = F.when(F.col("_gone").isNull(), old).otherwise(F.array_join(F.transform(keep, lambda i: F.get(F.col("_lines"), i)), "\n"))
    extra = {"n_lines": F.size("_lines").cast("long"), "n_dropped": F.coalesce(F.size("_gone"), F.lit(0)).cast("long")} if stats else {}
    own = [(new if c == text else F.col("_row").getField(c)).alias(c) for c in docs.columns if c not in extra]
    return both.select(*own, *[v.alias(c) for c, v in extra.items()])


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: n_lines, n_dropped and the hash of what is kept."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = line_dedup(docs, stats=True)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


OP3_SQL = r"""
WITH l AS (
  SELECT doc_id, i AS pos, string_split(coalesce(text, ''), chr(10))[i] AS line
  FROM documents, range(1, len(string_split(coalesce(text, ''), chr(10))) + 1) AS r(i)
), k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
), s AS (
  SELECT key, min(doc_id) AS keeper FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2
), d AS (
  SELECT k.doc_id, k.pos, k.line, s.keeper IS NOT NULL AND s.keeper <> k.doc_id AS gone FROM k LEFT JOIN s USING (key)
)
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(sum(CASE WHEN gone THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM d GROUP BY doc_id
"""
