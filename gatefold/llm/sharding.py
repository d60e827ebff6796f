"""Weighted rendezvous hashing of stable record keys, with DataFrame functions alone.

Every (key, shard) pair gets a pseudo-random number u in (0, 1); the record goes to the shard with the
largest weight / -ln(u).  The shard depends on nothing but the key and the shard list: one more
shard takes rows only into itself, and a shard that goes gives its rows to the others in proportion.

Slots are gapless positions in a shard.  They are numbered in two levels, so that no task ever
holds a shard: rows of a shard fall into buckets by a hash of the key, bucket sizes are summed into
offsets (a table of shards x buckets), and rows are numbered inside their bucket.

Defined results: a null key is the key 'null'; equal keys go to the same shard and take successive
slots (ties ordered by size and checksum); null text has size 1 and checksum 0.

Limit: rows of one key are numbered in one task, so keys must be nearly unique, as record keys are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gatefold.llm.common import table

#: Rows of one numbering bucket, on average.
BUCKET_ROWS = 20_000


def unit_hash(key: Column, salt: str) -> Column:
    """A number in (0, 1) from the first 52 bits of md5(key|salt); the same in any SQL engine."""
    h = F.conv(F.substring(F.md5(F.concat(key, F.lit(f"|{salt}")).cast("binary")), 1, 13), 16, 10).cast("double")
    return (h + F.lit(0.5)) / F.lit(float(1 << 52))


def rendezvous(key: Column, weights: dict[int, float]) -> Column:
    """The shard of a key; ties (never seen) go to the smallest shard number."""
    if not weights or any(w <= 0 for w in weights.values()):
        raise ValueError("shards need positive weights")
    k = F.coalesce(key.cast("string"), F.lit("null"))
    scored = [F.struct((F.lit(float(w)) / -F.log(unit_hash(k, f"shard{s}"))).alias("v"), F.lit(-s).alias("s")) for s, w in sorted(weights.items())]
    best = F.greatest(*scored) if len(scored) > 1 else scored[0]
    return (-best["s"]).cast("int")


def with_slots(rows: DataFrame, shard: str, key: str, ties: list[str], bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """rows with slot: 0, 1, ... in each shard, in the order of (bucket, key, ties)."""
    total = rows.agg(F.count(F.lit(1)).alias("_n"))
    n_buckets = total.select((F.floor(F.col("_n") / bucket_rows) + 1).alias("_nb"))
    code = F.conv(F.substring(F.md5(F.concat(F.coalesce(F.col(key).cast("string"), F.lit("null")), F.lit("|slot")).cast("binary")), 1, 12), 16, 10).cast("long")
    # one row: the number of buckets
    placed = rows.join(F.broadcast(n_buckets)).withColumn("_b", F.pmod(code, F.col("_nb")).cast("long")).drop("_nb")
    sizes = placed.groupBy(shard, "_b").agg(F.count(F.lit(1)).alias("_c"))
    before = Window.partitionBy(shard).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(shard, "_b", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_o"))
    inside = Window.partitionBy(shard, "_b").orderBy(F.col(key).asc_nulls_first(), *ties)
    numbered = placed.withColumn("_r", F.row_number().over(inside) - 1)
    return numbered.join(offsets, [shard, "_b"]).withColumn("slot", (F.col("_r") + F.col("_o")).cast("long")).drop("_r", "_o", "_b")


def shard_documents(docs: DataFrame, n_shards: int = 8, weights: dict[int, float] | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard (with one more shard of mean weight)."""
    w = weights or {s: 1.0 for s in range(n_shards)}
    grown = w | {max(w) + 1: sum(w.values()) / len(w)}
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"), rendezvous(F.col(doc_id), w).alias("shard"), rendezvous(F.col(doc_id), grown).alias("grown_shard"),
    )
    out = with_slots(rows, "shard", "doc_id", ["size", "text_crc32"])
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def write_shards(docs: DataFrame, path: str, n_shards: int = 8, weights: dict[int, float] | None = None, doc_id: str = "doc_id", files_per_shard: int = 1) -> None:
    """Write docs as one folder a shard; files_per_shard spreads a large shard over tasks."""
    w = weights or {s: 1.0 for s in range(n_shards)}
    sharded = docs.withColumn("shard", rendezvous(F.col(doc_id), w))
    spread = F.pmod(F.xxhash64(doc_id), F.lit(files_per_shard))
    sharded.repartition(len(w) * files_per_shard, "shard", spread).write.partitionBy("shard").parquet(path)


def op9_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))


def _best(n: int) -> str:
    """SQL of the shard with the greatest score among n equal ones."""
    u = "((CAST(('0x' || substr(md5(k || '|shard{s}'), 1, 13)) AS BIGINT)) + 0.5) / 4503599627370496.0"
    scores = ", ".join(f"(1.0 / -ln({u.format(s=s)}))" for s in range(n))
    return f"list_position([{scores}], list_max([{scores}])) - 1"


#: crc32 by the table method: 256 entries from the reflected polynomial 0xEDB88320, then one fold over the bytes.
OP9_SQL = f"""
WITH tab AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(CAST(n AS BIGINT), range(8)),
           lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
), d AS (
  SELECT doc_id, CAST(doc_id AS VARCHAR) AS k, octet_length(encode(coalesce(text, ''))) AS n, hex(encode(coalesce(text, ''))) AS hx FROM documents
), b AS (
  SELECT doc_id, k, n, list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(1, n + 1), lambda i: CAST(('0x' || hx[2 * i - 1 : 2 * i]) AS BIGINT))) AS bytes FROM d
), c AS (
  SELECT doc_id, k, n + 1 AS size,
         xor(list_reduce(bytes, lambda c, x: xor(c >> 8, t[xor(c & 255, x) + 1])), 4294967295) AS text_crc32
  FROM b, tab
), s AS (
  SELECT *, CAST({_best(8)} AS INTEGER) AS shard, CAST({_best(9)} AS INTEGER) AS grown_shard,
         CAST(('0x' || substr(md5(k || '|slot'), 1, 12)) AS BIGINT) % (SELECT count(*) // {BUCKET_ROWS} + 1 FROM documents) AS b
  FROM c
)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'key' AS law, shard,
       CAST(row_number() OVER (PARTITION BY shard ORDER BY b, doc_id, size, text_crc32) - 1 AS BIGINT) AS slot, grown_shard
FROM s
"""
