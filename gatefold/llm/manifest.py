"""A Merkle manifest of a table: one tree of leaf digests a group, one tree over the groups, and a proof for every row.

Leaves are put in order by a range partitioning and numbered from the sizes of its runs, so no task holds a group.
The trees are built by events: a task takes the digests of a run of nodes, keeps partial parents with their
indexed children, and fires a parent as soon as it has as many children as the size of its level allows; its digest
is an event one level higher.  What is still partial when a task ends is the frontier, about two nodes a
level and run, and reshuffles by blocks that grow by BAND levels a round until every tree has its root.
Every fired parent leaves a link to each child: the child's siblings.  Proofs are made from the links top down, one
band of levels at a time, so that a block of rows reads its own links and one path from its top to the root.

Defined results: rows are in the order of the key, null first, and rows of one key in the order of their digests;
equal rows are equal leaves at successive places, each with its own proof; a null group is a group of its
own, before the others; a group of one row has its leaf as subroot; an empty table gives an empty manifest.
Columns that aren't asked for, whatever their names, don't matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gatefold.llm.common import discard, stored, table

ARITY = 2
#: Levels of a proof's block and of a round's blocks: ARITY ** BAND leaves.
BAND = 10
#: Partial parents that a task holds at most; beyond it they go to the next round.
PENDING = 1 << 16
LINK, FRONTIER, ROOT = 0, 1, 2
NODE = "kind int, band int, g string, n long, level int, idx long, digest binary, others binary"


def field(c: Column) -> Column:
    """A value as '-' if null, else its bytes in UTF-8, ':' and itself."""
    s = c.cast("string")
    return F.when(s.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))


def leaf_digest(columns: list[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*[field(c) for c in columns]), 256))


def widths(n: int, arity: int = ARITY) -> list[int]:
    """Nodes of every level, from the leaves to the root."""
    out = [n]
    while out[-1] > 1:
        out.append(-(-out[-1] // arity))
    return out


def numbered(leaves: DataFrame, order: list[str]) -> tuple[DataFrame, list[DataFrame]]:
    """leaves (with g) plus n and idx: its group's size and its place there; the tables to discard when they were read."""
    raw = stored(leaves.withColumn("_m", F.monotonically_increasing_id()), "leaves")
    by = [F.col("g"), *[F.col(c).asc_nulls_first() for c in order]]
    # _m deals out rows that are equal in everything else
    spread = raw.repartitionByRange(*by, F.col("_m")).sortWithinPartitions(*by, F.col("_m")).drop("_m")
    ranged = stored(spread.withColumn("_m", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_m", 33)), "ranged")
    discard(raw)
    runs = ranged.groupBy("g", "_part").agg(F.min("_m").alias("_first"), F.count(F.lit(1)).alias("_c"))
    # a run is a group's rows in one partition
    before = Window.partitionBy("g").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumns({"_at": F.coalesce(F.sum("_c").over(before), F.lit(0)), "n": F.sum("_c").over(Window.partitionBy("g"))}).drop("_c")
    out = ranged.join(runs, ["g", "_part"]).withColumn("idx", F.col("_at") + F.col("_m") - F.col("_first"))
    return out.drop("_part", "_m", "_first", "_at"), [ranged]


def climb(arity: int, payload: list[str], schema: pa.Schema):
    """The task of a round: events in, links of fired parents, roots and the frontier out."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels: dict[int, list[int]] = {}
        held: dict[tuple, dict[int, tuple]] = {}
        out: list[tuple] = []
        none = (None,) * len(payload)

        def frontier():
            for (g, level, n, _), kids in held.items():
                out.extend((FRONTIER, 0, g, n, level, i, d, None, *pay) for i, (d, pay) in kids.items())
            held.clear()

        def batch():
            made = pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), schema.types, strict=True)], schema=schema)
            out.clear()
            return made

        for b in it:
            for g, n, level, idx, digest, *pay in zip(*[c.to_pylist() for c in b.columns], strict=True):
                wide = levels.get(n) or levels.setdefault(n, widths(n, arity))
                while True:
                    if level == len(wide) - 1:
                        out.append((ROOT, 0, g, n, level, idx, digest, None, *none))
                        if not level:
                            out.append((LINK, 0, g, n, 0, idx, digest, b"", *pay))
                        break
                    parent = idx // arity
                    kids = held.setdefault((g, level, n, parent), {})
                    kids[idx] = digest, pay
                    if len(kids) < min(arity, wide[level] - parent * arity):
                        break
                    del held[g, level, n, parent]
                    children = sorted(kids.items())
                    for i, (d, p) in children:
                        out.append((LINK, level // BAND, g, n, level, i, d, b"".join(x for j, (x, _) in children if j != i), *p))
                    digest = hashlib.sha256("".join(d.hex() for _, (d, _) in children).encode()).digest()
                    level, idx, pay = level + 1, parent, none
                if len(out) >= 8192:
                    yield batch()
            if len(held) > PENDING:
                frontier()
        frontier()
        if out:
            yield batch()

    return run


@dataclass
class Forest:
    """links: the siblings of every node by kind, group, level and index; roots: (g, n, level, digest); tall: levels of the tallest tree."""

    links: DataFrame
    roots: DataFrame
    tall: int
    tables: list[DataFrame]


def build(leaves: DataFrame, order: list[str], payload: list[str], arity: int = ARITY) -> Forest:
    """Trees of leaves (g, leaf, payload), one a group."""
    from pyspark.sql.pandas.types import to_arrow_schema

    placed, done = numbered(leaves, order)
    kinds = dict(leaves.dtypes)
    schema = ", ".join([NODE, *[f"`{c}` {kinds[c]}" for c in payload]])
    spark = leaves.sparkSession
    run = climb(arity, payload, to_arrow_schema(spark.createDataFrame([], schema).schema))
    event = ["g", "n", "level", "idx", "digest", *payload]
    now = placed.withColumns({"level": F.lit(0), "digest": F.col("leaf")}).select(*event).sortWithinPartitions("g", "idx")
    rounds: list[DataFrame] = []
    tall, span = 0, 0
    while True:
        made = stored(now.mapInArrow(run, schema), "nodes", parts=("kind", "band"))
        rounds.append(made)
        if not span:
            discard(*done)
            most = made.agg(F.max("n")).first()[0]
            tall = len(widths(most or 1, arity)) - 1
        open_ = made.filter(F.col("kind") == FRONTIER)
        if span > tall or not open_.limit(1).count():
            break
        span += BAND
        start = F.col("idx") * F.pow(F.lit(arity), F.col("level")).cast("long")
        block = F.floor(start / F.lit(arity**span)) if span <= tall else F.lit(0)
        now = open_.withColumn("_b", block.cast("long")).withColumn("_s", start).repartition("g", "_b").sortWithinPartitions("g", "_s", "level").select(*event)
    nodes = rounds[0]
    for x in rounds[1:]:
        nodes = nodes.unionByName(x)
    roots = nodes.filter(F.col("kind") == ROOT).select("g", "n", "level", "digest")
    return Forest(nodes.filter(F.col("kind") == LINK), roots, tall, rounds)


PATH = "others array<binary>, at array<int>"


def prove(forest: Forest, tops: DataFrame, payload: list[str], kept: list[str], arity: int = ARITY) -> DataFrame:
    """payload, g, idx, digest, others, at and the columns kept of tops, for every leaf.

    tops: g, level (the height of its tree), others, at (what follows the tree's root) and kept.  others holds the
    siblings of each level joined, at the place of the node among them.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = tops.sparkSession
    types = dict(forest.links.dtypes) | dict(tops.dtypes)
    waiting = None
    for band in range(max(0, forest.tall - 1) // BAND, -1, -1):
        lo, hi = band * BAND, (band + 1) * BAND
        mine = (F.col("level") <= hi) & ((F.col("level") > lo) if band else F.lit(True))
        enter = tops.filter(mine).select("g", F.lit(0).cast("long").alias("b"), "others", "at", *kept)
        waiting = enter if waiting is None else enter.unionByName(waiting.select("g", F.col("idx").alias("b"), "others", "at", *kept))
        pay = [] if band else payload
        links = forest.links.filter(F.col("band") == band).select("g", F.floor(F.col("idx") / F.pow(F.lit(arity), hi - F.col("level")).cast("long")).alias("b"), "n", "level", "idx", "digest", "others", *pay)
        schema = ", ".join(["g string, idx long, digest binary", PATH, *[f"`{c}` {types[c]}" for c in (*kept, *pay)]])
        waiting = links.groupBy("g", "b").cogroup(waiting.groupBy("g", "b")).applyInArrow(walk(lo, arity, pay, kept, to_arrow_schema(spark.createDataFrame([], schema).schema)), schema)
    return waiting


def walk(lo: int, arity: int, payload: list[str], kept: list[str], schema: pa.Schema):
    """The paths of a block's nodes at level lo: their own links, then the path of the block's top."""

    def run(links: pa.Table, top: pa.Table) -> pa.Table:
        if not links.num_rows or not top.num_rows:
            return schema.empty_table()
        level, idx, others = (links.column(c).to_pylist() for c in ("level", "idx", "others"))
        # the leaf of a tree of one row has no siblings on any level
        sibling = dict(zip(zip(level, idx, strict=True), others, strict=True)) if links.column("n")[0].as_py() > 1 else {}
        beyond, beyond_at = top.column("others")[0].as_py(), top.column("at")[0].as_py()
        paths: dict[tuple[int, int], tuple[list, list]] = {}

        def path(level: int, idx: int) -> tuple[list, list]:
            if (level, idx) not in sibling:
                return beyond, beyond_at
            if (got := paths.get((level, idx))) is None:
                more, at = path(level + 1, idx // arity)
                got = paths[level, idx] = [sibling[level, idx], *more], [idx % arity, *at]
            return got

        base = [k for k, x in enumerate(level) if x == lo]
        own = links.take(base)
        found = [path(lo, i) for i in own.column("idx").to_pylist()]
        same = [pa.array([top.column(c)[0].as_py()] * len(base), schema.field(c).type) for c in kept]
        cols = [own.column("g"), own.column("idx"), own.column("digest"), pa.array([p[0] for p in found], schema.field("others").type), pa.array([p[1] for p in found], schema.field("at").type)]
        return pa.table([*cols, *same, *[own.column(c) for c in payload]], schema=schema)

    return run


def manifest(rows: DataFrame, key: str, group: str, leaf: Column, payload: dict[str, Column], arity: int = ARITY) -> DataFrame:
    """payload, leaf, subroot, root (digests) and the proof (others, at) of every row.

    Rows are leaves in the order of key within their group; groups are in the order of their names, null first.
    """
    name = F.concat(F.lit("v"), F.col(group).cast("string"))
    leaves = rows.select(F.coalesce(name, F.lit("")).alias("g"), F.col(key).alias("_key"), leaf.alias("leaf"), *[c.alias(x) for x, c in payload.items()])
    pay = list(payload)
    trees = build(leaves, ["_key", "leaf"], pay, arity)
    groups = trees.roots.select(F.lit("").alias("g"), F.col("g").alias("_name"), F.col("n").alias("_n"), F.col("level").alias("_level"), F.col("digest").alias("leaf"))
    top = build(groups, ["_name"], ["_name", "_n", "_level"], arity)
    start = top.roots.select("g", "level", F.array().cast("array<binary>").alias("others"), F.array().cast("array<int>").alias("at"), F.col("digest").alias("root"))
    tops = prove(top, start, ["_name", "_n", "_level"], ["root"], arity)
    tops = stored(tops.select(F.col("_name").alias("g"), F.col("_level").alias("level"), "others", "at", F.col("digest").alias("subroot"), "root"), "tops")
    discard(*top.tables)
    return prove(trees, tops, pay, ["subroot", "root"], arity).select(*pay, F.col("digest").alias("leaf"), "subroot", "root", "others", "at")


def hexed(c: Column) -> Column:
    return F.lower(F.hex(c))


def folded(leaf: Column, others: Column, at: Column) -> Column:
    """The root (hex) that a leaf and its proof lead to."""

    def parent(own: Column, step: Column) -> Column:
        rest, before = hexed(step["others"]), step["at"] * 64
        return F.sha2(F.concat(F.substr(rest, F.lit(1), before), own, F.substr(rest, before + 1)), 256)

    return F.aggregate(F.arrays_zip(others.alias("others"), at.alias("at")), hexed(leaf), parent)


def proof_digest(others: Column) -> Column:
    return F.sha2(F.array_join(F.transform(others, hexed), ""), 256)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf, roots, proof and the root that its proof gives after one row in seven was altered."""
    docs = table(spark, sf_dir, "documents")
    own = {c: F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")}
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    altered = F.when(hit, leaf_digest(list((own | {"n_chars": F.col("n_chars") + 1}).values())))
    m = manifest(docs, "doc_id", "lang", leaf_digest(list(own.values())), {"doc_id": F.col("doc_id"), "altered": altered})
    m = m.withColumn("folded_root", folded(F.coalesce("altered", "leaf"), F.col("others"), F.col("at")))
    root = hexed(F.col("root"))
    return m.select("doc_id", hexed(F.col("leaf")).alias("leaf"), hexed(F.col("subroot")).alias("subroot"), root.alias("root"), proof_digest(F.col("others")).alias("proof_sha256"), "folded_root", (F.col("folded_root") == root).alias("verified"))


def _field(c: str) -> str:
    return f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR) END"


def _leaf(n_chars: str) -> str:
    return f"sha256({' || '.join(map(_field, ('doc_id', 'source', 'lang', n_chars, 'text')))})"


#: One recursion climbs the trees of all languages, one that of the languages; crc32 by the table method, as in op9.
OP11_SQL = f"""
WITH RECURSIVE tab AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(CAST(n AS BIGINT), range(8)),
           lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
), d AS (
  SELECT *, coalesce('v' || lang, '') AS g, {_leaf('n_chars')} AS leaf,
         xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
             lambda c, x: xor(c >> 8, t[xor(c & 255, x) + 1])), 4294967295) AS crc
  FROM documents, tab
), l AS (
  SELECT doc_id, g, leaf, CASE WHEN crc % 7 = 0 THEN {_leaf('(n_chars + 1)')} ELSE leaf END AS used,
         row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY g) AS n
  FROM d
), nodes AS (
  SELECT g, 0 AS level, idx, n, leaf AS digest FROM l
  UNION ALL
  SELECT g, level + 1, idx // 2, (any_value(n) + 1) // 2, sha256(string_agg(digest, '' ORDER BY idx)) FROM nodes WHERE n > 1 GROUP BY g, level, idx // 2
), subs AS (
  SELECT g, digest AS subroot, row_number() OVER (ORDER BY encode(g)) - 1 AS rank, count(*) OVER () AS n FROM nodes WHERE n = 1
), upper AS (
  SELECT 0 AS level, rank AS idx, n, subroot AS digest FROM subs
  UNION ALL
  SELECT level + 1, idx // 2, (any_value(n) + 1) // 2, sha256(string_agg(digest, '' ORDER BY idx)) FROM upper WHERE n > 1 GROUP BY level, idx // 2
), steps AS (
  SELECT l.doc_id, l.leaf, l.g, l.idx, a.level, a.idx % 2 AS right_, b.digest AS other
  FROM l JOIN nodes a ON a.g = l.g AND a.n > 1 AND a.idx = l.idx >> a.level LEFT JOIN nodes b ON b.g = a.g AND b.level = a.level AND b.idx = xor(a.idx, 1)
  UNION ALL
  SELECT l.doc_id, l.leaf, l.g, l.idx, 1000 + a.level, a.idx % 2, b.digest
  FROM l JOIN subs USING (g) JOIN upper a ON a.n > 1 AND a.idx = subs.rank >> a.level LEFT JOIN upper b ON b.level = a.level AND b.idx = xor(a.idx, 1)
), paths AS (
  SELECT g, idx, list({{'r': right_, 'o': coalesce(other, '')}} ORDER BY level) AS p, sha256(string_agg(coalesce(other, ''), '' ORDER BY level)) AS proof FROM steps GROUP BY g, idx
), folds AS (
  SELECT l.g, l.idx, used AS h, coalesce(p, []) AS p, 1 AS k, coalesce(proof, sha256('')) AS proof FROM l LEFT JOIN paths USING (g, idx)
  UNION ALL
  SELECT g, idx, sha256(CASE WHEN p[k].r = 1 THEN p[k].o || h ELSE h || p[k].o END), p, k + 1, proof FROM folds WHERE k <= len(p)
)
SELECT l.doc_id, l.leaf, subroot, u.digest AS root, f.proof AS proof_sha256, f.h AS folded_root, f.h = u.digest AS verified
FROM l JOIN subs USING (g) JOIN folds f USING (g, idx) CROSS JOIN (SELECT digest FROM upper WHERE n = 1) u WHERE f.k = len(f.p) + 1
"""
