"""Near-duplicate documents by a chosen-path set similarity join over minwise tokens.

1.  Every document becomes its set of word shingles (64-bit hashes), a 128-bit fingerprint of that set
    and minwise tokens: a path of DEPTH tokens for each independent tree, the first TOKENS of which
    serve as a MinHash signature.  Documents of equal sets are one representative.
2.  In each tree, representatives are branched by their first minwise token.  Nodes of more than LIMIT
    members are branched again by the next token of their own path, and so on.  The members of a
    node of at most LIMIT are compared exhaustively by signature; a node that is still larger at the last
    token is taken as a whole.  That leaves candidate links, as a spanning forest of each node.
3.  The candidate links' components are compared on full sets, in blocks of about BLOCK members.  A
    component of one block is compared exhaustively.  A larger one is first compared inside its blocks;
    the least member of each class found so meets those of other blocks, round by round, which joins
    the copies of a large group in linear time.  Then all members of classes that are still apart are
    compared exhaustively, block by block.  Only links that hold on full sets are ever used, as
    spanning forests; their components are the result.

Two documents of similarity s meet in a node of depth d of some tree with probability 1 - (1 - s**d)**trees.
The number of trees follows from the recall wanted at depth DEPTH: for 0.99, 10 trees at a similarity of 0.85
and 16 at 0.8 (over 0.9999 at depth 3 in both).  The signature test passes such a pair with probability over
0.9999.  No step emits the pairs of a group, and no task holds a whole one.

Defined results: texts without words (null, empty, blanks) have n_shingles 0 and are linked with nothing;
rows with a null doc_id aren't linked and are kept, with a null component; repeated rows of one doc_id are
one vertex, and if their texts differ, one of the texts speaks for it; an empty table gives an empty table; other columns of the input don't matter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gatefold.llm.common import MIX1, MIX2, Words, discard, join_hot, mix64, stored, table, text_parts, windows
from gatefold.llm.graph import components

DEPTH, LIMIT, RECALL = 6, 1024, 0.99
TOKENS = 64
#: Members and shingles of a block of a candidate component, whichever it reaches first.
BLOCK, SHINGLES = 128, 1 << 18
HOT_NODES = 4096


def n_trees(percent: int, recall: float = RECALL) -> int:
    """Independent trees by which a pair of that similarity meets at depth DEPTH with the recall."""
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - (percent / 100) ** DEPTH)))


def agreement(percent: int) -> int:
    """Signature positions, of TOKENS, that two sets must share to become candidates: 4 standard deviations below the mean."""
    p = percent / 100
    return max(1, int(TOKENS * p - 4 * math.sqrt(TOKENS * p * (1 - p))))


def shingle_sets(texts: list[bytes], size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text; a text of fewer words is one shingle."""
    w = Words(texts, lower=True)
    h = w.hashes()
    win = windows(h, size)
    out = []
    for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True):
        if b - a >= size:
            out.append(np.unique(win[a : b - size + 1]))
        elif b > a:
            out.append(windows(h[a:b], b - a) ^ np.uint64(b - a))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def minwise(sets: list[np.ndarray], seeds: np.ndarray) -> np.ndarray:
    """tokens[set, k]: the least 64-bit hash of the set's members under seed k."""
    out = np.full((len(sets), len(seeds)), np.uint64(0xFFFFFFFFFFFFFFFF))
    with np.errstate(over="ignore"):
        for r, s in enumerate(sets):
            for c in range(0, len(s), 2048):
                v = (s[c : c + 2048, None] ^ seeds) * MIX1
                v ^= v >> np.uint64(32)
                v *= MIX2
                np.minimum(out[r], v.min(0), out=out[r])
    return out


SKETCH = "doc_id long, n long, f1 long, f2 long, keys array<long>, sig binary, paths binary"


def sketches(docs: DataFrame, shingle: int, trees: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Set size, fingerprint, first token of each tree, signature and 16-bit tokens of all trees' paths."""
    names = [x.split()[0] for x in SKETCH.split(", ")]

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds = mix64(np.arange(1, max(TOKENS, trees * DEPTH) + 1, dtype=np.uint64) * MIX1)
        for b in it:
            for i, j, texts in text_parts(b, 1):
                sets = shingle_sets(texts, shingle)
                with np.errstate(over="ignore"):
                    f1 = np.array([mix64(s).sum(dtype=np.uint64) for s in sets], np.uint64)
                    f2 = np.array([mix64(s ^ MIX2).sum(dtype=np.uint64) for s in sets], np.uint64)
                tok = minwise(sets, seeds)
                keys = (mix64(tok[:, 0 : trees * DEPTH : DEPTH]) + np.arange(trees, dtype=np.uint64) * MIX2).view(np.int64)
                short = (tok >> np.uint64(48)).astype("<u2")
                yield pa.record_batch([
                    b.column(0)[i:j], pa.array([len(s) for s in sets], pa.int64()), pa.array(f1.view(np.int64)), pa.array(f2.view(np.int64)),
                    pa.array(list(keys), pa.list_(pa.int64())), *(pa.array([r.tobytes() for r in x], pa.binary()) for x in (short[:, :TOKENS], short[:, : trees * DEPTH])),
                ], names)

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), text).mapInArrow(run, SKETCH)


def branch(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Branch (key, depth, path, rep, sig) until no node is over LIMIT; also the nodes given up at the last token.

    Each pass branches every node over LIMIT and writes only their members, under new keys; all others
    are done.  The HOT_NODES largest go by broadcast, bounded at any size; if there are more, the surplus
    is joined by shuffle, where no key holds more than 1/HOT_NODES of the rows.
    """
    done, at = None, rows
    for _ in range(1, DEPTH):
        over = stored(at.groupBy("key").agg(F.count(F.lit(1)).alias("m")).filter(F.col("m") > LIMIT), "over")
        n = over.count()
        if not n:
            break
        hot = over if n <= HOT_NODES else stored(over.orderBy(F.desc("m"), "key").limit(HOT_NODES), "hot")
        hot = F.broadcast(hot.select("key"))
        split, rest = at.join(hot, "key"), at.join(hot, "key", "left_anti")
        if n > HOT_NODES:
            surplus = over.join(hot, "key", "left_anti").select("key")
            split, rest = split.unionByName(rest.join(surplus, "key")), rest.join(surplus, "key", "left_anti")
        done = rest if done is None else done.unionByName(rest)
        # two bytes of the path: the next token of this tree
        token = F.substring("path", 1 + 2 * F.col("depth"), F.lit(2))
        at = stored(split.select(F.xxhash64("key", token).alias("key"), (F.col("depth") + 1).alias("depth"), "path", "rep", "sig"), "branch")
    nodes = at if done is None else done.unionByName(at)
    given_up = at.filter(F.col("depth") >= DEPTH).groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.min("rep").alias("lead")).filter(F.col("m") > LIMIT)
    return nodes, given_up


def _forest(adjacent: np.ndarray) -> np.ndarray:
    """Label of every vertex: the least vertex of its component."""
    m = len(adjacent)
    lab = np.arange(m)
    np.fill_diagonal(adjacent, True)
    while True:
        new = np.where(adjacent, lab[None, :], m).min(1)
        new = new[new]
        if (new == lab).all():
            return lab
        lab = new


def compare_nodes(nodes: DataFrame, agree: int) -> DataFrame:
    """(a, b): spanning forests of the signature-similar members of each node."""

    def one(rep: np.ndarray, sig: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        order = np.argsort(rep, kind="stable")
        rep, sig = rep[order], sig[order]
        m = len(rep)
        adj = np.empty((m, m), bool)
        step = max(1, 2_000_000 // (m * TOKENS))
        for i in range(0, m, step):
            adj[i : i + step] = (sig[i : i + step, None, :] == sig[None]).sum(2, dtype=np.uint8) >= agree
        lab = _forest(adj)
        child = np.flatnonzero(lab != np.arange(m))
        if len(child):
            yield rep[child], rep[lab[child]]

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def groups(key: np.ndarray, rep: np.ndarray, sig: np.ndarray) -> Iterator[pa.RecordBatch]:
            at = np.flatnonzero(np.diff(key, prepend=key[0] - 1, append=key[-1] + 1) != 0) if len(key) else np.zeros(1, np.int64)
            size = np.diff(at)
            two = at[:-1][size == 2]
            near = (sig[two] == sig[two + 1]).sum(1) >= agree
            out = [(rep[two][near], rep[two + 1][near])]
            for s, n in zip(at[:-1][size > 2].tolist(), size[size > 2].tolist(), strict=True):
                if n > LIMIT:
                    continue  # given up, see branch()
                out += one(rep[s : s + n], sig[s : s + n])
            a, b = (np.concatenate(x) for x in zip(*out, strict=True))
            if len(a):
                yield pa.record_batch([pa.array(a), pa.array(b)], ["a", "b"])

        for x in it:
            key = x.column(0).to_numpy()
            if not len(key):
                continue
            rep = x.column(1).to_numpy()
            sig = np.frombuffer(b"".join(x.column(2).to_pylist()), "<u2").reshape(-1, TOKENS)
            held.append((key, rep, sig))
            if held[0][0][0] == key[-1]:
                if sum(len(h[0]) for h in held) > 4 * LIMIT:  # inside a node that is given up: its head is enough to tell
                    held = [(k[:LIMIT], r[:LIMIT], s[:LIMIT]) for k, r, s in held[:1]] + [(k[-1:], r[-1:], s[-1:]) for k, r, s in held[1:]] if len(held[0][0]) > LIMIT else held
                continue
            key, rep, sig = (np.concatenate(c) for c in zip(*held, strict=True))
            cut = int(np.searchsorted(key, key[-1]))  # the last node may go on
            yield from groups(key[:cut], rep[:cut], sig[:cut])
            held = [(key[cut:], rep[cut:], sig[cut:])]
        if held:
            yield from groups(*(np.concatenate(c) for c in zip(*held, strict=True)))

    dealt = nodes.select("key", "rep", "sig").repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(run, "a long, b long")


def linked(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, percent: int) -> np.ndarray:
    """adjacent[left, right]: 100 * intersection >= percent * union, on full sets."""
    lens = np.array([len(s) for s in sets], np.int64)
    flat = np.concatenate(sets)
    row = np.repeat(np.arange(len(sets)), lens)
    _, code, count = np.unique(flat, return_inverse=True, return_counts=True)
    shared = count > 1  # a shingle of one set alone meets nothing
    place = np.cumsum(shared) - 1
    use = shared[code]
    row, code = row[use], place[code[use]]
    order = np.argsort(code, kind="stable")
    row, code = row[order], code[order]
    inter = np.zeros((len(left), len(right)), np.float32)
    width = 4096
    for c in range(0, int(code[-1]) + 1 if len(code) else 0, width):
        a, b = np.searchsorted(code, (c, c + width))
        x = np.zeros((len(sets), width), np.float32)
        x[row[a:b], code[a:b] - c] = 1
        inter += x[left] @ x[right].T
    inter = np.rint(inter).astype(np.int64)
    union = lens[left][:, None] + lens[right][None] - inter
    return 100 * inter >= percent * union


def verify_units(units: DataFrame, shingle: int, percent: int) -> DataFrame:
    """(a, b) of links on full sets; units: (comp, i, j, side, rep, text), a unit's rows dealt to one task.

    A unit compares the rows of side i with those of side j, or all with each other where i = j.
    """

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        at = None

        def unit() -> Iterator[pa.RecordBatch]:
            held.sort(key=lambda r: r[0])
            reps = np.array([r[0] for r in held], np.int64)
            side = np.array([r[1] for r in held], np.int64)
            sets: list[np.ndarray] = [r[2] for r in held]
            one = side == at[1]
            left = np.flatnonzero(one)
            right = left if at[1] == at[2] else np.flatnonzero(~one)
            if not len(left) or not len(right) or len(reps) < 2:
                return
            adj = np.zeros((len(reps), len(reps)), bool)
            got = linked(sets, left, right, percent)
            adj[np.ix_(left, right)] = got
            adj[np.ix_(right, left)] |= got.T
            lab = _forest(adj)
            child = np.flatnonzero(lab != np.arange(len(reps)))
            if len(child):
                yield pa.record_batch([pa.array(reps[child]), pa.array(reps[lab[child]])], ["a", "b"])

        for x in it:
            cols = [x.column(k).to_pylist() for k in range(5)]
            for s, e, texts in text_parts(x, 5):
                for k, own in zip(range(s, e), shingle_sets(texts, shingle), strict=True):
                    key = tuple(c[k] for c in cols[:3])
                    if key != at:
                        if held:
                            yield from unit()
                        held, at = [], key
                    held.append((cols[4][k], cols[3][k], own))
        if held:
            yield from unit()

    dealt = units.select("comp", "i", "j", "side", "rep", "text").repartition("comp", "i", "j").sortWithinPartitions("comp", "i", "j")
    return dealt.mapInArrow(run, "a long, b long")


def _alone(rows: DataFrame, block) -> DataFrame:
    """Units of one block each: rows (root, rep, text) are compared inside their block."""
    return rows.select(F.col("root").alias("comp"), block.cast("long").alias("i"), block.cast("long").alias("j"), block.cast("long").alias("side"), "rep", "text")


def blocks(m, shingles):
    """Number of blocks for m members of so many shingles."""
    return F.greatest(F.ceil(m / BLOCK), F.ceil(shingles / SHINGLES), F.lit(1).cast("long"))


def verify_wide(wide: DataFrame, shingle: int, percent: int) -> list[DataFrame]:
    """Tables of links (a, b) in components of several blocks; wide: (root, rep, n, nb, text), a written table.

    First inside blocks, then between the least members of the classes found, as long as that leaves
    clearly fewer of them, then between all members of classes that are still apart.
    """
    names = wide.select("root", "rep", "n")
    found = [stored(verify_units(_alone(wide, F.pmod(F.xxhash64("rep"), F.col("nb"))), shingle, percent), "links")]
    before = None
    while True:
        edges = found[0]
        for x in found[1:]:
            edges = edges.unionByName(x)
        classes = components(edges).withColumnRenamed("v", "rep").withColumnRenamed("root", "class")
        named = stored(names.join(classes, "rep", "left").withColumn("class", F.coalesce("class", "rep")), "classes")
        leads = named.filter("rep = class").groupBy("root").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("t")).filter("k > 1")
        leads = stored(leads.withColumn("lb", blocks(F.col("k"), F.col("t"))), "leads")
        k = leads.agg(F.sum("k")).first()[0] or 0
        if not k:
            return found
        if before is not None and k > 0.7 * before:
            break
        before = k
        meet = join_hot(named.filter("rep = class"), leads, ["root"], "k").select("rep", "lb")
        rows = wide.join(meet, "rep")
        found.append(stored(verify_units(_alone(rows, F.pmod(F.xxhash64("rep", F.lit(len(found))), F.col("lb"))), shingle, percent), "links"))
    # what is left: a block is a part of one large class, or holds whole small classes
    open_ = join_hot(named, leads, ["root"], "k").select("root", "rep", "class", "n")
    size = open_.groupBy("root", "class").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("t")).withColumn("own", blocks(F.col("m"), F.col("t")))
    size = size.withColumn("part", F.when(F.col("own") > 1, F.col("class")))
    rest = size.filter("part is null").groupBy("root").agg(blocks(F.sum("m"), F.sum("t")).alias("shared"))
    size = stored(size.join(rest, "root", "left").withColumn("of", F.when(F.col("part").isNull(), F.col("shared")).otherwise(F.col("own"))), "sizes")
    spread = F.when(F.col("part").isNull(), F.xxhash64("class")).otherwise(F.xxhash64("rep"))
    placed = join_hot(open_, size.select("root", "class", "m", "part", "of"), ["root", "class"], "m").select("root", "rep", "part", F.pmod(spread, F.col("of")).alias("h"))
    placed = stored(placed.withColumn("side", F.xxhash64("root", F.coalesce("part", F.lit(-1)), "h")), "placed")
    side = placed.select("root", "part", "side").distinct()
    other = side.select("root", F.col("part").alias("part2"), F.col("side").alias("side2"))
    pairs = side.join(other, "root").filter("part is null or part2 is null or part <> part2")
    units = placed.select("root", "rep", "side").join(pairs.select("root", "side", "side2"), ["root", "side"])
    units = wide.select("rep", "text").join(units, "rep")
    units = units.select(F.col("root").alias("comp"), F.least("side", "side2").alias("i"), F.greatest("side", "side2").alias("j"), "side", "rep", "text")
    return [*found, stored(verify_units(units, shingle, percent), "links")]


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text", recall: float = RECALL) -> DataFrame:
    """doc_id, n_shingles, component_id and kept (the smallest doc_id of its component, or unlinked)."""
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    sk = stored(sketches(source, shingle, n_trees(percent, recall)), "sketches")
    known = sk.filter("n > 0 and doc_id is not null")
    reps = known.groupBy("f1", "f2").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("w"))
    ids = stored(reps, "reps")
    own = known.join(ids.select("f1", "f2", "rep"), (known["doc_id"] == F.col("rep")) & (known["f1"] == ids["f1"]) & (known["f2"] == ids["f2"])).select("rep", "n", "keys", "sig", "paths").dropDuplicates(["rep"])
    own = own.select("rep", "n", "sig", "paths", F.posexplode("keys").alias("tree", "key"))
    path = F.substring("paths", 1 + 2 * DEPTH * F.col("tree"), F.lit(2 * DEPTH))
    nodes, whole = branch(stored(own.select("key", F.lit(1).alias("depth"), path.alias("path"), "rep", "sig"), "nodes"))
    wide = stored(whole, "whole")
    edges = compare_nodes(nodes, agreement(percent))
    if wide.limit(1).count():
        edges = edges.unionByName(join_hot(nodes.filter(F.col("depth") >= DEPTH).select("key", "rep"), wide, ["key"], "m").select(F.col("rep").alias("a"), F.col("lead").alias("b")))
    cand = components(edges)
    # members of candidate components with their text, and the number of blocks of their component
    members = cand.withColumnRenamed("v", "rep").unionByName(cand.select(F.col("root").alias("rep"), "root").distinct())
    members = stored(members.join(known.groupBy(F.col("doc_id").alias("rep")).agg(F.max("n").alias("n")), "rep"), "candidates")
    size = members.groupBy("root").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("t")).withColumn("nb", blocks(F.col("m"), F.col("t")))
    placed = join_hot(members, size, ["root"], "m").select("root", "rep", "n", "nb")
    # one plan at every size: no broadcast where the members happen to be few
    held = stored(placed.hint("merge").join(source, placed["rep"] == source["doc_id"]).select("root", "rep", "n", "nb", "text"), "members", **{"parquet.block.size": str(16 << 20)})
    links = [stored(verify_units(_alone(held.filter("nb = 1"), F.lit(0)), shingle, percent), "links")]
    if size.filter("nb > 1").limit(1).count():
        links += verify_wide(held.filter("nb > 1"), shingle, percent)
    edges = links[0]
    for x in links[1:]:
        edges = edges.unionByName(x)
    comp = components(edges)
    discard(held, *links)
    labels = ids.join(comp.withColumnRenamed("v", "rep"), "rep", "left").select("f1", "f2", "w", F.coalesce("root", "rep").alias("component_id"))
    linked_docs = join_hot(known.select("doc_id", "n", "f1", "f2"), labels, ["f1", "f2"], "w")
    alone = sk.filter("n = 0 or doc_id is null").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    out = linked_docs.select("doc_id", "n", "component_id").unionByName(alone)
    return out.select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=3, percent=85)
