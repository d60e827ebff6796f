"""Removal of long byte strings that occur more than once, by a hash-compared suffix sort.

A string of `length` bytes is repeated if it starts anywhere else in the corpus, in the same or in another
document.  Sorting every suffix of a corpus is out of reach, so suffixes first meet by content:

1.  Each window of `length` bytes owns the leftmost of its least GRAM-byte hashes, its anchor.  Equal
    windows have equal anchors at equal offsets, so only windows of one anchor hash can be equal.
    Neighbouring windows of one anchor are one row: about two rows for each `length` bytes.
2.  Anchor hashes that occur once are dropped.  Rows of equal anchor and equal surroundings (the bytes of all
    windows of the row, by hash) are one class; a class of two rows or more is repeated as a whole.
3.  Where an anchor has several classes, one row of each sends its bytes.  All suffixes that start in
    its windows are sorted: a bottom-up mergesort compares two suffixes by their longest common
    extension, which a binary search over prefix polynomial hashes finds in log2(length) steps.
    Neighbours in that order that share `length` bytes are repeated.  These matches are verified on
    bytes: all of them for the first window of a run of matches, the last byte for each further one.
4.  An anchor of more than CONTEXTS classes (a passage in very many documents) doesn't meet in one task: its
    contexts are cut to windows at neighbouring distances from the anchor, and meet by the bytes that all
    windows of such a block have in common.  Groups that are still larger get narrower blocks, down to
    single windows, which are counted by hash alone.  Nothing is dropped on the way but what is alone.
5.  Windows that are repeated are marked in their documents and cut out.

Hot strings: rows of a class are counted by partial aggregation and joined by join_hot, so copies never
meet in one task.  What rests on hashes alone (two of 64 bits): equality of whole classes and of single
windows of step 4; everything that is sorted is compared on bytes.

Defined results: null or empty text has 0 bytes and nothing removed; texts shorter than length keep all
bytes; repeated rows are repeated texts, so all their windows go; rows of one doc_id with different
texts lose the strings marked in any of them, clipped to their length; null doc_ids share one mark
list likewise; what is kept is bytes and may cut a character in two.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gatefold.llm.common import POWERS, batches, discard, join_hot, mix64, prefix_hash, span_hash, stored, table, text_parts

LENGTH, GRAM = 400, 64
#: Bits of an anchor's place in its buffer; a longer text is worked off in overlapping pieces.
PLACE_BITS = 24
PIECE = 1 << 20
#: Suffixes sorted at once.
SORTED = 400_000
#: Most contexts of one anchor that meet in a task, and widths of the blocks of windows beyond it.
CONTEXTS, WIDTHS = 256, (64, 8, 1)


def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """min(x[i:i + width]) for every i, by prefix and suffix minima of blocks of that width."""
    n = len(x) - width + 1
    padded = np.full(-(-len(x) // width) * width, np.iinfo(x.dtype).max, x.dtype)
    padded[: len(x)] = x
    rows = padded.reshape(-1, width)
    left = np.minimum.accumulate(rows, 1).ravel()
    right = np.minimum.accumulate(rows[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(right[:n], left[width - 1 : width - 1 + n])


def anchors(texts: list[bytes], length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """text, first window, last window, anchor offset from the first window, anchor hash, surroundings hash."""
    pieces, owner, shift = [], [], []
    for k, t in enumerate(texts):
        for s in range(0, max(1, len(t) - length + 1), PIECE):
            if len(t) - s >= length:
                pieces.append(t[s : s + PIECE + length - 1])
                owner.append(k)
                shift.append(s)
    out: list[tuple[np.ndarray, ...]] = []
    for i, j in batches(pieces, PIECE):
        data = np.frombuffer(b"".join(pieces[i:j]), np.uint8)
        sizes = np.array([len(p) for p in pieces[i:j]], np.int64)
        begin = np.cumsum(sizes) - sizes
        p = prefix_hash(data)
        at = np.arange(len(data) - gram + 1)
        h = span_hash(p, at, at + gram)
        packed = (h & np.uint64(((1 << 64) - 1) ^ ((1 << PLACE_BITS) - 1))) | at.astype(np.uint64)
        least = sliding_least(packed, length - gram + 1)
        own = (least & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
        # windows that stay inside their piece
        ok = np.zeros(len(own) + 1, np.int32)
        ok[begin] += 1
        np.subtract.at(ok, np.minimum(begin + sizes - length + 1, len(own)), 1)
        start = np.flatnonzero(np.cumsum(ok[:-1]) > 0)
        a = own[start]
        piece = np.searchsorted(begin, start, "right") - 1
        new = np.flatnonzero((np.diff(a, prepend=-1) != 0) | (np.diff(piece, prepend=-1) != 0))
        last = np.append(new[1:], len(start)) - 1
        s, e, a, piece = start[new], start[last], a[new], piece[new]
        local = s - begin[piece] + np.array(shift[i:j], np.int64)[piece]
        out.append((np.array(owner[i:j], np.int64)[piece], local, local + (e - s), a - s, h[a], mix64(span_hash(p, s, e + length) + (a - s).astype(np.uint64))))
    if not out:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.int64, np.uint64, np.uint64))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def anchor_rows(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """kh, ch, doc_id, s, n (windows) and o (anchor offset)."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for i, j, texts in text_parts(b, 1):
                k, s, e, o, kh, ch = anchors(texts, length, gram)
                ids = b.column(0)[i:j].take(pa.array(k))
                yield pa.record_batch([pa.array(kh.view(np.int64)), pa.array(ch.view(np.int64)), ids, pa.array(s), pa.array((e - s + 1).astype(np.int32)), pa.array(o.astype(np.int32))], ["kh", "ch", "doc_id", "s", "n", "o"])

    return docs.select("doc_id", "text").mapInArrow(run, "kh long, ch long, doc_id long, s long, n int, o int")


# ---------------------------------------------------------------- suffix sort
class Suffixes:
    """Suffixes of a byte buffer, compared by prefix hashes up to `length` bytes."""

    def __init__(self, data: np.ndarray, length: int) -> None:
        self.data, self.length = data, length
        self.p = prefix_hash(data)
        _, self.down = POWERS.get(len(self.p))

    def extension(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Length of the longest common extension of suffixes x and y, by binary search."""
        lo, hi = np.zeros(len(x), np.int64), np.full(len(x), self.length)
        px, py, dx, dy = self.p[x], self.p[y], self.down[x], self.down[y]
        with np.errstate(over="ignore"):
            for _ in range(self.length.bit_length()):
                mid = (lo + hi + 1) >> 1
                same = (self.p[x + mid] - px) * dx == (self.p[y + mid] - py) * dy
                lo, hi = np.where(same, mid, lo), np.where(same, hi, mid - 1)
        return lo

    def less(self, x: np.ndarray, y: np.ndarray, or_equal: np.ndarray) -> np.ndarray:
        """x before y (or equal to it, where asked)."""
        n = self.extension(x, y)
        end = n >= self.length
        k = np.minimum(n, self.length - 1)
        return np.where(end, or_equal, self.data[x + k] < self.data[y + k])

    def sort(self, at: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Suffixes `at`, which stand together by segment, sorted inside each segment.

        first, size: start and length of the segment of every place.  Runs of 1, 2, 4, ... are merged:
        an element's new place is its place in its own run plus its rank in the other run, which
        a binary search over that run finds.
        """
        at = at.copy()
        run, longest = 1, int(size.max(initial=0))
        place = np.arange(len(at))
        while run < longest:
            live = place[size > run]
            t = live - first[live]
            pair = t // (2 * run) * (2 * run)
            is_left = t - pair < run
            end = size[live]
            lo = np.minimum(np.where(is_left, pair + run, pair), end)
            hi = np.where(is_left, np.minimum(pair + 2 * run, end), np.minimum(pair + run, end))
            other, base = lo.copy(), first[live]
            mine = at[live]
            todo = np.flatnonzero(lo < hi)
            while len(todo):
                mid = (lo[todo] + hi[todo]) >> 1
                # elements of the left run go before equal ones of the right run
                before = self.less(at[base[todo] + mid], mine[todo], ~is_left[todo])
                lo[todo] = np.where(before, mid + 1, lo[todo])
                hi[todo] = np.where(before, hi[todo], mid)
                todo = todo[lo[todo] < hi[todo]]
            own = t - pair - np.where(is_left, 0, run)
            target = base + pair + own + (lo - other)
            moved = np.empty(len(live), at.dtype)
            moved[np.searchsorted(live, target)] = mine
            at[live] = moved
            run *= 2
        return at


def repeated_windows(data: np.ndarray, begin: np.ndarray, count: np.ndarray, offset: np.ndarray, group: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Which windows are repeated: a flag for each window of each context, contexts in turn.

    Context k starts at data[begin[k]] and has count[k] windows, at successive bytes; its anchor lies
    offset[k] bytes after the first.  Windows of one group and one distance to the anchor are compared.
    """
    total = int(count.sum())
    k = np.repeat(np.arange(len(begin)), count)
    t = np.arange(total) - np.repeat(np.cumsum(count) - count, count)
    where = begin[k] + t
    order = np.lexsort((offset[k] - t, group[k]))
    g, o = group[k][order], (offset[k] - t)[order]
    new = np.flatnonzero((np.diff(g, prepend=-1) != 0) | (np.diff(o, prepend=-(1 << 40)) != 0))
    size = np.diff(np.append(new, total))
    first, size = np.repeat(new, size), np.repeat(size, size)
    sx = Suffixes(data, length)
    at = sx.sort(where[order], first, size)
    x, y = at[:-1], at[1:]
    near = np.flatnonzero(first[1:] == first[:-1])
    same = near[sx.extension(x[near], y[near]) >= length]
    # verification on bytes: a match that extends the match of the windows before needs its last byte alone
    partner = np.full(len(data) + 1, -1, np.int64)
    partner[y[same]] = x[same]
    a, b = x[same], y[same]
    follows = (b > 0) & (partner[b - 1] == a - 1) & (a > 0)
    good = np.where(follows, data[a + length - 1] == data[b + length - 1], True)
    whole = np.flatnonzero(~follows)
    span = np.arange(length)
    for c in range(0, len(whole), 4096):
        part = whole[c : c + 4096]
        good[part] = (data[a[part, None] + span] == data[b[part, None] + span]).all(1)
    if not good.all():
        raise RuntimeError("hash collision between different windows")
    flag = np.zeros(len(data) + 1, bool)
    flag[a], flag[b] = True, True
    return flag[where]


def sort_contexts(contexts: DataFrame, length: int) -> DataFrame:
    """doc_id, s, n of repeated windows; contexts: kh, doc_id, s, n, o, alone, data, a kh's rows in one task."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def work(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
            kh, ids, s, n, o, alone, blobs = zip(*rows, strict=True)
            sizes = np.array([len(b) for b in blobs], np.int64)
            data = np.frombuffer(b"".join(blobs), np.uint8)
            n = np.array(n, np.int64)
            _, group = np.unique(np.array(kh, np.int64), return_inverse=True)
            flag = repeated_windows(data, np.cumsum(sizes) - sizes, n, np.array(o, np.int64), group, length)
            edge = np.cumsum(n) - n
            step = np.diff(flag.astype(np.int8), prepend=0)
            step[edge] = flag[edge]  # a run ends with its context
            begins = np.flatnonzero(step == 1)
            stop = np.append(~flag, True)
            stop[edge[1:]] |= True
            ends = np.flatnonzero(stop)
            until = ends[np.searchsorted(ends, begins, "right")]
            c = np.searchsorted(edge, begins, "right") - 1
            use = np.array(alone, bool)[c]
            c, begins, until = c[use], begins[use], until[use]
            first = np.array(s, np.int64)[c] + begins - edge[c]
            yield pa.record_batch([pa.array([ids[x] for x in c.tolist()], pa.int64()), pa.array(first), pa.array(until - begins)], ["doc_id", "s", "n"])

        weight = 0
        for b in it:
            for row in zip(*(b.column(i).to_pylist() for i in range(7)), strict=True):
                if weight > SORTED and row[0] != held[-1][0]:
                    yield from work(held)
                    held, weight = [], 0
                held.append(row)
                weight += row[3]
        if held:
            yield from work(held)

    dealt = contexts.select("kh", "doc_id", "s", "n", "o", "alone", "data").repartition("kh").sortWithinPartitions("kh")
    return dealt.mapInArrow(run, "doc_id long, s long, n long")


def narrowed(contexts: DataFrame, width: int, length: int) -> DataFrame:
    """Contexts cut into blocks of windows at `width` neighbouring distances from the anchor.

    The new kh is a hash of the old one, the block and the bytes that all its windows share, so equal windows keep equal kh.
    """
    low, block = F.col("o") - F.col("n") + 1, F.col("block")
    c = contexts.withColumn("block", F.explode(F.sequence(F.floor(low / width).cast("int"), F.floor(F.col("o") / width).cast("int"))))
    far, near = F.least("o", block * width + width - 1), F.greatest(low, block * width)
    common = F.substring("data", F.col("o") - block * width + 1, F.lit(length - width + 1))
    n = (far - near + 1).alias("n")
    skip = F.col("o") - far
    return c.select(F.xxhash64("kh", "block", common).alias("kh"), F.xxhash64(F.lit(7), common).alias("ch"), "doc_id", (F.col("s") + skip).alias("s"), n, far.alias("o"), "alone", F.substring("data", skip + 1, far - near + length).alias("data"))


CONTEXT = ("kh", "ch", "doc_id", "s", "n", "o", "alone", "data")


def by_document(marks: DataFrame) -> DataFrame:
    return marks.groupBy("doc_id").agg(F.collect_list(F.struct("s", "n")).alias("spans"))


def repeated_spans(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """doc_id, spans: windows s .. s + n - 1 of the document are repeated, for each (s, n) of its spans."""
    rows = stored(anchor_rows(docs, length, gram), "anchors")
    often = rows.groupBy("kh").agg(F.count(F.lit(1)).alias("w")).filter("w > 1")
    # kept on the executors' disks: a lost one is computed again from the written anchors
    cand = join_hot(rows, often, ["kh"], "w").drop("w").persist(StorageLevel.DISK_ONLY)
    classes = cand.groupBy("kh", "ch").agg(F.count(F.lit(1)).alias("w"), F.min(F.struct("doc_id", "s", "n", "o")).alias("one"))
    classes = classes.persist(StorageLevel.DISK_ONLY)
    whole = join_hot(cand, classes.filter("w > 1").select("kh", "ch", "w"), ["kh", "ch"], "w").select("doc_id", "s", F.col("n").cast("long").alias("n"))
    done = stored(by_document(whole), "whole")
    several = classes.groupBy("kh").agg(F.count(F.lit(1)).alias("m")).filter("m > 1")
    open_ = join_hot(classes, several, ["kh"], "m").select("kh", "ch", "m", "one.*", (F.col("w") == 1).alias("alone"))
    text = docs.select(F.col("doc_id").alias("_id"), F.encode(F.col("text"), "UTF-8").alias("_b"))
    data = F.substring("_b", (F.col("s") + 1).cast("int"), (F.col("n") + length - 1).cast("int"))
    contexts = open_.join(text, open_["doc_id"].eqNullSafe(text["_id"])).select(*open_.columns, data.alias("data"))
    contexts = stored(contexts.filter(F.length("data") == F.col("n") + length - 1), "contexts", **{"parquet.block.size": str(16 << 20)})
    for x in (cand, classes):
        x.unpersist()
    discard(rows)
    single = None
    sortable, hot = contexts.filter(F.col("m") <= CONTEXTS).select(*CONTEXT), contexts.filter(F.col("m") > CONTEXTS).select(*CONTEXT)
    for width in WIDTHS:
        if not hot.limit(1).count():
            break
        parts = stored(narrowed(hot, width, length), "parts", **{"parquet.block.size": str(16 << 20)})
        key = ["kh", "ch"]
        met = join_hot(parts, parts.groupBy(*key).agg(F.count(F.lit(1)).alias("w")).filter("w > 1"), key, "w")
        if width == 1:
            single = met.filter("alone").select("doc_id", F.col("s").cast("long").alias("s"), F.col("n").cast("long").alias("n"))
            break
        sortable = sortable.unionByName(met.filter(F.col("w") <= CONTEXTS).select(*CONTEXT))
        hot = met.filter(F.col("w") > CONTEXTS).select(*CONTEXT)
    more = sort_contexts(sortable, length)
    more = by_document(more if single is None else more.unionByName(single))
    return done.unionByName(more).groupBy("doc_id").agg(F.flatten(F.collect_list("spans")).alias("spans"))


def cut_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, doc_id: str = "doc_id", text: str = "text", keep: str | None = "bytes") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and what is kept.

    keep: "bytes" gives kept (binary), "text" gives text, without the halves of characters that were cut in two.
    """
    gram = min(gram, length)
    src = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    spans = repeated_spans(src, length, gram).withColumnRenamed("doc_id", "_id")
    both = src.join(spans, src["doc_id"].eqNullSafe(spans["_id"]), "left").select("doc_id", "text", F.col("spans.s").alias("s"), F.col("spans.n").alias("n"))
    fields = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + {None: "", "bytes": ", kept binary", "text": ", text string"}[keep]
    names = [f.split()[0] for f in fields.split(", ")]

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for i, j, texts, b in ((*x, b) for b in it for x in text_parts(b, 1)):
            out = []
            for t, s, n in zip(texts, b.column(2)[i:j].to_pylist(), b.column(3)[i:j].to_pylist(), strict=True):
                gone = runs = 0
                if s:
                    s, n = np.array(s, np.int64), np.array(n, np.int64)
                    order = np.argsort(s, kind="stable")
                    a = np.minimum(s[order], len(t))
                    z = np.maximum.accumulate(np.minimum(s[order] + n[order] + length - 1, len(t)))
                    new = np.flatnonzero(np.append(True, a[1:] > z[:-1]))
                    a, z = a[new].tolist(), z[np.append(new[1:], len(z)) - 1].tolist()
                    runs, gone = len(a), sum(z) - sum(a)
                    t_kept = b"".join(t[u:v] for u, v in zip([0, *z], [*a, len(t)], strict=True))
                else:
                    t_kept = t
                out.append((len(t), gone, runs, hashlib.sha256(t_kept).hexdigest(), t_kept.decode("utf-8", "ignore") if keep == "text" else t_kept))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string() if keep == "text" else pa.binary()][: len(names) - 1]
            yield pa.record_batch([b.column(0)[i:j], *(pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds))], names)

    return both.mapInArrow(run, fields)


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's columns, then the kept text and its length, as documents have them."""
    return cut_repeats(table(spark, sf_dir, "documents"), keep="text").withColumn("n_chars", F.length("text").cast("long"))
