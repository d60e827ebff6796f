"""Periodic runs of words: every maximal stretch that repeats a short pattern at least EXPONENT times.

A run of period p and length EXPONENT * p or more has word i equal to word i + p for at least (EXPONENT - 1) * p
successive i, so one of them is a multiple of (EXPONENT - 1) * p: the harmonic grid, n log n pairs of a period and a grid point in all.
Pairs whose words differ are dropped at once; for all others together the common extension to the
right and to the left is found by binary search over prefix hashes, which gives the only run
of that period through the point.  Pairs that found the same stretch are one run, whose period is the smallest.
Words of a run are then compared by their bytes; a text in which a hash proved wrong is searched again with exact numbers of words.

Texts come in batches of about 1 MB and pairs in blocks of at most PAIRS, so memory follows the longest text and not its square.

Defined results: null and empty texts and texts of blanks have no words, no runs and an empty collapsed text; rows are
judged one by one, so null ids and repeated rows get their own results; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gatefold.llm.common import Words, prefix_hash, table, text_parts

EXPONENT, MIN_LENGTH = 4, 6
#: Pairs that are extended at a time.
PAIRS = 1 << 21
RUNS = "array<struct<start: long, length: long, period: long>>"


def grid(n: np.ndarray, exponent: int, pairs: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text, period, point) of all pairs with point + period < n, in blocks of about `pairs`."""
    most = n // exponent  # no longer period repeats often enough
    first = np.concatenate(([0], np.cumsum(most)))
    i, total = 0, int(first[-1])
    while i < total:
        j = min(total, i + pairs // 8)
        flat = np.arange(i, j)
        doc = np.searchsorted(first, flat, "right") - 1
        p = flat - first[doc] + 1
        many = (n[doc] - p - 1) // ((exponent - 1) * p) + 1
        upto = np.concatenate(([0], np.cumsum(many)))
        k = max(1, int(np.searchsorted(upto, pairs, "right")) - 1)
        if k < len(flat):  # as many periods as fit
            doc, p, many, upto = doc[:k], p[:k], many[:k], upto[: k + 1]
        step = np.arange(upto[-1]) - np.repeat(upto[:-1], many)
        p = np.repeat(p, many)
        yield np.repeat(doc, many), p, step * (exponent - 1) * p
        i += min(k, j - i)


class Extension:
    """Common extensions of places in an array of numbers, by binary search over its prefix hashes."""

    def __init__(self, words: np.ndarray) -> None:
        self.hash = prefix_hash(words)

    def same(self, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether [a, a + size) and [b, b + size) have one hash, where a < b."""
        from gatefold.llm.common import POWERS

        up, _ = POWERS.get(len(self.hash))
        with np.errstate(over="ignore"):
            return (self.hash[a + size] - self.hash[a]) * up[b - a] == self.hash[b + size] - self.hash[b]

    def reach(self, a: np.ndarray, b: np.ndarray, most: np.ndarray, back: bool = False) -> np.ndarray:
        """How many words match from a and b on (back: before them), at most `most`."""
        lo, hi = np.zeros(len(a), np.int64), most.astype(np.int64)
        open_ = np.flatnonzero(lo < hi)
        while len(open_):
            mid = (lo[open_] + hi[open_] + 1) // 2
            off = mid if back else 0
            ok = self.same(a[open_] - off, b[open_] - off, mid)
            lo[open_[ok]] = mid[ok]
            hi[open_[~ok]] = mid[~ok] - 1
            open_ = open_[lo[open_] < hi[open_]]
        return lo


def periodic_runs(words: np.ndarray, first: np.ndarray, exponent: int = EXPONENT, min_length: int = MIN_LENGTH, pairs: int = PAIRS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, length, period) of all runs, by text, start and period.

    words: numbers of the words of all texts; text i has words[first[i]:first[i + 1]].  Starts count from the text's first word.
    """
    ext = Extension(words)
    n = np.diff(first)
    found = []
    for doc, p, x in grid(n, exponent, pairs):
        at = first[doc] + x
        hit = np.flatnonzero(words[at] == words[at + p])
        doc, p, x, at = doc[hit], p[hit], x[hit], at[hit]
        right = ext.reach(at, at + p, n[doc] - x - p)
        left = ext.reach(at, at + p, x, back=True)
        size = left + right + p
        long = size >= np.maximum(min_length, exponent * p)
        found.append(np.stack([doc[long], (x - left)[long], size[long], p[long]]))
    if not found:
        return (np.zeros(0, np.int64),) * 4
    doc, start, size, p = np.concatenate(found, axis=1)
    order = np.lexsort((p, size, start, doc))
    doc, start, size, p = doc[order], start[order], size[order], p[order]
    new = np.ones(len(doc), bool)  # a stretch of several periods has the smallest
    new[1:] = (np.diff(doc) != 0) | (np.diff(start) != 0) | (np.diff(size) != 0)
    doc, start, size, p = doc[new], start[new], size[new], p[new]
    order = np.lexsort((p, start, doc))
    return doc[order], start[order], size[order], p[order]


def blocks(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each size."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def differing(w: Words, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether words a and b differ in their bytes."""
    size = w.end[a] - w.start[a]
    out = size != w.end[b] - w.start[b]
    same = np.flatnonzero(~out)
    for i in range(0, len(same), 1 << 18):
        k = same[i : i + (1 << 18)]
        odd = w.data[blocks(w.start[a[k]], size[k])] != w.data[blocks(w.start[b[k]], size[k])]
        out[k[np.repeat(np.arange(len(k)), size[k])[odd]]] = True
    return out


def verified_runs(texts: list[bytes], exponent: int = EXPONENT, min_length: int = MIN_LENGTH) -> tuple[Words, tuple]:
    """Words of the texts and their runs, whose words are equal in their bytes."""
    w = Words(texts)
    runs = periodic_runs(w.hashes(), w.first, exponent, min_length)
    doc, start, size, p = runs
    a = blocks(w.first[doc] + start, size - p)
    wrong = differing(w, a, a + np.repeat(p, size - p))
    if wrong.any():  # a hash was wrong: these texts again, word by word
        bad = np.unique(np.repeat(doc, size - p)[wrong])
        parts = [tuple(x[~np.isin(doc, bad)] for x in runs)]
        for d in bad.tolist():
            s = [bytes(w.data[i:j]) for i, j in zip(w.start[w.first[d] : w.first[d + 1]], w.end[w.first[d] : w.first[d + 1]], strict=True)]
            parts.append(exact_runs(s, d, exponent, min_length))
        doc, start, size, p = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.lexsort((p, start, doc))
        runs = doc[order], start[order], size[order], p[order]
    return w, runs


def exact_runs(words: list[bytes], doc: int, exponent: int, min_length: int) -> tuple[np.ndarray, ...]:
    """The runs of one text by comparing words, period by period; for texts whose hashes collide."""
    number = {x: i for i, x in enumerate(dict.fromkeys(words))}
    v = np.array([number[x] for x in words], np.int64)
    best: dict[tuple[int, int], int] = {}
    for p in range(1, len(v) // exponent + 1):
        edge = np.diff((v[:-p] == v[p:]).astype(np.int8), prepend=0, append=0)
        for s, e in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True):
            if e - s + p >= max(min_length, exponent * p):
                best.setdefault((s, e - s + p), p)
    rows = sorted((s, p, size) for (s, size), p in best.items())
    return tuple(np.array(x, np.int64) for x in ([doc] * len(rows), [r[0] for r in rows], [r[2] for r in rows], [r[1] for r in rows]))


def collapsed(w: Words, runs: tuple[np.ndarray, ...]) -> list[bytes]:
    """Each text's words that no run holds after its first period, joined by one space."""
    doc, start, size, p = runs
    cover = np.zeros(len(w.start) + 1, np.int64)
    np.add.at(cover, w.first[doc] + start + p, 1)
    np.subtract.at(cover, w.first[doc] + start + size, 1)
    keep = np.cumsum(cover[:-1]) == 0
    lens = np.where(keep, w.end - w.start + 1, 0)  # with the blank that follows
    flat = w.data[blocks(w.start[keep], lens[keep])].copy()
    ends = np.cumsum(lens)
    flat[ends[keep] - 1] = 32
    at = np.concatenate(([0], ends))[w.first]
    raw = flat.tobytes()
    return [raw[i : max(i, j - 1)] for i, j in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]


def find_runs(docs: DataFrame, text: str | Column = "text", keep: tuple[str, ...] = ("doc_id",), exponent: int = EXPONENT, min_length: int = MIN_LENGTH) -> DataFrame:
    """keep, n_words, runs (by start and period) and the collapsed text of every row."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for i, j, texts in text_parts(b, len(keep)):
                w, runs = verified_runs(texts, exponent, min_length)
                at = np.searchsorted(runs[0], np.arange(w.n + 1)).astype(np.int32)
                items = pa.StructArray.from_arrays([pa.array(x.astype(np.int64)) for x in runs[1:]], names=["start", "length", "period"])
                lists = pa.ListArray.from_arrays(pa.array(at), items)
                kept = pa.array(collapsed(w, runs), pa.binary()).cast(pa.string())
                yield pa.record_batch([*[b.column(k)[i:j] for k in range(len(keep))], pa.array(w.count.astype(np.int64)), lists, kept], [*keep, "n_words", "runs", "collapsed"])

    kinds = dict(docs.dtypes)
    t = F.col(text) if isinstance(text, str) else text
    return docs.select(*[F.col(c) for c in keep], t.alias("_text")).mapInArrow(run, ", ".join([*[f"`{c}` {kinds[c]}" for c in keep], "n_words long", f"runs {RUNS}", "collapsed string"]))


def repeated_tail(doc_id: Column, text: Column) -> Column:
    """The text with the words from a place on made periodic, for one id in ten: place and period follow crc32 of the id."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    words = F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda x: x != "")

    def place(x: Column) -> Column:
        n = F.size(x["w"]).cast("long")
        a = x["g"] % F.greatest(n, F.lit(1))
        return F.struct(x["w"].alias("w"), n.alias("n"), a.alias("a"), (F.floor((n - a) / (3 + x["g"] % 8)) + 1).alias("p"))

    def tail(x: Column) -> Column:
        number = F.transform(F.sequence(F.lit(0).cast("long"), x["n"] - 1), lambda i: F.when(i < x["a"], i).otherwise(x["a"] + (i - x["a"]) % x["p"]).cast("int"))
        return F.array_join(F.transform(number, lambda i: F.get(x["w"], i)), " ")

    # arrays of one bind a value, which would else be worked out again for every word
    bound = F.transform(F.array(F.struct(words.alias("w"), F.floor(h / 10).alias("g"))), place)
    made = F.transform(F.filter(bound, lambda x: x["n"] > 0), tail)
    return F.when(h % 10 == 0, F.coalesce(F.get(made, F.lit(0)), text)).otherwise(text)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's runs, its greatest run and its collapsed text, after one in ten got a repeated tail."""
    docs = table(spark, sf_dir, "documents")
    found = find_runs(docs, repeated_tail(F.col("doc_id"), F.col("text")))
    order = F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p")))
    best = F.when(F.size("runs") > 0, F.array_max(order))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    out = found.withColumns({"best": best, "lines": lines})
    return out.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.s")).alias("start"), F.col("best.length").alias("length"), (-F.col("best.p")).alias("period"),
        F.floor(1000 * F.col("best.length") / -F.col("best.p")).cast("long").alias("exponent_milli"), F.sha2(F.col("lines").cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
