"""Quality rules: base counts of every text and a band of n-gram perplexity for each language.

The language model is a character model: texts become strings of 32 symbol classes (letters without case, capitals,
digits, marks, symbols, blanks; bytes of other characters share the letters' classes), of which Spark counts all ORDER-grams
of the documents that may teach: at least MIN_WORDS words, at most one symbol character for ten words, at most
CAPITALS of the letters capitals.  Every language starts from the counts of all languages together, scaled
to PRIOR symbols, so a language of few documents is mostly the pooled model and a large one its own, without a switch.
Interpolated modified Kneser-Ney smoothing turns the counts into sorted arrays of n-gram codes with log
probabilities, and of contexts with back-off weights, one task a language.  32 ** ORDER = 2**25 codes bound a language's
arrays at any corpus size, language codes are two letters, and models are broadcast in groups of languages of
at most GROUP_BYTES, each group scoring its own documents.

A document's perplexity is that of its symbols, whichever documents taught.  It is rejected if its base counts fail, or if its mean
surprise lies outside its language's band: LOW standard errors below and HIGH above the median of all documents that pass
the base rules.  The mean of n symbols scatters with a / sqrt(n), with a robust estimate of a for each language, and by FLOOR of the
median from text to text; median and a are shrunk towards those of all documents by SHRINK documents.

Defined results: null or empty text has no words and fails; null and odd languages are one language, 'xx'; bands of
few documents are wider, by 10 / documents; repeated rows are counted each time and judged alike; an empty table gives an
empty table; other columns don't matter.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gatefold.llm.common import MIX2, SPACE, Words, discard, mix64, prefix_hash, span_hash, stored, table, text_parts, windows

ORDER, BITS = 5, 5
#: Standard errors below and above the median, and a text's own scatter as a share of the median.
LOW, HIGH, FLOOR = 4.0, 4.0, 0.01
#: Symbols of the pooled model that every language starts from; documents by which its band is shrunk towards the pooled one.
PRIOR, SHRINK = 1 << 17, 10
#: Bins for one unit of mean surprise, which are as many at any size: values beyond MOST count as MOST, which no quartile comes near.
BIN, MOST = 200, 64.0
#: Of documents that teach: words for one symbol character, share of capitals among letters.
SYMBOL_WORDS, CAPITALS = 10, 0.3
GROUP_BYTES = 256 << 20
MIN_WORDS, REPEAT_PERCENT, WINDOW = 10, 20, 5
#: Characters that count as symbols (fixed values).
SYMBOLS = "#*$%&|<>"


def symbol_classes() -> np.ndarray:
    """Class of each byte: 0 boundary, 1 blank, letters, digit, mark, symbol, capital; other characters by their trailing bytes, among the letters."""
    c = np.full(256, 31, np.uint8)
    c[0] = 0
    c[[32, 9, 10, 11, 12, 13]] = 1
    c[97:123] = 2 + np.arange(26)
    c[48:58] = 28
    c[[ord(m) for m in ".,;:!?'\"-()"]] = 29
    c[[ord(m) for m in SYMBOLS]] = 30
    c[128:192] = 2 + np.arange(64) % 26
    return c


CLASS = symbol_classes()
SYMBOL_BYTE = np.isin(np.arange(256), np.frombuffer(SYMBOLS.encode(), np.uint8))
GAP = b"\0" * (ORDER - 1)


def language(lang):
    """Two small letters, or 'xx'."""
    low = F.lower(F.coalesce(lang, F.lit("")))
    return F.when(low.rlike("^[a-z]{2}$"), low).otherwise("xx")


def teaching(texts: list[bytes]) -> np.ndarray:
    """Whether each text may teach the model."""
    raw = np.frombuffer(b" " + b" ".join(texts) + b" ", np.uint8)
    edge = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))
    count = lambda x: np.add.reduceat(x, edge[:-1], dtype=np.int64) if len(texts) else np.zeros(0, np.int64)
    gap = SPACE[raw]
    words = count(np.concatenate((gap[:-1] & ~gap[1:], [False])))
    capitals, small = count((raw >= 65) & (raw <= 90)), count((raw >= 97) & (raw <= 122))
    return (words >= MIN_WORDS) & (SYMBOL_WORDS * count(SYMBOL_BYTE[raw]) <= words) & (capitals <= CAPITALS * (capitals + small))


def codes_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the ORDER-grams that end in each symbol of each text, and where each text's codes start."""
    raw = np.frombuffer(GAP + GAP.join(texts) + GAP, np.uint8)
    sizes = np.array([len(t) for t in texts], np.int64)
    begin = np.cumsum(sizes + len(GAP)) - sizes
    keep = raw < 0xC0  # a lead byte tells less than its trailing bytes
    sym = CLASS[raw[keep]].astype(np.int32)
    code = sym[: len(sym) - ORDER + 1].copy()
    for k in range(1, ORDER):
        code <<= BITS
        code |= sym[k : len(sym) - ORDER + 1 + k]
    # of a code that ends at symbol i, the place is i - (ORDER - 1)
    before = np.concatenate(([0], np.cumsum(keep)))
    first = before[begin] - (ORDER - 1)
    last = before[begin + sizes] - (ORDER - 1)
    lens = last - first
    inside = np.zeros(len(code) + 1, np.int32)
    some = lens > 0
    inside[first[some]] += 1
    np.subtract.at(inside, last[some], 1)
    return code[np.cumsum(inside[:-1]) > 0], np.concatenate(([0], np.cumsum(lens)))


def count_ngrams(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, code, n) over all documents that may teach."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

        def merged(parts):
            code = np.concatenate([p[0] for p in parts])
            n = np.concatenate([p[1] for p in parts])
            order = np.argsort(code, kind="stable")
            code, n = code[order], n[order]
            at = np.flatnonzero(np.diff(code, prepend=-1))
            return code[at], np.add.reduceat(n, at) if len(at) else n

        for b in it:
            for i, j, texts in text_parts(b, 1, 2 << 20):
                langs, teach = np.array(b.column(0)[i:j].to_pylist(), str), teaching(texts)
                for x in np.unique(langs[teach]).tolist():
                    code, _ = codes_of([texts[k] for k in np.flatnonzero(teach & (langs == x))])
                    parts = held.setdefault(x, [])
                    parts.append(np.unique(code, return_counts=True))
                    if len(parts) >= 16:
                        held[x] = [merged(parts)]
        for x, parts in held.items():
            code, n = merged(parts)
            for s in range(0, len(code), 100_000):
                part = code[s : s + 100_000]
                yield pa.record_batch([pa.repeat(pa.scalar(x), len(part)), pa.array(part, pa.int32()), pa.array(n[s : s + 100_000], pa.int64())], ["lang", "code", "n"])

    found = docs.select(language(F.col(lang)).alias("lang"), text).mapInArrow(run, "lang string, code int, n long")
    return found.groupBy("lang", "code").agg(F.sum("n").alias("n"))


def with_prior(counts: DataFrame, names: list[str], prior: int = PRIOR) -> DataFrame:
    """counts of every language plus those of all languages, scaled to `prior` symbols at most and rounded."""
    total = counts.agg(F.sum("n")).first()[0] or 0
    share = min(1.0, prior / max(total, 1))
    pooled = counts.groupBy("code").agg(F.floor(F.sum("n") * share + 0.5).alias("n")).filter("n > 0")
    every = pooled.select(F.explode(F.array(*[F.lit(x) for x in names])).alias("lang"), "code", "n")
    return counts.unionByName(every).groupBy("lang", "code").agg(F.sum("n").alias("n"))


# ---------------------------------------------------------------- model
@dataclass
class Level:
    """One order of a model, in sorted arrays: n-gram codes with log p, context codes with log back-off weight."""

    codes: np.ndarray
    logp: np.ndarray
    contexts: np.ndarray
    backoff: np.ndarray


def discounts(n: np.ndarray) -> np.ndarray:
    """D1, D2, D3+ of modified Kneser-Ney from the counts of counts; 0.75 where those leave it open."""
    t = [float(np.count_nonzero(n == k)) for k in (1, 2, 3, 4)]
    if min(t[:3]) == 0:
        return np.array([0, 0.75, 0.75, 0.75])
    y = t[0] / (t[0] + 2 * t[1])
    d = [1 - 2 * y * t[1] / t[0], 2 - 3 * y * t[2] / t[1], 3 - 4 * y * t[3] / t[2]]
    return np.array([0, *(min(max(x, 0.05), k - 0.05) for k, x in enumerate(d, 1))])


def kneser_ney(codes: np.ndarray, counts: np.ndarray) -> list[Level]:
    """Levels of orders 1 to ORDER from the sorted codes of the highest order."""
    tables = [(codes.astype(np.int64), counts.astype(np.int64))]
    for k in range(ORDER - 1, 0, -1):  # lower orders count distinct left extensions
        tables.append(np.unique(tables[-1][0] & ((1 << (BITS * k)) - 1), return_counts=True))
    lower: Level | None = None
    out = []
    for k, (code, n) in enumerate(reversed(tables), 1):
        d = discounts(n)[np.minimum(n, 3)]
        ctx, at = np.unique(code >> BITS, return_index=True)
        total = np.add.reduceat(n, at).astype(float)
        gamma = np.add.reduceat(d, at) / total
        of = np.searchsorted(ctx, code >> BITS)
        if lower is None:
            base = np.full(len(code), 1.0 / (1 << BITS))
        else:
            base = np.exp(lower.logp[np.searchsorted(lower.codes, code & ((1 << (BITS * (k - 1))) - 1))])
        p = (n - d) / total[of] + gamma[of] * base
        lower = Level(code, np.log(p), ctx, np.log(gamma))
        out.append(lower)
    return out


def score(levels: list[Level], code: np.ndarray) -> np.ndarray:
    """log p of every code, by back-off where the code was never counted."""
    out = np.zeros(len(code))
    todo = np.arange(len(code))
    for k in range(ORDER, 0, -1):
        level, c = levels[k - 1], code[todo] & ((1 << (BITS * k)) - 1)
        at = np.minimum(np.searchsorted(level.codes, c.astype(level.codes.dtype)), len(level.codes) - 1)
        hit = level.codes[at] == c
        out[todo[hit]] += level.logp[at[hit]]
        todo, c = todo[~hit], c[~hit]
        if not len(todo):
            return out
        ctx = c >> BITS
        at = np.minimum(np.searchsorted(level.contexts, ctx), len(level.contexts) - 1)
        out[todo] += np.where(level.contexts[at] == ctx, level.backoff[at], 0.0)
    out[todo] -= np.log(1 << BITS)
    return out


PARTS = ("codes", "logp", "contexts", "backoff")


def packed(levels: list[Level]) -> bytes:
    out = io.BytesIO()
    kinds = (np.int32, np.float32, np.int32, np.float64)
    np.savez(out, **{f"{p}{k}": getattr(x, p).astype(t) for k, x in enumerate(levels) for p, t in zip(PARTS, kinds, strict=True)})
    return out.getvalue()


def unpacked(data: bytes) -> list[Level]:
    a = np.load(io.BytesIO(data))
    return [Level(*(a[f"{p}{k}"] for p in PARTS)) for k in range(ORDER)]


def fit(counts: DataFrame) -> DataFrame:
    """(lang, size, model): one row a language, whose at most 2**25 counts meet in one task."""

    def one(t: pa.Table) -> pa.Table:
        code, n = t.column("code").to_numpy(), t.column("n").to_numpy()
        order = np.argsort(code)
        model = packed(kneser_ney(code[order], n[order]))
        return pa.table({"lang": [t.column("lang")[0].as_py()], "size": pa.array([len(model)], pa.int64()), "model": pa.array([model], pa.binary())})

    return counts.groupBy("lang").applyInArrow(one, "lang string, size long, model binary")


def groups_of(sizes: list[tuple[str, int]], limit: int = GROUP_BYTES) -> list[list[str]]:
    """Languages in groups whose models sum to the limit at most, or are one."""
    out: list[list[str]] = []
    held = 0
    for name, size in sorted(sizes):
        if not out or held + size > limit:
            out.append([])
            held = 0
        out[-1].append(name)
        held += size
    return out


# ---------------------------------------------------------------- counts of a text
def base_counts(texts: list[bytes]) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of every text."""
    w = Words(texts)
    cum = lambda x: np.concatenate(([0], np.cumsum(x)))
    per = lambda x: np.diff(cum(x)[w.at])
    gap = SPACE[w.data]
    chars = per(((w.data & 0xC0) != 0x80) & ~gap)
    symbols = per(SYMBOL_BYTE[w.data])
    prefix = prefix_hash(w.data)
    word = span_hash(prefix, w.start, w.end)
    # lines: every newline ends one, the joining newline the text's last
    end = np.flatnonzero(w.data == 10)
    start = np.concatenate(([0], end[:-1] + 1))
    ink = cum(~gap)
    real = ink[end] > ink[start]
    start, end = start[real], end[real]
    doc = np.searchsorted(w.at, start, "right") - 1
    with np.errstate(over="ignore"):
        key = mix64(span_hash(prefix, start, end) + doc.astype(np.uint64) * MIX2)
    _, first, times = np.unique(key, return_index=True, return_counts=True)
    dup = np.zeros(w.n, np.int64)
    np.add.at(dup, doc[first], times - 1)
    # windows of one text that occur in it twice
    win = windows(word, WINDOW)
    repeat = np.zeros(w.n, np.int64)
    if len(win):
        same = w.doc[: len(win)] == w.doc[WINDOW - 1 :]
        place = np.flatnonzero(same)
        with np.errstate(over="ignore"):
            key = mix64(win[place] + w.doc[place].astype(np.uint64) * MIX2)
        ordered = np.sort(key)
        twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
        if len(twice):
            at = np.minimum(np.searchsorted(twice, key), len(twice) - 1)
            hit = place[twice[at] == key]
            cover = np.zeros(len(word) + 1, np.int64)
            cover[hit] += 1
            np.subtract.at(cover, hit + WINDOW, 1)
            repeat = np.diff(cum(np.cumsum(cover[:-1]) > 0)[w.first])
    return {"n_words": w.count, "word_chars": chars, "n_symbols": symbols, "n_dup_lines": dup, "n_repeat_words": repeat}


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def score_documents(docs: DataFrame, models: dict[str, bytes], doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """doc_id, th (hash of the text), lang, base counts, n_scored (symbols) and surprise: their mean negative log probability."""
    shared = docs.sparkSession.sparkContext.broadcast(models)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models, ready = shared.value, {}
        for b in it:
            for i, j, part in text_parts(b, 3):
                counts = base_counts(part)
                langs = np.array(b.column(2)[i:j].to_pylist(), str)
                surprise, n = np.full(len(part), np.nan), np.zeros(len(part), np.int64)
                for x in np.unique(langs).tolist():
                    own = np.flatnonzero(langs == x)
                    code, at = codes_of([part[k] for k in own])
                    if x in models and len(code):
                        if x not in ready:
                            ready[x] = unpacked(models[x])
                        total = np.concatenate(([0.0], np.cumsum(score(ready[x], code), dtype=np.float64)))
                        n[own] = np.diff(at)
                        some = (n[own] > 0) & (counts["n_words"][own] > 0)
                        surprise[own[some]] = -(total[at[1:]] - total[at[:-1]])[some] / n[own[some]]
                cols = [pa.array(counts[c].astype(np.int64)) for c in COUNTS]
                yield pa.record_batch([b.column(0)[i:j], b.column(1)[i:j], b.column(2)[i:j], *cols, pa.array(n), pa.array(np.round(surprise, 6), pa.float64(), mask=np.isnan(surprise))], ["doc_id", "th", "lang", *COUNTS, "n_scored", "surprise"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("th"), language(F.col(lang)).alias("lang"), text)
    return rows.mapInArrow(run, f"doc_id {dict(docs.dtypes)[doc_id]}, th long, lang string, {', '.join(f'{c} long' for c in COUNTS)}, n_scored long, surprise double")


def base_failed():
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))


def quartiles(rows: DataFrame, value, width: float) -> DataFrame:
    """lang, docs, q1, q2, q3 from a histogram of value over all rows, one task a language for its bins."""
    bins = rows.groupBy("lang", F.floor(F.greatest(F.least(value, F.lit(MOST)), F.lit(-MOST)) / width).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    up = Window.partitionBy("lang").orderBy("bin")
    cum = bins.withColumn("upto", F.sum("n").over(up)).withColumn("all", F.sum("n").over(Window.partitionBy("lang")))
    q = lambda p: F.min(F.when(F.col("upto") >= p * F.col("all"), (F.col("bin") + 0.5) * width))
    return cum.groupBy("lang").agg(F.max("all").alias("docs"), q(0.25).alias("q1"), q(0.5).alias("q2"), q(0.75).alias("q3"))


def bands(scored: DataFrame) -> DataFrame:
    """lang, mid, a (scatter of one symbol) and wide, over all documents that pass the base rules."""
    rows = scored.filter(~F.col("base_failed") & F.col("surprise").isNotNull()).select("lang", "surprise", "n_scored")
    both = rows.unionByName(rows.withColumn("lang", F.lit("")))  # '' is all languages together
    pool = lambda t: t.filter("lang = ''").drop("lang")
    shrunk = lambda own, pooled: (F.col("docs") * F.col(own) + SHRINK * F.col(pooled)) / (F.col("docs") + SHRINK)
    # tables of one row a language: two letters, so at most 678
    q = quartiles(both, F.col("surprise"), 1 / BIN).select("lang", "docs", F.col("q2").alias("own"))
    mids = q.join(F.broadcast(pool(q).select(F.col("own").alias("pooled")))).select("lang", shrunk("own", "pooled").alias("mid"))
    near = both.join(F.broadcast(mids), "lang")
    # 1.349: interquartile range of a normal distribution in standard deviations
    d = quartiles(near, (F.col("surprise") - F.col("mid")) * F.sqrt("n_scored"), 10 / BIN).select("lang", "docs", ((F.col("q3") - F.col("q1")) / 1.349).alias("own"))
    spread = d.join(F.broadcast(pool(d).select(F.col("own").alias("pooled")))).select("lang", shrunk("own", "pooled").alias("a"), (1 + 10 / F.col("docs")).alias("wide"))
    return mids.join(spread, "lang")


def judge(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Every document's counts, perplexity, base_failed and kept."""
    names = sorted(r[0] for r in docs.select(language(F.col(lang)).alias("l")).distinct().collect())  # two letters: at most 677
    counts = stored(count_ngrams(docs, text, lang), "ngrams")
    models = stored(fit(with_prior(counts, names)), "models") if names else None
    groups = groups_of([(r["lang"], r["size"]) for r in models.select("lang", "size").collect()]) if names else []
    mine = language(F.col(lang))
    parts = []
    for k, group in enumerate(groups or [[]]):
        own = {r["lang"]: bytes(r["model"]) for r in models.filter(F.col("lang").isin(group)).collect()} if group else {}
        rows = docs if len(groups) < 2 else docs.filter(mine.isin(group) if k else ~mine.isin([x for g in groups[1:] for x in g]))
        parts.append(stored(score_documents(rows, own, doc_id, text, lang).withColumn("base_failed", base_failed()), "scores"))
    discard(counts, *([models] if names else []))
    scored = parts[0]
    for x in parts[1:]:
        scored = scored.unionByName(x)
    out = scored.join(F.broadcast(bands(scored)), "lang", "left")
    unit = F.col("wide") * F.sqrt(F.col("a") * F.col("a") / F.greatest("n_scored", F.lit(1)) + F.pow(FLOOR * F.col("mid"), F.lit(2.0)))
    inside = F.col("surprise").between(F.col("mid") - LOW * unit, F.col("mid") + HIGH * unit)
    kept = ~F.col("base_failed") & F.coalesce(inside, F.lit(True))
    return out.select("doc_id", "th", "lang", *COUNTS, "base_failed", F.round(F.exp("surprise"), 4).alias("perplexity"), kept.alias("kept"))


def quality_filter(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows of docs that the rules keep."""
    good = judge(docs, doc_id, text, lang).filter("kept").select(F.col("doc_id").alias("_qid"), F.col("th").alias("_qth")).distinct()
    match = docs[doc_id].eqNullSafe(good["_qid"]) & (F.xxhash64(docs[text]) == good["_qth"])
    return docs.join(good, match, "left_semi")


def op5_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents")).drop("th")
