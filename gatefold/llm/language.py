"""Language identification with a blended-spectrum string kernel, Nyström landmarks and one-versus-rest ridge regression.

A text is the sets of its n-grams of 1 to ORDERS bytes, after lower-casing and with every stretch of ASCII characters
that aren't letters as one blank; an n-gram is a number of 16 bits (a hash from three bytes on).  The kernel of two texts is
the mean over n of the cosine between their presence sets, so it doesn't matter how often a text says something.

The classifier is fitted on a bounded sample: at most SAMPLE different texts a language, of which LANDMARKS / languages
(at least PER_LANGUAGE) are landmarks, both in the order of a hash of the text.  Landmark features are
k(x, landmarks) K^(-1/2); their Gram matrix is summed over the sample on executors, and the ridge system of landmarks x landmarks is
solved in the driver.  As a prediction is linear in the presence sets, landmarks and coefficients are multiplied out to one
weight for each n-gram and language (a broadcast of 1 MB a language), and a batch of texts is scored as the product of
its sparse presence matrix with these weights.

Defined results: null texts and texts without a letter are 'und' with score 0, as is every text if nothing could be learned;
rows with a null id are predicted but not learned from, and aren't held out; repeated rows are predicted alike; an empty table gives
an empty table.  Every language that a learned row names can be predicted, however rare.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gatefold.llm.common import discard, stored, table, text_parts

ORDERS, BITS = 4, 16
SIZE = ORDERS << BITS
#: Different texts a language that are learned from; landmarks of all languages; landmarks of a language at least.
SAMPLE, LANDMARKS, PER_LANGUAGE = 1000, 128, 4
#: Landmarks with more n-grams than this are taken last; share of the mean eigenvalue that is added to the diagonal.
WIDE, RIDGE = 1 << 14, 0.01
UNKNOWN = "und"

#: ASCII letters as small ones, other ASCII characters as blanks, bytes of other characters as they are.
PLAIN = np.arange(256, dtype=np.uint8)
PLAIN[:128] = 32
PLAIN[97:123] = PLAIN[65:91] = np.arange(97, 123)


def presence(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted n-grams of all texts, and where those of each text and order start: n-gram c of order n is (n - 1) << BITS | c."""
    raw = PLAIN[np.frombuffer(b" " + b" ".join(texts) + b" ", np.uint8)]
    edge = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))
    blank = raw == 32
    first = np.flatnonzero(blank & ~np.concatenate(([False], blank[:-1])))
    last = np.flatnonzero(blank & ~np.concatenate((blank[1:], [False])))
    keep = ~blank
    # of blanks in a row the first stays, of those at the ends of a text the one between texts
    keep[first[np.searchsorted(edge, first) == np.searchsorted(edge, last, "right")]] = True
    keep[edge] = True
    at = (np.cumsum(keep) - 1)[edge]
    raw = raw[keep].astype(np.uint32)
    code = [raw]
    for n in range(2, ORDERS + 1):
        code.append((code[-1][:-1] << np.uint32(8)) | raw[n - 1 :])
    for n in range(3, ORDERS + 1):
        code[n - 1] = (code[n - 1] * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)
    seen = np.zeros(SIZE, np.uint8)
    out, starts = [], np.zeros(len(texts) * ORDERS + 1, np.int64)
    for i, (a, b) in enumerate(zip(at[:-1].tolist(), (at[1:] + 1).tolist(), strict=True)):
        for n in range(ORDERS):
            seen[n << BITS : (n + 1) << BITS][code[n][a : max(a, b - n)]] = 1
        own = np.flatnonzero(seen.view(bool)).astype(np.int32)
        seen[own] = 0
        starts[i * ORDERS + 1 : (i + 1) * ORDERS + 1] = np.searchsorted(own, np.arange(1, ORDERS + 1) << BITS)
        starts[i * ORDERS + 1 : (i + 1) * ORDERS + 1] += starts[i * ORDERS]
        out.append(own)
    return np.concatenate(out) if out else np.zeros(0, np.int32), starts


def products(grams: np.ndarray, starts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Sparse presence matrix times weights (n-gram x column), each order divided by the root of its set's size, averaged over orders."""
    size = np.diff(starts)
    total = np.zeros((len(size), weights.shape[1]))
    step = max(1, (4 << 20) // max(1, weights.shape[1]))
    i = 0
    while i < len(size):  # about 4 M products at a time
        j = max(i + 1, int(np.searchsorted(starts, starts[i] + step, "right")) - 1)
        some = i + np.flatnonzero(size[i:j])
        if len(some):
            part = weights[grams[starts[i] : starts[j]]]
            total[some] = np.add.reduceat(part, starts[some] - starts[i], axis=0, dtype=np.float64)
        i = j
    total /= np.sqrt(np.maximum(size, 1))[:, None]
    return total.reshape(-1, ORDERS, weights.shape[1]).mean(axis=1)


@dataclass
class Landmarks:
    """columns: n-gram x landmark, presence over the root of the set's size of its order; root: K^(-1/2)."""

    columns: np.ndarray
    root: np.ndarray

    def features(self, grams: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Nyström features of texts and a constant."""
        f = products(grams, starts, self.columns) @ self.root
        return np.concatenate([f, np.ones((len(f), 1))], axis=1)


def landmarks(sets: list[np.ndarray], root: np.ndarray | None = None) -> Landmarks:
    """Landmarks from their n-grams; root, if it is known, isn't worked out again."""
    columns = np.zeros((SIZE, len(sets)), np.float32)
    grams, starts = np.concatenate(sets), [0]
    for k, g in enumerate(sets):
        cut = np.searchsorted(g, np.arange(ORDERS + 1) << BITS)
        starts += [starts[-1] + x for x in (cut[1:] - cut[0]).tolist()][:ORDERS]
        scale = 1 / np.sqrt(np.maximum(np.diff(cut), 1))
        columns[g, k] = scale[g >> BITS]
    if root is None:
        kernel = products(grams, np.array(starts), columns)
        value, vector = np.linalg.eigh((kernel + kernel.T) / 2)
        good = value > 1e-6 * value[-1]
        root = (vector[:, good] / np.sqrt(value[good])) @ vector[:, good].T
    return Landmarks(columns, root)


@dataclass
class Model:
    """names: languages; weights: n-gram x language; bias: one a language."""

    names: list[str]
    weights: np.ndarray
    bias: np.ndarray

    def predict(self, grams: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        s = products(grams, starts, self.weights) + self.bias
        best = s.argmax(axis=1)
        return best, np.clip(s[np.arange(len(s)), best], 0, 1)


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike("\\p{L}"), F.lit(False))


def sampled_sets(rows: DataFrame, sample: int) -> DataFrame:
    """(lang, h, grams, starts) of at most `sample` different texts a language; rows: lang and text."""
    # hashes are even, so a rate of 1.5 x sample leaves nearly always enough; short tables are taken whole
    n = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    h = F.xxhash64(F.lower("text"))
    unit = F.shiftrightunsigned(h, 11) / F.lit(float(1 << 53))
    # one row a language, and the model holds 1 MB of weights for each
    few = rows.join(F.broadcast(n), "lang").filter(unit < 1.5 * sample / F.col("n")).groupBy("lang", h.alias("h")).agg(F.min(F.lower("text")).alias("text"))
    first = few.withColumn("_k", F.row_number().over(Window.partitionBy("lang").orderBy("h"))).filter(F.col("_k") <= sample).drop("_k")

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for i, j, texts in text_parts(b, 2):
                grams, starts = presence(texts)
                own = pa.ListArray.from_arrays(pa.array(starts[::ORDERS].astype(np.int32)), pa.array(grams))
                yield pa.record_batch([b.column(0)[i:j], b.column(1)[i:j], own], ["lang", "h", "grams"])

    return first.select("lang", "h", "text").mapInArrow(run, "lang string, h long, grams array<int>")


def order_starts(grams: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Starts by text and order, from starts by text."""
    row = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    return np.searchsorted(row * ORDERS + (grams >> BITS), np.arange((len(starts) - 1) * ORDERS + 1))


def fit(rows: DataFrame, sample: int = SAMPLE, total: int = LANDMARKS) -> Model | None:
    """The classifier of rows (lang, text), None if there are none."""
    spark = rows.sparkSession
    sets = stored(sampled_sets(rows, sample), "sets")
    count = {r["lang"]: r["n"] for r in sets.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row a language
    if not count:
        discard(sets)
        return None
    names = sorted(count)
    each = max(PER_LANGUAGE, total // len(names))
    pick = Window.partitionBy("lang").orderBy(F.size("grams") > WIDE, "h")
    marks = sets.withColumn("_k", F.row_number().over(pick)).filter(F.col("_k") <= each).orderBy("lang", "h").select("grams").collect()
    chosen = [np.array(r[0], np.int32) for r in marks]
    base = landmarks(chosen)
    # the n-grams, from which a task builds the columns: the dense table would be a hundred times as large
    shared = spark.sparkContext.broadcast((chosen, base.root, {x: i for i, x in enumerate(names)}, np.array([1 / count[x] for x in names])))

    def sums(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen, root, place, weight = shared.value
        base, gram, target = landmarks(chosen, root), 0.0, 0.0
        for b in it:
            lists, lang = b.column(1), np.array([place[x] for x in b.column(0).to_pylist()])
            starts = lists.offsets.to_numpy().astype(np.int64)
            grams = lists.values.to_numpy()[starts[0] : starts[-1]]
            f = base.features(grams, order_starts(grams, starts - starts[0]))
            w = f * weight[lang][:, None]
            gram = gram + w.T @ f
            target = target + w.T @ (lang[:, None] == np.arange(len(place)))
        if not np.isscalar(gram):
            yield pa.record_batch([pa.array([gram.tobytes()], pa.binary()), pa.array([target.tobytes()], pa.binary())], ["gram", "target"])

    # a row a task of a table that the sample bounds
    parts = sets.select("lang", "grams").mapInArrow(sums, "gram binary, target binary").collect()
    m = base.root.shape[1] + 1
    gram = sum(np.frombuffer(p["gram"]).reshape(m, m) for p in parts)
    target = sum(np.frombuffer(p["target"]).reshape(m, len(names)) for p in parts)
    ridge = np.eye(m) * RIDGE * np.trace(gram) / m
    ridge[-1, -1] = 0  # the constant is free
    w = np.linalg.solve(gram + ridge, target)
    discard(sets)
    return Model(names, (base.columns @ (base.root @ w[:-1]).astype(np.float32)).astype(np.float32), w[-1])


def identify(docs: DataFrame, model: Model | None, keep: list[Column], text: str = "text") -> DataFrame:
    """keep, lang_pred and score of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for b in it:
            k = b.num_columns - 1
            for i, j, texts in text_parts(b, k):
                known = b.column(k)[i:j].is_valid().to_numpy(zero_copy_only=False)
                names, score = np.full(j - i, UNKNOWN, object), np.zeros(j - i)
                if model is not None and known.any():
                    best, s = model.predict(*presence([t for t, ok in zip(texts, known, strict=True) if ok]))
                    names[known], score[known] = np.array(model.names, object)[best], np.round(s, 6)
                yield pa.record_batch([*[b.column(c)[i:j] for c in range(k)], pa.array(names, pa.string()), pa.array(score)], [*head, "lang_pred", "score"])

    src = docs.select(*keep, F.when(has_letter(F.col(text)), F.lower(text)).alias("_text"))
    head = src.columns[:-1]
    return src.mapInArrow(run, ", ".join([*[f"`{c}` {t}" for c, t in src.dtypes[:-1]], "lang_pred string, score double"]))


def op13_string_kernel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language, learned from the documents whose crc32(doc_id) mod 4 isn't 2."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    model = fit(docs.filter((fold != 2) & F.col("lang").isNotNull() & has_letter(F.col("text"))).select("lang", "text"))
    return identify(docs, model, [F.col("doc_id"), F.coalesce(fold == 2, F.lit(False)).alias("held_out")])
