"""Token ids in a file format of interleaved range asymmetric numeral system (rANS) blocks.

Documents are dealt out by ranges of doc_id and encoded in that order.  A task cuts its documents into
segments of about SEGMENT ids; a segment has one shared static frequency table and independent blocks
of BLOCK ids, each coded by LANES interleaved states.  The segment's index has a checkpoint for
each block (byte offset, first id, ids) and checksums of its bytes and of its ids, so that any block
decodes alone and all of them in parallel.  A segment is one binary cell of a Parquet file, which
Spark writes and reads in any store.

Segment: magic, counts, table (symbol deltas, frequencies), document ids and lengths (all deflated
arrays), block index, blocks.  A block is its lanes' final states and the 32-bit words they gave off.

Defined results: null or empty text is one document of the end id alone; null doc_ids come first;
repeated rows are separate documents; a document of any length spans blocks of one segment; an
empty table gives no segments and no rows.  A damaged block raises CorruptBlock.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gatefold.llm.common import stored, table, text_parts

END, CACHE = 1, 1_500_000
PART_BYTES = 128 << 20
#: Marks that are cut off a word, and the first character that may combine.
MARKS, PLAIN = ".,;:!?", "\u0130"
WIDE = re.compile(f"[{PLAIN}-\U0010ffff]").search
SEGMENT, BLOCK, LANES, SCALE = 1 << 21, 1 << 15, 32, 18
LOW = np.uint64(1 << 31)
MAGIC = b"GFRANS01"


class CorruptBlock(ValueError):
    pass


# ---------------------------------------------------------------- ids
def byte_characters() -> dict[int, str]:
    """Characters below PLAIN as the byte-level alphabet writes their UTF-8 bytes."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in shown]
    alphabet = {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}
    return {c: "".join(alphabet[b] for b in chr(c).encode()) for c in range(ord(PLAIN))}


class Tokens(dict):
    """The tokenizers library behind a cache: chunk without space or newline -> its ids, little-endian.

    The tokenizer file splits at white space before anything else, so such chunks have the ids that
    they have in their text.  Lower-case letters alone are one piece and go straight to the library's
    BPE model; letters and one mark after them are two pieces; the library encodes other chunks.
    A text that holds an added token of the file, written as in the file, goes to the library whole.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole, self.lib = Tokenizer.from_file(path), Tokenizer.from_file(path)
        self.added = re.compile("|".join(re.escape(t.content) for t in self.whole.get_added_tokens_decoder().values()) or "(?!)").search
        self.lib.encode_special_tokens = True  # lower-casing and cutting must not make such a token
        self.model, self.shown = self.lib.model, byte_characters()
        self[""] = b""

    def __missing__(self, chunk: str) -> bytes:
        if WIDE(chunk) is None and chunk.islower():
            if chunk.isalpha():
                out = array("I", [t.id for t in self.model.tokenize(chunk if chunk.isascii() else chunk.translate(self.shown))]).tobytes()
                self[chunk] = out
                return out
            if chunk[-1] in MARKS and len(chunk) > 1 and chunk[-2].isalpha():
                out = self[chunk[:-1]] + self[chunk[-1]]
                self[chunk] = out
                return out
        out = self[chunk] = array("I", self.lib.encode(chunk, add_special_tokens=False).ids).tobytes()
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of every text, without an end id."""
        if len(self) > CACHE:
            self.clear()
            self[""] = b""
        get = self.__getitem__
        # below PLAIN nothing combines and lower-casing is by character, as in the library
        return [
            array("I", self.whole.encode(t, add_special_tokens=False).ids).tobytes() if self.added(t) else b"".join(map(get, (t if WIDE(t) else t.lower()).replace("\n", " ").split(" ")))
            for t in texts
        ]


@lru_cache(2)
def tokens(path: str) -> Tokens:
    return Tokens(path)


# ---------------------------------------------------------------- coder
def normalise(counts: np.ndarray) -> np.ndarray:
    """Frequencies of at least 1 that sum to 2**SCALE, near the counts' shares."""
    total = 1 << SCALE
    if len(counts) > total:
        raise ValueError("more symbols than the table's scale")
    f = np.maximum(1, counts * (total - len(counts)) // counts.sum())
    short = total - int(f.sum())
    if short >= 0:
        f[np.argmax(f)] += short
        return f
    order = np.argsort(-f, kind="stable")
    while short < 0:
        can = order[f[order] > 1][: -short]
        f[can] -= 1
        short += len(can)
    return f


class Table:
    def __init__(self, symbols: np.ndarray, freq: np.ndarray) -> None:
        self.symbols, self.freq = symbols, freq.astype(np.uint64)
        self.start = (np.cumsum(freq) - freq).astype(np.uint64)
        self.slot = np.repeat(np.arange(len(symbols), dtype=np.int64), freq)


def encode_lanes(codes: np.ndarray, t: Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """codes[step, lane] -> states[lane], words[step, lane], gave[step, lane]."""
    steps, lanes = codes.shape
    x = np.full(lanes, LOW, np.uint64)
    words, gave = np.zeros((steps, lanes), np.uint32), np.zeros((steps, lanes), bool)
    s32, sc = np.uint64(32), np.uint64(SCALE)
    unit = (LOW >> sc) << s32
    for k in range(steps - 1, -1, -1):
        f, c = t.freq[codes[k]], t.start[codes[k]]
        over = x >= unit * f
        words[k], gave[k] = x.astype(np.uint32), over
        x = np.where(over, x >> s32, x)
        q = x // f
        x = (q << sc) + (x - q * f) + c
    return x, words, gave


def decode_lanes(x: np.ndarray, words: np.ndarray, at: np.ndarray, block_of: np.ndarray, steps: int, t: Table) -> np.ndarray:
    """Codes[step, lane].  at[block]: place of the block's next word in words; lanes of a block stand together."""
    lanes = len(x)
    out = np.zeros((steps, lanes), np.int64)
    mask, sc, s32 = np.uint64((1 << SCALE) - 1), np.uint64(SCALE), np.uint64(32)
    per = lanes // len(at)
    at = at.copy()
    words = np.append(words, np.zeros(1, np.uint32)).astype(np.uint64)
    for k in range(steps):
        low = x & mask
        s = t.slot[low]
        out[k] = s
        x = t.freq[s] * (x >> sc) + low - t.start[s]
        need = x < LOW
        taken = need.reshape(-1, per)
        place = (np.cumsum(taken, 1) - taken + at[:, None]).ravel()
        x = np.where(need, (x << s32) | words[np.where(need, place, len(words) - 1)], x)
        at += taken.sum(1)
    return out


def _pack(a: np.ndarray, kind: str) -> bytes:
    z = zlib.compress(np.ascontiguousarray(a, kind).tobytes(), 3)
    return struct.pack("<I", len(z)) + z


def _unpack(d: bytes, at: int, kind: str) -> tuple[np.ndarray, int]:
    n = struct.unpack_from("<I", d, at)[0]
    return np.frombuffer(zlib.decompress(d[at + 4 : at + 4 + n]), kind), at + 4 + n


def write_segment(ids: np.ndarray, doc_ids: list[int | None], lengths: np.ndarray) -> bytes:
    # ids are bounded by the vocabulary, so counting by place needs no sort
    counts = np.bincount(ids)
    symbols = np.flatnonzero(counts)
    codes = (np.cumsum(counts > 0) - 1)[ids]
    counts = counts[symbols]
    freq = normalise(counts)
    t = Table(symbols, freq)
    n = len(ids)
    bodies: list[bytes] = []
    full = n // BLOCK
    fill = int(np.argmax(freq))
    for first, count, size in ((0, full, BLOCK), (full * BLOCK, 1, n - full * BLOCK)):
        if not count or not size:
            continue
        padded = -(-size // LANES) * LANES
        part = np.full(count * padded, fill, np.int64)
        if size == padded:
            part[:] = codes[first : first + count * size]
        else:
            part[:size] = codes[first:]
        # [block, step, lane] -> [step, block * lane]
        grid = part.reshape(count, -1, LANES).transpose(1, 0, 2).reshape(-1, count * LANES)
        x, words, gave = encode_lanes(grid, t)
        for b in range(count):
            own = slice(b * LANES, (b + 1) * LANES)
            bodies.append(x[own].astype("<u8").tobytes() + words[:, own][gave[:, own]].astype("<u4").tobytes())
    data = ids.astype("<u4")
    index, at = [], 0
    for b, body in enumerate(bodies):
        own = data[b * BLOCK : (b + 1) * BLOCK]
        index.append((at, b * BLOCK, len(own), zlib.crc32(body), zlib.crc32(own.tobytes())))
        at += len(body)
    null = np.array([d is None for d in doc_ids], "u1")
    keys = np.array([d or 0 for d in doc_ids], np.int64)
    head = MAGIC + struct.pack("<QII", n, len(doc_ids), len(bodies))
    parts = [_pack(np.diff(symbols.astype(np.int64), prepend=0), "<u4"), _pack(freq, "<u4"), _pack(null, "u1"), _pack(np.diff(keys, prepend=0), "<i8"), _pack(lengths, "<u8"), _pack(np.array(index, np.uint64).reshape(-1, 5), "<u8")]
    body = head + b"".join(parts)
    return body + struct.pack("<I", zlib.crc32(body)) + b"".join(bodies)


class Segment:
    """Reader: heads are parsed at once, blocks on demand."""

    def __init__(self, d: bytes) -> None:
        if d[:8] != MAGIC:
            raise CorruptBlock("no segment")
        self.d = d
        self.n, self.n_docs, self.n_blocks = struct.unpack_from("<QII", d, 8)
        at = 24
        try:
            deltas, at = _unpack(d, at, "<u4")
            freq, at = _unpack(d, at, "<u4")
            null, at = _unpack(d, at, "u1")
            keys, at = _unpack(d, at, "<i8")
            self.lengths, at = _unpack(d, at, "<u8")
            index, at = _unpack(d, at, "<u8")
        except (zlib.error, struct.error) as e:
            raise CorruptBlock(f"head: {e}") from e
        if zlib.crc32(d[:at]) != struct.unpack_from("<I", d, at)[0]:
            raise CorruptBlock("head checksum")
        self.body = at + 4
        self.table = Table(np.cumsum(deltas.astype(np.int64)), freq.astype(np.int64))
        self.doc_ids = [None if z else k for z, k in zip(null.tolist(), np.cumsum(keys).tolist(), strict=True)]
        self.index = index.reshape(-1, 5).astype(np.int64)

    def blocks(self, which: list[int]) -> np.ndarray:
        """Ids of neighbouring or single blocks of equal size, decoded together and checked."""
        ends = np.append(self.index[1:, 0], len(self.d) - self.body)
        states, words, at, total = [], [], [], 0
        for b in which:
            body = self.d[self.body + int(self.index[b, 0]) : self.body + int(ends[b])]
            if zlib.crc32(body) != self.index[b, 3] or len(body) < 8 * LANES:
                raise CorruptBlock(f"block {b}: bytes")
            states.append(np.frombuffer(body, "<u8", LANES))
            words.append(np.frombuffer(body, "<u4", offset=8 * LANES))
            at.append(total)
            total += len(words[-1])
        size = int(self.index[which[0], 2])
        steps = -(-size // LANES)
        grid = decode_lanes(np.concatenate(states).astype(np.uint64), np.concatenate(words), np.array(at), np.arange(len(which)), steps, self.table)
        codes = grid.reshape(steps, len(which), LANES).transpose(1, 0, 2).reshape(len(which), -1)[:, :size]
        ids = self.table.symbols[codes]
        for row, b in zip(ids, which, strict=True):
            if zlib.crc32(row.astype("<u4").tobytes()) != self.index[b, 4]:
                raise CorruptBlock(f"block {b}: ids")
        return ids.ravel()

    def ids(self) -> np.ndarray:
        full = [b for b in range(self.n_blocks) if self.index[b, 2] == BLOCK]
        rest = [b for b in range(self.n_blocks) if self.index[b, 2] != BLOCK]
        return np.concatenate([self.blocks(full) if full else np.zeros(0, np.int64), *(self.blocks([b]) for b in rest)])


# ---------------------------------------------------------------- tables
SEGMENTS = "part int, seq int, n_docs long, n_tokens long, segment binary"


def default_path() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


def encode_documents(docs: DataFrame, path: str | None = None, doc_id: str = "doc_id", text: str = "text", end: int = END, parts: int | None = None) -> DataFrame:
    """Segments of all documents in ascending doc_id order: by part, then seq.

    Without parts their number follows the bytes of the texts, so that no part outgrows a task.
    """
    path = path or default_path()
    if not parts:
        size = docs.agg(F.sum(F.octet_length(text).cast("long"))).first()[0] or 0
        parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // PART_BYTES))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, part, seq = tokens(path), TaskContext.get().partitionId(), 0
        tail = np.array([end], "<u4").tobytes()
        keys: list = []
        data: list[bytes] = []
        held = 0

        def flush() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(data), "<u4")
            lengths = np.array([len(x) // 4 for x in data], np.uint64)
            seg = write_segment(ids, keys, lengths)
            return pa.record_batch([pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([len(keys)], pa.int64()), pa.array([len(ids)], pa.int64()), pa.array([seg], pa.binary())], [x.split()[0] for x in SEGMENTS.split(", ")])

        for b in it:
            for i, j, texts in text_parts(b, 1):
                for k, x in zip(b.column(0)[i:j].to_pylist(), tok.encode([t.decode() for t in texts]), strict=True):
                    keys.append(k)
                    data.append(x + tail)
                    held += len(data[-1]) // 4
                    if held >= SEGMENT:
                        yield flush()
                        keys, data, held, seq = [], [], 0, seq + 1
        if keys:
            yield flush()

    rows = docs.select(F.col(doc_id).cast("long"), text).repartitionByRange(parts, F.col(doc_id).asc_nulls_first()).sortWithinPartitions(F.col(doc_id).asc_nulls_first(), text)
    return rows.mapInArrow(run, SEGMENTS)


def read_documents(segments: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the stored segments."""
    names = ["part", "seq", "doc_id", "local", "n_tokens", "ids_crc32"]

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for part, seq, d in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
                s = Segment(d)
                data = s.ids().astype("<u4").tobytes()
                stop = np.cumsum(s.lengths).astype(np.int64)
                start = stop - s.lengths.astype(np.int64)
                crc = [zlib.crc32(data[4 * i : 4 * j]) for i, j in zip(start.tolist(), stop.tolist(), strict=True)]
                n = len(crc)
                yield pa.record_batch([pa.repeat(pa.scalar(part, pa.int32()), n), pa.repeat(pa.scalar(seq, pa.int32()), n), pa.array(s.doc_ids, pa.int64()), pa.array(start, pa.int64()), pa.array(s.lengths.astype(np.int64)), pa.array(crc, pa.int64())], names)

    rows = segments.select("part", "seq", "segment").mapInArrow(run, "part int, seq int, doc_id long, local long, n_tokens long, ids_crc32 long")
    # ids before a segment: a sum over parts (one row each), then within the part
    metas = segments.select("part", "seq", "n_tokens")
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    per = metas.groupBy("part").agg(F.sum("n_tokens").alias("_n")).withColumn("_before", F.coalesce(F.sum("_n").over(before(Window.orderBy("part"))), F.lit(0)))
    starts = metas.withColumn("_in", F.coalesce(F.sum("n_tokens").over(before(Window.partitionBy("part").orderBy("seq"))), F.lit(0))).drop("n_tokens").join(per.drop("_n"), "part")
    out = rows.join(starts, ["part", "seq"])
    return out.select("doc_id", (F.col("local") + F.col("_in") + F.col("_before")).cast("long").alias("start"), "n_tokens", "ids_crc32")


def op6_rans_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    segments = encode_documents(table(spark, sf_dir, "documents"))
    return read_documents(stored(segments, "rans", compression="none"))
