"""Byte-level BPE encoding and decoding over length-bucketed padded matrices.

The distinct pieces of a batch of texts are put into one matrix per length bucket, a row a piece.  In
every round each row merges its leftmost pair of least rank: ranks of changed neighbours come from an
open-addressing hash table of pairs, columns right of the merge move one to the left, and rows
without a mergeable pair leave the matrix.  Pieces are cached per worker, up to a fixed number.

Defined results: null and empty texts have no ids; a piece of any length is encoded whole (pieces of
more than LONG bytes by a heap over linked neighbours, with the same merges, as a matrix of one
row would take quadratic time); equal texts have equal ids; other columns don't matter.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import sys
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame, SparkSession

from gatefold.llm.common import table, text_parts

NONE = np.int64(1 << 40)
LONG, CACHE = 256, 500_000


class PairTable:
    """(left id, right id) -> rank of the merged token; linear probing in numpy arrays."""

    def __init__(self, pairs: np.ndarray, ranks: np.ndarray) -> None:
        self.bits = max(4, int(len(pairs) * 4).bit_length())
        self.mask = np.int64((1 << self.bits) - 1)
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.vals = np.full(1 << self.bits, NONE, np.int64)
        todo, step = np.arange(len(pairs)), 0
        while len(todo):
            slot = (self._slot(pairs[todo]) + step) & self.mask
            free = self.keys[slot] == -1
            at, first = np.unique(slot[free], return_index=True)
            won = todo[free][first]
            self.keys[at], self.vals[at] = pairs[won], ranks[won]
            todo = np.setdiff1d(todo, won)
            step += 1
        self.probes = step

    def _slot(self, k: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((k.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of any shape; a negative id (padding) has none."""
        k = (left << 32) | right
        bad = (left < 0) | (right < 0)
        slot = self._slot(k)
        out = np.where(self.keys[slot] == k, self.vals[slot], NONE)
        miss = (self.keys[slot] != k) & (self.keys[slot] != -1) & ~bad
        for step in range(1, self.probes):
            if not miss.any():
                break
            at = np.nonzero(miss)
            s = (slot[at] + step) & self.mask
            hit = self.keys[s] == k[at]
            out[at] = np.where(hit, self.vals[s], out[at])
            miss[at] = ~hit & (self.keys[s] != -1)
        out[bad] = NONE
        return out


class ByteBPE:
    """Encoder and decoder for a rank file: base64 token and rank on each line."""

    def __init__(self, path: str, pattern: str = public_tokenizers.PATTERN) -> None:
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.pattern = regex.compile(pattern)
        self.tokens = [b""] * (max(self.ranks.values()) + 1)
        for t, r in self.ranks.items():
            self.tokens[r] = t
        self.names = [str(i) for i in range(len(self.tokens))]
        self.byte = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        pairs, ranks = [], []
        for t, r in self.ranks.items():
            for i in range(1, len(t)):
                a, b = self.ranks.get(t[:i]), self.ranks.get(t[i:])
                if a is not None and b is not None:
                    pairs.append((a << 32) | b)
                    ranks.append(r)
        self.pairs = PairTable(np.array(pairs, np.int64), np.array(ranks, np.int64))
        self.single = [i.to_bytes(4, sys.byteorder) for i in range(len(self.tokens))]
        self.cache: dict[str, bytes] = {}

    # ------------------------------------------------------------ pieces
    def merge_matrix(self, rows: list[bytes]) -> list[bytes]:
        """Ids (32-bit, packed) of pieces of similar length."""
        n, width = len(rows), max(map(len, rows))
        lens = np.array([len(r) for r in rows])
        ids = np.full((n, width), -1, np.int64)
        ids[np.arange(width) < lens[:, None]] = self.byte[np.frombuffer(b"".join(rows), np.uint8)]
        rank = np.full((n, width), NONE, np.int64)  # of the pair that starts in this column
        if width > 1:
            rank[:, :-1] = self.pairs.get(ids[:, :-1], ids[:, 1:])
        done = [b""] * n
        who = np.arange(n)
        while len(who):
            at = rank.argmin(1)  # the leftmost of the least
            least = rank[np.arange(len(who)), at]
            over = least == NONE
            if over.any():
                packed, step = ids[over].astype(np.int32).tobytes(), 4 * width
                for at0, (i, k) in enumerate(zip(who[over].tolist(), lens[over].tolist(), strict=True)):
                    done[i] = packed[at0 * step : at0 * step + 4 * k]
                stay = ~over
                who, ids, rank, lens, at, least = who[stay], ids[stay], rank[stay], lens[stay], at[stay], least[stay]
                if not len(who):
                    break
                width = int(lens.max())
                ids, rank = ids[:, :width], rank[:, :width]
            r = np.arange(len(who))
            col = np.arange(width - 1)
            source = col + (col > at[:, None])
            ids = np.concatenate((np.take_along_axis(ids, source, 1), np.full((len(who), 1), -1, np.int64)), 1)
            rank = np.concatenate((np.take_along_axis(rank, source, 1), np.full((len(who), 1), NONE, np.int64)), 1)
            ids[r, at] = least
            lens = lens - 1
            right = np.minimum(at + 1, width - 1)
            rank[r, at] = self.pairs.get(ids[r, at], np.where(at + 1 < lens, ids[r, right], -1))
            left = np.maximum(at - 1, 0)
            before = self.pairs.get(np.where(at > 0, ids[r, left], -1), ids[r, at])
            rank[r, left] = np.where(at > 0, before, rank[r, left])
        return done

    def merge_long(self, piece: bytes) -> bytes:
        """One long piece: the same merges in the same order, from a heap of (rank, place)."""
        ids = self.byte[np.frombuffer(piece, np.uint8)]
        n = len(ids)
        first = self.pairs.get(ids[:-1], ids[1:]).tolist()
        ids = ids.tolist()
        nxt, prv, tok = [*range(1, n), -1], [-1, *range(n - 1)], self.tokens
        heap = [(r, i) for i, r in enumerate(first) if r < NONE]
        heapq.heapify(heap)
        now = [*first, int(NONE)]

        def rank_at(i: int) -> None:
            j = nxt[i]
            now[i] = self.ranks.get(tok[ids[i]] + tok[ids[j]], int(NONE)) if j >= 0 else int(NONE)
            if now[i] < NONE:
                heapq.heappush(heap, (now[i], i))

        while heap:
            r, i = heapq.heappop(heap)
            if now[i] != r:
                continue
            j = nxt[i]
            ids[i], nxt[i], now[j] = r, nxt[j], -1
            if nxt[j] >= 0:
                prv[nxt[j]] = i
            rank_at(i)
            if prv[i] >= 0:
                rank_at(prv[i])
        out, i = [], 0
        while i >= 0:
            out.append(ids[i])
            i = nxt[i]
        return np.array(out, np.int32).tobytes()

    def learn(self, pieces: Iterable[str]) -> None:
        """Put the ids of new pieces into the cache."""
        buckets: dict[int, list[tuple[str, bytes]]] = {}
        for p in pieces:
            b = p.encode()
            r = self.ranks.get(b)
            if r is not None:
                self.cache[p] = self.single[r]
            elif len(b) > LONG:
                self.cache[p] = self.merge_long(b)
            else:
                buckets.setdefault(-(-len(b) // 4) if len(b) <= 32 else 8 + (len(b) - 1).bit_length(), []).append((p, b))
        for rows in buckets.values():
            step = max(64, 200_000 // max(len(b) for _, b in rows))
            for i in range(0, len(rows), step):
                part = rows[i : i + step]
                self.cache.update(zip((p for p, _ in part), self.merge_matrix([b for _, b in part]), strict=True))

    # ------------------------------------------------------------ texts
    def encode(self, texts: list[str]) -> list[list[int]]:
        pieces = [self.pattern.findall(t) for t in texts]
        if len(self.cache) > CACHE:
            self.cache.clear()
        self.learn(set(chain.from_iterable(pieces)).difference(self.cache))
        get = self.cache.__getitem__
        return [np.frombuffer(b"".join(map(get, p)), np.int32).tolist() for p in pieces]

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


@lru_cache(2)
def codec(path: str) -> ByteBPE:
    """One codec a worker process."""
    return ByteBPE(path)


def default_path() -> str:
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def encode_documents(docs: DataFrame, path: str | None = None, doc_id: str = "doc_id", text: str = "text", check: bool = False) -> DataFrame:
    """doc_id, ids array<int>; with check every document is decoded again and must give its text."""
    path = path or default_path()

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path)
        for b in it:
            for i, j, texts in text_parts(b, 1):
                ids = bpe.encode([t.decode() for t in texts])
                if check and any(bpe.decode(x) != t for x, t in zip(ids, texts, strict=True)):
                    raise RuntimeError("decoded ids differ from their text")
                yield pa.record_batch([b.column(0)[i:j], pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return docs.select(doc_id, text).mapInArrow(run, f"doc_id {dict(docs.dtypes)[doc_id]}, ids array<int>")


def decode_documents(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, data binary, of (doc_id, ids)."""
    path = path or default_path()

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path)
        for b in it:
            yield pa.record_batch([b.column(0), pa.array([bpe.decode(x or ()) for x in b.column(1).to_pylist()], pa.binary())], ["doc_id", "data"])

    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {dict(encoded.dtypes)['doc_id']}, data binary")


def round_trip(docs: DataFrame, path: str | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode and decode in one pass: doc_id, n_tokens and the digests of the ids and of the decoded bytes."""
    path = path or default_path()
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path)
        sha = lambda x: hashlib.sha256(x).hexdigest()
        for b in it:
            for i, j, texts in text_parts(b, 1):
                ids = bpe.encode([t.decode() for t in texts])
                cols = [[len(x) for x in ids], [sha(" ".join(map(bpe.names.__getitem__, x)).encode()) for x in ids], [sha(bpe.decode(x)) for x in ids]]
                yield pa.record_batch([b.column(0)[i:j], pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.string())], names)

    return docs.select(doc_id, text).mapInArrow(run, f"doc_id {dict(docs.dtypes)[doc_id]}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"))
