"""Shared helpers of the training-data operators: inputs, shared storage, hot keys, text arrays."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile
from pathlib import Path

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Heavy hitters that are broadcast in a hot-key join.  A key outside the first
#: HOT_KEYS by row count holds at most 1/HOT_KEYS of all rows, so the rest spreads.
HOT_KEYS = 4096


#: Bytes of an Arrow batch, by default 64 MB for each task on either side of the socket.
BATCH_BYTES, BATCH_CONF, BATCH_DEFAULT = 4 << 20, "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package where neither PYTHONPATH nor the working folder has it, and get texts in small batches."""
    if spark.conf.get(BATCH_CONF, None) == BATCH_DEFAULT:
        spark.conf.set(BATCH_CONF, str(BATCH_BYTES))
    root = Path(__file__).resolve().parents[2]
    paths = [Path(p).resolve() for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    sc = spark.sparkContext
    if root in paths or Path.cwd().resolve() == root or getattr(sc, "_gatefold_shipped", False):
        return
    at = Path(tempfile.mkdtemp(prefix="gatefold-code-")) / "gatefold.zip"
    with zipfile.ZipFile(at, "w") as z:
        for f in (root / "gatefold").rglob("*.py"):
            z.write(f, f.relative_to(root))
    sc.addPyFile(str(at))
    sc._gatefold_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor and the driver see: spark.checkpoint.dir of the session.

    Only a local session that has none (tests, a laptop) gets a folder of its own; on a cluster a
    folder of one machine would lose rows, so that is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="gatefold-shared-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


#: Session setting under which a finished write's shuffle files go at once, not when the driver collects garbage.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, tag: str, parts: tuple[str, ...] = (), **options: str) -> DataFrame:
    """Write df as Parquet in the shared folder, in a folder for each value of parts, and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/gatefold/{tag}-{uuid.uuid4().hex}"
    before = spark.conf.get(FREE_SHUFFLES, None)
    try:
        if before is not None:
            spark.conf.set(FREE_SHUFFLES, "true")
        df.write.options(**options).partitionBy(*parts).parquet(path)
    finally:
        if before is not None:
            spark.conf.set(FREE_SHUFFLES, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Remove stored() tables that no later step reads."""
    for t in tables:
        sc = t.sparkSession.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(t._stored_at)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def join_hot(left: DataFrame, right: DataFrame, keys: list[str], weight: str, how: str = "inner") -> DataFrame:
    """Equi-join of many rows with a table that has one row per key, where a key may hold a third of left.

    right.weight is the number of left rows of the key.  The HOT_KEYS heaviest keys (a bound on the
    broadcast that holds at any size) are joined by broadcast; no other key holds more than
    1/HOT_KEYS of the rows, and those are joined by shuffle.  Null keys match nothing.
    """
    hot = right.orderBy(F.desc(weight), *keys).limit(HOT_KEYS)
    marked = left.join(F.broadcast(hot.withColumn("_hot", F.lit(True))), keys, "left")
    extra = [c for c in right.columns if c not in keys]
    met = marked.filter("_hot").drop("_hot")
    cold = marked.filter("_hot is null").select(*left.columns)
    cold = cold.join(right, keys, how).select(*left.columns, *extra)
    return met.select(*left.columns, *extra).unionByName(cold)


def hash128(c: Column) -> list[Column]:
    """Two independently seeded 64-bit hashes, so that keys of 1e12 distinct values do not collide."""
    return [F.xxhash64(c), F.xxhash64(F.lit(0x5BD1E995), c)]


def lower_ascii(c: Column) -> Column:
    """Lower-case A-Z alone."""
    up = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    # lower() agrees unless a non-ASCII letter is upper case; translate() walks characters and is slower
    return F.when(F.length(c) == F.octet_length(c), F.lower(c)).otherwise(F.translate(c, up, up.lower()))


# ---------------------------------------------------------------- arrays of a batch of texts
MIX1, MIX2, MIX3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
BASE = np.uint64(0x2545F4914F6CDD1D)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambler of 64-bit words."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * MIX2
        x = (x ^ (x >> np.uint64(27))) * MIX3
        return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of BASE and of its inverse modulo 2**64, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << max(16, (n - 1).bit_length())
            inv = np.uint64(pow(int(BASE), -1, 1 << 64))
            with np.errstate(over="ignore"):
                self.up = np.concatenate(([np.uint64(1)], np.multiply.accumulate(np.full(size - 1, BASE, np.uint64))))
                self.down = np.concatenate(([np.uint64(1)], np.multiply.accumulate(np.full(size - 1, inv, np.uint64))))
        return self.up[:n], self.down[:n]


POWERS = _Powers()


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """P[i] = sum of (data[j] + 1) * BASE**j for j < i, modulo 2**64."""
    up, _ = POWERS.get(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=out[1:])
    return out


def span_hash(p: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Position-free hash of data[start:end], from prefix hashes."""
    _, down = POWERS.get(len(p))
    with np.errstate(over="ignore"):
        return mix64((p[end] - p[start]) * down[start] + (end - start).astype(np.uint64) * MIX1)


SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


class Words:
    """Words ([^\\x20\\x09-\\x0D]+) of a list of UTF-8 texts as arrays, without a Python object per word.

    data: the bytes of all texts, each followed by one newline; text i is data[at[i]:at[i + 1] - 1].
    start, end: byte spans of the words; doc: index of their text; first[i]: first word of text i.
    """

    def __init__(self, texts: list[bytes], lower: bool = False) -> None:
        self.n = len(texts)
        raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        self.data = LOWER[raw] if lower else raw
        self.at = np.zeros(self.n + 1, np.int64)
        np.cumsum([len(t) + 1 for t in texts], out=self.at[1:])
        gap = SPACE[self.data]
        edge = np.flatnonzero(np.diff(gap, prepend=True))
        self.start, self.end = edge[0::2], edge[1::2]
        self.first = np.searchsorted(self.start, self.at)
        self.count = np.diff(self.first)
        self.doc = np.repeat(np.arange(self.n), self.count)

    def hashes(self) -> np.ndarray:
        return span_hash(prefix_hash(self.data), self.start, self.end)


def windows(word: np.ndarray, size: int) -> np.ndarray:
    """Order-dependent hash of every `size` neighbouring words (windows may cross texts; mask those)."""
    if len(word) < size:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(word) - size + 1, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(size):
            out = (out + word[k : len(word) - size + 1 + k]) * MIX1
            out ^= out >> np.uint64(29)
    return mix64(out)


def batches(rows: list[bytes], limit: int = 1 << 20):
    """Index ranges of rows whose bytes sum to about limit; a longer row comes alone."""
    start = total = 0
    for i, r in enumerate(rows):
        if i > start and total + len(r) > limit:
            yield start, i
            start, total = i, 0
        total += len(r)
    if start < len(rows):
        yield start, len(rows)


def text_parts(batch, column: int, limit: int = 1 << 20):
    """(i, j, texts) over an Arrow batch: only about limit bytes become Python objects at a time."""
    import pyarrow.compute as pc

    col = batch.column(column)
    size = np.concatenate(([0], np.cumsum(pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False), dtype=np.int64)))
    i = 0
    while i < len(col):
        j = max(i + 1, int(np.searchsorted(size, size[i] + limit, "right")) - 1)
        yield i, j, utf8(col[i:j])
        i = j


def utf8(column) -> list[bytes]:
    """Arrow string column to bytes; null is empty."""
    import pyarrow as pa

    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]
