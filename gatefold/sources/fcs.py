"""FCS event files: their layout, parser and writer, and a scan of whole folders.

Files are listed by Spark and read by a data source (fcs_source) whose tasks are event ranges of a file.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCATTER = re.compile(r"^(fsc|ssc|time|event)", re.I)


class FcsError(ValueError):
    pass


def parse_text(segment: bytes) -> dict[str, str]:
    """Keyword pairs of a text segment; a doubled delimiter is a literal one."""
    if not segment:
        return {}
    sep = segment[:1]
    body = segment[1:].replace(sep * 2, b"\0\0").split(sep)
    vals = [v.replace(b"\0\0", sep).decode("utf-8", "replace") for v in body]
    return {k.strip().upper(): v for k, v in zip(vals[0::2], vals[1::2], strict=False) if k.strip()}


HEAD = 58


@dataclass(frozen=True)
class Layout:
    """Where a file's events are and how they are written: kw, byte offset, number, row type and range masks of integers."""

    kw: dict
    begin: int
    n: int
    order: str
    codes: tuple[str, ...]
    masks: tuple[int, ...]

    @property
    def row(self) -> np.dtype:
        return np.dtype([(f"c{i}", self.order + c) for i, c in enumerate(self.codes)])

    def decode(self, data: bytes, columns: list[int] | None = None) -> np.ndarray:
        """Events x columns as doubles, of whole rows of bytes."""
        raw = np.frombuffer(data, self.row)
        pick = range(len(self.codes)) if columns is None else columns
        out = np.zeros((len(raw), len(pick)))
        for k, i in enumerate(pick):
            v = raw[f"c{i}"]
            out[:, k] = v.astype(np.uint64) & np.uint64(self.masks[i]) if self.masks[i] else v
        return out


def text_span(head: bytes) -> tuple[int, int]:
    """First byte of the text segment and the one after it."""
    if head[:3] != b"FCS":
        raise FcsError("no FCS file")
    at = lambda i: int(head[10 + 8 * i : 18 + 8 * i].strip() or 0)
    return at(0), at(1) + 1


def layout_of(head: bytes, text: bytes, size: int) -> Layout:
    """The layout of a file of size bytes; types F, D and I, either byte order."""
    kw = parse_text(text)
    at = lambda i: int(head[10 + 8 * i : 18 + 8 * i].strip() or 0)
    begin, end = at(2), at(3)
    if not begin or not end:  # offsets over 99,999,999 are in the text segment alone
        begin, end = int(kw.get("$BEGINDATA", 0)), int(kw.get("$ENDDATA", 0))
    par, tot = int(kw["$PAR"]), int(kw["$TOT"])
    kind = kw.get("$DATATYPE", "F").upper()
    bits = [int(kw.get(f"$P{i}B", 32)) for i in range(1, par + 1)]
    codes = {"F": ["f4"] * par, "D": ["f8"] * par, "I": [f"u{b // 8}" for b in bits]}.get(kind)
    if codes is None:
        raise FcsError(f"data type {kind}")
    masks = [0] * par
    if kind == "I":
        for i in range(par):
            top = int(float(kw.get(f"$P{i + 1}R", 0)))
            masks[i] = top - 1 if top > 1 and top & (top - 1) == 0 else 0
    width = sum(int(c[1:]) for c in codes)
    there = (min(end + 1, size) - begin) // width if width else 0
    return Layout(kw, begin, max(0, min(tot, there)), "<" if kw.get("$BYTEORD", "1,2,3,4").startswith("1") else ">", tuple(codes), tuple(masks))


def parse(data: bytes) -> tuple[dict[str, str], np.ndarray]:
    """Keywords and events x channels as doubles, of a whole file."""
    a, b = text_span(data)
    at = layout_of(data[:HEAD], data[a:b], len(data))
    return at.kw, at.decode(data[at.begin : at.begin + at.n * at.row.itemsize])


def start_of(channels: list[tuple[str, str]], n: int, top: list[float], keywords: dict[str, str] | None = None, kind: str = "F", big: bool = False) -> bytes:
    """What stands before the n events of a file: header and text; top: the largest value of each channel, whose range gets 2 % of head room."""
    kw = {"$DATATYPE": kind, "$MODE": "L", "$BYTEORD": "4,3,2,1" if big else "1,2,3,4", "$PAR": str(len(channels)), "$TOT": str(n), "$NEXTDATA": "0"}
    for i, (name, desc) in enumerate(channels, 1):
        kw |= {f"$P{i}N": name, f"$P{i}B": "64" if kind == "D" else "32", f"$P{i}E": "0,0", f"$P{i}R": str(1 << 32) if kind == "I" else str(int(max(1.0, top[i - 1] * 1.02)) + 1)}
        if desc:
            kw[f"$P{i}S"] = desc
    kw |= keywords or {}
    body = n * len(channels) * (8 if kind == "D" else 4)
    esc = lambda s: s.replace("|", "||")
    size = 0
    while True:
        begin = HEAD + size
        text = ("|" + "".join(f"{esc(k)}|{esc(v)}|" for k, v in (kw | {"$BEGINDATA": str(begin), "$ENDDATA": str(begin + body - 1)}).items())).encode()
        if len(text) == size:
            break
        size = len(text)
    field = lambda n: f"{n if n <= 99_999_999 else 0:>8}"
    fits = begin + body <= 99_999_999
    head = "FCS3.1    " + field(HEAD) + field(HEAD + size - 1) + field(begin if fits else 0) + field(begin + body - 1 if fits else 0) + field(0) + field(0)
    return head.encode() + text


def body_of(x: np.ndarray, kind: str = "F", big: bool = False) -> bytes:
    """Events as bytes; non-finite values become 0."""
    code = (">" if big else "<") + {"F": "f4", "D": "f8", "I": "u4"}[kind]
    return np.ascontiguousarray(np.where(np.isfinite(x), x, 0.0), code).tobytes()


def write(channels: list[tuple[str, str]], x: np.ndarray, keywords: dict[str, str] | None = None, kind: str = "F", big: bool = False) -> bytes:
    """An FCS 3.1 file of (name, description) channels."""
    clean = np.where(np.isfinite(x), x, 0.0)
    top = clean.max(0).tolist() if len(x) else [1.0] * len(channels)
    return start_of(channels, len(x), top, keywords, kind, big) + body_of(clean, kind, big)


def channels_of(kw: dict[str, str]) -> list[dict]:
    """Channels with symbol and role: scatter, time, or marker (area channels with a stain; the first of a symbol)."""
    out, seen = [], set()
    for i in range(1, int(kw["$PAR"]) + 1):
        name, desc = kw.get(f"$P{i}N", f"P{i}"), kw.get(f"$P{i}S", "").strip()
        symbol = (desc.split(" : ")[0].strip() or name) if desc else name
        role = "other"
        if SCATTER.match(name):
            role = "time" if name.lower().startswith("time") else "scatter"
        elif not re.search(r"-[hw]$", name, re.I) and symbol not in seen:
            role = "marker"
            seen.add(symbol)
        out.append({"idx": i - 1, "name": name, "desc": desc, "symbol": symbol, "role": role})
    return out


def spill_matrix(kw: dict[str, str]) -> tuple[list[str], list[list[float]]] | None:
    raw = kw.get("$SPILLOVER") or kw.get("SPILL") or kw.get("$SPILL")
    if not raw:
        return None
    v = raw.split(",")
    n = int(v[0])
    return (v[1 : n + 1], [list(map(float, v[n + 1 + i * n : n + 1 + (i + 1) * n])) for i in range(n)]) if len(v) == 1 + n + n * n else None


def systematic(n: int, cap: int) -> np.ndarray:
    """Evenly spaced positions, at most cap of n."""
    return np.arange(n) if cap <= 0 or n <= cap else np.unique(np.rint(np.linspace(1, n, cap)).astype(int)) - 1


def open_scan(spark: SparkSession, paths: list[str], markers: list[str], scatter: tuple[str, ...] = ("FSC-A", "FSC-H", "SSC-A"), max_events: int = 0, events_per_task: int = 500_000) -> DataFrame:
    """Wide events of files: file, event_index (the place in the file, from 1) and a column a channel, null where a file lacks it."""
    from gatefold.sources.fcs_source import FcsDataSource

    spark.dataSource.register(FcsDataSource)
    options = {"paths": json.dumps(paths), "columns": json.dumps([*scatter, *markers]), "maxEvents": str(max_events), "eventsPerTask": str(events_per_task)}
    return spark.read.format("fcs").options(**options).load()


def listed(spark: SparkSession, path: str | list[str]) -> list[str]:
    """The event files of a folder, by Spark's listing; a list of files as it is.  A cohort has as many as samples."""
    if not isinstance(path, str):
        return list(path)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.[fF][cC][sS]").load(path)
    return sorted(r["path"] for r in files.select("path").collect())


def scan(spark: SparkSession, path: str | list[str], markers: list[str], scatter: tuple[str, ...] = ("FSC-A", "FSC-H", "SSC-A"), max_events: int = 0) -> DataFrame:
    """open_scan() of a folder or a list of files; max_events are evenly spaced ones of each file."""
    return open_scan(spark, listed(spark, path), markers, scatter, max_events)


def headers(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """file, keywords map and channels of each file; only the text segments are read."""
    from gatefold.sources.fcs_source import layout_at

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("idx", pa.int32()), ("name", pa.string()), ("desc", pa.string()), ("symbol", pa.string()), ("role", pa.string())]))
        for b in it:
            for p in b.column(0).to_pylist():
                kw = layout_at(p).kw
                yield pa.record_batch([pa.array([p]), pa.array([list(kw.items())], pa.map_(pa.string(), pa.string())), pa.array([channels_of(kw)], kind)], ["file", "keywords", "channels"])

    files = spark.createDataFrame([(p,) for p in listed(spark, path)], "path string")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return files.repartition(tasks, "path").mapInArrow(run, "file string, keywords map<string,string>, channels array<struct<idx:int,name:string,desc:string,symbol:string,role:string>>")


def category_codes(df: DataFrame, column: str, out: str) -> tuple[DataFrame, DataFrame]:
    """df with sorted integer codes of a category (null: unassigned), and the legend."""
    level = F.coalesce(F.col(column).cast("string"), F.lit("unassigned"))
    legend = df.select(level.alias("level")).distinct()
    from pyspark.sql import Window

    legend = legend.withColumn("code", F.row_number().over(Window.orderBy("level")))  # one row a level
    return df.withColumn("_l", level).join(F.broadcast(legend), F.col("_l") == F.col("level")).withColumn(out, F.col("code").cast("double")).drop("_l", "level", "code"), legend


def export(df: DataFrame, by: str, columns: list[str]) -> DataFrame:
    """(group, fcs binary): one file a group in a cell, sorted by event_index where there is one.

    For groups that fit a cell; fcs_source.export_files() streams larger ones to files.
    """
    order = [c for c in ("event_index",) if c in df.columns]

    def run(t: pa.Table) -> pa.Table:
        if order:
            t = t.sort_by([(order[0], "ascending")])
        x = np.column_stack([t.column(c).to_numpy() for c in columns]).astype(float)
        return pa.table({"group": pa.array([str(t.column(by)[0].as_py())]), "fcs": pa.array([write([(c, "") for c in columns], x)], pa.binary())})

    return df.select(by, *order, *[F.col(c).cast("double").alias(c) for c in columns]).groupBy(by).applyInArrow(run, "group string, fcs binary")
