"""A Spark data source of FCS event files: event ranges in, whole files out.

Reading: the driver reads the header and text segment of every file and deals event ranges to tasks; a task reads the bytes of its
range in slices and decodes the wanted channels.  A cap takes evenly spaced events, and slices without any aren't read.

Writing: rows arrive sorted by file and order, so that a task streams a file at a time with one slice in memory.
The header of a file names its number of events and ranges, which one aggregation finds first.  Files are written under names of
the attempt and get their own when all tasks are done, so a task that runs again leaves nothing half done.

Paths are opened by Arrow's file systems (local and mounted folders, HDFS, S3, GCS, Azure).
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

from gatefold.sources.fcs import HEAD, Layout, body_of, channels_of, layout_of, start_of, systematic, text_span

#: Bytes that a reader holds at a time.
SLICE = 4 << 20


def at(path: str) -> tuple[arrow_fs.FileSystem, str]:
    """File system and path of a URI or a plain local path."""
    path = re.sub(r"^file:/+", "/", path)
    return (arrow_fs.LocalFileSystem(), path) if path.startswith("/") else arrow_fs.FileSystem.from_uri(path)


def layout_at(path: str) -> Layout:
    system, name = at(path)
    with system.open_input_file(name) as f:
        head = f.read(HEAD)
        a, b = text_span(head)
        f.seek(a)
        return layout_of(head, f.read(b - a), f.size())


@dataclass
class EventRange(InputPartition):
    path: str
    layout: Layout
    columns: list[int]  # place in the file of each wanted channel, -1 where it has none
    first: int
    last: int
    cap: int


class FcsReader(DataSourceReader):
    def __init__(self, options) -> None:
        self.paths, self.columns = json.loads(options["paths"]), json.loads(options["columns"])
        self.cap, self.step = int(options.get("maxEvents", 0)), max(1, int(options.get("eventsPerTask", 500_000)))

    def partitions(self) -> list[InputPartition]:
        with ThreadPoolExecutor(16) as pool:
            layouts = list(pool.map(layout_at, self.paths))
        out: list[InputPartition] = []
        for path, layout in zip(self.paths, layouts, strict=True):
            place: dict[str, int] = {}
            for c in reversed(channels_of(layout.kw)):
                place[c["name"]] = c["idx"]
            for c in channels_of(layout.kw):
                if c["role"] == "marker":
                    place[c["symbol"]] = c["idx"]
            columns = [place.get(c, -1) for c in self.columns]
            out += [EventRange(path, layout, columns, i, min(layout.n, i + self.step), self.cap) for i in range(0, layout.n, self.step)]
        return out or [EventRange("", Layout({}, 0, 0, "<", (), ()), [], 0, 0, 0)]

    def read(self, part: EventRange) -> Iterator[pa.RecordBatch]:
        if part.first >= part.last:
            return
        names = ["file", "event_index", *self.columns]
        size = part.layout.row.itemsize
        rows = max(1, SLICE // size)
        keep = systematic(part.layout.n, part.cap) if 0 < part.cap < part.layout.n else None
        real = [c for c in part.columns if c >= 0]
        system, name = at(part.path)
        with system.open_input_file(name) as f:
            for i in range(part.first, part.last, rows):
                j = min(part.last, i + rows)
                pick = None if keep is None else keep[np.searchsorted(keep, i) : np.searchsorted(keep, j)]
                if pick is not None and not len(pick):
                    continue
                f.seek(part.layout.begin + i * size)
                x = part.layout.decode(f.read((j - i) * size), real)
                index = np.arange(i, j)
                if pick is not None:
                    x, index = x[pick - i], pick
                place = {c: k for k, c in enumerate(real)}
                values = [pa.array(x[:, place[c]]) if c >= 0 else pa.nulls(len(index), pa.float64()) for c in part.columns]
                yield pa.record_batch([pa.repeat(pa.scalar(part.path), len(index)), pa.array(index + 1), *values], names)


@dataclass
class Written(WriterCommitMessage):
    files: list[tuple[str, str]]  # name of the attempt, final name


class FcsWriter(DataSourceArrowWriter):
    """options: path, channels and totals (name of a file: number of events and largest values)."""

    def __init__(self, options) -> None:
        self.root, self.channels, self.totals = options["path"].rstrip("/"), json.loads(options["channels"]), json.loads(options["totals"])

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        done: list[tuple[str, str]] = []
        stream, current = None, None
        for b in iterator:
            names = np.array(b.column(0).to_pylist(), object)
            x = np.column_stack([b.column(1 + i).to_numpy(zero_copy_only=False) for i in range(len(self.channels))]).astype(float)
            for i in [0, *(np.flatnonzero(names[1:] != names[:-1]) + 1).tolist()] if len(names) else []:
                if names[i] != current:
                    if stream:
                        stream.close()
                    current = names[i]
                    n, top = self.totals[current]
                    system, folder = at(self.root)
                    system.create_dir(folder, recursive=True)
                    staged = f"{folder}/.{uuid.uuid4().hex}.part"
                    stream = system.open_output_stream(staged)
                    stream.write(start_of([(c, "") for c in self.channels], n, top))
                    done.append((staged, f"{folder}/{current}.fcs"))
                j = i + 1
                while j < len(names) and names[j] == current:
                    j += 1
                stream.write(body_of(x[i:j]))
        if stream:
            stream.close()
        return Written(done)

    def commit(self, messages: list[Written | None]) -> None:
        system, _ = at(self.root)
        for m in messages:
            for staged, final in m.files if m else []:
                system.move(staged, final)

    def abort(self, messages: list[Written | None]) -> None:
        system, _ = at(self.root)
        for m in messages:
            for staged, _ in m.files if m else []:
                system.delete_file(staged)


class FcsDataSource(DataSource):
    """Format "fcs".  Reading: options paths and columns (JSON lists), maxEvents, eventsPerTask."""

    @classmethod
    def name(cls) -> str:
        return "fcs"

    def schema(self) -> str:
        return "file string, event_index long" + "".join(f", `{c}` double" for c in json.loads(self.options["columns"]))

    def reader(self, schema: StructType) -> FcsReader:
        return FcsReader(self.options)

    def writer(self, schema: StructType, overwrite: bool) -> FcsWriter:
        return FcsWriter(self.options)



def export_files(df: DataFrame, path: str, columns: list[str], by: list[str | None] = ("sample_id",), order: tuple[str, ...] = ("sample_id", "event_index")) -> None:
    """Files of df's rows in the folder path: one for each value of every column of by, None: one of all rows.

    A file is one task's work, however many rows it has; rows are sorted outside of memory and streamed.
    """
    spark = df.sparkSession
    spark.dataSource.register(FcsDataSource)
    for column in by:
        name = F.coalesce(F.col(column).cast("string"), F.lit("unassigned")) if column else F.lit("all")
        safe = F.regexp_replace(name, r"[^\w.+-]+", "_")
        rows = df.select(F.concat(F.lit(f"{column}_" if column else ""), safe).alias("_file"), *[F.col(c).cast("double").alias(c) for c in columns], *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order) if c in df.columns])
        good = [F.when(~F.isnan(c) & (F.abs(c) != float("inf")), F.col(c)) for c in columns]
        # one row a file
        totals = {r["_file"]: (r["n"], [r[f"m{i}"] if r[f"m{i}"] is not None else 1.0 for i in range(len(columns))]) for r in rows.groupBy("_file").agg(F.count(F.lit(1)).alias("n"), *[F.max(g).alias(f"m{i}") for i, g in enumerate(good)]).collect()}
        if not totals:
            continue
        keys = [c for c in rows.columns if c.startswith("_o")]
        dealt = rows.repartition(min(len(totals), 2000), "_file").sortWithinPartitions("_file", *keys).select("_file", *[F.coalesce(c, F.lit(float("nan"))).alias(c) for c in columns])
        dealt.write.format("fcs").mode("append").options(path=path, channels=json.dumps(columns), totals=json.dumps(totals)).save()
