"""Matroska media columns: a writer of 8-bit PCM audio tracks and a parser into packet tables.

The parser walks variable-length EBML elements (known and unknown sizes), reads info, tracks, clusters
with SimpleBlocks and BlockGroups, undoes all four lacings (none, Xiph, fixed, EBML) and reads cues.
Every packet comes out with its track, timestamp, byte range in the file and key-frame flag.

Defined results: null or empty media has no packets; bytes that are no Matroska file, or elements that
run past the end, raise MediaError in parse(), and packet_table() returns one row for such a file with
the message in `error` and nulls elsewhere.  A file is parsed from one binary value, so files are bounded by
Spark's 2 GB cell; texts of any smaller length are written whole.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from gatefold.llm.common import table, text_parts

#: Element ids of the public Matroska specification (fixed values).
EBML, SEGMENT, INFO, TRACKS, CLUSTER, CUES = 0x1A45DFA3, 0x18538067, 0x1549A966, 0x1654AE6B, 0x1F43B675, 0x1C53BB6B
SCALE, DURATION, MUXER, WRITER = 0x2AD7B1, 0x4489, 0x4D80, 0x5741
TRACK, NUMBER, UID, KIND, CODEC, LACING, AUDIO, RATE, CHANNELS, DEPTH = 0xAE, 0xD7, 0x73C5, 0x83, 0x86, 0x9C, 0xE1, 0xB5, 0x9F, 0x6264
TIME, SIMPLE, GROUP, BLOCK, BLOCK_DURATION, REFERENCE = 0xE7, 0xA3, 0xA0, 0xA1, 0x9B, 0xFB
CUE, CUE_TIME, CUE_AT, CUE_TRACK, CUE_CLUSTER = 0xBB, 0xB3, 0xB7, 0xF7, 0xF1
DOCTYPE = 0x4282
TOP = {EBML, SEGMENT, INFO, TRACKS, CLUSTER, CUES, 0x114D9B74, 0x1254C367, 0x1043A770, 0x1941A469}

#: One frame: 192 samples at 48 kHz, 4 ms.  Eight frames a block, 128 blocks a cluster.
FRAME, SAMPLE_RATE, FRAME_MS, LACED, BLOCKS = 192, 48_000, 4, 8, 128


class MediaError(ValueError):
    pass


# ---------------------------------------------------------------- writing
def ebml_id(i: int) -> bytes:
    return i.to_bytes((i.bit_length() + 7) // 8, "big")


def ebml_size(n: int, width: int | None = None) -> bytes:
    """The length n as a variable-length integer; all ones is kept for 'unknown'."""
    width = width or next(w for w in range(1, 9) if n < (1 << (7 * w)) - 1)
    return (n | (1 << (7 * width))).to_bytes(width, "big")


def element(i: int, body: bytes) -> bytes:
    return ebml_id(i) + ebml_size(len(body)) + body


def unsigned(i: int, n: int) -> bytes:
    return element(i, n.to_bytes(max(1, (n.bit_length() + 7) // 8), "big"))


def lace(frames: list[bytes], kind: str) -> tuple[int, bytes]:
    """Flag bits and body of a block with these frames."""
    if kind == "none" or len(frames) == 1 and kind != "xiph":
        if len(frames) != 1:
            raise ValueError("several frames need a lacing")
        return 0, frames[0]
    sizes, head = [len(f) for f in frames], bytes([len(frames) - 1])
    if kind == "fixed":
        if len(set(sizes)) > 1:
            raise ValueError("fixed lacing needs equal sizes")
        return 4, head + b"".join(frames)
    if kind == "xiph":
        return 2, head + b"".join(b"\xff" * (s // 255) + bytes([s % 255]) for s in sizes[:-1]) + b"".join(frames)
    out = head + ebml_size(sizes[0])
    for a, b in zip(sizes, sizes[1:-1], strict=False):
        d = b - a
        w = next(w for w in range(1, 9) if abs(d) < 1 << (7 * w - 1))
        out += ebml_size(d + (1 << (7 * w - 1)) - 1, w)
    return 6, out + b"".join(frames)


def block(track: int, relative: int, frames: list[bytes], kind: str, key: bool = True, simple: bool = True) -> bytes:
    bits, body = lace(frames, kind)
    data = ebml_size(track) + struct.pack(">hB", relative, bits | (0x80 if key and simple else 0)) + body
    return element(SIMPLE, data) if simple else element(GROUP, element(BLOCK, data) + (b"" if key else element(REFERENCE, b"\xff")))


HEAD = element(EBML, unsigned(0x4286, 1) + unsigned(0x42F7, 1) + unsigned(0x42F2, 4) + unsigned(0x42F3, 8) + element(DOCTYPE, b"matroska") + unsigned(0x4287, 4) + unsigned(0x4285, 2))
TRACK_BODY = element(TRACKS, element(TRACK, unsigned(NUMBER, 1) + unsigned(UID, 1) + unsigned(KIND, 2) + unsigned(LACING, 1) + element(CODEC, b"A_PCM/INT/LIT") + element(AUDIO, element(RATE, struct.pack(">d", SAMPLE_RATE)) + unsigned(CHANNELS, 1) + unsigned(DEPTH, 8))))


def write(payload: bytes) -> bytes:
    """An 8-bit mono PCM file of the payload, whose length is a positive multiple of FRAME."""
    if not payload or len(payload) % FRAME:
        raise ValueError("the payload must be whole frames")
    n = len(payload) // FRAME
    info = element(INFO, unsigned(SCALE, 1_000_000) + element(DURATION, struct.pack(">d", n * FRAME_MS)) + element(MUXER, b"gatefold") + element(WRITER, b"gatefold"))
    body, cues, at = [info, TRACK_BODY], [], len(info) + len(TRACK_BODY)
    lead = ebml_size(1)
    full = ebml_id(SIMPLE) + ebml_size(5 + LACED * FRAME) + lead
    for first in range(0, n, LACED * BLOCKS):
        parts = [unsigned(TIME, first * FRAME_MS)]
        for k in range(first, min(n, first + LACED * BLOCKS), LACED):
            data = payload[k * FRAME : (k + LACED) * FRAME]
            if len(data) == LACED * FRAME:  # block() with fixed lacing, for the usual case
                parts += (full, struct.pack(">hBB", (k - first) * FRAME_MS, 0x84, LACED - 1), data)
            else:
                frames = [data[i : i + FRAME] for i in range(0, len(data), FRAME)]
                parts.append(block(1, (k - first) * FRAME_MS, frames, "ebml" if len(frames) > 1 else "none"))
        cluster = element(CLUSTER, b"".join(parts))
        cues.append(element(CUE, unsigned(CUE_TIME, first * FRAME_MS) + element(CUE_AT, unsigned(CUE_TRACK, 1) + unsigned(CUE_CLUSTER, at))))
        body.append(cluster)
        at += len(cluster)
    return HEAD + element(SEGMENT, b"".join([*body, element(CUES, b"".join(cues))]))


# ---------------------------------------------------------------- parsing
@dataclass
class Media:
    doctype: str = ""
    scale: int = 1_000_000
    duration: float = 0.0
    tracks: dict[int, dict] = field(default_factory=dict)
    clusters: int = 0
    blocks: int = 0
    #: (track, timestamp ns, offset, size, key frame, cluster) of every frame
    packets: list[tuple[int, int, int, int, bool, int]] = field(default_factory=list)
    #: (time ns, track, cluster position in the file)
    cues: list[tuple[int, int, int]] = field(default_factory=list)


def read_vint(d: bytes, at: int, keep: bool) -> tuple[int, int, bool]:
    """Value, next offset and whether all value bits are ones; keep: with the marker bit, as ids are."""
    if at >= len(d) or not d[at]:
        raise MediaError(f"no variable-length integer at {at}")
    w = 9 - d[at].bit_length()
    if at + w > len(d):
        raise MediaError(f"cut off at {at}")
    v = int.from_bytes(d[at : at + w], "big")
    bare = v & ((1 << (7 * w)) - 1)
    return (v if keep else bare), at + w, bare == (1 << (7 * w)) - 1


def children(d: bytes, at: int, end: int, parent: int = 0) -> Iterator[tuple[int, int, int]]:
    """(id, start, end) of the elements in d[at:end]; one of unknown size ends before the next element that can't be in it."""
    while at < end:
        i, at, _ = read_vint(d, at, True)
        n, at, open_end = read_vint(d, at, False)
        if open_end:
            stop = end if i == SEGMENT else _open_end(d, at, end, i)
        else:
            stop = at + n
        if stop > end:
            raise MediaError(f"element {i:X} runs past {end}")
        yield i, at, stop
        at = stop


def _open_end(d: bytes, at: int, end: int, inside: int) -> int:
    while at < end:
        i, p, _ = read_vint(d, at, True)
        if i in TOP:
            return at
        n, p, more = read_vint(d, p, False)
        if more:
            raise MediaError(f"element of unknown size in {inside:X}")
        at = p + n
    return min(at, end)


def _uint(d: bytes, a: int, b: int) -> int:
    return int.from_bytes(d[a:b], "big")


def _float(d: bytes, a: int, b: int) -> float:
    return struct.unpack(">f" if b - a == 4 else ">d", d[a:b])[0] if b > a else 0.0


def frame_sizes(d: bytes, at: int, end: int, kind: int) -> tuple[int, list[int]]:
    """Offset of the first frame and the sizes of all frames of a block body."""
    if not kind:
        return at, [end - at]
    if at >= end:
        raise MediaError("a lace without a head")
    n, at = d[at] + 1, at + 1
    if kind == 2:
        if (end - at) % n:
            raise MediaError("fixed lacing doesn't divide the block")
        return at, [(end - at) // n] * n
    sizes: list[int] = []
    if kind == 1:
        for _ in range(n - 1):
            s = 0
            while True:
                if at >= end:
                    raise MediaError("a lace head without an end")
                s, at = s + d[at], at + 1
                if d[at - 1] != 255:
                    break
            sizes.append(s)
    elif n > 1:
        s, at, _ = read_vint(d, at, False)
        sizes.append(s)
        for _ in range(n - 2):
            start = at
            v, at, _ = read_vint(d, at, False)
            s += v - ((1 << (7 * (at - start) - 1)) - 1)
            sizes.append(s)
    last = end - at - sum(sizes)
    if last < 0 or min(sizes, default=0) < 0:
        raise MediaError("a lace is longer than its block")
    return at, [*sizes, last]


def _block(d: bytes, at: int, end: int, out: Media, base: int, key: bool | None) -> None:
    track, at, _ = read_vint(d, at, False)
    if at + 3 > end:
        raise MediaError("a block without a head")
    relative, flags = struct.unpack_from(">hB", d, at)
    at, sizes = frame_sizes(d, at + 3, end, (flags >> 1) & 3)
    when = (base + relative) * out.scale
    step = out.tracks.get(track, {}).get("frame_ns", 0)
    key = bool(flags & 0x80) if key is None else key
    out.blocks += 1
    k = out.clusters - 1
    for s in sizes:
        out.packets.append((track, when, at, s, key, k))
        at, when = at + s, when + step


def parse(d: bytes) -> Media:
    out = Media()
    top = list(children(d, 0, len(d)))
    if not top or top[0][0] != EBML:
        raise MediaError("no EBML head")
    for i, a, b in top:
        if i == EBML:
            for j, p, q in children(d, a, b):
                if j == DOCTYPE:
                    out.doctype = d[p:q].rstrip(b"\0").decode("ascii", "replace")
        elif i == SEGMENT:
            _segment(d, a, b, out)
    return out


def _segment(d: bytes, start: int, end: int, out: Media) -> None:
    for i, a, b in children(d, start, end):
        if i == INFO:
            for j, p, q in children(d, a, b):
                if j == SCALE:
                    out.scale = _uint(d, p, q)
                elif j == DURATION:
                    out.duration = _float(d, p, q)
        elif i == TRACKS:
            for j, p, q in children(d, a, b):
                if j == TRACK:
                    _track(d, p, q, out)
        elif i == CLUSTER:
            out.clusters += 1
            base = 0
            for j, p, q in children(d, a, b):
                if j == SIMPLE:
                    _block(d, p, q, out, base, None)
                elif j == TIME:
                    base = _uint(d, p, q)
                elif j == GROUP:
                    inner = list(children(d, p, q))
                    key = all(x[0] != REFERENCE for x in inner)
                    for g, r, s in inner:
                        if g == BLOCK:
                            _block(d, r, s, out, base, key)
        elif i == CUES:
            for j, p, q in children(d, a, b):
                if j == CUE:
                    _cue(d, p, q, start, out)


def _track(d: bytes, start: int, end: int, out: Media) -> None:
    t: dict = {"number": 0, "kind": 0, "codec": "", "rate": 8000.0, "channels": 1, "depth": 0}
    for i, a, b in children(d, start, end):
        if i == NUMBER:
            t["number"] = _uint(d, a, b)
        elif i == KIND:
            t["kind"] = _uint(d, a, b)
        elif i == CODEC:
            t["codec"] = d[a:b].decode("ascii", "replace")
        elif i == 0x23E383:  # DefaultDuration
            t["frame_ns"] = _uint(d, a, b)
        elif i == AUDIO:
            for j, p, q in children(d, a, b):
                if j == RATE:
                    t["rate"] = _float(d, p, q)
                elif j == CHANNELS:
                    t["channels"] = _uint(d, p, q)
                elif j == DEPTH:
                    t["depth"] = _uint(d, p, q)
    if "frame_ns" not in t and t["codec"].startswith("A_PCM") and t["depth"]:
        t["frame_ns"] = round(1e9 * FRAME / t["rate"])
    out.tracks[t["number"]] = t


def _cue(d: bytes, start: int, end: int, segment: int, out: Media) -> None:
    when, places = 0, []
    for i, a, b in children(d, start, end):
        if i == CUE_TIME:
            when = _uint(d, a, b)
        elif i == CUE_AT:
            at = {j: _uint(d, p, q) for j, p, q in children(d, a, b)}
            places.append((at.get(CUE_TRACK, 0), segment + at.get(CUE_CLUSTER, 0)))
    out.cues += [(when * out.scale, t, p) for t, p in places]


# ---------------------------------------------------------------- columns
PACKET = "track int, packet long, timestamp_ns long, offset long, size long, keyframe boolean, cluster int, error string"


def packet_table(df: DataFrame, key: str, media: str) -> DataFrame:
    """One row a packet of the media column, with the key."""
    names = ["key", *(x.split()[0] for x in PACKET.split(", "))]
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.string()]

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for r, d in enumerate(b.column(1).to_pylist()):
                if not d:
                    continue
                try:
                    p = parse(d).packets
                    cols = [[x[0] for x in p], list(range(len(p))), *([x[k] for x in p] for k in range(1, 6)), [None] * len(p)]
                except MediaError as e:
                    cols = [[None]] * 7 + [[str(e)]]
                for s in range(0, len(cols[0]), 50_000):
                    part = [pa.array(c[s : s + 50_000], t) for c, t in zip(cols, kinds, strict=True)]
                    yield pa.record_batch([pa.repeat(b.column(0)[r], len(part[0])), *part], names)

    return df.select(key, media).mapInArrow(run, f"key {dict(df.dtypes)[key]}, {PACKET}")


def pad(text: bytes) -> bytes:
    return text + b" " * (-len(text) % FRAME if text else FRAME)


def feature(m: Media, payload: bytes) -> str:
    x = np.frombuffer(payload, np.uint8).astype(np.int64)
    flips = int(np.count_nonzero(np.diff(x >= 128)))
    return f"{m.doctype};tracks={len(m.tracks)};clusters={m.clusters};blocks={m.blocks};packets={len(m.packets)};cues={len(m.cues)};ms={m.duration:.0f};sum={int(x.sum())};energy={int((x * x).sum())};flips={flips}"


def media_round_trip(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Write each text as a file, read the file's packets back and describe both."""
    names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for i, j, texts, b in ((*x, b) for b in it for x in text_parts(b, 1)):
            rows = []
            for t in texts:
                media = write(pad(t))
                m = parse(media)
                back = b"".join([media[o : o + s] for _, _, o, s, _, _ in m.packets])
                rows.append((len(t), len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-16:]), len(media), hashlib.sha256(media).hexdigest(), feature(m, back)))
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.record_batch([b.column(0)[i:j], *(pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds))], names)

    return docs.select(doc_id, text).mapInArrow(run, f"doc_id {dict(docs.dtypes)[doc_id]}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")


def text_media(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and media binary: the padded text as a Matroska file."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for i, j, texts in text_parts(b, 1):
                yield pa.record_batch([b.column(0)[i:j], pa.array([write(pad(t)) for t in texts], pa.binary())], ["doc_id", "media"])

    return docs.select(doc_id, text).mapInArrow(run, f"doc_id {dict(docs.dtypes)[doc_id]}, media binary")


def op2_matroska(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_round_trip(table(spark, sf_dir, "documents"))
