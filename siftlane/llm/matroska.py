"""Matroska media columns: a binary column of files is parsed into packet tables, and bytes are stored as audio.

Reading follows the format itself: elements are an identifier and a size, both of variable length, a
size of all ones being unknown (such an element ends where a sibling of its parent begins).
Clusters give times, blocks and simple blocks give packets, with the three kinds of lacing (Xiph,
EBML, fixed size); track entries give codecs and default durations, cues the index. Of each packet:
track, time in nanoseconds, cluster, byte range in the file, whether it is a key frame, and how it was laced.

Storing takes a payload of 8-bit samples: one track of PCM, FRAME samples to a packet, several
packets laced into a block, blocks into clusters of at most half a minute (block times are 16-bit
milliseconds from their cluster's), and a cue for each cluster.

A file is a row, and each file is read by itself in one task; rows of a batch are independent.
Nulls: a null file has no packets and no error. What can't be parsed gives the packets before the fault
and an error text; bytes that are no Matroska file give an error alone. An empty payload gives a file
without clusters. Equal payloads give equal files.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from siftlane.llm.common import slices, whole_text

#: Identifiers of the format's elements.
EBML, DOC_TYPE, SEGMENT, INFO, TIMESTAMP_SCALE, DURATION = 0x1A45DFA3, 0x4282, 0x18538067, 0x1549A966, 0x2AD7B1, 0x4489
TRACKS, TRACK_ENTRY, TRACK_NUMBER, TRACK_UID, TRACK_TYPE, CODEC, DEFAULT_DURATION = 0x1654AE6B, 0xAE, 0xD7, 0x73C5, 0x83, 0x86, 0x23E383
AUDIO, RATE, CHANNELS, BIT_DEPTH = 0xE1, 0xB5, 0x9F, 0x6264
CLUSTER, TIMESTAMP, SIMPLE_BLOCK, BLOCK_GROUP, BLOCK, REFERENCE = 0x1F43B675, 0xE7, 0xA3, 0xA0, 0xA1, 0xFB
CUES, CUE_POINT, CUE_TIME, CUE_POSITIONS, CUE_TRACK, CUE_CLUSTER = 0x1C53BB6B, 0xBB, 0xB3, 0xB7, 0xF7, 0xF1
MASTERS = {SEGMENT, INFO, TRACKS, TRACK_ENTRY, AUDIO, CLUSTER, BLOCK_GROUP, CUES, CUE_POINT, CUE_POSITIONS}
TOP_LEVEL = {INFO, TRACKS, CLUSTER, CUES, 0x114D9B74, 0x1941A469, 0x1043A770, 0x1254C367}
LACINGS = ("none", "xiph", "fixed", "ebml")

SAMPLE_RATE, FRAME, FRAMES_A_BLOCK, BLOCKS_A_CLUSTER = 8000, 256, 8, 64
SLICE_BYTES = 8 << 20


def vint(n: int, length: int | None = None) -> bytes:
    """A size of variable length."""
    length = length or next(k for k in range(1, 9) if n < (1 << 7 * k) - 1)
    return (n | 1 << 7 * length).to_bytes(length, "big")


def element(ident: int, *parts: bytes) -> bytes:
    body = b"".join(parts)
    return ident.to_bytes((ident.bit_length() + 7) // 8, "big") + vint(len(body)) + body


def uint(ident: int, n: int) -> bytes:
    return element(ident, n.to_bytes(max(1, (n.bit_length() + 7) // 8), "big"))


def laced(frames: list[bytes], kind: str) -> bytes:
    """Frames behind each other, with what the lacing says of their sizes before them."""
    if kind == "none":
        return frames[0]
    head, sizes = bytes([len(frames) - 1]), [len(f) for f in frames]
    if kind == "xiph":
        head += b"".join(b"\xff" * (n // 255) + bytes([n % 255]) for n in sizes[:-1])
    elif kind == "ebml":
        head += vint(sizes[0])
        for a, b in zip(sizes, sizes[1:-1]):
            length = next(k for k in range(1, 9) if abs(b - a) < (1 << 7 * k - 1) - 1)
            head += vint(b - a + (1 << 7 * length - 1) - 1, length)
    return head + b"".join(frames)


def block(frames: list[bytes], time: int, track: int = 1, key: bool = True, kind: str | None = None, ident: int = SIMPLE_BLOCK) -> bytes:
    """A block; unless told, frames of one size are laced as such and others by differences."""
    kind = kind or ("none" if len(frames) == 1 else "fixed" if len({len(f) for f in frames}) == 1 else "ebml")
    flags = (0x80 if key and ident == SIMPLE_BLOCK else 0) | LACINGS.index(kind) << 1
    return element(ident, vint(track) + struct.pack(">hB", time, flags), laced(frames, kind))


def stored(payload: bytes) -> bytes:
    """A file whose packets hold the payload."""
    frames = [payload[i : i + FRAME] for i in range(0, len(payload), FRAME)]
    ms = 1000 * FRAME // SAMPLE_RATE
    head = element(EBML, element(DOC_TYPE, b"matroska"))
    info = element(INFO, uint(TIMESTAMP_SCALE, 1_000_000), element(DURATION, struct.pack(">d", 1000 * len(payload) / SAMPLE_RATE)))
    audio = element(AUDIO, element(RATE, struct.pack(">d", SAMPLE_RATE)), uint(CHANNELS, 1), uint(BIT_DEPTH, 8))
    tracks = element(TRACKS, element(TRACK_ENTRY, uint(TRACK_NUMBER, 1), uint(TRACK_UID, 1), uint(TRACK_TYPE, 2), element(CODEC, b"A_PCM/INT/LIT"), uint(DEFAULT_DURATION, ms * 1_000_000), audio))
    parts, at, cues = [info, tracks], len(info) + len(tracks), []
    step = FRAMES_A_BLOCK * BLOCKS_A_CLUSTER
    for i in range(0, len(frames), step):
        own = [block(frames[j : min(j + FRAMES_A_BLOCK, i + step)], (j - i) * ms) for j in range(i, min(i + step, len(frames)), FRAMES_A_BLOCK)]
        cues.append(element(CUE_POINT, uint(CUE_TIME, i * ms), element(CUE_POSITIONS, uint(CUE_TRACK, 1), uint(CUE_CLUSTER, at))))
        parts.append(element(CLUSTER, uint(TIMESTAMP, i * ms), *own))
        at += len(parts[-1])
    return head + element(SEGMENT, *parts, *([element(CUES, *cues)] if cues else []))


@dataclass
class Packet:
    track: int
    time_ns: int
    cluster: int
    offset: int
    size: int
    key: bool
    lacing: str


@dataclass
class Parsed:
    """What a file holds."""

    tracks: dict[int, dict] = field(default_factory=dict)
    packets: list[Packet] = field(default_factory=list)
    cues: list[tuple[int, int, int]] = field(default_factory=list)
    clusters: int = 0
    blocks: int = 0
    duration_ms: float = 0.0
    error: str | None = None


def read_vint(data: bytes, at: int, end: int, marker: bool) -> tuple[int, int, bool]:
    """(number, next place, whether all its bits are ones); identifiers keep their marker."""
    if at >= end or not data[at]:
        raise ValueError(f"no number of variable length at {at}")
    length = 9 - data[at].bit_length()
    if at + length > end:
        raise ValueError(f"the number at {at} is cut off")
    n = int.from_bytes(data[at : at + length], "big")
    plain = n & ((1 << 7 * length) - 1)
    return (n if marker else plain), at + length, plain == (1 << 7 * length) - 1


def frame_sizes(data: bytes, at: int, end: int, kind: int) -> tuple[list[int], int]:
    """Sizes of a block's frames, and where the first begins."""
    if kind == 0:
        return [end - at], at
    if at >= end:
        raise ValueError(f"the lacing at {at} is cut off")
    n, at = data[at] + 1, at + 1
    if kind == 2:
        if (end - at) % n:
            raise ValueError(f"{end - at} bytes aren't {n} frames of one size")
        return [(end - at) // n] * n, at
    sizes: list[int] = []
    for i in range(n - 1):
        if kind == 1:
            size = 0
            while True:
                if at >= end:
                    raise ValueError(f"the lacing at {at} is cut off")
                size, at = size + data[at], at + 1
                if data[at - 1] < 255:
                    break
        else:
            start = at
            number, at, _ = read_vint(data, at, end, False)
            size = number if i == 0 else sizes[-1] + number - ((1 << 7 * (at - start) - 1) - 1)
        sizes.append(size)
    sizes.append(end - at - sum(sizes))
    if min(sizes) < 0:
        raise ValueError(f"the frames of the block before {end} don't fit in it")
    return sizes, at


#: Numbers of files beyond these bounds are faults, as are elements nested deeper: no real file has them, and tables hold them no more.
MOST_TRACK, MOST_TIME, MOST_SCALE, MOST_DEPTH = 2**31 - 1, 2**40, 2**32, 64


def bounded(number: int, most: int, what: str, at: int) -> int:
    if number > most:
        raise ValueError(f"the {what} at {at} is out of bounds")
    return number


@dataclass
class Level:
    """A master element that is being read: where it ends, and what its children have said."""

    ident: int
    end: int
    unknown: bool
    record: dict = field(default_factory=dict)


class Reader:
    """Reads elements one after another; open masters are a list, so nesting costs no calls."""

    def __init__(self, data: bytes):
        self.data, self.out = data, Parsed()
        self.scale, self.now = 1_000_000, 0

    def frames(self, at: int, end: int, key: bool | None) -> None:
        """The packets of a block."""
        data, out, start = self.data, self.out, at
        track, at, _ = read_vint(data, at, end, False)
        bounded(track, MOST_TRACK, "track number", start)
        if at + 3 > end:
            raise ValueError(f"the block at {at} is cut off")
        time, flags = struct.unpack(">hB", data[at : at + 3])
        kind = flags >> 1 & 3
        sizes, at = frame_sizes(data, at + 3, end, kind)
        step = out.tracks.get(track, {}).get("default_duration", 0)
        first = max(-(2**62), min(2**62, (self.now + time) * self.scale))
        out.blocks += 1
        for i, size in enumerate(sizes):
            out.packets.append(Packet(track, first + i * step, out.clusters - 1, at, size, bool(flags & 0x80) if key is None else key, LACINGS[kind]))
            at += size

    def closed(self, level: Level, parent: Level) -> None:
        """What a master says once it is read."""
        own, out = level.record, self.out
        if level.ident == TRACK_ENTRY:
            out.tracks[own.get("number", 0)] = own
        elif level.ident == AUDIO:
            parent.record.update(own)
        elif level.ident == CUE_POSITIONS:
            out.cues.append((min(2**62, parent.record.get("time", 0) * self.scale), own.get("track", 0), own.get("position", 0)))
        elif level.ident == BLOCK_GROUP and "block" in own:
            self.frames(*own["block"], key=not own.get("references"))

    def value(self, ident: int, at: int, stop: int, inside: Level) -> None:
        """An element that is no master."""
        data, record = self.data, inside.record
        number = int.from_bytes(data[at:stop], "big") if stop - at <= 8 else 0
        if ident == SIMPLE_BLOCK:
            self.frames(at, stop, None)
        elif ident == BLOCK:
            record["block"] = (at, stop)
        elif ident == REFERENCE:
            record["references"] = 1
        elif ident == TIMESTAMP and inside.ident == CLUSTER:
            self.now = bounded(number, MOST_TIME, "cluster's time", at)
        elif ident == TIMESTAMP_SCALE:
            self.scale = bounded(number, MOST_SCALE, "time scale", at)
        elif ident == DURATION and stop - at in (4, 8):
            duration = struct.unpack(">d" if stop - at == 8 else ">f", data[at:stop])[0] * self.scale / 1e6
            self.out.duration_ms = duration if np.isfinite(duration) else 0.0
        elif ident == CODEC:
            record["codec"] = data[at:stop].decode("ascii", "replace")
        elif ident in NUMBERS:
            name = NUMBERS[ident]
            most = {"number": MOST_TRACK, "track": MOST_TRACK, "time": MOST_TIME, "default_duration": MOST_TIME}.get(name, 2**62)
            record[name] = bounded(number, most, name.replace("_", " "), at)

    def read(self) -> None:
        data = self.data
        ident, at, _ = read_vint(data, 0, len(data), True)
        if ident != EBML:
            raise ValueError("it doesn't begin as an EBML file")
        size, at, _ = read_vint(data, at, len(data), False)
        if at + size > len(data):
            raise ValueError("its head is cut off")
        at += size
        levels = [Level(0, len(data), True)]
        while levels:
            level = levels[-1]
            if at >= level.end:
                levels.pop()
                if levels:
                    self.closed(level, levels[-1])
                continue
            start = at
            ident, at, _ = read_vint(data, at, level.end, True)
            if (level.ident == CLUSTER and ident in TOP_LEVEL) or (level.ident and ident in (EBML, SEGMENT)):
                if not level.unknown:
                    raise ValueError(f"the element at {start} stands inside another that can't hold it")
                at = start  # an element of unknown size ends here
                levels.pop()
                self.closed(level, levels[-1])
                continue
            size, at, unknown = read_vint(data, at, level.end, False)
            stop = level.end if unknown else at + size
            if stop > level.end:
                raise ValueError(f"the element at {start} is longer than what holds it")
            if unknown and ident not in (SEGMENT, CLUSTER):
                raise ValueError(f"the element at {start} has no size")
            if ident in MASTERS:
                if len(levels) > MOST_DEPTH:
                    raise ValueError(f"the element at {start} is nested too deep")
                if ident == CLUSTER:
                    self.out.clusters += 1
                    self.now = 0
                levels.append(Level(ident, stop, unknown))
            else:
                self.value(ident, at, stop, level)
                at = stop


def parse(data: bytes) -> Parsed:
    """The packet table of a file; of a faulty one what stands before the fault, and the fault."""
    reader = Reader(data)
    try:
        reader.read()
    except ValueError as fault:
        reader.out.error = str(fault)
    return reader.out


NUMBERS = {TRACK_NUMBER: "number", TRACK_TYPE: "type", DEFAULT_DURATION: "default_duration", CHANNELS: "channels", BIT_DEPTH: "bit_depth", CUE_TIME: "time", CUE_TRACK: "track", CUE_CLUSTER: "position"}


def padded(text: bytes) -> bytes:
    """Bytes 0 behind, up to a positive multiple of 64."""
    return text + bytes(-len(text) % 64 or (0 if text else 64))


def store_texts(docs: DataFrame, *, text_col: str = "text", media_col: str = "media") -> DataFrame:
    """docs without the text, with its padded UTF-8 bytes as a file in media_col."""
    kept = [c for c in docs.columns if c not in (text_col, media_col)]
    work = docs.select(*kept, whole_text(text_col).alias("__text"))
    schema = docs.select(*kept).schema.add(media_col, "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, "__text", SLICE_BYTES):
                files = [stored(padded(t)) for t in rows["__text"].cast(pa.binary()).to_pylist()]
                yield pa.RecordBatch.from_arrays([*(rows[c] for c in kept), pa.array(files, pa.binary())], names=schema.fieldNames())

    return work.mapInArrow(run, schema)


def exploded(files: DataFrame, media_col: str, columns: dict[str, str], rows_of) -> DataFrame:
    """The rows that rows_of makes of each parsed file: the file's other columns, then columns, then media_error. A file
    without rows has none here unless it has an error."""
    new = {**columns, "media_error": "string"}
    kept = [c for c in files.columns if c != media_col and c not in new]
    schema = files.select(*kept).schema
    for name, kind in new.items():
        schema = schema.add(name, kind)
    arrow = {"integer": pa.int32(), "long": pa.int64(), "boolean": pa.bool_(), "string": pa.string()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, media_col, SLICE_BYTES):
                owner, made = [], []
                for i, data in enumerate(rows[media_col].to_pylist()):
                    got = parse(data) if data is not None else Parsed()
                    own = [(*x, got.error) for x in rows_of(got)] or ([(None,) * len(columns) + (got.error,)] if got.error else [])
                    owner += [i] * len(own)
                    made += own
                left = rows.take(pa.array(owner, pa.int64()))
                yield pa.RecordBatch.from_arrays([*(left[c] for c in kept), *(pa.array([m[k] for m in made], arrow[t]) for k, t in enumerate(new.values()))], names=schema.fieldNames())

    return files.select(*kept, media_col).mapInArrow(run, schema)


def packets(files: DataFrame, *, media_col: str = "media") -> DataFrame:
    """A row for each packet of each file, with its place in the file in bytes."""
    columns = {"track": "integer", "time_ns": "long", "cluster": "integer", "packet": "integer", "offset": "long", "size": "long", "key_frame": "boolean", "lacing": "string"}
    return exploded(files, media_col, columns, lambda got: [(p.track, p.time_ns, p.cluster, n, p.offset, p.size, p.key, p.lacing) for n, p in enumerate(got.packets)])


def tracks(files: DataFrame, *, media_col: str = "media") -> DataFrame:
    """A row for each track of each file; missing numbers are null."""
    columns = {"track": "integer", "track_type": "long", "codec": "string", "default_duration_ns": "long", "channels": "long", "bit_depth": "long"}
    return exploded(files, media_col, columns, lambda got: [(n, *(t.get(k) for k in ("type", "codec", "default_duration", "channels", "bit_depth"))) for n, t in sorted(got.tracks.items())])


def cues(files: DataFrame, *, media_col: str = "media") -> DataFrame:
    """A row for each cue of each file: the time and track, and the cluster's place from the segment's first byte."""
    columns = {"cue": "integer", "time_ns": "long", "track": "integer", "cluster_position": "long"}
    return exploded(files, media_col, columns, lambda got: [(i, *c) for i, c in enumerate(got.cues)])


def facts(data: bytes) -> dict:
    """A stored file's payload read back through its packets, and what there is to say of it."""
    got = parse(data)
    payload = b"".join(data[p.offset : p.offset + p.size] for p in got.packets)
    x = np.frombuffer(payload, dtype=np.uint8).astype(np.float64) - 128
    crossings = int(np.count_nonzero(np.diff(np.signbit(x)))) if len(x) else 0
    tone = f"mean={x.mean():.4f};rms={np.sqrt((x * x).mean()):.4f};crossings={crossings}" if len(x) else "mean=0;rms=0;crossings=0"
    kinds = ",".join(k for k in LACINGS if any(p.lacing == k for p in got.packets))
    whole = f"tracks={len(got.tracks)};clusters={got.clusters};blocks={got.blocks};packets={len(got.packets)};cues={len(got.cues)};lacing={kinds};duration_ms={got.duration_ms:.3f}"
    return {
        "payload_bytes": len(payload),
        "payload_sha256": hashlib.sha256(payload).hexdigest(),
        "tail_crc32": zlib.crc32(payload[-64:]),
        "media_bytes": len(data),
        "media_sha256": hashlib.sha256(data).hexdigest(),
        "feature": f"{whole};{tone}",
        "media_error": got.error,
    }


def file_facts(files: DataFrame, *, media_col: str = "media") -> DataFrame:
    """files without media_col, with payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature, media_error."""
    new = {"payload_bytes": "long", "payload_sha256": "string", "tail_crc32": "long", "media_bytes": "long", "media_sha256": "string", "feature": "string", "media_error": "string"}
    kept = [c for c in files.columns if c != media_col and c not in new]
    schema = files.select(*kept).schema
    for name, kind in new.items():
        schema = schema.add(name, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, media_col, SLICE_BYTES):
                made = [facts(d) if d is not None else {} for d in rows[media_col].to_pylist()]
                own = [pa.array([m.get(k) for m in made], pa.int64() if kind == "long" else pa.string()) for k, kind in new.items()]
                yield pa.RecordBatch.from_arrays([*(rows[c] for c in kept), *own], names=schema.fieldNames())

    return files.select(*kept, media_col).mapInArrow(run, schema)
