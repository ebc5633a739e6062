"""Files stored and read back, and files built by hand."""

import hashlib
import random
import struct
import zlib

import pytest

from siftlane.llm import matroska as m
from siftlane.llm import registry

ROWS = [(1, None), (2, ""), (3, "x"), (4, "é" * 32), (5, "y" * 64), (5, "y" * 64), (None, "z" * 65), (6, "long 🙂 text " * 40_000)]


def payload_of(text):
    data = (text or "").encode()
    return data + bytes(64 - len(data) % 64 if len(data) % 64 or not data else 0)


@pytest.mark.parametrize("rows", [ROWS, []])
def test_round_trip(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "1 as track", "'e' as feature")
    files = m.store_texts(docs)
    assert files.columns == ["doc_id", "track", "feature", "media"]
    got = m.file_facts(files).collect()
    want = [(i, len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:])) for i, p in ((i, payload_of(t)) for i, t in rows)]
    assert [(r.doc_id, r.payload_bytes, r.payload_sha256, r.tail_crc32) for r in got] == want
    assert all(r.media_error is None and r.media_bytes > r.payload_bytes for r in got)
    table = m.packets(files).collect()
    media = [bytes(r.media) for r in files.collect()]
    if rows:
        assert "".join(media[-1][r.offset : r.offset + r.size].decode("latin1") for r in table if r.doc_id == 6) == payload_of(rows[-1][1]).decode("latin1")
        times = [r.time_ns for r in table if r.doc_id == 6]
        assert times == [i * 32_000_000 for i in range(len(times))] and {r.cluster for r in table if r.doc_id == 6} == set(range(-(-len(times) // 512)))


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in registry.op1_matroska(spark, sf).collect()}
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        p, g = payload_of(r.text), got[r.doc_id]
        assert (g.n_bytes, g.payload_bytes, g.payload_sha256, g.tail_crc32) == (len((r.text or "").encode()), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:]))


@pytest.mark.parametrize("kind", ["none", "xiph", "fixed", "ebml"])
@pytest.mark.parametrize("unknown", [False, True])
def test_lacing_and_unknown_sizes(kind, unknown):
    rng = random.Random(1)
    frames = [rng.randbytes(n) for n in ([700] if kind == "none" else [300] * 4 if kind == "fixed" else [255, 510, 3, 1000, 0, 40_000, 7])]
    entry = m.element(m.TRACK_ENTRY, m.uint(m.TRACK_NUMBER, 3), m.uint(m.TRACK_TYPE, 1), m.element(m.CODEC, b"V_TEST"), m.uint(m.DEFAULT_DURATION, 40_000_000))
    group = m.element(m.BLOCK_GROUP, m.block(frames, -20, track=3, kind=kind, ident=m.BLOCK), m.element(m.REFERENCE, b"\xff"))
    body = m.uint(m.TIMESTAMP, 500) + m.block(frames, 7, track=3, kind=kind) + m.element(0xEC, bytes(9)) + group
    cues = m.element(m.CUES, m.element(m.CUE_POINT, m.uint(m.CUE_TIME, 500), m.element(m.CUE_POSITIONS, m.uint(m.CUE_TRACK, 3), m.uint(m.CUE_CLUSTER, 99))))
    size = b"\x01" + b"\xff" * 7
    ident = m.CLUSTER.to_bytes(4, "big")
    clusters = (ident + size + body) * 2 if unknown else m.element(m.CLUSTER, body) * 2
    inner = m.element(m.INFO, m.uint(m.TIMESTAMP_SCALE, 500_000), m.element(m.DURATION, struct.pack(">f", 10))) + m.element(m.TRACKS, entry) + clusters + cues
    data = m.element(m.EBML, m.element(m.DOC_TYPE, b"webm")) + (m.SEGMENT.to_bytes(4, "big") + size + inner if unknown else m.element(m.SEGMENT, inner))
    got = m.parse(data)
    assert got.error is None and got.clusters == 2 and got.blocks == 4 and got.duration_ms == 5
    assert [data[p.offset : p.offset + p.size] for p in got.packets] == frames * 4
    n = len(frames)
    assert [p.time_ns for p in got.packets[:n]] == [507 * 500_000 + i * 40_000_000 for i in range(n)]
    assert [p.time_ns for p in got.packets[n : 2 * n]] == [480 * 500_000 + i * 40_000_000 for i in range(n)]
    assert [p.key for p in got.packets] == ([True] * n + [False] * n) * 2 and {p.lacing for p in got.packets} == {kind} and got.packets[-1].cluster == 1
    assert got.cues == [(250_000_000, 3, 99)] and got.tracks[3]["codec"] == "V_TEST"


def test_faults_are_told(spark):
    whole = m.stored(b"abc" * 1000)
    assert m.parse(b"").error and m.parse(b"no file at all").error and m.parse(bytes(50)).error
    for cut in range(1, len(whole), 37):
        m.parse(whole[:cut])
    rng = random.Random(4)
    fuzzed = []
    for i in range(300):
        bad = bytearray(whole)
        for _ in range(rng.choice((1, 4))):
            bad[rng.randrange(60, 400)] = rng.randrange(256)
        fuzzed.append((i, bytes(bad)))
    files = spark.createDataFrame(fuzzed, "id long, media binary")
    for table_of in (m.packets, m.tracks, m.cues, m.file_facts):
        assert table_of(files).count() >= 0 and table_of(files).collect() is not None
    rows = [(1, None), (2, b"junk"), (3, bytes(whole)), (4, bytes(whole[:-900]))]
    table = m.packets(spark.createDataFrame(rows, "id long, media binary")).collect()
    assert {r.id for r in table} == {2, 3} | ({4} if any(r.id == 4 for r in table) else set()) and all(r.media_error for r in table if r.id == 2)


def wrapped(*parts):
    return m.element(m.EBML, m.element(m.DOC_TYPE, b"webm")) + m.element(m.SEGMENT, *parts)


def nested(n):
    out = b""
    for _ in range(n):
        out = m.element(m.BLOCK_GROUP, out)
    return out


def test_hostile_files_end_in_an_error_not_a_failed_task(spark):
    block = lambda track: m.element(m.SIMPLE_BLOCK, m.vint(track, 8) + b"\0\0\x80" + b"abc")
    bad = {
        "deep": wrapped(nested(1500)),
        "track": wrapped(m.element(m.CLUSTER, m.uint(m.TIMESTAMP, 1), block(1), block(1 << 40))),
        "time": wrapped(m.element(m.CLUSTER, m.uint(m.TIMESTAMP, 1 << 63), block(1))),
        "scale": wrapped(m.element(m.INFO, m.uint(m.TIMESTAMP_SCALE, (1 << 64) - 1)), m.element(m.CLUSTER, m.uint(m.TIMESTAMP, 5), block(1))),
        "cue": wrapped(m.element(m.CUES, m.element(m.CUE_POINT, m.uint(m.CUE_TIME, 1 << 50), m.element(m.CUE_POSITIONS, m.uint(m.CUE_CLUSTER, 1))))),
    }
    files = spark.createDataFrame(list(bad.items()), "name string, media binary")
    table = m.packets(files).collect()
    assert {r.name for r in table} == set(bad) and all(r.media_error for r in table)
    assert [(r.offset is not None, r.size) for r in table if r.name == "track"] == [(True, 3)]
    assert m.tracks(files).count() == m.cues(files).count() == m.file_facts(files).count() == len(bad)


def test_track_and_cue_tables(spark):
    rows = [(1, m.stored(b"abc" * 100_000)), (2, None), (3, m.stored(b""))]
    files = spark.createDataFrame(rows, "id long, media binary").selectExpr("*", "9 as cue", "'x' as codec")
    tracks = m.tracks(files)
    assert tracks.columns == ["id", "cue", "track", "track_type", "codec", "default_duration_ns", "channels", "bit_depth", "media_error"]
    assert [(r.id, r.cue, r.track, r.codec, r.default_duration_ns, r.bit_depth) for r in tracks.collect()] == [(i, 9, 1, "A_PCM/INT/LIT", 32_000_000, 8) for i in (1, 3)]
    cues = m.cues(files).collect()
    assert [(r.id, r.cue, r.time_ns, r.track) for r in cues] == [(1, i, i * 512 * 32_000_000, 1) for i in range(3)]
    segment = rows[0][1].index(m.SEGMENT.to_bytes(4, "big")) + 4
    at = segment + m.read_vint(rows[0][1], segment, len(rows[0][1]), False)[1] - segment
    assert all(rows[0][1][at + r.cluster_position :].startswith(m.CLUSTER.to_bytes(4, "big")) for r in cues)
