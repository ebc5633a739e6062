"""The trie against a plain dictionary of prefixes, and the query against its SQL."""

import hashlib
import random
import re
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from siftlane.llm import prefix_trie, registry

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string, depth int, least int, l string, words string"


def plain(seqs):
    """The nodes of {conv_id: [(role, text), ...]}, from all prefixes."""
    members, ends = {}, {}
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members.setdefault(tuple(s[:d]), []).append(c)
        ends.setdefault(tuple(s), []).append(c)
    kids, leaves, saved = {}, {}, {}
    for p in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        leaves[p] = leaves.get(p, 0) or 1
        saved[p] = saved.get(p, 0) + (len(members[p]) - 1) * words
        if p:
            kids[p[:-1]] = kids.get(p[:-1], 0) + 1
            leaves[p[:-1]] = leaves.get(p[:-1], 0) + leaves[p]
            saved[p[:-1]] = saved.get(p[:-1], 0) + saved[p]
    out = []
    for p, m in members.items():
        digest = hashlib.sha256(",".join(map(str, sorted(ends.get(p, [])))).encode()).hexdigest()
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), kids.get(p, 0), leaves[p], saved[p], digest))
    return sorted(out, key=repr)


def ordered(rows):
    own = {}
    for c, t, r, x in rows:
        if c is not None:
            own.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    return {c: [x[2:] for x in sorted(v)] for c, v in own.items()}


def rebuilt(seqs):
    out = {}
    for c, s in seqs.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = seqs.get(c - c % 20, [])[:h] + s[h:]
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, 0, 0, "x", "y") for r in rows], SCHEMA)


def nodes(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def conversations(r, n, words, most):
    for c in range(n):
        for t in range(r.randrange(1, most)):
            yield c, t, r.choice(["user", "assistant"]), " ".join(r.choice(words) for _ in range(r.randrange(3)))


@pytest.mark.parametrize("blocks", [1, 3, 16])
def test_against_prefixes(spark, blocks):
    r = random.Random(blocks)
    rows = list(conversations(r, 300, ["a", "b c"], 7)) + [(1000 + k, t, "user", f"long {t}") for k in range(5) for t in range(60 + 3 * k)]
    rows += [(2000 + k, t, "user", f"same {t}") for k in range(200) for t in range(3)]  # one common conversation
    want = plain(ordered(rows))
    assert nodes(prefix_trie.trie(prefix_trie.sequences(frame(spark, rows)), blocks=blocks)) == want


def test_every_interval_of_a_comb(spark):
    """Nested intervals that all blocks see from both sides."""
    rows = [(k, t, "u", str(t if t < min(k, 40 - k) else (t, k))) for k in range(41) for t in range(min(k, 40 - k) + 2)]
    assert nodes(prefix_trie.trie(prefix_trie.sequences(frame(spark, rows)), blocks=12)) == plain(ordered(rows))


EDGE = [(3, None, None, None), (3, 1, "user", "x y"), (3, 1, "user", "x y"), (4, 0, "", ""), (4, 1, "user", "x y"), (4, 1, "user", "x y"), (None, 1, "user", "lost"), (25, 5, "user", "w " * 50_000), (20, 5, "user", "h\x0b1"), (20, 7, "u", None)]


@pytest.mark.parametrize("rows", [EDGE, [], [(None, 1, "a", "b")], [(7, 0, "user", "only one")]])
def test_edge_cases(spark, rows):
    found = prefix_trie.with_shared_heads(prefix_trie.sequences(frame(spark, rows)))
    assert nodes(prefix_trie.trie(found)) == plain(rebuilt(ordered(rows)))


def test_conversations_without_turns_end_at_the_root(spark):
    found = prefix_trie.sequences(frame(spark, [(1, 0, "u", "a"), (2, 0, "u", "b c"), (3, 0, "u", "a")]))
    found = found.withColumn("turns", F.when(F.col("conv_id") == 2, F.slice("turns", 1, 0)).otherwise(F.col("turns")))
    assert nodes(prefix_trie.trie(found)) == plain({1: [("u", "a")], 2: [], 3: [("u", "a")]})


def test_digest_of_many_ids(spark):
    ids = spark.range(30_000).selectExpr("id * 3 as conv_id", "unhex('00ff') as seq").unionByName(spark.range(5).selectExpr("id as conv_id", "unhex('01') as seq"))
    got = {bytes(r.seq): r.ends for r in prefix_trie.id_digests(ids, 5).collect()}
    assert got == {b"\x00\xff": hashlib.sha256(",".join(str(i * 3) for i in range(30_000)).encode()).hexdigest(), b"\x01": hashlib.sha256(b"0,1,2,3,4").hexdigest()}


def test_query_against_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    want = con.execute(registry.ORACLE_SQL["op11_prefix_trie"])
    names = [d[0] for d in want.description]
    got = [tuple(r[n] for n in names) for r in registry.op11_prefix_trie(spark, SF).collect()]
    assert sorted(got, key=repr) == sorted(want.fetchall(), key=repr)
    rows = spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    assert len(got) == len(plain(rebuilt(ordered(map(tuple, rows)))))
