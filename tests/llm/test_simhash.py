"""Fingerprints and components against plain ones over all pairs."""

import random
import re

import numpy as np
import pytest
import xxhash

from siftlane.llm import registry, simhash

SF = "/root/testdata/sf0.001"


def plain_fingerprint(text, k):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or "")) if w]
    runs = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(ids, prints, radius):
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [least.get(find(i)) for i in range(len(ids))]


def test_query_against_all_pairs(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    prints = [plain_fingerprint(r.text, 4) for r in docs]
    names = plain_components([r.doc_id for r in docs], prints, 4)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in registry.op10_simhash(spark, SF).collect()}
    assert got == {r.doc_id: (f"{p:016x}", c) for r, p, c in zip(docs, prints, names)}


EDGE = [(4, None), (3, ""), (7, " \n "), (None, "one two"), (9, "ONE two"), (9, "one two"), (1, "É a b c d"), (2, "é a b c d"), (5, "w " * 60_000), (6, "x" * 100_000)]


@pytest.mark.parametrize("rows", [EDGE, [], [(None, None)]])
def test_edge_cases(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "1 as fingerprint", "'c' as component")
    got = simhash.near_duplicates(docs, shingle=4, radius=4, segment_bits=2)
    prints = [plain_fingerprint(t, 4) for _, t in rows]
    want = list(zip([i for i, _ in rows], prints, plain_components([i for i, _ in rows], prints, 4)))
    assert sorted(map(repr, ((r.doc_id, r.fingerprint % (1 << 64), r.component_id) for r in got.collect()))) == sorted(map(repr, want))


@pytest.mark.parametrize(("radius", "segment_bits", "agree", "cell_rows"), [(4, 2, 1, 16384), (4, 2, 3, 16384), (4, 2, 1, 40), (3, 4, 2, 7), (6, 1, 2, 16384), (12, 2, 2, 100)])
def test_links_lose_nothing(spark, radius, segment_bits, agree, cell_rows):
    rng = random.Random(radius * 10 + agree)
    prints = set()
    for _ in range(12):
        centre = rng.getrandbits(64)
        for _ in range(rng.choice((1, 5, 60))):
            prints.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(radius + 2))))
    prints = sorted(prints)
    nodes = spark.createDataFrame([(simhash.signed(p),) for p in prints], "fingerprint long")
    links = simhash.near_links(nodes, radius=radius, segment_bits=segment_bits, agree=agree, cell_rows=cell_rows).collect()
    pairs = [(r.src % (1 << 64), r.dst % (1 << 64)) for r in links]
    assert len(pairs) == len(set(pairs))
    from siftlane.operators.components import connected_components

    made = {r.node % (1 << 64): r.component for r in connected_components(spark.createDataFrame([(simhash.signed(a), simhash.signed(b)) for a, b in pairs] or [], "src long, dst long")).collect()}
    want = plain_components(list(range(len(prints))), prints, radius)
    part = dict(zip(prints, want))
    assert all(part[a] == part[b] for a, b in pairs)
    assert [len({made.get(p, p) for p, c in zip(prints, want) if c == k}) for k in sorted(set(want))] == [1] * len(set(want))


def test_manhattan_never_exceeds_hamming():
    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 1 << 63, 2000, dtype=np.uint64), rng.integers(0, 1 << 63, 2000, dtype=np.uint64)
    for bits in (1, 2, 4, 8):
        assert (np.bitwise_count(simhash.unary(a, bits) ^ simhash.unary(b, bits)) <= np.bitwise_count(a ^ b)).all()


def test_embedding_column_is_unary(spark):
    from pyspark.sql import functions as F

    rng = np.random.default_rng(4)
    a = rng.integers(-(1 << 63), (1 << 63) - 1, 50)
    df = spark.createDataFrame([(int(x),) for x in a], "f long")
    for bits in (1, 2, 4):
        got = [r[0] for r in df.select(simhash.embedding(F.col("f"), bits)).collect()]
        assert got == simhash.unary(a.view(np.uint64), bits).view(np.int64).tolist()


def test_dense_cells_give_stars():
    """Near copies without number: one link for each member of a cell, whatever the number of their pairs."""
    rng = np.random.default_rng(5)
    links = simhash.Links(4, 2, 1)
    fps = np.unique(np.uint64(rng.integers(0, 1 << 63)) ^ (np.uint64(1) << rng.integers(20, 64, 3000).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(20, 64, 3000).astype(np.uint64)))
    n = len(fps)
    one, two = links.of(np.zeros(n, np.int64), fps[None], np.zeros(n, np.int32))
    assert n > 500 and len(one) == n - 1 and set(one) == {0}


def jaccard(a, b):
    return len(a & b) / len(a | b) if a or b else 1.0


def edited(rng, words, changes):
    own = list(words)
    for _ in range(changes):
        own[rng.randrange(len(own))] = "".join(rng.choice("klmnopqr") for _ in range(7))
    return own


@pytest.mark.parametrize("cell_rows", [1 << 16, 60])
def test_near_copies_are_found_and_nothing_else(spark, cell_rows):
    """Against exact Jaccard over all pairs: every drop is due to links of 0.8 or more, and few such links are lost."""
    rng = random.Random(11)
    rows = []
    for g in range(60):
        base = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(3, 9))) for _ in range(rng.choice((60, 200, 500)))]
        for k in range(120 if g == 0 else rng.choice((1, 2, 5))):
            rows.append((g * 1000 + k, " ".join(edited(rng, base, rng.randrange(0, 1 + len(base) // 25)))))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    keyed = docs.withColumn("k", docs.doc_id)
    got = {r.key: r.kept_key for r in simhash.near_copies(keyed, "k", cell_rows=cell_rows).collect()}
    sets = {i: set(simhash.shingle_hashes(t, 5).tolist()) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links = [(a, b) for a in sets for b in sets if a < b and a // 1000 == b // 1000 and jaccard(sets[a], sets[b]) >= 0.8]
    for a, b in links:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    assert len(links) > 300 and all(find(i) == find(got[i]) and got[i] <= i for i in sets)
    assert sum(got[a] == got[b] for a, b in links) >= 0.97 * len(links)
