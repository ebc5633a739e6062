"""Signatures against the sequential definition, links against all pairs."""

import random
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from siftlane.llm import minhash, registry

SF = "/root/testdata/sf0.001"


def plain_set(text, k):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or "")) if w]
    return frozenset(" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))) if words else frozenset()


def plain_components(rows, k, percent=80):
    """(doc_id, set size, least id reachable) of every row, from all pairs."""
    sets = [plain_set(t, k) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, len(s), least.get(find(i))) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=repr)


def found(docs, **options):
    return sorted((tuple(r) for r in minhash.near_duplicates(docs, **options).select("doc_id", "n_shingles", "component_id").collect()), key=repr)


def test_query_against_all_pairs(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = registry.op13_minhash(spark, SF).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == plain_components(rows, 4)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_sql_against_all_pairs():
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    rows = con.execute("SELECT doc_id, text FROM documents").fetchall()
    got = con.execute(registry.ORACLE_SQL["op13_minhash"]).fetchall()
    assert sorted((r[:3] for r in got), key=repr) == plain_components(rows, 4) and all(k == (i == c) for i, _, c, k in got)


EDGE = [(4, None), (3, ""), (7, " \n "), (None, "one two"), (9, "ONE two"), (9, "one two"), (1, "É a b c d"), (2, "é a b c d"), (5, "w " * 60_000), (6, "x" * 100_000), (None, None), (8, "x" * 100_000)]


@pytest.mark.parametrize("rows", [EDGE, [], [(None, None)]])
def test_edge_cases(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "1 as n", "2 as node", "'c' as component_id", "3 as bucket")
    assert found(docs, shingle=4) == plain_components(rows, 4)


def group(r, members, words, edits):
    base = [f"w{r.randrange(10**6)}" for _ in range(words)]
    for _ in range(members):
        own = list(base)
        for _ in range(edits):
            own[r.randrange(words)] = f"v{r.randrange(10**6)}"
        yield " ".join(own)


def test_large_groups_keep_every_link(spark):
    """Copies whose links are about as many as not, a passage that many share, and chains: with small buckets, cells and blocks."""
    r = random.Random(11)
    texts = [*group(r, 150, 90, 2), *group(r, 90, 60, 1), *group(r, 60, 200, 5)]
    passage = [f"p{i}" for i in range(40)]
    texts += [" ".join(passage + [f"q{r.randrange(10**6)}" for _ in range(r.randrange(2, 20))]) for _ in range(120)]
    chain = [f"c{i}" for i in range(150)]
    texts += [" ".join(chain[i : i + 60]) for i in range(0, 90, 5)]
    texts += texts[:100]
    rows = list(enumerate(r.sample(texts, len(texts))))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = plain_components(rows, 4)
    assert found(docs, shingle=4) == want
    assert found(docs, shingle=4, small=4, cell_rows=50, block_bytes=1 << 14, broadcast_rows=0) == want


def sequential(hashes, slots):
    """SuperMinHash one element after the other, with early stopping, as it is published."""
    one = lambda x: int(minhash.mixed(np.array([x % 2**64], np.uint64))[0])
    h = [None] * slots
    counts, a = [0] * (slots - 1) + [slots], slots - 1
    for e in hashes:
        p, j = list(range(slots)), 0
        while j <= a:
            x = one(int(e) + (j + 1) * int(minhash.GOLDEN))
            k = j + ((x & 0xFFFFFFFF) * (slots - j) >> 32)
            p[j], p[k] = p[k], p[j]
            value = (j, x >> 40)
            if h[p[j]] is None or value < h[p[j]]:
                before = slots - 1 if h[p[j]] is None else h[p[j]][0]
                h[p[j]] = value
                if j < before:
                    counts[before] -= 1
                    counts[j] += 1
                    while counts[a] == 0:
                        a -= 1
            j += 1
    return [v[0] << 24 | v[1] for v in h]


def test_signatures_match_the_sequential_definition():
    r = np.random.default_rng(4)
    sets = [np.unique(r.integers(0, 2**63, n).astype(np.uint64)) for n in (1, 2, 5, 40, 300)]
    bounds = np.r_[0, np.cumsum([len(s) for s in sets])]
    got = minhash.super_minhash(np.concatenate(sets), bounds, 32)
    assert got.tolist() == [sequential(s, 32) for s in sets]


def test_variance_is_below_that_of_independent_hashes():
    r = np.random.default_rng(9)
    off, n = [], 24
    for _ in range(400):
        pool = r.integers(0, 2**63, 2 * n).astype(np.uint64)
        a, b = pool[: n + n // 2], pool[n // 2 :]
        s = minhash.super_minhash(np.r_[a, b], np.array([0, len(a), len(a) + len(b)]), 32)
        off.append((s[0] == s[1]).mean() - n / (2 * n))
    assert abs(np.mean(off)) < 0.015 and np.var(off) < 0.8 * 0.25 / 32


def test_shingles_are_sets():
    hashes, bounds = minhash.shingle_sets(pa.array(["a b c d a b c d", "A B c", "", "a b c", "x"]), 4)
    rows = [hashes[i:j].tolist() for i, j in zip(bounds, bounds[1:])]
    assert [len(x) for x in rows] == [4, 1, 0, 1, 1] and rows[1] == rows[3]
    assert Counter(map(len, map(set, rows))) == Counter(map(len, rows))
