"""Packing: nothing lost, nothing over the edge, and close to the least cost."""

import random

import numpy as np
import pytest

from siftlane.llm import packing, registry
from siftlane.llm.common import vocabulary


def checked(rows, lengths, capacities):
    bins, tokens = {}, {}
    for r in rows:
        assert r.bin_capacity in capacities
        bins.setdefault((r.bin_id, r.bin_capacity), []).append((r.bin_offset, r.n_tokens))
        tokens.setdefault(r.doc_id, []).append((r.start, r.n_tokens))
    for (_, capacity), parts in bins.items():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= capacity and not any(at <= c < capacity for c in capacities)
    assert len({b for b, _ in bins}) == len(bins)
    got = {}
    for d, parts in tokens.items():
        got[d] = sum(n for _, n in parts)
    assert got == lengths
    return sum(c for _, c in bins)


@pytest.mark.parametrize("shard_pieces", [2048, 50])
def test_lengths(spark, shard_pieces):
    rng = random.Random(1)
    lengths = {i: rng.choice((1, 30, 100, 511, 512, 513, 2048, 2049, rng.randrange(1, 9000))) for i in range(500)}
    docs = spark.createDataFrame(list(lengths.items()), "doc_id long, n int").selectExpr("doc_id", "n", "1 as piece", "2 as shard")
    rows = packing.pack(docs, length_col="n", shard_pieces=shard_pieces).collect()
    cost = checked(rows, lengths, packing.CAPACITIES)
    assert sum(lengths.values()) >= 0.97 * cost


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, " a  b\n"), (4, "w " * 5000), (None, "x y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = packing.pack(docs).collect()
    checked(got, {1: 1, 2: 1, 3: 3, 4: 5001, None: 3}, packing.CAPACITIES)
    assert sorted((r.piece, r.start, r.n_tokens) for r in got if r.doc_id == 4) == [(0, 0, 2048), (1, 2048, 2048), (2, 4096, 905)]
    twice = packing.pack(docs.unionByName(docs)).collect()
    assert len(twice) == 2 * len(got)
    assert packing.pack(docs.where("false")).count() == 0
    assert [r.n_tokens for r in packing.pack(spark.createDataFrame([(1, None), (2, -5)], "doc_id long, n int"), length_col="n").collect()] == [1, 1]


def test_sizes_are_chosen_together():
    cost = lambda final: sum(final) + 16 * len(final)
    where, place, final = packing.pack_shard(np.array([500] * 4), (512, 1024, 2048), 16)
    assert sorted(final) == [2048]
    _, _, final = packing.pack_shard(np.array([1000, 1000, 500]), (512, 1024, 2048), 16)
    assert cost(final) <= 512 + 2048 + 32
    _, _, final = packing.pack_shard(np.array([40]), (512, 1024, 2048), 16)
    assert final == [512]
    rng = np.random.default_rng(5)
    for _ in range(20):
        lengths = -np.sort(-rng.integers(1, 2049, 300))
        _, _, final = packing.pack_shard(lengths, (512, 1024, 2048), 16)
        one = packing.fill(lengths, (2048,), 16)[2]
        assert cost(final) <= sum(2048 + 16 for _ in one)


def partitions(n):
    """All ways to deal n pieces into groups."""
    if not n:
        yield []
        return
    for rest in partitions(n - 1):
        yield [*rest, [n - 1]]
        for i in range(len(rest)):
            yield [*rest[:i], [*rest[i], n - 1], *rest[i + 1 :]]


def test_close_to_the_optimum_of_all_partitions():
    sizes, overhead, ratios = (512, 1024, 2048), 16, []
    rng = np.random.default_rng(9)
    for _ in range(40):
        lengths = -np.sort(-rng.integers(1, 2049, int(rng.integers(1, 8))))
        best = min(
            sum(min(c for c in sizes if c >= total) + overhead for total in totals)
            for p in partitions(len(lengths))
            if max(totals := [int(lengths[g].sum()) for g in p]) <= max(sizes)
        )
        _, _, final = packing.pack_shard(lengths, sizes, overhead)
        ratios.append((sum(final) + overhead * len(final)) / best)
    assert min(ratios) >= 1 and max(ratios) <= 1.35 and np.mean(ratios) <= 1.03


def laid_back(rows):
    """Each document's ids from the sequences."""
    out = {}
    for r in rows:
        assert r.bin_capacity in packing.CAPACITIES and len(r.ids) == r.n_tokens == sum(r.lengths) <= r.bin_capacity
        assert not any(r.n_tokens <= c < r.bin_capacity for c in packing.CAPACITIES)
        at = 0
        for d, piece, start, n in zip(r.doc_ids, r.pieces, r.starts, r.lengths):
            assert start == piece * max(packing.CAPACITIES)
            out.setdefault(d, {}).setdefault(start, []).append(list(r.ids[at : at + n]))
            at += n
    assert len({r.bin_id for r in rows}) == len(rows)
    return out


def test_query(spark):
    from tokenizers import Tokenizer

    sf = "/root/testdata/sf0.001"
    tokenizer = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    want = {r.doc_id: [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 1] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = laid_back(registry.op3_packing(spark, sf).collect())
    assert {d: sum((p[0] for _, p in sorted(x.items())), []) for d, x in got.items()} == want


def test_token_edges(spark):
    rows = [(1, None), (2, ""), (3, " a  b"), (4, "word " * 5000), (4, "word " * 5000), (None, "x y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as row", "2 as ids")
    got = laid_back(packing.pack_tokens(docs, vocabulary("word_bpe_49k.json")).collect())
    assert got[1] == got[2] == {0: [[1]]} and len(got[None][0][0]) == 3
    assert [len(x) for _, x in sorted(got[4].items())] == [2, 2, 2] and got[4][4096][0][-1] == 1
    assert packing.pack_tokens(docs.where("false"), vocabulary("word_bpe_49k.json")).count() == 0
