"""Exact verification of candidates, shared by the near-duplicate operators.

Nodes are distinct sets of shingles, with a sketch of 64-bit columns k0, k1, ... and a bound that says by sizes and sketches whether two can
reach the similarity. Candidates come as pairs, and for groups of many as members of a bucket:

1. Pairs are compared on whole sets, and linked nodes joined into components.
2. In buckets the candidate pairs of nodes that are still in different components are compared where they lie: only nodes that
   have such a partner (a row for each, never the pairs) get their sets, a bucket of many bytes is cut into blocks of which each
   two meet in a task of their own, and only links that connect come back.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftlane.llm.common import checkpointed, slices, words_of
from siftlane.operators.components import FEW_ROWS, connected_components, joined_by_key, united

SLICE_BYTES = 2 << 20
#: Bytes of sets and rows in a block of a bucket.
BLOCK_BYTES, BLOCK_ROWS = 4 << 20, 1 << 11
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64 bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def chained(parts: list[np.ndarray]) -> np.ndarray:
    """One hash of several in order."""
    out = parts[0]
    for x in parts[1:]:
        out = mixed(out + GOLDEN) ^ x
    return mixed(out + GOLDEN)


def shingle_sets(texts: pa.Array, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of each text's runs of words, ascending, all texts back to back, and the texts' bounds."""
    words, index, bounds = words_of(pc.ascii_lower(texts))
    hashed = np.fromiter((xxhash.xxh64_intdigest(w, 42) for w in words), np.uint64, len(words))[index]
    counts = np.diff(bounds)
    runs = np.maximum(counts - shingle + 1, 0)
    owner = np.repeat(np.arange(len(counts)), runs)
    at = np.arange(runs.sum()) + np.repeat(bounds[:-1] - (np.cumsum(runs) - runs), runs)
    made = chained([hashed[at + k] for k in range(shingle)])
    short = np.flatnonzero((counts > 0) & (counts < shingle))
    whole = [chained([hashed[i : i + 1] for i in range(bounds[r], bounds[r + 1])])[0] for r in short]
    owner, made = np.r_[owner, short], np.r_[made, np.array(whole, np.uint64)]
    order = np.argsort(made)
    order = order[np.argsort(owner[order].astype(np.uint16 if len(counts) < 1 << 16 else np.int64), kind="stable")]
    owner, made = owner[order], made[order]
    first = np.r_[True, (made[1:] != made[:-1]) | (owner[1:] != owner[:-1])][: len(made)]
    owner, made = owner[first], made[first]
    return made, np.r_[0, np.cumsum(np.bincount(owner, minlength=len(counts)))].astype(np.int64)


def set_digests(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of each set."""
    sums = []
    for salt in (1, 2):
        total = np.r_[np.zeros(1, np.uint64), np.cumsum(mixed(hashes ^ np.uint64(salt * int(GOLDEN) % 2**64)))]
        sums.append(total[bounds[1:]] - total[bounds[:-1]])
    return sums[0], sums[1]


def stars(one: np.ndarray, two: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of connected rows with the least row of their part, in place of links between them."""
    part = np.arange(n)
    while len(one):
        least = np.minimum(part[one], part[two])
        before = part.copy()
        np.minimum.at(part, one, least)
        np.minimum.at(part, two, least)
        part = part[part]
        if (part == before).all():
            break
    member = np.flatnonzero(part != np.arange(n))
    return part[member], member


def without_keys(docs: DataFrame, keys: DataFrame, key: str, broadcast_rows: int, how: str = "left_anti") -> DataFrame:
    """docs without the rows of some keys (or with these alone); the keys, 8 bytes each, are broadcast if they are no more than
    broadcast_rows, else both sides are shuffled."""
    return docs.join(F.broadcast(keys) if keys.count() <= broadcast_rows else keys, key, how)


def similar(pairs: DataFrame, sets: DataFrame, similarity: float, a_task: int = 256) -> DataFrame:
    """The pairs (a, b) whose sets reach the Jaccard similarity. A set that stands in many pairs is dealt out, a copy for about
    a_task of them, so a hub's pairs are no task of their own."""
    rows = pairs.count()
    degrees = pairs.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("n"))
    degrees = checkpointed(degrees.withColumn("copies", F.ceil(F.col("n") / a_task).cast("int")))
    dealt = sets.join(degrees, "node").select("node", "shingles", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"))
    work = pairs
    for end, other in (("a", "b"), ("b", "a")):
        of = degrees.select(F.col("node").alias(end), "n", "copies")
        work = joined_by_key(work, of, end, "n", rows, few=FEW_ROWS).drop("n").withColumn(f"copy_{end}", F.pmod(F.xxhash64(other), "copies").cast("int")).drop("copies")
    for end in ("a", "b"):
        work = work.join(dealt.select(F.col("node").alias(end), F.col("copy").alias(f"copy_{end}"), F.col("shingles").alias(f"set_{end}")), [end, f"copy_{end}"])
    both = F.size(F.array_intersect("set_a", "set_b"))
    return work.where(both >= similarity * (F.size("set_a") + F.size("set_b") - both) - 1e-9).select("a", "b")


def whole_buckets(batches: Iterator[pa.RecordBatch], done: Callable, most: int, over: Callable | None = None) -> Iterator[pa.RecordBatch]:
    """``done`` of runs of whole buckets of rows sorted by the column bucket; rows of a bucket of more than ``most`` rows go to ``over``."""
    held: pa.Table | None = None
    large = None
    for batch in batches:
        rows = pa.table(batch) if not isinstance(batch, pa.Table) else batch
        if large is not None:
            same = np.asarray(rows["bucket"]) == large
            if same.any():
                yield from over(rows.filter(pa.array(same)))
                rows = rows.filter(pa.array(~same))
            if not rows.num_rows:
                continue
            large = None
        rows = pa.concat_tables([held, rows]) if held is not None else rows
        if not rows.num_rows:
            continue
        keys = np.asarray(rows["bucket"])
        last = int(np.searchsorted(keys, keys[-1]))
        if last:
            yield from done(rows.slice(0, last))
        held = rows.slice(last)
        if over is not None and held.num_rows > most:
            large = keys[-1]
            yield from over(held)
            held = None
    if held is not None and held.num_rows:
        yield from done(held)


def arrays(rows: pa.Table) -> tuple[dict, np.ndarray, np.ndarray]:
    """Columns of nodes as arrays, and the starts and sizes of the buckets."""
    own = {c: np.asarray(rows[c]) for c in rows.column_names if c not in ("k0", "k1", "k2", "shingles")}
    own["sketch"] = [np.asarray(rows[c]).view(np.uint64) for c in rows.column_names if c in ("k0", "k1", "k2")]
    starts = np.flatnonzero(np.r_[True, own["bucket"][1:] != own["bucket"][:-1]])
    return own, starts, np.diff(np.r_[starts, len(own["bucket"])])


def pivot_of(sketch: list[np.ndarray], at: np.ndarray) -> int:
    """The row of a bucket whose sketch is nearest to what most rows have."""
    far = np.zeros(len(at), np.int64)
    for k in sketch:
        bits = np.unpackbits(np.ascontiguousarray(k[at]).view(np.uint8).reshape(len(at), 8), axis=1)
        far += (bits != (2 * bits.sum(axis=0, dtype=np.int64) > len(at))).sum(axis=1)
    return int(at[far.argmin()])


#: Candidate tests of one bucket at once.
TESTS = 1 << 18


def candidates(own: dict, at: np.ndarray, bound: Callable) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of a bucket, of different components, that the bound lets through."""
    step = max(1, TESTS // len(at))
    for i in range(0, len(at), step):
        left, right = at[i : i + step, None], at[None, i:]
        a, b = np.nonzero((left < right) & (own["part"][left] != own["part"][right]))
        if len(a):
            a, b = at[a + i], at[b + i]
            hit = bound(own, a, b)
            yield a[hit], b[hit]


def unsettled(members: DataFrame, bound: Callable, cell_rows: int) -> DataFrame:
    """(bucket, node): members that could be linked with a member of another component; of very large buckets all."""
    names = ["bucket", "node"]

    def over(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        yield from rows.select(names).to_batches()

    def done(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        own, starts, sizes = arrays(rows)
        marked = np.zeros(rows.num_rows, bool)
        mixed_parts = np.minimum.reduceat(own["part"], starts) != np.maximum.reduceat(own["part"], starts)
        for start, size in zip(starts[mixed_parts].tolist(), sizes[mixed_parts].tolist()):
            for a, b in candidates(own, np.arange(start, start + size), bound):
                marked[a] = marked[b] = True
        if marked.any():
            yield from rows.select(names).filter(pa.array(marked)).to_batches()

    def run(batches):
        yield from whole_buckets(batches, done, cell_rows, over)

    parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return members.repartition(parts, "bucket").sortWithinPartitions("bucket", "node").mapInArrow(run, "bucket long, node long")


#: Bytes of the bits that are held of a bucket's sets, and of the pairs' bits that are counted at once.
BITS_BYTES, PAIR_BYTES = 16 << 20, 8 << 20


def shared_counts(sets: list[np.ndarray]) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """How many elements the sets of given rows have in common: bits of those elements that several sets have, some columns of them at a time."""
    _, inverse, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    common = counts[inverse] > 1
    row, at = row[common], (np.cumsum(counts > 1) - 1)[inverse[common]]
    order = np.argsort(at, kind="stable")
    row, at = row[order], at[order]
    width = max(1, BITS_BYTES // (8 * len(sets)))  # words of a column block
    blocks = int(at[-1]) // (64 * width) + 1 if len(at) else 0
    made: dict[int, np.ndarray] = {}

    def bits(block: int) -> np.ndarray:
        if block not in made:
            a, b = np.searchsorted(at, [block * 64 * width, (block + 1) * 64 * width])
            own = at[a:b] - block * 64 * width
            out = np.zeros((len(sets), int(own[-1]) // 64 + 1), np.uint64)
            np.bitwise_or.at(out, (row[a:b], own // 64), np.uint64(1) << (own % 64).astype(np.uint64))
            made.clear()
            made[block] = out
        return made[block]

    def count(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        out = np.zeros(len(i), np.int64)
        for block in range(blocks):
            own = bits(block)
            some = max(1, PAIR_BYTES // (8 * own.shape[1]))
            for k in range(0, len(i), some):
                out[k : k + some] += np.bitwise_count(own[i[k : k + some]] & own[j[k : k + some]]).sum(axis=1, dtype=np.int64)
        return out

    return count


def bucket_links(rows: DataFrame, bound: Callable) -> DataFrame:
    """Links (a, b) that connect all verified pairs of different components in rows (bucket, node, part, n, k0, k1, shingles)."""

    def done(some: pa.Table) -> Iterator[pa.RecordBatch]:
        own, starts, sizes = arrays(some)
        lists = some["shingles"].combine_chunks()
        lists = pa.concat_arrays(lists.chunks) if isinstance(lists, pa.ChunkedArray) else lists
        ends, flat = np.asarray(lists.offsets), np.asarray(lists.values)
        for start, size in zip(starts.tolist(), sizes.tolist()):
            count, one, two = None, [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for a, b in candidates(own, np.arange(start, start + size), bound):
                count = count or shared_counts([flat[ends[r] : ends[r + 1]] for r in range(start, start + size)])
                both = count(a - start, b - start)
                hit = 100 * both >= bound.percent * (own["n"][a].astype(np.int64) + own["n"][b] - both)
                a, b = stars(a[hit] - start, b[hit] - start, size)
                one.append(a)
                two.append(b)
            a, b = stars(np.concatenate(one), np.concatenate(two), size)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(own["node"][a + start]), pa.array(own["node"][b + start])], names=["a", "b"])

    def run(batches):
        yield from whole_buckets(batches, done, 1 << 62)

    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(parts, "bucket").sortWithinPartitions("bucket", "node").mapInArrow(run, "a long, b long")


def node_sets(keyed: DataFrame, wanted: DataFrame, shingle: int, broadcast_rows: int) -> DataFrame:
    """(node, shingles) of wanted nodes (node, key, s0, s1), from the texts of their keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, "text", SLICE_BYTES):
                hashes, bounds = shingle_sets(rows["text"], shingle)
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(hashes.view(np.int64)))
                yield pa.RecordBatch.from_arrays([rows["key"], *(pa.array(x.view(np.int64)) for x in set_digests(hashes, bounds)), lists], names=["key", "s0", "s1", "shingles"])

    texts = without_keys(keyed.select("key", "text"), wanted.select("key").distinct(), "key", broadcast_rows, "left_semi")
    made = texts.mapInArrow(run, "key long, s0 long, s1 long, shingles array<long>")
    return made.join(wanted, ["key", "s0", "s1"]).select("node", "shingles").dropDuplicates(["node"])


def settled(keyed: DataFrame, nodes: DataFrame, pairs: DataFrame, members: DataFrame, bound, *, sketch: list[str], shingle: int, percent: int, cell_rows: int, block_bytes: int, broadcast_rows: int) -> DataFrame:
    """(node, component) of nodes (node, key, s0, s1, n, sketch columns) that have a link: pairs (a, b) and members (bucket, node) are
    candidates, keyed has the texts by key."""
    wanted = lambda some: checkpointed(nodes.join(some.distinct(), "node").select("node", "key", "s0", "s1"))
    sets = checkpointed(node_sets(keyed, wanted(pairs.select(F.explode(F.array("a", "b")).alias("node"))), shingle, broadcast_rows))
    links = checkpointed(similar(pairs, sets, percent / 100))
    parts = checkpointed(connected_components(links, "a", "b"))
    if members.isEmpty():
        return parts
    part = nodes.join(parts, "node", "left").select("node", "n", *sketch, F.coalesce("component", "node").alias("part"))
    open_rows = checkpointed(unsettled(members.join(part, "node"), bound, cell_rows))
    if open_rows.isEmpty():
        return parts
    more = node_sets(keyed, wanted(open_rows.select("node")), shingle, broadcast_rows)
    placed = checkpointed(open_rows.join(part, "node"))
    sizes = placed.groupBy("bucket").agg(F.ceil(F.greatest(F.sum("n") * 8 / block_bytes, F.count("*") / BLOCK_ROWS)).cast("int").alias("blocks"), F.count("*").alias("rows"))
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    meets = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda b: F.xxhash64("bucket", F.least(b, F.col("block")), F.greatest(b, F.col("block"))))
    dealt = joined_by_key(placed, sizes, "bucket", "rows", placed.count()).withColumn("block", block).select(F.explode(meets).alias("bucket"), "node", "part", "n", *sketch)
    found = checkpointed(united(bucket_links(dealt.join(more, "node"), bound), "a", "b"))
    if found.isEmpty():
        return parts
    return checkpointed(connected_components(links.unionByName(found.select(F.col("u").alias("a"), F.col("v").alias("b"))), "a", "b"))


def batch_of(bucket: np.ndarray | None, a: np.ndarray, b: np.ndarray | None) -> pa.RecordBatch:
    """Rows of candidates (bucket, a, b): a pair has no bucket, a bucket's member no b."""
    none = lambda x: pa.nulls(len(a), pa.int64()) if x is None else pa.array(x, pa.int64())
    return pa.RecordBatch.from_arrays([none(bucket), pa.array(a), none(b)], names=["bucket", "a", "b"])


def starred(own: dict, at: np.ndarray, bucket: np.ndarray, bound) -> Iterator[pa.RecordBatch]:
    """Of a large group's rows the pairs with its pivot, and all as members of a bucket."""
    pivot = np.array(pivot_of(own["sketch"], at))
    hit = at[bound(own, pivot, at) & (own["node"][at] != own["node"][pivot])]
    a, b = np.full(len(hit), own["node"][pivot]), own["node"][hit]
    if len(a):
        yield batch_of(None, np.minimum(a, b), np.maximum(a, b))
    yield batch_of(bucket, own["node"][at], None)


PAIRS = "bucket long, a long, b long"
