"""Near duplicates by SuperMinHash, banding, exact verification and union-find.

Sets: words are what lies between ASCII white space once A-Z are lower-cased; a text's set is that of its distinct runs of
``shingle`` words, each hashed to 64 bits; a text of fewer words is one run, a text without words is empty and linked with nothing.

Signature: each element gives a pseudo-random permutation of the slots, step by step; at step j it offers the slot that its
permutation has at place j the value j + r, r in [0, 1). A slot keeps the least value offered. All elements of a slice of texts
take a step together, and a text stops at the step that fills its last slot, as later values are greater: the usual
signature of long texts is done after a step or two. The ranks of one element's permutation differ in all slots, which is what
lowers the variance against independent hashes.

Candidates: equal sets are one node. ``bands`` runs of ``rows`` slots are bucket keys. In a bucket two nodes are a candidate pair if
their sizes allow the similarity and their sketches (a bit for each slot) are not farther apart than ``SIGMAS`` deviations at the
similarity. With 26 bands of 4 slots a pair of similarity 0.8 shares no bucket in one of a million cases.

Verification (``verify``) is always on whole sets of hashes. Buckets of up to ``SMALL`` nodes give all their candidate pairs; a larger one gives each
member's with its pivot, the member nearest to the majority of the sketches, the likely common origin. Linked nodes are joined into
components, and then all candidate pairs of larger buckets that are still in different components are verified in the bucket.

So no pair of different texts that shares a bucket and could be a link stays unverified unless it is connected already, and
a group of copies costs rows in proportion to its members.

Nulls: a null text is empty. A row with a null id is linked like any other; a component is named by its least id that is not null.
Repeated rows stay repeated. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftlane.llm.common import checkpointed, slices, whole_text
from siftlane.llm.verify import BLOCK_BYTES, GOLDEN, PAIRS, SLICE_BYTES, arrays, batch_of, chained, mixed, set_digests, settled, shingle_sets, starred, whole_buckets
from siftlane.operators.components import joined_by_key

SLOTS, BANDS, ROWS = 128, 26, 4
#: Members of a bucket of which all pairs are looked at in the first round.
SMALL = 32
#: Rows of a bucket that a task holds at once.
CELL_ROWS = 1 << 14
#: Deviations of a sketch's distance from the expected one at the similarity.
SIGMAS = 4.5
FREE = np.uint32(0xFFFFFFFF)


def super_minhash(hashes: np.ndarray, bounds: np.ndarray, slots: int = SLOTS) -> np.ndarray:
    """The signatures [text, slot] of sets; a value is the step in the upper 8 bits and 24 bits of r. Up to 256 slots."""
    sets = len(bounds) - 1
    out = np.full((sets, slots), FREE)
    flat = out.reshape(-1)
    owner = np.repeat(np.arange(sets), np.diff(bounds))
    ranks = None  # of each element still at work: its permutation so far
    open_sets = np.diff(bounds) > 0
    for step in range(slots):
        x = mixed(hashes + np.uint64((step + 1) * int(GOLDEN) % 2**64))
        pick = (step + (((x & np.uint64(0xFFFFFFFF)) * np.uint64(slots - step)) >> np.uint64(32))).astype(np.int64)
        value = np.uint32(step << 24) | (x >> np.uint64(40)).astype(np.uint32)
        if step:
            row = np.arange(len(hashes))
            slot = ranks[row, pick]
            ranks[row, pick] = ranks[:, step]
            ranks[:, step] = slot
        else:
            slot = pick
        np.minimum.at(flat, owner * slots + slot, value)
        open_sets &= (out == FREE).any(axis=1)
        stays = open_sets[owner]
        if not stays.any():
            break
        if not stays.all():
            hashes, owner = hashes[stays], owner[stays]
        if step:
            ranks = ranks if stays.all() else ranks[stays]
        else:
            pick = pick[stays]
            ranks = np.repeat(np.arange(slots, dtype=np.uint8)[None], len(hashes), axis=0)
            ranks[np.arange(len(hashes)), pick] = 0
            ranks[:, 0] = pick
    return out


def band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A bucket key [text, band] for each band."""
    own = signatures[:, : bands * rows].astype(np.uint64).reshape(-1, bands, rows)
    return chained([np.broadcast_to(np.arange(bands, dtype=np.uint64), own.shape[:2]), *(own[:, :, k] for k in range(rows))])


def sketches(signatures: np.ndarray) -> np.ndarray:
    """A bit of each slot's value, [text, 64 slots]."""
    return np.packbits((signatures & np.uint32(1)).astype(np.uint8), axis=1, bitorder="little").view(np.uint64)


def signed_texts(keyed: DataFrame, shingle: int) -> DataFrame:
    """keyed (doc_id, key, text) with each text's set size, digest, bucket keys and sketch in place of the text."""
    schema = "doc_id long, key long, n int, s0 long, s1 long, bands array<long>, k0 long, k1 long"
    signed = lambda x: pa.array(np.ascontiguousarray(x).view(np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, "text", SLICE_BYTES):
                hashes, bounds = shingle_sets(rows["text"], shingle)
                signatures = super_minhash(hashes, bounds)
                digests, sketch, keys = set_digests(hashes, bounds), sketches(signatures), band_keys(signatures, BANDS, ROWS)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(keys) + 1) * BANDS, pa.int32()), signed(keys.reshape(-1)))
                columns = [rows["doc_id"], rows["key"], pa.array(np.diff(bounds).astype(np.int32)), *map(signed, digests), lists, *(signed(sketch[:, k]) for k in (0, 1))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "key", "n", "s0", "s1", "bands", "k0", "k1"])

    return keyed.mapInArrow(run, schema)


class Bound:
    """Whether two nodes can reach the similarity, by sizes and sketches; the latter fails once in some hundred thousand links."""

    def __init__(self, percent: int, slots: int = SLOTS):
        miss = (100 - percent) / 200
        self.percent, self.most = percent, int(slots * miss + SIGMAS * math.sqrt(slots * miss * (1 - miss)))

    def __call__(self, rows: dict[str, np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
        n, k = rows["n"], rows["sketch"]
        near = np.bitwise_count(k[0][i] ^ k[0][j]).astype(np.int64) + np.bitwise_count(k[1][i] ^ k[1][j]) <= self.most
        return near & (100 * np.minimum(n[i], n[j]).astype(np.int64) >= self.percent * np.maximum(n[i], n[j]).astype(np.int64))


def first_pairs(cells: DataFrame, bound: Bound, small: int, cell_rows: int) -> DataFrame:
    """(bucket, a, b): candidate pairs have no bucket; members of larger buckets have no b."""

    def over(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        """A part of a very large bucket: each member with the part's pivot; parts meet in the second round."""
        own, _, _ = arrays(rows)
        yield from starred(own, np.arange(rows.num_rows), own["bucket"], bound)

    def done(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        own, starts, sizes = arrays(rows)
        rest = np.repeat(starts + sizes, sizes) - np.arange(rows.num_rows)
        size_of = np.repeat(sizes, sizes)
        at, step = np.flatnonzero((size_of > 1) & (size_of <= small)), 0
        while len(at):
            step += 1
            at = at[rest[at] > step]
            hit = at[bound(own, at, at + step)]
            if len(hit):
                a, b = own["node"][hit], own["node"][hit + step]
                yield batch_of(None, np.minimum(a, b), np.maximum(a, b))
        for start, size in zip(starts[sizes > small].tolist(), sizes[sizes > small].tolist()):
            at = np.arange(start, start + size)
            yield from starred(own, at, own["bucket"][at], bound)

    def run(batches):
        yield from whole_buckets(batches, done, cell_rows, over)

    parts = int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cells.repartition(parts, "bucket").sortWithinPartitions("bucket", "node").mapInArrow(run, PAIRS).distinct()


def near_duplicates(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80, small: int = SMALL, cell_rows: int = CELL_ROWS, block_bytes: int = BLOCK_BYTES, broadcast_rows: int = 2_000_000
) -> DataFrame:
    """One row for each row of docs: doc_id, n_shingles (the size of its set) and component_id, the least id that
    links lead to. Two texts are linked if 100 times what their sets share is ``percent`` times their union or more."""
    bound = Bound(percent)
    keyed = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text")).select("doc_id", F.xxhash64("doc_id", "text").alias("key"), "text")
    made = checkpointed(signed_texts(keyed, shingle))
    full = made.where("n > 0")
    nodes = full.groupBy("s0", "s1", "n").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies"), F.min("key").alias("key"), F.first(F.struct("bands", "k0", "k1")).alias("x"))
    nodes = checkpointed(nodes.select(F.monotonically_increasing_id().alias("node"), "s0", "s1", "n", "least", "copies", "key", "x.bands", "x.k0", "x.k1"))

    cells = nodes.select("node", "n", "k0", "k1", F.explode("bands").alias("bucket"))
    first = checkpointed(first_pairs(cells, bound, small, cell_rows))
    pairs, members = first.where("b is not null").select("a", "b"), first.where("b is null").select("bucket", F.col("a").alias("node"))
    parts = settled(keyed, nodes, pairs, members, bound, sketch=["k0", "k1"], shingle=shingle, percent=percent, cell_rows=cell_rows, block_bytes=block_bytes, broadcast_rows=broadcast_rows)

    known = nodes.join(parts, "node", "left").select("s0", "s1", "n", "least", "copies", F.col("component"))
    linked = checkpointed(known.where("component is not null"))
    least = linked.groupBy("component").agg(F.min("least").alias("component_id"), F.count("*").alias("members"))
    of = joined_by_key(linked, least, "component", "members", linked.count()).select("s0", "s1", "n", "copies", "component_id")
    named = checkpointed(of.unionByName(known.where("component is null").select("s0", "s1", "n", "copies", F.col("least").alias("component_id"))))
    digest = F.struct("s0", "s1", "n").alias("digest")
    own = joined_by_key(full.select("doc_id", F.col("n").alias("n_shingles"), digest), named.select(digest, "copies", "component_id"), "digest", "copies", full.count())
    alone = made.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return own.select("doc_id", "n_shingles", "component_id").unionByName(alone).withColumn("n_shingles", F.col("n_shingles").cast("long"))
