"""Near duplicates by SimHash, found through a segment-popcount embedding.

Fingerprint: words are what lies between ASCII white space once A-Z are lower-cased; each run
of ``shingle`` words, space-joined, is hashed by XXH64 with seed 42; a bit of the fingerprint
is 1 if more than half the hashes have it. A text of fewer words is one shingle, a text
without words has fingerprint zero.

Search: a fingerprint is cut into segments and mapped to its bit count in each. The Manhattan
distance of two such vectors never exceeds the Hamming distance of the fingerprints. The
coordinates are dealt into radius + agree groups; distances are whole numbers that add up, so
two vectors within the radius are equal in at least ``agree`` of the groups. The range join
under the Manhattan distance is thus an equi-join on grid cells: one cell for each choice of
``agree`` groups, its place given by those coordinates. Nothing within the radius is lost.
In a cell the Manhattan bound is tested first (counts are held in unary, so the distance is
the bit count of an exclusive or), then the Hamming distance.

Size: equal fingerprints are one node. A pair counts in the first cell that it meets in, and a cell
gives at most one link for each member (with the first member that it is connected with there),
never its pairs. A cell of more than
``cell_rows`` rows is dealt again into blocks, and each two blocks meet in a task of their own.
With more nodes ``agree`` grows, which changes the number and size of cells but no result.

Near copies by similarity (``near_copies``, ``one_of_each``): the texts' sets of shingles have three
independent fingerprints. Sets that are within the radius in one of them, within ``total`` in
all together, and whose sizes allow the similarity are candidates. In a cell the candidates' connected parts of up to
``SMALL`` sets give all their pairs, a larger part each member's with its pivot and then, of those pairs that this hasn't
connected, all (``verify``); so no candidate is left out, and a group of copies costs rows in proportion to its members. Candidates are
compared by the exact Jaccard similarity of their sets before components.
At Jaccard 0.8 two fingerprints differ in 9.7 of 64 bits on average with a deviation of 2.9, so
one of three is within 10 in 97 of 100 pairs, and in nearly all pairs above. A greater ``radius`` and ``total`` find more of the rest, at more cells.

Nulls: a null text is empty. A row with a null document id is linked like any other; the
component is named by the least id that is not null. Repeated rows stay repeated.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftlane.llm import verify
from siftlane.llm.common import checkpointed, slices, whole_text
from siftlane.llm.verify import BLOCK_BYTES, PAIRS, arrays, batch_of, set_digests, settled, shingle_sets, starred, stars, whole_buckets, without_keys
from siftlane.operators.components import connected_components, joined_by_key

SLICE_BYTES = 8 << 20
#: Pairs of a large cell that are compared at once.
BLOCK_PAIRS = 1 << 19
#: Members of a connected part of a cell of which all pairs are candidates; pairs for each row of a large cell that are held.
SMALL, HELD = 32, 32


def shingle_hashes(text: str, shingle: int) -> np.ndarray:
    """XXH64 of each run of words, repeats included."""
    words = text.encode("utf-8", "replace").lower().split()
    line = b" ".join(words)
    if len(words) <= shingle:
        return np.array([xxhash.xxh64_intdigest(line, 42)] if words else [], dtype=np.uint64)
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1
    ends = np.cumsum(sizes) - 1
    starts = (ends + 1 - sizes)[: len(words) - shingle + 1].tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(line[a:b], 42) for a, b in zip(starts, ends[shingle - 1 :].tolist())), dtype=np.uint64, count=len(starts))


def majority(hashes: np.ndarray) -> int:
    """The 64 bits that more than half the hashes have."""
    if not len(hashes):
        return 0
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), 1 << 15):
        part = np.ascontiguousarray(hashes[i : i + (1 << 15)])
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def rehashed(hashes: np.ndarray) -> np.ndarray:
    """A second hash of each shingle, mixed from the first."""
    x = hashes + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def print_names(count: int) -> list[str]:
    return ["fingerprint", *(f"fingerprint{i}" for i in range(2, count + 1))]


def fingerprints(docs: DataFrame, *, shingle: int = 5, text_col: str = "text", count: int = 1, distinct: bool = False) -> DataFrame:
    """docs with ``count`` fingerprints, the later ones from further hashes of the same shingles; with ``distinct`` a repeated
    shingle counts once, and n_shingles is how many there are."""
    added = print_names(count) + ["n_shingles"] * distinct
    kept = [c for c in docs.columns if c not in added]
    work = docs.select(*kept, whole_text(text_col).alias("__text"))
    schema = docs.select(*kept).schema
    for name in added:
        schema = schema.add(name, "long")

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, "__text", SLICE_BYTES):
                new = np.zeros((len(added), rows.num_rows), dtype=np.uint64)
                for i, t in enumerate(rows["__text"].to_pylist()):
                    hashes = shingle_hashes(t, shingle)
                    if distinct:
                        hashes = np.unique(hashes)
                        new[-1, i] = len(hashes)
                    for k in range(count):
                        new[k, i] = majority(hashes)
                        hashes = rehashed(hashes) if k + 1 < count else hashes
                yield pa.RecordBatch.from_arrays([rows[c] for c in kept] + [pa.array(x.view(np.int64)) for x in new], names=schema.fieldNames())

    return work.mapInArrow(made, schema)


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def embedding(fingerprint: Column, segment_bits: int) -> Column:
    """The bit counts of the segments, each in unary in as many bits as its segment has."""
    if segment_bits == 1:
        return fingerprint
    out = F.lit(0).cast("long")
    for at in range(0, 64, segment_bits):
        count = F.bit_count(fingerprint.bitwiseAND(F.lit(signed(((1 << segment_bits) - 1) << at))))
        steps = F.lit(0).cast("long")
        for c in range(1, segment_bits + 1):
            steps = F.when(count >= c, F.lit(signed(((1 << c) - 1) << at))).otherwise(steps)
        out = out.bitwiseOR(steps)
    return out


def group_masks(radius: int, agree: int, segment_bits: int) -> list[int]:
    """The bits of the segments of each of the radius + agree groups."""
    segments, groups = 64 // segment_bits, radius + agree
    if groups > segments:
        raise ValueError(f"{groups} groups need as many segments; there are {segments}")
    bits = [0] * groups
    for s in range(segments):
        bits[s * groups // segments] |= ((1 << segment_bits) - 1) << (s * segment_bits)
    return bits


def cell_masks(radius: int, agree: int, segment_bits: int) -> list[int]:
    """For each choice of ``agree`` of the groups, the bits of their segments."""
    bits = group_masks(radius, agree, segment_bits)
    return [sum(bits[g] for g in chosen) for chosen in combinations(range(radius + agree), agree)]


def agreeing_groups(nodes: int, radius: int, segment_bits: int) -> int:
    """The ``agree`` at which placing and comparing the nodes is cheapest.

    A placed row costs about as much as 750 comparisons; by chance alone a cell has the nodes
    divided by two to the bits that its coordinates tell apart.
    """
    segments, tells = 64 // segment_bits, {1: 1.0, 2: 1.415, 4: 1.87, 8: 2.35}[segment_bits]
    ways = range(1, min(5, segments - radius + 1))
    return min(ways, key=lambda k: math.comb(radius + k, k) * (750 + nodes / 2 ** (1 + tells * segments * k / (radius + k))))


def unary(fps: np.ndarray, segment_bits: int) -> np.ndarray:
    """``embedding`` of an array."""
    if segment_bits == 1:
        return fps
    out, low = np.zeros_like(fps), np.uint64((1 << segment_bits) - 1)
    for at in range(0, 64, segment_bits):
        count = np.bitwise_count((fps >> np.uint64(at)) & low).astype(np.uint64)
        out |= ((np.uint64(1) << count) - np.uint64(1)) << np.uint64(at)
    return out


class Links:
    """Pairs inside cells that are near. A pair that meets in several cells counts in the first of them alone, that of its first agreeing groups.

    Rows have several fingerprints in ``near_copies``; a choice's number also says by which of them the row was placed."""

    def __init__(self, radius: int, segment_bits: int, agree: int, *, prints: int = 1):
        self.radius, self.segment_bits = radius, segment_bits
        self.groups = [np.uint64(g) for g in group_masks(radius, agree, segment_bits)]
        chosen = list(combinations(range(radius + agree), agree))
        self.own = np.array([sum(1 << g for g in c) for c in chosen] * prints, dtype=np.uint64)  # groups of each choice
        self.upto = np.array([(2 << c[-1]) - 1 for c in chosen] * prints, dtype=np.uint64)  # groups up to its last
        self.choices = len(chosen)

    def rows_of(self, prints: np.ndarray, choices: np.ndarray) -> tuple:
        """The fingerprints that rows were placed by, their embedding, and the choices."""
        fps = prints[choices // self.choices, np.arange(len(choices))]
        return fps, unary(fps, self.segment_bits), choices

    def near(self, i: np.ndarray, j: np.ndarray, rows: tuple) -> np.ndarray:
        """Whether rows i and j (broadcast) are near: the Manhattan bound, the Hamming distance, and that their cell is the pair's first."""
        fps, emb, choices = rows
        hit = np.bitwise_count(emb[i] ^ emb[j]) <= self.radius
        if hit.any():
            at = np.nonzero(hit)
            i, j = np.broadcast_to(i, hit.shape)[at], np.broadcast_to(j, hit.shape)[at]
            ok = np.bitwise_count(fps[i] ^ fps[j]) <= self.radius
            differ, agreeing = emb[i] ^ emb[j], np.zeros(len(i), dtype=np.uint64)
            for g, mask in enumerate(self.groups):
                agreeing |= ((differ & mask) == 0).astype(np.uint64) << np.uint64(g)
            hit[at] = ok & ((agreeing & self.upto[choices[i]]) == self.own[choices[i]])
        return hit

    def pairs(self, starts: np.ndarray, sizes: np.ndarray, rows: tuple, also: Callable | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The near pairs (row, row) of whole cells, some at a time, that ``also`` lets through."""
        size_of, rest = np.repeat(sizes, sizes), np.repeat(starts + sizes, sizes) - np.arange(int(sizes.sum()))
        at, step = np.flatnonzero((size_of > 1) & (size_of <= 48)), 0
        fine = lambda a, b: (a, b) if also is None else (a[ok := also(a, b)], b[ok])
        while len(at):
            step += 1
            at = at[rest[at] > step]
            if len(at):
                hit = at[self.near(at, at + step, rows)]
                yield fine(hit, hit + step)
        for start, size in zip(starts[sizes > 48].tolist(), sizes[sizes > 48].tolist()):
            own = np.arange(start, start + size)
            some = max(1, BLOCK_PAIRS // size)
            for i in range(0, size, some):
                a, b = np.nonzero(self.near(own[i : i + some, None], own[None, i:], rows))
                up = b > a
                yield fine(own[a[up] + i], own[b[up] + i])

    def of(self, cells: np.ndarray, prints: np.ndarray, choices: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Links (row, row) of whole cells: each member with the first member of its cell that it is connected with."""
        starts = np.flatnonzero(np.r_[True, cells[1:] != cells[:-1]])
        return merged(self.pairs(starts, np.diff(np.r_[starts, len(cells)]), self.rows_of(prints, choices)), len(cells))


def merged(pairs: Iterator[tuple[np.ndarray, np.ndarray]], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of the rows that pairs connect with the least row of their part."""
    one, two, rows = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
    for a, b in pairs:
        one.append(a)
        two.append(b)
        rows += len(a)
        if rows > max(4 * n, 1 << 20):
            a, b = stars(np.concatenate(one), np.concatenate(two), n)
            one, two, rows = [a], [b], len(a)
    return stars(np.concatenate(one), np.concatenate(two), n)


def link_schema(prints: int) -> str:
    """A cell's row, or the two ends of a link: fingerprints f and g."""
    return ", ".join(["cell long", "choice int", *(f"{x}{k} long" for x in "fg" for k in range(prints))])


def cell_links(cells: DataFrame, links: Links, prints: int, cell_rows: int) -> DataFrame:
    """Links of rows (cell, choice, f0, f1, ...) sorted by cell and fingerprints within partitions.

    A cell of more than cell_rows rows comes back as it is, its rows having a null g0.
    """
    names = [x.split(" ")[0] for x in link_schema(prints).split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, large = (np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros((prints, 0), np.uint64)), None
        part = lambda rows, at: (rows[0][at], rows[1][at], rows[2][:, at])

        def put(rows, ends=None):
            """Links, the same one from several cells being the same row, or rows of a large cell."""
            cell, choice, f = rows
            if ends is None:
                g = [pa.nulls(len(cell), pa.int64())] * prints
            else:
                cell, choice = np.zeros_like(cell), np.zeros_like(choice)
                swap, settled = np.zeros(len(cell), bool), np.zeros(len(cell), bool)
                for a, b in zip(f, ends):
                    swap |= ~settled & (a > b)
                    settled |= a != b
                f, ends = np.where(swap, ends, f), np.where(swap, f, ends)
                g = [pa.array(x.view(np.int64)) for x in np.ascontiguousarray(ends)]
            return pa.RecordBatch.from_arrays([pa.array(cell), pa.array(choice), *(pa.array(x.view(np.int64)) for x in np.ascontiguousarray(f)), *g], names=names)

        def done(rows):
            bounds = np.flatnonzero(np.r_[True, rows[0][1:] != rows[0][:-1]])
            sizes = np.diff(np.r_[bounds, len(rows[0])])
            over = np.repeat(sizes, sizes) > cell_rows
            if over.any():
                yield put(part(rows, over))
                rows = part(rows, ~over)
            if len(rows[0]):
                a, b = links.of(rows[0], rows[2], rows[1])
                if len(a):
                    yield put(part(rows, a), rows[2][:, b])

        for batch in batches:
            own = np.stack([np.asarray(batch[f"f{k}"]).view(np.uint64) for k in range(prints)])
            rows = (np.asarray(batch["cell"]), np.asarray(batch["choice"]), own)
            if large is not None:
                same = rows[0] == large
                if same.any():
                    yield put(part(rows, same))
                    rows = part(rows, ~same)
                if not len(rows[0]):
                    continue
                large = None
            rows = tuple(np.concatenate(x, axis=-1) for x in zip(held, rows))
            if not len(rows[0]):
                continue
            last = int(np.searchsorted(rows[0], rows[0][-1]))
            if last:
                yield from done(part(rows, slice(None, last)))
            held = part(rows, slice(last, None))
            if len(held[0]) > cell_rows:
                large = held[0][0]
                yield put(held)
                held = part(held, slice(0, 0))
        if len(held[0]):
            yield from done(held)

    return cells.mapInArrow(run, link_schema(prints))


def placed_cells(nodes: DataFrame, columns: list[str], radius: int, segment_bits: int, agree: int) -> DataFrame:
    """nodes with choice and cell: a row for each cell that one of the fingerprint columns falls into."""
    masks = cell_masks(radius, agree, segment_bits)
    embedded = nodes.select("*", *[embedding(F.col(c), segment_bits).alias(f"__e{k}") for k, c in enumerate(columns)])
    places = [F.xxhash64(F.lit(k * len(masks) + i), F.col(f"__e{k}").bitwiseAND(F.lit(signed(m)))) for k in range(len(columns)) for i, m in enumerate(masks)]
    return embedded.select(*nodes.columns, F.posexplode(F.array(*places)).alias("choice", "cell"))


def dealt_blocks(large: DataFrame, by: str, cell_rows: int) -> DataFrame:
    """Rows of cells that are too large for a task: cut into blocks, of which each two have a cell of their own."""
    sizes = large.groupBy("cell").agg(F.count("*").alias("__n"))
    sizes = sizes.select("cell", "__n", F.ceil(F.col("__n") / F.lit(cell_rows / 2)).cast("int").alias("blocks"))
    meets = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda b: F.xxhash64("cell", F.least(b, F.col("block")), F.greatest(b, F.col("block"))))
    rows = joined_by_key(large, sizes, "cell", "__n", large.count()).withColumn("block", F.pmod(F.xxhash64(by), F.col("blocks")).cast("int"))
    return rows.select(F.explode(meets).alias("cell"), *[c for c in large.columns if c != "cell"])


def cell_pairs(nodes: DataFrame, columns: list[str], *, radius: int, segment_bits: int, agree: int | None = None, cell_rows: int = 1 << 16) -> DataFrame:
    """Links (f0, g0) of nodes, distinct fingerprints: see ``Links``."""
    agree = agree or agreeing_groups(nodes.count(), radius, segment_bits)
    links = Links(radius, segment_bits, agree)
    cells = placed_cells(nodes.select(F.col(columns[0]).alias("f0")), ["f0"], radius, segment_bits, agree).select("cell", "choice", "f0")
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    first = checkpointed(cell_links(cells.repartition(parts, "cell").sortWithinPartitions("cell", "f0"), links, 1, cell_rows).distinct())
    found, large = first.where("g0 is not null").select("f0", "g0"), first.where("g0 is null").select("cell", "choice", "f0")
    if large.isEmpty():
        return found.distinct()
    dealt = dealt_blocks(large, "f0", cell_rows)
    more = cell_links(dealt.repartition(parts, "cell").sortWithinPartitions("cell", "f0"), links, 1, 1 << 40)
    return found.unionByName(more.select("f0", "g0")).distinct()


def near_links(nodes: DataFrame, *, radius: int, segment_bits: int = 2, agree: int | None = None, cell_rows: int = 1 << 16) -> DataFrame:
    """Links (src, dst) that connect all fingerprints within the radius, and none other. nodes: distinct fingerprints."""
    found = cell_pairs(nodes, ["fingerprint"], radius=radius, segment_bits=segment_bits, agree=agree, cell_rows=cell_rows)
    return found.select(F.col("f0").alias("src"), F.col("g0").alias("dst"))


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, radius: int = 4, segment_bits: int = 2, agree: int | None = None, cell_rows: int = 1 << 16) -> DataFrame:
    """One row for each row of docs: doc_id, fingerprint (long), component (a fingerprint that all of a component have in
    common) and component_id (the least id reachable). Links are fingerprints within the radius, exactly."""
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    prints = checkpointed(fingerprints(own, shingle=shingle).select("doc_id", "fingerprint"))
    nodes = checkpointed(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")))
    found = connected_components(near_links(nodes, radius=radius, segment_bits=segment_bits, agree=agree, cell_rows=cell_rows))
    linked = checkpointed(nodes.join(found.withColumnRenamed("node", "fingerprint"), "fingerprint"))
    least = linked.groupBy("component").agg(F.min("least").alias("component_id"), F.count("*").alias("members"))
    of = joined_by_key(linked, least, "component", "members", linked.count()).select("fingerprint", "n", "component", "component_id")
    alone = nodes.join(linked.select("fingerprint"), "fingerprint", "left_anti").select("fingerprint", "n", F.col("fingerprint").alias("component"), F.col("least").alias("component_id"))
    named = checkpointed(of.unionByName(alone))
    return joined_by_key(prints, named, "fingerprint", "n", prints.count()).select("doc_id", "fingerprint", "component", "component_id")


# --- near copies by similarity ------------------------------------------------------------------------------------------------------------


class Bound:
    """Whether two sets can be candidates: by their sizes, and by all fingerprints together."""

    def __init__(self, percent: int, total: int):
        self.percent, self.total = percent, total

    def __call__(self, rows: dict, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        apart = sum(np.bitwise_count(k[i] ^ k[j]).astype(np.int64) for k in rows["sketch"])
        n = rows["n"].astype(np.int64)
        return (apart <= self.total) & (100 * np.minimum(n[i], n[j]) >= self.percent * np.maximum(n[i], n[j]))


def printed_sets(keyed: DataFrame, shingle: int, prints: int) -> DataFrame:
    """keyed (doc_id, key, text) with each text's set size, digest and fingerprints in place of the text."""
    names = ["doc_id", "key", "n", "s0", "s1", *(f"k{k}" for k in range(prints))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, "text", verify.SLICE_BYTES):
                hashes, bounds = shingle_sets(rows["text"], shingle)
                new = [*set_digests(hashes, bounds)]
                for _ in range(prints):
                    new.append(np.array([majority(hashes[a:b]) for a, b in zip(bounds, bounds[1:])], np.uint64))
                    hashes = rehashed(hashes)
                yield pa.RecordBatch.from_arrays([rows["doc_id"], rows["key"], pa.array(np.diff(bounds).astype(np.int32)), *(pa.array(x.view(np.int64)) for x in new)], names=names)

    return keyed.mapInArrow(run, ", ".join(f"{c} {'int' if c == 'n' else 'long'}" for c in names))


CANDIDATES = PAIRS + ", choice int"


def cell_candidates(cells: DataFrame, links: Links, bound: Bound, small: int, cell_rows: int) -> DataFrame:
    """(bucket, a, b, choice): candidate pairs have no bucket, members of large parts no b; rows of cells that are too large come back with their choice."""

    def chosen(batch: pa.RecordBatch, choice: pa.Array | None = None) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*batch.columns, choice if choice is not None else pa.nulls(batch.num_rows, pa.int32())], names=["bucket", "a", "b", "choice"])

    def over(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        own, _, _ = arrays(rows)
        yield chosen(batch_of(own["bucket"], own["node"], None), pa.array(own["choice"], pa.int32()))

    def done(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        own, starts, sizes = arrays(rows)
        place, n = links.rows_of(np.stack(own["sketch"]), own["choice"]), rows.num_rows
        also = lambda a, b: bound(own, a, b)
        one, two, held, forest = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0, [(np.zeros(0, np.int64),) * 2]
        for a, b in links.pairs(starts, sizes, place, also):
            held += len(a)
            if held <= HELD * n:
                one.append(a)
                two.append(b)
            else:  # a large group: what it connects is enough, its pairs are looked at again
                forest.append(stars(a, b, n))
        one, two = np.concatenate(one), np.concatenate(two)
        root, member = stars(np.concatenate([one, *(f[0] for f in forest)]), np.concatenate([two, *(f[1] for f in forest)]), n)
        part = np.arange(n)
        part[member] = root
        sizes_of = np.bincount(part, minlength=n)
        few = (sizes_of > 1) & (sizes_of <= small)
        order = np.argsort(part, kind="stable")
        at = np.flatnonzero(sizes_of > 1)
        first = np.searchsorted(part[order], at)
        if held > HELD * n:
            again = [[np.zeros(0, np.int64)], [np.zeros(0, np.int64)]]
            for r, f in zip(at[few[at]].tolist(), first[few[at]].tolist()):
                i, j = np.triu_indices(sizes_of[r], 1)
                i, j = np.sort(order[f : f + sizes_of[r]])[np.stack([i, j])]
                ok = links.near(i, j, place) & also(i, j)
                again[0].append(i[ok])
                again[1].append(j[ok])
            one, two = map(np.concatenate, again)
        kept = few[part[one]]
        if kept.any():
            a, b = own["node"][one[kept]], own["node"][two[kept]]
            yield chosen(batch_of(None, np.minimum(a, b), np.maximum(a, b)))
        for r, f in zip(at[~few[at]].tolist(), first[~few[at]].tolist()):
            rows_at = order[f : f + sizes_of[r]]
            bucket = np.full(len(rows_at), own["bucket"][r] ^ own["node"][r])
            for batch in starred(own, rows_at, bucket, bound):
                yield chosen(batch)

    def run(batches):
        yield from whole_buckets(batches, done, cell_rows, over if cell_rows < 1 << 40 else None)

    parts = int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cells.repartition(parts, "bucket").sortWithinPartitions("bucket", "node").mapInArrow(run, CANDIDATES).distinct()


def near_copies(
    keyed: DataFrame,
    key: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 5,
    percent: int = 80,
    prints: int = 3,
    radius: int = 10,
    total: int = 42,
    agree: int | None = None,
    small: int = SMALL,
    cell_rows: int = 1 << 16,
    block_bytes: int = BLOCK_BYTES,
    broadcast_rows: int = 2_000_000,
) -> DataFrame:
    """(key, kept_key) for each row of keyed: the key of the row that stands for its component, that of the least id
    (nulls last), of equal ids that of the least key. Two texts are linked if their sets of shingles reach the similarity
    (see above on candidates); texts without words are alike. Up to three fingerprints."""
    sketch, bound = [f"k{k}" for k in range(prints)], Bound(percent, total)
    own = keyed.select(F.col(id_col).cast("long").alias("doc_id"), F.col(key).alias("key"), whole_text(text_col).alias("text"))
    made = checkpointed(printed_sets(own, shingle, prints))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), "key")).alias("first")
    nodes = made.groupBy("s0", "s1", "n", *sketch).agg(first, F.count("*").alias("copies"))
    nodes = checkpointed(nodes.withColumn("node", F.monotonically_increasing_id()).withColumn("key", F.col("first.key")))

    full = nodes.where("n > 0").select("node", "n", *sketch)
    agree = agree or agreeing_groups(full.count(), radius, 1)
    links = Links(radius, 1, agree, prints=prints)
    cells = placed_cells(full, sketch, radius, 1, agree).withColumnRenamed("cell", "bucket")
    found = checkpointed(cell_candidates(cells, links, bound, small, cell_rows))
    large = found.where("choice is not null").select(F.col("bucket").alias("cell"), F.col("a").alias("node"), "choice")
    some = found.where("choice is null")
    if not large.isEmpty():
        dealt = dealt_blocks(large, "node", cell_rows).withColumnRenamed("cell", "bucket").join(full, "node")
        some = checkpointed(some.unionByName(cell_candidates(dealt, links, bound, small, 1 << 40)))
    pairs, members = some.where("b is not null").select("a", "b").distinct(), some.where("b is null").select("bucket", F.col("a").alias("node"))
    parts = settled(own.select("key", "text"), nodes, pairs, members, bound, sketch=sketch, shingle=shingle, percent=percent, cell_rows=cell_rows, block_bytes=block_bytes, broadcast_rows=broadcast_rows)

    linked = checkpointed(nodes.select("node", "first").join(parts, "node"))
    best = linked.groupBy("component").agg(F.min("first").alias("best"), F.count("*").alias("members"))
    of = joined_by_key(linked, best, "component", "members", linked.count()).select("node", F.col("best.key").alias("kept_key"))
    digest = F.struct("s0", "s1", "n").alias("digest")
    named = checkpointed(nodes.join(of, "node", "left").select(digest, "copies", F.coalesce("kept_key", "key").alias("kept_key")))
    return joined_by_key(made.select("key", digest), named, "digest", "copies", made.count()).select("key", "kept_key")


def one_of_each(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", broadcast_rows: int = 2_000_000, **search) -> DataFrame:
    """docs with one row of each component of ``near_copies``. Of rows that are repeated, one stays."""
    keyed = docs.withColumn("__key", F.xxhash64(F.col(id_col), whole_text(text_col)))
    named = checkpointed(near_copies(keyed, "__key", id_col=id_col, text_col=text_col, broadcast_rows=broadcast_rows, **search))
    gone = checkpointed(named.where("key != kept_key").select(F.col("key").alias("__key")).distinct())
    repeated = checkpointed(named.where("key = kept_key").groupBy(F.col("key").alias("__key")).agg(F.count("*").alias("n")).where("n > 1").select("__key"))
    rows = without_keys(keyed, gone, "__key", broadcast_rows)
    if not repeated.isEmpty():
        once = without_keys(rows, repeated, "__key", broadcast_rows, "left_semi").dropDuplicates(["__key"])
        rows = without_keys(rows, repeated, "__key", broadcast_rows).unionByName(once)
    return rows.select(*docs.columns)
