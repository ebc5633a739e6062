"""Vector code compression: product codes by a filtering Lloyd.

A vector's components become whole numbers and are cut into ``parts`` equal consecutive parts. Each part
position has a codebook of ``entries`` entries, which start as that part of the vectors with the smallest ids.

Trees: the vectors of a partition are taken in slices of ``slice_rows``, and for each part position the slice's
parts are laid in a kd-tree: level by level each cell is halved at the middle of its widest side. A
cell holds its bounding box, the count and the sums of its parts. The trees are written once to the shared
folder, and all rounds read them.

Filtering: the entries that can be nearest to anything in a cell are followed from the root down. An entry
goes when another one is nearer to (or as near as, with a lower index) even the corner of the box that
suits it best; that is an exact test in whole numbers. A cell with one entry left is assigned
as a whole, by its cached sums and count; only parts in leaves with several entries left are compared one by one.
Each slice gives a row for each entry it used; they are summed by entry, so a round moves parts x entries rows for
each task and the codebooks (parts x entries rows, whatever the input) are all that the driver holds.

Rows: those whose vector is null, empty, or holds null or non-finite components are dropped, and those of another
length than the vector of the smallest id (of a length that the parts divide). Whole numbers beyond 2**25 in size
are cut to it, so that sums of squares stay within 64 bits. A null id is kept but comes last for the first entries;
of equal ids the lesser vector comes first. Fewer rows than entries give as many entries. Repeated rows count as
often as they stand. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftlane.llm.common import checkpointed
from siftlane.operators.components import joined_by_key

LARGEST = 1 << 25
LEAF = 16
#: Points of leaves that are compared with all entries at once.
POINTS = 1 << 13


def whole_numbers(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int) -> DataFrame:
    """(vec_id, label, v): the rows that are kept so far, components as whole numbers."""
    own = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("v"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    cut = lambda x: F.greatest(F.lit(-LARGEST), F.least(F.lit(LARGEST), F.floor(F.greatest(F.lit(-1e15), F.least(F.lit(1e15), x * scale)))))
    return own.where((F.size("v") > 0) & F.coalesce(fine, F.lit(False))).withColumn("v", F.transform("v", lambda x: cut(x).cast("int")))


def laid(points: np.ndarray, leaf: int = LEAF) -> tuple[np.ndarray, list[np.ndarray]]:
    """The order of points in their kd-tree, and each level's first places: 1, 2, 4, ... cells, halved by rank."""
    n = len(points)
    order, levels, cells = np.arange(n), [], 1
    while True:
        starts = n * np.arange(cells) // cells
        levels.append(starts)
        if n <= leaf * cells:
            return order, levels
        own = points[order]
        side = (np.maximum.reduceat(own, starts) - np.minimum.reduceat(own, starts)).argmax(axis=1)
        cell = np.repeat(np.arange(cells), np.diff(np.r_[starts, n]))
        order = order[np.lexsort((own[np.arange(n), side[cell]], cell))]
        cells *= 2


@dataclass
class Tree:
    """Points in the order of their tree; of each level the first places, boxes, sums and counts of its cells."""

    points: np.ndarray
    order: np.ndarray
    starts: list[np.ndarray]
    low: list[np.ndarray]
    high: list[np.ndarray]
    sums: list[np.ndarray]

    @classmethod
    def of(cls, points: np.ndarray) -> Tree:
        order, starts = laid(points)
        own = points[order]
        fold = lambda f, dtype: [f.reduceat(own.astype(dtype, copy=False), s).astype(dtype) for s in starts]
        return cls(own, order, starts, fold(np.minimum, np.int32), fold(np.maximum, np.int32), fold(np.add, np.int64))

    def packed(self) -> bytes:
        parts = [self.points.astype("<i4"), self.order.astype("<i4"), *(x.astype("<i4") for x in self.low), *(x.astype("<i4") for x in self.high), *(x.astype("<i8") for x in self.sums)]
        return b"".join(x.tobytes() for x in parts)

    @classmethod
    def unpacked(cls, data: bytes, n: int, width: int) -> Tree:
        cells, starts = 1, []
        while True:
            starts.append(n * np.arange(cells) // cells)
            if n <= LEAF * cells:
                break
            cells *= 2
        at = 0

        def take(rows: int, columns: int, kind: str) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, kind, rows * columns, at)
            at += out.nbytes
            return out.reshape(rows, columns)

        points, order = take(n, width, "<i4"), take(n, 1, "<i4")[:, 0]
        low, high = ([take(len(s), width, "<i4") for s in starts] for _ in range(2))
        return cls(points, order, starts, low, high, [take(len(s), width, "<i8") for s in starts])

    def assign(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The nearest entry of each point in tree order (ties to the lower index), and each entry's sums and counts."""
        n, width = self.points.shape
        nearest, sums, counts = np.zeros(n, np.int64), np.zeros((len(entries), width), np.int64), np.zeros(len(entries), np.int64)
        entries = entries.astype(np.int64)
        square = (entries**2).sum(axis=1)
        ids = np.arange(len(entries))
        cells, left = np.zeros(1, np.int64), np.ones((1, len(entries)), bool)
        for level, starts in enumerate(self.starts):
            ends = np.r_[starts[1:], n]
            left = self.filtered(level, cells, left, entries, square, ids)
            alone = left.sum(axis=1) == 1
            at, entry = cells[alone], left[alone].argmax(axis=1)
            np.add.at(sums, entry, self.sums[level][at])
            np.add.at(counts, entry, ends[at] - starts[at])
            for a, b, e in zip(starts[at], ends[at], entry):
                nearest[a:b] = e
            cells, left = cells[~alone], left[~alone]
            if level + 1 < len(self.starts):
                cells, left = np.r_[2 * cells, 2 * cells + 1], np.r_[left, left]
        if len(cells):
            sizes = ends[cells] - starts[cells]
            place = np.repeat(starts[cells] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
            owner = np.repeat(np.arange(len(cells)), sizes)
            for i in range(0, len(place), POINTS):
                p = self.points[place[i : i + POINTS]].astype(np.int64)
                far = square - 2 * (p @ entries.T)
                far[~left[owner[i : i + POINTS]]] = np.iinfo(np.int64).max
                nearest[place[i : i + POINTS]] = e = far.argmin(axis=1)
                np.add.at(sums, e, p)
                np.add.at(counts, e, 1)
        return nearest, sums, counts

    def filtered(self, level: int, cells: np.ndarray, left: np.ndarray, entries: np.ndarray, square: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Of the entries left in some cells of a level those that no other one rules out: the entry nearest to the box's middle is held
        against each other one at the corner that lies farthest that one's way."""
        low, high = self.low[level][cells].astype(np.int64), self.high[level][cells].astype(np.int64)
        middle = 2 * square - 2 * ((low + high) @ entries.T)  # twice the distance from the middle, but for what all entries share
        best = np.where(left, middle, np.iinfo(np.int64).max).argmin(axis=1)
        way = entries[None, :, :] - entries[best][:, None, :]
        corner = np.where(way > 0, high[:, None, :], low[:, None, :])
        farther = square[None, :] - square[best][:, None] - 2 * (way * corner).sum(axis=2)
        return left & ((farther < 0) | (farther == 0) & (ids <= best[:, None]))


def slice_trees(own: DataFrame, parts: int, dim: int, slice_rows: int) -> DataFrame:
    """A row for each slice: how many rows, their ids and labels, and a tree for each part position."""
    width = dim // parts
    schema = own.select(F.array("vec_id").alias("ids"), F.array("label").alias("labels")).schema.add("n", T.IntegerType()).add("trees", T.ArrayType(T.BinaryType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0

        def put(batch: pa.Table) -> pa.RecordBatch:
            v = batch["v"].combine_chunks()
            v = np.asarray((v.chunk(0) if isinstance(v, pa.ChunkedArray) else v).flatten()).reshape(-1, dim)
            trees = [Tree.of(np.ascontiguousarray(v[:, p * width : (p + 1) * width])).packed() for p in range(parts)]
            one = lambda c: pa.array([batch[c].to_pylist()], pa.list_(batch[c].type))
            return pa.RecordBatch.from_arrays([one("vec_id"), one("label"), pa.array([len(v)], pa.int32()), pa.array([trees], pa.list_(pa.binary()))], names=["ids", "labels", "n", "trees"])

        for batch in batches:
            while batch.num_rows:
                some = batch.slice(0, slice_rows - rows)
                held.append(some)
                rows, batch = rows + some.num_rows, batch.slice(some.num_rows)
                if rows == slice_rows:
                    yield put(pa.Table.from_batches(held))
                    held, rows = [], 0
        if rows:
            yield put(pa.Table.from_batches(held))

    return own.mapInArrow(run, schema)


def improved(trees: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round: entries are the floors of their parts' means; unused ones stay."""
    parts, _, width = books.shape
    names = [f"s{k}" for k in range(width)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros(books.shape, np.int64), np.zeros(books.shape[:2], np.int64)
        for batch in batches:
            for n, data in zip(batch["n"].to_pylist(), batch["trees"]):
                for p in range(parts):
                    _, s, c = Tree.unpacked(data[p].as_py(), n, width).assign(books[p])
                    sums[p] += s
                    counts[p] += c
        p, e = np.nonzero(counts)
        if len(p):
            yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in (p, e, counts[p, e], *sums[p, e].T)], names=["part", "entry", "n", *names])

    schema = ", ".join(f"{c} long" for c in ["part", "entry", "n", *names])
    found = trees.select("n", "trees").mapInArrow(run, schema).groupBy("part", "entry").agg(*[F.sum(c).alias(c) for c in ["n", *names]])
    out = books.copy()
    for r in found.collect():  # parts x entries rows at most
        out[r.part, r.entry] = [r[c] // r.n for c in names]
    return out


def codes_of(trees: DataFrame, books: np.ndarray) -> DataFrame:
    """(vec_id, label, code, error) of every vector."""
    parts, _, width = books.shape
    schema = trees.select(F.col("ids")[0].alias("vec_id"), F.col("labels")[0].alias("label")).schema.add("code", "string").add("error", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                n, data = batch["n"][i].as_py(), batch["trees"][i]
                codes, error = np.zeros((n, parts), np.uint16), np.zeros(n, np.int64)
                for p in range(parts):
                    tree = Tree.unpacked(data[p].as_py(), n, width)
                    entry = tree.assign(books[p])[0]
                    codes[tree.order, p] = entry
                    error[tree.order] += ((tree.points - books[p][entry]) ** 2).sum(axis=1)
                digits = 2 if books.shape[1] <= 256 else 4
                text = codes.astype(f">u{digits // 2}").tobytes().hex()
                step = parts * digits
                text = [text[k : k + step] for k in range(0, len(text), step)]
                yield pa.RecordBatch.from_arrays([batch["ids"][i].values, batch["labels"][i].values, pa.array(text, pa.string()), pa.array(error)], names=schema.fieldNames())

    return trees.mapInArrow(run, schema)


def books_digest(books: np.ndarray) -> str:
    """SHA-256 of all entries' components by part, entry and position, as decimals with commas between them."""
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


@dataclass
class Codes:
    """Codebooks [part, entry, position], and (vec_id, label, code, error) of every kept vector."""

    books: np.ndarray
    rows: DataFrame


def compress(
    vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256, slice_rows: int = 8192
) -> Codes:
    """Codebooks and codes of all vectors. Up to 65,536 entries; the driver holds parts x entries x width numbers."""
    own = whole_numbers(vectors, id_col, vector_col, label_col, scale)
    nulls_last = (F.col("vec_id").isNull(), "vec_id", "v")
    first = own.where(F.size("v") % parts == 0).orderBy(*nulls_last).select(F.size("v").alias("dim")).first()
    dim = first.dim if first else parts
    own = own.where(F.size("v") == dim)
    seeds = np.array([r.v for r in own.orderBy(*nulls_last).select("v").limit(entries).collect()], dtype=np.int64).reshape(-1, parts, dim // parts)
    books = np.ascontiguousarray(seeds.transpose(1, 0, 2))
    trees = checkpointed(slice_trees(own, parts, dim, slice_rows))
    for _ in range(rounds if books.size else 0):
        books = improved(trees, books)
    return Codes(books, codes_of(trees, books))


def label_errors(rows: DataFrame) -> DataFrame:
    """rows with label_error, the error summed over equal labels (nulls together). A label that many rows have keeps them where they are."""
    keyed = rows.withColumn("__label", F.coalesce(F.concat(F.lit("="), F.col("label").cast("string")), F.lit("")))
    sums = checkpointed(keyed.groupBy("__label").agg(F.sum("error").alias("label_error"), F.count("*").alias("__n")))
    return joined_by_key(keyed, sums, "__label", "__n", sums.agg(F.sum("__n")).first()[0] or 0).drop("__label", "__n")
