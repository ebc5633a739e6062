"""Best-fit packing into several permitted sequence lengths.

``pack_tokens`` lays real token ids: a row for each sequence, with its ids and the bounds of the documents in it.
``pack`` places pieces by their lengths alone: a document's tokens are then its words between ASCII
white space and an end token, unless a length column is given. A document longer than the greatest permitted length is cut into pieces of that
length and a rest; no token is lost. Pieces are dealt evenly into shards of about
``shard_pieces`` pieces by a hash, and each shard is packed by itself, so no task sees more
than its shard and the waste is a few sequences for each shard.

In a shard the pieces go from long to short, each into the open sequence that it fills best
(the least room left). If none has room, a sequence is opened: for each permitted length that
holds the piece, the pieces still to come are laid in greedily, the longest that fits first, and
the length of least cost for each token laid in is taken. At the end each sequence is cut down
to the least permitted length that holds its contents. The whole is done once for every subset
of the lengths that has the greatest (which a full piece needs), only its lengths being opened, and the
cheapest outcome is kept. The cost of a sequence is its length and ``overhead``.

Nulls: a null or empty text is one end token. A null length counts as 1, one below 1 as 1. Null ids are
kept. Repeated rows are packed as often as they stand. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftlane.llm.common import checkpointed, memory_returned, slices, whole_text
from siftlane.llm.token_ids import encode_rows, id_type, splits_at_spaces

CAPACITIES = (512, 1024, 2048)
OVERHEAD = 16
#: Bytes of text whose words are looked up together.
SLICE_BYTES = 12 << 20


def word_tokens(text: Column) -> Column:
    """Words between ASCII white space, and one for the end."""
    return F.size(F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")) + 1


def fill(lengths: np.ndarray, capacities: tuple[int, ...], overhead: int) -> tuple[list[int], list[int], list[int]]:
    """Best fit of lengths that go down: each piece's sequence and place, and the sequences' contents."""
    most = max(capacities)
    counts = np.bincount(lengths, minlength=most + 1).tolist()
    left = sum(1 << n for n, c in enumerate(counts) if c)  # bit n: pieces of length n are still to come
    room: list[list[int]] = [[] for _ in range(most + 1)]  # open sequences by the room they have
    rooms = 0  # bit r: there are sequences with room r
    used: list[int] = []
    where, place = [], []

    def promise(n: int, capacity: int) -> float:
        """Cost for each token of a sequence opened for a piece of length n."""
        free, taken, bits = capacity - n, {n: 1}, left
        while free > 0:
            fits = bits & ((1 << (free + 1)) - 1)
            if not fits:
                break
            m = fits.bit_length() - 1
            take = min(counts[m] - taken.get(m, 0), free // m)
            if take <= 0:
                bits &= ~(1 << m)
                continue
            taken[m] = taken.get(m, 0) + take
            free -= take * m
        return (capacity + overhead) / (capacity - free)

    for n in lengths.tolist():
        fits = rooms >> n
        if fits:
            r = n + (fits & -fits).bit_length() - 1
            at = room[r].pop()
            if not room[r]:
                rooms &= ~(1 << r)
        else:
            capacity = min((c for c in capacities if c >= n), key=lambda c: (promise(n, c), c))
            at, r = len(used), capacity
            used.append(0)
        where.append(at)
        place.append(used[at])
        used[at] += n
        if r > n:
            room[r - n].append(at)
            rooms |= 1 << (r - n)
        counts[n] -= 1
        if not counts[n]:
            left &= ~(1 << n)
    return where, place, used


def pack_shard(lengths: np.ndarray, capacities: tuple[int, ...], overhead: int) -> tuple[list[int], list[int], list[int]]:
    """The cheapest of the fills: each piece's sequence, its place there, and the sequences' final lengths."""
    sizes = sorted(capacities)
    best = None
    for some in (x for n in range(len(sizes)) for x in combinations(sizes[:-1], n)):
        where, place, used = fill(lengths, (*some, sizes[-1]), overhead)
        final = [sizes[int(np.searchsorted(sizes, u))] for u in used]
        cost = sum(final) + overhead * len(final)
        if best is None or cost < best[0]:
            best = cost, where, place, final
    return best[1:]


PACKED = "piece integer, start long, n_tokens integer, bin_id long, bin_capacity integer, bin_offset integer"


def pack(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    length_col: str | None = None,
    capacities: tuple[int, ...] = CAPACITIES,
    overhead: int = OVERHEAD,
    shard_pieces: int = 2048,
) -> DataFrame:
    """One row for each piece: doc_id, piece, start (its first token), n_tokens, bin_id, bin_capacity, bin_offset (its
    first token's place in the sequence)."""
    capacities, most = tuple(sorted(set(capacities))), max(capacities)
    length = F.coalesce(F.col(length_col).cast("long"), F.lit(1)) if length_col else word_tokens(whole_text(text_col)).cast("long")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.greatest(length, F.lit(1)).alias("n"), F.monotonically_increasing_id().alias("row"))
    rows = checkpointed(rows)
    pieces = rows.select("doc_id", "row", "n", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / most))).alias("piece"))
    pieces = pieces.select("doc_id", "row", F.col("piece").cast("int").alias("piece"), (F.col("piece") * most).alias("start"), F.least(F.lit(most), F.col("n") - F.col("piece") * most).cast("int").alias("n_tokens"))
    total = rows.agg(F.sum(F.floor((F.col("n") - 1) / most) + 1)).first()[0] or 0
    shards = max(1, -(-total // shard_pieces))
    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64("row", "piece"), F.lit(shards)))
    schema = dealt.select("doc_id").schema
    for part in PACKED.split(", "):
        schema = schema.add(*part.split(" "))

    def run(table: pa.Table) -> pa.Table:
        lengths = np.asarray(table["n_tokens"], dtype=np.int64)
        order = np.lexsort((np.asarray(table["piece"]), np.asarray(table["row"]), -lengths))
        table, lengths = table.take(pa.array(order)), lengths[order]
        where, place, final = pack_shard(lengths, capacities, overhead)
        base = int(table["shard"][0].as_py()) << 32
        bins = np.asarray(where, dtype=np.int64)
        own = [pa.array(bins + base), pa.array(np.asarray(final)[bins], pa.int32()), pa.array(place, pa.int32())]
        return pa.table([*(table[c] for c in ("doc_id", "piece", "start", "n_tokens")), *own], schema=pa.schema([*(table.schema.field(c) for c in ("doc_id", "piece", "start", "n_tokens")), pa.field("bin_id", pa.int64()), pa.field("bin_capacity", pa.int32()), pa.field("bin_offset", pa.int32())]))

    return dealt.groupBy("shard").applyInArrow(run, schema)


def token_pieces(docs: DataFrame, tokenizer_file: str, most: int, *, id_col: str, text_col: str, end_id: int) -> DataFrame:
    """(doc_id, row, piece, start, n_tokens, ids): every document's ids and an end id, cut into pieces of up to ``most``;
    ids are little-endian unsigned numbers, row is different for each row of docs."""
    by_word, kind = splits_at_spaces(tokenizer_file), id_type(tokenizer_file, end_id)
    width = np.dtype(kind).itemsize
    rows = docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("__text"))
    schema = rows.select("doc_id").schema
    for name, of in (("row", "long"), ("piece", "integer"), ("start", "long"), ("n_tokens", "integer"), ("ids", "binary")):
        schema = schema.add(name, of)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            for own in slices(batch, "__text", SLICE_BYTES):
                ids, ends = encode_rows(own["__text"], tokenizer_file, end_id, by_word)
                sizes = np.diff(np.r_[0, ends])
                pieces = -(-sizes // most)
                at = np.repeat(np.arange(len(sizes)), pieces)
                piece = np.arange(len(at)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                n = np.minimum(most, sizes[at] - piece * most)
                data = pa.py_buffer(ids.astype(kind))
                bounds = pa.py_buffer(np.r_[0, np.cumsum(n * width)].astype(np.int32).tobytes())
                laid = pa.Array.from_buffers(pa.binary(), len(at), [None, bounds, data])
                yield pa.RecordBatch.from_arrays([own["doc_id"].take(pa.array(at)), pa.array(row + at), pa.array(piece, pa.int32()), pa.array(piece * most), pa.array(n, pa.int32()), laid], names=schema.fieldNames())
                row += own.num_rows
            batch = own = ids = ends = at = n = data = bounds = laid = None  # let go before the next is read
            memory_returned()

    return rows.mapInArrow(run, schema)


def pack_tokens(
    docs: DataFrame,
    tokenizer_file: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = 1,
    capacities: tuple[int, ...] = CAPACITIES,
    overhead: int = OVERHEAD,
    shard_pieces: int = 2048,
) -> DataFrame:
    """One row for each sequence: bin_id, bin_capacity, n_tokens; doc_ids, pieces, starts (the piece's first token in its
    document) and lengths of the pieces in it, in order; and ids, all their token ids. Room behind them is not padded."""
    capacities, most, kind = tuple(sorted(set(capacities))), max(capacities), id_type(tokenizer_file, end_id)
    pieces = checkpointed(token_pieces(docs, tokenizer_file, most, id_col=id_col, text_col=text_col, end_id=end_id))
    shards = max(1, -(-pieces.count() // shard_pieces))
    ids_of = pieces.schema["doc_id"].dataType.simpleString()
    schema = f"bin_id long, bin_capacity int, n_tokens int, doc_ids array<{ids_of}>, pieces array<int>, starts array<long>, lengths array<int>, ids array<int>"

    def run(table: pa.Table) -> pa.Table:
        lengths = np.asarray(table["n_tokens"], dtype=np.int64)
        order = np.lexsort((np.asarray(table["piece"]), np.asarray(table["row"]), -lengths))
        where, place, final = pack_shard(lengths[order], capacities, overhead)
        laid = order[np.lexsort((place, where))]  # pieces by sequence, then by place
        table, lengths = table.take(pa.array(laid)), lengths[laid]
        bounds = np.r_[0, np.cumsum(np.bincount(where, minlength=len(final)))].astype(np.int32)
        token_bounds = np.r_[0, np.cumsum(lengths)][bounds].astype(np.int32)
        ids = np.frombuffer(b"".join(table["ids"].to_pylist()), dtype=kind).astype(np.int32)
        listed = lambda c: pa.ListArray.from_arrays(pa.array(bounds), table[c].combine_chunks())
        base = int(table["shard"][0].as_py()) << 32
        memory_returned()
        return pa.table(
            {
                "bin_id": pa.array(base + np.arange(len(final), dtype=np.int64)),
                "bin_capacity": pa.array(final, pa.int32()),
                "n_tokens": pa.array(np.diff(token_bounds), pa.int32()),
                "doc_ids": listed("doc_id"),
                "pieces": listed("piece"),
                "starts": listed("start"),
                "lengths": listed("n_tokens"),
                "ids": pa.ListArray.from_arrays(pa.array(token_bounds), pa.array(ids)),
            }
        )

    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64("row", "piece"), F.lit(shards)))
    return dealt.groupBy("shard").applyInArrow(run, schema)
