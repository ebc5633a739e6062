"""Conversation prefix trie: a Cartesian tree over the LCP array of the sorted conversations.

``sequences`` makes of each conversation its turns in order, a turn being 120 bits of the SHA-256 of role and text (20 characters)
and a count of words; texts go no further. ``trie`` takes such sequences:

1. Equal sequences are one row: how many, the least id, and the SHA-256 of their ids. The ids of a sequence are sorted by ranges and joined
   to strings where they lie, so the digest of a sequence that many conversations share is fed few rows, one after the other.
2. The distinct sequences are sorted by ranges of their keys. The LCP array says how many turns each shares with the one before it.
   A partition is a block; the blocks' edges are compared by their first and last keys.
3. A node of the trie that branches or ends is an interval of the array between the nearest smaller values on both sides of a position. They are found in
   parallel: a block keeps those positions that no later (earlier) value in it undercuts, and the blocks' minima say which later (earlier) blocks see
   each of these. With what it sees from both sides a block runs the two stacks over its own positions alone. Positions of equal value between the same
   bounds are one node; only nodes that cross a block's edge are merged across blocks.
4. Sums over an interval are differences of prefix sums, the least id comes along on the stacks, and the depths between a node and its
   parent, where nothing branches, are filled in at the end. A node's parent is a join on interval and depth, in which the children of very common parents stay where they are.

The driver holds a few numbers for each block. A task holds a block: the distinct sequences over the number of ``blocks``.

Per node: the least member, its depth and its parent's least member; members; children; childless nodes in its
subtree; words saved by sharing: over the subtree, (members - 1) times the words of a node's last turn; the digest of the ids that end there.

Nulls: a null role or text is empty. Rows without a conversation id are dropped; a null turn comes first. Turns of equal number go by their digests.
Repeated rows are turns of their own. A conversation without turns ends at the root. An empty table has no nodes. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftlane.llm.common import checkpointed, whole_text
from siftlane.operators.components import joined_by_key

#: Characters of a turn in a key.
TOKEN = 20
#: Ids in one string of a digest's input.
IDS = 4096
MOST = np.iinfo(np.int64).max
NO_ENDS = hashlib.sha256(b"").hexdigest()


def sequences(turns: DataFrame, *, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, turns): each conversation's turns in order, as (token, words)."""
    role, text = whole_text(role_col), whole_text(text_col)
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    own = turns.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"), F.base64(F.substring(F.unhex(digest), 1, TOKEN * 3 // 4)).alias("d"), F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).alias("w")
    )
    listed = own.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(F.col("turn").isNotNull().alias("known"), "turn", "d", "w"))).alias("t"))
    return listed.select("conv_id", F.transform("t", lambda x: F.struct(x["d"].alias("d"), x["w"].alias("w"))).alias("turns"))


def with_shared_heads(found: DataFrame, group: int = 20, heads: int = 4) -> DataFrame:
    """The sequences with their first h turns taken from the first conversation of their group of ids: h is the CRC-32 of the
    id's decimals modulo ``heads``, the groups start at multiples of ``group``. A group without its first conversation gives none."""
    found = checkpointed(found)
    base = F.col("conv_id") - F.pmod("conv_id", F.lit(group))
    first = found.where(base == F.col("conv_id")).select(F.col("conv_id").alias("base"), F.slice("turns", 1, heads - 1).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("int")
    own = found.withColumn("base", base).withColumn("h", h).join(first, "base", "left")
    head = F.when(F.col("h") > 0, F.slice(F.coalesce("head", F.slice("turns", 1, 0)), F.lit(1), F.col("h"))).otherwise(F.slice("turns", 1, 0))
    return own.select("conv_id", F.concat(head, F.slice("turns", F.col("h") + 1, F.size("turns"))).alias("turns"))


def id_digests(ids: DataFrame, parts: int) -> DataFrame:
    """(seq, ends): SHA-256 of the decimal ids of each seq, ascending, with commas between them."""

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seq, own = batch["seq"].to_pylist(), np.asarray(batch["conv_id"])
            text = pc.cast(batch["conv_id"], pa.string()).to_pylist()
            cuts, start = [], 0
            for i in range(1, len(seq) + 1):
                if i == len(seq) or seq[i] != seq[start] or i - start == IDS:
                    cuts.append((start, i))
                    start = i
            if cuts:
                yield pa.RecordBatch.from_pydict({"seq": pa.array([seq[a] for a, _ in cuts], pa.binary()), "first": own[[a for a, _ in cuts]], "ids": [",".join(text[a:b]) for a, b in cuts]})

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            out = []
            for seq, ids in zip(batch["seq"].to_pylist(), batch["ids"].to_pylist()):
                if seq == now:
                    state.update(b",")
                else:
                    if state:
                        out.append((now, state.hexdigest()))
                    now, state = seq, hashlib.sha256()
                state.update(ids.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.binary()), pa.array([x[1] for x in out])], names=["seq", "ends"])
        if state:
            yield pa.RecordBatch.from_arrays([pa.array([now], pa.binary()), pa.array([state.hexdigest()])], names=["seq", "ends"])

    lines = ids.repartitionByRange(parts, "seq", "conv_id").sortWithinPartitions("seq", "conv_id").mapInArrow(joined, "seq binary, first long, ids string")
    return lines.repartition(parts, "seq").sortWithinPartitions("seq", "first").mapInArrow(hashed, "seq binary, ends string")


def common_turns(a: str, b: str) -> int:
    """How many tokens two keys share from the start."""
    at = 0
    while a[at : at + TOKEN] == b[at : at + TOKEN] and at < len(a) and at < len(b):
        at += TOKEN
    return at // TOKEN


ROWS = "block int, i long, lcp int, next int, n int, copies long, least long, words array<int>, ends string, first string, last string"


def sorted_blocks(distinct: DataFrame, blocks: int) -> DataFrame:
    """The rows sorted, a partition being a block: the turns shared with the row before and behind (null at a block's edges), and the
    keys at the edges."""
    names = [x.split(" ")[0] for x in ROWS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block, i, before, held = TaskContext.get().partitionId(), 0, None, None

        def put(rows: pa.Table, lcp: list, after: int | None, last: str | None) -> pa.RecordBatch:
            m = rows.num_rows
            words = rows["words"].combine_chunks()
            words = pa.concat_arrays(words.chunks) if isinstance(words, pa.ChunkedArray) else words
            columns = {
                "block": pa.array(np.full(m, block, np.int32)), "i": pa.array(np.arange(i, i + m)), "lcp": pa.array(lcp, pa.int32()), "next": pa.array([*lcp[1:], after], pa.int32()), "n": pc.list_value_length(words),
                "copies": rows["copies"].combine_chunks(), "least": rows["least"].combine_chunks(), "words": words, "ends": rows["ends"].combine_chunks(),
                "first": pa.array([rows["key"][0].as_py() if not i else None] + [None] * (m - 1), pa.string()), "last": pa.array([None] * (m - 1) + [last], pa.string()),
            }
            return pa.RecordBatch.from_arrays([columns[c] for c in names], names=names)

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch["key"].to_pylist()
            lcp = [common_turns(a, b) if a is not None else None for a, b in zip([before, *keys], keys)]
            if held is not None:
                yield put(*held, lcp[0], None)
                i += held[0].num_rows
            held, before = (pa.Table.from_batches([batch]), lcp), keys[-1]
        if held is not None:
            yield put(*held, None, before)

    return checkpointed(distinct.repartitionByRange(blocks, "key").sortWithinPartitions("key").mapInArrow(run, ROWS))


class Edges:
    """The order of the blocks that have rows, and the turns that each block's first row shares with the row before it."""

    def __init__(self, rows: DataFrame):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            before = None
            for batch in batches:
                lcp = []
                for first, last in zip(batch["first"].to_pylist(), batch["last"].to_pylist()):
                    lcp.append(-1 if before is None else common_turns(before, first))
                    before = last
                yield pa.RecordBatch.from_arrays([batch["block"], pa.array(lcp, pa.int32())], names=["block", "lcp"])

        keys = rows.where("first is not null or last is not null").groupBy("block").agg(F.max("first").alias("first"), F.max("last").alias("last"))
        found = keys.repartition(1).sortWithinPartitions("block").mapInArrow(run, "block int, lcp int").collect()
        self.rank = {r.block: k for k, r in enumerate(found)}
        self.lcp = [r.lcp for r in found] + [-1]  # behind the last block there is the end


class Block:
    """A block's rows as arrays, with what precedes each of its positions in the block."""

    def __init__(self, rows: pa.Table, edges: Edges):
        rows = rows.sort_by("i")
        self.rank = edges.rank[rows["block"][0].as_py()]
        column = lambda c: np.asarray(rows[c].combine_chunks().fill_null(0))
        self.lcp, self.next, self.n = column("lcp").astype(np.int64), column("next").astype(np.int64), column("n").astype(np.int64)
        self.lcp[0], self.next[-1] = edges.lcp[self.rank], edges.lcp[self.rank + 1]
        self.copies, self.least = column("copies"), column("least")
        self.ends = rows["ends"].to_pylist()
        words = rows["words"].combine_chunks()
        words = pa.concat_arrays(words.chunks) if isinstance(words, pa.ChunkedArray) else words
        flat = np.asarray(words.flatten()).astype(np.int64)
        self.m = len(self.n)
        self.at = np.cumsum(self.n + 1) - (self.n + 1)  # where a row's sums of words begin: no turn, one turn, ...
        total = np.r_[0, np.cumsum(flat)]
        offset = np.cumsum(self.n) - self.n
        place = np.arange(len(flat) + self.m) - np.repeat(np.arange(self.m), self.n + 1)
        self.sums = total[place] - np.repeat(total[offset], self.n + 1)
        self.before = self.sums[self.at + np.maximum(self.lcp, 0)]  # words of what a row shares with the one before
        whole = self.sums[self.at + self.n]
        prefix = lambda x: np.r_[0, np.cumsum(x)]
        #: Up to each position: conversations, their words, words of new nodes, leaves.
        self.upto = np.stack([prefix(self.copies), prefix(self.copies * whole), prefix(whole - self.before), prefix(self.next < self.n)])


SEEN = "block int, side int, pos long, value int, c long, w long, fresh long, leaves long, least long, n int, pre long, ends string"
NAMES = [x.split(" ")[0] for x in SEEN.split(", ")]


def seen_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string()}
    return pa.RecordBatch.from_arrays([pa.array(list(c), kinds[x.split(" ")[1]]) for c, x in zip(zip(*rows), SEEN.split(", "))], names=NAMES)


def summaries(rows: DataFrame, edges: Edges) -> DataFrame:
    """For each block its sums (side 0), and the positions that other blocks may see: those below all earlier values of the
    block (side 1) and those below all later ones (side 2), with the least id from there to the block's edge."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        b = Block(pa.Table.from_batches(held), edges)
        own = edges_block[b.rank]
        out = [(own, 0, b.m, int(b.lcp.min()), *b.upto[:, -1].tolist(), int(b.least.min()), 0, 0, None)]
        entry = lambda k, side, least: (own, side, int(k), int(b.lcp[k]), *b.upto[:, k].tolist(), least, int(b.n[k]), int(b.before[k]), b.ends[k])
        first = np.flatnonzero(np.r_[True, b.lcp[1:] < np.minimum.accumulate(b.lcp)[:-1]])
        up = np.minimum.accumulate(b.least)
        out += [entry(k, 1, int(up[k - 1]) if k else int(MOST)) for k in first]
        back = b.lcp[::-1]
        last = b.m - 1 - np.flatnonzero(np.r_[True, back[1:] < np.minimum.accumulate(back)[:-1]])
        down = np.minimum.accumulate(b.least[::-1])[::-1]
        out += [entry(k, 2, int(down[k])) for k in last]
        yield seen_batch(out)

    edges_block = sorted(edges.rank)
    return rows.drop("first", "last").mapInArrow(run, SEEN)


class Bases:
    """The blocks' sums laid end to end, their minima and least ids."""

    def __init__(self, found: DataFrame, edges: Edges):
        own = sorted(found.where("side = 0").collect(), key=lambda r: r.block)  # a row for each block
        sums = np.array([[r.pos, r.c, r.w, r.fresh, r.leaves] for r in own], np.int64).reshape(-1, 5)
        self.sums = np.r_[np.zeros((1, 5), np.int64), np.cumsum(sums, axis=0)]
        self.low, self.least = np.array([r.value for r in own]), np.array([r.least for r in own], np.int64)
        self.blocks, self.rank = sorted(edges.rank), edges.rank


def visible(found: DataFrame, bases: Bases) -> DataFrame:
    """What each block sees: positions of earlier blocks (side 2) that no block between undercuts, of later ones (side 1) likewise.
    The block that does so sees them too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for _, side, pos, value, c, w, fresh, leaves, least, n, pre, ends in zip(*(batch[x].to_pylist() for x in NAMES)):
                r = bases.rank[_]
                base = bases.sums[r].tolist()
                row = (side, base[0] + pos, value, base[1] + c, base[2] + w, base[3] + fresh, base[4] + leaves)
                for b in range(r + 1, len(bases.low)) if side == 2 else range(r - 1, -1, -1):
                    out.append((bases.blocks[b], *row, least, n, pre, ends))
                    if bases.low[b] <= value:
                        break
                    least = min(least, int(bases.least[b]))
                if len(out) > 10_000:
                    yield seen_batch(out)
                    out = []
            if out:
                yield seen_batch(out)

    return found.where("side > 0").mapInArrow(run, SEEN)


FOUND = "l long, depth int, top int, pl long, crosses boolean, equal long, n_convs long, least long, leaves long, saved long, own int, ends string, words array<long>"


def intervals(block: Block, seen: list[dict], base: list[int], end: list[int], later: int) -> pa.Table:
    """The nodes that have a position in the block (interval nodes) or are one row's own (leaves); see ``FOUND``: l is the row before
    which the nearest smaller value on the left stands, top and pl are depth and l of the parent, own says whether the first
    row goes on below the node, words are those of the turns above each depth. base and end are the sums before the block and of all
    rows, later the least id of the blocks behind."""
    start, m, lcp, least = base[0], block.m, block.lcp.tolist(), block.least.tolist()
    upto = (block.upto + np.array(base[1:], np.int64)[:, None]).T.tolist()
    behind = sorted((s for s in seen if s["side"] == 2), key=lambda s: s["pos"])
    ahead = sorted((s for s in seen if s["side"] == 1), key=lambda s: -s["pos"])
    at = lambda k: {"pos": start + k, "value": lcp[k], "sums": upto[k], "n": int(block.n[k]), "pre": int(block.before[k]), "ends": block.ends[k]}
    far = lambda s: {"pos": s["pos"], "value": s["value"], "sums": [s["c"], s["w"], s["fresh"], s["leaves"]], "n": s["n"], "pre": s["pre"], "ends": s["ends"]}

    # left to right: the nearest smaller value, the one before that, and the least id from there on; entries are [value, place, least id]
    places = [far(s) for s in behind]
    stack = [[s["value"], k - len(behind), s["least"]] for k, s in enumerate(behind)]
    left, below, low, group, groups, equal = [0] * m, [None] * m, [0] * m, [0] * m, [], []
    for k in range(m):
        value, same = lcp[k], None
        while stack and stack[-1][0] >= value:
            was = stack.pop()
            if was[0] == value and was[1] >= 0:
                same = group[was[1]]
            if stack:
                stack[-1][2] = min(stack[-1][2], was[2])
        left[k] = stack[-1][1] if stack else None
        below[k] = stack[-2][1] if len(stack) > 1 else None
        low[k] = stack[-1][2] if stack else MOST
        if same is None:
            same = len(groups)
            groups.append(k)
            equal.append(0)
        group[k] = same
        equal[same] += 1
        stack.append([value, k, least[k]])
    # right to left
    last = [far(s) for s in ahead]
    end_of_all = {"pos": end[0], "value": -1, "sums": end[1:]}
    stack = [[-1, None, later], *([s["value"], -1 - k, s["least"]] for k, s in enumerate(ahead))]
    right, high = [None] * m, [0] * m
    for k in range(m - 1, -1, -1):
        if lcp[k] < 0:  # the very first row: no node begins before it
            break
        stack[-1][2] = min(stack[-1][2], least[k])
        while stack[-1][0] >= lcp[k]:
            was = stack.pop()
            stack[-1][2] = min(stack[-1][2], was[2])
        right[k], high[k] = stack[-1][1], stack[-1][2]
        stack.append([lcp[k], k, MOST])

    on_left = lambda p: at(p) if p >= 0 else places[p]
    on_right = lambda p: end_of_all if p is None else at(p) if p >= 0 else last[-1 - p]
    out: dict[str, list] = {x.split(" ")[0]: [] for x in FOUND.split(", ")}
    slices: list[tuple[int, int, int]] = []

    def put(depth, first, beyond, second, crosses, equal, least, k):
        """One node: first its first row, second the row before which the nearest smaller value on the left of first stands."""
        top = max(first["value"], beyond["value"])
        convs, words, fresh, leaves = (b - a for a, b in zip(first["sums"], beyond["sums"]))
        row = (first["pos"], depth, top, None if top < 0 else first["pos"] if beyond["value"] > first["value"] else second, crosses, equal, convs, least, leaves, words - fresh - first["pre"])
        for c, x in zip(out, (*row, int(first["n"] > depth), first["ends"] if first["n"] == depth else NO_ENDS)):
            out[c].append(x)
        slices.append((k, top, depth))

    for g, k in enumerate(groups):
        if lcp[k] >= 0:
            a, b = on_left(left[k]), on_right(right[k])
            second = None if below[k] is None else start + below[k] if below[k] >= 0 else places[below[k]]["pos"]
            put(lcp[k], a, b, second, a["pos"] < start or b["pos"] > start + m, equal[g], min(low[k], high[k]), k)
    for k in range(m):
        if block.n[k] > max(lcp[k], block.next[k]):
            beyond = {"pos": start + k + 1, "value": int(block.next[k]), "sums": upto[k + 1]}
            second = None if left[k] is None else start + left[k] if left[k] >= 0 else places[left[k]]["pos"]
            put(int(block.n[k]), at(k), beyond, second, False, 0, least[k], k)
    k, top, depth = (np.array(x, np.int64) for x in zip(*slices)) if slices else (np.zeros(0, np.int64),) * 3
    size = depth - top
    step = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    words = block.sums[np.repeat(block.at[k], size) + np.maximum(np.repeat(top, size) + step, 0)]
    kinds = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "string": pa.string()}
    columns = [pa.array(out[c], kinds[t]) for c, t in (x.split(" ") for x in FOUND.split(", ")[:-1])]
    return pa.Table.from_arrays([*columns, pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(size)], pa.int32()), pa.array(words))], names=list(out))


def trie(found: DataFrame, *, blocks: int | None = None) -> DataFrame:
    """The nodes of the trie of sequences (conv_id, turns): conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    spark = found.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = found.select("conv_id", F.array_join(F.transform("turns", lambda t: t["d"]), "").alias("key"), F.transform("turns", lambda t: t["w"].cast("int")).alias("words"))
    keyed = checkpointed(keyed.select("conv_id", F.unhex(F.sha2("key", 256)).alias("seq"), "key", "words"))
    ends = id_digests(keyed.select("seq", "conv_id"), parts)
    distinct = keyed.groupBy("seq").agg(F.count("*").alias("copies"), F.min("conv_id").alias("least"), F.first(F.struct("key", "words")).alias("x"))
    distinct = checkpointed(distinct.join(ends, "seq").select("x.key", "x.words", "copies", "least", "ends"))

    rows = sorted_blocks(distinct, blocks or parts)
    edges = Edges(rows)
    marks = checkpointed(summaries(rows, edges))
    bases = Bases(marks, edges)

    def nodes_of(own: pa.Table, seen: pa.Table) -> pa.Table:
        block = Block(own, edges)
        later = int(bases.least[block.rank + 1 :].min(initial=MOST))
        return intervals(block, seen.to_pylist(), bases.sums[block.rank].tolist(), bases.sums[-1].tolist(), later)

    seen = visible(marks, bases)
    made = checkpointed(rows.drop("first", "last").groupBy("block").cogroup(seen.groupBy("block")).applyInArrow(nodes_of, FOUND))
    rest = [c for c in made.columns if c not in ("l", "depth", "equal")]
    merged = made.where("crosses").groupBy("l", "depth").agg(F.sum("equal").alias("equal"), F.first(F.struct(*rest)).alias("x")).select("l", "depth", "equal", "x.*")
    nodes = checkpointed(made.where("not crosses").unionByName(merged).withColumn("children", F.col("equal") + F.when((F.col("equal") > 0), F.col("own")).otherwise(0)).drop("crosses", "equal", "own"))

    parents = nodes.select(F.struct("l", "depth").alias("up"), F.col("least").alias("up_least"), "children")
    inner = nodes.where("top >= 0").withColumn("up", F.struct(F.col("pl").alias("l"), F.col("top").alias("depth")))
    inner = joined_by_key(inner.withColumnRenamed("children", "own_children"), parents, "up", "children", nodes.count()).drop("up", "children").withColumnRenamed("own_children", "children")
    placed = inner.unionByName(nodes.where("top < 0").withColumn("up_least", F.lit(None).cast("long")))
    deep = placed.select("*", F.posexplode("words").alias("k", "above")).withColumn("d", F.col("top") + 1 + F.col("k"))
    bottom = F.col("d") == F.col("depth")
    return deep.select(
        F.col("least").alias("conv_id"),
        F.col("d").cast("long").alias("depth"),
        F.when(F.col("d") == 0, None).when(F.col("k") == 0, F.col("up_least")).otherwise(F.col("least")).alias("parent_conv_id"),
        "n_convs",
        F.when(bottom, F.col("children")).otherwise(F.lit(1)).cast("long").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        (F.col("saved") - (F.col("n_convs") - 1) * F.col("above")).alias("saved_tokens"),
        F.when(bottom, F.col("ends")).otherwise(F.lit(NO_ENDS)).alias("ends_sha256"),
    )
