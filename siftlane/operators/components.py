"""Connected components of an edge table, as joins and aggregations only."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftlane.session import checkpointed


#: Tables of fewer rows are one task's work anyway.
FEW_ROWS = 1 << 16


def joined_by_key(many: DataFrame, one: DataFrame, key: str, size: str, rows: int, share: int = 4096, few: int = 512) -> DataFrame:
    """many (of ``rows`` rows) joined with one, which has a row for each key and in ``size`` how many of many's rows have it.

    Keys of more than rows / share rows (512 at least) can't be more than ``share``: they are broadcast, so that their rows
    stay where they are. All other keys are dealt out by a shuffle, as are tables of ``few`` rows or fewer.
    """
    limit = max(512, rows // share)
    if rows <= max(few, limit):
        return many.join(one, key)
    hot = F.broadcast(one.where(F.col(size) > limit))
    rest = many.join(hot.select(key), key, "left_anti").join(one.where(F.col(size) <= limit), key)
    return many.join(hot, key).unionByName(rest)


#: Edges that a task joins by itself.
TASK_EDGES = 1 << 18


def united(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Edges (u, v), v the least node, that connect the same nodes as edges without nulls: union-find over the edges that a task
    reads together, a few hundred thousand at a time; a node without others is its own edge."""
    kind = edges.schema[src].dataType.simpleString()

    def least_of(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        nodes, index = np.unique(np.concatenate([u, v]), return_inverse=True)
        part, one, two = np.arange(len(nodes)), index[: len(u)], index[len(u) :]
        while True:
            low = np.minimum(part[one], part[two])
            before = part.copy()
            np.minimum.at(part, one, low)
            np.minimum.at(part, two, low)
            np.minimum.at(part, before[one], low)
            np.minimum.at(part, before[two], low)
            part = part[part]
            if (part == before).all():
                return nodes, nodes[part]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in itertools.chain(batches, (None,)):
            if batch is not None and batch.num_rows:
                held.append(batch)
                rows += batch.num_rows
            if held and (batch is None or rows >= 2 * TASK_EDGES):
                table = pa.Table.from_batches(held)
                u, v = least_of(*(table[c].to_numpy() for c in (src, dst)))
                yield pa.RecordBatch.from_arrays([pa.array(u, table[src].type), pa.array(v, table[src].type)], names=["u", "v"])
                held, rows = [], 0

    return edges.select(src, dst).where(F.col(src).isNotNull() & F.col(dst).isNotNull()).mapInArrow(run, f"u {kind}, v {kind}")


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node that has an edge; component is the least node of its component.

    Tasks first join the edges that they hold by union-find, ``TASK_EDGES`` of them or so each; if one task holds them all, that is it. Otherwise
    large and small stars alternate over what the tasks left: each round sends a node's larger neighbours, then its
    smaller ones, to the least neighbour, until the edges are stars. Rounds grow with the
    logarithm of a component's diameter. The least neighbour is a map-side-combined minimum
    joined back to the edges; those of the few hubs that hold many edges are broadcast, so a hub's
    edges are never gathered in one task. Edges with a null end are ignored; a loop makes a component of one node.
    """
    known = checkpointed(edges.select(src, dst).where(F.col(src).isNotNull() & F.col(dst).isNotNull()))
    tasks = -(-known.count() // TASK_EDGES)
    now = checkpointed(united(known.coalesce(max(1, tasks)), src, dst))
    if tasks <= 1:
        return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    mark = lambda df: df.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    nodes = now.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    links, before = now.where("u > v"), None
    rows = links.count()
    for _ in range(max_rounds):
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count("*").alias("n"))
        links = joined_by_key(both, least, "u", "n", 2 * rows, few=FEW_ROWS).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = links.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        small = joined_by_key(links, least, "u", "n", rows, few=FEW_ROWS).select(F.explode(F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m"))).alias("e"))
        links = checkpointed(small.select(F.col("e.u").alias("u"), F.col("e.m").alias("v")).where("u > v").distinct())
        if (after := mark(links)) == before:
            break
        before, rows = after, after.n
    else:
        raise RuntimeError(f"components have not settled in {max_rounds} rounds")
    return nodes.join(links.select(F.col("u").alias("node"), F.col("v").alias("component")), "node", "left").select("node", F.coalesce("component", "node").alias("component"))
