"""Codes and codebooks against plain Lloyd rounds, and the query against its SQL."""

import hashlib
import math
import random

import duckdb
import numpy as np
import pytest

from siftlane.llm import registry, vector_codes

SF = "/root/testdata/sf0.001"


def plain(rows, parts=16, entries=64, rounds=2):
    """{(vec_id, label): [(code, error)]} and the codebooks, straight from the definition."""
    kept = [(i, [max(-(2**25), min(2**25, math.floor(256 * x))) for x in v], k) for i, v, k in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return [], []
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    w = len(kept[0][1]) // parts
    cut = lambda v, p: v[p * w : (p + 1) * w]
    books = [[cut(r[1], p) for r in kept[:entries]] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    best = lambda v, book: min(range(len(book)), key=lambda e: (far(v, book[e]), e))
    for _ in range(rounds):
        for p in range(parts):
            own = {}
            for r in kept:
                own.setdefault(best(cut(r[1], p), books[p]), []).append(cut(r[1], p))
            for e, vs in own.items():
                books[p][e] = [sum(x) // len(vs) for x in zip(*vs)]
    out = []
    for i, v, k in kept:
        code = [best(cut(v, p), books[p]) for p in range(parts)]
        out.append((i, "".join(f"{c:02x}" for c in code), sum(far(cut(v, p), books[p][c]) for p, c in enumerate(code)), k))
    return out, books


def compared(spark, rows, **options):
    made = vector_codes.compress(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, code string, error string, n int, v int").repartition(3), **options)
    got = sorted((tuple(r) for r in vector_codes.label_errors(made.rows).select("vec_id", "code", "error", "label", "label_error").collect()), key=repr)
    want, books = plain([r[:3] for r in rows])
    total = {}
    for _, _, e, k in want:
        total[k] = total.get(k, 0) + e
    assert got == sorted(((*r, total[r[3]]) for r in want), key=repr)
    assert made.books.tolist() == books or not books


def test_against_plain_rounds(spark):
    r = random.Random(5)
    centre = [[r.gauss(0, 0.3) for _ in range(32)] for _ in range(5)]
    rows = [(i * 3, [round(x + r.gauss(0, 0.1), 3) for x in centre[i % 5]], i % 4 or None) for i in range(700)]
    rows += [(5000 + i, rows[7][1], 1) for i in range(300)]  # one common vector
    rows += [(6000 + i, [float(r.randrange(-2, 3)) / 256 for _ in range(32)], 9) for i in range(300)]  # many ties
    compared(spark, [(*x, None, None, 0, 0) for x in rows], slice_rows=128)


@pytest.mark.parametrize("rows", [[], [(1, None, 1)], [(None, None, None), (3, [], None)], "odd"])
def test_edge_cases(spark, rows):
    if rows == "odd":
        v = [0.5] * 16
        rows = [(4, v, None), (4, [0.25] * 16, 2), (None, [1.5] * 16, 2), (2, [None] + v[1:], 1), (1, [float("nan")] + v[1:], 1), (0, [float("inf")] * 16, 1), (7, v * 2, 1), (8, [3e38] * 16, 1), (8, [3e38] * 16, 1), (9, [-0.001] * 16, None)]
    compared(spark, [(*x, None, None, 0, 0) for x in rows])


def test_trees_are_read_back_and_assign_whole_cells():
    points = np.random.default_rng(3).integers(-90, 90, (1000, 4)).astype(np.int32)
    tree = vector_codes.Tree.of(points)
    again = vector_codes.Tree.unpacked(tree.packed(), 1000, 4)
    entries = points[:64].astype(np.int64)
    nearest, sums, counts = again.assign(entries)
    far = ((points[tree.order].astype(np.int64)[:, None] - entries[None]) ** 2).sum(axis=2)
    assert (nearest == far.argmin(axis=1)).all() and (counts == np.bincount(nearest, minlength=64)).all()
    assert (sums == np.array([points[tree.order][nearest == e].sum(axis=0) for e in range(64)])).all()


def test_query_against_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    want = con.execute(registry.ORACLE_SQL["op12_vector_codes"])
    names = [d[0] for d in want.description]
    got = [tuple(r[n] for n in names) for r in registry.op12_vector_codes(spark, SF).collect()]
    assert sorted(got) == sorted(want.fetchall()) and len(got) == 500


def test_digest():
    books = np.array([[[1, -2], [3, 4]], [[5, 6], [7, -8]]])
    assert vector_codes.books_digest(books) == hashlib.sha256(b"1,-2,3,4,5,6,7,-8").hexdigest()
