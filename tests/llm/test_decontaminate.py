"""Decontamination against a brute-force pass over every item-sized window."""

import random
import re
from collections import Counter

import pytest

from siftlane.llm import decontaminate, registry

SF = "/root/testdata/sf0.001"


def plain_words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def runs(ws, k=5):
    return [" ".join(ws[i : i + k]) for i in range(max(1, len(ws) - k + 1))] if ws else []


def similarity(a, b):
    a, b = Counter(a), Counter(b)
    less = sum(len(s) * min(a[s], b[s]) for s in a | b)
    return less / sum(len(s) * max(a[s], b[s]) for s in a | b)


def brute(docs, items, least=0.8):
    """(doc, item) with the best similarity of all windows of the item's size."""
    out = {}
    for i, text in docs:
        ws = plain_words(text)
        for j, item in items:
            iw = plain_words(item)
            if not iw or not ws or not set(runs(iw)) & set(runs(ws, min(5, len(iw)))) and len(iw) >= 5:
                continue
            best = max(similarity(runs(ws[a : a + len(iw)]), runs(iw)) for a in range(max(1, len(ws) - len(iw) + 1)))
            if best >= least:
                out[i, j] = round(best, 6)
    return out


def best_of(rows):
    out = {}
    for r in rows:
        k = (r.doc_id, r.item_id)
        out[k] = max(out.get(k, 0), round(r.similarity, 6))
    return out


def test_query_against_all_windows(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = brute(docs, items)
    assert best_of(registry.op8_decontaminate(spark, SF).collect()) == want and want


@pytest.mark.parametrize("small", [1_000_000, 0])
def test_edited_passages(spark, small):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 7)))
    items = [(j, " ".join(word() for _ in range(rng.randrange(16, 60)))) for j in range(12)] + [(90, "Two words"), (91, ""), (92, None), (None, "a b c d e f g h")]
    docs = [(1, None), (2, ""), (3, "two, words"), (None, "pre A b. c d e f g h post")]
    for n in range(120):
        ws = items[n % 12][1].split()
        for _ in range(n % 3):
            ws[rng.choice((0, 1, len(ws) - 1, rng.randrange(len(ws))))] = word()
        docs.append((10 + n, " ".join([*(word() for _ in range(rng.randrange(30))), " ".join(ws).upper(), *(word() for _ in range(rng.randrange(30)))])))
    docs += docs[-3:] + [(500, " ".join(word() for _ in range(40_000)))]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("doc_id", "text", "1 as h", "2 as n", "3 as runs")
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("item_id", "text", "1 as n")
    found = decontaminate.contaminated(df, bench, broadcast_rows=small)
    assert best_of(found.collect()) == brute(docs, items)
    hit = {r.doc_id for r in found.collect()}
    left = decontaminate.without_contaminated(df, found)
    assert left.columns == df.columns
    assert sorted(map(repr, (r.doc_id for r in left.collect()))) == sorted(repr(i) for i, _ in docs if i not in hit)


@pytest.mark.parametrize("side", ["docs", "items"])
def test_empty_tables(spark, side):
    rows, none = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string"), spark.createDataFrame([], "doc_id long, text string")
    docs, items = (none, rows) if side == "docs" else (rows, none)
    assert decontaminate.contaminated(docs, items.withColumnRenamed("doc_id", "item_id")).count() == 0
