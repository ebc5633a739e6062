"""Paged answers: the stop rule against a loop over pages, the data source's partitions and filters, and its stream."""

import json
import random

import pytest

from siftlane.sources import files, paged
from siftlane.sources.stores import store_of

ITEM = "company_name string"


def read_in_turn(pages, most):
    """The items of one key's {offset: payload}, asked for page by page."""
    total, out = None, []
    for offset in sorted(pages):
        if offset >= most or (total is not None and offset >= total):
            break
        total = pages[offset].get("total", total)
        items = pages[offset].get("items") or []
        if not items:
            break
        out += [(offset, i["company_name"]) for i in items]
    return out


def made(r):
    for key in range(30):
        pages = {}
        for offset in range(0, 60, 10):
            pages[offset] = {"items": [{"company_name": f"{key}-{offset}-{i}"} for i in range(r.choice([0, 1, 3, 3, 3]))]}
            if r.random() < 0.7:
                pages[offset]["total"] = r.choice([None, 10, 30, 55, 1000])
        yield f"k {key}", pages


@pytest.mark.parametrize("most", [None, 40])
def test_running_total_decides(spark, most):
    want, rows = [], []
    for key, pages in made(random.Random(3)):
        want += [(key, *x) for x in read_in_turn(pages, most or 10**9)]
        rows += [(key, o, json.dumps(p)) for o, p in pages.items()]
    rows += [("broken", 0, "no json"), (None, 0, json.dumps({"items": [{"company_name": "n"}]}))]
    want.append((None, 0, "n"))
    got = files.paged_items(spark.createDataFrame(rows, "country string, offset long, body string"), ITEM, most=most)
    assert sorted((tuple(r) for r in got.selectExpr("country", "offset", "item.company_name").collect()), key=repr) == sorted(want, key=repr)


def test_a_total_that_falls_ends_a_key(spark):
    rows = [("a", o, json.dumps({"total": t, "items": [{"company_name": str(o)}]})) for o, t in ((0, 30), (10, 10), (20, 10))]
    got = files.paged_items(spark.createDataFrame(rows, "country string, offset long, body string"), ITEM)
    assert sorted(r.offset for r in got.collect()) == [0, 10]


def test_source_reads_what_was_kept(spark, tmp_path):
    rows = [(k, o, json.dumps({"k": k, "o": o, "text": "é\nx"})) for k in ("a b", "c/d", "é=1") for o in range(0, 70, 10)]
    paged.keep_answers(spark.createDataFrame(rows, "key string, offset long, body string"), str(tmp_path / "in"))
    every = paged.read_answers(spark, str(tmp_path / "in"), pages=3)
    assert sorted(map(tuple, every.collect())) == sorted(rows)
    assert every.rdd.getNumPartitions() == 9  # three runs of offsets for each key
    some = paged.read_answers(spark, str(tmp_path / "in"), keys=("c/d",), pages=100)
    assert some.rdd.getNumPartitions() == 1 and {r.key for r in some.collect()} == {"c/d"}
    assert paged.read_answers(spark, str(tmp_path / "none")).count() == 0


def test_filters_on_the_key_are_taken_in(spark, tmp_path):
    rows = [(k, o, "{}") for k in "abcd" for o in (0, 10)]
    paged.keep_answers(spark.createDataFrame(rows, "key string, offset long, body string"), str(tmp_path / "in"))
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        some = paged.read_answers(spark, str(tmp_path / "in"), pages=1).where("key in ('a', 'c') and offset > 0")
        assert some.rdd.getNumPartitions() == 4 and sorted((r.key, r.offset) for r in some.collect()) == [("a", 10), ("c", 10)]
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def test_stream_goes_on_at_the_next_page(spark, tmp_path):
    def batch():
        run = paged.stream_answers(spark, str(tmp_path / "in"), pages=2).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "at")).start()
        run.processAllAvailable()
        run.stop()
        return sorted((r.key, r.offset) for r in spark.read.parquet(str(tmp_path / "out")).collect())

    frame = lambda offsets: spark.createDataFrame([(k, o, "{}") for k in "ab" for o in offsets], "key string, offset long, body string")
    paged.keep_answers(frame([0, 10]), str(tmp_path / "in"))
    assert batch() == [("a", 0), ("a", 10), ("b", 0), ("b", 10)]
    paged.keep_answers(frame([20]), str(tmp_path / "in"))
    assert batch() == [("a", 0), ("a", 10), ("a", 20), ("b", 0), ("b", 10), ("b", 20)]


def test_addresses_that_arrow_cannot_open_are_told_at_once(tmp_path):
    assert store_of(f"file://{tmp_path}")[1] == store_of(str(tmp_path))[1] == str(tmp_path)
    assert store_of("dbfs:/a/b")[1] == "/dbfs/a/b"
    with pytest.raises(ValueError, match="plain files"):
        store_of("swift://a/b")
