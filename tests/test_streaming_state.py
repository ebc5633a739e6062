"""Paced hosts against a plain replay, with late requests and states that go; buckets that a batch leaves alone."""

import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from siftlane.streaming import buckets, hosts

START = datetime(2024, 1, 1)


def replay(rows, interval, burst):
    """{id: goes} of (host, id, ms) in order."""
    state, out = {}, {}
    for host, ident, ms in rows:
        left, last = state.get(host, (interval * burst, ms))
        left = min(interval * burst, left + max(0, ms - last))
        out[ident] = left >= interval
        state[host] = (left - interval * out[ident], max(ms, last))
    return out


def test_paced_hosts(spark, tmp_path):
    hosts.state_store(spark)
    r = random.Random(4)
    rows, now = [], 0
    for i in range(400):
        now += r.choice([200, 900, 4000, 30_000])
        rows.append((r.choice("abcde"), i, now))
    late = ("a", 9_000, 1000)  # far behind the watermark by then
    schema = "host string, id long, ts timestamp"
    frame = lambda some: spark.createDataFrame([(h, i, START + timedelta(milliseconds=ms)) for h, i, ms in some], schema)
    for k in range(4):
        part = rows[k * 100 : (k + 1) * 100] + ([late, (None, 9_001, now), ("b", 9_002, None)][: 2 if k == 3 else 0] if k == 3 else [])
        frame(part).coalesce(1).write.parquet(str(tmp_path / f"in/{k}"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in/*"))
    got = hosts.paced(stream, interval_s=10, burst=3, keep_s=60, late="20 seconds")
    run = got.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "at")).trigger(availableNow=True).start()
    run.awaitTermination()
    found = {x.id: x for x in spark.read.parquet(str(tmp_path / "out")).collect()}
    want = replay(rows, 10_000, 3)
    assert {i: x.verdict == "go" for i, x in found.items()} == want and 9_000 not in found
    assert 50 < sum(want.values()) < 400
    for x in found.values():
        assert x.free_at == x["at"] if x.verdict == "go" else x.free_at > x["at"]
    kept = [o for p in run.recentProgress for o in p["stateOperators"]]
    assert max(o["numRowsTotal"] for o in kept) >= 5


def test_many_hosts_are_few_states(spark, tmp_path):
    """A batch costs calls for each group of hosts, not for each host; quiet hosts leave their group's state."""
    hosts.state_store(spark)
    r = random.Random(5)
    rows = [(f"h{r.randrange(150)}", i, 2000 * i) for i in range(600)]
    schema = "host string, id long, ts timestamp"
    for k in range(3):
        part = [(h, i, START + timedelta(milliseconds=ms)) for h, i, ms in rows[k * 200 : (k + 1) * 200]]
        spark.createDataFrame(part, schema).coalesce(1).write.parquet(str(tmp_path / f"in/{k}"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in/*"))
    got = hosts.paced(stream, interval_s=60, burst=2, keep_s=200, late="20 seconds", groups=4)
    run = got.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "at")).trigger(availableNow=True).start()
    run.awaitTermination()
    found = {x.id: x.verdict == "go" for x in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert found == replay(rows, 60_000, 2)
    assert max(o["numRowsTotal"] for p in run.recentProgress for o in p["stateOperators"]) <= 4 * 4


def test_a_bucket_must_be_full_before_it_is_forgotten(spark):
    with pytest.raises(ValueError, match="keep_s"):
        hosts.paced(spark.readStream.format("rate").load(), interval_s=60, burst=5, keep_s=100)


def size_of(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(path) for f in fs)


def test_batches_write_their_buckets_only(spark, tmp_path):
    path = str(tmp_path / "t")
    frame = lambda ids, ts, name: spark.createDataFrame([(i, ts, f"{name}{i}") for i in ids], "id long, ts int, name string")
    buckets.put_batch(frame(range(20_000), 1, "a"), 0, path, "id", "ts", 32)
    whole = size_of(f"{path}/data")
    buckets.put_batch(frame([5, 6], 2, "b"), 1, path, "id", "ts", 64)
    more = size_of(f"{path}/data") - whole
    assert more < whole / 8
    assert len(os.listdir(f"{path}/data/v1")) <= 3 + 2  # two buckets, and the committer's marks
    before = sorted(os.listdir(f"{path}/data"))
    buckets.put_batch(frame([7], 9, "c"), 1, path, "id", "ts", 32)  # a batch that was put in already
    assert sorted(os.listdir(f"{path}/data")) == before
    buckets.put_batch(frame([5], 1, "old"), 2, path, "id", "ts", 32)
    buckets.put_batch(frame([], 1, ""), 3, path, "id", "ts", 32)
    rows = buckets.read_buckets(spark, path, frame([1], 1, "a").schema)
    assert rows.count() == 20_000 and {r.name for r in rows.where("ts > 1").collect()} == {"b5", "b6"}
    assert buckets.vacuum(spark, path) >= 4
    assert buckets.read_buckets(spark, path, rows.schema).where("id in (5, 6, 7)").select(F.sort_array(F.collect_list("name"))).first()[0] == ["a7", "b5", "b6"]


def test_a_batch_that_fails_before_its_manifest_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    frame = spark.createDataFrame([(1, 1)], "id long, ts int")
    buckets.put_batch(frame, 0, path, "id", "ts", 4)
    frame.withColumn("bucket", F.lit(0)).write.partitionBy("bucket").parquet(f"{path}/data/v1")  # what a lost driver leaves
    assert buckets.read_buckets(spark, path, frame.schema).collect() == frame.collect()
    buckets.put_batch(spark.createDataFrame([(2, 2)], frame.schema), 1, path, "id", "ts", 4)
    assert sorted(map(tuple, buckets.read_buckets(spark, path, frame.schema).collect())) == [(1, 1), (2, 2)]
