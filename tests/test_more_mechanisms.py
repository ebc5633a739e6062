"""Sketches that are merged, pipelines that count as they run, and table functions in SQL."""

import pytest
from pyspark.errors import PySparkException

from siftlane.operators import sketches
from siftlane.plans.pipelines import Pipeline
from siftlane.sources import table_functions


def test_sketches_are_written_and_merged(spark, tmp_path):
    df = spark.range(60_000).selectExpr("id % 5 as k", "id % 3 as j", "if(id % 7 = 0, null, id % 20000) as v")
    for part in range(3):
        sketches.sketched(df.where(f"j = {part}"), ("k", "j"), "v").write.parquet(str(tmp_path / str(part)))
    every = spark.read.parquet(*[str(tmp_path / str(p)) for p in range(3)])
    got = {r.k: r for r in sketches.estimated(sketches.merged(every, ("k",))).collect()}
    for r in df.groupBy("k").agg({"v": "count"}).collect():
        assert got[r.k].n == r["count(v)"]
    exact = {r.k: r.n for r in df.groupBy("k").agg({"v": "count"}).selectExpr("k", "0 as n").collect()} | {r.k: r.n for r in df.where("v is not null").select("k", "v").distinct().groupBy("k").count().selectExpr("k", "count as n").collect()}
    assert all(abs(got[k].n_distinct - n) <= sketches.bound() * n for k, n in exact.items())
    whole = sketches.estimated(sketches.merged(every, ())).first().n_distinct
    n = df.where("v is not null").select("v").distinct().count()
    assert abs(whole - n) <= sketches.bound() * n
    assert sketches.estimated(sketches.sketched(df.where("false"), ("k",), "v")).count() == 0


def test_grouping_sets(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", None)], "x string, y int")
    got = sorted((tuple(r) for r in sketches.grouped_counts(df, (("x", "y"), ("x",), ())).select("x", "y", "n", "level").collect()), key=repr)
    assert got == sorted([("a", 1, 1, 0), ("a", 2, 1, 0), ("b", None, 1, 0), ("a", None, 2, 1), ("b", None, 1, 1), (None, None, 3, 3)], key=repr)


def test_a_pipeline_counts_as_it_runs(spark, tmp_path):
    pipe = Pipeline((lambda d: d.where("id % 2 = 0"), lambda d: d.where("id > 50"), lambda d: d.where("id % 2 = 1")))
    rows, seen = pipe.observed(spark.range(100), ("all", "even"))
    rows.write.parquet(str(tmp_path / "out"))
    assert [(name, own.get["n"]) for name, own in seen] == [("all", 100), ("even", 50), ("stage 2", 24), ("stage 3", 0)]


@pytest.fixture
def functions(spark):
    table_functions.register(spark)
    return spark


def test_company_items(functions):
    bodies = ['{"total": 1, "members": [{"name": "a", "mail": "x@y.z"}, 5]}', '{"a": {"b": [{"company": "c", "url": ""}, {"k": 1}]}}', '{"members": [], "a": {"b": {"c": {"d": [{"name": "too deep"}]}}}}', "[{\"name\": \"top\"}]", "junk", "", None]
    functions.createDataFrame(list(enumerate(bodies)), "i int, body string").createOrReplaceTempView("bodies")
    got = functions.sql("SELECT i, t.* FROM bodies, LATERAL company_items(body) t").collect()
    assert sorted((tuple(r) for r in got), key=repr) == sorted([(0, "a", None, "x@y.z", None), (1, "c", None, None, None), (1, None, None, None, None), (3, "top", None, None, None)], key=repr)
    own = functions.sql("SELECT firm FROM bodies, LATERAL company_items(body, 'firm=company|name') WHERE firm IS NOT NULL").collect()
    assert sorted(r.firm for r in own) == ["a", "c", "top"]
    with pytest.raises(PySparkException, match="payload must be text"):
        functions.sql("SELECT * FROM company_items(5)").collect()


def test_table_records(functions):
    rows = [("p", 1, 0, ["Hall plan"]), ("p", 1, 1, ["Exhibitor", "Country", "Stand"]), ("p", 1, 2, ["Alfa", "Brazil", None]), ("p", 1, 3, [" ", "Peru", ""]), ("p", 2, 0, ["nothing", "here"]), ("q", 1, 0, ["Firm", "Web"]), ("q", 1, 1, ["Beta", "b.com"]), ("q", 1, 2, None)]
    functions.createDataFrame(rows, "page string, tab long, row long, cells array<string>").repartition(3).createOrReplaceTempView("cut")
    got = functions.sql("SELECT page, tab, row, company, country, website, booth FROM table_records(TABLE(cut))").collect()
    assert sorted(map(tuple, got)) == [("p", 1, 2, "Alfa", "Brazil", None, None), ("q", 1, 1, "Beta", None, "b.com", None)]
    with pytest.raises(PySparkException, match="row and cells"):
        functions.sql("SELECT * FROM table_records(TABLE(SELECT page FROM cut))").collect()
