"""Files, spreadsheets, tables, cards, sinks, streams and the command line."""

import pytest
from pyspark.sql import functions as F

from siftlane import cli
from siftlane.functions import text as T
from siftlane.functions import web as H
from siftlane.sources import files, sinks
from siftlane.streaming import events


def test_table_records(spark):
    table = [["Hall plan", ""], ["Exhibitor", "Country", "Stand"], ["Alfa", "Brazil", "1A"], ["", "Peru", ""], ["Beta", None, "2"]]
    df = spark.createDataFrame([(1, table), (2, [["nothing"]]), (3, None)], "id int, rows array<array<string>>")
    assert [(r.id, r.record) for r in files.table_records(df).collect()] == [(1, {"company": "Alfa", "country": "Brazil", "booth": "1A"}), (1, {"company": "Beta", "booth": "2"})]


def test_json_items_and_sitemaps(spark):
    df = spark.createDataFrame([(1, '[{"name": "a"}]'), (2, '{"total": 2, "data": [{"name": "b"}, {"name": "c"}]}'), (3, "junk"), (4, None)], "page int, body string")
    assert [(r.page, r.item.name) for r in files.json_items(df, "body", "name string").collect()] == [(1, "a"), (2, "b"), (2, "c")]
    xml = spark.createDataFrame([(1, "<urlset><url><loc> https://a.b/x </loc></url><url><loc>https://a.b/y</loc></url></urlset>")], "id int, xml string")
    assert [r.loc for r in files.sitemap_locations(xml).collect()] == ["https://a.b/x", "https://a.b/y"]


def test_cards(spark):
    html = '<div class="card"><h3>Alfa <b>Textil</b></h3><a href="https://alfa.com">site</a> info@alfa.com +90 212 555 44 33 dyeing</div><div class="card"><a href="/x">Beta</a> trade</div><div class="card"></div>'
    df = spark.createDataFrame([(1, html), (2, None)], "page_id int, html string")
    item = r'(?s)<div class="card">(.*?)</div>'
    got = files.cards(df, item).collect()
    assert [(r.company, r.emails, r.websites) for r in got] == [("Alfa Textil", ["info@alfa.com"], ["https://alfa.com"]), ("Beta", [], [])] and got[0].phones == ["+90 212 555 44 33"]
    assert [r.company for r in files.cards(df, item, keywords=["dyeing"]).collect()] == ["Alfa Textil"]


def test_page_functions(spark):
    html = '<html><script>x</script><!-- no --><nav>menu</nav><p>Tea &amp; more</p><a href="mailto:A@b.co?x">m</a><a href="tel:+1 2">t</a><script type="application/ld+json">{"name": "Alfa", "telephone": "1", "sameAs": ["u"]}</script></html>'
    df = spark.createDataFrame([(html,)], "html string")
    r = df.select(H.main_text("html").alias("t"), H.mailtos("html").alias("m"), H.telephones("html").alias("p"), H.organisation("html").alias("o")).first()
    assert (r.t, r.m, r.p, r.o.name, r.o.sameAs) == ("Tea & more m t", ["a@b.co"], ["+1 2"], "Alfa", ["u"])
    s = spark.createDataFrame([("['a', 'b']",), ("x; y,z",), ("nan",), (None,), ('["q"]',)], "c string")
    assert [x[0] for x in s.select(T.parse_list("c")).collect()] == [["a", "b"], ["x", "y", "z"], [], [], ["q"]]
    m = spark.createDataFrame([("write sales (at) x (dot) com or B@y.org",)], "c string")
    assert "B@y.org" in m.select(T.emails("c")).first()[0]


@pytest.mark.parametrize("keys", [("tier",), ("tier", "region")])
def test_sinks(spark, tmp_path, keys):
    df = spark.range(50).select("id", (F.col("id") % 3).alias("tier"), F.lit("r").alias("region"))
    sinks.write_partitioned(df, str(tmp_path / "p"), *keys)
    assert spark.read.parquet(str(tmp_path / "p")).count() == 50
    sinks.write_csv(df.withColumn("mails", F.array(F.lit("a"), F.lit("b"))), str(tmp_path / "c"))
    assert files.read_csv(spark, str(tmp_path / "c"), "id long, tier long, region string, mails string").where("mails = 'a; b'").count() == 50
    for _ in range(2):
        sinks.append_log(df, str(tmp_path / "log"))
    assert spark.read.parquet(str(tmp_path / "log")).count() == 100
    new = spark.createDataFrame([(1, 9, "new"), (99, 9, "new")], "id long, tier long, region string")
    assert sinks.upserted(df, new, "id").where("tier = 9").count() == 2 and sinks.upserted(df, new, "id").count() == 51


def test_streams(spark, tmp_path):
    src = spark.read.parquet("/root/testdata/sf0.001/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    src.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = events.event_stream(spark, str(tmp_path / "in"), src.schema)
    q = events.window_counts(stream, "1 day", "60 days").writeStream.format("memory").queryName("days").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    want = {(r.start, r.event_type): r.n for r in events.window_counts(src, "1 day").collect()}
    assert {(r.start, r.event_type): r.n for r in spark.sql("select * from days").collect()} == want
    done = events.upsert_batches(stream.selectExpr("user_id", "event_type", "ts"), str(tmp_path / "t"), "user_id", str(tmp_path / "cp"))
    done.awaitTermination()
    versions = {p.name for p in (tmp_path / "t").iterdir() if p.name.startswith("v")}
    last = spark.read.text(str(tmp_path / "t/newest")).first()[0]
    assert versions == {last, f"v{int(last[1:]) - 1}"}
    assert spark.read.parquet(str(tmp_path / "t" / last)).count() == src.select("user_id").distinct().count()
    assert events.sessions(src).agg(F.sum("n")).first()[0] == src.count()


def test_command_line(spark, tmp_path):
    rows = [(1, "Alfa Tekstil A.Ş.", "Turkey", "boyahane", "gots", "https://alfa.com.tr"), (2, "x", "", "", "", "")]
    spark.createDataFrame(rows, "_ord long, company string, country string, context string, source_type string, website string").write.parquet(str(tmp_path / "l.parquet"))
    cli.main(["v9", "--source", str(tmp_path / "l.parquet"), "--out", str(tmp_path / "o"), "--by", "tier"])
    assert [r.company for r in spark.read.parquet(str(tmp_path / "o")).collect()] == ["Alfa Tekstil A.Ş."]


def test_command_line_options(spark, tmp_path):
    rows = [(i, f"Alfa {i} Tekstil A.Ş.", c, "boyahane", t, f"https://alfa{i}.com.tr") for i, (c, t) in enumerate([("Turkey", "gots"), ("turkey ", "brave_search"), ("Egypt", "gots"), ("Turkey", "gots")])]
    spark.createDataFrame(rows, "_ord long, company string, country string, context string, source_type string, website string").write.parquet(str(tmp_path / "l.parquet"))

    def ran(*options):
        cli.main(["v9", "--source", str(tmp_path / "l.parquet"), "--out", str(tmp_path / "o"), *options])
        got = spark.read.parquet(str(tmp_path / "o"))
        assert not any(c.startswith("scan_") for c in got.columns)
        return sorted(r._ord for r in got.collect()), got.columns

    from siftlane import dictionaries as D

    assert ran()[0] == [0, 1, 2, 3] and ran("--countries", "Turkey, Peru")[0] == [0, 1, 3] and ran("--limit", "2")[0] == [0, 1]
    assert ran("--min-priority", str(D.SOURCE_PRIORITY["gots"]))[0] == [0, 2, 3]
    kept, columns = ran("--skip-validation")
    assert kept == [0, 1, 2, 3] and "entity_grade" not in columns
