"""Cases in which results once differed from their SQL, or the work grew faster than the table."""

import duckdb
import pytest
from pyspark.sql import functions as F

from siftlane.functions import text as T
from siftlane.operators import dedupe, extract
from siftlane.plans import contacts
from siftlane.sources import files


def test_addresses_of_cards_are_written_ones(spark):
    """prose such as "x at y.com" is no address, and one in capitals is one."""
    html = "<article><h2>Alfa</h2> seen at hain.aenc, Info@Alfa.com</article>"
    df = spark.createDataFrame([(1, html)], "page_id int, html string")
    assert files.cards(df, r"(?is)<article\b[^>]*>(.*?)</article>").first().emails == ["Info@Alfa.com"]


def test_short_hosts_go_by_their_first_label(spark):
    """supplier12345.com has a label of 13 characters."""
    own = spark.createDataFrame([(1, "Supplier12345", "Brazil")], "_ord long, company string, country string")
    url = "https://supplier12345.com/about"
    results = spark.createDataFrame([(1, 1, url, "", "about " + url)], "_ord long, rank int, url string, title string, description string")
    assert [tuple(r) for r in extract.best_website(own, results).collect()] == [(1, "https://supplier12345.com", 7)]


def test_latest_of_tables_with_parts(spark, tmp_path):
    """a folder is one table, with all its parts."""
    for name, n in (("t_2023", 30), ("t_2024", 40)):
        spark.range(n).repartition(4).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert files.read_latest(spark, str(tmp_path / "t_2023.parquet")).count() == 30
    assert files.read_latest(spark, str(tmp_path / "t_*.parquet")).count() == 40
    assert files.read_latest(spark, f"file://{tmp_path}/t_20[0-9][0-3].parquet").count() == 30


def test_bare_names_keep_letters_of_all_alphabets(spark):
    """names that differ in a letter with a mark, or in another alphabet, are two."""
    df = spark.createDataFrame([(1, "Réunés"), (2, "Runs"), (3, "Ткань"), (4, "Нить"), (5, "RÉUNÉS!")], "_ord long, company string").withColumn("source_type", F.lit("gots"))
    assert sorted(r._ord for r in dedupe.by_priority(df, {"gots": 1}).select("_ord").collect()) == [1, 2, 3, 4]


def test_addresses_of_hosts_are_written_ones(spark):
    """F8."""
    pages = spark.createDataFrame([(1, "https://a.org/x", "<p>tish at hain.aenc</p>"), (2, "https://b.org/", "<p>Seo.05@Mail6.com</p>")], "page_id int, url string, html string")
    assert [tuple(r) for r in extract.page_contacts(pages).collect()] == [("b.org", ["Seo.05@Mail6.com"])]


@pytest.mark.parametrize("name", ["osga, asíes asja", "Ltd. Kg-Bau AG", "é ag ñas as", "a-ltd-b group", "ab", "as as oy asx", "Co. Company S.A. x"])
def test_legal_forms_as_the_sql_cuts_them(spark, name):
    """what bounds a form doesn't hang on what Java takes for a word."""
    want = duckdb.connect().execute(f"SELECT {contacts.sql_normal('n')} FROM (SELECT ? AS n)", [name]).fetchone()[0]
    assert spark.createDataFrame([(name,)], "n string").select(T.normalize_company("n")).first()[0] == want


def test_names_are_taken_once(spark):
    """Filters that read a name don't each take it from the whole text again."""
    from siftlane.operators import gates
    from siftlane.plans.leads import leads

    own = gates.entity_gate(leads(spark, "/root/testdata/sf0.001")).where("gate_reason is not null").groupBy("entity_grade").count()
    assert own._jdf.queryExecution().optimizedPlan().toString().count("substring_index(") == 1


def test_crowds_of_like_names(spark):
    """Names of which most resemble each other cost no square of their number; seeds are those of plain code, over several rounds."""
    names = [f"textil {i:06d}"[::-1] for i in range(0, 6000, 4)]
    want, seeds = {}, []
    for i, n in enumerate(names):
        want[i] = next((s for s in seeds if dedupe.resembles(names[s], n, 92.0)), i)
        seeds += [i] if want[i] == i else []
    own = spark.createDataFrame(list(enumerate(names)), "_ord long, company string")
    assert len(names) > dedupe.FIRST_NAMES and {r._ord: r.seed_ord for r in dedupe.similar_names(own).collect()} == want


@pytest.mark.parametrize("size", [3, 70, 400])
def test_resembling_names(size):
    import random

    rng = random.Random(size)
    for _ in range(200):
        a = [rng.choice("abcd ") for _ in range(size)]
        b = list(a)
        for _ in range(rng.randrange(1 + size // 5)):
            b[rng.randrange(size)] = rng.choice(["", "x", "ab"])
        a, b = "".join(a), "".join(b)
        assert dedupe.resembles(a, b, 92.0) == (dedupe.indel_ratio(a, b) >= 92.0)


@pytest.mark.parametrize("size, threshold", [(8, 92.0), (40, 92.0), (200, 92.0), (200, 80.0), (700, 92.0), (1500, 92.0)])
def test_blocks_of_names_lose_no_pair(size, threshold):
    """F1, F2 of round 4."""
    import random

    rng, names = random.Random(size), ["lyhe " * 40, "lyhe " * 44, "x" * 300, "x" * 320, "é" * 9, "é" * 10]
    for _ in range(12):
        base = [rng.choice(["th", "he ", "an", "er", "on ", "reé"]) for _ in range(rng.randrange(size // 4, size // 2))]
        for _ in range(5):
            own = list(base)
            for _ in range(rng.randrange(1 + len(base) // 5)):
                own[rng.randrange(len(own))] = rng.choice(["", "x", "on on "])
            names.append("".join(own) or "x")
    names = sorted(set(names), key=len)
    near = lambda a, b: dedupe.indel_ratio(a, b) >= threshold - 1e-9
    found = [(min(pair), max(pair)) for pair in dedupe.near_in_blocks(names, names, True, threshold)]
    assert sorted(found) == [(i, j) for i in range(len(names)) for j in range(i + 1, len(names)) if near(names[i], names[j])]
    some, others = names[::2], names[1::2]
    found = dedupe.near_in_blocks(some, others, False, threshold)
    assert sorted(found) == [(i, j) for i in range(len(some)) for j in range(len(others)) if near(some[i], others[j])]


@pytest.mark.parametrize("size", [150, 600])
def test_few_long_names_are_compared_by_letters(size, monkeypatch):
    """F1, F2 of round 4: names of common syllables have like counts of characters, but few runs of them in common."""
    import random

    rng, compared, resembles = random.Random(size), [], dedupe.resembles
    syllables = [rng.choice("bcdfghklmnprst") + rng.choice("aeiou") + rng.choice(["", " ", "n"]) for _ in range(40)]
    names = sorted(("".join(rng.choice(syllables) for _ in range(size // 3)) for _ in range(300)), key=len)
    names.insert(7, names[7])
    monkeypatch.setattr(dedupe, "resembles", lambda *a: compared.append(a) or resembles(*a))
    assert list(dedupe.near_in_blocks(names, names, True, 92.0)) == [(7, 8)] and len(compared) < 10


def test_merged_leads_are_read_once(spark):
    """F2 of round 4: names are normalised once, not for each time that keyed rows are read."""
    rows = [(1, "Korteks Sanayi", None, None), (2, "Corteks Sanayi", "", ""), (3, "Zeta Ltd", "Egypt", None), (4, "zeta", "egypt", ""), (5, "Zeta", None, "https://z.com")]
    own = spark.createDataFrame(rows, "_ord long, company string, country string, website string").withColumn("source_type", F.lit("gots"))
    merged, _ = dedupe.merge_leads(own.withColumn("websites", F.array(F.col("_ord").cast("string"))))
    assert sorted((r._ord, r.websites) for r in merged.collect()) == [(1, ["1", "2"]), (3, ["3", "4"]), (5, ["5"])]
    assert "regexp_replace" not in merged._jdf.queryExecution().optimizedPlan().toString()


def test_blocked_pairs_need_no_shuffle(spark):
    """each pair is made once, also one of both keys."""
    rows = [(1, "A", "w.de"), (2, "a ", "W.de"), (3, "B", "w.de"), (4, "", "w.de"), (5, None, "w.de"), (6, "b", None)]
    found = dedupe.blocked_pairs(spark.createDataFrame(rows, "_ord long, company string, website string"))
    assert sorted(map(tuple, found.collect())) == sorted([(a, b) for a in range(1, 6) for b in range(a + 1, 6)] + [(3, 6)])
    assert "Aggregate" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_pages_in_parts():
    """the rows of a few pages are held at once, not those of a whole batch."""
    import pandas as pd

    from siftlane.operators import page_trees

    frames = [pd.DataFrame({"id": range(n)}) for n in (150, 0, 3)]
    assert [len(x) for x in page_trees.parts(frames)] == [64, 64, 22, 3]


def test_texts_without_an_event_are_not_cut_into_parts():
    """the parts of a text are looked for only where an event's words stand; what a part ends with is what is looked for."""
    from siftlane.operators import extract

    for i, end in extract.MENTION_ENDS.items():
        assert extract.MENTION_PARTS[i].endswith(end)


def test_links_are_counted_without_pairs(spark, monkeypatch):
    """each lead's links are as many as ``linked`` has pairs of it, for fixed weights and for those with shares of values, and no pairs are made."""
    import random

    rng = random.Random(5)
    names = ["", "a", "ab", "abcd", "firm one", "firm onee", "firm tow", "firm two", "fim one", "other", "othre", "long company name 1", "ong company name 22"]
    rows = [(i, rng.choice(names), rng.choice(["Turkey", "Peru", ""]), rng.choice(["", "w.com", "v.com", "t.org"])) for i in range(160)]
    own = spark.createDataFrame(rows, "_ord long, company string, country string, website string")
    shares = spark.createDataFrame([("country", "turkey", 0.6), ("country", "peru", 0.01), ("website", "w.com", 0.5), ("website", "t.org", 0.02)], "kind string, value string, share double")
    rare = dedupe.Weights.of(dedupe.LINK_WEIGHTS, 0.01, shares=shares, by_chance={"country": 0.2, "website": 0.1})
    cases = [(None, 0.8), (None, 0.3), (rare, 0.8), (rare, 0.95)]
    wanted = []
    for weights, threshold in cases:
        pairs = [(x.a, x.b) for x in dedupe.linked(own, threshold, weights=weights).collect()]
        wanted.append({i: sum(i in p for p in pairs) for i in range(len(rows))})
    monkeypatch.setattr(dedupe, "dealt_pairs", None)
    for (weights, threshold), want in zip(cases, wanted):
        assert any(want.values()) and {x["_ord"]: x["links"] for x in dedupe.linked_leads(own, threshold, weights=weights).collect()} == want


def test_names_within_two_edits(spark):
    """names of a website meet by their parts; none within two edits is lost."""
    import random

    rng = random.Random(3)
    names = sorted({"".join(rng.choice("ab") for _ in range(rng.randrange(12))) for _ in range(150)})
    df = spark.createDataFrame([("w.de", n) for n in names] + [("v.de", "ab")], "website string, name string")
    pairs = df.alias("l").join(df.alias("r"), F.expr("l.website = r.website and l.name != r.name and levenshtein(l.name, r.name) <= 2")).select("l.website", "l.name", F.col("r.name").alias("other"))
    found = sorted(map(tuple, dedupe.close_names(df).collect()))
    assert found and found == sorted(map(tuple, pairs.collect()))


def test_stages_that_lists_share_run_once(spark):
    """what all lists begin with runs once, and each list keeps what it keeps by itself."""
    from siftlane.operators import scores
    from siftlane.plans.leads import leads
    from siftlane.plans.pipelines import Pipeline, variants

    def counted(df):
        calls.append(1)
        return df.where("_ord % 3 > 0")

    calls, own = [], leads(spark, "/root/testdata/sf0.001").drop("html")
    lists = {"a": (counted, scores.role), "b": (counted, scores.role, lambda d: d.where("role = 'UNKNOWN'")), "c": (counted,)}
    found = {name: df.count() for name, df in variants(own, lists)}
    assert len(calls) == 1 and found == {name: Pipeline(stages).run(own).count() for name, stages in lists.items()}


def test_cells_of_single_bits(spark):
    """Pipeline: with segments of one bit the embedding is the fingerprint itself, so its plan has no expression for each bit."""
    from siftlane.llm import simhash

    prints = [0, -1, 1, 1 << 62, -(1 << 63), 123456789]
    df = spark.createDataFrame([(x,) for x in prints], "f long").select("f", simhash.embedding(F.col("f"), 1).alias("e"))
    assert all(r.e == r.f for r in df.collect()) and "bit_count" not in df._jdf.queryExecution().optimizedPlan().toString()
