"""Gates, scores, extraction and merging on hand-made leads."""

import pytest
from pyspark.sql import functions as F

from siftlane.operators import dedupe, extract, gates, more_scores, scores
from siftlane.operators import tables as O
from siftlane.plans.pipelines import STAGES, Pipeline

LEAD = "_ord long, company string, country string, context string, source_type string, website string, score double, emails array<string>, phones array<string>"


def leads(spark, *rows):
    """Rows of (company, source_type, context, website)."""
    full = [(i, *(list(r) + [None] * 4)[:4]) for i, r in enumerate(rows)]
    return spark.createDataFrame([(i, c, "Turkey", x, s, w, 1.0, [], []) for i, c, s, x, w in full], LEAD)


def column(df, name):
    return [r[name] for r in df.orderBy("_ord").collect()]


def test_entity_gate(spark):
    own = leads(
        spark, ("Stenter Machine: Types,", "brave_search"), ("We are now fully supported in Turkey", "brave_search"), ("Monforts Technologist for Dyeing", "brave_search"), ("Brückner Stenter", "brave_search"), ("textile", "brave_search"),
        ("Dyeing and Finishing", "brave_search"), ("Korteks Mensucat A.Ş.", "oem_customer"), ("Aksa Akrilik Kimya A.Ş.", "gots", None, "aksa.com"), (None, "gots"), ("", None), ("ABC Spare Parts Ltd", "gots", None, "a.com"),
    )
    got = gates.entity_gate(own)
    assert column(got, "entity_grade") == ["REJECT"] * 6 + ["C", "A", "REJECT", "REJECT", "C"]
    kinds = [r.split(":")[0] if r else None for r in column(got, "gate_reason")]
    assert kinds[:6] == ["Title pattern", "Sentence fragment", "Person/role pattern", "Contains OEM manufacturer name", "Truncated name", "Generic phrase"]


def test_contract(spark):
    rows = [(0, "ABC Tekstil A.Ş.", "Turkey", "https://abc-tekstil.com"), (1, "Egyptian Fibers Company", "https://services.oeko-tex.com/profile/123", "info@efco.com"), (2, "View basket", "Brazil", None), (3, "Energy", "Egypt", None), (4, "fabric", "Egypt", None), (5, None, None, None)]
    own = spark.createDataFrame(rows, "_ord long, company string, country string, website string")
    assert column(gates.contract_errors(own), "errors") == [[], ["country_url", "website_email"], ["company_noise"], ["company_noise"], ["company_generic"], ["company_empty"]]
    rows = [(0, " ABC ", "BRASIL", "abc.com", None, [" a@b.co", "x", None]), (1, "Mill", "", "nodot", "s", []), (2, "Mill", None, "https://services.oeko-tex.com/p", None, None), (3, "Mill", "fas", "www.oeko-tex.com", "kept", [])]
    valid, invalid = gates.contract(spark.createDataFrame(rows, "_ord long, company string, country string, website string, source_url string, emails array<string>"))
    assert [tuple(r) for r in valid.orderBy("_ord").collect()] == [
        (0, "ABC", "Brazil", "https://abc.com", None, ["a@b.co"]), (1, "Mill", None, None, "s", []), (2, "Mill", None, None, "https://services.oeko-tex.com/p", None), (3, "Mill", "Morocco", None, "kept", []),
    ]
    assert invalid.count() == 0


def test_evidence_found_elsewhere(spark):
    rows = [(0, "Mill", "strong", True, "Reference"), (1, "Mill", "medium", True, "news"), (2, "Mill", "strong", False, "x"), (3, "Mill", None, None, None)]
    own = spark.createDataFrame(rows, "_ord long, company string, sce_confidence string, sce_has_evidence boolean, sce_evidence_type string").withColumn("context", F.lit(None).cast("string"))
    got = scores.evidence_layers(own.withColumn("sce_evidence_text", F.when(F.col("_ord") == 3, "with a Monforts Montex stenter"))).orderBy("_ord").collect()
    assert [r.e1 for r in got][:3] == [0.8, 0.0, 0.0] and got[3].e1 == 1.0 and [r.e2 for r in got][:3] == [0.0, 0.25, 0.0]
    assert got[0].e1_words == ["brave_evidence:Reference"] and got[1].e2_words == ["brave_evidence:news"] and got[0].sce_ready and not got[1].sce_ready
    assert [r.sce_confidence for r in got] == ["high", "low", "low", "high"]


def test_evidence_layers(spark):
    own = leads(
        spark, ("Döhler Textil", None, "textile manufacturing with Monforts Montex stenter finishing line"), ("Santana Textiles", None, "denim production with dyeing and finishing facilities"),
        ("ANJ Máquinas", None, "textile machinery dealer and equipment supplier"), ("Random Company", None, "general business services"), (None, None, None),
    )
    got = scores.evidence_layers(own)
    assert column(got, "e1")[0] == 1.0 and column(got, "e2")[:2] == [0.5, 0.5] and column(got, "sce_score")[1] == 0.3
    assert column(got, "sce_ready") == [True, False, False, False, False] and column(got, "sce_confidence") == ["high", "low", "low", "low", "low"]


def test_enrichment_need(spark):
    rows = [(0, "https://abit.org.br/company/santana", []), (1, "", []), (2, "https://www.vicunha.com.br", ["contato@vicunha.com.br"]), (3, "nodot", []), (4, "https://x.com.br", [])]
    own = spark.createDataFrame(rows, "_ord long, website string, emails array<string>")
    assert column(gates.enrichment_need(own), "enrichment_reason") == ["non_company_domain:abit.org.br", "no_website", None, "invalid_url", "no_email"]


def test_guessed_emails(spark):
    own = spark.createDataFrame([(0, "Brazil", "https://www.x.com.br/a"), (1, "Egypt", "y.com"), (2, "Egypt", None)], "_ord long, country string, website string")
    assert column(O.guessed_emails(own), "guesses") == [["vendas@x.com.br", "sales@x.com.br", "comercial@x.com.br"], ["sales@y.com", "export@y.com", "info@y.com"], []]


def test_merge(spark):
    rows = [(1, "Mega", "Turkey", "https://mega.com", "brave_search", ["a@x.y"], 2.0, ""), (2, "Mega Textil", "Turkey", "https://mega.com/x", "gots", ["b@x.y"], 1.0, None), (3, "Alone", None, None, "gots", [], None, "c"), (4, "Ürün Ltd.", "Egypt", None, "fair", [], 3.0, "d"), (5, "ürün ltd", "egypt ", "", "fair", ["z@x.y"], None, "e")]
    own = spark.createDataFrame(rows, "_ord long, company string, country string, website string, source_type string, emails array<string>, score double, context string")
    merged, audit = dedupe.merge_leads(own)
    assert {r._ord: (r.company, r.emails, r.score, r.context) for r in merged.collect()} == {2: ("Mega Textil", ["a@x.y", "b@x.y"], 2.0, None), 3: ("Alone", [], None, "c"), 4: ("Ürün Ltd.", ["z@x.y"], 3.0, "d")}
    assert sorted(map(tuple, audit.collect())) == [("Mega Textil", "Mega", "same_domain:mega.com"), ("Ürün Ltd.", "ürün ltd", "norm_country:ürün|egypt")]


def test_merge_by_name(spark):
    rows = [(1, "Korteks Mensucat Sanayi", None, None, "brave_search", 1.0, None), (2, "Corteks Mensucat Sanayi", "", "", "gots", 4.0, "b"), (3, "korteks mensucat sanayi", None, "", "gots", None, "c"), (4, "Zeta", None, None, "gots", 2.0, "d"), (5, "", None, None, "gots", 0.0, "e"), (6, None, None, None, "gots", 0.0, "f"), (7, "Zeta", "Egypt", None, "gots", 2.0, "g")]
    own = spark.createDataFrame(rows, "_ord long, company string, country string, website string, source_type string, score double, context string")
    merged, audit = dedupe.merge_leads(own)
    assert {r._ord: (r.company, r.score, r.context) for r in merged.collect()} == {1: ("Korteks Mensucat Sanayi", 4.0, "b"), 4: ("Zeta", 2.0, "d"), 5: ("", 0.0, "e"), 6: (None, 0.0, "f"), 7: ("Zeta", 2.0, "g")}
    assert sorted(map(tuple, audit.collect())) == [("Korteks Mensucat Sanayi", n, "name_similarity") for n in ("Corteks Mensucat Sanayi", "korteks mensucat sanayi")]


def test_similar_names(spark):
    names = ["Akdeniz Tekstil Sanayi", "Akdeniz Tekstil Sanayii", "Akdeniz Textil Sanayii", "Bursa Boya", "Bursa Boyaa", "Zeta", "akdeniz tekstil sanayi ltd", None, ""]
    own = spark.createDataFrame(list(enumerate(names)), "_ord long, company string")
    norm = [(n or "").lower().replace(" ltd", "") for n in names]
    want, seeds = {}, []
    for i, n in enumerate(norm):
        if n:
            want[i] = next((s for s in seeds if dedupe.indel_ratio(norm[s], n) >= 92), i)
            seeds += [i] if want[i] == i else []
    assert {r._ord: r.seed_ord for r in dedupe.similar_names(own).collect()} == want and want[1] == 0


def test_similar_names_that_differ_early(spark):
    import random

    rng = random.Random(7)
    names = ["korteks mensucat sanayi", "corteks mensucat sanayi"]
    for _ in range(25):
        base = "".join(rng.choice("abcde ") for _ in range(rng.randrange(4, 40))).strip() or "x"
        for _ in range(5):
            own = list(base)
            for _ in range(rng.randrange(4)):
                at = rng.randrange(len(own))
                own[at : at + 1] = rng.choice([[], [rng.choice("abcde")], [own[at], rng.choice("abcde")]]) or own[at : at + 1][:0]
                own = own or ["x"]
            names.append("".join(own))
    own = spark.createDataFrame(list(enumerate(names)), "_ord long, company string")
    norm = dict(own.select("_ord", dedupe.normalize_company("company")).collect())
    for threshold in (92.0, 75.0):
        want, seeds = {}, []
        for i in sorted(norm):
            if norm[i]:
                want[i] = next((s for s in seeds if dedupe.indel_ratio(norm[s], norm[i]) >= threshold), i)
                seeds += [i] if want[i] == i else []
        assert {r._ord: r.seed_ord for r in dedupe.similar_names(own, threshold).collect()} == want and want[1] == 0


def test_indel_ratio_is_lcs():
    def lcs(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            last = 0
            for j, y in enumerate(b):
                row[j + 1], last = max(row[j + 1], row[j], last + (x == y)), row[j + 1]
        return row[-1]

    import random

    rng = random.Random(1)
    for _ in range(300):
        a, b = ("".join(rng.choice("abcd") for _ in range(rng.randrange(12))) for _ in "ab")
        want = 200.0 * lcs(a, b) / (len(a) + len(b)) if a or b else 100.0
        assert abs(dedupe.indel_ratio(a, b) - want) < 1e-9


def test_resolution(spark):
    rows = [(1, "Mega", "Turkey", "mega.com", 1.0), (2, "Megaa", "Turkey", "mega.com", 5.0), (3, "Other", "Egypt", "o.com", 2.0), (4, "Mega", "Turkey", None, 0.0)]
    own = spark.createDataFrame(rows, "_ord long, company string, country string, website string, score double")
    got = {r._ord: r.entity_id for r in dedupe.resolved(own).collect()}
    assert set(got) == {2, 3} and got[2] == 1 and got[3] == 3


def test_large_groups_are_linked_exactly(spark):
    """One name of 1401 leads: the first alone in its country, the others of one country and without websites."""
    own = spark.range(1401).select(F.col("id").alias("_ord"), F.lit("Mega").alias("company"), F.when(F.col("id") == 0, "Egypt").otherwise("Turkey").alias("country"), F.lit(None).cast("string").alias("website"), F.lit(1.0).alias("score"))
    assert dedupe.linked(own).count() == 1400 * 1399 // 2
    assert sorted((r._ord, r.entity_id) for r in dedupe.resolved(own).collect()) == [(0, 0), (1, 1)]


def test_resolution_is_components_of_links(spark):
    import random

    rng = random.Random(4)
    rows = [(i, rng.choice(["Mega", "Megaa", "Alfa", "", None]), rng.choice(["Turkey", "Egypt", "", None]), rng.choice(["m.com", "M.com", "a.com", "", None]), 1.0) for i in range(60)]
    own = spark.createDataFrame(rows, "_ord long, company string, country string, website string, score double")
    for threshold in (0.2, 0.8, 0.95, 0.999):
        root = list(range(60))
        for a, b in sorted((r.a, r.b) for r in dedupe.linked(own, threshold).collect()):
            x, y = sorted((root[a], root[b]))
            root = [x if r == y else r for r in root]
        assert {r.entity_id for r in dedupe.resolved(own, threshold=threshold).collect()} == set(root)


def test_extraction(spark):
    text = "Visit us\nAksa Akrilik GmbH opened a mill\nService for Denim Works in Cairo\nJohn Smith, Manager of textile sales\nThe Green River Fabrics mill\n" + "x" * 300
    own = spark.createDataFrame([(1, text), (2, None), (3, "")], "_ord long, context string")
    got = {(r._ord, r.company) for r in extract.companies(own, "_ord").collect()}
    assert {(1, "Aksa Akrilik GmbH"), (1, "Denim Works")} <= got and all(k == 1 for k, _ in got) and not any("Smith" in c for _, c in got)
    body = "News. Textil Alfa of Brazil has installed a new Monforts stenter for finishing. Gamma Mills in Egypt has commissioned two lines. Delta has ordered more. Nobody has seen it."
    found = {r.company: (r.country, r.event, r.oem_brand, r.confidence) for r in extract.purchases(spark.createDataFrame([(1, body)], "k long, t string"), "k", "t").collect()}
    assert found == {"Textil Alfa": ("Brazil", "installed", "monforts", 1.0), "Gamma Mills": ("Egypt", "commissioned", None, 0.6), "Delta": (None, "ordered", None, 0.4)}
    page = spark.createDataFrame([(1, "Profile\nAlfa Textil\nStreet 1\nTown\nEmail: a@alfa.com\nrest")], "k long, t string")
    assert tuple(extract.profiles(page, "k", "t").first()) == (1, "Alfa Textil", "a@alfa.com", "Street 1, Town")


def test_all_mentions_of_a_sentence(spark):
    body = "Alpha Mills has installed a line and Beta Tekstil of Turkey has ordered two stenters and Alpha Mills has ordered more"
    found = {(r.company, r.country, r.event) for r in extract.purchases(spark.createDataFrame([(1, body)], "k long, t string"), "k", "t").collect()}
    assert found == {("Alpha Mills", None, "installed"), ("Beta Tekstil", "Turkey", "ordered")}


def test_best_website(spark):
    own = spark.createDataFrame([(1, "Alfa Textil", "Brazil"), (2, "Beta", "Egypt")], "_ord long, company string, country string")
    results = spark.createDataFrame([(1, 1, "https://facebook.com/alfa", "Alfa", ""), (1, 2, "https://www.alfa.com.br/x", "Alfa", "textil"), (1, 3, "https://alfa.com", "", ""), (2, 1, "https://kompass.com/b", "Beta", "")], "_ord long, rank int, url string, title string, description string")
    assert [tuple(r) for r in extract.best_website(own, results).collect()] == [(1, "https://www.alfa.com.br", 8)]


def test_quota_is_exact(spark):
    own = spark.range(5000).select(F.col("id").alias("_ord"), F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 3 == 1, "b").otherwise("c").alias("k"), (F.col("id") % 97).alias("s"))
    got = O.top_of_each(own, "k", [F.desc("s"), F.asc("_ord")], {"a": 10, "b": 0}).groupBy("k").agg(F.count("*").alias("n"), F.sum("_ord").alias("t"))
    rows = sorted([(i % 97, -i) for i in range(0, 5000, 3)], reverse=True)[:10]
    found = {r.k: (r.n, r.t) for r in got.collect()}
    assert found["a"] == (10, sum(-i for _, i in rows)) and "b" not in found and found["c"][0] == 1666


def test_scores_bear_nulls(spark):
    own = leads(spark, (None, None, None, None), ("", "", "", ""))
    for f in (scores.heuristic, scores.hundred_points, scores.role, scores.qualification, scores.signals, scores.triggers, scores.hs_codes, scores.contactability, more_scores.gate_v1, more_scores.role_by_majority, more_scores.potential, more_scores.weighted_detector, gates.entity_type, gates.fast_filter, gates.clean_dataset):
        assert f(own).count() == 2 and f(own.where("false")).count() == 0


@pytest.mark.parametrize("name", sorted(STAGES))
def test_stage_lists(spark, name):
    own = leads(spark, ("Alfa Tekstil A.Ş.", "gots", "boyahane ve terbiye, Monforts stenter, info@alfa.com.tr", "https://alfa.com.tr"), ("x", "brave_search", "", None))
    got = Pipeline.named(name).run(own)
    assert [r.company for r in got.collect()] == ["Alfa Tekstil A.Ş."]


def test_contacts_and_snippets(spark):
    own = spark.createDataFrame([(1, "Turkey", "https://www.alfa.com.tr", ["a@alfa.com.tr"], ["+90 212 555 44 33"]), (2, "Egypt", None, ["b@gmail.com"], [])], "_ord long, country string, website string, emails array<string>, phones array<string>")
    got = more_scores.contact_confidence(own, {"turkey": "90", "egypt": "20"})
    assert column(got, "contact_confidence") == ["high", "low"] and column(got, "contact_notes") == [["email_on_site", "phone_in_country"], ["free_provider"]]
    both = more_scores.consolidated(own.withColumn("more", F.lit("c@x.org; bad")), ["emails", "more"], ["phones"])
    assert column(both, "all_emails") == ["a@alfa.com.tr; c@x.org", "b@gmail.com; c@x.org"] and column(both, "phone") == ["+902125554433", None]


def plain_mentions(text):
    """The six patterns of customer mentions by plain code."""
    import re

    out = {}
    for p in extract.MENTION_EVENTS:
        for m in re.finditer(p, text, re.IGNORECASE):
            around = text[max(0, m.start() - 150) : m.end() + 150]
            name = re.sub(r"^(the|a|an)\s+", "", re.sub(r"\s+", " ", m.group(1)).strip(), flags=re.IGNORECASE)
            words, low = name.split(), name.lower()
            if not 3 <= len(name) <= 80 or len(words) > 8 or (len(words) == 1 and low in extract.MENTION_GENERIC) or low.startswith(extract.MENTION_MAKERS):
                continue
            if len(words) > 3 and any(w in low for w in ("has", "have", "will", "are", "is", "the")):
                continue
            said = [x.group(1) for x in (re.search(q, around) for q in extract.MENTION_PLACES) if x]
            known = [x for x in said if x.lower() in extract.MENTION_COUNTRIES] + [c for c in extract.MENTION_COUNTRIES if c in around.lower()]
            equipment = next((k for k, w in extract.MENTION_EQUIPMENT.items() if any(x in around.lower() for x in w)), "unknown")
            points = 2 * bool(re.search(r"\b(Ltd|GmbH|SA|Inc|Group|SpA|Ltda|SRL|AS|KG)\b", name, re.I)) + 2 * bool(known) + (equipment != "unknown")
            points += any(w in around.lower() for w in ("installed", "commissioned", "delivered", "ordered", "invested")) + (len(words) >= 2)
            out.setdefault(low, (name, known[0].title() if known else "Unknown", equipment, around[:300], "high" if points >= 5 else "medium" if points >= 3 else "low"))
    return sorted(out.values())


def test_mentions_against_plain_code(spark):
    from siftlane.plans import registry, whole

    sf = "/root/testdata/sf0.001"
    got = {}
    for r in registry.QUERIES["s23_mentions"](spark, sf).collect():
        got.setdefault(r._ord, []).append((r.company, r.country, r.equipment_type, r.evidence_snippet, r.confidence))
    want = {r._ord: plain_mentions(r.context) for r in whole.mentioning(spark, sf).collect()}
    assert {k: sorted(v) for k, v in got.items()} == {k: v for k, v in want.items() if v} and len(got) > 100


def plain_gate(company, source, website, context):
    """The entity gate by plain code: (grade, score, reason)."""
    import re

    D, G = gates.D, gates
    search = lambda p, x=company: re.search(re.sub(r"^\(\?iuU\)", "", p), x, re.I)
    low = company.strip(" ").lower()
    words = [w for w in re.split(r"[ \t\n\r\f\v]+", low) if w]
    own = [w for w in words if w not in ("of", "the", "and", "for", "in", "on", "to")]
    first = lambda t, table: next((w for w in table if w in t), None)
    part, legal = company[:50], search(G.LEGAL)
    countries = "|".join(D.GATE_COUNTRIES)
    oem, media, domain = first(low, [x for x in D.GATE_OEM if len(x) > 4]), first(low, D.GATE_MEDIA), None
    rules = [
        (len(company.strip(" ")) < 3, "Name too short", company), (low in D.GATE_MENU, "Website menu item", company), (search(G.HEADLINE) and not legal, "Headline", part),
        (re.search(rf"^({countries})\s*(s\.?a\.?|ltd\.?|inc\.?|corp\.?|llc|gmbh|limited)?$", low), "Country name as company", company), (search(G.ARTICLE), "Article fragment", company), (search(G.TITLE), "Title pattern", part),
        (search(G.SENTENCE), "Sentence fragment", part), (search(G.PERSON), "Person/role pattern", part), (low in D.GATE_GARBAGE, "Garbage word", company), (company[:1] == company[:1].lower() and len(company) > 2, "Truncated name", company[:30]),
        (search(G.ADJECTIVE_NOUN), "Adjective + generic noun", company), (low in D.GATE_OEM, "OEM manufacturer", company), (oem, "Contains OEM manufacturer name", oem), (low in D.GATE_MEDIA, "News/media site", company), (media, "Contains news site name", media),
        (search(G.MACHINE), "Machine/product name", part), (search(G.GENERIC_PHRASE) and not legal and len(words) <= 4, "Generic phrase", company), (len(words) == 1 and low in D.GATE_GENERIC, "Single generic term", company),
        (1 <= len(words) <= 3 and all(w in D.GATE_GENERIC for w in own), "All generic terms", company), (domain, "Rejected domain", domain), (len(company) > 80, None, "Name too long"), (company.count(":") > 1 or "|" in company, "Multiple colons/pipes", part),
        (re.search(r"^\d+\s+", company) and "no." not in low, "Starts with number", part),
    ]
    reason = next((f"{k}: {x}" if k else x for c, k, x in rules if c), None)
    count = len([w for w in re.split(r"[ \t\n\r\f\v]+", company) if w])
    site = bool((website or "").strip(" "))
    score = 2 * bool(legal) + (1 if count >= 2 else -1 if count == 1 and len(company) < 4 else 0) + (2 if source in D.GATE_HIGH_SOURCES else 1 if source in D.GATE_MEDIUM_SOURCES and site else 0) + site
    parts = bool(search(G.PARTS_SUPPLIER, company.lower()) or any(w in (context or "").lower() for w in D.GATE_PARTS_SIGNALS))
    return "REJECT" if reason else "C" if parts else "A" if score >= 4 else "B" if score >= 2 else "C", score, reason, parts


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_entity_gate_against_plain_code(spark, sf):
    """Every row of the gate's query, and the counts of its reasons."""
    from collections import Counter

    from siftlane.plans import registry
    from siftlane.plans.leads import leads as made

    rows = made(spark, f"/root/testdata/{sf}").withColumn("title", F.initcap("company")).select("_ord", "company", "title", "source_type", "website", "context").collect()
    got = {r._ord: tuple(r)[1:] for r in registry.QUERIES["f11_entity_gate"](spark, f"/root/testdata/{sf}").collect()}
    want = {r._ord: plain_gate(r.title or "", (r.source_type or "").lower(), r.website, r.context) for r in rows}
    assert got == want and len({w[2].split(":")[0] for w in want.values() if w[2]}) >= 3
    counts = Counter(x.split(":")[0] for x in (plain_gate(r.company or "", (r.source_type or "").lower(), r.website, r.context)[2] for r in rows) if x)
    assert {r.category: r.n for r in registry.QUERIES["f11_gate_reasons"](spark, f"/root/testdata/{sf}").collect()} == counts


def test_estimated_weights(spark):
    """Matches agree in name and mostly in country; chance agreement follows from the shares, and rare values weigh more."""
    import random

    rng, rows = random.Random(5), []
    for e in range(400):
        country = "Turkey" if rng.random() < 0.6 else f"C{rng.randrange(30)}"
        for _ in range(rng.choice((1, 2, 3))):
            rows.append((len(rows), f"Firm {e}", country if rng.random() < 0.9 else "Egypt", f"f{e}.com" if rng.random() < 0.5 else "", 1.0))
    for i in range(200):
        rows.append((len(rows), f"Common {i % 3}", f"C{rng.randrange(30)}", f"x{i}.com", 1.0))
    own = spark.createDataFrame(rows, "_ord long, company string, country string, website string, score double")
    w = dedupe.estimated_weights(own)
    n = len(rows)
    shares = {}
    for r in rows:
        shares[r[2].lower()] = shares.get(r[2].lower(), 0) + 1 / n
    assert abs(w.by_chance["country"] - sum(s * s for s in shares.values())) < 1e-9
    assert w.levels["name_equal"] > 3 and w.levels["country_equal"] > 0 > w.levels["country_other"] and w.levels["site_equal"] > 3
    _, links = dedupe.profile_links(own, 0.0, w)
    top = dedupe.linked(own.limit(0), weights=w)
    assert top.count() == 0 and links.count() > 0
    pair = spark.createDataFrame([(0, "Firm", "Turkey", "", 1.0), (1, "Firm", "Turkey", "", 1.0), (2, "Else", "C7", "", 1.0), (3, "Else", "C7", "", 1.0)], own.schema)
    found = {(r.a, r.b): r.match_weight for r in dedupe.linked(pair, threshold=0.0, weights=w).collect()}
    import math

    assert abs((found[2, 3] - found[0, 1]) - math.log2(shares["turkey"] / shares["c7"])) < 1e-4
