"""Blocks of common keys, classes in place of pairs, and the order that estimated weights keep."""

import random
from itertools import combinations

from siftlane.operators import dedupe
from siftlane.plans import registry
from siftlane.plans.leads import leads

SF = "/root/testdata/sf0.001"
SCHEMA = "_ord long, company string, country string, website string, score double"


def test_pairs_of_a_common_key_are_dealt_out(spark):
    r = random.Random(1)
    rows = [("hot", i) for i in range(90)] + [(f"k{r.randrange(40)}", 100 + i) for i in range(120)] + [(None, 500), (None, 501), ("alone", 502)]
    got = dedupe.dealt_pairs(spark.createDataFrame([(k, p, "x") for k, p in rows], "key string, p long, x string"), block_rows=8)
    found = [(x.key, x.p, x.q) for x in got.collect()]
    want = {(k, min(p, q), max(p, q)) for (k, p), (m, q) in combinations(rows, 2) if k == m and k is not None}
    assert len(found) == len(set(found)) and set(found) == want


def test_classes_tell_what_pairs_tell(spark):
    r = random.Random(2)
    rows = [(i, f"Firm {r.randrange(25)}", r.choice(["Turkey", "Peru", ""]), r.choice(["", "", f"f{r.randrange(30)}.com"]), 1.0) for i in range(300)]
    own = spark.createDataFrame(rows, SCHEMA)
    pairs = {(x.a, x.b) for x in dedupe.linked(own).collect()}
    classes, members = dedupe.linked_classes(own)
    of = {x["_ord"]: x["class"] for x in members.collect()}
    assert sorted(of) == [x[0] for x in rows]
    for x in classes.collect():
        inside = [i for i, c in of.items() if c == x["class"]]
        assert len(inside) == x.members and min(inside) == x["class"]
        others = {of[b if a == x["class"] else a] for a, b in pairs if x["class"] in (a, b)} - {x["class"]}
        assert x.links == len(others) and x.linked_leads == sum(c in others for c in of.values())
        if len(inside) > 1:
            assert x.alike == ((min(inside), sorted(inside)[1]) in pairs)


def test_estimate_never_turns_agreement_round(spark):
    """The driver's leads: copies of a firm lie on different pages, so websites tell nothing of a match, and links are still found."""
    own = leads(spark, SF)
    w = dedupe.estimated_weights(own)
    for kind in ("name", "country", "site"):
        assert w.levels[f"{kind}_equal"] >= 0 >= w.levels[f"{kind}_other"], kind
    assert w.levels["site_equal"] == 0 or "site" not in w.notes
    links = {(x.a, x.b) for x in dedupe.linked(own, weights=w).collect()}
    names = {x["_ord"]: x.company.strip().lower() for x in own.select("_ord", "company").collect()}
    assert links and all(names[a] == names[b] for a, b in links)
    copies = {(a, b) for a, b in combinations(sorted(names), 2) if names[a] == names[b] and names[a]}
    assert len(links) >= 0.9 * len(copies)
    counted = {x["_ord"]: x["links"] for x in registry.QUERIES["d10_estimated"](spark, SF).collect()}
    assert counted == {i: sum(i in pair for pair in links) for i in names}


def test_columns_that_nothing_tells_of_keep_fixed_values(spark):
    own = spark.createDataFrame([(0, "A", "X", "", 1.0), (1, "B", "Y", "", 1.0)], SCHEMA)
    notes = dedupe.estimated_weights(own).notes
    assert all("fixed values" in notes[k] or "no weight" in notes[k] for k in ("name", "country", "site"))
