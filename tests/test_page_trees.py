"""Trees, selectors against their definition, site configurations, main texts and repeated structures."""

import random
import re

import pytest

from siftlane.functions import dom
from siftlane.operators import page_trees

SF = "/root/testdata/sf0.001"


def shape(tree, node=0):
    return (tree.tag[node], [shape(tree, c) for c in tree.children(node)])


@pytest.mark.parametrize(
    "html,want",
    [
        ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "ul(li,li(ul(li)),li)"),
        ("<p>a<p>b<div>c<p>d</div>e", "p,p,div(p)"),
        ("<table><tr><td>1<td>2<tr><th>3</table><i>x", "table(tr(td,td),tr(th)),i"),
        ("<div><b>a</div></b><br/>x</p>", "div(b),br"),
        ("<dl><dt>a<dd>b<dt>c</dl><select><option>1<option>2</select>", "dl(dt,dd,dt),select(option,option)"),
        ("<td><p>a</div>b</td>", "td(p)"),
        ("<script>var t='</p><div>';</script><!-- <i> --><b", "script"),
        ("", ""),
        (None, ""),
    ],
)
def test_trees(html, want):
    said = lambda s: s[0] + (f"({','.join(map(said, s[1]))})" if s[1] else "")
    assert ",".join(map(said, shape(dom.Tree(html))[1])) == want


def random_page(r, depth=0):
    out = ""
    for _ in range(r.randrange(1, 5) if depth < 5 else 0):
        tag = r.choice(["div", "span", "b", "section"])
        attrs = "".join(f' {a}="{v}"' for a, v in (("class", r.choice(["x", "y", "x y", "z"])), ("id", r.choice("pq")), ("href", r.choice(["/a", "/ab", "c"]))) if r.random() < 0.5)
        out += f"<{tag}{attrs}>{r.choice(['t', ''])}{random_page(r, depth + 1)}" + (f"</{tag}>" if r.random() < 0.95 else "")
    return out


def defined(tree, node, steps):
    """Whether a node fits all steps, from the last one upward, straight from their meaning."""
    how, tests = steps[-1]
    for t in tests:
        own = tree.attributes[node]
        ok = (
            t["tag"] in ("*", tree.tag[node]) if "tag" in t else own.get("id") == t["id"] if "id" in t else t["cls"] in own.get("class", "").split() if "cls" in t
            else [c for c in tree.children(tree.parent[node])][0 if t["pseudo"] == "first-child" else -1] == node if "pseudo" in t
            else t["attr"] in own and {None: True, "=": own[t["attr"]] == t.get("value"), "^=": own[t["attr"]].startswith(t.get("value", "")), "*=": t.get("value", "") in own[t["attr"]], "$=": own[t["attr"]].endswith(t.get("value", ""))}[t.get("op")]
        )
        if not ok:
            return False
    if len(steps) == 1:
        return True
    row = list(tree.children(tree.parent[node]))
    before = row[: row.index(node)]
    above, up = [], tree.parent[node]
    while up > 0:
        above.append(up)
        up = tree.parent[up]
    others = {" ": above, ">": above[:1], "+": before[-1:], "~": before}[how]
    return any(defined(tree, x, steps[:-1]) for x in others)


def test_selectors_against_their_definition():
    r = random.Random(6)
    simple = ["div", "*", ".x", ".x.y", "#p", "span.y", "[href]", "[href^='/a']", '[href$="b"]', "[href=c]", "b:first-child", ":last-child", "section#q.x"]
    for _ in range(60):
        tree = dom.Tree(random_page(r))
        for _ in range(20):
            parts = [r.choice(simple) for _ in range(r.randrange(1, 4))]
            selector = parts[0] + "".join(r.choice([" ", " > ", ">", " + ", " ~ "]) + p for p in parts[1:])
            both = f"{selector}, {r.choice(simple)}" if r.random() < 0.3 else selector
            steps = dom.parsed(both)
            assert dom.selected(tree, steps) == [n for n in range(1, len(tree)) if any(defined(tree, n, s) for s in steps)], both
    with pytest.raises(ValueError, match="no selector"):
        dom.parsed("div > !")


PAGES = {
    "cards": '<div class="card"><h3>Alfa <b>Textil</b></h3><a href="https://alfa.com">site</a> dyeing</div><div class="card"><h3>Beta</h3> trade</div><div class="card"></div>',
    "table": "<table><tr><th>Name<th>Land<tr><td>Gamma Mills<td>Peru weaving<tr><td>Delta<td>Egypt textile</table>",
    "nested": '<ul class=list><li class=item><h4>Outer Mill</h4>textile<ul><li class=item><h4>Inner Mill</h4> spinning</ul><li class=item><p>no heading Epsilon Works textile</ul>',
    "attributes": '<article data-name="Zeta SA" data-country="Brazil"><a href="/profile?id=1">more</a><a rel=site href="https://zeta.br">w</a></article>',
    "plain": "<div>Eta Finishing Ltd, finishing</div>",
}
SITES = {
    "cards": ({"selectors": {"item": ".card", "name": "h3", "website": "a"}}, [(0, "Alfa Textil", "https://alfa.com", {})]),
    "table": ({"selectors": {"item": "tr", "name": "td:first-child", "country": "td + td"}}, [(1, "Gamma Mills", "", {"country": "Peru weaving"}), (2, "Delta", "", {"country": "Egypt textile"})]),
    "nested": ({"selectors": {"item": "li.item", "name": "h4"}}, [(0, "Outer Mill", "", {}), (1, "Inner Mill", "", {}), (2, "Epsilon Works textile", "", {})]),
    "attributes": ({"selectors": {"item": "article", "name": "a", "website": "a[rel=site]", "country": "a@rel"}, "skip_industry_filter": True}, [(0, "more", "https://zeta.br", {"country": ""})]),
    "plain": ({}, [(0, "Eta Finishing Ltd", "", {})]),
}


@pytest.mark.parametrize("kind", sorted(PAGES))
def test_site_configurations(spark, kind):
    site, want = SITES[kind]
    rows = [(7, PAGES[kind], 0, "c"), (8, None, 0, "c"), (None, "", 1, "d")]
    got = page_trees.scraped(spark.createDataFrame(rows, "page_id long, html string, place int, company string"), site)
    assert [(r.place, r.company, r.website, r.fields) for r in got.orderBy("page_id", "place").collect()] == want


def test_navigation_in_plain_blocks_goes(spark):
    words = "The mill dyes and finishes cotton for many brands, and it has its own laboratory. "
    menu = "<div>" + "".join(f'<div><a href="/{i}">Menu entry {i}</a></div>' for i in range(12)) + "</div>"
    html = f"<html><head><title>t</title></head><body>{menu}<div><div><h1>About</h1><p>{words * 3}</p><p>{words} See <a href='/x'>the list</a>.</p>{menu}<script>x()</script></div></div><div>(c) 2024</div><footer>{words * 9}</footer></body></html>"
    got = page_trees.main_texts(spark.createDataFrame([(1, html), (2, None), (3, menu), (4, "just text")], "page_id long, html string"))
    found = {r.page_id: r.main_text for r in got.collect()}
    assert found[1] == " ".join(f"About {words * 3}{words} See the list .".split())
    assert found[2] == "" and found[4] == "just text"


def test_articles_of_all_pages_stay(spark):
    """Against plain code over every page: the text between article's tags is the main text, links of its navigation aren't in it."""
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "html")
    got = {r.page_id: r.main_text for r in page_trees.main_texts(pages).collect()}
    squeezed = lambda t: " ".join(t.split())
    checked = 0
    for r in pages.collect():
        article = re.search(r"(?s)<article>(.*?)</article>", r.html)
        if article:
            plain = squeezed(dom.Tree(article[1]).text(0))
            if len(plain) > 400:
                checked += 1
                assert got[r.page_id] == plain, r.page_id
    assert checked > 20


def groups(html):
    tree = dom.Tree(html)
    return [["+".join(tree.text(x) for x in unit) for unit in g] for g in dom.repeated_groups(tree)]


def test_repeated_structures():
    assert groups("<ul><li>1<li>2<ul><li>a<li>b<li>c</ul><li>3<li>4</ul>") == [["1", "2 a b c", "3", "4"], ["a", "b", "c"]]
    cards = "".join(f"<div class=c{i}><h3>Firm {i}</h3><p>{i}</p>{'<a href=x>w</a>' if i % 2 else ''}</div>" for i in range(4))
    assert [len(g) for g in groups(f"<div><div>head</div>{cards}</div>")] == [4]  # no common class, fields missing in some
    assert groups("<section><h3>A</h3><p>a</p><h3>B</h3><p>b</p><h3>C</h3><p>c</p><h3>D</h3></section>") == [["A+a", "B+b", "C+c"]]
    assert groups("<div><p>1</p><b>2</b></div>") == [] and groups("<p>" * 3000) != []
    assert groups("<div>" * 3000) == []


def test_records(spark):
    html = "<dl><dt>Alfa</dt><dd><a href='/a'>x</a></dd><dt>Beta</dt><dd><a href='/b'>y</a></dd><dt>Gamma</dt><dd><a href='/c'>z</a></dd></dl>"
    got = page_trees.repeated_records(spark.createDataFrame([(1, html), (2, None)], "page_id long, html string")).collect()
    assert [(r.group, r.place, r.n, r.path, r.name, r.href, r.text) for r in got] == [(0, i, 3, "dl>dt+dd", n, h, f"{n} {t}") for i, (n, h, t) in enumerate((("Alfa", "/a", "x"), ("Beta", "/b", "y"), ("Gamma", "/c", "z")))]
