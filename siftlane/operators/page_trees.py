"""Leads, main texts and repeated records of whole pages, by their trees (``functions.dom``). A page is a row's work; pages are dealt by Spark."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftlane.functions import dom

#: The default of a directory's keywords, the characters of a lead's context, a name that no selector finds.
INDUSTRY = ("textile", "machinery", "dyeing", "finishing", "spinning", "weaving")
CONTEXT = 240
NAME = re.compile(r"\b[A-Z][A-Za-z0-9&\-\.\s]{2,}\b")


#: Pages whose rows a task holds at once.
PAGES = 64


def parts(frames: Iterable[pd.DataFrame], rows: int = PAGES) -> Iterator[pd.DataFrame]:
    """The frames in pieces of so many rows."""
    for frame in frames:
        for at in range(0, len(frame), rows):
            yield frame.iloc[at : at + rows]


def of_trees(pages: DataFrame, key: str, html: str, each: Callable[[dom.Tree], Iterable[tuple]], schema: str) -> DataFrame:
    """(key, columns of schema): the rows that ``each`` makes of a page's tree. A null page is empty."""
    out = T.StructType([pages.schema[key], *T._parse_datatype_string(schema).fields])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in parts(frames):
            rows = [(k, *row) for k, h in zip(frame[key], frame[html]) for row in each(dom.Tree(h))]
            yield pd.DataFrame(rows, columns=out.fieldNames())

    return pages.select(key, html).mapInPandas(run, out)


def field_of(tree: dom.Tree, item: int, found: list[int], attribute: str) -> str | None:
    """The text, or the attribute, of the first found node in an item; nothing where there is none."""
    own = dom.within(tree, found, item)
    if not own:
        return None
    return tree.attributes[own[0]].get(attribute, "").strip() if attribute else tree.text(own[0])


def rules_of(fields: dict[str, str]) -> dict[str, tuple[list, str]]:
    """Selectors by field, parsed; behind an @ stands the attribute that is wanted in place of the text."""
    out = {}
    for name, rule in fields.items():
        selector, _, attribute = rule.partition("@")
        out[name] = dom.parsed(selector), attribute.strip()
    return out


def scraped(pages: DataFrame, site: dict, *, key: str = "page_id", html: str = "html", keywords: Iterable[str] = INDUSTRY) -> DataFrame:
    """Leads (key, place, company, website, context, fields) of pages by a site's configuration: ``selectors`` with item, name,
    website and any further fields (a selector, and behind an @ an attribute).

    Without an item selector every div, tr and li is an item. Without a name, or where its selector finds nothing, the first words that
    begin in capitals are it; without a website the first link is. Items without one of the keywords are left out, unless the
    site says skip_industry_filter; so are names of three characters or fewer. Items may lie in one another: each is one."""
    selectors = dict(site.get("selectors") or {})
    items = dom.parsed(selectors.pop("item", "") or "div, tr, li")
    website = selectors.get("website", "")
    rules = rules_of(selectors | ({"website": f"{website}@href"} if website and "@" not in website else {}))
    link, words = dom.parsed("a[href]"), () if site.get("skip_industry_filter") else tuple(w.lower() for w in keywords)
    others = [n for n in rules if n not in ("name", "website")]

    def each(tree: dom.Tree) -> Iterator[tuple]:
        at = {n: (dom.selected(tree, steps), attribute) for n, (steps, attribute) in rules.items()}
        links = dom.selected(tree, link)
        of = lambda item, n: field_of(tree, item, *at[n]) if n in at else None
        for place, item in enumerate(dom.selected(tree, items)):
            text = tree.text(item)
            if words and not any(w in text.lower() for w in words):
                continue
            name = of(item, "name")
            if name is None:
                found = NAME.search(text)
                name = found[0].strip() if found else ""
            if len(name) > 3:
                site_of = of(item, "website") or field_of(tree, item, links, "href") or ""
                yield place, name, site_of, text[:CONTEXT], {n: of(item, n) or "" for n in others}

    return of_trees(pages, key, html, each, "place long, company string, website string, context string, fields map<string,string>")


def main_texts(pages: DataFrame, *, key: str = "page_id", html: str = "html") -> DataFrame:
    """(key, main_text, n_words) of pages by text and link density."""
    found = of_trees(pages, key, html, lambda tree: [(dom.main_text(tree),)], "main_text string")
    return found.withColumn("n_words", F.size(F.filter(F.split("main_text", " "), lambda w: w != "")).cast("long"))


LINK = dom.parsed("a[href]")
HEADS = dom.parsed("h1, h2, h3, h4, h5, h6, strong, b, a, dt, th, td")


def repeated_records(pages: DataFrame, *, key: str = "page_id", html: str = "html", least: int = dom.MEMBERS) -> DataFrame:
    """(key, group, place, n, path, name, href, text): the records of each page's repeated structures; n is how many the group has, path the tags from the
    page down to its parent and those of a unit. The name is the first heading, link or cell, else the text."""

    def each(tree: dom.Tree) -> Iterator[tuple]:
        all_heads, all_links = dom.selected(tree, HEADS), dom.selected(tree, LINK)
        own_and = lambda x, found: ([x] if dom.holds(found, x) else []) + dom.within(tree, found, x)
        for g, units in enumerate(dom.repeated_groups(tree, least)):
            up, path = tree.parent[units[0][0]], []
            while up > 0:
                path.append(tree.tag[up])
                up = tree.parent[up]
            name_of = ">".join([*reversed(path), "+".join(tree.tag[x] for x in units[0])])
            for place, unit in enumerate(units):
                text = " ".join(filter(None, map(tree.text, unit)))
                heads = [h for x in unit for h in own_and(x, all_heads)]
                links = [h for x in unit for h in own_and(x, all_links)]
                name = next((t for t in map(tree.text, heads) if t), text)
                yield g, place, len(units), name_of, name, tree.attributes[links[0]]["href"] if links else "", text

    return of_trees(pages, key, html, each, "group long, place long, n long, path string, name string, href string, text string")
