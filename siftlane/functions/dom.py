"""A page as a tree of node arrays, selectors over it, its main text by density and its repeated structures by signatures.

Nodes are numbered in document order, so a subtree is a run of numbers. Tags that aren't closed end where their parent does or where HTML says
that a sibling begins; closing tags without an opening one are ignored; scripts and styles have no text.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np

#: Fixed values of HTML: elements without contents; what an opening tag closes, and the element that bounds the search for it.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES = {
    "li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)), "option": (("option",), ("select",)),
    "tr": (("tr", "td", "th"), ("table", "tbody", "thead", "tfoot")), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")), "tbody": (("tbody", "thead", "tr", "td", "th"), ("table",)), "tfoot": (("tbody", "thead", "tr", "td", "th"), ("table",)),
}
BLOCKS = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
UNSEEN = frozenset("script style template noscript head".split())
BOUNDS = frozenset("table td th body html button object".split())


class Tree(HTMLParser):
    """Arrays by node: tag, attributes, parent, end of the subtree, and the run of text pieces in it. Node 0 stands for the page."""

    def __init__(self, html: str | None):
        super().__init__(convert_charrefs=True)
        self.tag, self.attributes, self.parent, self.end, self.first_text, self.last_text = ["#page"], [{}], [-1], [0], [0], [0]
        self.texts: list[str] = []
        self.owner: list[int] = []
        self.open = [0]
        self.feed(html or "")
        self.close()
        self._close_to(0)
        self.end[0], self.last_text[0] = len(self.tag), len(self.texts)

    def _close_to(self, depth: int) -> None:
        """Only the first open elements stay open."""
        while len(self.open) > max(depth, 1):
            node = self.open.pop()
            self.end[node], self.last_text[node] = len(self.tag), len(self.texts)

    def _close_one_of(self, tags, bounds) -> None:
        for depth in range(len(self.open) - 1, 0, -1):
            tag = self.tag[self.open[depth]]
            if tag in tags:
                self._close_to(depth)
                if tags != ("p",):
                    continue
                return
            if tag in bounds:
                return

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCKS:
            self._close_one_of(("p",), BOUNDS)
        if tag in CLOSES:
            self._close_one_of(*CLOSES[tag])
        node = len(self.tag)
        own: dict[str, str] = {}
        for name, value in attrs:
            own.setdefault(name, value or "")
        self.tag.append(tag)
        self.attributes.append(own)
        self.parent.append(self.open[-1])
        for ends in (self.first_text, self.last_text):
            ends.append(len(self.texts))
        self.end.append(node + 1)
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        for depth in range(len(self.open) - 1, 0, -1):
            if self.tag[self.open[depth]] == tag:
                return self._close_to(depth)
            if tag not in BOUNDS and self.tag[self.open[depth]] in BOUNDS and tag not in ("tr", "tbody", "table"):
                return None
        return None

    def handle_data(self, data: str) -> None:
        if data.strip() and self.tag[self.open[-1]] not in UNSEEN:
            self.texts.append(data)
            self.owner.append(self.open[-1])

    def __len__(self) -> int:
        return len(self.tag)

    def text(self, node: int) -> str:
        """All text of a subtree, squeezed."""
        return " ".join(" ".join(self.texts[self.first_text[node] : self.last_text[node]]).split())

    def children(self, node: int) -> Iterator[int]:
        at = node + 1
        while at < self.end[node]:
            yield at
            at = self.end[at]

    def classes(self, node: int) -> list[str]:
        return self.attributes[node].get("class", "").split()


# --- selectors ------------------------------------------------------------------------------------------------------------------------------

SIMPLE = re.compile(r"""(?:(?P<tag>\*|[A-Za-z][\w-]*)|\#(?P<id>[\w-]+)|\.(?P<cls>[\w-]+)|\[\s*(?P<attr>[\w:-]+)\s*(?:(?P<op>[~^$*|]?=)\s*(?P<q>["']?)(?P<value>[^\]"']*)(?P=q)\s*)?\]|:(?P<pseudo>first-child|last-child))""", re.X)


def parsed(selector: str) -> list[list[tuple[str, list]]]:
    """The alternatives of a selector, each a list of (how it is joined to what stands before it, tests)."""
    out = []
    for part in re.split(r",(?![^\[]*\])", selector):
        steps: list[tuple[str, list]] = []
        how, at, part = " ", 0, part.strip()
        while at < len(part):
            gap = re.match(r"\s*([>+~]?)\s*", part[at:])
            if steps and gap[0]:
                how, at = gap[1] or " ", at + gap.end()
            found, tests = SIMPLE.match(part, at), []
            while found:
                tests.append({k: v for k, v in found.groupdict().items() if v is not None and k != "q"})
                at = found.end()
                found = SIMPLE.match(part, at)
            if not tests:
                raise ValueError(f"no selector: {selector!r} at {part[at:]!r}")
            steps.append((how, tests))
        out.append(steps)
    return out


def passes(tree: Tree, node: int, test: dict) -> bool:
    if "tag" in test:
        return test["tag"] == "*" or tree.tag[node] == test["tag"].lower()
    if "id" in test:
        return tree.attributes[node].get("id") == test["id"]
    if "cls" in test:
        return test["cls"] in tree.classes(node)
    if "pseudo" in test:
        up = tree.parent[node]
        return (node == up + 1) if test["pseudo"] == "first-child" else tree.end[node] == tree.end[up]
    own = tree.attributes[node].get(test["attr"].lower())
    if own is None or "op" not in test:
        return own is not None
    value = test["value"]
    how = {"=": own == value, "^=": bool(value) and own.startswith(value), "$=": bool(value) and own.endswith(value), "*=": bool(value) and value in own, "~=": value in own.split(), "|=": own == value or own.startswith(value + "-")}
    return how[test["op"]]


def selected(tree: Tree, steps: list[list[tuple[str, list]]]) -> list[int]:
    """Nodes that a selector finds, in document order. A step is a pass over all nodes."""
    found: set[int] = set()
    for alternative in steps:
        here: set[int] | None = None
        for how, tests in alternative:
            hits = [n for n in range(1, len(tree)) if all(passes(tree, n, t) for t in tests)]
            if here is not None:
                near = (lambda n, h=here: tree.parent[n] in h) if how == ">" else reached(tree, here, how).__contains__
                hits = [n for n in hits if near(n)]
            here = set(hits)
        found |= here or set()
    return sorted(found)


def reached(tree: Tree, here: set[int], how: str) -> set[int]:
    """Nodes below some nodes (a space), behind one in its row (~), or next to one (+)."""
    out: set[int] = set()
    last: dict[int, tuple[bool, bool]] = {}  # by parent: whether the sibling before, and any before, is one of them
    for n in range(1, len(tree)):
        up = tree.parent[n]
        next_to, behind = last.get(up, (False, False))
        if (up in here or up in out) if how == " " else next_to if how == "+" else behind:
            out.add(n)
        last[up] = n in here, behind or n in here
    return out


def within(tree: Tree, found: list[int], node: int) -> list[int]:
    """Those of found nodes that lie in a node's subtree, itself left out."""
    return found[bisect_right(found, node) : bisect_left(found, tree.end[node])]


def holds(found: list[int], node: int) -> bool:
    at = bisect_left(found, node)
    return at < len(found) and found[at] == node


# --- main text ------------------------------------------------------------------------------------------------------------------------------

#: Never part of the main text; elements that stand in running text, and those that hold parts of a page.
DROPPED = frozenset("nav footer header aside form button select".split()) | UNSEEN
INLINE = frozenset("a abbr b br cite code em font i img label small span strong sub sup u".split())
HOLDERS = frozenset("#page html body div section article main center table tbody tr td".split())
#: What an element costs, how much link text weighs against other text, and the share of a part's score that one inside it must have.
COST, LINKS, SHARE = 12, 3, 0.75


def main_text(tree: Tree) -> str:
    """The text of the densest part of a page. A part's score is its characters outside links, less link text and elements;
    parts inside it with links whose score is negative count nothing and go. From the page down, the part that has most of the score of what
    holds it is gone into; of equal ones the first. Dropped elements are no part of anything."""
    n = len(tree)
    score = np.zeros(n, np.int64)
    dropped, linked = np.zeros(n, bool), np.zeros(n, bool)
    for k in range(1, n):
        up = tree.parent[k]
        dropped[k] = dropped[up] or tree.tag[k] in DROPPED
        linked[k] = linked[up] or tree.tag[k] == "a"
    score[1:] -= COST
    for text, k in zip(tree.texts, tree.owner):
        size = len(" ".join(text.split()))
        score[k] += -LINKS * size if linked[k] else size
    kept, links = ~dropped, linked.copy()
    for k in range(n - 1, 0, -1):
        kept[k] &= score[k] >= 0 or tree.tag[k] in INLINE or not links[k]
        links[tree.parent[k]] |= links[k]
        if kept[k]:
            score[tree.parent[k]] += score[k]
    best = 0
    while True:
        inner = [c for c in tree.children(best) if kept[c] and tree.tag[c] in HOLDERS]
        most = max(inner, key=lambda c: score[c], default=0)
        if not most or score[most] < SHARE * score[best]:
            break
        best = most
    for k in range(best + 1, tree.end[best]):
        kept[k] &= kept[tree.parent[k]]
    return " ".join(" ".join(t for t, k in zip(tree.texts, tree.owner) if best <= k < tree.end[best] and kept[k]).split())


# --- repeated structures ----------------------------------------------------------------------------------------------------------------------

#: Members of a group at least, elements of a repeated unit at most, how alike the paths of two single members are at least, and tags in a path at most.
MEMBERS, PERIOD, ALIKE, DEPTH = 3, 3, 0.5, 5
#: Elements that are members of a list whatever is in them.
ENTRIES = frozenset(("li", "option"))


def path_sets(tree: Tree) -> list[frozenset[int]]:
    """Of each node the hashes of the tag paths of up to DEPTH tags that begin with it, made from the leaves up."""
    levels: list[list[set[int]]] = [[] for _ in range(len(tree))]
    out: list[frozenset[int]] = [frozenset()] * len(tree)
    for node in range(len(tree) - 1, -1, -1):
        tag = tree.tag[node]
        own = [{hash_of(tag, 0)}, *(set() for _ in range(DEPTH - 1))]
        for child in tree.children(node):
            for k, below in enumerate(levels[child][: DEPTH - 1]):
                own[k + 1] |= {hash_of(tag, p) for p in below}
        levels[node] = own
        out[node] = frozenset().union(*own)
    return out


def hash_of(tag: str, path: int) -> int:
    h = path ^ 0xCBF29CE484222325
    for b in tag.encode():
        h = (h ^ b) * 0x100000001B3 & 0xFFFFFFFFFFFFFFFF
    return h


def repeated_groups(tree: Tree, least: int = MEMBERS) -> list[list[tuple[int, ...]]]:
    """Groups of siblings that repeat a structure, each a list of units (runs of one to PERIOD siblings), in document order: maximal runs of like
    siblings first (the same tag, paths alike), then runs of units of several elements whose signatures repeat. A group that lies in a
    unit of another stays."""
    paths = path_sets(tree)
    alike = lambda a, b: tree.tag[a] == tree.tag[b] and (tree.tag[a] in ENTRIES or len(paths[a] & paths[b]) >= ALIKE * len(paths[a] | paths[b]))
    out = []
    for node in range(len(tree)):
        row = [c for c in tree.children(node) if tree.tag[c] not in UNSEEN and tree.tag[c] not in VOID]
        used = [False] * len(row)
        for period in range(1, PERIOD + 1):
            same = (lambda i: alike(row[i], row[i - 1])) if period == 1 else (lambda i, p=period: tree.tag[row[i]] == tree.tag[row[i - p]] and paths[row[i]] == paths[row[i - p]])
            start = 0
            while start < len(row):
                stop = start + period
                while stop < len(row) and not used[stop] and same(stop):
                    stop += 1
                units = (min(stop, len(row)) - start) // period
                if units >= least and not any(used[start : start + units * period]):
                    out.append([tuple(row[start + u * period : start + (u + 1) * period]) for u in range(units)])
                    for i in range(start, start + units * period):
                        used[i] = True
                    start += units * period
                else:
                    start += 1
    return sorted(out, key=lambda g: g[0])
