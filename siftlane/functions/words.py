"""Words of dictionaries found in a text by one pass, whatever the number of words.

The words make one pattern, a tree of their letters whose branches are chosen by halves, looked for at each place of the
text; the longest word at a place is found there, and words that begin it are added from a table. What a dictionary has in
the text then follows from the array of found words. Whole columns of long texts (``scanned``) are passed over in Arrow batches instead: places
where the first three bytes of a word may stand are looked up in a table, and only these are compared letter by letter.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftlane.functions.text import let, listed, text_of

NONE = "array<string>"


def _escaped(c: str) -> str:
    return c if c.isalnum() or c == " " or ord(c) > 127 else "\\" + c


def word_pattern(words: Iterable[str]) -> str:
    """A pattern of all words, the longest first where several fit."""
    tree: dict = {}
    for w in words:
        at = tree
        for c in w:
            at = at.setdefault(c, {})
        at[""] = {}

    def choice(items: list) -> str:
        if len(items) <= 3:
            return "|".join(_escaped(c) + rest(x) for c, x in items)
        halves = items[: len(items) // 2], items[len(items) // 2 :]
        return "|".join(f"(?=[{''.join(_escaped(c) for c, _ in half)}])(?:{choice(half)})" for half in halves)

    def rest(node: dict) -> str:
        items = sorted((c, x) for c, x in node.items() if c)
        if not items:
            return ""
        if len(items) == 1 and "" not in node:
            return _escaped(items[0][0]) + rest(items[0][1])
        return f"(?:{choice(items)})" + ("?" if "" in node else "")

    return rest(tree)


def words_in(text: Column, words: Iterable[str]) -> Column:
    """The words that are substrings of the text: a distinct array in no certain order."""
    words = sorted({w for w in words if w})
    if not words:
        return F.array().cast(NONE)
    found = F.regexp_extract_all(text, F.lit(f"(?=({word_pattern(words)}))"), F.lit(1))
    begun = {w: [v for v in words if v != w and w.startswith(v)] for w in words}
    begun = {w: v for w, v in begun.items() if v}
    if not begun:
        return F.array_distinct(found)
    # one literal for the table: words behind each word that they begin; the found words are computed once
    table = F.str_to_map(F.lit("\x1e".join(f"{w}\x1d" + "\x1f".join(v) for w, v in begun.items())), F.lit("\x1e"), F.lit("\x1d"))
    more = lambda own: F.flatten(F.transform(F.filter(own, lambda w: F.array_contains(listed(begun), w)), lambda w: F.split(F.try_element_at(table, w), "\x1f")))
    return let(F.array_distinct(found), lambda own: F.array_union(own, more(own)))


#: Bytes of text that are looked through together.
SLICE_BYTES = 4 << 20


def triple(b: np.ndarray) -> np.ndarray:
    """A number of 16 bits for each three bytes of b."""
    b = b.astype(np.uint16)
    return b[:-2] * np.uint16(961) + b[1:-1] * np.uint16(31) + b[2:] * np.uint16(12345)


def finder(words: list[str]) -> Callable[[pa.Array], pa.Array]:
    """A function from texts to the distinct words that are substrings of each; null texts have none."""
    coded = [w.encode() for w in words]
    sizes = np.array([len(w) for w in coded])
    table = np.zeros((len(words), int(sizes.max())), np.uint8)
    for i, w in enumerate(coded):
        table[i, : len(w)] = np.frombuffer(w, np.uint8)
    # what may stand behind words of one or two bytes is all counted
    starts: dict[int, list[int]] = {}
    for i, w in enumerate(coded):
        free = 3 - min(3, len(w))
        rest = np.indices((256,) * free).reshape(free, -1).T.astype(np.uint8) if free else np.zeros((1, 0), np.uint8)
        for h in {int(triple(np.r_[np.frombuffer(w[:3], np.uint8), r])[0]) for r in rest}:
            starts.setdefault(h, []).append(i)
    many = np.zeros(1 << 16, np.int64)
    for h, own in starts.items():
        many[h] = len(own)
    first, here = np.cumsum(many) - many, many > 0
    every = np.array([i for h in sorted(starts) for i in starts[h]], np.int64)
    names = pa.array(words, pa.string())

    def of(text: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each row's found words, as sorted pairs."""
        padded = np.r_[text, np.zeros(2, np.uint8)]
        codes = triple(padded)
        at = np.flatnonzero(here[codes])
        codes = codes[at]
        n = many[codes]
        nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        word, at = every[np.repeat(first[codes], n) + nth], np.repeat(at, n)
        row = np.searchsorted(bounds, at, "right") - 1
        fits = at + sizes[word] <= bounds[row + 1]
        word, at, row = word[fits], at[fits], row[fits]
        done = []
        for j in range(table.shape[1]):
            ends = sizes[word] == j
            done.append(row[ends] * len(words) + word[ends])
            go = np.flatnonzero(~ends)
            go = go[text[at[go] + j] == table[word[go], j]]
            word, at, row = word[go], at[go], row[go]
        done.append(row * len(words) + word)
        return np.divmod(np.unique(np.concatenate(done)), len(words))

    def find(texts: pa.Array) -> pa.Array:
        texts = texts.cast(pa.large_string()).fill_null("")
        bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
        counts, found, i = [np.zeros(1, np.int64)], [], 0
        while i < len(texts):
            j = max(i + 1, int(np.searchsorted(bounds, bounds[i] + SLICE_BYTES, "right")) - 1)
            row, word = of(data[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i])
            counts.append(np.bincount(row, minlength=j - i))
            found.append(word)
            i = j
        own = names.take(pa.array(np.concatenate(found) if found else np.zeros(0, np.int64)))
        return pa.ListArray.from_arrays(pa.array(np.cumsum(np.concatenate(counts)), pa.int32()), own)

    return find


def words_of_texts(text: Column, words: Iterable[str]) -> Column:
    """``words_in`` by Arrow batches."""
    words = sorted({w for w in words if w})
    held: dict[str, Callable] = {}  # made once in a task's worker

    def find(texts: pa.Array) -> pa.Array:
        return held.setdefault("f", held.get("f") or finder(words))(texts)

    return F.arrow_udf(find, NONE)(text) if words else F.array().cast(NONE)


class Words:
    """Found words, asked for by dictionary."""

    def __init__(self, column: Column):
        self.column = column

    def found(self, words: Iterable[str]) -> Column:
        """The dictionary's words that were found, in its order."""
        words = list(dict.fromkeys(words))
        return F.array_intersect(listed(words), self.column) if words else F.array().cast(NONE)

    def hits(self, words: Iterable[str]) -> Column:
        return F.size(self.found(words))

    def any(self, words: Iterable[str]) -> Column:
        words = list(words)
        return F.arrays_overlap(self.column, listed(words)) if words else F.lit(False)

    def first(self, words: Iterable[str]) -> Column:
        return F.get(self.found(words), F.lit(0))


def scanned(leads: DataFrame, columns: Iterable[str], words: Iterable[str]) -> DataFrame:
    """leads with a column ``scan_x`` for each column x: the words found in its lower-cased text, and its edges, which are
    what it adds to words that reach over into a column beside it. Models that read x then don't pass over it again."""
    words = sorted(set(words))
    most = max(map(len, words))
    out = leads
    for c in columns:
        out = out.withColumn("__low", F.lower(text_of(c)))
        low = F.col("__low")
        edges = F.when(F.length(low) > 2 * most, F.concat(F.left(low, F.lit(most)), F.lit("\x01"), F.right(low, F.lit(most)))).otherwise(low)
        out = out.withColumn(f"scan_{c}", F.struct(words_of_texts(low, words).alias("words"), edges.alias("edges"), F.lit(len(words)).alias("of"))).drop("__low")
    return out


def words_of_columns(leads: DataFrame, columns: Iterable[str], *dictionaries: Iterable[str]) -> Column:
    """The dictionaries' words in the lower-cased text of several columns with a space between (a missing one is empty): by
    one pass over the text, or from what ``scanned`` has found (which must have had these dictionaries) and the edges."""
    words = {w for d in dictionaries for w in d}
    there = [c for c in columns if f"scan_{c}" in leads.columns]
    of = lambda c: F.col(f"scan_{c}.edges") if c in there else F.lower(text_of(c)) if c in leads.columns else F.lit("")
    own = words_in(F.concat_ws(" ", *map(of, columns)), words)
    for c in there:
        own = F.array_union(own, F.col(f"scan_{c}.words"))
    return own
