"""The language model against a plain one, and the decisions against held-out labels."""

import math
import random
from collections import Counter, defaultdict

import pytest

from siftlane.llm import quality, registry

TEXTS = ["the cat sat on the mat", "the dog sat 12 times", "a cat and a dog", "é🙂 the end\n", "the cat sat on the mat", "hat rat bat cat that", ""]


class Plain:
    """Interpolated modified Kneser-Ney of characters, straight from its definition."""

    def __init__(self, texts):
        code = lambda c: "0" if c.isdigit() else c if ord(c) < 0xFFFF else "￿"
        self.code, n = code, quality.ORDER
        self.counts = {n: Counter()}
        for t in texts:
            cs = ["\0"] * (n - 1) + [code(c) for c in t]
            self.counts[n].update(tuple(cs[i : i + n]) for i in range(len(cs) - n + 1))
        for k in range(n - 1, 0, -1):
            self.counts[k] = Counter(g[1:] for g in self.counts[k + 1])
        self.d, self.around = {}, {}
        for k, c in self.counts.items():
            of = Counter(c.values())
            if all(of[i] for i in (1, 2, 3, 4)):
                y = of[1] / (of[1] + 2 * of[2])
                self.d[k] = [max(0.05, min(i - 0.05, i - (i + 1) * y * of[i + 1] / of[i])) for i in (1, 2, 3)]
            else:
                self.d[k] = [0.5, 1.0, 1.5]
            self.around[k] = defaultdict(list)
            for g, x in c.items():
                self.around[k][g[:-1]].append(x)

    def p(self, gram):
        k = len(gram)
        if k == 0:
            return 1 / (len(self.counts[1]) + 1)
        own = self.around[k].get(gram[:-1])
        if own is None:
            return self.p(gram[1:])
        cut = lambda x: self.d[k][min(x, 3) - 1]
        x = self.counts[k].get(gram, 0)
        return ((x - cut(x)) if x else 0) / sum(own) + sum(map(cut, own)) / sum(own) * self.p(gram[1:])

    def log(self, text):
        n = quality.ORDER
        cs = ["\0"] * (n - 1) + [self.code(c) for c in text]
        return sum(math.log(self.p(tuple(cs[i : i + n]))) for i in range(len(cs) - n + 1))


@pytest.mark.parametrize("mapped_rows", [2_000_000, 0])
def test_scores_match_the_definition(spark, mapped_rows):
    trusted = [(t, "en") for t in TEXTS] + [("la casa y el perro", None)]
    model = quality.fit(spark.createDataFrame(trusted, "text string, lang string"), mapped_rows=mapped_rows)
    assert (model.arrays is None) == (mapped_rows == 0)
    rows = [(1, "the cat xyz", "en"), (2, None, "en"), (3, "", "en"), (4, "abc", "xx"), (5, "zqzq 99 🙂é", "en"), (6, "la gata", None), (6, "la gata", None), (None, "the" * 5000, "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "1 as gram", "2 as n", "3 as log_prob")
    got = quality.score(docs, model)
    assert got.columns == ["doc_id", "text", "lang", "gram", "n", "n_chars_scored", "log_prob"]
    plain = {"en": Plain(TEXTS), None: Plain(["la casa y el perro"])}
    want = sorted((repr(i), len(t or ""), plain[g].log(t or "") if g in plain else None) for i, t, g in rows)
    for a, b in zip(sorted((repr(r.doc_id), r.n_chars_scored, r.log_prob) for r in got.collect()), want):
        assert a[:2] == b[:2] and (a[2] is None) == (b[2] is None) and (a[2] is None or math.isclose(a[2], b[2], rel_tol=1e-9, abs_tol=1e-9))


def test_probabilities_add_up():
    model = Plain(TEXTS)
    for context in (("\0", "\0", "\0"), ("t", "h", "e"), ("q", "q", "q")):
        assert math.isclose(sum(model.p((*context, c)) for (c,) in model.counts[1]) + model.p((*context, "\1")), 1)


def test_edges_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "fine text here", "en"), (2, None, "en"), (3, "x", None), (None, "fine text", "en")], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, None), (None, 1, 0)], "doc_id long, quality int, toxic int")
    none = labels.where("false")
    for given in (labels, none):
        judged = quality.train(docs, given).judge(docs)
        assert judged.columns == ["doc_id", "text", "lang", "perplexity", "limit", "keep"]
        assert {r.doc_id: r.keep for r in judged.collect()} == {1: True, 2: False, 3: True, None: True}
    good = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    assert quality.train(docs.where("false"), good).judge(docs.where("false")).count() == 0
    assert {r.doc_id: r.keep for r in quality.train(docs, good).judge(docs).collect()}[1]


def test_held_out_decisions(spark):
    """Trained on half the labels, judged on the other half."""
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    judged = quality.train(docs, labels.where("doc_id % 2 = 0")).judge(docs)
    keep = {r.doc_id: r.keep for r in judged.collect()}
    held = [r for r in labels.where("doc_id % 2 = 1").collect()]
    clean = [keep[r.doc_id] for r in held if r.quality == 1 and not r.toxic]
    junk = [keep[r.doc_id] for r in held if r.quality == 0]
    assert sum(clean) >= 0.97 * len(clean) and sum(junk) <= 0.2 * len(junk)
    assert registry.op2_quality(spark, sf).count() == docs.count()


def test_slices_and_languages_change_nothing(spark):
    rng = random.Random(2)
    rows = [(i, "".join(rng.choice("abcde ") for _ in range(rng.randrange(60))), rng.choice(["en", "de", None])) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    one = {(r.lang, r.gram): r.n for r in quality.gram_counts(df).collect()}
    two = {(r.lang, r.gram): r.n for r in quality.gram_counts(df.repartition(7)).collect()}
    assert one == two and sum(one.values()) == sum(len(t) for _, t, _ in rows)


def test_limits_are_quantiles_of_each_language(spark):
    rng = random.Random(8)
    rows = [(lang, n, -n * x) for lang in ("en", "de") for n in (100, 3000) for x in (rng.uniform(1, 4) + (lang == "de") for _ in range(500 if n == 100 else 20))]
    got = {(r.lang, r["class"]): r.limit for r in quality.thresholds(spark.createDataFrame(rows, "lang string, n_chars_scored long, log_prob double"), quantile=0.9, least=100).collect()}
    assert set(got) == {(lang, c) for lang in ("en", "de") for c in (None, 6)}
    for (lang, c), limit in got.items():
        own = [-p / n for g, n, p in rows if g == lang and c in (None, int(math.log2(n)))]
        assert abs(sum(x <= limit for x in own) - 0.9 * len(own)) <= 1
