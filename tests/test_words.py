"""One pass over a text against looking for each word."""

import random

from pyspark.sql import functions as F

from siftlane.functions.words import Words, scanned, words_in, words_of_columns


def test_words_in_texts(spark):
    rng = random.Random(5)
    words = ["a", "ab", "abc", "bc", "b c", "c.a", "ü", "üb", "(x)", "aa", "a/b", "-", "cab", "bb-a", "ç a"]
    texts = ["".join(rng.choice("aabbc .üç()x/-") for _ in range(rng.randrange(40))) for _ in range(300)] + ["", "abc", "aaaa"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("m", words_in(F.col("t"), words))
    m = Words(F.col("m"))
    some = ["üb", "abc", "a", "zz", "b c"]
    for r in df.select("t", "m", m.found(some).alias("found"), m.hits(some).alias("n"), m.any(some).alias("any"), m.first(some).alias("first"), m.any([]).alias("none")).collect():
        assert sorted(r.m) == sorted(w for w in words if w in r.t)
        want = [w for w in some if w in r.t]
        assert r.found == want and r.n == len(want) and r["any"] == bool(want) and r["first"] == (want[0] if want else None) and not r.none


def test_scanned_columns_give_the_words_of_the_joined_text(spark):
    rng = random.Random(6)
    words = ["ab", "b a", "a  b", "c a c", "abc ab"]
    part = lambda n: "".join(rng.choice("AabBc ") for _ in range(rng.randrange(n)))
    rows = [(part(4), part(60), part(5)) for _ in range(300)] + [(None, None, None), ("a", None, "b")]
    df = spark.createDataFrame(rows, "x string, y string, z string")
    both = scanned(df, ("x", "y"), words)
    plain = [sorted(r[0]) for r in df.select(words_of_columns(df, ("x", "y", "z", "missing"), words)).collect()]
    assert plain == [sorted(r[0]) for r in both.select(words_of_columns(both, ("x", "y", "z", "missing"), words)).collect()]
    assert plain == [sorted(w for w in words if w in " ".join(c or "" for c in (*r, "")).lower()) for r in rows]


def test_words_by_batches_are_those_of_the_pattern():
    """Texts cut into slices, nulls, letters of several bytes, words of one and two bytes, and a batch that begins inside an array."""
    import pyarrow as pa

    from siftlane.functions import words as W

    rng = random.Random(7)
    words = ["a", "ab", "abc", "ü", "üb", "b c", "ç a", "cabab"]
    texts = [None if rng.random() < 0.1 else "".join(rng.choice("aabbc üç") for _ in range(rng.randrange(30))) for _ in range(500)]
    before, W.SLICE_BYTES = W.SLICE_BYTES, 200
    try:
        got = W.finder(words)(pa.array(["abc", *texts, "abc"]).slice(1, len(texts))).to_pylist()
    finally:
        W.SLICE_BYTES = before
    assert [sorted(x) for x in got] == [sorted(w for w in words if w in (t or "")) for t in texts]


def test_scans_of_whole_texts_pass_by_batches(spark):
    plan = scanned(spark.createDataFrame([("a b",)], "x string"), ("x",), ["a b", "b"])._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "regexp_extract_all" not in plan
