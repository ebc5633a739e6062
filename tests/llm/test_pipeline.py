"""The pipeline's stages against plain versions of what they promise."""

import random

import pytest
from test_decontaminate import brute
from test_packing import laid_back
from test_secrets import plain_spans

import corpus_pipeline
from siftlane.llm import secrets, simhash
from siftlane.llm.common import vocabulary

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), [spark.read.parquet(f"{SF}/documents.parquet")]
    base = tmp_path_factory.mktemp("stages")
    for i, (_, f) in enumerate(corpus_pipeline.STAGES):
        f(spark, docs, SF).write.parquet(f"{base}/{i}")
        docs = spark.read.parquet(f"{base}/{i}")
        out.append(docs)
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_columns_and_rows(stages):
    assert len({tuple(s.columns) for s in stages[:5]}) == 1
    before = texts(stages[0])
    for s in stages[1:4]:
        now = texts(s)
        assert now.items() <= before.items() and s.count() == len(now)
        before = now


def test_quality_keeps_clean_documents(spark, stages):
    kept, labels = texts(stages[1]), spark.read.parquet(f"{SF}/labels.parquet").collect()
    clean = [r.doc_id in kept for r in labels if r.quality == 1 and not r.toxic]
    junk = [r.doc_id in kept for r in labels if r.quality == 0]
    assert sum(clean) >= 0.97 * len(clean) and sum(junk) < len(junk)


def test_one_of_each_group_stays(stages):
    """Against the exact Jaccard similarity of all pairs: what goes is linked with what stays, and few links are missed."""
    before, after = texts(stages[1]), texts(stages[2])
    sets = {i: set(simhash.shingle_hashes(t, 5).tolist()) for i, t in before.items()}
    ids = sorted(before)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(sets[a] & sets[b])
            if both >= 0.8 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    parts = {find(i) for i in ids}
    assert parts <= set(after) and len(after) < len(before)
    assert len(after) - len(parts) <= 0.1 * (len(before) - len(parts))


def test_benchmark_passages_go(spark, stages):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    before = texts(stages[2])
    hit = {d for d, _ in brute(list(before.items()), items)}
    assert set(texts(stages[3])) == set(before) - hit


def test_secrets_are_redacted(spark, stages):
    model = secrets.train(secrets.labelled_samples(stages[3]))
    after = texts(stages[4])
    for i, t in texts(stages[3]).items():
        want, at = "", 0
        for s, _, e in plain_spans(t, model):
            want += (t[at:s] + "[SECRET]") if s >= at else ""
            at = max(at, e)
        assert after[i] == want + t[at:]


def test_packing_holds_every_token(stages):
    from tokenizers import Tokenizer

    tokenizer, got = Tokenizer.from_file(vocabulary("word_bpe_49k.json")), {}
    for d, pieces in laid_back(stages[5].collect()).items():
        got[d] = sum((p[0] for _, p in sorted(pieces.items())), [])
    assert got == {i: [*tokenizer.encode(t, add_special_tokens=False).ids, 1] for i, t in texts(stages[4]).items()}


def test_run_gives_the_last_stage(spark, stages):
    every = lambda df: sorted(x for r in df.collect() for x in zip(r.doc_ids, r.starts, r.lengths))
    assert every(corpus_pipeline.run(spark, SF)) == every(stages[5])


def test_near_copies_nulls_and_repeats(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9)))
    rows = []
    for g in range(12):
        ws = [word() for _ in range(400)]
        for k in range(4):
            own = list(ws)
            if k:
                own[rng.randrange(400)] = word()
            rows.append((g * 10 + k, " ".join(own)))
    rows += [rows[0], rows[0], (None, rows[4][1]), (None, "alone " + word()), (500, None), (501, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as component", "2 as n")
    got = simhash.one_of_each(docs)
    assert got.columns == docs.columns
    assert sorted(repr(r.doc_id) for r in got.collect()) == sorted(map(repr, [*(g * 10 for g in range(12)), None, 500]))
    assert simhash.one_of_each(docs.where("false")).count() == 0
