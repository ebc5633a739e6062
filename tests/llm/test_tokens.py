"""Token counts and token files against plain encodings of each text."""

import math
import random
import subprocess
import sys
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from siftlane.llm import registry, token_counts, token_ids
from siftlane.llm.common import shared_path, vocabulary

TEXTS = [
    (5, "The quick brown fox, the QUICK brown fox.\n\tagain"),
    (2, ""),
    (9, None),
    (None, "no id"),
    (7, "é́ ﬁ ß Σας Ω l'été isn't don't 12 345 <|endoftext|> a<|startoftext|>b"),
    (7, "é́ ﬁ ß Σας Ω l'été isn't don't 12 345 <|endoftext|> a<|startoftext|>b"),
    (1, "nb sp em line\x1csep\x85nel 漢字かな 🙂🙂 \x00 zero​width"),
    (3, "word " * 30_000),
    (4, "x" * 50_000),
    (-8, "   \r\n "),
]
SCHEMA = "doc_id long, text string"


@pytest.mark.parametrize("texts", [TEXTS, []])
def test_token_files_round_trip(spark, texts):
    docs = spark.createDataFrame(texts, SCHEMA).withColumnRenamed("doc_id", "id").selectExpr("id as doc_id", "text", "'x' as part", "1 as name")
    path = shared_path(spark, "tokens")
    token_ids.write_token_files(docs, path, vocabulary("word_bpe_49k.json"))
    got = token_ids.read_token_files(spark, path, docs_a_task=2).orderBy("start").collect()
    tokenizer = token_ids.load_tokenizer(vocabulary("word_bpe_49k.json"))
    want, start = [], 0
    for doc_id, text in sorted(texts, key=lambda t: (t[0] is not None, t[0] or 0)):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        want.append((doc_id, start, len(ids), ids))
        start += len(ids)
    assert [tuple(r) for r in got] == want


def test_token_file_query(spark):
    sf = "/root/testdata/sf0.001"
    tokenizer = token_ids.load_tokenizer(vocabulary("word_bpe_49k.json"))
    start, want = 0, []
    for r in spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect():
        ids = np.array([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 1], dtype="<u4")
        want.append((r.doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert [tuple(r) for r in registry.op9_token_ids(spark, sf).orderBy("doc_id").collect()] == want


def best_path(word, model):
    """(score, tokens, pieces) of one word, by itself."""
    word = token_counts.WORD_MARK + word
    best = [(0.0, 0, ())]
    for end in range(1, len(word) + 1):
        size = len(word[end - 1].encode())
        ways = [(best[end - 1][0] + model.byte_score * size, -(best[end - 1][1]) - size, best[end - 1][2])]
        ways += [(best[a][0] + model.scores[word[a:end]], -best[a][1] - 1, (*best[a][2], word[a:end])) for a in range(end) if word[a:end] in model.scores]
        top = max(ways, key=lambda w: w[:2])
        best.append((top[0], -top[1], top[2]))
    return best[-1]


def split(text):
    return [w for w in __import__("re").split(r"[ \t\n\r\x0b\x0c]+", text or "") if w]


@pytest.mark.parametrize("texts", [TEXTS, []])
def test_token_counts_match_single_words(spark, texts):
    file = vocabulary("piece_bpe_32k.model")
    texts = [(i, t if t is None or len(t) < 40_000 or " " in t else None) for i, t in texts]
    docs = spark.createDataFrame(texts, SCHEMA).selectExpr("doc_id", "text", "7 as n_tokens", "'kept' as words")
    model = token_counts.train(docs, file)
    got = token_counts.count_tokens(docs, model)
    assert got.columns == ["doc_id", "text", "words", "n_pretokens", "n_tokens"]
    memo = {}

    def tokens(text):
        words = split(text)
        return len(words), sum(memo.setdefault(w, best_path(w, model)[1]) for w in words)

    assert sorted(map(repr, ((r.doc_id, r.n_pretokens, r.n_tokens) for r in got.collect()))) == sorted(map(repr, ((i, *tokens(t)) for i, t in texts)))


def test_scores_are_trained_on_best_paths(spark):
    """Each round against plain counting over single words, and the best paths become likelier."""
    from collections import Counter

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text")
    words, file = Counter(w for r in docs.collect() for w in split(r.text) if len(w) < 200), vocabulary("piece_bpe_32k.model")
    pieces = token_counts.vocabulary_pieces(file)
    docs = spark.createDataFrame([(" ".join([w] * n),) for w, n in words.items()], "text string")
    model, before = token_counts.Unigram.of_counts(pieces, {}), -math.inf
    for rounds in (1, 2):
        counts, total = Counter(), 0.0
        for w, n in words.items():
            score, _, path = best_path(w, model)
            total += n * score
            for p in path:
                counts[p] += n
        assert total > before
        model, before = token_counts.Unigram.of_counts(pieces, counts), total
        got = token_counts.train(docs, file, rounds=rounds)
        assert got.scores == model.scores and got.byte_score == model.byte_score


def test_very_long_word_is_counted(spark):
    model = token_counts.Unigram.of_counts(token_counts.vocabulary_pieces(vocabulary("piece_bpe_32k.model")), {})
    counts = token_counts.trie_counts(["x" * 5000, "x" * 4999, "y"], model)
    assert counts[0] >= counts[1] > counts[2] >= 1


def test_words_encode_as_by_themselves():
    file = vocabulary("word_bpe_49k.json")
    tokenizer = token_ids.load_tokenizer(file)
    words = ["plain", "Caps.", "tail***", "it's", "'s", "s'", "don't.", "é́x", "İstanbul,", "ﬁn", "a1", "1a", "12", "ⅷ", "x²", "漢字", "漢字。", "ab-cd", "-ab", "ªº", "Ⅷ", "ŉ.", "ß", "ẞ!", "a" * 300, "ά", "ΑΣ", "ﷺ", "<|endoftext|>", "x<|endoftext|>", "ẞ", "á", "ॐ", "नि"]
    assert token_ids.encode_words(words, file) == [tokenizer.encode(w, add_special_tokens=False).ids for w in words]


def test_folder_that_tasks_cannot_open_is_told_before_any_work(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    with pytest.raises(ValueError, match="plain files"):
        token_ids.write_token_files(docs, "swift://store/tokens", vocabulary("word_bpe_49k.json"))


def test_rows_by_parts_have_the_ids_of_whole_texts():
    file = vocabulary("word_bpe_49k.json")
    tokenizer = token_ids.load_tokenizer(file)
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdeéß中") for _ in range(rng.randrange(1, 9))) + rng.choice(["", ",", "'s", "...", "7"]) for _ in range(300)] + ["--", "x=1", "İ", "ﬁ"]
    texts = ["", " ", *(" ".join(rng.choices(words, k=rng.randrange(1, 90))) for _ in range(60)), ""]
    want = [[*tokenizer.encode(t, add_special_tokens=False).ids, 1] for t in texts]
    for by_word in (True, False):
        for part_bytes in (1, 700, 1 << 20):
            ids, ends = token_ids.encode_rows(pa.array(texts), file, 1, by_word, part_bytes)
            assert [x.tolist() for x in np.split(ids, ends[:-1])] == want
    for at_once in (1, 7, 1000):
        flat, sizes = token_ids.ids_of_words(words, file, at_once)
        assert [x.tolist() for x in np.split(flat, np.cumsum(sizes)[:-1])] == [tokenizer.encode(w, add_special_tokens=False).ids for w in words]
    assert [len(x) for x in token_ids.encode_rows(pa.array([], pa.string()), file, 1, True)] == [0, 0]
    assert [len(x) for x in token_ids.encode_rows(pa.array([], pa.string()), file, 1, False)] == [0, 0]


def test_memory_of_many_different_words():
    """What a fresh process takes above the start for 13 MB of text with 300,000 different words."""
    code = """
import re
import numpy as np, pyarrow as pa
from siftlane.llm import token_ids
from siftlane.llm.common import vocabulary
rng = np.random.default_rng(8)
words = [w.tobytes().decode() + t for w, t in zip(rng.integers(97, 107, (300_000, 7), dtype=np.uint8), ["", ",", ".", "1"] * 75_000)]
texts = pa.array([" ".join(words[i] for i in rng.integers(0, len(words), 3_000)) for _ in range(500)])
file = vocabulary("word_bpe_49k.json")
token_ids.encode_rows(texts[:1], file, 1, True)
held = lambda name: int(re.search(rf"{name}:\\s+(\\d+)", open("/proc/self/status").read())[1]) / 1024
open("/proc/self/clear_refs", "w").write("5")
before = held("VmRSS")
token_ids.encode_rows(texts, file, 1, True)
print(held("VmHWM") - before)
"""
    root = str(Path(token_ids.__file__).parents[2])
    out = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, check=True).stdout
    assert float(out) < 220
