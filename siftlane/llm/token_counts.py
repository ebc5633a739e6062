"""Token counts by a unigram model: forward scores shared along a trie of pre-tokens.

A pre-token is a word between ASCII white space with the word mark before it. Its tokens are
the pieces of the best path, the sum of the pieces' scores being greatest (of equal paths the
one of fewer pieces). The forward score of a prefix depends on that prefix alone, so the
distinct pre-tokens of a slice of documents are put in a trie and each shared prefix is
scored once; the score and count at a terminal are its pre-token's. Documents then sum the
counts of their pre-tokens. Counting shuffles no row: each task has its own trie, bounded by a slice
of its documents, and a bounded cache of frequent pre-tokens between slices.

Piece scores (``train``): log-probabilities of a public vocabulary's pieces, which stays as it is. All
documents' distinct pre-tokens are counted; then, in each round, each is cut by its best path
under the scores so far (at first all pieces are alike), and the pieces' counts, SMOOTH added, give
the next scores: expectation maximisation on best paths, along the same trie. A round's result is a row
for each piece, so what is collected is bounded by the vocabulary. A character outside
the vocabulary takes one token for each of its UTF-8 bytes, each scored BYTE_STEP below the least piece.

A null or empty text has no pre-tokens and no tokens. Equal texts have equal counts. Without any
pre-token all pieces stay alike.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftlane.llm.common import checkpointed, row_sums, slices, whole_text, words_of

WORD_MARK = "▁"
BYTE_STEP = 2.0
SMOOTH = 0.5
SLICE_BYTES = 16 << 20


@dataclass(frozen=True)
class Unigram:
    """Scores of the pieces, and of a byte of what no piece covers."""

    scores: dict[str, float]
    byte_score: float
    longest: int

    @classmethod
    def of_counts(cls, pieces: list[str], counts: dict[str, float]) -> "Unigram":
        total = math.log(sum(counts.values()) + SMOOTH * len(pieces))
        scores = {p: math.log(counts.get(p, 0) + SMOOTH) - total for p in pieces}
        return cls(scores, min(scores.values()) - BYTE_STEP, max(map(len, pieces)))


def vocabulary_pieces(model_file: str) -> list[str]:
    """The pieces of a public vocabulary that stand for text."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    return [model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]


def trie_paths(words: list[str], model: Unigram) -> Iterator[tuple[int, str, list[float], list[int], list[int]]]:
    """(index, marked word, forward scores, tokens, where the last piece begins) of each word and its prefixes, the start
    being -1 for bytes. The words are walked in order, which visits their trie depth first: the lists are the path from the
    root, cut back to the prefix shared with the next word, and are only valid until then."""
    best, tokens, back, path = [0.0], [0], [0], ""
    get, byte_score, longest = model.scores.get, model.byte_score, model.longest
    for at in sorted(range(len(words)), key=words.__getitem__):
        word = WORD_MARK + words[at]
        shared, most = 0, min(len(word), len(path))
        while shared < most and word[shared] == path[shared]:
            shared += 1
        del best[shared + 1 :], tokens[shared + 1 :], back[shared + 1 :]
        for end in range(shared + 1, len(word) + 1):
            size = len(word[end - 1].encode("utf-8", "surrogatepass"))
            top, count, first = best[end - 1] + byte_score * size, tokens[end - 1] + size, -1
            for start in range(max(0, end - longest), end):
                s = get(word[start:end])
                if s is not None:
                    s += best[start]
                    n = tokens[start] + 1
                    if s > top or (s == top and n < count):
                        top, count, first = s, n, start
            best.append(top)
            tokens.append(count)
            back.append(first)
        path = word
        yield at, word, best, tokens, back


def trie_counts(words: list[str], model: Unigram) -> np.ndarray:
    """Tokens of each word."""
    counts = np.zeros(len(words), dtype=np.int64)
    for at, _, _, tokens, _ in trie_paths(words, model):
        counts[at] = tokens[-1]
    return counts


def piece_counts(words: list[str], times: list[int], model: Unigram) -> dict[str, int]:
    """How often each piece stands on the best paths of words that occur so many times."""
    out: dict[str, int] = {}
    for at, word, _, _, back in trie_paths(words, model):
        end, n = len(word), times[at]
        while end:
            start = back[end]
            if start < 0:
                end -= 1
            else:
                piece = word[start:end]
                out[piece] = out.get(piece, 0) + n
                end = start
    return out


def pretoken_counts(docs: DataFrame, text_col: str) -> DataFrame:
    """(word, n) of all documents' distinct pre-tokens; a task sends each word once for a slice."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, "__text", SLICE_BYTES):
                words, index, _ = words_of(rows["__text"])
                yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(np.bincount(index, minlength=len(words)))], names=["word", "n"])

    return docs.select(whole_text(text_col).alias("__text")).mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def train(docs: DataFrame, model_file: str, *, text_col: str = "text", rounds: int = 2) -> Unigram:
    """The scores of a vocabulary's pieces from all documents."""
    pieces = vocabulary_pieces(model_file)
    model, spark = Unigram.of_counts(pieces, {}), docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    words = checkpointed(pretoken_counts(docs, text_col).repartitionByRange(parts, "word"))
    for _ in range(rounds):
        sent = spark.sparkContext.broadcast(model)

        def cut(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            held: dict[str, int] = {}
            for batch in batches:
                for piece, n in piece_counts(batch["word"].to_pylist(), batch["n"].to_pylist(), sent.value).items():
                    held[piece] = held.get(piece, 0) + n
            yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["piece", "n"])

        seen = words.mapInArrow(cut, "piece string, n long").groupBy("piece").agg(F.sum("n").alias("n")).collect()  # the vocabulary at most
        model = Unigram.of_counts(pieces, {r.piece: r.n for r in seen})
        sent.unpersist()
    return model


def count_tokens(docs: DataFrame, model: Unigram, *, text_col: str = "text", cache_words: int = 200_000) -> DataFrame:
    """docs with the columns n_pretokens and n_tokens (of clashing names, the new ones win).

    cache_words: pre-tokens a task remembers between slices; more or fewer change the speed alone. The model is broadcast:
    its size is the vocabulary's.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in docs.columns if c not in ("n_pretokens", "n_tokens")]
    work = docs.select(*kept, whole_text(text_col).alias("__text"))
    schema = docs.select(*kept).schema.add("n_pretokens", "long").add("n_tokens", "long")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}
        for batch in batches:
            for rows in slices(batch, "__text", SLICE_BYTES):
                words, index, bounds = words_of(rows["__text"])
                new = [w for w in words if w not in known]
                fresh = dict(zip(new, trie_counts(new, sent.value).tolist()))
                each = np.fromiter((known[w] if w in known else fresh[w] for w in words), dtype=np.int64, count=len(words))
                if len(known) < cache_words:
                    often = np.bincount(index, minlength=len(words)) > 1
                    known.update((w, int(c)) for w, c, o in zip(words, each, often) if o)
                columns = [rows[c] for c in kept] + [pa.array(np.diff(bounds)), pa.array(row_sums(each[index], bounds))]
                yield pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())

    return work.mapInArrow(count, schema)
