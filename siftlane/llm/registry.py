"""The queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from siftlane.llm import decontaminate, matroska, minhash, packing, pii, prefix_trie, quality, secrets, simhash, sql, token_counts, token_ids, urls, vector_codes
from siftlane.llm.common import shared_path, vocabulary
from siftlane.session import spread, table


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents; a small file of them is dealt to all tasks."""
    return spread(table(spark, sf_dir, "documents"))


def op1_matroska(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document stored as an audio track and read back."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    sized = docs.select("doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"), "text")
    return matroska.file_facts(matroska.store_texts(sized))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perplexity, its limit and the decision for every document."""
    docs, labels = documents(spark, sf_dir), table(spark, sf_dir, "labels")
    judged = quality.train(docs, labels).judge(docs.select("doc_id", "lang", "text"))
    return judged.select("doc_id", "lang", F.round("perplexity", 6).alias("perplexity"), F.round("limit", 6).alias("limit"), "keep")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequences of 512, 1024 or 2048 tokens with the ids of every document."""
    return packing.pack_tokens(documents(spark, sf_dir), vocabulary("word_bpe_49k.json"))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: the rules' counts and digest, and all spans."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = secrets.train(secrets.labelled_samples(docs))
    found = secrets.find_secrets(docs, model).select("doc_id", "secrets")
    base = F.filter("secrets", lambda s: s["rank"] < 3)
    count = lambda i: F.size(F.filter("secrets", lambda s: s["rank"] == i)).cast("long")
    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(secrets.spans_text(base), 256).alias("base_sha256"),
        secrets.spans_text(F.col("secrets")).alias("spans"),
    )


#: The rules of the url query.
URL_RULES = (
    urls.Rule("allow", "org", "/"),
    urls.Rule("block", "example.org", "/es/"),
    urls.Rule("block", "example.org", "/en/1"),
    urls.Rule("allow", "com", "/fr/"),
    urls.Rule("block", "com", "/de/"),
)


def op5_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page; a page's outcome is the label of its number."""
    pages, labels = table(spark, sf_dir, "pages").select("page_id", "url"), table(spark, sf_dir, "labels")
    outcome = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max((F.col("quality") == 0) | (F.coalesce("toxic", F.lit(0)) == 1)).alias("bad"))
    labelled = pages.select(F.col("page_id").alias("doc_id"), urls.host_of(F.col("url")).alias("host")).join(outcome, "doc_id")
    known = urls.reputation(labelled.select("host", "bad"))
    return urls.filter_urls(pages, known, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


#: A key for these synthetic tables; a user gives a secret one.
PII_KEY = "synthetic tables"


def op6_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with format-preserving pseudonyms, and what was replaced."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    found = pii.pseudonymise(docs, PII_KEY)
    count = lambda k: F.size(F.filter("pii", lambda m: m["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select("doc_id", "text", *[count(k) for k in pii.KINDS], F.transform("pii", lambda m: m["pseudonym"]).alias("pseudonyms"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram token counts of every document, by a model of all documents."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = token_counts.train(docs, vocabulary("piece_bpe_32k.model"))
    return token_counts.count_tokens(docs, model).select("doc_id", "n_pretokens", "n_tokens")


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages in every document: one row for each document, item and window."""
    docs, benchmark = documents(spark, sf_dir), table(spark, sf_dir, "benchmark")
    found = decontaminate.contaminated(docs, benchmark)
    return found.select("doc_id", "item_id", F.col("start").cast("long"), F.col("n_words").cast("long"), F.col("hamming").cast("long"), F.round("similarity", 6).alias("similarity"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus pipeline's rows."""
    return corpus_pipeline.run(spark, sf_dir)


def ids_crc32(ids: np.ndarray) -> dict:
    return {"ids_crc32": zlib.crc32(ids.astype("<u4").tobytes())}


def op9_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files of every document, read back."""
    docs, path = documents(spark, sf_dir), shared_path(spark, "tokens")
    token_ids.write_token_files(docs, path, vocabulary("word_bpe_49k.json"))
    return token_ids.read_token_files(spark, path, ids_crc32, "ids_crc32 long")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document: four-word shingles, radius 4."""
    found = simhash.near_duplicates(documents(spark, sf_dir), shingle=4, radius=4, segment_bits=2)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all conversations, each with the first turns of its group's first one."""
    found = prefix_trie.sequences(table(spark, sf_dir, "conversations"))
    return prefix_trie.trie(prefix_trie.with_shared_heads(found))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product codes of all embeddings: 16 parts, 64 entries, two rounds."""
    made = vector_codes.compress(table(spark, sf_dir, "embeddings"))
    return vector_codes.label_errors(made.rows).select("vec_id", "code", "error", "label_error", F.lit(vector_codes.books_digest(made.books)).alias("codebooks_sha256"))


def op13_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document by exact similarity of four-word shingles, and whether it stands for it."""
    found = minhash.near_duplicates(documents(spark, sf_dir), shingle=4, percent=80)
    return found.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


QUERIES = {f.__name__: f for f in (op1_matroska, op2_quality, op3_packing, op4_secrets, op5_urls, op6_pseudonyms, op7_token_counts, op8_decontaminate, op9_token_ids, op10_simhash, op11_prefix_trie, op12_vector_codes, op13_minhash, pipeline)}
ORACLE_SQL: dict[str, str] = {"op5_urls": sql.OP5_URLS, "op11_prefix_trie": sql.OP11_PREFIX_TRIE, "op12_vector_codes": sql.OP12_VECTOR_CODES, "op13_minhash": sql.OP13_MINHASH}
