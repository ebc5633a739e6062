"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks, exact check.

Words are runs of letters and digits of the lower-cased text; an item of fewer than ``shingle``
words is one shingle, as is a window of its size. A window has as many words as the item it is
compared with. Two texts are compared by weighted shingles: a shingle weighs as many as it has
characters, and the similarity is the sum of the lesser weights over that of the greater ones,
repeats counted.

1. Windows: a window that shares no shingle with an item has similarity zero, so windows are
   laid where a document has an item's shingle: each so that the shingle has its place in the
   item, and ``drift`` words to either side (a window whose edge misses an edited word may
   be a little closer), moved inside the document where it would stand out.
2. Equal windows are one row from here on, however many documents hold them.
3. SimHash: 64 bits, each 1 if more than half of the window's shingle hashes (repeats included) have it.
4. Multi-index blocks: the fingerprint is cut into radius + 1 blocks; two fingerprints within the
   radius are equal in a block at least, so an equi-join on (size, block, value) finds all of them.
   The Hamming distance then drops the rest.
5. The weighted similarity is computed exactly for what is left; matches reach ``similarity``.

Radius 15 keeps about 97 in 100 of the pairs that have similarity 0.8 exactly (their fingerprints
differ in 9.7 bits on average, with a deviation of 2.9) and nearly all above.

The benchmark's shingles are broadcast only if their number, which is counted first, is at most
``broadcast_rows`` (16 bytes each); beyond it both sides are shuffled by the shingle's hash.

Nulls: null or empty texts and items have no words and match nothing; a null id is kept. Repeated
rows of docs give their matches once, as they are the same document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftlane.llm.common import checkpointed, whole_text

WORD = r"[\p{L}\p{N}]+"


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def shingles(own: Column, size: int) -> Column:
    """The runs of ``size`` words, space-joined; fewer words are one run, none no run."""
    last = F.greatest(F.lit(1), F.size(own) - (size - 1))
    return F.when(F.size(own) == 0, F.array().cast("array<string>")).otherwise(F.transform(F.sequence(F.lit(1), last), lambda i: F.array_join(F.slice(own, i, F.lit(size)), " ")))


def simhash(runs: Column) -> Column:
    """The bits that more than half of the runs' hashes have."""
    hashes = F.transform(runs, lambda s: F.xxhash64(s))
    bit = lambda h, b: F.call_function("shiftrightunsigned", h, b).bitwiseAND(F.lit(1).cast("long"))

    def vote(acc: Column, b: Column) -> Column:
        ones = F.aggregate(hashes, F.lit(0).cast("long"), lambda n, h: n + bit(h, b))
        return F.when(ones * 2 > F.size(hashes), acc.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), b))).otherwise(acc)

    return F.aggregate(F.sequence(F.lit(0), F.lit(63)), F.lit(0).cast("long"), vote)


def blocks(fingerprint: Column, radius: int) -> Column:
    """(block, value) of the radius + 1 blocks."""
    bounds = [64 * i // (radius + 1) for i in range(radius + 2)]
    cut = [F.struct(F.lit(i).alias("block"), F.shiftrightunsigned(fingerprint, a).bitwiseAND(F.lit((1 << (b - a)) - 1).cast("long")).alias("value")) for i, (a, b) in enumerate(zip(bounds, bounds[1:]))]
    return F.explode(F.array(*cut))


def weighted_similarity(one: Column, two: Column) -> Column:
    """Lesser over greater weights of two arrays of shingles."""
    times = lambda runs, s: F.size(F.filter(runs, lambda x: x == s))
    both = F.transform(F.array_union(one, two), lambda s: F.struct(F.length(s).alias("w"), times(one, s).alias("a"), times(two, s).alias("b")))
    start = F.struct(F.lit(0).cast("long").alias("less"), F.lit(0).cast("long").alias("more"))
    step = lambda acc, x: F.struct((acc["less"] + x["w"] * F.least(x["a"], x["b"])).alias("less"), (acc["more"] + x["w"] * F.greatest(x["a"], x["b"])).alias("more"))
    return F.aggregate(both, start, step, lambda acc: acc["less"] / acc["more"])


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
    shingle: int = 5,
    radius: int = 15,
    similarity: float = 0.8,
    drift: int = 4,
    broadcast_rows: int = 1_000_000,
) -> DataFrame:
    """Matches: doc_id, doc_key (hash of id and text), item_id, start (the window's first word, from 0), n_words,
    hamming and similarity; one row for each document, item and window."""
    items = benchmark.select(F.col(item_col).alias("item_id"), words(whole_text(item_text)).alias("w")).where(F.size("w") > 0)
    items = items.select("item_id", F.size("w").alias("n"), shingles(F.col("w"), shingle).alias("runs"))
    items = checkpointed(items.withColumn("fp", simhash(F.col("runs"))).withColumn("item", F.monotonically_increasing_id()))
    starts = items.select("n", F.posexplode("runs").alias("off", "run")).select(F.xxhash64("run").alias("h"), "n", "off").distinct()
    small = starts.count() <= broadcast_rows

    own = docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("t"))
    own = own.select("doc_id", F.xxhash64("doc_id", "t").alias("doc_key"), words(F.col("t")).alias("w")).where(F.size("w") > 0)
    sizes = [r.k for r in items.select(F.least("n", F.lit(shingle)).alias("k")).distinct().collect()]  # at most ``shingle`` rows
    # one pass for all sizes of shingles: a run of so many words equals none of another number
    placed = lambda k: F.transform(shingles(F.col("w"), k), lambda s, i: F.struct(i.alias("pos"), F.xxhash64(s).alias("h")))
    runs = F.explode(F.flatten(F.array(*[placed(k) for k in sorted(sizes)])) if sizes else placed(shingle)).alias("x")
    if small:
        hits = own.select("doc_id", "doc_key", "w", runs).select("doc_id", "doc_key", "w", "x.pos", "x.h").join(F.broadcast(starts), "h")
    else:  # only keys and places are shuffled by shingle; the words come back to the few hits
        at = own.select("doc_key", runs).select("doc_key", "x.pos", "x.h").join(starts, "h")
        hits = at.select("doc_key", "pos", "off", "n").distinct().join(own, "doc_key")
    start = F.greatest(F.lit(0), F.least(F.col("pos") - F.col("off"), F.size("w") - F.col("n")))
    hits = hits.select("doc_id", "doc_key", "n", F.greatest(F.lit(0), start - drift).alias("at"), (start + F.col("n") + drift).alias("to"), "w")
    found = hits.select("doc_id", "doc_key", "n", "at", F.slice("w", F.col("at") + 1, F.col("to") - F.col("at")).alias("part"))
    # a part stands once for each of its shared shingles; its words follow from (doc_key, at, n)
    found = found.groupBy("doc_key", "at", "n").agg(F.first("doc_id").alias("doc_id"), F.first("part").alias("part"))
    found = found.select("*", F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.size("part") - F.col("n")))).alias("by"))
    found = found.select("doc_id", "doc_key", (F.col("at") + F.col("by")).alias("start"), "n", shingles(F.slice("part", F.col("by") + 1, F.col("n")), shingle).alias("runs"))
    found = found.withColumn("key", F.xxhash64("n", "runs")).groupBy("doc_key", "start", "n").agg(*[F.first(c).alias(c) for c in ("doc_id", "key", "runs")])
    found = checkpointed(found)

    windows = checkpointed(found.groupBy("key", "n").agg(F.first("runs").alias("runs")).withColumn("fp", simhash(F.col("runs"))))
    indexed = items.select("item", "n", F.col("fp").alias("item_fp"), blocks(F.col("fp"), radius).alias("b"))
    # the index is joined by keys and fingerprints alone; shingles come to the pairs within the radius
    near = windows.select("key", "n", "fp", blocks(F.col("fp"), radius).alias("b")).join(indexed, ["n", "b"])
    near = near.select("key", "n", "item", F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))).alias("hamming")).where(F.col("hamming") <= radius).distinct()
    near = near.join(windows.select("key", "n", "runs"), ["key", "n"]).join(items.select("item", "item_id", F.col("runs").alias("item_runs")), "item")
    matched = near.withColumn("similarity", weighted_similarity(F.col("runs"), F.col("item_runs"))).where(F.col("similarity") >= similarity)
    matched = matched.groupBy("key", "n", "item_id").agg(F.min("hamming").alias("hamming"), F.max("similarity").alias("similarity"))
    return found.select("doc_id", "doc_key", "key", "start", "n").join(matched, ["key", "n"]).select("doc_id", "doc_key", "item_id", "start", F.col("n").alias("n_words"), "hamming", "similarity")


def without_contaminated(docs: DataFrame, matches: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without those that have a match."""
    key = F.xxhash64(F.col(id_col), whole_text(text_col))
    return docs.withColumn("__key", key).join(matches.select(F.col("doc_key").alias("__key")).distinct(), "__key", "left_anti").select(*docs.columns)
