"""Quality classifier: an interpolated modified Kneser-Ney model of characters, for each language.

Training: trusted texts are counted into character n-grams of the highest order (the start of a
text is padded; characters beyond 16 bits share one code; digits are one character). Tasks count
their own documents first, and the counts are summed by language and n-gram. Lower orders
count the distinct left neighbours of their n-grams. Each order has three discounts for each
language, from its counts of counts. Probabilities and back-off weights are joins, sharded by
language and n-gram: counts with the totals of their contexts and the next lower order.

Scoring: the sum of log-probabilities over a text's characters; perplexity is per character.
The tables hold a row for each n-gram seen. If they have ``mapped_rows`` rows or fewer (counted
first, 16 bytes each, so 32 MB by default) they are broadcast, and documents are scored where they lie; beyond it the distinct n-grams of the
documents are joined with the tables and summed by document. Both ways give the same sums. Trusted
texts are found by their ids where they lie, too, as long as there are no more than ``broadcast_ids`` of them.

Thresholds: the ``quantile`` of log-perplexity over all trusted documents, each scored without its own half of them, by
language and length (a class for each power of two of characters; the language's own where a class has
fewer than ``least`` trusted documents): a text above it is rejected.

Nulls: a null text is empty. An empty text has no perplexity and is rejected. A text whose
language (null counts as one) has no trusted text has no perplexity and is kept. Null ids are
never trusted. Repeated rows count as often as they stand.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftlane.llm.common import checkpointed, memory_returned, row_sums, slices, whole_text

#: Bytes of text that are scored at once; a dozen arrays of eight bytes a character are made of them.
SLICE_BYTES = 1 << 19
BITS = 16
ORDER = 4
#: Rows of the tables for each task that works on them: they are small beside the texts, and a shuffle writes files for each task.
TASK_ROWS = 200_000


def language(column: str = "lang"):
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def grams_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """N-grams of the highest order (a character in each BITS bits) of all rows back to back, and rows' bounds."""
    sizes = np.asarray(pc.utf8_length(texts), dtype=np.int64)
    chars = np.frombuffer("".join(texts.to_pylist()).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    ends = np.cumsum(sizes)
    codes = np.zeros(int(sizes.sum()) + len(sizes) * (ORDER - 1), dtype=np.uint64)
    at = np.arange(len(chars)) + np.repeat(np.arange(1, len(sizes) + 1), sizes) * (ORDER - 1)
    kept = np.minimum(chars, 0xFFFF)
    codes[at] = np.where((kept >= 48) & (kept <= 57), 48, kept)
    grams = codes[at]
    for back in range(1, ORDER):
        grams |= codes[at - back] << np.uint64(BITS * back)
    return grams, np.r_[0, ends]


def by_language(rows: pa.RecordBatch) -> Iterator[tuple[str, np.ndarray, pa.Array]]:
    """(language, row numbers, texts) of each language in a batch."""
    langs = rows["__lang"].dictionary_encode()
    index = np.asarray(langs.indices)
    for i, lang in enumerate(langs.dictionary.to_pylist()):
        own = np.flatnonzero(index == i)
        yield lang, own, rows["__text"].take(pa.array(own))


def gram_counts(trusted: DataFrame, *, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, gram, n) over all trusted texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, pd.Series] = {}
        for batch in batches:
            for rows in slices(batch, "__text", SLICE_BYTES):
                for lang, _, texts in by_language(rows):
                    codes, seen = pd.factorize(grams_of(texts)[0])
                    n = pd.Series(np.bincount(codes, minlength=len(seen)), index=seen)
                    held[lang] = held[lang].add(n, fill_value=0) if lang in held else n
                if sum(map(len, held.values())) > 1_000_000:
                    yield from sent(held)
                    held = {}
            batch = rows = texts = None  # let go before the next is read
            memory_returned()
        yield from sent(held)

    def sent(held: dict[str, pd.Series]) -> Iterator[pa.RecordBatch]:
        for lang, n in held.items():
            grams = n.index.to_numpy(dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(n), pa.string()), pa.array(grams), pa.array(n.to_numpy(dtype=np.int64))], names=["lang", "gram", "n"])

    work = trusted.select(language(lang_col).alias("__lang"), whole_text(text_col).alias("__text"))
    return work.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def discounts(order: DataFrame) -> DataFrame:
    """(lang, d1, d2, d3) of an order's counts; where counts of counts are missing, 0.5, 1 and 1.5."""
    of = [F.sum(F.when(F.col("n") == k, 1).otherwise(0)).alias(f"n{k}") for k in (1, 2, 3, 4)]
    y = F.expr("n1 / (n1 + 2 * n2)")
    counted = order.groupBy("lang").agg(*of)
    some = (F.col("n1") > 0) & (F.col("n2") > 0) & (F.col("n3") > 0) & (F.col("n4") > 0)
    form = lambda k: F.when(some, F.greatest(F.lit(0.05), F.least(F.lit(k - 0.05), k - (k + 1) * y * F.try_divide(f"n{k + 1}", F.col(f"n{k}"))))).otherwise(k / 2)
    return counted.select("lang", *[form(k).alias(f"d{k}") for k in (1, 2, 3)])


@dataclass
class Tables:
    """Of each order: (lang, gram, logp) and (lang, context, logw), the back-off weight; and (lang, logp) of an unseen character."""

    grams: dict[int, DataFrame] = field(default_factory=dict)
    contexts: dict[int, DataFrame] = field(default_factory=dict)
    unseen: DataFrame | None = None

    def rows(self) -> int:
        return sum(t.count() for t in (*self.grams.values(), *self.contexts.values()))


def tables(counts: DataFrame) -> Tables:
    """Probabilities and back-off weights of all orders, from the counts of the highest."""
    counts = checkpointed(counts)
    parts = max(1, counts.count() // TASK_ROWS)
    few = lambda df: df.coalesce(parts)
    counts = few(counts)
    by_order = {ORDER: counts}
    for k in range(ORDER - 1, 0, -1):
        suffix = F.col("gram").bitwiseAND(F.lit((1 << BITS * k) - 1))
        by_order[k] = few(checkpointed(few(by_order[k + 1].groupBy("lang", suffix.alias("gram")).agg(F.count("*").alias("n")))))
    out = Tables()
    for k in range(1, ORDER + 1):
        own = few(by_order[k].join(discounts(by_order[k]), "lang"))
        own = own.withColumn("d", F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3")))
        own = own.withColumn("context", F.shiftrightunsigned("gram", BITS))
        around = few(own.groupBy("lang", "context").agg(F.sum("n").alias("total"), (F.sum("d") / F.sum("n")).alias("w"), F.count("*").alias("types")))
        own = few(own.join(around, ["lang", "context"]))
        if k == 1:
            lower = F.col("w") / (F.col("types") + 1)
            out.unseen = checkpointed(around.select("lang", F.log(F.col("w") / (F.col("types") + 1)).alias("logp")))
        else:
            below = out.grams[k - 1].select("lang", F.col("gram").alias("suffix"), F.exp("logp").alias("below"))
            own = own.withColumn("suffix", F.col("gram").bitwiseAND(F.lit((1 << BITS * (k - 1)) - 1)))
            own = few(own.join(below, ["lang", "suffix"]))
            lower = F.col("w") * F.col("below")
        out.grams[k] = checkpointed(own.select("lang", "gram", F.log((F.col("n") - F.col("d")) / F.col("total") + lower).alias("logp")))
        out.contexts[k] = checkpointed(around.select("lang", "context", F.log("w").alias("logw")))
    return out


def lookup(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, missing: float) -> np.ndarray:
    """values where keys (sorted) has wanted, else missing."""
    if not len(keys):
        return np.full(len(wanted), missing)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], missing)


KINDS = (("grams", "gram", "logp"), ("contexts", "context", "logw"))


def sorted_tables(made: Tables) -> dict:
    """The tables as sorted arrays by language, kind and order; for tables of bounded size."""
    out: dict = {r.lang: {"unseen": r.logp, "grams": {}, "contexts": {}} for r in made.unseen.collect()}
    for kind, key, value in KINDS:
        for k, t in getattr(made, kind).items():
            rows = t.select("lang", key, value).toArrow()
            langs = rows["lang"].combine_chunks().dictionary_encode() if rows.num_rows else None
            for i, lang in enumerate(langs.dictionary.to_pylist() if langs else []):
                own = rows.filter(pc.equal(langs.indices, i))
                keys = np.asarray(own[key]).view(np.uint64)
                order = np.argsort(keys)
                out[lang][kind][k] = keys[order], np.asarray(own[value])[order]
    return out


def log_probabilities(own: dict, grams: np.ndarray) -> np.ndarray:
    """Of distinct n-grams, by a language's arrays."""
    logp = np.full(len(grams), own["unseen"])
    for k in range(1, ORDER + 1):
        part = grams & np.uint64((1 << BITS * k) - 1)
        backed = logp + (lookup(*own["contexts"][k], part >> np.uint64(BITS), 0.0) if k > 1 else 0.0)
        found = lookup(*own["grams"][k], part, np.nan)
        logp = np.where(np.isnan(found), backed, found)
    return logp


@dataclass
class Model:
    """A fitted model: its tables, and their sorted arrays as a broadcast if they are small."""

    tables: Tables
    arrays: Broadcast | None = None


def fit(trusted: DataFrame, *, text_col: str = "text", lang_col: str = "lang", mapped_rows: int = 2_000_000) -> Model:
    """The model of all trusted texts."""
    return of_counts(gram_counts(trusted, text_col=text_col, lang_col=lang_col), mapped_rows)


def of_counts(counts: DataFrame, mapped_rows: int) -> Model:
    """The model of counted n-grams."""
    made = tables(counts)
    return Model(made, counts.sparkSession.sparkContext.broadcast(sorted_tables(made)) if made.rows() <= mapped_rows else None)


SCORED = ("n_chars_scored", "log_prob")


def score(docs: DataFrame, model: Model, *, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """docs with n_chars_scored and log_prob (null where the language has no model)."""
    kept = [c for c in docs.columns if c not in SCORED]
    work = docs.select(*kept, language(lang_col).alias("__lang"), whole_text(text_col).alias("__text"))
    if model.arrays is None:
        return score_by_join(work, model, kept)
    arrays = model.arrays
    schema = docs.select(*kept).schema.add("n_chars_scored", "long").add("log_prob", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = arrays.value
            for rows in slices(batch, "__text", SLICE_BYTES):
                n, logp = np.zeros(rows.num_rows, dtype=np.int64), np.full(rows.num_rows, np.nan)
                for lang, at, texts in by_language(rows):
                    grams, bounds = grams_of(texts)
                    n[at] = np.diff(bounds)
                    if lang in own:
                        codes, seen = pd.factorize(grams)
                        logp[at] = row_sums(log_probabilities(own[lang], seen)[codes], bounds)
                yield pa.RecordBatch.from_arrays([*(rows[c] for c in kept), pa.array(n), pa.array(logp, from_pandas=True)], names=schema.fieldNames())
            batch = rows = texts = None  # let go before the next is read
            memory_returned()

    return work.mapInArrow(run, schema)


def score_by_join(work: DataFrame, model: Model, kept: list[str]) -> DataFrame:
    """The same sums with the tables left where they are: equal texts are scored once."""
    keyed = work.withColumn("__key", F.xxhash64("__lang", "__text"))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, "__text", SLICE_BYTES):
                grams, bounds = grams_of(rows["__text"])
                frame = pd.DataFrame({"row": np.repeat(np.arange(rows.num_rows), np.diff(bounds)), "gram": grams.view(np.int64)})
                n = frame.groupby(["row", "gram"], sort=False).size()
                row = pa.array(n.index.get_level_values(0).to_numpy())
                yield pa.RecordBatch.from_arrays([rows["__key"].take(row), rows["__lang"].take(row), pa.array(n.index.get_level_values(1).to_numpy()), pa.array(n.to_numpy())], names=["key", "lang", "gram", "n"])

    texts = keyed.groupBy("__key").agg(F.first("__lang").alias("__lang"), F.first("__text").alias("__text"))
    own = texts.mapInArrow(split, "key long, lang string, gram long, n long")
    logs = own.select("lang", "gram").distinct().join(model.tables.unseen.withColumnRenamed("logp", "__p"), "lang")
    for k in range(1, ORDER + 1):
        part = F.col("gram").bitwiseAND(F.lit((1 << BITS * k) - 1 if k < ORDER else -1))
        logs = logs.withColumn("__g", part).withColumn("__c", F.shiftrightunsigned("__g", BITS))
        logs = logs.join(model.tables.grams[k].select("lang", F.col("gram").alias("__g"), "logp"), ["lang", "__g"], "left")
        if k > 1:
            logs = logs.join(model.tables.contexts[k].withColumnRenamed("context", "__c"), ["lang", "__c"], "left")
        backed = F.col("__p") + (F.coalesce("logw", F.lit(0.0)) if k > 1 else F.lit(0.0))
        logs = logs.select("lang", "gram", F.coalesce("logp", backed).alias("__p"))
    sums = own.join(logs, ["lang", "gram"]).groupBy("key").agg(F.sum(F.col("n") * F.col("__p")).alias("log_prob"))
    known = keyed.join(sums.withColumnRenamed("key", "__key"), "__key", "left").join(model.tables.unseen.select(F.col("lang").alias("__lang"), F.lit(0.0).alias("__none")), "__lang", "left")
    return known.select(*kept, F.length("__text").cast("long").alias("n_chars_scored"), F.coalesce("log_prob", F.when(F.length("__text") == 0, F.col("__none"))).alias("log_prob"))


def length_class(n):
    return F.floor(F.log2(F.greatest(n, F.lit(1)))).cast("int")


def thresholds(trusted_scores: DataFrame, *, quantile: float = 0.995, least: int = 400, lang_col: str = "lang") -> DataFrame:
    """(lang, class, limit) of log-perplexity, and with a null class the language's own.

    Log-perplexities are rounded up to thousandths, so a group holds a bounded number of values.
    """
    own = trusted_scores.where("n_chars_scored > 0 and log_prob is not null")
    own = own.select(language(lang_col).alias("lang"), length_class(F.col("n_chars_scored")).alias("class"), (F.ceil(-F.col("log_prob") / F.col("n_chars_scored") * 1000) / 1000).alias("x"))
    of = [F.percentile("x", F.lit(quantile)).alias("limit"), F.count("*").alias("n")]
    classes = own.groupBy("lang", "class").agg(*of).where(F.col("n") >= least)
    whole = own.groupBy("lang").agg(*of).withColumn("class", F.lit(None).cast("int"))
    return classes.select("lang", "class", "limit").unionByName(whole.select("lang", "class", "limit"))


@dataclass
class Classifier:
    """A model and its thresholds."""

    model: Model
    limits: DataFrame

    def judge(self, docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", limit_rows: int = 100_000) -> DataFrame:
        """docs with perplexity (per character), limit and keep; the thresholds are broadcast up to limit_rows rows."""
        kept = [c for c in docs.columns if c not in ("perplexity", "limit", "keep", *SCORED)]
        scored = score(docs.select(*kept), self.model, text_col=text_col, lang_col=lang_col)
        scored = scored.withColumn("__lang", language(lang_col)).withColumn("__class", length_class(F.col("n_chars_scored")))
        whole = self.limits.where("class is null").select(F.col("lang").alias("__lang"), F.col("limit").alias("__whole"))
        own = self.limits.where("class is not null").select(F.col("lang").alias("__lang"), F.col("class").alias("__class"), F.col("limit").alias("__own"))
        if self.limits.count() <= limit_rows:
            whole, own = F.broadcast(whole), F.broadcast(own)
        scored = scored.join(whole, "__lang", "left").join(own, ["__lang", "__class"], "left")
        x = -F.col("log_prob") / F.when(F.col("n_chars_scored") > 0, F.col("n_chars_scored"))
        limit = F.coalesce("__own", "__whole")
        keep = (F.col("n_chars_scored") > 0) & F.coalesce(x <= limit, F.lit(True))
        return scored.select(*kept, F.exp(x).alias("perplexity"), F.exp(limit).alias("limit"), keep.alias("keep"))


def trusted_ids(labels: DataFrame, *, id_col: str = "doc_id") -> DataFrame:
    """Ids whose labels all say good and not toxic."""
    own = labels.where(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.min(F.coalesce("quality", F.lit(0))).alias("q"), F.max(F.coalesce("toxic", F.lit(1))).alias("t"))
    return own.where("q = 1 and t = 0").select(id_col)


HALF = "\x1f"


def in_half(lang, half):
    """A language's name with a half behind it."""
    return F.concat(lang, F.lit(HALF), half.cast("string"))


def train(
    docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", mapped_rows: int = 2_000_000, broadcast_ids: int = 2_000_000, **quantiles
) -> Classifier:
    """The classifier from all documents that the labels trust.

    The model counts all trusted texts. For the thresholds they are dealt into two halves by a hash
    of the text, and each is scored by the model of the other half, as a text is likelier under
    a model that has counted it. Of the trusted ids, 8 bytes each, up to broadcast_ids are broadcast, so that no text is
    shuffled; with more of them documents and ids are dealt by id.
    """
    own = docs.select(F.col(id_col).alias("doc_id"), language(lang_col).alias("lang"), F.col(text_col).alias("text"))
    half = F.pmod(F.xxhash64(whole_text("text")), F.lit(2))
    good = checkpointed(trusted_ids(labels.withColumnRenamed(id_col, "doc_id")))
    trusted = own.join(F.broadcast(good) if good.count() <= broadcast_ids else good.hint("merge"), "doc_id", "left_semi")
    halves = checkpointed(gram_counts(trusted.withColumn("lang", in_half(F.col("lang"), 1 - half))))
    name = F.expr(f"substring(lang, 1, length(lang) - {len(HALF) + 1})")
    whole = halves.groupBy(name.alias("lang"), "gram").agg(F.sum("n").alias("n"))
    model = of_counts(halves.unionByName(whole), mapped_rows)
    scored = score(trusted.withColumn("lang", in_half(F.col("lang"), half)), model).select("doc_id", name.alias("lang"), *SCORED)
    return Classifier(model, checkpointed(thresholds(scored, **quantiles)))
