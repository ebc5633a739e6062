"""Secret scans: three rules, and character Markov models for what the rules don't know.

Rules (kind, in this order): ``assign``, a name such as password or api_key with a value of 12
or more characters behind it; ``access``, AKIA and capitals or digits, 18 or more together;
``hex``, 16 or more lower-case hex digits. Matches are leftmost and don't overlap within a kind.

``markov``: tokens of 16 or more letters, digits and ``+/_=-`` are scored by two first-order
character models, one of random strings and one of ordinary identifiers. A token is a secret if
the log-likelihood ratio (thousandths of a nat, summed over its characters) reaches the
threshold and no rule's span overlaps it. The threshold is set on strings that no training saw: at 30,000 all but a few in a
thousand random strings of 24 characters and more are caught, and one in a hundred identifiers is at most. Both models are counted from labelled samples, in one
aggregation of at most two times 68 squared rows; a state's transitions are smoothed by those
of all states together, counted as PRIOR more.

Spans are in code points, the end exclusive. All of it is built-in functions. A text is cut into segments at characters that no
match has: white space and marks, but for spaces beside a colon or an equals sign. Matches lie in segments, a few words at most, and their places in the text come from running sums of the
segments' lengths, so the work grows with the text and not with the square of its matches.

Nulls: a null or empty text has no spans. Repeated rows get equal spans. Without samples of a
class its model is uniform.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftlane.functions.text import let, places, running_sums
from siftlane.llm.common import whole_text

#: The kinds in order, and the patterns of the three rules.
KINDS = ("assign", "access", "hex", "markov")
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
ASSIGN_LEAST = 12
TOKEN = r"[A-Za-z0-9+/_=-]{16,}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
SPAN = "array<struct<start:int,rank:int,end:int>>"
STATES = len(ALPHABET) + 1
PRIOR = 8.0


#: A segment: what matches may have, with the spaces beside : and =, and then the characters up to the next.
INNER = r"""[A-Za-z0-9+/_.=:"'-]"""
SEGMENT = rf"""(?:{INNER}++|\x20++(?=[:=])|(?<=[:=])\x20++)++(?:[^A-Za-z0-9+/_.=:"'\x20-]++|\x20++)?+|[^A-Za-z0-9+/_.=:"'\x20-]++|\x20++"""
#: The least characters of a match, but for the name of an assignment.
LEAST = 12


def segments(text: Column) -> Column:
    """The segments of a text, which is what they are laid end to end."""
    return F.regexp_extract_all(text, F.lit(SEGMENT), F.lit(0))


def base_matches(text: Column) -> dict[str, Column]:
    """Matches of the three rules."""
    assign = F.filter(places(text, ASSIGN, 2), lambda x: F.length(x["value"]) >= ASSIGN_LEAST)
    return {"assign": assign, "access": places(text, ACCESS), "hex": places(text, HEX)}


def ranked(kind: str, matches: Column) -> Column:
    rank = F.lit(KINDS.index(kind))
    return F.transform(matches, lambda x: F.struct(x["start"].alias("start"), rank.alias("rank"), x["end"].alias("end")))


@dataclass(frozen=True)
class MarkovModel:
    """ratios: thousandths of a nat by which a random string is likelier to go from one state to
    another (0 is the start, then ALPHABET), row by row."""

    ratios: tuple[int, ...]
    threshold: int = 30_000

    def ratio(self, token: Column) -> Column:
        """The log-likelihood ratio of a token."""
        table = F.split(F.lit(",".join(map(str, self.ratios))), ",").cast("array<int>")
        states = F.transform(F.filter(F.split(token, ""), lambda c: c != ""), lambda c: F.instr(F.lit(ALPHABET), c))
        pairs = F.zip_with(F.concat(F.array(F.lit(0)), states), states, lambda a, b: F.get(table, a * STATES + b))
        return F.aggregate(F.filter(pairs, lambda x: x.isNotNull()), F.lit(0), lambda acc, x: acc + x)


def train(samples: DataFrame, threshold: int = 30_000) -> MarkovModel:
    """The model of labelled samples: token string, random boolean, times long."""
    states = F.transform(F.filter(F.split("token", ""), lambda c: c != ""), lambda c: F.instr(F.lit(ALPHABET), c))
    pairs = F.zip_with(F.concat(F.array(F.lit(0)), F.col("states")), F.col("states"), lambda a, b: a * STATES + b)
    counted = (
        samples.where("token is not null and random is not null")
        .select("random", "times", states.alias("states"))
        .select("random", "times", F.explode(F.filter(pairs, lambda x: x.isNotNull())).alias("pair"))
        .groupBy("random", "pair")
        .agg(F.sum("times").alias("n"))
    )
    counts = {True: [0] * STATES**2, False: [0] * STATES**2}
    for r in counted.collect():  # two times STATES squared rows at most
        counts[r.random][r.pair] += r.n
    logs = {}
    for label, n in counts.items():
        into = [sum(n[b::STATES]) + 0.5 for b in range(STATES)]
        share = [x / sum(into) for x in into]
        logs[label] = [math.log((n[a * STATES + b] + PRIOR * share[b]) / (sum(n[a * STATES : (a + 1) * STATES]) + PRIOR)) for a in range(STATES) for b in range(STATES)]
    ratios = [round(1000 * (x - y)) for x, y in zip(logs[True], logs[False])]
    return MarkovModel(tuple(ratios), threshold)


def made_samples(docs: DataFrame, rows: int) -> DataFrame:
    """Strings that are random by construction: hex, base 64, capitals with digits, letters with digits."""
    h = F.sha2(F.concat(F.lit("sample"), F.col("id").cast("string")), 256)
    g = F.sha2(F.concat(F.lit("other"), F.col("id").cast("string")), 256)
    b64 = F.base64(F.unhex(h))
    forms = F.array(F.substring(h, 1, 40), b64, F.upper(F.conv(F.substring(g, 1, 15), 16, 36)), F.regexp_replace(F.base64(F.unhex(g)), "[+/=]", ""))
    made = docs.sparkSession.range(rows).select(F.explode(forms).alias("token"))
    return made.select("token", F.lit(True).alias("random"), F.lit(1).cast("long").alias("times"))


def labelled_samples(docs: DataFrame, *, text_col: str = "text", made: int = 2000) -> DataFrame:
    """Samples labelled by the rules over all documents: a rule's values are random strings, tokens that meet no rule and are of
    letters or of digits alone (marks aside) are identifiers and numbers; with ``made`` rows of strings random by
    construction. A token of letters and digits that no rule knows may be a secret of an unknown kind: it is no sample."""
    work = docs.select(F.explode(F.filter(segments(whole_text(text_col)), lambda s: F.length(s) >= LEAST)).alias("__s"))
    base = base_matches(F.col("__s"))
    values = F.concat(*[F.transform(m, lambda x: x["value"]) for m in base.values()])
    spans = F.concat(*[ranked(k, m) for k, m in base.items()])
    seen = work.select(values.alias("values"), spans.alias("spans"), places(F.col("__s"), TOKEN).alias("tokens"))
    mixed = lambda v: v.rlike("[0-9]") & v.rlike("[A-Za-z]")
    plain = F.filter("tokens", lambda t: ~mixed(t["value"]) & ~F.exists("spans", lambda s: (s["start"] < t["end"]) & (t["start"] < s["end"])))
    kinds = F.concat(
        F.transform("values", lambda v: F.struct(v.alias("token"), F.lit(True).alias("random"))),
        F.transform(plain, lambda t: F.struct(t["value"].alias("token"), F.lit(False).alias("random"))),
    )
    own = seen.select(F.explode(kinds).alias("s")).groupBy("s.token", "s.random").agg(F.count("*").alias("times"))
    return own.unionByName(made_samples(docs, made))


def segment_spans(segment: Column, model: MarkovModel) -> Column:
    """The secrets of a segment by their places in it."""
    base = F.concat(*[ranked(k, m) for k, m in base_matches(segment).items()])
    free = lambda t, spans: ~F.exists(spans, lambda s: (s["start"] < t["end"]) & (t["start"] < s["end"]))
    more = lambda spans: F.filter(places(segment, TOKEN), lambda t: free(t, spans) & (model.ratio(t["value"]) >= model.threshold))
    return F.when(F.length(segment) >= LEAST, let(base, lambda spans: F.array_sort(F.concat(spans, ranked("markov", more(spans)))))).otherwise(F.from_json(F.lit("[]"), SPAN))


def scanned(docs: DataFrame, model: MarkovModel, text_col: str) -> DataFrame:
    """docs with __segments and their spans in __spans."""
    kept = [c for c in docs.columns if c not in ("__segments", "__spans")]
    cut = docs.select(*kept, segments(whole_text(text_col)).alias("__segments"))
    return cut.select(*kept, "__segments", F.transform("__segments", lambda s: segment_spans(s, model)).alias("__spans"))


def find_secrets(docs: DataFrame, model: MarkovModel, *, text_col: str = "text") -> DataFrame:
    """docs with secrets: array of (start, rank, end) by start, then rank, a kind's place in KINDS."""
    found = scanned(docs, model, text_col)
    kept = [c for c in docs.columns if c not in ("secrets", "__segments", "__spans")]
    before = running_sums(F.transform("__segments", F.length))
    moved = lambda spans, at: F.transform(spans, lambda s: F.struct((s["start"] + at).alias("start"), s["rank"].alias("rank"), (s["end"] + at).alias("end")))
    # places are summed up only where there is something to place
    placed = F.when(F.exists("__spans", lambda s: F.size(s) > 0), F.flatten(F.zip_with("__spans", before, moved))).otherwise(F.from_json(F.lit("[]"), SPAN))
    return found.select(*kept, placed.alias("secrets"))


def spans_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["rank"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, model: MarkovModel, *, text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """docs whose text has the mark in place of each secret; overlapping spans get one mark."""
    empty = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def cleaned(segment, spans):
        def step(acc, s):
            free = s["start"] >= acc["at"]
            more = F.concat(acc["out"], F.substring(segment, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark))
            return F.struct(F.greatest(s["end"], acc["at"]).alias("at"), F.when(free, more).otherwise(acc["out"]).alias("out"))

        rest = lambda acc: F.concat(acc["out"], F.substring(segment, acc["at"] + 1, F.length(segment)))
        return F.when(F.size(spans) == 0, segment).otherwise(F.aggregate(spans, empty, step, rest))

    found = scanned(docs, model, text_col)
    own = F.when(F.exists("__spans", lambda s: F.size(s) > 0), F.array_join(F.zip_with("__segments", "__spans", cleaned), "")).otherwise(F.col(text_col))
    return found.select(*[own.alias(c) if c == text_col else F.col(c) for c in docs.columns])
