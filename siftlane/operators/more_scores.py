"""Further classification models: role by majority, multilingual override, tiers, site checks, snippet evidence, outcomes."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftlane import dictionaries as D
from siftlane.functions.text import contains_any, first_word, hits, let, low, text_of
from siftlane.functions.web import host
from siftlane.operators.gates import col_or_empty, has_value
from siftlane.operators.rules import Rule, banded, first_reason
from siftlane.operators.scores import joined

#: Patterns and words of the models.
ROLE_PATTERNS = {
    "CUSTOMER": r"(?iu)(?<![\p{L}\p{N}_])(mill|mills|dye\s?house|finishing plant|textile factory|fabric producer)(?![\p{L}\p{N}_])",
    "INTERMEDIARY": r"(?iu)(?<![\p{L}\p{N}_])(machinery|spare parts|distributor|dealer|trading)(?![\p{L}\p{N}_])",
    "BRAND": r"(?iu)(?<![\p{L}\p{N}_])(fashion|boutique|apparel brand)(?![\p{L}\p{N}_])",
}
LOOSE_SUFFIX = r"\b(gmbh|ltd|llc|inc|corp|sa|ag|kg|srl|spa|as|ltda|limited|company)\b"
SITE_STRONG, SITE_WEAK = D.V10_FINISHING, D.INDUSTRY_TERMS
PARKED = ("domain for sale", "buy this domain", "parked", "coming soon", "under construction")
STATUSES = ("new", "contacted", "quoted", "won", "lost")
LOSS_REASONS = ("price", "no_need", "competitor", "no_response", "other")


def gate_v1(leads: DataFrame) -> DataFrame:
    """The simple entity gate: grade by suffix, words, source and website; eight ordered rejections."""
    company = F.trim(text_of("company"))
    lower, words = F.lower(company), F.size(F.filter(F.split(company, r"\s+"), lambda w: w != ""))
    rules: list[Rule] = [
        (F.length(company) < 2, "too_short"),
        (F.length(company) > 100, "too_long"),
        (lower.isin(*D.GATE_GENERIC), "generic"),
        (lower.isin(*D.GATE_MENU), "menu"),
        (company.rlike(r"(?i)^(https?://|www\.)"), "url"),
        (company.contains("@"), "email"),
        (company.rlike(r"^\d+$"), "number"),
        (first_word(low(col_or_empty(leads, "source_url")), D.GATE_DOMAINS).isNotNull(), "domain"),
    ]
    score = F.when(lower.rlike(LOOSE_SUFFIX), 2).otherwise(0) + F.when(words >= 2, 1).when(F.length(company) < 4, -1).otherwise(0)
    score = score + F.when(low("source_type").isin(*D.GATE_HIGH_SOURCES), 2).otherwise(0) + has_value("website").cast("int")
    out = leads.withColumn("v1_reason", first_reason(rules)).withColumn("v1_score", score)
    return out.withColumn("v1_grade", F.when(F.col("v1_reason").isNotNull(), "REJECT").otherwise(banded(F.col("v1_score"), [(3, "A"), (1, "B")], "C")))


def role_by_majority(leads: DataFrame) -> DataFrame:
    """majority_role: three points for a pattern, one for each word, one for a source's hint; the most points, two at least."""
    work, t, source = leads.withColumn("__t", joined(text_of("company"), text_of("context"))), F.col("__t"), low("source_type")
    words = {"CUSTOMER": D.ENTITY_END_USER, "INTERMEDIARY": D.ENTITY_INTERMEDIARY, "BRAND": D.ENTITY_BRAND}
    hint = {"CUSTOMER": source.isin(*D.QUALIFY_SOURCES, "gots", "oekotex"), "INTERMEDIARY": source == "comtrade", "BRAND": F.lit(False)}
    votes = [F.struct((F.when(t.rlike(p), 3).otherwise(0) + hits(t, words[k]) + hint[k].cast("int")).alias("n"), F.lit(-i).alias("i"), F.lit(k).alias("role")) for i, (k, p) in enumerate(ROLE_PATTERNS.items())]
    out = work.withColumn("__best", F.array_max(F.array(*votes))).drop("__t")
    return out.withColumn("majority_role", F.when(F.col("__best.n") >= 2, F.col("__best.role")).otherwise("UNKNOWN")).withColumn("majority_points", F.col("__best.n")).drop("__best")


def role_override(leads: DataFrame, words: dict[str, Iterable[str]] | None = None) -> DataFrame:
    """role, set anew where a strong word of another role stands in the text; brands come first, then intermediaries, then customers."""
    words = words or {"BRAND": D.ROLE_BRAND, "INTERMEDIARY": D.ROLE_STRONG_INTERMEDIARY, "CUSTOMER": D.ROLE_STRONG_CUSTOMER}
    t = joined(text_of("company"), text_of("context"))
    new = let(t, lambda t: F.coalesce(*[F.when(contains_any(t, w), k) for k, w in words.items()]))
    return leads.withColumn("role", F.coalesce(new, "role"))


def additive_tier(leads: DataFrame) -> DataFrame:
    """v4_score and v4_tier 1 to 5: points for role, grade, website, e-mails and brand words."""
    t = joined(text_of("company"), text_of("context"))
    score = F.when(F.col("role") == "CUSTOMER", 30).when(F.col("role") == "UNKNOWN", 10).otherwise(0)
    score = score + F.when(F.col("entity_grade") == "A", 30).when(F.col("entity_grade") == "B", 20).when(F.col("entity_grade") == "C", 10).otherwise(0)
    score = score + has_value("website").cast("int") * 15 + (F.size("emails") > 0).cast("int") * 15 + F.when(let(t, lambda t: contains_any(t, D.V10_TIER1)), 10).otherwise(0)
    out = leads.withColumn("v4_score", score)
    return out.withColumn("v4_tier", banded(F.col("v4_score"), [(80, 1), (60, 2), (40, 3), (20, 4)], 5))


def potential(leads: DataFrame) -> DataFrame:
    """potential: high, medium or low by how many process, machine and product words a text holds."""
    t = joined(text_of("company"), text_of("context"))
    n = let(t, lambda t: hits(t, D.QUALIFY_MACHINERY) * 2 + hits(t, D.QUALIFY_OPERATIONS) + hits(t, D.QUALIFY_PRODUCT_CATEGORIES))
    return leads.withColumn("potential_hits", n).withColumn("potential", banded(F.col("potential_hits"), [(4, "high"), (2, "medium")], "low"))


def weighted_detector(leads: DataFrame) -> DataFrame:
    """detector_score: hits of each signal times its weight; detector_confidence at 30, 15 and 8."""
    t = low("context")
    groups = {"finishing": D.SIGNAL_FINISHING, "stenter": D.SIGNAL_STENTER, "parts": D.SIGNAL_PARTS, "facility": D.SIGNAL_FACILITY}
    score = let(t, lambda t: sum((hits(t, w) * D.SIGNAL_WEIGHTS[k] for k, w in groups.items()), F.lit(0)))
    return leads.withColumn("detector_score", score).withColumn("detector_confidence", banded(F.col("detector_score"), [(30, "high"), (15, "medium"), (8, "low")], "none"))


def fetched_layers(pages: DataFrame, text: str = "content") -> DataFrame:
    """The evidence layers for fetched text: weights 0.3, 0.2 and 0.15, ready from 0.3 in the first or 0.4 in the second."""
    work, t = pages.withColumn("__t", low(text)), F.col("__t")
    e1, e2, e3 = (F.least(F.lit(1.0), hits(t, w) * x) for w, x in ((D.SCE_E1, 0.3), (D.SCE_E2, 0.2), (D.SCE_E3, 0.15)))
    out = work.withColumn("e1", e1).withColumn("e2", e2).withColumn("e3", e3)
    return out.withColumn("ready", ((F.col("e1") >= 0.3) | ((F.col("e2") >= 0.4) & (F.col("e3") >= 0.15))) & ~contains_any(t, D.V10_NEGATIVE)).drop("__t")


def snippet_score(leads: DataFrame, snippets: str = "snippets") -> DataFrame:
    """snippet_score (1 at most) of an array of snippets: brands, process words, and snippets that hold both."""
    work, t = leads.withColumn("__t", F.lower(F.array_join(snippets, "\n"))), F.col("__t")
    brands, words = hits(t, (*D.V10_TIER1, *D.V10_TIER2)), hits(t, D.SCE_E2)
    both = F.size(F.filter(F.transform(snippets, lambda s: F.lower(s)), lambda s: contains_any(s, (*D.V10_TIER1, *D.V10_TIER2)) & contains_any(s, D.SCE_E2)))
    work = work.withColumns({"__b": brands, "__w": words})
    brands, words = F.col("__b"), F.col("__w")
    score = F.when(brands > 0, 0.3 + F.least(brands, F.lit(3)) * 0.1).otherwise(0.0) + F.when(words > 0, 0.2 + F.least(words, F.lit(4)) * 0.05).otherwise(0.0)
    score = score + F.when((brands > 0) & (words > 0), 0.2).otherwise(0.0) + both * 0.1
    out = work.withColumn("snippet_score", F.least(F.lit(1.0), score)).drop("__t", "__b", "__w")
    return out.withColumn("snippet_ready", F.col("snippet_score") >= 0.5)


def first_evidence(results: DataFrame, key: str = "_ord") -> DataFrame:
    """(key, evidence_strength, evidence_word, url): of a lead's search results the first with a strong word, else the first with a medium one.

    results: key, rank, url, title, description. One aggregation, combined on the map side."""
    t = joined(text_of("title"), text_of("description"))
    results = results.withColumn("__strong", let(t, lambda t: first_word(t, D.SCE_E1))).withColumn("__medium", let(t, lambda t: first_word(t, D.SCE_E2)))
    strong, medium = F.col("__strong"), F.col("__medium")
    level = F.when(strong.isNotNull(), 0).when(medium.isNotNull(), 1).otherwise(2)
    own = results.select(key, level.alias("level"), "rank", F.coalesce(strong, medium).alias("word"), "url")
    best = own.groupBy(key).agg(F.min(F.struct("level", "rank", "word", "url")).alias("s"))
    name = F.element_at(F.array(F.lit("strong"), F.lit("medium"), F.lit("none")), F.col("s.level") + 1)
    return best.select(key, name.alias("evidence_strength"), F.col("s.word").alias("evidence_word"), F.when(F.col("s.level") < 2, F.col("s.url")).alias("url"))


def site_tier(leads: DataFrame, page: str = "page_text") -> DataFrame:
    """site_tier 1 (machines or brands and process words), 2 (process words), 3 (industry words) or null (parked, empty or none)."""
    work, t = leads.withColumn("__t", low(page)), F.col("__t")
    n, brand = hits(t, SITE_STRONG), contains_any(t, (*D.V10_TIER1, *D.V10_TIER2, "stenter", "ram makine"))
    tier = F.when((t == "") | contains_any(t, PARKED), F.lit(None)).when(brand & (n >= 1), 1).when(n >= 1, 2).when(contains_any(t, SITE_WEAK), 3)
    return work.withColumn("site_tier", tier).drop("__t")


def sales_ready(leads: DataFrame) -> DataFrame:
    """sales_ready: no intermediary or brand, no maker's name, and evidence: e1 of 0.4, or for customers e2 of 0.5 and e3 of 0.4."""
    ok = ~F.col("role").isin("INTERMEDIARY", "BRAND") & ~contains_any(low("company"), [x for x in D.GATE_OEM if len(x) > 4])
    return leads.withColumn("sales_ready", ok & ((F.col("e1") >= 0.4) | ((F.col("role") == "CUSTOMER") & (F.col("e2") >= 0.5) & (F.col("e3") >= 0.4))))


def at_least(leads: DataFrame, least: str, column: str = "sce_confidence") -> DataFrame:
    """Leads whose confidence is at least the given one of low, medium, high."""
    rank = lambda c: F.array_position(F.array(F.lit("low"), F.lit("medium"), F.lit("high")), c)
    return leads.where(rank(F.col(column)) >= rank(F.lit(least)))


def outcome(leads: DataFrame, updates: DataFrame, key: str = "_ord") -> DataFrame:
    """leads with status and loss_reason of their newest update; others than the listed ones change nothing."""
    own = updates.where(F.col("status").isin(*STATUSES))
    last = own.groupBy(key).agg(F.max_by(F.struct("status", "loss_reason"), "at").alias("__u"))
    out = leads.join(last, key, "left")
    reason = F.when((F.col("__u.status") == "lost") & F.col("__u.loss_reason").isin(*LOSS_REASONS), F.col("__u.loss_reason"))
    return out.withColumn("status", F.coalesce("__u.status", F.lit("new"))).withColumn("loss_reason", reason).drop("__u")


def country_potential(country: Column, table: dict[str, int], other: int = 20) -> Column:
    known = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    return F.coalesce(F.try_element_at(known, F.lower(F.trim(country))), F.lit(other))


def contact_confidence(leads: DataFrame, codes: dict[str, str]) -> DataFrame:
    """contact_confidence and notes: whether an e-mail's domain is the website's, and a telephone's code the country's.

    high: both agree; medium: one; low: none. codes: telephone code of each lower-case country."""
    site = F.regexp_replace(host("website"), r"^www\.", "")
    same = F.exists("emails", lambda e: (site != "") & F.endswith(F.lower(F.substring_index(e, "@", -1)), site))
    free = F.exists("emails", lambda e: F.substring_index(F.lower(e), "@", -1).isin("gmail.com", "yahoo.com", "hotmail.com", "outlook.com"))
    table = F.create_map(*[F.lit(x) for kv in codes.items() for x in kv])
    code = F.try_element_at(table, low("country"))
    dial = F.exists("phones", lambda p: code.isNotNull() & F.startswith(F.regexp_replace(p, r"[^0-9+]", ""), F.concat(F.lit("+"), code)))
    notes = F.array_compact(F.array(F.when(same, "email_on_site"), F.when(free, "free_provider"), F.when(dial, "phone_in_country")))
    n = same.cast("int") + dial.cast("int")
    return leads.withColumn("contact_confidence", F.when(n == 2, "high").when(n == 1, "medium").otherwise("low")).withColumn("contact_notes", notes)


def endpoint_policy(urls: DataFrame, robots: DataFrame, url: str = "url") -> DataFrame:
    """urls with safe and policy: blocked by pattern, disallowed for its host (robots: host, path), allowed by pattern, or unknown (unsafe).

    The longest rule that a path begins with decides for a host; hosts without rules keep their verdict."""
    path = F.coalesce(F.regexp_extract(F.col(url), r"^[a-z]+://[^/?#]*(/[^?#]*)", 1), F.lit("/"))
    work = urls.withColumn("__host", host(url)).withColumn("__path", path)
    rules = robots.groupBy("host").agg(F.collect_set("path").alias("__paths")).withColumnRenamed("host", "__host")
    work = work.join(rules, "__host", "left")
    banned = F.coalesce(F.exists("__paths", lambda p: F.startswith(F.col("__path"), p)), F.lit(False))
    t = F.lower(url)
    policy = F.when(t.rlike(r"(login|signin|admin|account|cart|checkout|password)"), "blocked").when(banned, "robots").when(t.rlike(r"(member|director|exhibitor|compan|list|about|contact|/en/)"), "allowed").otherwise("unknown")
    return work.withColumn("policy", policy).withColumn("safe", F.col("policy") == "allowed").drop("__host", "__path", "__paths")


def consolidated(leads: DataFrame, mail_columns: Iterable[str], phone_columns: Iterable[str]) -> DataFrame:
    """email, all_emails and phone: the first clean value of the columns in order, all addresses sorted and joined."""
    from siftlane.functions.text import clean_email, clean_phone, parse_list

    mails = F.flatten(F.array(*[parse_list(c) if t == "string" else F.coalesce(F.col(c), F.array().cast("array<string>")) for c, t in leads.dtypes if c in tuple(mail_columns)]))
    dials = F.flatten(F.array(*[parse_list(c) if t == "string" else F.coalesce(F.col(c), F.array().cast("array<string>")) for c, t in leads.dtypes if c in tuple(phone_columns)]))
    clean = F.array_compact(F.transform(mails, clean_email))
    return leads.withColumn("email", F.get(clean, F.lit(0))).withColumn("all_emails", F.array_join(F.array_sort(F.array_distinct(clean)), "; ")).withColumn("phone", F.get(F.array_compact(F.transform(dials, clean_phone)), F.lit(0)))


