"""Row-level scoring and classification models. Each adds its columns to a lead table."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftlane import dictionaries as D
from siftlane.functions.text import contains_any, fold_accents, language_votes, let, low, near, text_of
from siftlane.functions.words import Words, scanned, words_of_columns, words_of_texts
from siftlane.operators.gates import col_or_empty, has_value
from siftlane.operators.rules import banded
from siftlane.session import once

#: Word groups, patterns and tables of the models.
NEAR_MACHINES = ("stenter", "rama", "spannrahmen", "estiradora", "dyeing", "tintoreria", "boyahane")
NEAR_PARTS = ("spare", "part", "recambio", "repuesto", "peça", "parça", "chain", "clip", "pin", "kluppen")
FACILITY = ("mill", "plant", "factory", "fábrica", "usina", "tesis", "fabrika", "werk", "production")
PROFILE_LARGE, PROFILE_MEDIUM = ("500", "1000", "group", "holding", "large"), ("100", "200", "factory", "plant")
SIGNAL_EXPANSION = ("expansion", "genişleme", "new plant", "yeni tesis")
SIGNAL_MODERN = ("modernization", "retrofit", "yenileme")
SIGNAL_INVEST = ("investment", "yatırım")
CARE = ("maintenance", "bakım")
TRIGGER_FACILITY = (
    "yeni tesis", "yeni fabrika", "kapasite artışı", "genişleme", "modernizasyon", "yatırım", "new plant", "new facility", "capacity expansion",
    "expansion", "modernization", "investment", "upgrade", "retrofit", "nova fábrica", "expansão", "investimento", "nueva planta", "expansión", "inversión",
)
TRIGGER_FAIR = ("itma", "itm", "techtextil", "fimi", "index", "heimtextil", "intertextile", "texworld", "fuarı", "sergi")
TRIGGER_JOB = (
    "iş ilanı", "personel alımı", "teknik müdür", "bakım mühendisi", "makine operatörü", "job posting", "hiring", "vacancy", "engineer", "technician",
    "maintenance manager", "production manager",
)
TRIGGERS = {  # priority, bonus, action
    "large_import": ("high", 20, "auto_create_lead"),
    "new_facility": ("high", 15, "fast_profile"),
    "fair_participation": ("high", 10, "score_boost"),
    "job_posting": ("medium", 8, "add_to_nurture"),
    "association_update": ("medium", 5, "lead_update"),
    "website_change": ("medium", 5, "rescan_machine_park"),
}
HS_RULES = (  # words, primary, secondary, reason
    (("gleitstein", "gleitleiste", "kluppen gleitstein", "öffner segment", "kette", "nadelglied", "gleitstücke", "ram", "stenter", "tenter"), "845190", "", "Stenter machine component"),
    (("buchse", "buchsen", "torlonbuchse", "bushing", "plain bearing", "gleitlager"), "848330", "", "Plain shaft bearing/bushing"),
    (("spindel mutter", "spindelmutter", "ball screw", "roller screw", "spindle nut", "kugelgewindetrieb"), "848340", "848390", "Ball/roller screw assembly or part"),
)
HS_DEFAULT = ("845190", "", "default_stenter_parts")


def joined(*columns: Column) -> Column:
    """Lower-case text of several columns, with a space between."""
    return F.lower(F.concat_ws(" ", *columns))


def evidence_layers(leads: DataFrame) -> DataFrame:
    """Three layers of evidence: e1, e2, e3, sce_score, sce_ready, sce_confidence, and the first five words of each layer.

    Evidence that was looked for elsewhere counts if the lead has it (sce_has_evidence, sce_evidence_text, sce_evidence_type
    and, as it comes in, sce_confidence): two words more of the first layer if it is strong, one of the second if medium."""
    columns = ("company", "context", "website_content", "source_name", "sce_evidence_text", "sce_evidence_type")
    work = leads.withColumn("__m", words_of_columns(leads, columns, D.SCE_SUPPLIER, D.SCE_E1, D.SCE_E2, D.SCE_E3))
    m = Words(F.col("__m"))
    has = F.coalesce(F.col("sce_has_evidence").cast("boolean"), F.lit(False)) if "sce_has_evidence" in leads.columns else F.lit(False)
    strength = col_or_empty(leads, "sce_confidence")
    strong, medium = has & (strength == "strong"), has & (strength == "medium")
    cut = F.when(m.any(D.SCE_SUPPLIER), 0.3).otherwise(1.0)
    layer = lambda words, weight, more=F.lit(0): F.least(F.lit(1.0), (m.hits(words) + more) * weight) * F.col("__cut")
    out = work.withColumn("__cut", cut).withColumn("__e1", layer(D.SCE_E1, 0.4, F.when(strong, 2).otherwise(0)))
    out = out.withColumn("__e2", layer(D.SCE_E2, 0.25, F.when(medium, 1).otherwise(0))).withColumn("__e3", layer(D.SCE_E3, 0.2))
    e1, e2, e3 = F.col("__e1"), F.col("__e2"), F.col("__e3")
    out = out.withColumn("__total", F.greatest(e1, e2 * 0.6 + e3 * 0.4, e1 * 0.5 + e2 * 0.3 + e3 * 0.2))
    total = F.col("__total")
    ready = ((e1 >= 0.4) | ((e2 >= 0.4) & (e3 >= 0.3)) | (total >= 0.5)) & (F.col("__cut") == 1.0)
    confidence = F.when((e1 >= 0.6) | (total >= 0.7), "high").when((e1 >= 0.3) | (total >= 0.4), "medium").otherwise("low")
    told = F.concat(F.lit("brave_evidence:"), col_or_empty(leads, "sce_evidence_type"))
    with_told = lambda words, when: F.slice(F.concat(m.found(words), F.when(when, F.array(told)).otherwise(F.array().cast("array<string>"))), 1, 5)
    named = [with_told(D.SCE_E1, strong).alias("e1_words"), with_told(D.SCE_E2, medium).alias("e2_words"), F.slice(m.found(D.SCE_E3), 1, 5).alias("e3_words")]
    new = [F.round(F.col(f"__{c}"), 3).alias(n) for c, n in (("e1", "e1"), ("e2", "e2"), ("e3", "e3"), ("total", "sce_score"))]
    made = {"e1", "e2", "e3", "sce_score", "sce_ready", "sce_confidence", "e1_words", "e2_words", "e3_words"}
    return out.select(*[c for c in leads.columns if c not in made], *new, ready.alias("sce_ready"), confidence.alias("sce_confidence"), *named)


def heuristic(leads: DataFrame, url: str = "website") -> DataFrame:
    """Keyword score of a text: heuristic_score (may be negative), is_lead, heuristic_confidence."""
    address = col_or_empty(leads, url)
    work = leads.withColumn("__m", words_of_columns(leads, ("company", "context", url), D.HEURISTIC_POSITIVE, NEAR_MACHINES, NEAR_PARTS, FACILITY, D.HEURISTIC_NEGATIVE))
    m, t = Words(F.col("__m")), joined(text_of("company"), text_of("context"), address)
    # the pattern of distances is only tried where both sides have a word
    close = F.when(m.any(NEAR_MACHINES) & m.any(NEAR_PARTS), let(t, lambda t: near(t, NEAR_MACHINES, NEAR_PARTS))).otherwise(F.lit(False))
    score = F.least(F.lit(40), m.hits(D.HEURISTIC_POSITIVE) * 10) + F.when(close, 20).otherwise(0)
    score = score + F.when(m.any(FACILITY), 15).otherwise(0) - m.hits(D.HEURISTIC_NEGATIVE) * 20
    score = score - F.when(address.contains("linkedin.com/in/") & ~address.contains("linkedin.com/company"), 30).otherwise(0)
    out = work.withColumn("heuristic_score", score).drop("__m")
    return out.withColumn("is_lead", F.col("heuristic_score") >= 25).withColumn("heuristic_confidence", banded(F.col("heuristic_score"), [(60, "high"), (30, "medium")], "low"))


def reachability(leads: DataFrame) -> Column:
    """10 for an e-mail, 6 for a telephone, 3 for a website, 1 for a contact page; 20 at most."""
    some = lambda c: (F.size(c) > 0).cast("int") if c in leads.columns else F.lit(0)
    page = has_value("contact_urls").cast("int") if "contact_urls" in leads.columns else F.lit(0)
    return F.least(F.lit(20), some("emails") * 10 + some("phones") * 6 + has_value("website").cast("int") * 3 + page)


def composite(
    leads: DataFrame,
    priority: DataFrame,
    *,
    capacity_words: Iterable[str] = D.SIGNAL_FACILITY,
    product_words: Iterable[str] = D.SIGNAL_PARTS,
    brand_words: Iterable[str] = D.GATE_OEM,
    weights: tuple[float, float, float, float] = (0.4, 0.2, 0.2, 0.2),
) -> DataFrame:
    """fit, capacity, import and reach scores, product and brand bonuses, and score (150 at most).

    priority: (country, value); of several rows of a country the greatest value counts.
    """
    capacity_words, product_words, brand_words = tuple(capacity_words), tuple(product_words), tuple(brand_words)
    top = priority.agg(F.max("value")).scalar()
    known = priority.where("country is not null").groupBy(F.lower(F.trim("country")).alias("__country")).agg(F.max("value").alias("__value"))
    out = heuristic(leads).withColumn("__country", F.lower(F.trim(text_of("country"))))
    out = out.join(known, "__country", "left")
    out = out.withColumn("__m", words_of_columns(leads, ("context", "company", "source_name"), capacity_words, product_words, brand_words))
    m = Words(F.col("__m"))
    out = out.withColumn("fit_score", F.greatest(F.lit(0), F.least(F.lit(40), F.col("heuristic_score"))).cast("double"))
    out = out.withColumn("capacity_score", F.least(F.lit(20.0), m.hits(capacity_words) * F.lit(20 / max(1, len(capacity_words)))))
    out = out.withColumn("import_score", F.when(top > 0, F.least(F.lit(20.0), F.coalesce(F.col("__value"), F.lit(0.0)) / top * 20)).otherwise(0.0))
    out = out.withColumn("reach_score", reachability(leads).cast("double"))
    out = out.withColumn("product_bonus", F.least(F.lit(15), m.hits(product_words) * 3)).withColumn("brand_bonus", F.least(F.lit(20), m.hits(brand_words) * 5))
    base = sum((F.col(c) * w for c, w in zip(("fit_score", "capacity_score", "import_score", "reach_score"), weights)), F.lit(0.0))
    rival = F.least(F.lit(35), F.when(has_value("competitor_reference"), 25).otherwise(0)) if "competitor_reference" in leads.columns else F.lit(0)
    score = F.least(F.lit(150.0), F.least(F.lit(100.0), base * 2.5) + F.col("product_bonus") + F.col("brand_bonus") + rival)
    return out.withColumn("score", score).drop("__country", "__value", "__m")


def hundred_points(leads: DataFrame, *, grades: tuple[float, float, float] = (80, 65, 50), bonuses: tuple[int, int, int, int] = (10, 5, 5, 5)) -> DataFrame:
    """The 100-point model: activity, machines, profile, signals and bonuses; disqualified leads have 0 and grade X."""
    columns, names = leads.columns, ("__x", "__c", "__m", "__f", "__s")
    small, both = (PROFILE_LARGE, PROFILE_MEDIUM, SIGNAL_EXPANSION, SIGNAL_MODERN, SIGNAL_INVEST, D.V10_NEGATIVE), (D.V10_TIER1, D.V10_TIER2, CARE)
    of = {"__x": words_of_columns(leads, ("context",), *small), "__c": words_of_columns(leads, ("company",), D.V10_NEGATIVE), "__m": words_of_columns(leads, ("context", "company"), *both)}
    leads = leads.withColumns(of | {"__f": words_of_columns(leads, ("context", "company", "segment"), D.V10_FINISHING), "__s": low("source_type")})
    context, text, whole, source = Words(F.col("__x")), Words(F.col("__m")), Words(F.col("__f")), F.col("__s")
    flag = lambda c: F.coalesce(F.col(c).cast("boolean"), F.lit(False)) if c in leads.columns else F.lit(False)
    listed = lambda c: F.coalesce(F.col(c), F.array().cast("array<string>")) if c in leads.columns else F.array().cast("array<string>")
    negative = Words(F.array_union("__x", "__c")).first(D.V10_NEGATIVE)
    reason = F.coalesce(
        F.when(flag("is_machinery_supplier"), "Machinery supplier"),
        F.when(flag("is_parts_supplier"), "Spare parts supplier"),
        F.when(flag("is_trading_company"), "Trading company"),
        F.when(F.lower(col_or_empty(leads, "entity_type")).isin("supplier", "distributor", "trader", "agent"), F.concat(F.lit("Entity type: "), F.lower(col_or_empty(leads, "entity_type")))),
        F.concat(F.lit("Negative signal: "), negative),
    )
    evidence = whole.hits(D.V10_FINISHING) + flag("has_finishing_context").cast("int") + F.least(F.lit(5), F.size(listed("finishing_signals")))
    role = F.lower(col_or_empty(leads, "role")).isin("end_user", "customer", "manufacturer")
    activity = F.when(evidence >= 3, 30).when(evidence >= 2, 25).when(evidence >= 1, 15).when(role, 10).otherwise(5)
    brands = F.transform(listed("oem_brands"), F.lower)
    count = lambda words: F.size(F.array_union(text.found(words), F.array_intersect(F.array(*map(F.lit, words)), brands)))
    one, two = count(D.V10_TIER1), count(D.V10_TIER2)
    care = (F.size(listed("oem_signals")) > 0) | text.any(CARE)
    machine = F.when((one >= 2) | ((one >= 1) & care), 25).when(one >= 1, 20).when(two >= 1, 12).when(flag("has_finishing_context"), 8).otherwise(0)
    paper = F.lower(col_or_empty(leads, "certification"))
    certificates = sum(((source.contains(a) | paper.contains(b)).cast("int") for a, b in (("gots", "gots"), ("oekotex", "oeko"), ("bettercotton", "bci"))), F.lit(0)) + flag("is_premium_fiber").cast("int")
    large = context.any(PROFILE_LARGE)
    profile = F.when((certificates >= 2) | ((certificates >= 1) & large), 25).when(certificates >= 1, 20).when(large, 15).when(context.any(PROFILE_MEDIUM), 12).otherwise(8)
    urgent = has_value("urgency_signal").cast("int") if "urgency_signal" in leads.columns else F.lit(0)
    signs = [source.contains("fair"), source.contains("job"), source.contains("trade") | source.contains("import"), context.any(SIGNAL_EXPANSION), context.any(SIGNAL_MODERN), context.any(SIGNAL_INVEST), flag("has_recent_investment")]
    signals = sum((s.cast("int") for s in signs), urgent)
    signal = F.when(signals >= 3, 20).when(signals >= 2, 15).when(signals >= 1, 10).otherwise(6)
    brand = F.lower(col_or_empty(leads, "oem_brand"))
    bonus = F.when(brand.isin(*D.V10_TIER1), bonuses[0]).when(brand.isin(*D.V10_TIER2), bonuses[1]).otherwise(0)
    bonus = bonus + F.when(F.col("source_type") == "gots", bonuses[2]).otherwise(0) + F.when(F.col("source_type") == "oekotex", bonuses[3]).otherwise(0) + F.when(flag("is_golden"), 5).otherwise(0)
    out = leads.withColumn("v10_reason", reason)
    for name, value in (("activity", activity), ("machine", machine), ("profile", profile), ("signal", signal), ("bonus", bonus)):
        out = out.withColumn(f"v10_{name}", value)
    total = F.least(F.lit(100), F.greatest(F.lit(0), F.expr("v10_activity + v10_machine + v10_profile + v10_signal + v10_bonus")))
    out = out.withColumn("v10_score", F.when(F.col("v10_reason").isNotNull(), 0).otherwise(total))
    out = out.select(*columns, *[c for c in out.columns if c not in columns and c not in names])
    return out.withColumn("v10_grade", F.when(F.col("v10_reason").isNotNull(), "X").otherwise(banded(F.col("v10_score"), list(zip(grades, "ABC")), "D")))


def role(leads: DataFrame) -> DataFrame:
    """The lead's role: role, role_score and role_confidence, from weighted words and its source's weight.

    The score is held in hundredths, so sums are exact and the limits are met as they are written.
    """
    groups = (D.ROLE_STRONG_CUSTOMER, D.ROLE_STRONG_INTERMEDIARY, D.ROLE_CUSTOMER, D.ROLE_INTERMEDIARY, D.ROLE_BRAND)
    work = once(leads, __m=words_of_columns(leads, ("company", "context", "website"), *groups))
    hits = Words(F.col("__m")).hits
    weights = F.create_map(*[F.lit(x) for k, v in D.ROLE_SOURCE_WEIGHTS.items() for x in (k, float(v))])
    source = F.coalesce(F.try_element_at(weights, low("source_type")), F.lit(0.3))
    score = hits(D.ROLE_STRONG_CUSTOMER) * 30 - hits(D.ROLE_STRONG_INTERMEDIARY) * 40 + hits(D.ROLE_CUSTOMER) * 10 - hits(D.ROLE_INTERMEDIARY) * 15
    both = F.struct((score + F.round((source - 0.5) * 50)).alias("s"), (hits(D.ROLE_BRAND) * 20).alias("b"))

    def decided(x: Column) -> Column:
        kind = F.when((x["b"] >= 40) & (x["s"] < 30), "BRAND").when(x["s"] >= 30, "CUSTOMER").when(x["s"] <= -20, "INTERMEDIARY").otherwise("UNKNOWN")
        sure = F.when(kind == "BRAND", 50 + x["b"]).when(kind == "CUSTOMER", 50 + x["s"]).when(kind == "INTERMEDIARY", 50 - x["s"]).otherwise(30)
        return F.struct(kind.alias("role"), (x["s"] / 100).alias("score"), (F.least(F.lit(90), sure) / 100).alias("confidence"))

    # words and sums are computed once, so that a filter on the role that is pushed down doesn't repeat them
    out = once(work, __r=let(both, decided))
    return out.withColumns({"role": F.col("__r.role"), "role_score": F.col("__r.score"), "role_confidence": F.col("__r.confidence")}).drop("__r", "__m")


def qualification(leads: DataFrame) -> DataFrame:
    """qualification_score (0 to 100) and is_qualified: a source, one word of each group, the disqualifying words, the country."""
    groups = (D.QUALIFY_OEM_BRANDS, D.QUALIFY_MACHINERY, D.QUALIFY_OPERATIONS, D.QUALIFY_PRODUCT_CATEGORIES, D.QUALIFY_NOT)
    work = leads.withColumn("__m", words_of_columns(leads, ("company", "context"), *groups))
    m = Words(F.col("__m"))
    some = lambda words, points: F.when(m.any(words), points).otherwise(0)
    score = F.when(low("source_type").isin(*D.QUALIFY_SOURCES), 60).otherwise(0)
    score = score + some(D.QUALIFY_OEM_BRANDS, 25) + some(D.QUALIFY_MACHINERY, 20) + some(D.QUALIFY_OPERATIONS, 15) + some(D.QUALIFY_PRODUCT_CATEGORIES, 10)
    score = score - m.hits(D.QUALIFY_NOT) * 30 + F.when(contains_any(low("country"), D.QUALIFY_COUNTRIES), 10).otherwise(0)
    out = work.withColumn("qualification_score", F.greatest(F.lit(0), F.least(F.lit(100), score))).drop("__m")
    return out.withColumn("is_qualified", F.col("qualification_score") >= 50)


def signals(leads: DataFrame) -> DataFrame:
    """Weighted signals of a text: signals (names), signal_words (the first word of each), signal_score, signal_confidence."""
    words = {"finishing": D.SIGNAL_FINISHING, "stenter": D.SIGNAL_STENTER, "parts": D.SIGNAL_PARTS, "facility": D.SIGNAL_FACILITY}
    own = {w for d in (*words.values(), D.SIGNAL_NEGATIVE) for w in d}
    work = leads.withColumn("__t", words_of_texts(fold_accents(text_of("context")), own))
    m = Words(F.col("__t"))
    work = work.withColumns({f"__{k}": m.first(w) for k, w in words.items()})
    named = [F.when(F.col(f"__{k}").isNotNull(), F.struct(F.lit(k).alias("name"), F.col(f"__{k}").alias("word"), F.lit(float(D.SIGNAL_WEIGHTS[k])).alias("weight"))) for k in words]
    out = work.withColumn("__s", F.array_compact(F.array(*named)))
    plain = F.aggregate("__s", F.lit(0.0), lambda acc, x: acc + x["weight"])
    score = F.when((F.size("__s") > 0) & m.any(D.SIGNAL_NEGATIVE), F.greatest(F.lit(0.0), plain - 1.5)).otherwise(plain)
    out = out.withColumn("signals", F.transform("__s", lambda x: x["name"])).withColumn("signal_words", F.transform("__s", lambda x: x["word"])).withColumn("signal_score", score)
    return out.drop("__s", "__t", *[f"__{k}" for k in words]).withColumn("signal_confidence", banded(F.col("signal_score"), [(6, "high"), (3, "medium")], "low"))


def triggers(leads: DataFrame, now: str = "2024-02-01 00:00:00") -> DataFrame:
    """Events that call for action: triggers (type, priority, bonus, action), trigger_count, trigger_bonus, trigger_priority, trigger_actions."""
    work, source = leads.withColumn("__m", words_of_columns(leads, ("company", "context"), TRIGGER_FACILITY, TRIGGER_FAIR, TRIGGER_JOB)), low("source_type")
    m = Words(F.col("__m"))
    volume = F.coalesce(F.col("import_volume_tons"), F.lit(0.0)) >= 20 if "import_volume_tons" in leads.columns else F.lit(False)
    recent = F.coalesce(F.col("last_updated") > F.lit(now).cast("timestamp") - F.expr("INTERVAL 90 DAYS"), F.lit(False)) if "last_updated" in leads.columns else F.lit(False)
    changed = F.coalesce(F.col("website_changed").cast("boolean"), F.lit(False)) if "website_changed" in leads.columns else F.lit(False)
    when = {
        "large_import": volume,
        "new_facility": m.any(TRIGGER_FACILITY),
        "fair_participation": source.contains("fair") | source.contains("exhibitor") | m.any(TRIGGER_FAIR),
        "job_posting": m.any(TRIGGER_JOB),
        "association_update": contains_any(source, ("gots", "bci", "oekotex", "association")) & recent,
        "website_change": changed,
    }
    made = [F.when(when[k], F.struct(F.lit(k).alias("type"), F.lit(p).alias("priority"), F.lit(b).alias("bonus"), F.lit(a).alias("action"))) for k, (p, b, a) in TRIGGERS.items()]
    out = work.withColumn("triggers", F.array_compact(F.array(*made))).drop("__m")
    out = out.withColumn("trigger_count", F.size("triggers")).withColumn("trigger_bonus", F.aggregate("triggers", F.lit(0), lambda acc, x: acc + x["bonus"]))
    high = F.exists("triggers", lambda x: x["priority"] == "high")
    return out.withColumn("trigger_priority", F.when(high, "high").when(F.col("trigger_count") > 0, "medium")).withColumn("trigger_actions", F.array_sort(F.array_distinct(F.transform("triggers", lambda x: x["action"]))))


def hs_codes(leads: DataFrame) -> DataFrame:
    """hs_primary, hs_secondary, hs_reason and hs_words of the first rule one of whose words stands in the text."""
    work = leads.withColumn("__m", words_of_columns(leads, ("context", "company"), *[r[0] for r in HS_RULES]))
    m = Words(F.col("__m"))
    pick = lambda i: [F.when(m.any(r[0]), r[i]) for r in HS_RULES]
    words = F.coalesce(*[F.when(m.any(r[0]), m.found(r[0])) for r in HS_RULES], F.array().cast("array<string>"))
    return work.withColumn("hs_primary", F.coalesce(*pick(1), F.lit(HS_DEFAULT[0]))).withColumn("hs_secondary", F.coalesce(*pick(2), F.lit(HS_DEFAULT[1]))).withColumn("hs_reason", F.coalesce(*pick(3), F.lit(HS_DEFAULT[2]))).withColumn("hs_words", words).drop("__m")


def email_points(mail: Column) -> Column:
    local = F.lower(F.substring_index(mail, "@", 1))
    starts = lambda words: local.rlike("^(" + "|".join(words) + ")")
    points = F.when(starts(D.MAIL_GENERIC), 0).when(local.isin(*D.MAIL_INFO), 10).when(starts(D.MAIL_DEPARTMENT), 30).when(local.contains(".") | local.contains("_"), 60).otherwise(20)
    return F.when(mail.contains("@"), points).otherwise(0)


def contactability(leads: DataFrame) -> DataFrame:
    """contactability_score: the best e-mail's points, a telephone, a search string, a named contact; 100 at most."""
    best = F.coalesce(F.array_max(F.transform("emails", email_points)), F.lit(0))
    both = (has_value("contact_person") & has_value("contact_role")).cast("int") if {"contact_person", "contact_role"} <= set(leads.columns) else F.lit(0)
    search = has_value("linkedin_xray").cast("int") if "linkedin_xray" in leads.columns else F.lit(0)
    return leads.withColumn("contactability_score", F.least(F.lit(100), best + (F.size("phones") > 0).cast("int") * 20 + search * 15 + both * 25))


def machine_age(leads: DataFrame, year: str = "estimated_installation_year") -> DataFrame:
    """machine_age_priority and urgency_boost by the year of installation."""
    y = F.col(year).cast("int")
    kind = F.when(y.isNull(), "unknown").when(y.between(2016, 2021), "high").when(y.between(2023, 2026), "low").otherwise("medium")
    return leads.withColumn("machine_age_priority", kind).withColumn("urgency_boost", F.when(y.between(2016, 2021), 20).when(y.between(2023, 2026), -10).otherwise(0))


def final_score(leads: DataFrame) -> DataFrame:
    """evidence_score from k1_count, k2_count and oem_brand; final_score with contactability and urgency; tier 1, 2 or 3."""
    k1, k2, brand = F.coalesce("k1_count", F.lit(0)), F.coalesce("k2_count", F.lit(0)), F.trim(text_of("oem_brand"))
    score = F.when(k1 >= 2, 50).when(k1 == 1, 35).otherwise(0) + F.when(k2 >= 2, 30).when(k2 == 1, 20).otherwise(0)
    score = score + F.when(brand.isin("Monforts", "Brückner", "Krantz"), 20).when(brand != "", 10).otherwise(0)
    out = leads.withColumn("evidence_score", F.least(F.lit(100), score)).withColumn("is_golden", (k1 >= 1) & (k2 >= 1))
    pace = F.when(F.col("machine_age_priority") == "high", 0.2).when(F.col("machine_age_priority") == "low", -0.2).otherwise(0.0) if "machine_age_priority" in leads.columns else F.lit(0.0)
    pace = pace + (F.when(F.col("urgency_signal") == "job_posting", 0.3).otherwise(0.0) if "urgency_signal" in leads.columns else F.lit(0.0))
    pace = F.greatest(F.lit(0.5), F.least(F.lit(2.0), pace + 1.0))
    total = F.col("evidence_score") * 0.5 + F.col("contactability_score") * 0.3 + F.col("evidence_score") * (pace - 1) * 0.2
    out = out.withColumn("final_score", F.round(total, 2))
    one = F.col("is_golden") & (F.col("final_score") >= 60) & (F.col("contactability_score") >= 40)
    return out.withColumn("tier", F.when(one, 1).when(((k1 >= 1) | (k2 >= 1)) & (F.col("final_score") >= 40), 2).otherwise(3))


def evidence_counts(leads: DataFrame, sources: Iterable[str] = ("oekotex", "gots", "known_manufacturer", "oem_customer", "fair", "directory")) -> DataFrame:
    """k1_count (a source that vouches for the lead) and k2_count (signals on its own site); derived anew each time."""
    k2 = (F.size("signals") > 0).cast("int") if "signals" in leads.columns else F.lit(0)
    return leads.withColumn("k1_count", low("source_type").isin(*sources).cast("int")).withColumn("k2_count", k2)


#: The dictionaries that the models of one lead pipeline look for in companies and contexts.
SCAN_WORDS = (
    D.SCE_SUPPLIER, D.SCE_E1, D.SCE_E2, D.SCE_E3, D.HEURISTIC_POSITIVE, NEAR_MACHINES, NEAR_PARTS, FACILITY, D.HEURISTIC_NEGATIVE, D.SIGNAL_FACILITY, D.SIGNAL_PARTS, D.GATE_OEM,
    PROFILE_LARGE, PROFILE_MEDIUM, SIGNAL_EXPANSION, SIGNAL_MODERN, SIGNAL_INVEST, CARE, D.V10_NEGATIVE, D.V10_FINISHING, D.V10_TIER1, D.V10_TIER2, D.ROLE_STRONG_CUSTOMER,
    D.ROLE_STRONG_INTERMEDIARY, D.ROLE_CUSTOMER, D.ROLE_INTERMEDIARY, D.ROLE_BRAND, D.QUALIFY_OEM_BRANDS, D.QUALIFY_MACHINERY, D.QUALIFY_OPERATIONS, D.QUALIFY_PRODUCT_CATEGORIES,
    D.QUALIFY_NOT, TRIGGER_FACILITY, TRIGGER_FAIR, TRIGGER_JOB, *[r[0] for r in HS_RULES], D.ENTITY_ASSOCIATION, D.ENTITY_INTERMEDIARY, D.ENTITY_END_USER, D.ENTITY_BRAND, D.GATE_PARTS_SIGNALS,
)


def scan(leads: DataFrame) -> DataFrame:
    """leads with what all the models look for in company and context, found by one pass (columns scan_company, scan_context).
    Whoever changes company or context afterwards must drop them."""
    return scanned(leads, ("company", "context"), {w for d in SCAN_WORDS for w in d})


def text_relevance(leads: DataFrame, languages: dict[str, Iterable[str]], finishing: Iterable[str] = D.SIGNAL_FINISHING, columns: Iterable[str] = ("company", "context", "segment", "description")) -> DataFrame:
    """kw_finishing, kw_oem_tier1, kw_oem_tier2, kw_language (unknown where no dictionary has a hit), kw_relevance_score: ten for
    each process word (50 at most), 15 and 10 for each maker (90 at most in all), ten for a known language; kw_keyword_count."""
    finishing, there = tuple(finishing), [c for c in columns if c in leads.columns]
    work = leads.withColumn("__m", words_of_columns(leads, there, finishing, D.V10_TIER1, D.V10_TIER2))
    m = Words(F.col("__m"))
    lang = let(joined(*map(text_of, there)), lambda t: F.coalesce(language_votes(t, languages), F.lit("unknown")))
    out = work.withColumns({"kw_finishing": m.found(finishing), "kw_oem_tier1": m.found(D.V10_TIER1), "kw_oem_tier2": m.found(D.V10_TIER2), "kw_language": lang})
    score = F.least(F.lit(90), F.least(F.lit(50), F.size("kw_finishing") * 10) + F.size("kw_oem_tier1") * 15 + F.size("kw_oem_tier2") * 10)
    count = F.size("kw_finishing") + F.size("kw_oem_tier1") + F.size("kw_oem_tier2")
    return out.withColumn("kw_relevance_score", (score + F.when(F.col("kw_language") != "unknown", 10).otherwise(0)).cast("double")).withColumn("kw_keyword_count", count).drop("__m")


def trade_points(leads: DataFrame, priority: DataFrame, key: str = "iso3", most: float = 20.0) -> DataFrame:
    """leads with import_score: the import value of the lead's country by its code as a share of the greatest, times ``most``.
    priority: (key, import_value); of several rows of a code the sum counts. Leads without a code have zero."""
    known = priority.where(F.col(key).isNotNull()).groupBy(key).agg(F.sum("import_value").alias("__value"))
    top = known.agg(F.max("__value")).scalar()
    out = leads.join(known, key, "left")
    return out.withColumn("import_score", F.when(top > 0, F.least(F.lit(most), F.coalesce("__value", F.lit(0.0)) / top * most)).otherwise(0.0)).drop("__value")


def unscan(leads: DataFrame) -> DataFrame:
    """leads without what ``scan`` has found."""
    return leads.drop("scan_company", "scan_context")
