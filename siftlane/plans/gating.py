"""Queries of the record-level gates (sanitising, noise, entity gate, selections, contracts)."""

from __future__ import annotations

from pyspark.sql import functions as F

from siftlane import dictionaries as D
from siftlane.operators import gates, rules, scores
from siftlane.plans.collected import query
from siftlane.plans.leads import LEADS_SQL, leads, sql_any, sql_first, sql_list
from siftlane.session import table
from siftlane.sources import sinks

WITH = "WITH " + LEADS_SQL
WORDS = r"list_filter(regexp_split_to_array({0}, '\s+'), lambda w: w <> '')"
NAME = "lower(trim(company, ' '))"
NOISE = f"""(length({NAME}) < 3
  OR (len({WORDS.format(NAME)}) = 1 AND list_contains({sql_list(D.NAME_GENERIC)}, {NAME}))
  OR (len({WORDS.format(NAME)}) = 2 AND (list_contains({sql_list(D.NAME_GENERIC)}, {WORDS.format(NAME)}[1]) OR list_contains({sql_list(D.NAME_GENERIC)}, {WORDS.format(NAME)}[2])))
  OR regexp_matches({NAME}, '\\b(event|summit|conference|review|news|expo|fair|exhibition)\\b')
  OR regexp_matches({NAME}, '^(the |a )?(textile|dyeing|finishing|machine)$') OR regexp_matches({NAME}, '\\d{{4}}\\s*(event|summit|conference)')
  OR (length({NAME}) < 5 AND NOT regexp_matches({NAME}, '\\w+\\s+(ltd|inc|llc|gmbh|sa|srl)')))"""
BOTH = "lower(company || ' ' || context)"
NON_CUSTOMER = f"""({sql_any(BOTH, [w for w in D.NON_CUSTOMER if w not in ("institute", "chamber")])} OR (contains({BOTH}, 'institute') AND NOT contains({BOTH}, 'technology'))
  OR (contains({BOTH}, 'chamber') AND NOT contains({BOTH}, 'reaction')))"""
SITE = "nullif(trim(coalesce(website, ''), ' '), '')"
SITE_HOST = f"split_part(regexp_replace(lower({SITE}), '^https?://', ''), '/', 1)"


@query(f"{WITH} SELECT _ord, trim(regexp_replace(company, '\\s+', ' ', 'g'), ' ') AS company, country FROM leads WHERE trim(regexp_replace(company, '\\s+', ' ', 'g'), ' ') <> ''")
def f1_sanitise(spark, sf):
    return gates.sanitise(leads(spark, sf)).select("_ord", "company", "country")


# leads with the faults that contracts are about, by their number
FAULTY = f"""{WITH}, c AS (SELECT _ord, CASE _ord % 13 WHEN 0 THEN ' View basket ' WHEN 1 THEN 'Energy' WHEN 2 THEN 'Fabric' WHEN 3 THEN 'ab' WHEN 4 THEN company || ' www.x.y' WHEN 5 THEN company || ' a@b.io' WHEN 6 THEN '  ' WHEN 7 THEN 'Page 7' ELSE company END AS company,
  CASE _ord % 7 WHEN 0 THEN 'https://x.y/' || country WHEN 1 THEN 'BRASIL' WHEN 2 THEN 'mısır' WHEN 3 THEN 'x@' || country || '.tld' WHEN 4 THEN '' ELSE country END AS country,
  CASE _ord % 9 WHEN 0 THEN 'info@x.y' WHEN 1 THEN 'www.x.y' WHEN 2 THEN ' x.y/z ' WHEN 3 THEN 'nodot' WHEN 4 THEN 'https://services.oeko-tex.com/' || _ord WHEN 5 THEN 'http://u@x.y' ELSE website END AS website,
  CASE WHEN _ord % 2 = 0 THEN 'https://source.org' END AS source_url, [' a@b.co ', 'none', 'c@d'] AS emails FROM leads),
s AS (SELECT *, regexp_replace(company, '^\\s+|\\s+$', '', 'g') AS n, regexp_replace(coalesce(country, ''), '^\\s+|\\s+$', '', 'g') AS l, regexp_replace(coalesce(website, ''), '^\\s+|\\s+$', '', 'g') AS w FROM c),
e AS (SELECT *, list_filter([CASE WHEN n = '' THEN 'company_empty' WHEN list_contains({sql_list(gates.CONTRACT_NOISE)}, lower(n)) OR regexp_matches(lower(n), '^page [0-9]$') THEN 'company_noise' WHEN length(n) < 3 THEN 'company_short'
    WHEN list_contains({sql_list(gates.CONTRACT_GENERIC)}, lower(n)) THEN 'company_generic' WHEN regexp_matches(n, '(?i)https?://|www\\.|\\.com|\\.org|\\.net|\\.edu|\\.gov') THEN 'company_url' WHEN regexp_matches(n, '@[a-zA-Z0-9.-]+\\.[a-zA-Z]{{2,}}') THEN 'company_email' END,
  CASE WHEN regexp_matches(l, '(?i)https?://|www\\.|\\.com|\\.org|\\.net|\\.edu|\\.gov') THEN 'country_url' WHEN regexp_matches(l, '@[a-zA-Z0-9.-]+\\.[a-zA-Z]{{2,}}') THEN 'country_email' END,
  CASE WHEN contains(w, '@') AND NOT starts_with(w, 'http') THEN 'website_email' END], lambda x: x IS NOT NULL) AS errors FROM s)"""


def faulty(spark, sf):
    """Leads with the faults that contracts are about, by their number."""
    at = lambda n, **by: [F.when(F.col("_ord") % n == int(k[1:]), v) for k, v in by.items()]
    company, country = F.col("company"), F.col("country")
    odd = at(13, _0=F.lit(" View basket "), _1=F.lit("Energy"), _2=F.lit("Fabric"), _3=F.lit("ab"), _4=F.concat(company, F.lit(" www.x.y")), _5=F.concat(company, F.lit(" a@b.io")), _6=F.lit("  "), _7=F.lit("Page 7"))
    lands = at(7, _0=F.concat(F.lit("https://x.y/"), country), _1=F.lit("BRASIL"), _2=F.lit("mısır"), _3=F.concat(F.lit("x@"), country, F.lit(".tld")), _4=F.lit(""))
    sites = at(9, _0=F.lit("info@x.y"), _1=F.lit("www.x.y"), _2=F.lit(" x.y/z "), _3=F.lit("nodot"), _4=F.concat(F.lit("https://services.oeko-tex.com/"), F.col("_ord").cast("string")), _5=F.lit("http://u@x.y"))
    return leads(spark, sf).select(
        "_ord", F.coalesce(*odd, company).alias("company"), F.coalesce(*lands, country).alias("country"), F.coalesce(*sites, F.col("website")).alias("website"),
        F.when(F.col("_ord") % 2 == 0, "https://source.org").alias("source_url"), F.array(F.lit(" a@b.co "), F.lit("none"), F.lit("c@d")).alias("emails"),
    )


@query(f"{FAULTY} SELECT _ord, array_to_string(errors, ',') AS errors FROM e")
def f3_contract(spark, sf):
    return gates.contract_errors(faulty(spark, sf)).select("_ord", F.array_join("errors", ",").alias("errors"))


@query(f"{FAULTY} SELECT error, count(*) AS n FROM (SELECT unnest(errors) AS error FROM e) GROUP BY error")
def f3_contract_counts(spark, sf):
    return gates.error_counts(gates.contract_errors(faulty(spark, sf)))


COUNTRY_SQL = "CASE lower(l) " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in gates.CONTRACT_COUNTRIES.items()) + " ELSE l END"


@query(
    f"""{FAULTY}, v AS (SELECT *, CASE WHEN starts_with(w, 'http') OR starts_with(w, 'www.') THEN w WHEN contains(w, '.') AND NOT contains(w, '@') THEN 'https://' || w END AS u FROM e WHERE len(errors) = 0)
SELECT _ord, n AS company, nullif({COUNTRY_SQL}, '') AS country, CASE WHEN NOT contains(u, 'oeko-tex.com') THEN u END AS website, CASE WHEN contains(u, 'oeko-tex.com') AND source_url IS NULL THEN u ELSE source_url END AS source_url, 'a@b.co' AS emails FROM v"""
)
def f3_valid(spark, sf):
    return gates.contract(faulty(spark, sf))[0].withColumn("emails", F.array_join("emails", ","))


@query(f"{FAULTY} SELECT _ord, company, country, website FROM e WHERE len(errors) > 0")
def f3_invalid(spark, sf):
    return gates.contract(faulty(spark, sf))[1].select("_ord", "company", "country", "website")


@query(f"{WITH} SELECT _ord, {NOISE} AS is_noise, {NON_CUSTOMER} AS is_non_customer FROM leads")
def f4_f6_noise_and_customers(spark, sf):
    own = leads(spark, sf)
    return own.select("_ord", gates.is_noise(F.col("company")).alias("is_noise"), gates.is_non_customer(F.col("company"), F.col("context")).alias("is_non_customer"))


@query(
    f"""{WITH} SELECT _ord, CASE WHEN {NOISE} THEN 'noise_company_name' END AS reject_reason, coalesce({sql_any(SITE_HOST, D.DOMAIN_BLOCKLIST)}, false) AS needs_discovery,
  CASE WHEN {sql_any(SITE_HOST, D.DOMAIN_BLOCKLIST)} THEN {SITE} END AS invalid_domain_cleared FROM leads"""
)
def f7_f8_clean_dataset(spark, sf):
    return gates.clean_dataset(leads(spark, sf)).select("_ord", "reject_reason", "needs_discovery", "invalid_domain_cleared")


URL = f"lower(coalesce({SITE}, ''))"
PATH = f"regexp_extract({URL}, '^(?:[a-z][a-z0-9+.-]*://)?[^/?#]*([^?#]*)', 1)"


@query(
    f"""{WITH} SELECT _ord, CASE WHEN NOT list_contains({sql_list(D.FAST_TRUSTED)}, lower(source_type)) THEN
  coalesce('domain_blacklist:' || {sql_first(URL, D.FAST_DOMAINS)}, 'path_blacklist:' || {sql_first(PATH, D.FAST_PATHS)}) END AS reject_reason FROM leads"""
)
def f9_fast_filter(spark, sf):
    return gates.fast_filter(leads(spark, sf)).select("_ord", "reject_reason")


@query()
def f11_entity_gate(spark, sf):
    """The gate's patterns need look at letters that DuckDB's expressions class differently; tests hold it against samples."""
    own = gates.entity_gate(leads(spark, sf).withColumn("company", F.initcap("company")))
    return own.select("_ord", "entity_grade", "entity_score", "gate_reason", "is_parts_supplier")


@query()
def f11_gate_reasons(spark, sf):
    own = gates.entity_gate(leads(spark, sf)).where("gate_reason is not null")
    return own.groupBy(rules.category("gate_reason").alias("category")).agg(F.count("*").alias("n"))


ENTITY_TEXT = "lower(company || ' ' || context || ' ')"


@query(
    f"""{WITH}, t AS (SELECT _ord, CASE WHEN {sql_any(ENTITY_TEXT, D.ENTITY_ASSOCIATION)} THEN 'association' WHEN {sql_any(ENTITY_TEXT, D.ENTITY_INTERMEDIARY)} THEN 'intermediary'
  WHEN {sql_any(ENTITY_TEXT, D.ENTITY_END_USER)} THEN 'end_user' WHEN {sql_any(ENTITY_TEXT, D.ENTITY_BRAND)} THEN 'brand' ELSE 'unknown' END AS entity_type FROM leads)
SELECT _ord, entity_type, entity_type NOT IN ('association', 'intermediary') AS should_process,
  CASE entity_type WHEN 'end_user' THEN 100 WHEN 'brand' THEN 60 WHEN 'unknown' THEN 40 WHEN 'intermediary' THEN 10 ELSE 0 END AS entity_priority FROM t"""
)
def f13_entity_type(spark, sf):
    return gates.entity_type(leads(spark, sf)).select("_ord", "entity_type", "should_process", "entity_priority")


@query(
    f"""{WITH} SELECT _ord, nullif(array_to_string(list_filter([CASE WHEN {NOISE} THEN 'noise' END, CASE WHEN {NON_CUSTOMER} THEN 'non_customer' END], lambda x: x IS NOT NULL), '+'), '') AS drop_reason FROM leads"""
)
def f14_role_filter(spark, sf):
    return gates.role_filter(leads(spark, sf).withColumn("role", F.lit("UNKNOWN"))).select("_ord", "drop_reason")


@query(
    f"""{WITH} SELECT country, source_type, score FROM (SELECT *, {sql_any("lower(context)", D.GATE_PARTS_SIGNALS)} AS ps FROM leads)
WHERE coalesce(score, 0) >= 40 AND {SITE} IS NOT NULL AND NOT ps AND _ord % 3 <> 2"""
)
def f15_export_filter(spark, sf):
    own = leads(spark, sf).withColumn("is_parts_supplier", F.col("context").isNotNull() & gates.contains_any(F.lower("context"), D.GATE_PARTS_SIGNALS))
    graded = own.withColumn("entity_grade", F.element_at(F.array(F.lit("A"), F.lit("C"), F.lit("REJECT")), (F.pmod("_ord", F.lit(3)) + 1).cast("int")))
    return gates.export_filter(graded, least_score=40).select("country", "source_type", "score")


@query(
    f"""{WITH}, v AS (SELECT *, regexp_extract_all(lower(context), '[a-z0-9._%+-]+@[a-z0-9.-]+\\.[a-z]{{2,}}') AS mails FROM leads)
SELECT _ord, CASE WHEN {SITE} IS NULL THEN 'no_website' WHEN {sql_first(SITE_HOST, D.DOMAIN_BLOCKLIST)} IS NOT NULL THEN 'non_company_domain:' || {sql_first(SITE_HOST, D.DOMAIN_BLOCKLIST)}
  WHEN NOT contains(website, '.') THEN 'invalid_url' WHEN len(mails) = 0 THEN 'no_email' END AS enrichment_reason FROM v"""
)
def f20_enrichment_need(spark, sf):
    return gates.enrichment_need(leads(spark, sf, contacts=True)).select("_ord", "enrichment_reason")


@query(
    f"""{WITH} SELECT count(*) AS n_rows, 1.0 * count(*) FILTER (company = '') / count(*) AS missing_company, 0.0 AS missing_country, 1.0 * count(*) FILTER (website IS NULL) / count(*) AS missing_website,
  1 - (SELECT count(*) FROM (SELECT DISTINCT company, country FROM leads)) / count(*) AS duplicate_rate FROM leads"""
)
def f25_contract_report(spark, sf):
    own = gates.contract_report(leads(spark, sf))
    return own.select("n_rows", *[F.col(c).cast("double").alias(c) for c in ("missing_company", "missing_country", "missing_website", "duplicate_rate")])


@query(f"{WITH} SELECT _ord FROM leads WHERE _ord NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)")
def f26_resume(spark, sf):
    from siftlane.operators.tables import unseen

    done = table(spark, sf, "labels").select(F.col("doc_id").alias("_ord"))
    return unseen(leads(spark, sf).select("_ord"), done, "_ord")


@query(f"{WITH} SELECT count(*) AS total, count(*) FILTER ({NOISE}) AS n_noise, round(100.0 * count(*) FILTER ({NOISE}) / count(*), 2) AS pct_noise, count(*) FILTER ({SITE} IS NOT NULL) AS n_site, round(100.0 * count(*) FILTER ({SITE} IS NOT NULL) / count(*), 2) AS pct_site FROM leads")
def k11_report(spark, sf):
    own = leads(spark, sf)
    return sinks.report(own, noise=gates.is_noise(F.col("company")), site=gates.has_value("website")).select("total", "n_noise", F.col("pct_noise").cast("double").alias("pct_noise"), "n_site", F.col("pct_site").cast("double").alias("pct_site"))


@query()
def lead_pipeline(spark, sf):
    """Raw leads to ranked and tiered ones: sanitised, cleaned, gated, classified, scored; in one lazy plan."""
    own = gates.sanitise(leads(spark, sf, contacts=True))
    kept, _ = rules.split(gates.clean_dataset(own))
    graded = gates.entity_type(gates.entity_gate(scores.scan(kept)))
    scored = scores.hundred_points(scores.role(scores.evidence_layers(scores.signals(graded))))
    scored = scores.final_score(scores.evidence_counts(scores.contactability(scored)).withColumn("oem_brand", F.lit("")))
    return scored.select("_ord", "company", "country", "entity_grade", "entity_type", "role", "sce_score", "signal_confidence", "v10_score", "v10_grade", "contactability_score", "final_score", "tier")
