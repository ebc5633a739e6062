"""Queries of selections, exports, extraction and further models."""

from __future__ import annotations

from pyspark.sql import functions as F

from siftlane import dictionaries as D
from siftlane.functions.text import parse_list, text_of, hits
from siftlane.functions.web import blocked
from siftlane.operators import extract, gates, more_scores
from siftlane.operators import tables as O
from siftlane.plans.collected import query
from siftlane.plans.gating import SITE, SITE_HOST
from siftlane.plans.leads import COUNTRIES, LEADS_SQL, leads, sql_any, sql_first, sql_hits, sql_list
from siftlane.session import table
from siftlane.sources import sinks

WITH = "WITH " + LEADS_SQL
TEXT = "lower(company || ' ' || context)"


@query(
    f"""{WITH}, t AS (SELECT _ord, lower(context) AS t FROM leads), s AS (SELECT _ord, {sql_hits("t", D.SIGNAL_FINISHING)} * 3 + {sql_hits("t", D.SIGNAL_STENTER)} * 4 + {sql_hits("t", D.SIGNAL_PARTS)} * 3 + {sql_hits("t", D.SIGNAL_FACILITY)} AS n FROM t)
SELECT _ord, n AS detector_score, CASE WHEN n >= 30 THEN 'high' WHEN n >= 15 THEN 'medium' WHEN n >= 8 THEN 'low' ELSE 'none' END AS detector_confidence FROM s"""
)
def m19_weighted_detector(spark, sf):
    own = more_scores.weighted_detector(leads(spark, sf))
    return own.select("_ord", F.col("detector_score").cast("long").alias("detector_score"), "detector_confidence")


@query(
    f"""{WITH}, s AS (SELECT _ord, {sql_hits(TEXT, D.QUALIFY_MACHINERY)} * 2 + {sql_hits(TEXT, D.QUALIFY_OPERATIONS)} + {sql_hits(TEXT, D.QUALIFY_PRODUCT_CATEGORIES)} AS n FROM leads)
SELECT _ord, n AS potential_hits, CASE WHEN n >= 4 THEN 'high' WHEN n >= 2 THEN 'medium' ELSE 'low' END AS potential FROM s"""
)
def m18_potential(spark, sf):
    own = more_scores.potential(leads(spark, sf))
    return own.select("_ord", F.col("potential_hits").cast("long").alias("potential_hits"), "potential")


@query(
    f"""SELECT page_id, e1, e2, e3, (e1 >= 0.3::DOUBLE OR (e2 >= 0.4::DOUBLE AND e3 >= 0.15::DOUBLE)) AND NOT neg AS ready FROM (SELECT page_id, least(1.0::DOUBLE, {sql_hits("lower(html)", D.SCE_E1)} * 0.3::DOUBLE) AS e1, least(1.0::DOUBLE, {sql_hits("lower(html)", D.SCE_E2)} * 0.2::DOUBLE) AS e2,
  least(1.0::DOUBLE, {sql_hits("lower(html)", D.SCE_E3)} * 0.15::DOUBLE) AS e3, {sql_any("lower(html)", D.V10_NEGATIVE)} AS neg FROM pages)"""
)
def m5_fetched_layers(spark, sf):
    return more_scores.fetched_layers(table(spark, sf, "pages"), "html").select("page_id", "e1", "e2", "e3", "ready")


BRANDS = (*D.V10_TIER1, *D.V10_TIER2)


@query(
    f"""SELECT doc_id, least(1.0::DOUBLE, CASE WHEN b > 0 THEN 0.3::DOUBLE + least(b, 3) * 0.1::DOUBLE ELSE 0 END + CASE WHEN k > 0 THEN 0.2::DOUBLE + least(k, 4) * 0.05::DOUBLE ELSE 0 END + CASE WHEN b > 0 AND k > 0 THEN 0.2::DOUBLE ELSE 0 END + both_ * 0.1::DOUBLE) >= 0.5::DOUBLE AS snippet_ready
FROM (SELECT doc_id, {sql_hits("lower(text)", BRANDS)} AS b, {sql_hits("lower(text)", D.SCE_E2)} AS k,
  len(list_filter(string_split(text, chr(10)), lambda s: {sql_any("lower(s)", BRANDS).replace("lambda k:", "lambda z:").replace(", k)", ", z)")} AND {sql_any("lower(s)", D.SCE_E2).replace("lambda k:", "lambda z:").replace(", k)", ", z)")})) AS both_ FROM documents)"""
)
def m6_snippets(spark, sf):
    own = table(spark, sf, "documents").withColumn("snippets", F.split("text", "\n"))
    return more_scores.snippet_score(own).select("doc_id", "snippet_ready")


RESULT = "lower(trim(company, ' ') || ' ' || context)"


@query(
    f"""{WITH}, r AS (SELECT country, _ord, {sql_first("lower(company || ' ' || context)", D.SCE_E1)} AS s, {sql_first("lower(company || ' ' || context)", D.SCE_E2)} AS m FROM leads),
l AS (SELECT *, CASE WHEN s IS NOT NULL THEN 0 WHEN m IS NOT NULL THEN 1 ELSE 2 END AS level FROM r), b AS (SELECT *, row_number() OVER (PARTITION BY country ORDER BY level, _ord) AS n FROM l)
SELECT country, ['strong', 'medium', 'none'][level + 1] AS evidence_strength, coalesce(s, m) AS evidence_word FROM b WHERE n = 1"""
)
def m7_first_evidence(spark, sf):
    """A country's leads stand for a query's results, in their order."""
    results = leads(spark, sf).select("country", F.col("_ord").alias("rank"), F.col("website").alias("url"), F.col("company").alias("title"), F.col("context").alias("description"))
    return more_scores.first_evidence(results, "country").select("country", "evidence_strength", "evidence_word")


@query(
    f"""SELECT page_id, CASE WHEN t = '' OR {sql_any("t", more_scores.PARKED)} THEN NULL WHEN {sql_any("t", (*BRANDS, "stenter", "ram makine"))} AND {sql_any("t", D.V10_FINISHING)} THEN 1 WHEN {sql_any("t", D.V10_FINISHING)} THEN 2 WHEN {sql_any("t", D.INDUSTRY_TERMS)} THEN 3 END AS site_tier
FROM (SELECT page_id, lower(html) AS t FROM pages)"""
)
def m11_site_tier(spark, sf):
    return more_scores.site_tier(table(spark, sf, "pages"), "html").select("page_id", "site_tier")


@query(
    f"""{WITH}, v AS (SELECT _ord, CASE WHEN regexp_matches({TEXT}, '(^|[^\\pL\\pN_])(mill|mills|dye\\s?house|finishing plant|textile factory|fabric producer)($|[^\\pL\\pN_])') THEN 3 ELSE 0 END + {sql_hits(TEXT, D.ENTITY_END_USER)} + CAST(source_type IN ('known_manufacturer', 'oem_customer', 'precision_search', 'gots', 'oekotex') AS INT) AS c,
  CASE WHEN regexp_matches({TEXT}, '(^|[^\\pL\\pN_])(machinery|spare parts|distributor|dealer|trading)($|[^\\pL\\pN_])') THEN 3 ELSE 0 END + {sql_hits(TEXT, D.ENTITY_INTERMEDIARY)} + CAST(source_type = 'comtrade' AS INT) AS i,
  CASE WHEN regexp_matches({TEXT}, '(^|[^\\pL\\pN_])(fashion|boutique|apparel brand)($|[^\\pL\\pN_])') THEN 3 ELSE 0 END + {sql_hits(TEXT, D.ENTITY_BRAND)} AS b FROM leads)
SELECT _ord, CASE WHEN greatest(c, i, b) < 2 THEN 'UNKNOWN' WHEN c >= greatest(i, b) THEN 'CUSTOMER' WHEN i >= b THEN 'INTERMEDIARY' ELSE 'BRAND' END AS majority_role, greatest(c, i, b) AS majority_points FROM v"""
)
def m13_role_by_majority(spark, sf):
    own = more_scores.role_by_majority(leads(spark, sf))
    return own.select("_ord", "majority_role", F.col("majority_points").cast("long").alias("majority_points"))


@query(
    f"""{WITH} SELECT _ord, CASE WHEN {sql_any(TEXT, D.ROLE_BRAND)} THEN 'BRAND' WHEN {sql_any(TEXT, D.ROLE_STRONG_INTERMEDIARY)} THEN 'INTERMEDIARY' WHEN {sql_any(TEXT, D.ROLE_STRONG_CUSTOMER)} THEN 'CUSTOMER' ELSE 'UNKNOWN' END AS role FROM leads"""
)
def m14_role_override(spark, sf):
    return more_scores.role_override(leads(spark, sf).withColumn("role", F.lit("UNKNOWN"))).select("_ord", "role")


GRADE = "['A', 'B', 'C', 'REJECT'][_ord % 4 + 1]"


@query(
    f"""{WITH}, s AS (SELECT _ord, 10 + CASE {GRADE} WHEN 'A' THEN 30 WHEN 'B' THEN 20 WHEN 'C' THEN 10 ELSE 0 END + CASE WHEN {SITE} IS NOT NULL THEN 15 ELSE 0 END
  + CASE WHEN len(regexp_extract_all(lower(context), '[a-z0-9._%+-]+@[a-z0-9.-]+\\.[a-z]{{2,}}')) > 0 THEN 15 ELSE 0 END + CASE WHEN {sql_any(TEXT, D.V10_TIER1)} THEN 10 ELSE 0 END AS v FROM leads)
SELECT _ord, v AS v4_score, CASE WHEN v >= 80 THEN 1 WHEN v >= 60 THEN 2 WHEN v >= 40 THEN 3 WHEN v >= 20 THEN 4 ELSE 5 END AS v4_tier FROM s"""
)
def m17_additive_tier(spark, sf):
    grade = F.element_at(F.array(*map(F.lit, ("A", "B", "C", "REJECT"))), (F.pmod("_ord", F.lit(4)) + 1).cast("int"))
    own = leads(spark, sf, contacts=True).withColumn("role", F.lit("UNKNOWN")).withColumn("entity_grade", grade)
    return more_scores.additive_tier(own).select("_ord", "v4_score", "v4_tier")


@query(f"{WITH} SELECT _ord, CASE country WHEN 'Turkey' THEN 100 WHEN 'Brazil' THEN 90 WHEN 'Egypt' THEN 70 ELSE 20 END AS potential FROM leads")
def m20_country_potential(spark, sf):
    return leads(spark, sf).select("_ord", more_scores.country_potential(F.col("country"), {"turkey": 100, "brazil": 90, "egypt": 70}).alias("potential"))


@query(
    "WITH u AS (SELECT user_id, max_by(event_type, ts) AS e, max_by(value, ts) AS v FROM (SELECT user_id, ts, value, CASE event_type WHEN 'purchase' THEN 'won' WHEN 'error' THEN 'lost' WHEN 'click' THEN 'contacted' END AS event_type FROM events) WHERE event_type IS NOT NULL GROUP BY user_id) "
    "SELECT c_custkey, coalesce(e, 'new') AS status, CASE WHEN e = 'lost' THEN 'price' END AS loss_reason FROM customer LEFT JOIN u ON u.user_id = c_custkey"
)
def m21_outcome(spark, sf):
    status = F.create_map(*[F.lit(x) for kv in (("purchase", "won"), ("error", "lost"), ("click", "contacted"), ("view", "seen")) for x in kv])
    updates = table(spark, sf, "events").select(F.col("user_id").alias("c_custkey"), F.try_element_at(status, F.col("event_type")).alias("status"), F.lit("price").alias("loss_reason"), F.col("ts").alias("at"))
    return more_scores.outcome(table(spark, sf, "customer").select("c_custkey"), updates, "c_custkey")


@query(
    f"""{WITH} SELECT _ord, CASE WHEN length(company) < 2 THEN 'too_short' WHEN length(company) > 100 THEN 'too_long' WHEN list_contains({sql_list(D.GATE_GENERIC)}, lower(company)) THEN 'generic' WHEN list_contains({sql_list(D.GATE_MENU)}, lower(company)) THEN 'menu'
  WHEN regexp_matches(company, '(?i)^(https?://|www\\.)') THEN 'url' WHEN contains(company, '@') THEN 'email' WHEN regexp_matches(company, '^\\d+$') THEN 'number' END AS v1_reason FROM leads"""
)
def f10_gate_v1(spark, sf):
    return more_scores.gate_v1(leads(spark, sf)).select("_ord", "v1_reason")


@query(f"{WITH} SELECT _ord, {sql_any('lower(context)', D.GATE_PARTS_SIGNALS)} OR regexp_matches(lower(company), '\\b(spare\\s*parts?|distributor|reseller|trading\\s*co)\\b') AS is_parts_supplier FROM leads")
def f12_parts_supplier(spark, sf):
    return leads(spark, sf).select("_ord", gates.is_parts_supplier(F.col("company"), F.col("context")).alias("is_parts_supplier"))


@query(f"{WITH}, w AS (SELECT _ord, {SITE} IS NULL AS need FROM leads), n AS (SELECT _ord, need, row_number() OVER (PARTITION BY need ORDER BY _ord) AS r FROM w) SELECT _ord, CASE WHEN NOT need THEN 'not_needed' WHEN r <= 40 THEN 'enriched' ELSE 'skipped' END AS enrichment_status FROM n")
def f21_capped_enrichment(spark, sf):
    """A run's cap on enrichment is the feature: the first 40 leads that need it, found as a top-k and joined back."""
    own = leads(spark, sf).select("_ord", gates.has_value("website").alias("has"))
    first = own.where("not has").orderBy("_ord").limit(40).select("_ord", F.lit(True).alias("first"))
    out = own.join(F.broadcast(first), "_ord", "left")
    return out.select("_ord", F.when(F.col("has"), "not_needed").when(F.col("first"), "enriched").otherwise("skipped").alias("enrichment_status"))


@query(f"{WITH} SELECT _ord, {SITE} IS NOT NULL AND NOT coalesce({sql_any(SITE_HOST, D.DOMAIN_BLOCKLIST)}, false) AS real_website FROM leads")
def f22_real_website(spark, sf):
    return leads(spark, sf).select("_ord", (gates.has_value("website") & ~blocked("website", D.DOMAIN_BLOCKLIST)).alias("real_website"))


@query(
    """SELECT page_id, CASE WHEN regexp_matches(lower(url), '(login|signin|admin|account|cart|checkout|password)') THEN 'blocked' WHEN regexp_matches(url, '^[a-z]+://[^/?#]*(/es/|/de/)') AND contains(url, 'example.net') THEN 'robots'
  WHEN regexp_matches(lower(url), '(member|director|exhibitor|compan|list|about|contact|/en/)') THEN 'allowed' ELSE 'unknown' END AS policy FROM pages"""
)
def f23_endpoint_policy(spark, sf):
    from siftlane.functions.web import host

    own = table(spark, sf, "pages")
    robots = own.select(host("url").alias("host")).distinct().where("host like '%example.net'").select("host", F.explode(F.array(F.lit("/es/"), F.lit("/de/"))).alias("path"))
    return more_scores.endpoint_policy(own.select("page_id", "url"), robots).select("page_id", "policy")


@query(f"{WITH} SELECT _ord, CASE WHEN score >= 60 THEN 1 WHEN {SITE} IS NOT NULL AND len(regexp_extract_all(lower(context), '[a-z0-9._%+-]+@[a-z0-9.-]+\\.[a-z]{{2,}}')) > 0 THEN 2 WHEN len(regexp_extract_all(lower(context), '[a-z0-9._%+-]+@[a-z0-9.-]+\\.[a-z]{{2,}}')) > 0 THEN 3 WHEN {SITE} IS NOT NULL THEN 4 ELSE 5 END AS priority FROM leads")
def k9_sales_priority(spark, sf):
    own = leads(spark, sf, contacts=True).withColumn("sales_ready", F.coalesce(F.col("score") >= 60, F.lit(False)))
    return O.sales_priority(own).select("_ord", "priority")


@query("SELECT c_custkey, coalesce(s, 'pending') AS status FROM customer LEFT JOIN (SELECT user_id, max_by(CASE event_type WHEN 'purchase' THEN 'approved' ELSE 'rejected' END, ts) AS s FROM events WHERE event_type IN ('purchase', 'error') GROUP BY user_id) ON user_id = c_custkey")
def k10_review_queue(spark, sf):
    own = table(spark, sf, "events").where("event_type in ('purchase', 'error')")
    decisions = own.select(F.col("user_id").alias("c_custkey"), F.when(F.col("event_type") == "purchase", "approved").otherwise("rejected").alias("status"), F.col("ts").alias("decided_at"))
    return sinks.decided(table(spark, sf, "customer").select("c_custkey"), decisions, "c_custkey")


@query("SELECT doc_id, array_to_string(list_filter(list_transform(regexp_split_to_array(source || ', ' || lang || ';' || doc_id, '[,;]'), lambda x: trim(x, ' ')), lambda x: x <> ''), '|') AS parts FROM documents")
def s02_parse_list(spark, sf):
    own = table(spark, sf, "documents")
    return own.select("doc_id", F.array_join(parse_list(F.concat("source", F.lit(", "), "lang", F.lit(";"), F.col("doc_id").cast("string"))), "|").alias("parts"))


LABELS = ("Th", "On", "And", "De", "La", "Der", "Les")


@query(f"SELECT doc_id, array_to_string(list_sort(list_filter({sql_list(LABELS)}, lambda k: contains(lower(text), lower(k)))), ',') AS mentions, CASE WHEN contains(lower(text), ' der ') THEN 'Germany' WHEN contains(lower(text), ' les ') THEN 'France' WHEN contains(lower(text), ' los ') THEN 'Spain' END AS country FROM documents")
def s16_s17_countries(spark, sf):
    own = table(spark, sf, "documents")
    return own.select("doc_id", F.array_join(extract.country_mentions(text_of("text"), LABELS), ",").alias("mentions"), extract.country_in(F.lower("text"), {"Germany": (" der ",), "France": (" les ",), "Spain": (" los ",)}).alias("country"))


@query("SELECT page_id, CASE WHEN ends_with(h, '.de') THEN 'Germany' END AS country FROM (SELECT page_id, regexp_extract(lower(url), '://([^/?#]*)', 1) AS h FROM pages)")
def s18_country_of_host(spark, sf):
    return table(spark, sf, "pages").select("page_id", extract.country_of_host(F.col("url")).alias("country"))


@query()
def s20_companies(spark, sf):
    """Companies named in the texts; held against samples in the tests."""
    return extract.companies(leads(spark, sf), "_ord")


@query(
    "SELECT host, array_to_string(list_sort(list_distinct(list(e))), ';') AS emails FROM (SELECT regexp_replace(regexp_extract(lower(url), '://([^/?#]*)', 1), '^www\\.', '') AS host, unnest(regexp_extract_all(html, '(?i)[A-Z0-9._%+-]+@[A-Z0-9.-]+\\.[A-Z]{2,}')) AS e FROM pages) GROUP BY host"
)
def h5_page_contacts(spark, sf):
    return extract.page_contacts(table(spark, sf, "pages")).select("host", F.array_join("emails", ";").alias("emails"))


@query(f"{WITH} SELECT country, count(*) AS n, count(DISTINCT source_type) AS n_sources FROM leads GROUP BY country")
def g2_distinct_sources(spark, sf):
    return leads(spark, sf).groupBy("country").agg(F.count("*").alias("n"), F.count_distinct("source_type").alias("n_sources"))


@query(f"{WITH} SELECT _ord, score FROM leads WHERE (score >= 40) AND {SITE} IS NOT NULL UNION ALL SELECT _ord, score FROM leads WHERE score >= 60 AND {SITE} IS NULL")
def f16_f17_export_pools(spark, sf):
    own = leads(spark, sf)
    return own.where(((F.col("score") >= 40) & gates.has_value("website")) | ((F.col("score") >= 60) & ~gates.has_value("website"))).select("_ord", "score")


@query(
    f"""{WITH}, m AS (SELECT list_distinct(regexp_extract_all(lower(context), '[a-z0-9._%+-]+@[a-z0-9.-]+\\.[a-z]{{2,}}')) AS ms, _ord, website FROM leads)
SELECT _ord, coalesce(nullif(website, ''), 'https://www.' || split_part(list_sort(ms)[1], '@', -1)) AS website FROM m"""
)
def s15_inferred_website(spark, sf):
    return extract.inferred_website(leads(spark, sf, contacts=True)).select("_ord", "website")


@query()
def lead_variants(spark, sf):
    """How many leads each stage list keeps; what the lists have in common runs once."""
    from siftlane.plans.pipelines import funnel, variants

    return funnel(variants(leads(spark, sf).drop("html")))


@query(f"SELECT {sql_list(COUNTRIES[:3])}[c_nationkey % 3 + 1] AS country, max(c_acctbal) AS top FROM customer GROUP BY 1")
def g12_best_of_each(spark, sf):
    country = F.element_at(F.array(*map(F.lit, COUNTRIES[:3])), (F.pmod(F.col("c_nationkey"), F.lit(3)) + 1).cast("int"))
    return table(spark, sf, "customer").groupBy(country.alias("country")).agg(F.max("c_acctbal").alias("top"))


@query(
    f"""{WITH}, e AS (SELECT _ord, CASE WHEN _ord % 7 = 0 THEN 'Monforts ' ELSE '' END || company AS company, ['CUSTOMER', 'INTERMEDIARY', 'BRAND', 'UNKNOWN'][_ord % 4 + 1] AS role, length(company) % 6 AS a, _ord // 4 % 10 AS b, length(context) % 10 AS c FROM leads)
SELECT _ord FROM e WHERE role NOT IN ('INTERMEDIARY', 'BRAND') AND NOT {sql_any("lower(company)", [x for x in D.GATE_OEM if len(x) > 4])} AND (a >= 4 OR (role = 'CUSTOMER' AND b >= 5 AND c >= 4))"""
)
def f18_sales_ready(spark, sf):
    """Leads of four roles, some with a maker's name, with evidence from the lengths of their texts."""
    role = F.element_at(F.array(*map(F.lit, ("CUSTOMER", "INTERMEDIARY", "BRAND", "UNKNOWN"))), (F.col("_ord") % 4 + 1).cast("int"))
    own = leads(spark, sf).withColumns({"role": role, "e1": F.length("company") % 6 / 10, "e2": F.floor(F.col("_ord") / 4) % 10 / 10, "e3": F.length("context") % 10 / 10})
    own = own.withColumn("company", F.concat(F.when(F.col("_ord") % 7 == 0, "Monforts ").otherwise(""), "company"))
    return more_scores.sales_ready(own).where("sales_ready").select("_ord")


PLACES = {"Germany": (" der ", " und "), "France": (" les ", " des "), "Spain": (" los ", " las ")}


@query(
    f"""{WITH}, b AS (SELECT _ord, CASE WHEN _ord % 2 = 0 THEN 'https://x.com' ELSE country END AS country, lower(' ' || context) AS t, CASE WHEN _ord % 3 = 0 THEN 'a@b.co' ELSE {SITE} END AS w FROM leads)
SELECT _ord, CASE WHEN country = 'https://x.com' THEN CASE WHEN {sql_any("t", PLACES["Germany"])} THEN 'Germany' WHEN {sql_any("t", PLACES["France"])} THEN 'France' WHEN {sql_any("t", PLACES["Spain"])} THEN 'Spain' END ELSE country END AS country,
  CASE WHEN contains(w, '@') OR NOT contains(w, '.') THEN NULL ELSE w END AS website FROM b"""
)
def f2_repaired(spark, sf):
    own = leads(spark, sf).withColumn("country", F.when(F.col("_ord") % 2 == 0, "https://x.com").otherwise(F.col("country"))).withColumn("website", F.when(F.col("_ord") % 3 == 0, "a@b.co").otherwise(F.col("website")))
    return gates.repaired(own, PLACES).select("_ord", "country", "website")


@query(
    f"""SELECT page_id, place, name, length(name) < 3 OR list_contains({sql_list(D.GATE_GENERIC)}, lower(name)) OR {sql_any("lower(name)", gates.NAVIGATION)} OR regexp_matches(lower(name), '^(view basket|add to cart|read more|home|about us|contact us)$') AS noise
FROM (SELECT page_id, trim(unnest(regexp_extract_all(html, '<li><a href="[^"]+">([^<]*)</a>', 1)), ' ') AS name, generate_subscripts(regexp_extract_all(html, '<li><a href="[^"]+">([^<]*)</a>', 1), 1) - 1 AS place FROM pages)"""
)
def f5_page_noise(spark, sf):
    found = F.posexplode(F.regexp_extract_all("html", F.lit('<li><a href="[^"]+">([^<]*)</a>'), F.lit(1))).alias("place", "name")
    own = table(spark, sf, "pages").select("page_id", found).select("page_id", F.col("place").cast("long").alias("place"), F.trim("name").alias("name"))
    return own.withColumn("noise", gates.is_page_noise(F.col("name")))


@query(f"{WITH} SELECT _ord FROM leads WHERE score >= 40")
def f19_at_least(spark, sf):
    own = leads(spark, sf).withColumn("sce_confidence", F.when(F.col("score") >= 60, "high").when(F.col("score") >= 40, "medium").otherwise("low"))
    return more_scores.at_least(own, "medium").select("_ord")


@query(f"{WITH} SELECT _ord FROM leads WHERE country IN ('Brazil', 'Peru', 'Chile', 'Colombia', 'Argentina', 'Ecuador') AND {SITE} IS NOT NULL AND NOT {sql_any(SITE_HOST, D.DOMAIN_BLOCKLIST)}")
def f24_targets(spark, sf):
    own = leads(spark, sf).withColumn("region", O.region_of(F.col("country")))
    return gates.target_filter(own, ["south_america"]).select("_ord")


@query(f"{WITH} SELECT _ord, CAST({SITE} IS NOT NULL AS INT) AS n_own, CAST({SITE} IS NOT NULL AND regexp_extract(lower(website), '://([^/?#]*)', 1) <> 'other.org' AS INT) AS n_external FROM leads")
def j12_evidence_hosts(spark, sf):
    item = lambda u: F.struct(u.alias("url"), F.lit("x").alias("type"))
    own = leads(spark, sf).withColumn("evidence_details", F.array(item(F.col("website")), item(F.lit("https://other.org/a"))))
    return gates.same_host_evidence(own).select("_ord", "n_own", "n_external")


@query(f"{WITH}, s AS (SELECT _ord, lower(company) AS n, lang FROM leads) SELECT n AS name, lang, min(_ord) AS _ord FROM s WHERE n <> '' GROUP BY ALL")
def d6_composite_key(spark, sf):
    from siftlane.operators.dedupe import first_seen

    own = leads(spark, sf).select("_ord", F.lower("company").alias("name"), "lang").where("name != ''")
    return first_seen(own, F.concat("name", F.lit("\x1f"), "lang"))


@query(f"{WITH} SELECT _ord, coalesce(CASE WHEN len(regexp_split_to_array(trim(p, ' '), '\\s+')) <= 5 AND trim(p, ' ') <> '' THEN trim(p, ' ') END, nullif(trim(w, ' '), '')) AS name FROM (SELECT _ord, regexp_split_to_array(company, '\\s+[|\\-–:»]\\s+')[1] AS p, regexp_extract(company, '^((?:[A-Z][\\w&.\\-]*\\s*){{1,3}})', 1) AS w FROM leads)")
def s22_title_names(spark, sf):
    return leads(spark, sf).select("_ord", extract.title_company(F.col("company")).alias("name"))


WORDS = ("the", "und", "les", "los", "token")


@query(
    f"""SELECT doc_id, CASE WHEN n_chars BETWEEN 50 AND 1000000 THEN least(50, {sql_hits("lower(text)", WORDS)} * 10) ELSE 0 END AS relevance FROM documents"""
)
def n4_relevance(spark, sf):
    t = F.lower("text")
    score = F.least(F.lit(50), hits(t, WORDS) * 10)
    return table(spark, sf, "documents").select("doc_id", F.when(F.col("n_chars").between(50, 1_000_000), score).otherwise(0).cast("long").alias("relevance"))


@query("SELECT s_name AS name, s_acctbal AS balance, NULL::VARCHAR AS segment FROM supplier UNION ALL SELECT c_name, c_acctbal, c_mktsegment FROM customer")
def u1_ragged_union(spark, sf):
    one = table(spark, sf, "supplier").select(F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    two = table(spark, sf, "customer").select(F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    return one.unionByName(two, allowMissingColumns=True).select("name", "balance", "segment")


@query("SELECT p_partkey, array_to_string(list_sort(list_distinct(list_concat(string_split(p_name, ' '), [p_type]))), ',') AS words FROM part")
def u2_set_union(spark, sf):
    return table(spark, sf, "part").select("p_partkey", F.array_join(F.array_sort(F.array_union(F.split("p_name", " "), F.array("p_type"))), ",").alias("words"))


@query(f"{WITH} SELECT _ord, rank() OVER (ORDER BY score DESC NULLS LAST) AS r FROM leads")
def w3_global_rank(spark, sf):
    """Rank over all leads: scores are few, so they are counted and ranked, and joined back to the leads."""
    return O.global_rank(leads(spark, sf).select("_ord", "score"), "score").select("_ord", F.col("rank").alias("r"))


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def t2_largest(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20)


@query(f"{WITH} SELECT source_type, country, n FROM (SELECT source_type, country, count(*) AS n FROM leads GROUP BY ROLLUP (source_type, country))")
def g13_rollup(spark, sf):
    return leads(spark, sf).rollup("source_type", "country").agg(F.count("*").alias("n"))
