"""Queries of contacts, extraction, exports, reports, sources and streams. Texts that the made leads lack are laid behind them."""

from __future__ import annotations

from pyspark.sql import functions as F

from siftlane import dictionaries as D
from siftlane.functions import text as T
from siftlane.functions import web as H
from siftlane.operators import extract, gates, more_scores, scores
from siftlane.operators import tables as O
from siftlane.plans.collected import query
from siftlane.plans.contacts import VOTES
from siftlane.plans.leads import COUNTRIES, LEADS_SQL, leads, sql_hits, sql_list
from siftlane.session import shared_path, table
from siftlane.sources import files, paged, sinks, workbooks
from siftlane.streaming import buckets, hosts
from siftlane.streaming.events import event_stream, first_of_repeats, sessions

WITH = "WITH " + LEADS_SQL


def laid(spark, sf, **parts):
    """Leads with text behind the context."""
    return leads(spark, sf).withColumn("context", F.concat("context", *parts.values()))


# --- contacts -----------------------------------------------------------------------------------------------------------------------------

MAILS = " Logo@2x.png Info@Acme.com info@ACME.com noreply@acme.com a@sentry.io, b@mail.net; Testing@x.org c."


@query(
    f"""{WITH}, m AS (SELECT _ord, context || '{MAILS}' || _ord || '@d.org' AS t FROM leads),
f AS (SELECT _ord, unnest(list_filter(regexp_extract_all(t, '[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\\.[a-zA-Z]{{2,}}'), lambda e: len(list_filter({sql_list((*T.MAIL_FILES, *T.MAIL_NO_DOMAINS))}, lambda x: contains(lower(e), x))) = 0
  AND len(list_filter({sql_list(T.MAIL_NO_PREFIXES)}, lambda x: starts_with(split_part(lower(e), '@', 1), x))) = 0)) AS e, generate_subscripts(list_filter(regexp_extract_all(t, '[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\\.[a-zA-Z]{{2,}}'), lambda e: len(list_filter({sql_list((*T.MAIL_FILES, *T.MAIL_NO_DOMAINS))}, lambda x: contains(lower(e), x))) = 0
  AND len(list_filter({sql_list(T.MAIL_NO_PREFIXES)}, lambda x: starts_with(split_part(lower(e), '@', 1), x))) = 0), 1) AS i FROM m),
d AS (SELECT _ord, arg_min(e, i) AS e, min(i) AS i FROM f GROUP BY _ord, lower(e))
SELECT _ord, string_agg(e, ';' ORDER BY i) AS emails FROM d GROUP BY _ord"""
)
def s07_company_emails(spark, sf):
    own = laid(spark, sf, mails=F.lit(MAILS), own=F.concat(F.col("_ord").cast("string"), F.lit("@d.org")))
    return own.select("_ord", F.array_join(T.company_emails("context"), ";").alias("emails"))


RAW_MAILS = (" <Sales@Mill.DE> ", "noreply@mill.de", "a@b@facebook.com", "'x@y'", "[q@r.io]", "", "@r.io", "a b@c.d")
PICK = f"({sql_list(RAW_MAILS)}[_ord % {len(RAW_MAILS)} + 1])"
RAW = f"regexp_replace(lower({PICK}), '^[\\s''\"<>\\[\\]]+|[\\s''\"<>\\[\\]]+$', '', 'g')"


@query(
    f"""{WITH}, m AS (SELECT _ord, {RAW} AS t FROM leads), p AS (SELECT _ord, t, regexp_extract(t, '^(.*)@([^@]*)$', 1) AS l, regexp_extract(t, '^(.*)@([^@]*)$', 2) AS d FROM m)
SELECT _ord, CASE WHEN contains(t, '@') AND contains(d, '.') AND NOT list_contains({sql_list(T.MAIL_NO_LOCALS)}, l) AND NOT list_contains({sql_list(T.MAIL_NO_HOSTS)}, d) AND length(l) >= 1 AND length(d) >= 3 THEN t END AS email FROM p"""
)
def s08_valid_emails(spark, sf):
    mail = F.element_at(F.array(*map(F.lit, RAW_MAILS)), (F.col("_ord") % len(RAW_MAILS) + 1).cast("int"))
    return leads(spark, sf).select("_ord", T.valid_email(mail).alias("email"))


CODES = {c.lower(): str(30 + i) for i, c in enumerate(COUNTRIES)}
CODE_SQL = "CASE lower(country) " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in CODES.items()) + " END"


@query(
    f"""{WITH}, c AS (SELECT _ord, CASE _ord % 4 WHEN 0 THEN 'a@gmail.com' WHEN 1 THEN 'info@example.org' WHEN 2 THEN 'x@sub.example.net' END AS mail, CASE _ord % 3 WHEN 0 THEN '+' || {CODE_SQL} || ' 555-1234' WHEN 1 THEN '+99 1' END AS phone, {CODE_SQL} AS code,
  regexp_replace(lower(coalesce(regexp_extract(website, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)', 1), '')), '^www\\.', '') AS site FROM leads),
f AS (SELECT _ord, coalesce(site <> '' AND ends_with(split_part(mail, '@', 2), site), false) AS same, coalesce(split_part(mail, '@', 2) = 'gmail.com', false) AS free, coalesce(starts_with(regexp_replace(phone, '[^0-9+]', '', 'g'), '+' || code), false) AS dial FROM c)
SELECT _ord, CASE WHEN same AND dial THEN 'high' WHEN same OR dial THEN 'medium' ELSE 'low' END AS contact_confidence, array_to_string(list_filter([CASE WHEN same THEN 'email_on_site' END, CASE WHEN free THEN 'free_provider' END, CASE WHEN dial THEN 'phone_in_country' END], lambda x: x IS NOT NULL), ',') AS notes FROM f"""
)
def j11_s41_contact_confidence(spark, sf):
    mail = F.when(F.col("_ord") % 4 == 0, "a@gmail.com").when(F.col("_ord") % 4 == 1, "info@example.org").when(F.col("_ord") % 4 == 2, "x@sub.example.net")
    codes = F.create_map(*[F.lit(x) for kv in CODES.items() for x in kv])
    dial = F.when(F.col("_ord") % 3 == 0, F.concat(F.lit("+"), F.element_at(codes, F.lower("country")), F.lit(" 555-1234"))).when(F.col("_ord") % 3 == 1, "+99 1")
    own = leads(spark, sf).withColumn("emails", F.array_compact(F.array(mail))).withColumn("phones", F.array_compact(F.array(dial)))
    return more_scores.contact_confidence(own, CODES).select("_ord", "contact_confidence", F.array_join("contact_notes", ",").alias("notes"))


@query(
    f"""{WITH} SELECT _ord, 'a' || _ord || '@b.co' AS email, 'a' || _ord || '@b.co; z@y.net' AS all_emails, CASE WHEN _ord % 2 = 0 THEN '5551234' ELSE '+49123456789' END AS phone FROM leads"""
)
def s43_consolidated(spark, sf):
    own = leads(spark, sf).select("_ord", F.concat(F.lit("none, A"), F.col("_ord").cast("string"), F.lit("@b.co; Z@y.net")).alias("m1"), F.array(F.lit("z@y.net")).alias("m2"), F.when(F.col("_ord") % 2 == 0, "12;555-1234").alias("p1"), F.lit("+49 (123) 456-789").alias("p2"))
    return more_scores.consolidated(own, ("m1", "m2"), ("p1", "p2")).select("_ord", "email", "all_emails", "phone")


@query("SELECT page_id, CASE page_id % 3 WHEN 0 THEN url ELSE 'https://' || regexp_replace(url, '^[a-z]+://', '') END AS repaired FROM pages")
def s14_repaired_urls(spark, sf):
    """Addresses of all pages, as they are, without their scheme, and so with spaces around them."""
    bare = F.regexp_replace("url", "^[a-z]+://", "")
    raw = F.when(F.col("page_id") % 3 == 0, F.col("url")).when(F.col("page_id") % 3 == 1, bare).otherwise(F.concat(F.lit("  "), bare, F.lit(" ")))
    return table(spark, sf, "pages").select("page_id", H.with_scheme(raw).alias("repaired"))


# --- extraction ---------------------------------------------------------------------------------------------------------------------------

NAMES = (" by Acme Mills Ltd and Örnek Tekstil A.Ş.", " from Brandt Weberei GmbH", " at Vicunha Textil Ltda", " with the Nile Dyeing works", "")
NAME_PICK = f"({sql_list(NAMES)}[_ord % {len(NAMES)} + 1])"
LEGAL_SQL = " || ".join("regexp_extract_all(t, '{}', 1)".format(p.replace("'", "''")) for p in extract.LEGAL_PATTERNS)


@query(
    f"""{WITH}, m AS (SELECT _ord, context || {NAME_PICK} AS t FROM leads), f AS (SELECT _ord, list_filter(list_transform({LEGAL_SQL}, lambda n: trim(n, ' ')), lambda n: length(n) > 3) AS a FROM m)
SELECT _ord, array_to_string(list_filter(a, lambda n, i: list_position(list_transform(a, lambda y: lower(y)), lower(n)) = i), '|') AS names FROM f"""
)
def s21_legal_names(spark, sf):
    """Names by legal forms in whole texts."""
    own = leads(spark, sf).select("_ord", F.concat("context", F.element_at(F.array(*map(F.lit, NAMES)), (F.col("_ord") % len(NAMES) + 1).cast("int"))).alias("t"))
    return own.select("_ord", F.array_join(extract.legal_names(F.col("t")), "|").alias("names"))


MENTIONED = (
    ", Acme Mills Ltd in Brazil has installed a new stenter line.",
    ", delivered to the Nile Dyeing Group in Egypt last year.",
    ", installed at Delta Finishing SA's plant near Cairo, Egypt.",
    ", Korteks Tekstil AS has ordered two Montex ranges.",
    ", Customer: Vicunha Textil",
    ', a good step, says Ana Silva, Director at Santana Textiles',
    ", Monforts has ordered nothing. The good people that are the best have it in Peru has installed",
    "",
)


def mentioning(spark, sf):
    own = leads(spark, sf)
    return own.select("_ord", F.concat("context", F.element_at(F.array(*map(F.lit, MENTIONED)), (F.col("_ord") % len(MENTIONED) + 1).cast("int"))).alias("context"))


@query()
def s23_mentions(spark, sf):
    """Customers that texts tell of; the tests hold every row against plain code over the whole table."""
    return extract.mentions(mentioning(spark, sf), "_ord", "context", brand="Monforts")


@query(
    f"""{WITH} SELECT _ord, CASE _ord % 8 WHEN 0 THEN 'Acme Mills Ltd' WHEN 3 THEN 'Korteks Tekstil AS' ELSE 'Monforts' END AS company, CASE _ord % 8 WHEN 0 THEN 'Brazil' END AS country, CASE _ord % 8 WHEN 0 THEN 'installed' ELSE 'ordered' END AS event FROM leads WHERE _ord % 8 IN (0, 3, 6) UNION ALL SELECT _ord, 'Peru', NULL, 'installed' FROM leads WHERE _ord % 8 = 6"""
)
def s23_purchases(spark, sf):
    """Purchases that sentences tell of; the made texts tell of none but those laid behind them."""
    own = mentioning(spark, sf)
    return extract.purchases(own, "_ord", "context").select("_ord", "company", "country", "event")


LANG_SQL = "CASE WHEN greatest({0}) = 0 THEN 'unknown' {1} END".format(", ".join(sql_hits("t", w) for w in VOTES.values()), " ".join(f"WHEN {sql_hits('t', w)} = greatest({', '.join(sql_hits('t', x) for x in VOTES.values())}) THEN '{k}'" for k, w in VOTES.items()))


@query(
    f"""{WITH}, m AS (SELECT _ord, lower(company || ' ' || context) AS t FROM leads), k AS (SELECT _ord, {sql_hits("t", D.SIGNAL_FINISHING)} AS f, {sql_hits("t", D.V10_TIER1)} AS a, {sql_hits("t", D.V10_TIER2)} AS b, {LANG_SQL} AS kw_language FROM m)
SELECT _ord, kw_language, CAST(least(90, least(50, f * 10) + a * 15 + b * 10) + CASE WHEN kw_language <> 'unknown' THEN 10 ELSE 0 END AS DOUBLE) AS kw_relevance_score, CAST(f + a + b AS BIGINT) AS kw_keyword_count FROM k"""
)
def s32_text_relevance(spark, sf):
    return scores.text_relevance(leads(spark, sf), VOTES).select("_ord", "kw_language", "kw_relevance_score", F.col("kw_keyword_count").cast("long").alias("kw_keyword_count"))


RESULT_SQL = " + ".join(f"CASE WHEN contains(t, '{w}') OR contains(u, '{w}') THEN {n} ELSE 0 END" for w, n in extract.RESULT_POINTS) + "".join(f" - CASE WHEN contains(u, '{w}') THEN 5 ELSE 0 END" for w in extract.RESULT_NOT)


@query(f"{WITH}, r AS (SELECT _ord, lower(company || ' ' || context || ' in ' || country) AS t, lower(coalesce(website, '')) || CASE _ord % 5 WHEN 0 THEN '/blog/members' WHEN 1 THEN '/exhibitor-list' ELSE '' END AS u, lower(country) AS c FROM leads) SELECT _ord, CAST({RESULT_SQL} + CASE WHEN contains(t, c) THEN 2 ELSE 0 END AS BIGINT) AS result_score FROM r")
def s38_result_relevance(spark, sf):
    url = F.concat(F.coalesce("website", F.lit("")), F.when(F.col("_ord") % 5 == 0, "/blog/members").when(F.col("_ord") % 5 == 1, "/exhibitor-list").otherwise(""))
    own = leads(spark, sf).select("_ord", F.col("company").alias("title"), F.concat("context", F.lit(" in "), "country").alias("description"), url.alias("url"), "country")
    return extract.result_relevance(own).select("_ord", F.col("result_score").cast("long").alias("result_score"))


@query("SELECT s_suppkey AS id, s_name AS company, 'info' || s_suppkey || '@mill.de' AS email, 'Street ' || s_nationkey || ', Town' AS address FROM supplier")
def a15_profiles(spark, sf):
    text = F.concat(F.lit("Profile\n"), "s_name", F.lit("\n\nStreet "), F.col("s_nationkey").cast("string"), F.lit("\nTown\nEmail: info"), F.col("s_suppkey").cast("string"), F.lit("@mill.de\nother"))
    return extract.profiles(table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), text.alias("t")), "id", "t")


@query("SELECT s_suppkey AS _ord, 'https://supplier' || s_suppkey || '.com' AS website, 7 AS score FROM supplier")
def a16_d11_s37_best_website(spark, sf):
    """Sitemap locations of each company, the best of them as its website: a blocked one, one of its name, another."""
    own = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("_ord"), F.concat(F.lit("Supplier"), F.col("s_suppkey").cast("string")).alias("company"), F.lit("Brazil").alias("country"))
    loc = lambda *x: F.concat(F.lit("<url><loc>"), *x, F.lit("</loc></url>"))
    xml = own.select("_ord", F.concat(loc(F.lit("https://facebook.com/"), F.lower("company")), loc(F.lit("https://"), F.lower("company"), F.lit(".com/about")), loc(F.lit("https://unrelated-place-name.com/"))).alias("xml"))
    found = files.sitemap_locations(xml).select("_ord", F.col("place").alias("rank"), F.col("loc").alias("url"), F.lit("").alias("title"), F.concat(F.lit("about "), "loc").alias("description"))
    return extract.best_website(own, found).select("_ord", "website", F.col("website_score").cast("int").alias("score"))


@query("SELECT page_id, 'Org ' || page_id AS name, 'o' || page_id || '@x.de' AS email, NULL::VARCHAR AS telephone, 'https://a.b/' || page_id AS same FROM pages")
def h3_organisations(spark, sf):
    block = F.concat(F.lit('<script type="application/ld+json">{"@type": "Organization", "name": "Org '), F.col("page_id").cast("string"), F.lit('", "email": "o'), F.col("page_id").cast("string"), F.lit('@x.de", "contactPoint": {"telephone": "1"}, "sameAs": ["https://a.b/'), F.col("page_id").cast("string"), F.lit('"]}</script>'))
    own = table(spark, sf, "pages").select("page_id", H.organisation(F.concat(block, "html")).alias("o"))
    return own.select("page_id", "o.name", "o.email", "o.telephone", F.array_join("o.sameAs", ",").alias("same"))


TH = "regexp_extract_all(html, '(?is)<th\\b[^>]*>(.*?)</th>', 1)"
PAGE_SQL = "SELECT page_id, html || CASE page_id % 3 WHEN 0 THEN '<table><tr><th>Company</th><th>Country <b>code</b></th><th>x</th></tr></table>' WHEN 1 THEN '<div class=\"card a\"></div><div class=\"card a\"></div><li class=\"card a\"></li>' ELSE '<ul><li>1<li>2<li>3<li>4<li>5<li>6</ul>' END AS html FROM pages"


@query(
    f"""WITH p AS ({PAGE_SQL}), t AS (SELECT page_id, len({TH}) AS n, list_filter({sql_list(files.TABLE_HEADS)}, lambda w: len(list_filter({TH}, lambda c: contains(lower(regexp_replace(c, '<[^>]*>', ' ', 'g')), w))) > 0) AS h FROM p)
SELECT page_id, 'table' AS kind, array_to_string(h, ',') AS name, n FROM t WHERE len(h) >= 2
UNION ALL SELECT page_id, 'card', c, count(*) FROM (SELECT page_id, unnest(regexp_extract_all(html, '(?i)<(?:div|article|li|section)\\b[^>]*\\bclass="([^"]+)"', 1)) AS c FROM p) GROUP BY page_id, c HAVING count(*) >= 3
UNION ALL SELECT page_id, 'list', 'li', n FROM (SELECT page_id, len(regexp_extract_all(l, '(?i)<li\\b')) AS n FROM (SELECT page_id, unnest(regexp_extract_all(html, '(?is)<[uo]l\\b[^>]*>.*?</[uo]l>')) AS l FROM p)) WHERE n > 5"""
)
def h4_repeated_structures(spark, sf):
    more = F.when(F.col("page_id") % 3 == 0, "<table><tr><th>Company</th><th>Country <b>code</b></th><th>x</th></tr></table>").when(F.col("page_id") % 3 == 1, '<div class="card a"></div><div class="card a"></div><li class="card a"></li>').otherwise("<ul><li>1<li>2<li>3<li>4<li>5<li>6</ul>")
    return files.repeated_structures(table(spark, sf, "pages").select("page_id", F.concat("html", more).alias("html")), "page_id")


# --- sources ------------------------------------------------------------------------------------------------------------------------------


def customer_answers(spark, sf):
    """Customers as a paged service's answers, eight pages a nation. Some pages tell a total that has fallen, some none, some are empty."""
    own, page = table(spark, sf, "customer").withColumn("page", F.col("c_custkey") % 8), F.col("page")
    item = F.struct(F.when(F.col("c_custkey") % 9 == 0, F.concat("c_name", F.lit(" (Withdrawn)"))).otherwise(F.col("c_name")).alias("company_name"), F.lit("X").alias("country"), F.col("c_acctbal").cast("string").alias("product_category"))
    void = (F.col("c_nationkey") + page) % 13 == 12
    paged = own.groupBy("c_nationkey", "page").agg(F.sort_array(F.collect_list(F.when(~void, item))).alias("items"))
    total = F.when((F.col("c_nationkey") * 3 + page) % 7 == 6, page * 100 - 50).otherwise(1_000_000)
    body = F.when(page % 3 == 1, F.to_json(F.struct("items"))).otherwise(F.to_json(F.struct(total.alias("total"), "items")))
    return paged.select(F.col("c_nationkey").cast("string").alias("country"), (page * 100).alias("offset"), body.alias("body"))


PAGED_SQL = """p AS (SELECT c_nationkey AS k, c_custkey % 8 * 100 AS o, CASE WHEN (c_nationkey + c_custkey % 8) % 13 = 12 THEN 0 ELSE count(*) END AS n,
  CASE WHEN c_custkey % 8 % 3 = 1 THEN NULL WHEN (c_nationkey * 3 + c_custkey % 8) % 7 = 6 THEN c_custkey % 8 * 100 - 50 ELSE 1000000 END AS t FROM customer GROUP BY c_nationkey, c_custkey % 8),
b AS (SELECT *, last_value(t IGNORE NULLS) OVER (PARTITION BY k ORDER BY o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS told FROM p), e AS (SELECT k, min(o) AS o FROM b WHERE n = 0 OR o >= told GROUP BY k)"""


@query(
    f"""WITH {PAGED_SQL} SELECT CAST(c_nationkey AS VARCHAR) AS country, c_name AS company, 'X' AS item_country, 'gots' AS source_type,
  'GOTS certified supplier. Product category: ' || CAST(c_acctbal AS VARCHAR) || '. Country: X. Brands: .' AS context
FROM customer LEFT JOIN e ON k = c_nationkey WHERE c_custkey % 9 <> 0 AND c_custkey % 8 * 100 < coalesce(o, 1000000)"""
)
def a10_a11_paged_service(spark, sf):
    """Answers kept as files and read page by page, as their running totals say."""
    path = shared_path(spark, "answers")
    paged.keep_answers(customer_answers(spark, sf), path, key="country")
    answers = paged.read_answers(spark, path, key="country", pages=3)
    return files.listed_companies(files.paged_items(answers, "company_name string, country string, product_category string, brand_names string"), "gots")


@query("SELECT CAST(c_nationkey AS VARCHAR) AS country, c_custkey % 8 * 100 AS offset, CASE WHEN (c_nationkey + c_custkey % 8) % 13 = 12 THEN 0 ELSE count(*) END AS n FROM customer WHERE c_nationkey IN (3, 7) GROUP BY c_nationkey, c_custkey % 8")
def a10_streamed_pages(spark, sf):
    """Answers of two keys as a stream, of which the later pages come after the first batch."""
    path, answers = shared_path(spark, "answers"), customer_answers(spark, sf)
    stream = lambda: paged.stream_answers(spark, f"{path}/in", key="country", keys=(3, 7)).writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/at")
    for half in ("offset < 400", "offset >= 400"):
        paged.keep_answers(answers.where(half), f"{path}/in", key="country")
        run = stream().start()
        run.processAllAvailable()
        run.stop()
    items = F.from_json(F.get_json_object("body", "$.items"), "array<string>")
    return spark.read.parquet(f"{path}/out").select("country", "offset", F.size(items).cast("long").alias("n"))


@query("SELECT s_suppkey AS id, s_name AS company, CASE WHEN s_suppkey % 4 = 3 THEN 'n' || s_suppkey || '@x.de' END AS email FROM supplier WHERE s_suppkey % 5 <> 4")
def n1_n3_nested_companies(spark, sf):
    """Payloads with a company list under a known key, two or three levels down, too deep, or a list of something else."""
    name, i = F.concat(F.lit('{"name": "'), "s_name", F.lit('"'), F.when(F.col("s_suppkey") % 4 == 3, F.concat(F.lit(', "text": "write to n'), F.col("s_suppkey").cast("string"), F.lit('@x.de"'))).otherwise(""), F.lit("}")), F.col("s_suppkey") % 5
    wrap = lambda a, b: F.concat(F.lit(a), name, F.lit(b))
    body = F.when(i == 0, wrap('{"total": 1, "members": [', "]}")).when(i == 1, wrap('{"a": {"b": [', ']}, "data": [], "other": [{"k": 1}]}'))
    body = body.when(i == 2, wrap('{"a": {"b": {"c": [', "]}}}")).when(i == 3, wrap("[", "]")).otherwise(wrap('{"a": {"b": {"c": {"d": [', "]}}}}"))
    items = files.company_items(table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), body.alias("body")), "id", "body")
    return files.item_fields(items, "id", {"company": ("company", "name"), "email": ("email", "mail")})


@query("SELECT s_suppkey AS id, 1 AS row, s_name AS company, CAST(s_nationkey AS VARCHAR) AS country FROM supplier")
def a8_table_records(spark, sf):
    """Tables as a page of a catalogue gives them: a title, a header in its own words, a record."""
    own = table(spark, sf, "supplier")
    cells = lambda *x: F.array(*[F.lit(c) if isinstance(c, str) else c for c in x])
    rows = F.array(cells("Hall plan", ""), cells("Exhibitor", "Nation"), cells(F.col("s_name"), F.col("s_nationkey").cast("string")))
    got = files.table_records(own.select(F.col("s_suppkey").alias("id"), rows.alias("rows")))
    return got.select("id", (F.col("row") + 1).alias("row"), F.col("record")["company"].alias("company"), F.col("record")["country"].alias("country"))


# --- sinks: written to the shared folder and read again ------------------------------------------------------------------------------------

PART_SCHEMA = "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"


@query("SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def a1_a3_k1_csv(spark, sf):
    path = shared_path(spark, "csv")
    sinks.write_csv(table(spark, sf, "part"), path)
    return files.read_csv(spark, path, PART_SCHEMA)


@query("SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY o_orderstatus")
def k3_partitioned(spark, sf):
    path = shared_path(spark, "by-status")
    sinks.write_partitioned(table(spark, sf, "orders"), path, "o_orderstatus")
    return spark.read.parquet(path).groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("SELECT event_type, count(*) * 2 AS n FROM events GROUP BY event_type")
def k7_appended_log(spark, sf):
    path = shared_path(spark, "log")
    for _ in range(2):
        sinks.append_log(table(spark, sf, "events").select("event_id", "event_type"), path)
    return spark.read.parquet(path).groupBy("event_type").agg(F.count("*").alias("n"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'NEW' ELSE c_mktsegment END AS c_mktsegment FROM customer")
def k2_replaced_table(spark, sf):
    """A table replaced, then appended to by those whose rows were changed."""
    path = shared_path(spark, "table")
    own = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    sinks.replace_table(own.where("c_custkey % 7 = 1"), path)
    sinks.replace_table(own.where("c_custkey % 3 != 0"), path)
    sinks.append_log(own.where("c_custkey % 3 = 0").withColumn("c_mktsegment", F.lit("NEW")), path)
    return spark.read.parquet(path)


@query(
    f"""{WITH} SELECT 'targets_master' AS kind, _ord, NULL::VARCHAR AS query FROM leads UNION ALL SELECT * FROM (SELECT 'top100', _ord, NULL FROM leads ORDER BY score DESC NULLS LAST, _ord LIMIT 100)
UNION ALL SELECT 'linkedin_xray_queries', _ord, 'site:linkedin.com/in "' || company || '" ("textile" OR "finishing" OR "dyeing" OR "stenter")' FROM leads WHERE company <> ''"""
)
def k4_target_exports(spark, sf):
    out = None
    for kind, df in O.target_exports(leads(spark, sf)).items():
        own = df.select(F.lit(kind).alias("kind"), "_ord", F.col("query") if "query" in df.columns else F.lit(None).cast("string").alias("query"))
        out = own if out is None else out.unionByName(own)
    return out


def golden_leads(spark, sf):
    at = lambda n, i, v: F.when(F.col("_ord") % n == i, v)
    none = F.array().cast("array<string>")
    return leads(spark, sf).select(
        "_ord", "company", "country", "website", F.coalesce(at(5, 0, "Monforts"), at(5, 1, "Brückner"), at(5, 2, "Krantz")).alias("oem_brand"), at(7, 3, "job_posting").alias("evidence_type"),
        F.coalesce(at(2, 0, F.array(F.lit("ram"), F.lit("stenter"), F.lit("x"))), none).alias("stenter_signals"), F.coalesce(at(3, 0, F.array(F.lit("dyeing"))), none).alias("finishing_signals"),
        F.array(F.col("context")).alias("evidence_snippets"), F.coalesce(at(2, 1, F.array(F.concat(F.lit("m@"), F.col("_ord").cast("string")))), none).alias("emails_extracted"), F.col("score").alias("final_score"), F.col("source_type").alias("source"),
    )


@query(
    f"""{WITH}, g AS (SELECT *, CASE _ord % 5 WHEN 0 THEN 'Monforts' WHEN 1 THEN 'Brückner' WHEN 2 THEN 'Krantz' ELSE '' END AS b FROM leads)
SELECT _ord, company, country, website, CASE WHEN b <> '' THEN b || '{O.WHY_BRAND}' WHEN _ord % 7 = 3 THEN '{O.WHY_JOB}' WHEN _ord % 2 = 0 THEN '{O.WHY_SIGNALS[0]}ram, stenter{O.WHY_SIGNALS[1]}' WHEN _ord % 3 = 0 THEN '{O.WHY_SIGNALS[0]}dyeing{O.WHY_SIGNALS[1]}' ELSE '{O.WHY_ELSE}' END AS why_customer,
  '' AS evidence_url, substr(context, 1, 200) AS evidence_snippet, '' AS target_product, '8451.90' AS hs_code, CASE WHEN _ord % 2 = 1 THEN 'm@' || _ord ELSE '' END AS best_email, '' AS phone, NULL::VARCHAR AS linkedin_xray, NULL::VARCHAR AS contact_person, NULL::VARCHAR AS contact_role,
  CASE WHEN b = 'Monforts' THEN '{O.ANGLE_BRANDS["Monforts"]}' WHEN b = 'Brückner' THEN '{O.ANGLE_BRANDS["Brückner"]}' WHEN lower(country) IN ('brazil', 'argentina') THEN '{O.ANGLE_COUNTRIES["brazil"]}' WHEN lower(country) IN ('turkey', 'türkiye') THEN '{O.ANGLE_COUNTRIES["turkey"]}' ELSE '{O.ANGLE_ELSE}' END AS sales_angle,
  score AS final_score, NULL::DOUBLE AS evidence_score, NULL::DOUBLE AS contactability_score, NULL::INT AS tier, NULL::BOOLEAN AS is_golden, source_type AS source FROM g"""
)
def k6_golden_records(spark, sf):
    return O.golden_records(golden_leads(spark, sf), keys=("_ord",))


SITE = "nullif(trim(coalesce(website, ''), ' '), '') IS NOT NULL"


def reported(spark, sf):
    own = leads(spark, sf).withColumn("emails", F.when(F.col("_ord") % 4 == 0, F.array(F.lit("a@b.c"))).otherwise(F.array().cast("array<string>")))
    own = own.withColumn("role", F.when(F.col("_ord") % 3 == 0, "CUSTOMER").when(F.col("_ord") % 3 == 1, "BRAND")).withColumn("e1", (F.col("_ord") % 5) / 10)
    return own.withColumn("e2", F.col("e1") / 2).withColumn("e3", F.lit(0.25)).withColumn("sce_ready", F.col("score") >= 60).withColumn("sce_confidence", F.when(F.col("_ord") % 2 == 0, "high").otherwise("low"))


@query(
    f"""{WITH} SELECT count(*) AS n, round(avg(CAST({SITE} AS INT)), 6) AS website_coverage, round(avg(CAST(_ord % 4 = 0 AS INT)), 6) AS email_coverage, 0.0::DOUBLE AS phone_coverage, round(avg(CAST(_ord % 3 = 0 AS INT)), 6) AS precision_estimate,
  round(avg(coalesce(CAST(score >= 60 AS INT), 0)), 6) AS sales_ready_ratio, round(avg((_ord % 5) / 10), 3) AS avg_e1, round(avg((_ord % 5) / 10 / 2), 3) AS avg_e2, 0.25::DOUBLE AS avg_e3, count(DISTINCT country) AS n_countries,
  count(*) FILTER (country IN ('Brazil', 'Argentina', 'Colombia', 'Peru', 'Ecuador', 'Chile')) AS n_south_america, count(DISTINCT source_type) AS n_sources FROM leads"""
)
def g5_quality_report(spark, sf):
    got = O.quality_report(reported(spark, sf)).drop("recommendations")
    return got.select(*[F.round(c, 6).alias(c) if c.endswith(("coverage", "estimate", "ratio")) else F.col(c) for c in got.columns])


@query(
    f"""{WITH}, v AS (SELECT 'country' AS "column", country AS value FROM leads UNION ALL SELECT 'source_type', source_type FROM leads UNION ALL SELECT 'role', CASE _ord % 3 WHEN 0 THEN 'CUSTOMER' WHEN 1 THEN 'BRAND' ELSE 'Unknown' END FROM leads
  UNION ALL SELECT 'sce_confidence', CASE _ord % 2 WHEN 0 THEN 'high' ELSE 'low' END FROM leads), c AS (SELECT "column", value, count(*) AS n FROM v GROUP BY ALL)
SELECT "column", value, n FROM c QUALIFY row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value) <= 20"""
)
def g5_distributions(spark, sf):
    return O.distributions(reported(spark, sf))


# --- joins, limits, streams ---------------------------------------------------------------------------------------------------------------


@query(f"{WITH} SELECT _ord FROM leads WHERE company NOT IN (SELECT company FROM leads WHERE score >= 60)")
def j8_not_yet_validated(spark, sf):
    own = leads(spark, sf)
    return O.unseen(own, own.where("score >= 60"), "company").select("_ord")


ISO3 = {c: (c[:2] + c[-1]).upper() for c in COUNTRIES}
ISO3_SQL = "CASE country " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in ISO3.items()) + " END"


@query(f"{WITH}, f AS (SELECT c_nationkey, sum(o_totalprice) AS v FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1), i AS (SELECT {sql_list(ISO3.values())}[c_nationkey % {len(ISO3)} + 1] AS iso3, sum(v) AS v FROM f GROUP BY 1) SELECT _ord, round(least(20.0::DOUBLE, coalesce(v, 0) / (SELECT max(v) FROM i) * 20), 4) AS import_score FROM leads LEFT JOIN i ON iso3 = {ISO3_SQL}")
def j10_trade_priority(spark, sf):
    """Import points by the country's three-letter code."""
    codes = F.create_map(*[F.lit(x) for kv in ISO3.items() for x in kv])
    own = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    code = F.element_at(F.array(*map(F.lit, ISO3.values())), (F.pmod("c_nationkey", F.lit(len(ISO3))) + 1).cast("int"))
    priority = own.groupBy(code.alias("iso3")).agg(F.sum("o_totalprice").alias("import_value"))
    got = scores.trade_points(leads(spark, sf).withColumn("iso3", F.try_element_at(codes, F.col("country"))), priority)
    return got.select("_ord", F.round("import_score", 4).alias("import_score"))


@query(f"{WITH} SELECT _ord, company FROM leads ORDER BY _ord LIMIT 25")
def t4_first_rows(spark, sf):
    return leads(spark, sf).select("_ord", "company").orderBy("_ord").limit(25)


@query("SELECT 1 - (SELECT count(*) FROM (SELECT DISTINCT c_mktsegment, c_nationkey FROM customer)) / count(*) AS duplicate_rate FROM customer")
def d12_duplicate_rate(spark, sf):
    own = table(spark, sf, "customer").select(F.col("c_mktsegment").alias("company"), F.col("c_nationkey").alias("country"), F.lit("x").alias("website"))
    return gates.contract_report(own).select(F.col("duplicate_rate").cast("double").alias("duplicate_rate"))


@query(
    """WITH g AS (SELECT user_id, ts, CASE WHEN ts >= lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 30 MINUTE OR lag(ts) OVER (PARTITION BY user_id ORDER BY ts) IS NULL THEN 1 ELSE 0 END AS new FROM events WHERE ts IS NOT NULL),
s AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts) AS k FROM g) SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 30 MINUTE AS "end", count(*) AS n FROM s GROUP BY user_id, k"""
)
def stream_sessions(spark, sf):
    return sessions(table(spark, sf, "events"))


@query("SELECT user_id, event_type, count(*) AS n FROM (SELECT DISTINCT user_id, event_type FROM events) GROUP BY ALL")
def stream_repeats(spark, sf):
    """A stream of the table's rows, each user and type of event once."""
    path, name = shared_path(spark, "stream"), f"repeats_{shared_path(spark, 'q')[-12:]}"
    table(spark, sf, "events").select("user_id", "event_type", F.lit("2024-01-01").cast("timestamp").alias("ts")).repartition(8).write.parquet(f"{path}/in")
    stream = first_of_repeats(event_stream(spark, f"{path}/in", "user_id long, event_type string, ts timestamp", files_a_batch=4), ["user_id", "event_type"])
    stream.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/at").queryName(name).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{path}/out").groupBy("user_id", "event_type").agg(F.count("*").alias("n"))


@query("SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id FROM events GROUP BY user_id")
def stream_upserts(spark, sf):
    """The newest event of each user, put into a table of buckets batch by batch, each by many tasks."""
    path = shared_path(spark, "upserts")
    own = table(spark, sf, "events").select("user_id", "event_id", F.struct("ts", "event_id").alias("at"), "ts")
    for i in range(2):
        own.where(F.col("event_id") % 2 == i).repartition(4).write.parquet(f"{path}/in/{i}")
    stream = event_stream(spark, f"{path}/in/*", own.schema, files_a_batch=4)
    buckets.upsert_buckets(stream, f"{path}/out", "user_id", f"{path}/at", order="at", buckets=16).awaitTermination()
    return buckets.read_buckets(spark, f"{path}/out", own.schema).select("user_id", "event_id")


#: Each user may send two requests, and gets one back in six hours.
PACE, BURST = 6 * 3600, 2


@query(
    f"""WITH RECURSIVE e AS (SELECT user_id, event_id, epoch_us(ts) // 1000 AS ms, row_number() OVER (PARTITION BY user_id ORDER BY epoch_us(ts) // 1000, event_id) AS k FROM events),
w AS (SELECT user_id, event_id, k, ms, {1000 * PACE * (BURST - 1)}::BIGINT AS left_ms, true AS goes FROM e WHERE k = 1 UNION ALL
  SELECT e.user_id, e.event_id, e.k, e.ms, t - CASE WHEN t >= {1000 * PACE} THEN {1000 * PACE} ELSE 0 END, t >= {1000 * PACE} FROM w JOIN e ON e.user_id = w.user_id AND e.k = w.k + 1, LATERAL (SELECT least({1000 * PACE * BURST}, w.left_ms + e.ms - w.ms) AS t))
SELECT CAST(user_id AS VARCHAR) AS host, event_id AS id, CASE WHEN goes THEN 'go' ELSE 'wait' END AS verdict, left_ms FROM w"""
)
def stream_paced_hosts(spark, sf):
    """A replay of the events in four batches of time, each user's paced by a bucket of tokens whose state goes when they are quiet."""
    path, own = shared_path(spark, "paced"), table(spark, sf, "events").select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"))
    day = F.dayofmonth("ts")
    for k, (a, b) in enumerate(((1, 8), (8, 15), (15, 23), (23, 32))):
        own.where((day >= a) & (day < b)).repartition(4).write.parquet(f"{path}/in/{k}")  # four files are a batch; Spark takes the oldest first
    hosts.state_store(spark)
    stream = hosts.paced(event_stream(spark, f"{path}/in/*", own.schema, files_a_batch=4), host="user_id", ident="event_id", interval_s=PACE, burst=BURST, keep_s=3 * 24 * 3600)
    stream.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/at").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{path}/out").select("host", "id", "verdict", "left_ms")


# --- further scans and names ----------------------------------------------------------------------------------------------------------------


@query("SELECT 'm' || c_nationkey % 5 || '.xlsx' AS file, c_name AS company, CAST(c_nationkey AS VARCHAR) AS country, c_mktsegment AS category, '' AS website FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') AND c_nationkey <> 7")
def a5_member_lists(spark, sf):
    """The customers as five workbooks that tasks write, with a title and a header in the directory's words, read by rows; two categories count."""
    own, path = table(spark, sf, "customer"), shared_path(spark, "members")
    cells = F.array("c_name", F.col("c_nationkey").cast("string"), "c_mktsegment")
    rows = own.select(F.concat(F.lit("m"), F.col("c_nationkey") % 5, F.lit(".xlsx")).alias("file"), F.col("c_custkey").alias("row"), cells.alias("cells"))
    head = lambda row, *x: rows.select("file").distinct().select("file", F.lit(row).cast("long").alias("row"), F.array(*map(F.lit, x)).alias("cells"))
    every = rows.unionByName(head(-2, "List of members", None, None)).unionByName(head(-1, "Member name", "Country", "Membership category"))
    workbooks.write_workbooks(every, path).write.format("noop").mode("overwrite").save()
    found = workbooks.member_list(spark, f"{path}/*.xlsx", countries=[str(i) for i in range(25) if i != 7], categories=["Building", " machinery"])
    return found.select(F.substring_index("file", "/", -1).alias("file"), "company", "country", "category", "website")


@query("SELECT CASE WHEN n_regionkey % 2 = 0 THEN 'b.xlsx' ELSE 'c.csv' END AS file, n_name AS company, CAST(n_regionkey AS VARCHAR) AS country FROM nation")
def a5_a6_member_lists(spark, sf):
    """The nations as a workbook and as delimited files, both written by tasks and read by their header rows."""
    own, path = table(spark, sf, "nation"), shared_path(spark, "lists")
    cells = F.array("n_name", F.col("n_regionkey").cast("string"))
    head = spark.createDataFrame([("b.xlsx", -2, ["Members of 2024", ""]), ("b.xlsx", -1, ["Member name", "Country"])], "file string, row long, cells array<string>")
    workbooks.write_workbooks(head.unionByName(own.where("n_regionkey % 2 = 0").select(F.lit("b.xlsx").alias("file"), F.col("n_nationkey").alias("row"), cells.alias("cells"))), path).write.format("noop").mode("overwrite").save()
    sinks.write_csv(own.where("n_regionkey % 2 = 1").select(F.col("n_name").alias("Member name"), F.col("n_regionkey").alias("Country")), f"{path}/c")
    found = workbooks.member_list(spark, f"{path}/*.xlsx").unionByName(workbooks.member_list(spark, f"{path}/c/*.csv"))
    return found.select(F.when(F.endswith("file", F.lit(".csv")), "c.csv").otherwise(F.substring_index("file", "/", -1)).alias("file"), "company", "country")


@query("SELECT s_name AS company, CAST(s_nationkey AS VARCHAR) AS country, 'https://' || s_suppkey || '.example' AS website FROM supplier WHERE s_nationkey IN (1, 2, 3)")
def a6_registered_list(spark, sf):
    """The suppliers as delimited files of a registry's entry, of which three countries count."""
    path = shared_path(spark, "registered")
    own = table(spark, sf, "supplier").select(F.col("s_name").alias("Organisation"), F.col("s_nationkey").cast("string").alias("Country"), F.concat(F.lit("https://"), F.col("s_suppkey").cast("string"), F.lit(".example")).alias("Homepage"))
    sinks.write_csv(own, path)
    return workbooks.registered_list(spark, {"directory_url": f"{path}/*.csv", "countries": ["1", "2", "3"]}).select("company", "country", "website")


@query(
    f"""{WITH}, m AS (SELECT _ord, 'Found ' || substr(company, 1, 60) || ' ' || {NAME_PICK} || CASE _ord % 3 WHEN 0 THEN ' in Brazil for textile' WHEN 1 THEN ' shop' ELSE '' END AS t, CASE _ord % 2 WHEN 0 THEN 'https://a.com.tr/x' ELSE 'https://b.org' END AS url FROM leads),
f AS (SELECT _ord, t, url, list_filter(list_transform({LEGAL_SQL}, lambda n: trim(n, ' ')), lambda n: length(n) > 3) AS a FROM m), n AS (SELECT _ord, t, url, unnest(list_filter(a, lambda n, i: list_position(list_transform(a, lambda y: lower(y)), lower(n)) = i)) AS company FROM f)
SELECT _ord, company, CASE WHEN len(list_filter({sql_list(extract.MENTION_COUNTRIES)}, lambda w: contains(lower(t), w))) > 0 THEN (SELECT string_agg(upper(x[1]) || x[2:], ' ') FROM (SELECT unnest(string_split(list_filter({sql_list(extract.MENTION_COUNTRIES)}, lambda w: contains(lower(t), w))[1], ' ')) AS x)) WHEN contains(url, '.com.tr/') THEN 'Turkey' ELSE 'Unknown' END AS country,
  len(list_filter({sql_list(("textile", "tekstil", "dyeing", "finishing", "stenter", "ramöz", "terbiye", "têxtil"))}, lambda w: contains(lower(t), w))) > 0 AS has_textile_context FROM n"""
)
def a18_search_leads(spark, sf):
    own = leads(spark, sf)
    pick = F.element_at(F.array(*map(F.lit, NAMES)), (F.col("_ord") % len(NAMES) + 1).cast("int"))
    title = F.concat(F.lit("Found "), F.substring("company", 1, 60))
    text = F.concat(pick, F.when(F.col("_ord") % 3 == 0, " in Brazil for textile").when(F.col("_ord") % 3 == 1, " shop").otherwise(""))
    results = own.select("_ord", title.alias("title"), text.alias("description"), F.when(F.col("_ord") % 2 == 0, "https://a.com.tr/x").otherwise("https://b.org").alias("url"))
    return extract.leads_of_results(results, "_ord").select("_ord", "company", "country", "has_textile_context")


REGION_SQL = " ".join(f"WHEN len(list_filter({sql_list(w)}, lambda k: contains(t, k))) > 0 THEN '{k}'" for k, w in extract.REGION_WORDS.items())


@query(f"{WITH}, m AS (SELECT _ord, lower(coalesce(website, '') || ' ' || company || CASE _ord % 2 WHEN 0 THEN ' ' || country ELSE '' END) AS t FROM leads) SELECT _ord, CASE {REGION_SQL} ELSE 'unknown' END AS region FROM m")
def s19_region_of_text(spark, sf):
    title = F.concat("company", F.when(F.col("_ord") % 2 == 0, F.concat(F.lit(" "), "country")).otherwise(""))
    return leads(spark, sf).select("_ord", extract.region_in(F.col("website"), title).alias("region"))


@query(
    f"""{WITH}, m AS (SELECT _ord, CASE _ord % 4 WHEN 0 THEN 'The  ' || country || ' Mills' WHEN 1 THEN 'Textile' WHEN 2 THEN 'a small mill' ELSE 'Finishing' END AS n FROM leads),
c AS (SELECT _ord, n, trim(regexp_replace(regexp_replace(n, '(?i)^(the|a|an)\\s+', ''), '\\s+', ' ', 'g'), ' ') AS t FROM m)
SELECT _ord, CASE WHEN length(t) BETWEEN 3 AND 60 AND substr(t, 1, 1) = upper(substr(t, 1, 1)) AND NOT list_contains({sql_list(extract.NAME_NOT)}, lower(t)) THEN t ELSE '' END AS name, length(n) >= 3 AND NOT list_contains({sql_list(extract.NAME_EXCLUDED)}, lower(n)) AS fine FROM c"""
)
def s24_clean_names(spark, sf):
    name = F.when(F.col("_ord") % 4 == 0, F.concat(F.lit("The  "), "country", F.lit(" Mills"))).when(F.col("_ord") % 4 == 1, "Textile").when(F.col("_ord") % 4 == 2, "a small mill").otherwise("Finishing")
    own = leads(spark, sf).select("_ord", name.alias("n"))
    return own.select("_ord", extract.plain_name(F.col("n")).alias("name"), extract.fine_name(F.col("n")).alias("fine"))


@query("SELECT doc_id, strip_accents(lower(x)) AS folded FROM (SELECT doc_id, ['Çalışma Ağı', 'Ærø – Łódź', 'São João', 'ÉÈÊË Ñandú', 'Žluťoučký kůň'][doc_id % 5 + 1] AS x FROM documents) WHERE doc_id % 5 <> 1 AND doc_id % 5 <> 0 UNION ALL SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'calisma agi' ELSE 'aero – lodz' END FROM documents WHERE doc_id % 5 < 2")
def s29_folded_accents(spark, sf):
    words = F.array(*map(F.lit, ("Çalışma Ağı", "Ærø – Łódź", "São João", "ÉÈÊË Ñandú", "Žluťoučký kůň")))
    return table(spark, sf, "documents").select("doc_id", T.fold_accents(F.element_at(words, (F.col("doc_id") % 5 + 1).cast("int"))).alias("folded"))


@query(
    f"""{WITH} SELECT _ord, coalesce(source_type = 'gots' AND TIMESTAMP '2024-02-01' - INTERVAL 90 DAY < (TIMESTAMP '2023-10-01' + to_days(CAST(_ord % 100 AS INT))), false) AS updated FROM leads"""
)
def s40_recent_updates(spark, sf):
    """Whether a certificate's list was updated within 90 days of a given day."""
    own = leads(spark, sf).withColumn("last_updated", F.expr("timestamp'2023-10-01' + make_interval(0, 0, 0, cast(_ord % 100 as int))"))
    own = own.withColumn("source_type", F.when(F.col("source_type") == "gots", "gots").otherwise("x"))
    return scores.triggers(own).select("_ord", F.exists("triggers", lambda t: t["type"] == "association_update").alias("updated"))


@query("SELECT o_custkey, o_orderkey, round(avg(o_totalprice) OVER w, 4) AS moving, round(o_totalprice - lag(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey), 4) AS step, dense_rank() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority) AS level FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)")
def w5_analytics(spark, sf):
    """Moving means, steps and levels of each customer's orders."""
    from pyspark.sql import Window

    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    return table(spark, sf, "orders").select(
        "o_custkey", "o_orderkey", F.round(F.avg("o_totalprice").over(w.rowsBetween(-2, 0)), 4).alias("moving"), F.round(F.col("o_totalprice") - F.lag("o_totalprice").over(w), 4).alias("step"),
        F.dense_rank().over(Window.partitionBy("o_custkey").orderBy("o_orderpriority")).alias("level"),
    )
