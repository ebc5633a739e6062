"""Queries of text, contact, web and JSON functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from siftlane import dictionaries as D
from siftlane.functions import numbering as N
from siftlane.functions import text as T
from siftlane.functions import web as H
from siftlane.operators import page_trees
from siftlane.operators.tables import guessed_emails
from siftlane.plans.collected import query
from siftlane.plans.leads import LEADS_SQL, leads, sql_any, sql_hits, sql_list
from siftlane.session import table
from siftlane.sources import files

WITH = "WITH " + LEADS_SQL
MAIL = r"[a-z0-9._%+-]+@[a-z0-9.-]+\.[a-z]{2,}"
PLAIN = "lower(text)"
for _a, _b in T.MAIL_WORDS:
    PLAIN = f"replace({PLAIN}, '{_a}', '{_b}')"
TAIL = "lambda x: regexp_replace(x, '[.,;]+$', '')"


@query(
    f"""SELECT doc_id, array_to_string(list_sort(list_distinct(list_concat(regexp_extract_all(text, '(?i)[A-Z0-9._%+-]+@[A-Z0-9.-]+\\.[A-Z]{{2,}}'), regexp_extract_all({PLAIN}, '{MAIL}')))), ';') AS emails,
  array_to_string(list_sort(list_distinct(list_transform(regexp_extract_all(text, '\\+?\\d[\\d\\s\\-()]{{6,}}\\d'), lambda x: trim(regexp_replace(x, '\\s+', ' ', 'g'), ' ')))), ';') AS phones,
  array_to_string(list_sort(list_distinct(list_concat(list_transform(regexp_extract_all(text, '(?i)https?://[^\\s)\\]"''>]+'), {TAIL}), list_transform(regexp_extract_all(text, '(?i)\\bwww\\.[^\\s)\\]"''>]+'), lambda x: 'http://' || regexp_replace(x, '[.,;]+$', ''))))), ';') AS links
FROM documents"""
)
def s06_s09_s10_contacts(spark, sf):
    own = table(spark, sf, "documents")
    return own.select("doc_id", *[F.array_join(f("text"), ";").alias(n) for n, f in (("emails", T.emails), ("phones", T.phones), ("links", T.links))])


HOST = "regexp_extract(regexp_replace(lower(trim(url, ' ')), '^[a-z][a-z0-9+.-]*://', ''), '^[^/?#]*', 0)"
BARE = f"regexp_replace(regexp_replace({HOST}, '^www\\.', ''), ':\\d+$', '')"
PARTS = f"string_split({BARE}, '.')"


@query(
    f"""SELECT page_id, {HOST} AS host, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)) AS domain_key,
  CASE WHEN len({PARTS}) > 2 AND list_contains({sql_list(H.SECOND_LEVEL)}, {PARTS}[-2]) THEN array_to_string({PARTS}[-3:], '.') ELSE array_to_string({PARTS}[-2:], '.') END AS registrable,
  {BARE} AS clean_domain, {PARTS}[-1] AS top_level FROM pages"""
)
def s11_s12_s13_hosts(spark, sf):
    own = table(spark, sf, "pages")
    return own.select("page_id", H.host("url").alias("host"), H.domain_key("url").alias("domain_key"), H.registrable("url").alias("registrable"), H.clean_domain("url").alias("clean_domain"), H.top_level("url").alias("top_level"))


NORMAL = "lower(trim(regexp_replace(regexp_replace({0}, '[\"''.,()]', ' ', 'g'), '\\s+', ' ', 'g'), ' '))"


def sql_normal(column: str) -> str:
    out = NORMAL.format(column)
    for s in D.COMPANY_SUFFIXES:
        out = f"trim(regexp_replace({out}, '\\b{s.replace('.', '[.]')}\\b', '', 'g'), ' ')"
    return f"trim(regexp_replace({out}, '\\s+', ' ', 'g'), ' ')"


@query(f"SELECT s_suppkey, {sql_normal('n')} AS name FROM (SELECT s_suppkey, s_name || ' Trading (S.A.), Ltd. & Group GmbH' AS n FROM supplier)")
def s04_normalize_company(spark, sf):
    return table(spark, sf, "supplier").select("s_suppkey", T.normalize_company(F.concat("s_name", F.lit(" Trading (S.A.), Ltd. & Group GmbH"))).alias("name"))


@query(f"{WITH} SELECT _ord, trim(country, ' ') AS country, lower(source_type) IN ('true', '1', 'yes', 'evet') AS truth, CASE WHEN lower(trim(lang, ' ')) IN ('', 'nan', 'none', 'null', '[]', '{{}}') THEN NULL ELSE trim(lang, ' ') END AS lang FROM leads")
def s01_s03_s05_cleaning(spark, sf):
    return leads(spark, sf).select("_ord", T.normalize_country("country").alias("country"), T.is_true("source_type").alias("truth"), T.clean("lang").alias("lang"))


@query(
    f"""SELECT doc_id, {sql_hits("lower(text)", D.SIGNAL_FACILITY)} AS n_hits, round(least(20.0::DOUBLE, {sql_hits("lower(text)", D.SIGNAL_FACILITY)} * (20.0::DOUBLE / {len(D.SIGNAL_FACILITY)})), 6) AS score,
  array_to_string(list_filter({sql_list(D.SIGNAL_PARTS)}, lambda k: contains(lower(text), k)), ',') AS words FROM documents"""
)
def s26_s27_keywords(spark, sf):
    own, t = table(spark, sf, "documents"), F.lower("text")
    return own.select("doc_id", T.hits(t, D.SIGNAL_FACILITY).cast("long").alias("n_hits"), F.round(T.proportional(t, D.SIGNAL_FACILITY, 20), 6).alias("score"), F.array_join(T.found(t, D.SIGNAL_PARTS), ",").alias("words"))


VOTES = {"en": (" the ", " and ", " of ", "tion"), "fr": (" les ", " des ", "eaux", "ment"), "de": (" der ", " und ", "keit", "lich"), "es": (" los ", " las ", "ción", " el ")}


@query(
    "SELECT doc_id, CASE WHEN greatest(a, b, c, d) = 0 THEN NULL WHEN a >= greatest(b, c, d) THEN 'en' WHEN b >= greatest(c, d) THEN 'fr' WHEN c >= d THEN 'de' ELSE 'es' END AS guess FROM (SELECT doc_id, "
    + ", ".join(f"{sql_hits('lower(text)', w)} AS {n}" for n, w in zip("abcd", VOTES.values()))
    + " FROM documents)"
)
def s31_language(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.language_votes(F.lower("text"), VOTES).alias("guess"))


AT = "strpos(lower(text), 'token')"
S, E = f"greatest(1, {AT} - 150)", f"least(length(text), {AT} + 4 + 150)"


@query(
    f"""SELECT doc_id, CASE WHEN {AT} > 0 THEN CASE WHEN {S} > 1 THEN '...' ELSE '' END || trim(regexp_replace(substr(text, {S}, {E} - {S} + 1), '\\s+', ' ', 'g'), ' ') || CASE WHEN {E} < length(text) THEN '...' ELSE '' END END AS context,
  CASE WHEN length(text) > 300 THEN substr(text, 1, 297) || '...' ELSE text END AS short FROM documents"""
)
def s25_s45_windows(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.context_around(F.col("text"), "token").alias("context"), T.shortened(F.col("text")).alias("short"))


@query(f"SELECT doc_id, {sql_any('lower(text)', ('spare', 'part', 'chain'))} AS any_word, regexp_matches(lower(text), '(stenter|rama).{{0,100}}(part|pin)') OR regexp_matches(lower(text), '(part|pin).{{0,100}}(stenter|rama)') AS near FROM documents")
def s28_proximity(spark, sf):
    t = F.lower("text")
    return table(spark, sf, "documents").select("doc_id", T.contains_any(t, ("spare", "part", "chain")).alias("any_word"), T.near(t, ("stenter", "rama"), ("part", "pin")).alias("near"))


TAGS = {"the": "en", "and": "en", "les": "fr", "des": "fr", "der": "de", "und": "de", "los": "es", "las": "es"}


@query(
    f"""SELECT word, count(*) AS n FROM (SELECT unnest(list_filter(regexp_split_to_array(lower(text), '[^A-Za-z0-9_]+'), lambda w: list_contains({sql_list(TAGS)}, w))) AS word FROM documents) GROUP BY word"""
)
def s30_tagged_words(spark, sf):
    found = table(spark, sf, "documents").select(F.explode(T.tagged_words(F.col("text"), TAGS)).alias("x"))
    return found.groupBy("x.word").agg(F.count("*").alias("n"))


@query("SELECT doc_id, sha256(coalesce(text, '')) AS content_hash, md5(source) AS source_hash FROM documents")
def s44_hashes(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.sha2(T.text_of("text"), 256).alias("content_hash"), F.md5("source").alias("source_hash"))


@query("SELECT p_partkey, substr(regexp_replace('HS ' || p_partkey || '.' || p_size || '-' || p_type, '[^0-9]', '', 'g'), 1, 6) AS hs FROM part")
def s34_hs6(spark, sf):
    code = F.concat(F.lit("HS "), F.col("p_partkey").cast("string"), F.lit("."), F.col("p_size").cast("string"), F.lit("-"), F.col("p_type"))
    return table(spark, sf, "part").select("p_partkey", T.hs6(code).alias("hs"))


TEXT = "regexp_replace(html, '<!--(.|\\n)*?-->', ' ', 'g')"
for _tag in H.DROPPED:
    TEXT = f"regexp_replace({TEXT}, '(?is)<{_tag}\\b[^>]*>.*?</{_tag}\\s*>', ' ', 'g')"
TEXT = f"regexp_replace({TEXT}, '<[^>]*>', ' ', 'g')"
for _a, _b in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&amp;", "&")):
    TEXT = f"replace({TEXT}, '{_a}', '{_b}')"


@query(
    f"""SELECT page_id, trim(regexp_replace({TEXT}, '\\s+', ' ', 'g'), ' ') AS main_text, len(regexp_extract_all(html, '(?i)<a[^>]+href=["'']([^"'']+)["'']', 1)) AS n_links,
  array_to_string(list_sort(list_distinct(list_transform(regexp_extract_all(html, '(?i)href=["'']mailto:([^"''?]+)', 1), lambda x: lower(trim(x, ' '))))), ';') AS mailtos FROM pages"""
)
def h1_h2_pages(spark, sf):
    return table(spark, sf, "pages").select("page_id", H.main_text("html").alias("main_text"), F.size(H.hrefs("html")).cast("long").alias("n_links"), F.array_join(H.mailtos("html"), ";").alias("mailtos"))


@query("SELECT page_id, href, place FROM (SELECT page_id, unnest(regexp_extract_all(html, '<li><a href=\"([^\"]+)\"', 1)) AS href, generate_subscripts(regexp_extract_all(html, '<li><a href=\"([^\"]+)\"', 1), 1) - 1 AS place FROM pages)")
def a13_h4_list_items(spark, sf):
    """Repeated list items of each page and their links."""
    found = F.posexplode(F.regexp_extract_all("html", F.lit('<li><a href="([^"]+)"'), F.lit(1))).alias("place", "href")
    return table(spark, sf, "pages").select("page_id", found).select("page_id", "href", F.col("place").cast("long").alias("place"))


@query(
    r"""WITH c AS (SELECT page_id, unnest(regexp_extract_all(html, '(?is)<article\b[^>]*>(.*?)</article>', 1)) AS c, generate_subscripts(regexp_extract_all(html, '(?is)<article\b[^>]*>(.*?)</article>', 1), 1) - 1 AS place FROM pages),
t AS (SELECT page_id, place, c, trim(regexp_replace(regexp_replace(c, '<[^>]*>', ' ', 'g'), '\s+', ' ', 'g'), ' ') AS context, trim(regexp_replace(regexp_replace(regexp_extract(c, '(?is)<(?:h[1-6]|strong|b)\b[^>]*>(.*?)</', 1), '<[^>]*>', ' ', 'g'), '\s+', ' ', 'g'), ' ') AS h,
  trim(regexp_replace(regexp_replace(regexp_extract(c, '(?is)<a\b[^>]*>(.*?)</a>', 1), '<[^>]*>', ' ', 'g'), '\s+', ' ', 'g'), ' ') AS l FROM c)
SELECT page_id, place, substr(coalesce(nullif(h, ''), nullif(l, '')), 1, 100) AS company, context, array_to_string(list_sort(list_distinct(regexp_extract_all(c, '(?i)[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}'))), ';') AS emails FROM t WHERE coalesce(nullif(h, ''), nullif(l, '')) IS NOT NULL"""
)
def a13_a14_cards(spark, sf):
    """Leads of the pages' articles."""
    own = files.cards(table(spark, sf, "pages").select("page_id", "html"), r"(?is)<article\b[^>]*>(.*?)</article>")
    return own.select("page_id", "place", "company", "context", F.array_join("emails", ";").alias("emails"))


PLAN_SQL = "[" + ", ".join(f"{{'c': '{c}', 'lo': {lo}, 'hi': {hi}, 't': '{t}', 'n': {sql_list(n)}}}" for c, lo, hi, t, n in N.PLAN) + "]"
#: Numbers as people write them, of some ten countries by the lead's number, behind its own text.
WRITTEN = ("+90 (0212) 555 NN NN", "0090 532 NN NN NN 4", "+44 (0)20 79NN NNNN", "+1 (415) 555-NNNN", "+55 11 9 NNNN-NNNN", "+49/0711/NNNNNN", "+39 06 NNNN NNNN", "+880 1711-NNNNNN", "+998 71 NNN NN", "tel 12345678 or 1234567890, 0000-1111-2222", "+999 123 4567 8NNN", "+34 91 NNN NN NN")


@query(
    f"""{WITH}, w AS (SELECT _ord, context || ' ' || regexp_replace({sql_list(WRITTEN)}[_ord % {len(WRITTEN)} + 1], 'N', CAST(_ord % 9 + 1 AS VARCHAR), 'g') || ' and (0) 212 444 33 2' || _ord % 10 AS t,
  list_filter({PLAN_SQL}, lambda p: list_contains(p.n, lower(trim(country, ' '))))[1].c AS home FROM leads),
m AS (SELECT _ord, home, unnest(l) AS raw, generate_subscripts(l, 1) AS i FROM (SELECT _ord, home, regexp_extract_all(t, '{N.CANDIDATE}') AS l FROM w)),
d AS (SELECT *, regexp_replace(raw, '[^0-9]', '', 'g') AS g FROM m), h AS (SELECT *, CASE WHEN contains(raw, '+') THEN g WHEN starts_with(g, '00') THEN g[3:] WHEN home IS NOT NULL THEN home || g END AS f FROM d),
r AS (SELECT *, coalesce(list_filter({PLAN_SQL}, lambda p: length(p.c) = 3 AND starts_with(f, p.c))[1], list_filter({PLAN_SQL}, lambda p: length(p.c) = 2 AND starts_with(f, p.c))[1], list_filter({PLAN_SQL}, lambda p: length(p.c) = 1 AND starts_with(f, p.c))[1]) AS p FROM h),
n AS (SELECT *, CASE WHEN p.t <> '' AND starts_with(f[length(p.c) + 1:], p.t) AND length(f) - length(p.c) > p.lo THEN f[length(p.c) + 2:] ELSE f[length(p.c) + 1:] END AS nat FROM r),
e AS (SELECT _ord, i, g, raw, CASE WHEN length(nat) BETWEEN p.lo AND p.hi THEN '+' || p.c || nat END AS number FROM n),
o AS (SELECT _ord, i, coalesce(number, trim(raw, ' ')) AS number, number IS NOT NULL AS valid FROM e WHERE number IS NOT NULL OR (length(g) BETWEEN 10 AND 15 AND g NOT IN {N.PLACEHOLDERS} AND NOT (starts_with(g, '00') AND len(list_distinct(string_split(g[1:4], ''))) <= 2)))
SELECT _ord, number, valid FROM o GROUP BY _ord, number, valid"""
)
def s09_numbers(spark, sf):
    """Telephone numbers of all leads by the numbering plan, national ones by the lead's country."""
    written = F.element_at(F.array(*map(F.lit, WRITTEN)), (F.col("_ord") % len(WRITTEN) + 1).cast("int"))
    own = F.concat("context", F.lit(" "), F.regexp_replace(written, "N", (F.col("_ord") % 9 + 1).cast("string")), F.lit(" and (0) 212 444 33 2"), (F.col("_ord") % 10).cast("string"))
    found = leads(spark, sf).select("_ord", F.explode(N.phone_numbers(own, "country")).alias("p"))
    return found.select("_ord", "p.number", "p.valid")


@query(
    r"""WITH l AS (SELECT page_id, generate_subscripts(regexp_extract_all(html, '<li><a href="([^"]+)">([^<]*)</a></li>', 1), 1) - 1 AS place, unnest(regexp_extract_all(html, '<li><a href="([^"]+)">([^<]*)</a></li>', 1)) AS website,
  unnest(regexp_extract_all(html, '<li><a href="([^"]+)">([^<]*)</a></li>', 2)) AS company FROM pages)
SELECT page_id, place, company, website, company AS context FROM l WHERE length(company) > 3"""
)
def a13_selected_items(spark, sf):
    """Leads of the pages' lists by a site's selectors."""
    site = {"selectors": {"item": "nav > ul > li", "name": "li a", "website": "a[href^='/']"}, "skip_industry_filter": True}
    return page_trees.scraped(table(spark, sf, "pages"), site).drop("fields")


@query()
def h1_main_texts(spark, sf):
    """The main text of all pages by text and link density."""
    return page_trees.main_texts(table(spark, sf, "pages"))


@query(
    r"""WITH l AS (SELECT page_id, regexp_extract_all(regexp_extract(html, '<nav><ul>(.*?)</ul>', 1), '<li><a href="([^"]+)">([^<]*)</a></li>', 1) AS h, regexp_extract_all(regexp_extract(html, '<nav><ul>(.*?)</ul>', 1), '<li><a href="([^"]+)">([^<]*)</a></li>', 2) AS t FROM pages)
SELECT page_id, unnest(range(0, len(h))) AS place, len(h) AS n, unnest(t) AS name, unnest(h) AS href FROM l WHERE len(h) >= 3"""
)
def h4_n3_repeated_records(spark, sf):
    """The records of the pages' repeated structures: here those of their navigation."""
    found = page_trees.repeated_records(table(spark, sf, "pages").select("page_id", "html"))
    return found.where("path = 'html>body>nav>ul>li'").select("page_id", "place", "n", "name", "href")


@query(
    r"""SELECT page_id, CASE WHEN regexp_matches(url, '[?&](page|p|pg|offset)=\d+') THEN regexp_replace(url, '([?&](?:page|p|pg|offset)=)\d+', '\1{num}', 'g')
  WHEN regexp_matches(url, '/page/\d+') THEN regexp_replace(url, '/page/\d+', '/page/{num}', 'g') END AS template FROM pages"""
)
def n5_page_templates(spark, sf):
    return table(spark, sf, "pages").select("page_id", H.page_template("url").alias("template"))


@query("SELECT event_id, coalesce(json_extract_string(props, '$.name'), json_extract_string(props, '$.k')) AS value FROM events")
def n2_json_synonyms(spark, sf):
    return table(spark, sf, "events").select("event_id", H.synonyms("props", ("name", "k")).alias("value"))


@query("SELECT key, count(*) AS n FROM (SELECT unnest(json_keys(props)) AS key FROM events) GROUP BY key")
def n3_g11_json_keys(spark, sf):
    keys = table(spark, sf, "events").select(F.explode(F.json_object_keys("props")).alias("key"))
    return keys.groupBy("key").agg(F.count("*").alias("n"))


DOMAIN = "regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(trim(website, ' ')), '^https?://', ''), '^www\\.', ''), '[/?#].*$', ''), ':\\d+$', '')"
LANGS = {"pt": "['vendas','sales','comercial']", "es": "['ventas','sales','comercial']", "tr": "['satis','sales','ihracat']", "de": "['vertrieb','sales','verkauf']", "fr": "['ventes','sales','commercial']"}
LOCALS = "CASE lower(country) " + " ".join(f"WHEN '{c}' THEN {LANGS[g]}" for c, g in (("brazil", "pt"), ("portugal", "pt"), *((x, "es") for x in ("argentina", "chile", "colombia", "peru", "ecuador", "mexico", "spain")), ("turkey", "tr"), ("germany", "de"), ("tunisia", "fr"), ("morocco", "fr"), ("france", "fr"))) + " ELSE ['sales','export','info'] END"


@query(f"{WITH} SELECT _ord, CASE WHEN website IS NULL THEN '' ELSE array_to_string(list_transform({LOCALS}, lambda p: p || '@' || {DOMAIN}), ';') END AS guesses FROM leads")
def s35_guessed_emails(spark, sf):
    return guessed_emails(leads(spark, sf)).select("_ord", F.array_join("guesses", ";").alias("guesses"))


@query(f"{WITH} SELECT _ord, 'site:linkedin.com/in \"' || company || '\" (\"textile\" OR \"finishing\" OR \"dyeing\" OR \"stenter\")' AS linkedin_xray FROM leads WHERE company <> ''")
def s36_search_strings(spark, sf):
    from siftlane.operators.tables import crm_projection

    own = leads(spark, sf).where("company != ''")
    return crm_projection(own, ["_ord", "linkedin_xray"])
