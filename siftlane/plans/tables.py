"""Queries of scans, sinks, joins, counts, quotas, sorts and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from siftlane.functions.text import contains_any, found, hits
from siftlane.operators import sketches
from siftlane.operators import tables as O
from siftlane.plans.collected import query
from siftlane.plans.leads import COUNTRIES, LEADS_SQL, leads, sql_hits, sql_list
from siftlane.plans.pipelines import Pipeline
from siftlane.session import shared_path, table
from siftlane.sources import files, table_functions

WITH = "WITH " + LEADS_SQL


@query("SELECT s_name AS company, s_nationkey AS nation, 'supplier' AS source_type FROM supplier UNION ALL SELECT c_name, c_nationkey, c_mktsegment FROM customer")
def a2_union_sources(spark, sf):
    one = table(spark, sf, "supplier").select(F.col("s_name").alias("company"), F.col("s_nationkey").alias("nation"))
    two = table(spark, sf, "customer").select(F.col("c_name").alias("company"), F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("source_type"))
    return O.union_sources((one, "supplier"), (two, "customer"))


@query("SELECT count(*) AS n FROM documents")
def a4_latest_file(spark, sf):
    return files.read_latest(spark, f"{sf}/documents.parquet").agg(F.count("*").alias("n"))


@query(
    """SELECT r_name AS region, n_name AS country, unnest([s_name, s_name || ' Mills']) AS company FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
UNION ALL SELECT r_name, 'none', s_name FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE s_suppkey % 5 = 0"""
)
def a12_known_entities(spark, sf):
    """The suppliers as entries of a configuration by region and country, some with a second country."""
    nations = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    own = table(spark, sf, "supplier").join(F.broadcast(nations), F.col("s_nationkey") == F.col("n_nationkey"))  # a nation's rows are 25
    first = F.create_map("n_name", F.array("s_name", F.concat("s_name", F.lit(" Mills"))))
    both = F.map_concat(first, F.when(F.col("s_suppkey") % 5 == 0, F.create_map(F.lit("none"), F.array("s_name"))).otherwise(F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<array<string>>"))))
    return O.configured_entities(own.select(F.col("r_name").alias("region"), both.alias("countries")), "configured").select("region", "country", "company")


@query("SELECT min(page_id) AS page_id, url, 'html' AS file_type FROM pages WHERE contains(lower(url), '.html') GROUP BY url")
def a19_search_files(spark, sf):
    own = table(spark, sf, "pages").select("page_id", "url", F.col("page_id").alias("rank"))
    return files.search_files(own, kinds=("html",)).select("page_id", "url", "file_type")


@query("SELECT p_brand, p_size FROM part WHERE p_size >= 40")
def a22_registry(spark, sf):
    return table(spark, sf, "part").where("p_size >= 40").select("p_brand", "p_size")


TRADE = f"SELECT {sql_list(COUNTRIES)}[c_nationkey % {len(COUNTRIES)} + 1] AS country, year(o_orderdate) AS year, o_orderpriority AS partner, o_totalprice AS value FROM orders JOIN customer ON o_custkey = c_custkey"


def trade(spark, sf):
    country = F.element_at(F.array(*map(F.lit, COUNTRIES)), (F.pmod(F.col("c_nationkey"), F.lit(len(COUNTRIES))) + 1).cast("int"))
    own = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return own.select(country.alias("country"), F.year("o_orderdate").alias("year"), F.col("o_orderpriority").alias("partner"), F.col("o_totalprice").alias("value"))


@query(f"SELECT country, round(sum(value), 2) AS value FROM ({TRADE}) GROUP BY country")
def a23_g1_trade_by_country(spark, sf):
    return trade(spark, sf).groupBy("country").agg(F.round(F.sum("value"), 2).alias("value"))


@query(f"WITH t AS (SELECT country, sum(value) AS v FROM ({TRADE}) GROUP BY country) SELECT country, round(v / (SELECT max(v) FROM t) * 100, 6) AS priority FROM t")
def g8_country_priority(spark, sf):
    own = trade(spark, sf).groupBy("country").agg(F.sum("value").alias("value"))
    return O.max_share(own, "value", 100, "priority").select("country", "priority")


@query(
    f"""WITH t AS ({TRADE}), y AS (SELECT country, year, sum(value) AS v FROM t GROUP BY ALL), g AS (SELECT *, v / lag(v) OVER (PARTITION BY country ORDER BY year) - 1 AS growth FROM y),
p AS (SELECT country, partner, sum(value) AS v FROM t GROUP BY ALL), h AS (SELECT country, sum(pow(v / tv, 2)) AS hhi, count(*) AS n_partners FROM (SELECT *, sum(v) OVER (PARTITION BY country) AS tv FROM p) GROUP BY country)
SELECT g.country, round(max_by(v, year), 2) AS latest_value, round(CASE WHEN max(year) > min(year) THEN pow(max_by(v, year) / min_by(v, year), 1.0 / (max(year) - min(year))) - 1 END, 6) AS cagr, round(stddev_samp(growth), 6) AS volatility,
  round(any_value(hhi), 6) AS hhi, any_value(n_partners) AS n_partners FROM g JOIN h ON g.country = h.country GROUP BY g.country"""
)
def g9_trade_kpis(spark, sf):
    own = O.trade_kpis(trade(spark, sf))
    return own.select("country", F.round("latest_value", 2).alias("latest_value"), *[F.round(c, 6).alias(c) for c in ("cagr", "volatility", "hhi")], "n_partners")


@query(f"{WITH} SELECT source_type, count(*) AS n, round(count(*)::DOUBLE / (SELECT count(*) FROM leads), 6) AS share FROM leads GROUP BY source_type")
def g2_counts(spark, sf):
    return O.counts(leads(spark, sf), "source_type")


@query(f"{WITH} SELECT count(*) FILTER (score >= 60) AS high, count(*) FILTER (score >= 40 AND score < 60) AS medium, count(*) FILTER (score < 40) AS low, count(*) FILTER (score IS NULL) AS none FROM leads")
def g3_conditional_counts(spark, sf):
    s = F.col("score")
    return leads(spark, sf).agg(F.count_if(s >= 60).alias("high"), F.count_if((s >= 40) & (s < 60)).alias("medium"), F.count_if(s < 40).alias("low"), F.count_if(s.isNull()).alias("none"))


TIER = "CASE WHEN score >= 60 THEN 1 WHEN score >= 40 THEN 2 ELSE 3 END"


@query(
    f"""{WITH}, t AS (SELECT source_type, count(*) AS total, count(*) FILTER ({TIER} = 1) AS tier1, count(*) FILTER ({TIER} = 2) AS tier2, count(*) FILTER ({TIER} = 3) AS tier3 FROM leads GROUP BY source_type)
SELECT source_type, total, tier1, tier2, tier3, round((tier1 + tier2)::DOUBLE / total, 6) AS yield, total >= 50 AND round((tier1 + tier2)::DOUBLE / total, 6) < 0.10 AS drop_source FROM t"""
)
def g4_source_yield(spark, sf):
    tier = F.when(F.col("score") >= 60, 1).when(F.col("score") >= 40, 2).otherwise(3)
    return O.source_yield(leads(spark, sf).withColumn("tier", tier))


@query(f"{WITH} SELECT 'leads' AS stage, count(*) AS n FROM leads UNION ALL SELECT 'with website', count(*) FROM leads WHERE website IS NOT NULL UNION ALL SELECT 'labelled', count(*) FROM leads WHERE score IS NOT NULL")
def g7_funnel(spark, sf):
    own = leads(spark, sf)
    flags = F.array(F.lit("leads"), F.when(F.col("website").isNotNull(), "with website"), F.when(F.col("score").isNotNull(), "labelled"))
    return own.select(F.explode(F.array_compact(flags)).alias("stage")).groupBy("stage").agg(F.count("*").alias("n"))


@query(f"{WITH} SELECT 'leads' AS stage, count(*) AS n FROM leads UNION ALL SELECT 'with website', count(*) FROM leads WHERE website IS NOT NULL UNION ALL SELECT 'labelled', count(*) FROM leads WHERE website IS NOT NULL AND score IS NOT NULL")
def f25_g7_observed(spark, sf):
    """The funnel of a pipeline, counted by the run that writes its rows."""
    stages = (lambda d: d.where("website is not null"), lambda d: d.where("score is not null"))
    rows, seen = Pipeline(stages).observed(leads(spark, sf), ("leads", "with website", "labelled"))
    rows.write.parquet(shared_path(spark, "observed"))
    return spark.createDataFrame([(name, own.get["n"]) for name, own in seen], "stage string, n long")


@query("SELECT o_orderstatus, count(DISTINCT o_custkey) AS exact, true AS within FROM orders GROUP BY o_orderstatus UNION ALL SELECT NULL, count(DISTINCT o_custkey), true FROM orders")
def g2_sketches(spark, sf):
    """Customers by status and in all, from sketches by status and priority that are merged: whether the estimates keep within three deviations of the counts."""
    own = table(spark, sf, "orders")
    small = sketches.sketched(own, ("o_orderstatus", "o_orderpriority"), "o_custkey")
    found = sketches.estimated(sketches.merged(small, ("o_orderstatus",))).drop("n")
    whole = sketches.estimated(sketches.merged(small, ())).select(F.lit(None).cast("string").alias("o_orderstatus"), "n_distinct")
    exact = own.groupBy("o_orderstatus").agg(F.countDistinct("o_custkey").alias("exact")).unionByName(own.agg(F.countDistinct("o_custkey").alias("exact")).withColumn("o_orderstatus", F.lit(None).cast("string")))
    both = found.unionByName(whole).withColumnRenamed("o_orderstatus", "s").join(exact, F.col("s").eqNullSafe(F.col("o_orderstatus")))
    return both.select("o_orderstatus", "exact", (F.abs(F.col("n_distinct") - F.col("exact")) <= 1 + sketches.bound() * F.col("exact")).alias("within"))


@query("SELECT o_orderstatus, o_orderpriority, count(*) AS n, grouping(o_orderstatus) * 2 + grouping(o_orderpriority) AS level FROM orders GROUP BY GROUPING SETS ((o_orderstatus, o_orderpriority), (o_orderstatus), ())")
def g3_grouping_sets(spark, sf):
    """Counts by status and priority, by status, and in all, in one pass."""
    return sketches.grouped_counts(table(spark, sf, "orders"), (("o_orderstatus", "o_orderpriority"), ("o_orderstatus",), ()))


@query("SELECT s_suppkey AS id, s_name AS company, CASE WHEN s_suppkey % 2 = 0 THEN 'M' || s_nationkey END AS town FROM supplier WHERE s_suppkey % 4 <> 3")
def n1_company_items_sql(spark, sf):
    """A table function called from SQL: companies of payloads under a known key, in a list below, and none."""
    table_functions.register(spark)
    body = F.to_json(F.struct(F.when(F.col("s_suppkey") % 4 == 0, F.array(F.struct(F.col("s_name").alias("title"), F.concat(F.lit("M"), "s_nationkey").alias("place")))).alias("members"), F.when(F.col("s_suppkey") % 4 != 0, F.struct(F.when(F.col("s_suppkey") % 4 != 3, F.array(F.struct(F.col("s_name").alias("name"), F.when(F.col("s_suppkey") % 2 == 0, F.concat(F.lit("M"), "s_nationkey")).alias("city")))).alias("b"))).alias("a")))
    table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), body.alias("body")).createOrReplaceTempView("payloads")
    return spark.sql("SELECT id, company, town FROM payloads, LATERAL company_items(body, 'company=name|title', 'town=place|city')")


@query("SELECT n_regionkey AS page, n_nationkey AS row, n_name AS company, CAST(n_regionkey AS VARCHAR) AS country FROM nation")
def a8_table_records_sql(spark, sf):
    """A partitioned table function called from SQL: the rows of a table for each region, with a title and a header before them."""
    table_functions.register(spark)
    own = table(spark, sf, "nation").select(F.col("n_regionkey").cast("long").alias("page"), F.col("n_nationkey").cast("long").alias("row"), F.array("n_name", F.col("n_regionkey").cast("string")).alias("cells"))
    pages = own.select("page").distinct()
    head = lambda row, *x: pages.select("page", F.lit(row).cast("long").alias("row"), F.array(*map(F.lit, x)).alias("cells"))
    own.unionByName(head(-2, "Hall plan", "")).unionByName(head(-1, "Exhibitor", "Nation")).createOrReplaceTempView("extracted")
    return spark.sql("SELECT page, row, company, country FROM table_records(TABLE(extracted))")


@query(f"{WITH} SELECT country, array_to_string(list_sort(list_distinct(list(source_type))), ',') AS sources FROM leads GROUP BY country")
def g10_list_union(spark, sf):
    return leads(spark, sf).groupBy("country").agg(F.array_join(F.array_sort(F.collect_set("source_type")), ",").alias("sources"))


@query(
    f"""{WITH}, r AS (SELECT _ord, score, CASE WHEN country IN ('Brazil', 'Argentina', 'Chile', 'Colombia', 'Peru', 'Ecuador') THEN 'south_america' WHEN country IN ('Egypt', 'Morocco', 'Tunisia') THEN 'north_africa'
  WHEN country = 'Turkey' THEN 'middle_east' ELSE 'other' END AS region FROM leads)
SELECT _ord, region FROM (SELECT *, row_number() OVER (PARTITION BY region ORDER BY score DESC NULLS LAST, _ord) AS n FROM r) WHERE region = 'other' OR n <= CASE region WHEN 'south_america' THEN 300 WHEN 'north_africa' THEN 150 ELSE 75 END"""
)
def w1_region_quota(spark, sf):
    own = leads(spark, sf).select("_ord", "score", O.region_of(F.col("country")).alias("region"))
    return O.top_of_each(own, "region", [F.desc_nulls_last("score"), F.asc("_ord")], {k: v[1] for k, v in O.REGIONS.items()}).select("_ord", "region")


@query(f"{WITH} SELECT _ord, score FROM leads ORDER BY score DESC NULLS LAST, _ord LIMIT 100")
def t1_top_hundred(spark, sf):
    return leads(spark, sf).select("_ord", "score").orderBy(F.desc_nulls_last("score"), "_ord").limit(100)


@query("SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders ORDER BY o_orderpriority ASC, o_totalprice DESC, o_orderkey LIMIT 50")
def t3_two_way_sort(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice").orderBy("o_orderpriority", F.desc("o_totalprice"), "o_orderkey").limit(50)


@query("SELECT doc_id, array_to_string(list_filter(['the', 'and', 'der', 'les', 'los', 'ing', 'tion'], lambda k: contains(lower(text), k))[1:3], ',') AS firsts FROM documents")
def t5_first_signals(spark, sf):
    t = F.lower("text")
    return table(spark, sf, "documents").select("doc_id", F.array_join(F.slice(found(t, ("the", "and", "der", "les", "los", "ing", "tion")), 1, 3), ",").alias("firsts"))


@query("SELECT doc_id FROM documents ORDER BY md5('7:' || doc_id), doc_id LIMIT 25")
def t6_seeded_sample(spark, sf):
    return O.seeded_sample(table(spark, sf, "documents").select("doc_id"), 25, "doc_id")


@query("SELECT c_nationkey AS k FROM customer EXCEPT ALL SELECT s_nationkey FROM supplier")
def u3_except(spark, sf):
    return table(spark, sf, "customer").select(F.col("c_nationkey").alias("k")).exceptAll(table(spark, sf, "supplier").select("s_nationkey"))


@query("SELECT DISTINCT c_nationkey AS k FROM customer WHERE c_nationkey IN (SELECT s_nationkey FROM supplier)")
def u4_intersect(spark, sf):
    return table(spark, sf, "customer").select(F.col("c_nationkey").alias("k")).intersect(table(spark, sf, "supplier").select("s_nationkey"))


@query(f"{WITH} SELECT _ord, n_name, r_name FROM leads LEFT JOIN nation ON n_nationkey = _ord % 25 LEFT JOIN region ON r_regionkey = n_regionkey")
def j1_region_lookup(spark, sf):
    """Nations and regions have a fixed number of rows, so both are broadcast."""
    where = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    own = leads(spark, sf).select("_ord", F.pmod("_ord", F.lit(25)).alias("k"))
    return own.join(F.broadcast(where), F.col("k") == F.col("n_nationkey"), "left").select("_ord", "n_name", "r_name")


J2_WORDS = ("the", "and", "tion", "keit", "ment", "ción", "token", "license")


@query(f"SELECT doc_id, {sql_hits('lower(text)', J2_WORDS)} AS n FROM documents WHERE {sql_hits('lower(text)', J2_WORDS)} > 0")
def j2_dictionary(spark, sf):
    own, t = table(spark, sf, "documents"), F.lower("text")
    return own.where(contains_any(t, J2_WORDS)).select("doc_id", hits(t, J2_WORDS).cast("long").alias("n"))


@query(f"{WITH} SELECT l._ord, coalesce(u.source, l.source_type) AS source_type FROM leads l LEFT JOIN (SELECT lang, min_by(source, doc_id) AS source FROM documents WHERE lang <> 'en' GROUP BY lang) u ON u.lang = l.lang")
def j5_override(spark, sf):
    updates = table(spark, sf, "documents").where("lang != 'en'").select("lang", F.col("source").alias("source_type"), F.col("doc_id").alias("_ord"))
    return O.override(leads(spark, sf).select("_ord", "lang", "source_type"), updates, "lang", ["source_type"]).select("_ord", "source_type")


@query(
    "WITH RECURSIVE l AS (SELECT DISTINCT c_nationkey AS src, s_nationkey AS dst FROM customer JOIN supplier ON c_custkey = s_suppkey), w AS (SELECT 0 AS node, 0 AS depth UNION SELECT dst, depth + 1 FROM w JOIN l ON src = node WHERE depth < 2) SELECT node, min(depth) AS depth FROM w GROUP BY node"
)
def j6_a17_reachable(spark, sf):
    links = table(spark, sf, "customer").join(table(spark, sf, "supplier"), F.col("c_custkey") == F.col("s_suppkey")).select(F.col("c_nationkey").alias("src"), F.col("s_nationkey").alias("dst")).distinct()
    return O.reachable(spark, links, spark.createDataFrame([(0,)], "node int"), 2)


@query("SELECT c_custkey FROM customer WHERE c_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 9000)")
def j7_a20_unseen(spark, sf):
    known = table(spark, sf, "supplier").where("s_acctbal > 9000").select(F.col("s_nationkey").alias("c_nationkey"))
    return O.unseen(table(spark, sf, "customer"), known, "c_nationkey").select("c_custkey")


@query(f"WITH t AS (SELECT country FROM ({TRADE}) GROUP BY country ORDER BY sum(value) DESC LIMIT 5), {LEADS_SQL} SELECT _ord, country FROM leads WHERE country IN (SELECT country FROM t)")
def j9_top_importers(spark, sf):
    top = trade(spark, sf).groupBy("country").agg(F.sum("value").alias("v")).orderBy(F.desc("v")).limit(5).select("country")
    return leads(spark, sf).select("_ord", "country").join(top, "country", "left_semi").select("_ord", "country")


CRM = ["_ord", "company", "country", "city", "website", "evidence_snippet", "linkedin_xray"]


@query(
    f"""{WITH} SELECT _ord, company, country, '' AS city, coalesce(website, '') AS website, CASE WHEN length(trim(context, ' ')) > 300 THEN substr(trim(context, ' '), 1, 297) || '...' ELSE trim(context, ' ') END AS evidence_snippet,
  CASE WHEN company <> '' THEN 'site:linkedin.com/in "' || company || '" ("textile" OR "finishing" OR "dyeing" OR "stenter")' ELSE '' END AS linkedin_xray FROM leads"""
)
def k5_crm_slim(spark, sf):
    return O.crm_projection(leads(spark, sf).withColumn("evidence_snippet", F.col("context")), CRM)


@query("SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS value FROM events GROUP BY ALL")
def stream_window_counts(spark, sf):
    from siftlane.streaming.events import window_counts

    own = window_counts(table(spark, sf, "events"))
    return own.select("start", "event_type", "n", F.round("value", 4).alias("value"))
