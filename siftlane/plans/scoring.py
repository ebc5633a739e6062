"""Queries of the scoring models."""

from __future__ import annotations

from pyspark.sql import functions as F

from siftlane import dictionaries as D
from siftlane.operators import scores
from siftlane.plans.collected import query
from siftlane.plans.leads import COUNTRIES, LEADS_SQL, leads, sql_any, sql_first, sql_hits, sql_list
from siftlane.session import table

WITH = "WITH " + LEADS_SQL


@query(
    f"""{WITH}, t AS (SELECT _ord, lower(company || ' ' || context || '  ') AS t FROM leads),
h AS (SELECT _ord, CASE WHEN {sql_any("t", D.SCE_SUPPLIER)} THEN 0.3::DOUBLE ELSE 1.0::DOUBLE END AS cut, {sql_hits("t", D.SCE_E1)} AS n1, {sql_hits("t", D.SCE_E2)} AS n2, {sql_hits("t", D.SCE_E3)} AS n3 FROM t),
e AS (SELECT _ord, cut, least(1.0::DOUBLE, n1 * 0.4::DOUBLE) * cut AS e1, least(1.0::DOUBLE, n2 * 0.25::DOUBLE) * cut AS e2, least(1.0::DOUBLE, n3 * 0.2::DOUBLE) * cut AS e3 FROM h),
s AS (SELECT *, greatest(e1, e2 * 0.6::DOUBLE + e3 * 0.4::DOUBLE, e1 * 0.5::DOUBLE + e2 * 0.3::DOUBLE + e3 * 0.2::DOUBLE) AS total FROM e)
SELECT _ord, round(e1, 3) AS e1, round(e2, 3) AS e2, round(e3, 3) AS e3, round(total, 3) AS sce_score, ((e1 >= 0.4::DOUBLE) OR (e2 >= 0.4::DOUBLE AND e3 >= 0.3::DOUBLE) OR total >= 0.5::DOUBLE) AND cut = 1 AS sce_ready,
  CASE WHEN e1 >= 0.6::DOUBLE OR total >= 0.7::DOUBLE THEN 'high' WHEN e1 >= 0.3::DOUBLE OR total >= 0.4::DOUBLE THEN 'medium' ELSE 'low' END AS sce_confidence FROM s"""
)
def m4_evidence_layers(spark, sf):
    return scores.evidence_layers(leads(spark, sf)).select("_ord", "e1", "e2", "e3", "sce_score", "sce_ready", "sce_confidence")


NEAR = f"(regexp_matches(t, '({'|'.join(scores.NEAR_MACHINES)}).{{0,100}}({'|'.join(scores.NEAR_PARTS)})') OR regexp_matches(t, '({'|'.join(scores.NEAR_PARTS)}).{{0,100}}({'|'.join(scores.NEAR_MACHINES)})'))"
HEURISTIC = f"""{WITH}, t AS (SELECT *, lower(company || ' ' || context || ' ' || coalesce(website, '')) AS t FROM leads),
q AS (SELECT *, least(40, {sql_hits("t", D.HEURISTIC_POSITIVE)} * 10) + CASE WHEN {NEAR} THEN 20 ELSE 0 END + CASE WHEN {sql_any("t", scores.FACILITY)} THEN 15 ELSE 0 END - {sql_hits("t", D.HEURISTIC_NEGATIVE)} * 20 AS s FROM t)"""


@query(f"{HEURISTIC} SELECT _ord, s AS heuristic_score, s >= 25 AS is_lead, CASE WHEN s >= 60 THEN 'high' WHEN s >= 30 THEN 'medium' ELSE 'low' END AS heuristic_confidence FROM q")
def m1_heuristic(spark, sf):
    return scores.heuristic(leads(spark, sf)).select("_ord", F.col("heuristic_score").cast("long").alias("heuristic_score"), "is_lead", "heuristic_confidence")


def priorities(spark, sf):
    """Order value of each stand-in country."""
    customer, orders = table(spark, sf, "customer"), table(spark, sf, "orders")
    country = F.element_at(F.array(*map(F.lit, COUNTRIES)), (F.pmod(F.col("c_nationkey"), F.lit(len(COUNTRIES))) + 1).cast("int"))
    value = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    return value.groupBy(country.alias("country")).agg(F.sum(F.round(F.col("o_totalprice")).cast("long")).cast("double").alias("value"))


PRIORITY_SQL = f"""pri AS (SELECT {sql_list(COUNTRIES)}[c_nationkey % {len(COUNTRIES)} + 1] AS country, CAST(sum(CAST(round(o_totalprice) AS BIGINT)) AS DOUBLE) AS value FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1)"""
MAIL_SQL = "len(regexp_extract_all(lower(context), '[a-z0-9._%+-]+@[a-z0-9.-]+\\.[a-z]{2,}')) > 0"
PHONE_SQL = "len(regexp_extract_all(context, '\\+?\\d[\\d\\s\\-()]{6,}\\d')) > 0"


@query(
    f"""{HEURISTIC}, {PRIORITY_SQL}, c AS (
  SELECT _ord, lower(context || ' ' || company || ' ') AS t, CAST(greatest(0, least(40, s)) AS DOUBLE) AS fit,
    CASE WHEN (SELECT max(value) FROM pri) > 0 THEN least(20.0::DOUBLE, coalesce(pri.value, 0) / (SELECT max(value) FROM pri) * 20) ELSE 0 END AS imp,
    CAST(CASE WHEN {MAIL_SQL} THEN 10 ELSE 0 END + CASE WHEN {PHONE_SQL} THEN 6 ELSE 0 END + CASE WHEN website IS NOT NULL THEN 3 ELSE 0 END AS DOUBLE) AS reach
  FROM q LEFT JOIN pri ON lower(pri.country) = lower(q.country)),
d AS (SELECT *, least(20.0::DOUBLE, {sql_hits("t", D.SIGNAL_FACILITY)} * (20.0::DOUBLE / {len(D.SIGNAL_FACILITY)})) AS cap, least(15, {sql_hits("t", D.SIGNAL_PARTS)} * 3) AS pb, least(20, {sql_hits("t", D.GATE_OEM)} * 5) AS bb FROM c)
SELECT _ord, fit AS fit_score, round(cap + 1e-7, 2) AS capacity_score, round(imp + 1e-7, 2) AS import_score, reach AS reach_score, CAST(pb AS BIGINT) AS product_bonus, CAST(bb AS BIGINT) AS brand_bonus,
  round(least(150.0::DOUBLE, least(100.0::DOUBLE, (fit * 0.4::DOUBLE + cap * 0.2::DOUBLE + imp * 0.2::DOUBLE + reach * 0.2::DOUBLE) * 2.5::DOUBLE) + pb + bb) + 1e-7, 2) AS score FROM d"""
)
def m2_composite(spark, sf):
    own = scores.composite(leads(spark, sf, contacts=True), priorities(spark, sf))
    return own.select(
        "_ord", "fit_score", F.round(F.col("capacity_score") + 1e-7, 2).alias("capacity_score"), F.round(F.col("import_score") + 1e-7, 2).alias("import_score"), "reach_score",
        F.col("product_bonus").cast("long").alias("product_bonus"), F.col("brand_bonus").cast("long").alias("brand_bonus"), F.round(F.col("score") + 1e-7, 2).alias("score"),
    )


C, X = "lower(company)", "lower(context)"
TXT = f"({X} || ' ' || {C})"


@query(
    f"""{WITH}, a AS (SELECT *, {sql_first(f"({X} || chr(10) || {C})", D.V10_NEGATIVE)} AS neg, {sql_hits(f"({TXT} || ' ')", D.V10_FINISHING)} AS ev, {sql_hits(TXT, D.V10_TIER1)} AS t1, {sql_hits(TXT, D.V10_TIER2)} AS t2,
  (contains({TXT}, 'maintenance') OR contains({TXT}, 'bakım')) AS care, CAST(contains(source_type, 'gots') AS INT) + CAST(contains(source_type, 'oekotex') AS INT) + CAST(contains(source_type, 'bettercotton') AS INT) AS cert,
  {sql_any(X, scores.PROFILE_LARGE)} AS large, {sql_any(X, scores.PROFILE_MEDIUM)} AS medium,
  CAST(contains(source_type, 'fair') AS INT) + CAST(contains(source_type, 'job') AS INT) + CAST(contains(source_type, 'trade') OR contains(source_type, 'import') AS INT)
  + CAST({sql_any(X, scores.SIGNAL_EXPANSION)} AS INT) + CAST({sql_any(X, scores.SIGNAL_MODERN)} AS INT) + CAST({sql_any(X, scores.SIGNAL_INVEST)} AS INT) AS sig FROM leads),
b AS (SELECT _ord, neg, CASE WHEN ev >= 3 THEN 30 WHEN ev >= 2 THEN 25 WHEN ev >= 1 THEN 15 ELSE 5 END AS v10_activity,
  CASE WHEN t1 >= 2 OR (t1 >= 1 AND care) THEN 25 WHEN t1 >= 1 THEN 20 WHEN t2 >= 1 THEN 12 ELSE 0 END AS v10_machine,
  CASE WHEN cert >= 2 OR (cert >= 1 AND large) THEN 25 WHEN cert >= 1 THEN 20 WHEN large THEN 15 WHEN medium THEN 12 ELSE 8 END AS v10_profile,
  CASE WHEN sig >= 3 THEN 20 WHEN sig >= 2 THEN 15 WHEN sig >= 1 THEN 10 ELSE 6 END AS v10_signal, CASE WHEN source_type IN ('gots', 'oekotex') THEN 5 ELSE 0 END AS v10_bonus FROM a),
c AS (SELECT *, CASE WHEN neg IS NOT NULL THEN 0 ELSE least(100, v10_activity + v10_machine + v10_profile + v10_signal + v10_bonus) END AS v10_score FROM b)
SELECT _ord, 'Negative signal: ' || neg AS v10_reason, v10_activity, v10_machine, v10_profile, v10_signal, v10_bonus, v10_score,
  CASE WHEN neg IS NOT NULL THEN 'X' WHEN v10_score >= 80 THEN 'A' WHEN v10_score >= 65 THEN 'B' WHEN v10_score >= 50 THEN 'C' ELSE 'D' END AS v10_grade FROM c"""
)
def m3_hundred_points(spark, sf):
    return scores.hundred_points(leads(spark, sf)).select("_ord", "v10_reason", "v10_activity", "v10_machine", "v10_profile", "v10_signal", "v10_bonus", "v10_score", "v10_grade")


WEIGHTS_SQL = "CASE lower(source_type) " + " ".join(f"WHEN '{k}' THEN {float(v)}" for k, v in D.ROLE_SOURCE_WEIGHTS.items()) + " ELSE 0.3 END"


@query(
    f"""{WITH}, t AS (SELECT _ord, source_type, lower(company || ' ' || context || ' ' || coalesce(website, '')) AS t FROM leads),
s AS (SELECT _ord, {sql_hits("t", D.ROLE_STRONG_CUSTOMER)} * 30 - {sql_hits("t", D.ROLE_STRONG_INTERMEDIARY)} * 40 + {sql_hits("t", D.ROLE_CUSTOMER)} * 10 - {sql_hits("t", D.ROLE_INTERMEDIARY)} * 15
  + CAST(round(({WEIGHTS_SQL} - 0.5) * 50) AS INT) AS s, {sql_hits("t", D.ROLE_BRAND)} * 20 AS b FROM t),
r AS (SELECT *, CASE WHEN b >= 40 AND s < 30 THEN 'BRAND' WHEN s >= 30 THEN 'CUSTOMER' WHEN s <= -20 THEN 'INTERMEDIARY' ELSE 'UNKNOWN' END AS role FROM s)
SELECT _ord, role, CAST(s AS DOUBLE) / 100 AS role_score, CAST(least(90, CASE role WHEN 'BRAND' THEN 50 + b WHEN 'CUSTOMER' THEN 50 + s WHEN 'INTERMEDIARY' THEN 50 - s ELSE 30 END) AS DOUBLE) / 100 AS role_confidence FROM r"""
)
def m12_role(spark, sf):
    return scores.role(leads(spark, sf)).select("_ord", "role", "role_score", "role_confidence")


@query(
    f"""{WITH}, t AS (SELECT _ord, source_type, country, lower(company || ' ' || context) AS t FROM leads),
s AS (SELECT _ord, greatest(0, least(100, CASE WHEN list_contains({sql_list(D.QUALIFY_SOURCES)}, source_type) THEN 60 ELSE 0 END + CASE WHEN {sql_any("t", D.QUALIFY_OEM_BRANDS)} THEN 25 ELSE 0 END
  + CASE WHEN {sql_any("t", D.QUALIFY_MACHINERY)} THEN 20 ELSE 0 END + CASE WHEN {sql_any("t", D.QUALIFY_OPERATIONS)} THEN 15 ELSE 0 END + CASE WHEN {sql_any("t", D.QUALIFY_PRODUCT_CATEGORIES)} THEN 10 ELSE 0 END
  - {sql_hits("t", D.QUALIFY_NOT)} * 30 + CASE WHEN {sql_any("lower(country)", D.QUALIFY_COUNTRIES)} THEN 10 ELSE 0 END)) AS q FROM t)
SELECT _ord, q AS qualification_score, q >= 50 AS is_qualified FROM s"""
)
def m15_qualification(spark, sf):
    return scores.qualification(leads(spark, sf)).select("_ord", F.col("qualification_score").cast("long").alias("qualification_score"), "is_qualified")


ACCENTS = ("áàâãäåéèêëíìîïóòôõöúùûüýÿñçşğıİšžčćđ", "aaaaaaeeeeiiiiooooouuuuyyncsgiiszccd")
FOLD = f"replace(replace(replace(replace(replace(translate(lower(context), '{ACCENTS[0]}', '{ACCENTS[1]}'), 'ß', 'ss'), 'æ', 'ae'), 'œ', 'oe'), 'ø', 'o'), 'ł', 'l')"


@query(
    f"""{WITH}, t AS (SELECT _ord, {FOLD} AS t FROM leads), w AS (SELECT _ord, t, {sql_first("t", D.SIGNAL_FINISHING)} AS a, {sql_first("t", D.SIGNAL_STENTER)} AS b, {sql_first("t", D.SIGNAL_PARTS)} AS c, {sql_first("t", D.SIGNAL_FACILITY)} AS d FROM t),
s AS (SELECT *, CASE WHEN a IS NULL THEN 0 ELSE 3 END + CASE WHEN b IS NULL THEN 0 ELSE 4 END + CASE WHEN c IS NULL THEN 0 ELSE 3 END + CASE WHEN d IS NULL THEN 0 ELSE 1 END AS p FROM w),
f AS (SELECT *, CAST(CASE WHEN p > 0 AND {sql_any("t", D.SIGNAL_NEGATIVE)} THEN greatest(0, p - 1.5) ELSE p END AS DOUBLE) AS score FROM s)
SELECT _ord, concat_ws(',', CASE WHEN a IS NOT NULL THEN 'finishing' END, CASE WHEN b IS NOT NULL THEN 'stenter' END, CASE WHEN c IS NOT NULL THEN 'parts' END, CASE WHEN d IS NOT NULL THEN 'facility' END) AS signals,
  concat_ws(',', a, b, c, d) AS signal_words, score AS signal_score, CASE WHEN score >= 6 THEN 'high' WHEN score >= 3 THEN 'medium' ELSE 'low' END AS signal_confidence FROM f"""
)
def m8_signals(spark, sf):
    return scores.signals(leads(spark, sf)).select("_ord", F.array_join("signals", ",").alias("signals"), F.array_join("signal_words", ",").alias("signal_words"), "signal_score", "signal_confidence")


@query(
    f"""{WITH}, t AS (SELECT _ord, source_type, lower(company || ' ' || context) AS t FROM leads),
g AS (SELECT _ord, {sql_any("t", scores.TRIGGER_FACILITY)} AS f, contains(source_type, 'fair') OR contains(source_type, 'exhibitor') OR {sql_any("t", scores.TRIGGER_FAIR)} AS e, {sql_any("t", scores.TRIGGER_JOB)} AS j FROM t)
SELECT _ord, concat_ws(',', CASE WHEN f THEN 'new_facility' END, CASE WHEN e THEN 'fair_participation' END, CASE WHEN j THEN 'job_posting' END) AS triggers, CAST(f AS INT) + CAST(e AS INT) + CAST(j AS INT) AS trigger_count,
  CASE WHEN f THEN 15 ELSE 0 END + CASE WHEN e THEN 10 ELSE 0 END + CASE WHEN j THEN 8 ELSE 0 END AS trigger_bonus, CASE WHEN f OR e THEN 'high' WHEN j THEN 'medium' END AS trigger_priority,
  concat_ws(',', CASE WHEN j THEN 'add_to_nurture' END, CASE WHEN f THEN 'fast_profile' END, CASE WHEN e THEN 'score_boost' END) AS trigger_actions FROM g"""
)
def m16_triggers(spark, sf):
    own = scores.triggers(leads(spark, sf))
    return own.select("_ord", F.array_join(F.transform("triggers", lambda x: x["type"]), ",").alias("triggers"), "trigger_count", "trigger_bonus", "trigger_priority", F.array_join("trigger_actions", ",").alias("trigger_actions"))


HS = scores.HS_RULES
HS_TEXT = "lower(context || ' ' || company)"


@query(
    f"""{WITH}, t AS (SELECT _ord, {HS_TEXT} AS t FROM leads)
SELECT _ord, CASE WHEN {sql_any("t", HS[0][0])} THEN '{HS[0][1]}' WHEN {sql_any("t", HS[1][0])} THEN '{HS[1][1]}' WHEN {sql_any("t", HS[2][0])} THEN '{HS[2][1]}' ELSE '845190' END AS hs_primary,
  CASE WHEN {sql_any("t", HS[0][0])} THEN '{HS[0][3]}' WHEN {sql_any("t", HS[1][0])} THEN '{HS[1][3]}' WHEN {sql_any("t", HS[2][0])} THEN '{HS[2][3]}' ELSE 'default_stenter_parts' END AS hs_reason FROM t"""
)
def s33_hs_codes(spark, sf):
    return scores.hs_codes(leads(spark, sf)).select("_ord", "hs_primary", "hs_reason")


@query(
    f"""{WITH}, m AS (SELECT _ord, list_distinct(regexp_extract_all(lower(context), '[a-z0-9._%+-]+@[a-z0-9.-]+\\.[a-z]{{2,}}')) AS ms, {PHONE_SQL} AS ph FROM leads),
p AS (SELECT _ord, ph, list_transform(ms, lambda x: CASE WHEN regexp_matches(split_part(x, '@', 1), '^({"|".join(D.MAIL_GENERIC)})') THEN 0 WHEN list_contains({sql_list(D.MAIL_INFO)}, split_part(x, '@', 1)) THEN 10
  WHEN regexp_matches(split_part(x, '@', 1), '^({"|".join(D.MAIL_DEPARTMENT)})') THEN 30 WHEN contains(split_part(x, '@', 1), '.') OR contains(split_part(x, '@', 1), '_') THEN 60 ELSE 20 END) AS ps FROM m)
SELECT _ord, least(100, coalesce(list_max(ps), 0) + CASE WHEN ph THEN 20 ELSE 0 END) AS contactability_score FROM p"""
)
def s42_contactability(spark, sf):
    return scores.contactability(leads(spark, sf, contacts=True)).select("_ord", F.col("contactability_score").cast("int").alias("contactability_score"))


@query(
    "SELECT p_partkey, CASE WHEN 2000 + p_size IS NULL THEN 'unknown' WHEN 2000 + p_size BETWEEN 2016 AND 2021 THEN 'high' WHEN 2000 + p_size BETWEEN 2023 AND 2026 THEN 'low' ELSE 'medium' END AS machine_age_priority, "
    "CASE WHEN 2000 + p_size BETWEEN 2016 AND 2021 THEN 20 WHEN 2000 + p_size BETWEEN 2023 AND 2026 THEN -10 ELSE 0 END AS urgency_boost FROM part"
)
def s39_machine_age(spark, sf):
    own = table(spark, sf, "part").select("p_partkey", (F.col("p_size") + 2000).alias("estimated_installation_year"))
    return scores.machine_age(own).select("p_partkey", "machine_age_priority", "urgency_boost")


@query(
    f"""{WITH}, k AS (SELECT _ord, score, CAST(list_contains(['oekotex', 'gots', 'known_manufacturer', 'oem_customer', 'fair', 'directory'], source_type) AS INT) AS k1, CAST(website IS NOT NULL AS INT) AS k2, CAST(coalesce(score, 0) AS INT) AS con FROM leads),
e AS (SELECT *, CASE WHEN k1 >= 2 THEN 50 WHEN k1 = 1 THEN 35 ELSE 0 END + CASE WHEN k2 >= 2 THEN 30 WHEN k2 = 1 THEN 20 ELSE 0 END AS ev FROM k),
f AS (SELECT *, round(ev * 0.5::DOUBLE + con * 0.3::DOUBLE, 2) AS fin FROM e)
SELECT _ord, k1 AS k1_count, k2 AS k2_count, ev AS evidence_score, k1 >= 1 AND k2 >= 1 AS is_golden, fin AS final_score,
  CASE WHEN k1 >= 1 AND k2 >= 1 AND fin >= 60 AND con >= 40 THEN 1 WHEN (k1 >= 1 OR k2 >= 1) AND fin >= 40 THEN 2 ELSE 3 END AS tier FROM f"""
)
def m9_m10_final_score(spark, sf):
    own = leads(spark, sf).withColumn("signals", F.when(F.col("website").isNotNull(), F.array(F.lit("x"))).otherwise(F.array().cast("array<string>"))).withColumn("oem_brand", F.lit(""))
    own = scores.final_score(scores.evidence_counts(own).withColumn("contactability_score", F.coalesce("score", F.lit(0.0)).cast("int")))
    return own.select("_ord", "k1_count", "k2_count", "evidence_score", "is_golden", "final_score", "tier")
