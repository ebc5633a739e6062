"""A lead table made of the driver's tables, in Spark and as DuckDB SQL.

A document is a lead: its first line is the company, its text the context; page and country follow from its
number, the source type from that of its source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftlane import dictionaries as D
from siftlane.functions.text import emails, phones
from siftlane.session import spread, table

COUNTRIES = tuple(c.title() for c in D.GATE_COUNTRIES)
SOURCES = (*D.SOURCE_PRIORITY, "facility_verified")


def leads(spark: SparkSession, sf_dir: str, contacts: bool = False) -> DataFrame:
    """_ord, company, country, context, source_type, website, html, score; with emails and phones if asked for."""
    docs, pages, labels = spread(table(spark, sf_dir, "documents")), table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels")
    country = F.element_at(F.array(*map(F.lit, COUNTRIES)), (F.pmod(F.col("doc_id"), F.lit(len(COUNTRIES))) + 1).cast("int"))
    source = F.element_at(F.array(*map(F.lit, SOURCES)), (F.pmod(F.substring("source", 4, 9).cast("int"), F.lit(len(SOURCES))) + 1).cast("int"))
    first_line = F.explode(F.array(F.trim(F.substring_index("text", "\n", 1))))  # so it is taken once (see session.once)
    own = docs.select(
        F.col("doc_id").alias("_ord"), first_line.alias("company"), country.alias("country"), F.col("text").alias("context"), source.alias("source_type"), "lang"
    )
    out = own.join(pages.select(F.col("page_id").alias("_ord"), F.col("url").alias("website"), "html"), "_ord", "left")
    out = out.join(labels.select(F.col("doc_id").alias("_ord"), (F.col("quality") * 60 - F.col("toxic") * 20).cast("double").alias("score")), "_ord", "left")
    return out.withColumn("emails", emails("context")).withColumn("phones", phones("context")) if contacts else out


def sql_list(words) -> str:
    return "[" + ", ".join("'" + str(w).replace("'", "''") + "'" for w in words) + "]"


def sql_hits(text: str, words) -> str:
    """How many of the words a text holds."""
    return f"len(list_filter({sql_list(words)}, lambda k: contains({text}, k)))"


def sql_any(text: str, words) -> str:
    return f"(len(list_filter({sql_list(words)}, lambda k: contains({text}, k))) > 0)"


def sql_first(text: str, words) -> str:
    return f"list_filter({sql_list(words)}, lambda k: contains({text}, k))[1]"


LEADS_SQL = f"""
leads AS (
  SELECT d.doc_id AS _ord, trim(split_part(d.text, chr(10), 1), ' ') AS company, {sql_list(COUNTRIES)}[d.doc_id % {len(COUNTRIES)} + 1] AS country, d.text AS context,
         {sql_list(SOURCES)}[CAST(substr(d.source, 4) AS INT) % {len(SOURCES)} + 1] AS source_type, d.lang, p.url AS website, p.html AS html, CAST(l.quality * 60 - l.toxic * 20 AS DOUBLE) AS score
  FROM documents d LEFT JOIN pages p ON p.page_id = d.doc_id LEFT JOIN labels l ON l.doc_id = d.doc_id
)"""
