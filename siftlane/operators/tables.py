"""Joins, counts, shares, quotas and rankings over lead tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siftlane import dictionaries as D
from siftlane.session import checkpointed


def union_sources(*frames: tuple[DataFrame, str]) -> DataFrame:
    """All rows of frames whose columns may differ; a missing source_type becomes the given one."""
    out = None
    for frame, source in frames:
        own = frame if "source_type" in frame.columns else frame.withColumn("source_type", F.lit(None).cast("string"))
        own = own.withColumn("source_type", F.coalesce("source_type", F.lit(source)))
        out = own if out is None else out.unionByName(own, allowMissingColumns=True)
    return out


def renamed(df: DataFrame, aliases: dict[str, Iterable[str]]) -> DataFrame:
    """Columns under their canonical names; of several synonyms the first in the list wins."""
    for name, others in aliases.items():
        there = [c for c in others if c in df.columns and c != name]
        if name not in df.columns and there:
            df = df.withColumnRenamed(there[0], name)
    return df


def override(master: DataFrame, updates: DataFrame, key: str, columns: Iterable[str]) -> DataFrame:
    """master with the columns of its update where that has a value; of several updates of a key the first by _ord."""
    columns = list(columns)
    first = updates.groupBy(key).agg(*[F.min_by(c, "_ord").alias(f"__{c}") for c in columns])
    out = master.join(first, key, "left")
    return out.select(*[F.coalesce(f"__{c}", c).alias(c) if c in columns else F.col(c) for c in master.columns])


def unseen(df: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Rows whose key isn't known."""
    return df.join(known.select(key).distinct(), key, "left_anti")


def reachable(spark: SparkSession, links: DataFrame, seeds: DataFrame, depth: int = 2) -> DataFrame:
    """(node, depth): what can be reached from the seeds over links (src, dst) in so many steps, each at its least depth."""
    seen = seeds.select("node").distinct().withColumn("depth", F.lit(0))
    front = seen
    for d in range(1, depth + 1):
        found = front.join(links, front.node == links.src).select(F.col("dst").alias("node")).distinct()
        front = found.join(seen, "node", "left_anti").withColumn("depth", F.lit(d))
        seen = seen.unionByName(front)
    return seen


def counts(df: DataFrame, key: str, top: int | None = None) -> DataFrame:
    """(key, n, share): rows of each value and their share of all, most first; ``top`` is a report's length.

    The total is summed over the counts, one row for each value, so no row of df is gathered."""
    own = df.groupBy(key).agg(F.count("*").alias("n"))
    total = own.agg(F.sum("n")).scalar()
    out = own.select(key, "n", F.round(F.col("n") / total, 6).alias("share")).orderBy(F.desc("n"), key)
    return out.limit(top) if top else out


def source_yield(leads: DataFrame, least: int = 50, least_yield: float = 0.10) -> DataFrame:
    """Of each source: total, tiers 1 to 3, yield (tiers 1 and 2 over all) and whether it should be dropped."""
    tier = lambda k: F.count_if(F.col("tier") == k).alias(f"tier{k}")
    own = leads.groupBy("source_type").agg(F.count("*").alias("total"), tier(1), tier(2), tier(3))
    own = own.withColumn("yield", F.round((F.col("tier1") + F.col("tier2")) / F.col("total"), 6))
    return own.withColumn("drop_source", (F.col("total") >= least) & (F.col("yield") < least_yield))


def max_share(df: DataFrame, value: str, most: float, name: str) -> DataFrame:
    """value as a share of its greatest, times ``most``; the greatest is a scalar subquery."""
    top = df.agg(F.max(value)).scalar()
    return df.withColumn(name, F.when(top > 0, F.round(F.col(value) / top * most, 6)).otherwise(0.0))


REGIONS = {  # fixed values: the regions of the quotas, their countries and shares
    "south_america": (("brazil", "argentina", "chile", "colombia", "peru", "ecuador", "uruguay"), 300),
    "north_africa": (("egypt", "morocco", "tunisia", "algeria", "libya"), 150),
    "middle_east": (("turkey", "uae", "saudi arabia", "jordan", "lebanon", "israel"), 75),
}


def region_of(country: Column) -> Column:
    out = F.lit("other")
    for name, (countries, _) in REGIONS.items():
        out = F.when(F.lower(F.trim(country)).isin(*countries), name).otherwise(out)
    return out


def top_of_each(df: DataFrame, key: str, order: list[Column], most: dict[str, int], other: int | None = None) -> DataFrame:
    """At most so many rows of each key, the first by ``order``; keys without a number have ``other``, or all their rows.

    Ranked keys are salted: each salt's rows are ranked and cut first, so no task holds a key whole,
    and what is left (salts times the number at most) is ranked again.
    """
    table = F.create_map(*[F.lit(x) for kv in most.items() for x in kv])
    number = F.coalesce(F.try_element_at(table, F.col(key)), F.lit(other).cast("int"))
    work = df.withColumn("__most", number)
    free = work.where("__most is null").drop("__most")
    capped = work.where("__most is not null").withColumn("__salt", F.pmod(F.xxhash64(*df.columns), F.lit(32)))
    for partition in ((key, "__salt"), (key,)):
        rank = F.row_number().over(Window.partitionBy(*partition).orderBy(*order))
        capped = capped.withColumn("__rank", rank).where("__rank <= __most").drop("__rank")
    return capped.select(*df.columns).unionByName(free)


def seeded_sample(df: DataFrame, n: int, key: str, seed: int = 7) -> DataFrame:
    """n rows in the order of a hash of their key: the same rows each time."""
    return df.orderBy(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string"))), key).limit(n)


def trade_kpis(facts: DataFrame) -> DataFrame:
    """Of each country: latest value, yearly growth, its volatility, and the concentration of partners (sum of squared shares).

    facts: country, year, partner, value. Years and partners are summed first; the windows are over a country's years.
    """
    years = facts.groupBy("country", "year").agg(F.sum("value").alias("value"))
    w = Window.partitionBy("country").orderBy("year")
    grown = years.withColumn("growth", F.col("value") / F.lag("value").over(w) - 1)
    span = grown.groupBy("country").agg(
        F.max_by("value", "year").alias("latest_value"), F.min_by("value", "year").alias("__first"), (F.max("year") - F.min("year")).alias("__years"), F.stddev_samp("growth").alias("volatility")
    )
    partners = facts.groupBy("country", "partner").agg(F.sum("value").alias("v"))
    total = partners.groupBy("country").agg(F.sum("v").alias("__t"))
    hhi = partners.join(total, "country").groupBy("country").agg(F.sum(F.pow(F.col("v") / F.col("__t"), 2)).alias("hhi"), F.count("*").alias("n_partners"))
    cagr = F.when(F.col("__years") > 0, F.pow(F.col("latest_value") / F.col("__first"), 1 / F.col("__years")) - 1)
    return span.join(hhi, "country").select("country", "latest_value", cagr.alias("cagr"), "volatility", "hhi", "n_partners")


def crm_projection(leads: DataFrame, columns: Iterable[str]) -> DataFrame:
    """The listed columns as clean text or numbers, missing ones empty; a search string from the company where none is."""
    from siftlane.functions.text import clean, shortened, text_of

    out = []
    for c in columns:
        if c == "linkedin_xray":
            made = F.when(F.trim(text_of("company")) != "", F.concat(F.lit('site:linkedin.com/in "'), F.trim(text_of("company")), F.lit('" ("textile" OR "finishing" OR "dyeing" OR "stenter")')))
            out.append(F.coalesce(clean(c) if c in leads.columns else F.lit(None).cast("string"), made, F.lit("")).alias(c))
        elif c not in leads.columns:
            out.append(F.lit("").alias(c))
        elif c == "evidence_snippet":
            out.append(shortened(F.coalesce(clean(c), F.lit(""))).alias(c))
        elif dict(leads.dtypes)[c] == "string":
            out.append(F.coalesce(clean(c), F.lit("")).alias(c))
        else:
            out.append(F.col(c))
    return leads.select(*out)


MAIL_PATTERNS = {  # fixed values: local parts by language and their priority
    "en": (("sales", 10), ("export", 9), ("info", 8), ("contact", 7), ("office", 5)),
    "pt": (("vendas", 10), ("comercial", 9), ("contato", 8), ("exportacao", 7)),
    "es": (("ventas", 10), ("comercial", 9), ("contacto", 8), ("exportacion", 7)),
    "tr": (("satis", 10), ("ihracat", 9), ("bilgi", 8), ("iletisim", 7)),
    "de": (("vertrieb", 10), ("verkauf", 9), ("kontakt", 7)),
    "fr": (("ventes", 10), ("commercial", 9), ("contact", 8)),
}
COUNTRY_LANGUAGE = {"brazil": "pt", "portugal": "pt", "argentina": "es", "chile": "es", "colombia": "es", "peru": "es", "ecuador": "es", "mexico": "es", "spain": "es", "turkey": "tr", "germany": "de", "tunisia": "fr", "morocco": "fr", "france": "fr"}


def guessed_emails(leads: DataFrame, top: int = 3) -> DataFrame:
    """leads with guesses: the likeliest addresses at a domain, the country's language before English, by priority; ``top`` is how many are told."""
    from siftlane.functions.text import low
    from siftlane.functions.web import clean_domain

    table = F.create_map(*[F.lit(x) for kv in COUNTRY_LANGUAGE.items() for x in kv])
    lang = F.coalesce(F.try_element_at(table, low("country")), F.lit("en"))
    ranked = {}
    for name, own in MAIL_PATTERNS.items():
        pool = dict(own) | {k: v for k, v in MAIL_PATTERNS["en"] if k not in dict(own)}
        ranked[name] = sorted(pool, key=lambda k: -pool[k])[:top]
    locals_ = F.create_map(*[x for k, v in ranked.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    made = F.transform(locals_[lang], lambda p: F.concat(p, F.lit("@"), clean_domain("website")))
    return leads.withColumn("guesses", F.when(clean_domain("website").isNotNull(), made).otherwise(F.array().cast("array<string>")))


def configured_entities(config: DataFrame, context: str, *, region: str = "region", countries: str = "countries") -> DataFrame:
    """Rows (region, country, company, source_type, context) of a configuration: a region, and its countries as a map to lists of companies."""
    own = config.select(F.col(region).alias("region"), F.explode(countries).alias("country", "names")).select("region", "country", F.explode("names").alias("company"))
    return own.withColumn("source_type", F.lit("known_manufacturer")).withColumn("context", F.lit(context))


def known_entities(spark: SparkSession, regions: dict[str, dict[str, list[str]]], context: str) -> DataFrame:
    """Rows of a configured region -> country -> companies table."""
    return configured_entities(spark.createDataFrame(list(regions.items()), "region string, countries map<string,array<string>>"), context)


COUNTRIES = D.GATE_COUNTRIES


def sales_priority(leads: DataFrame) -> DataFrame:
    """leads with priority 1 to 5: ready, website and e-mail, e-mail, website, neither."""
    from siftlane.functions.web import blocked
    from siftlane.operators.gates import has_value

    site, mail = has_value("website") & ~blocked("website", D.DOMAIN_BLOCKLIST), F.size("emails") > 0
    return leads.withColumn("priority", F.when(F.col("sales_ready"), 1).when(site & mail, 2).when(mail, 3).when(site, 4).otherwise(5))




#: What a golden record says of a lead.
GOLDEN_COLUMNS = (
    "company", "country", "website", "why_customer", "evidence_url", "evidence_snippet", "target_product", "hs_code", "best_email", "phone", "linkedin_xray", "contact_person",
    "contact_role", "sales_angle", "final_score", "evidence_score", "contactability_score", "tier", "is_golden", "source",
)
WHY_BRAND, WHY_JOB = " referans listesinde görülüyor, stenter kullanımı doğrulanmış.", "Stenter operatörü arıyor, aktif üretim tesisi."
WHY_SIGNALS, WHY_ELSE = ("Web sitesinde ", " terimleri geçiyor."), "Tekstil terbiye tesisi olarak tespit edildi."
ANGLE_BRANDS = {"Monforts": "Monforts zincir baklası ve gleitstein uyumluluğu vurgula", "Brückner": "Brückner kluppen ve segment parçaları için teklif hazırla"}
ANGLE_COUNTRIES = {
    "brazil": "Hızlı teslimat ve yerel stok avantajı vurgula", "argentina": "Hızlı teslimat ve yerel stok avantajı vurgula", "turkey": "Türkçe destek ve hızlı servis vurgula",
    "türkiye": "Türkçe destek ve hızlı servis vurgula",
}
ANGLE_ELSE = "Orijinal kalitede, rekabetçi fiyat ve hızlı teslimat"


def golden_records(leads: DataFrame, keys: Iterable[str] = ()) -> DataFrame:
    """The keys, and the twenty columns of a golden record; what the leads don't have is null, or empty for texts that are made
    up of lists (evidence_url and evidence_snippet of the first items, best_email, phone)."""
    has = lambda c: c in leads.columns
    plain = lambda c, kind="string": F.col(c) if has(c) else F.lit(None).cast(kind)
    first = lambda c: F.coalesce(F.get(c, F.lit(0)), F.lit("")) if has(c) else F.lit("")
    brand = F.coalesce(plain("oem_brand"), F.lit(""))
    empty = F.array().cast("array<string>")
    words = F.coalesce(*[F.when(F.size(c) > 0, F.col(c)) for c in ("stenter_signals", "finishing_signals") if has(c)], empty)
    why = F.when(brand != "", F.concat(brand, F.lit(WHY_BRAND))).when(F.coalesce(plain("evidence_type"), F.lit("")) == "job_posting", WHY_JOB)
    why = why.when(F.size(words) > 0, F.concat(F.lit(WHY_SIGNALS[0]), F.array_join(F.slice(words, 1, 2), ", "), F.lit(WHY_SIGNALS[1]))).otherwise(WHY_ELSE)
    of = lambda table: F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    angle = F.coalesce(F.try_element_at(of(ANGLE_BRANDS), brand), F.try_element_at(of(ANGLE_COUNTRIES), F.lower(F.coalesce(plain("country"), F.lit("")))), F.lit(ANGLE_ELSE))
    made = {
        "why_customer": why,
        "evidence_url": F.coalesce(F.get("k1_details", F.lit(0))["url"], F.lit("")) if has("k1_details") else F.lit(""),
        "evidence_snippet": F.substring(first("evidence_snippets"), 1, 200),
        "target_product": F.coalesce(plain("target_product"), F.lit("")),
        "hs_code": F.lit("8451.90"),
        "best_email": first("emails_extracted"),
        "phone": first("phones_extracted"),
        "sales_angle": angle,
    }
    numbers = {"final_score": "double", "evidence_score": "double", "contactability_score": "double", "tier": "int", "is_golden": "boolean"}
    return leads.select(*keys, *[made.get(c, plain(c, numbers.get(c, "string"))).alias(c) for c in GOLDEN_COLUMNS])


def quality_report(leads: DataFrame) -> DataFrame:
    """One row: rows; coverage of websites, e-mails and telephones; the share of customers; of leads with layers of evidence the
    share that is ready for sales and the mean of each layer; and what to do about them. Missing columns count as empty."""
    from siftlane.operators.gates import has_value

    has = lambda c: c in leads.columns
    share = lambda c: F.avg(F.coalesce(c, F.lit(False)).cast("int"))
    some = lambda c: (F.size(c) > 0 if dict(leads.dtypes)[c].startswith("array") else has_value(c)) if has(c) else F.lit(False)
    role = F.coalesce(F.col("role"), F.lit("UNKNOWN")) == "CUSTOMER" if has("role") else F.lit(False)
    layers = [F.round(F.avg(c), 3).alias(f"avg_{c}") if has(c) else F.lit(None).cast("double").alias(f"avg_{c}") for c in ("e1", "e2", "e3")]
    ready = share(F.col("sce_ready")) if has("sce_ready") else F.lit(None).cast("double")
    south = F.count_if(F.col("country").isin("Brazil", "Argentina", "Colombia", "Peru", "Ecuador", "Chile"))
    out = leads.agg(
        F.count("*").alias("n"), share(some("website")).alias("website_coverage"), share(some("emails")).alias("email_coverage"), share(some("phones")).alias("phone_coverage"), share(role).alias("precision_estimate"),
        ready.alias("sales_ready_ratio"), *layers, F.count_distinct("country").alias("n_countries"), south.alias("n_south_america"), F.count_distinct("source_type").alias("n_sources"),
    )
    low = lambda c, limit, say: F.when(F.coalesce(F.col(c), F.lit(0.0)) < limit, say)
    advice = F.array_compact(
        F.array(
            low("website_coverage", 0.7, "enrich websites"), low("email_coverage", 0.5, "enrich contacts"), low("precision_estimate", 0.5, "review role words"), low("sales_ready_ratio", 0.3, "look for finishing sources"),
            low("n_south_america", 100, "collect South America"), low("n_sources", 5, "add collectors"),
        )
    )
    return out.withColumn("recommendations", F.when(F.size(advice) > 0, advice).otherwise(F.array(F.lit("healthy"))))


def distributions(leads: DataFrame, columns: Iterable[str] = ("role", "sce_confidence", "country", "source_type"), top: int = 20) -> DataFrame:
    """(column, value, n): the commonest values of each column, ``top`` of each, which is a report's length; equal ones by name."""
    there = [c for c in columns if c in leads.columns]
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.coalesce(F.col(c).cast("string"), F.lit("Unknown")).alias("value")) for c in there]))
    counted = leads.select(pairs.alias("x")).groupBy("x.column", "x.value").agg(F.count("*").alias("n"))
    return top_of_each(counted, "column", [F.desc("n"), F.col("value")], {c: top for c in there})


def target_exports(leads: DataFrame, score: str = "score", top: int = 100) -> dict[str, DataFrame]:
    """What an export of targets writes: master, the ``top`` of the greatest score (equal ones by _ord), and a search query for each company."""
    queries = crm_projection(leads.where(F.coalesce("company", F.lit("")) != ""), ["_ord", "linkedin_xray"])
    return {"targets_master": leads, "top100": leads.orderBy(F.desc_nulls_last(score), "_ord").limit(top), "linkedin_xray_queries": queries.select("_ord", F.col("linkedin_xray").alias("query"))}


def global_rank(df: DataFrame, score: str) -> DataFrame:
    """df with rank: one more than the rows of a greater score, nulls last.

    Distinct scores are dealt by ranges, counted by range, and each range begins where the prefix sums over
    the ranges (a row for each) say; so no task sees more than its range of scores."""
    counts = df.groupBy(score).agg(F.count("*").alias("__n"))
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = checkpointed(counts.repartitionByRange(parts, F.desc_nulls_last(score)).withColumn("__part", F.spark_partition_id()))
    sums = dealt.groupBy("__part").agg(F.sum("__n").alias("__t"))
    base = sums.select("__part", (F.sum("__t").over(Window.orderBy("__part")) - F.col("__t")).alias("__base"))  # a row for each partition
    own = Window.partitionBy("__part").orderBy(F.desc_nulls_last(score))
    ranks = dealt.join(F.broadcast(base), "__part").withColumn("rank", F.col("__base") + F.sum("__n").over(own) - F.col("__n") + 1)
    return df.join(ranks.select(F.col(score).alias("__s"), "rank"), F.col(score).eqNullSafe(F.col("__s"))).drop("__s")
