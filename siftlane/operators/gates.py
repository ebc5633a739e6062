"""Record-level gates over lead tables: each adds decision columns and drops nothing.

Column names are those of the lead table; a missing text column counts as empty where ``col_or_empty`` reads it.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftlane import dictionaries as D
from siftlane.functions.text import clean, contains_any, first_word, let, low, normalize_country, squeezed, text_of
from siftlane.functions.web import blocked, host
from siftlane.functions.words import Words, words_of_columns
from siftlane.operators.rules import Rule, banded, first_reason, reasons
from siftlane.session import once

#: The patterns of the name gates.
NAME_EVENT = r"\b(event|summit|conference|review|news|expo|fair|exhibition)\b"
NAME_BARE = r"^(the |a )?(textile|dyeing|finishing|machine)$"
NAME_YEAR = r"\d{4}\s*(event|summit|conference)"
NAME_SUFFIX = r"\w+\s+(ltd|inc|llc|gmbh|sa|srl)"
LEGAL = (
    r"(?iuU)\b(gmbh|ltd|llc|inc|corp|sa\b|s\.a\.|ag\b|a\.g\.|kg\b|k\.g\.|co\.|company|limited|plc|pty|bv\b|b\.v\.|nv\b|n\.v\.|"
    r"srl|s\.r\.l\.|spa|s\.p\.a\.|as\b|a\.s\.|oy|ab\b|anonim|a\.ş\.|ltd\.şti\.|ltda|cia|industries|group|holdings|bros|brothers|sons|e\.?\s*cia)\b"
)
HEADLINE = (
    r"(?iuU)^(Advanced|Premium|Value|Booming|Fascinating|Global|Technical|Modern|New|Latest|Industrial|Efficient|Sustainable|Innovative|Leading|Major)\s+"
    r"(Textile|Textiles|Finishing|Dyeing|Fabric|Fabrics|Processing|Manufacturing)s?\b|\bTextile\s+(Manufacturers?|Industry|Sector|Production|World|Technology)\b|"
    r"\b(CKNER|NFORTS|ANTEX)\s+|^(For|The|In|On|At|To|Of|With)\s+\w+\s+(Textile|Finishing)|\bEnergy\s+Efficiencies?\s+For\b|"
    r"\bMachine\s+Orders?\s+(From|To)\b|\bPuts?\s+A\s+Premium\b|\bThermatron\s+The\b"
)
TITLE = (
    r"(?iuU)^.{0,50}:\s|\bTypes?,\s|\bMachine:\s|\bGuide\s+(to|for)\b|\bHow\s+to\b|\bWhat\s+is\b|\bIntroduction\s+to\b|\b(Top|Best|Latest)\s+\d+\b|"
    r"^The\s+(New|Latest|Best)\b|:$|^Textile\s+Stenter\b|\bMachine$|,\s*(What|How|Why|Who|When|Where)\b|^\w+,\s+(What|How|Why)\b|\bFrame$"
)
SENTENCE = (
    r"(?iuU)^(We|They|Our|It|This|That)\s+(are|is|was|were|have|has|will)\b|\b(fully|now|recently|currently)\s+(supported|available|launched)\b|"
    r"^(Here|There|Now|Also)\s+|\band\s+more\b|\betc\.?\b|^\d+\s+years?\b|\bsince\s+\d{4}\b|\s+at\s+the\s+|\s+in\s+the\s+|"
    r"\s+plant\s+o[fn]?\b|\s+factory\s+o[fn]?\b|\s+facility\s+o[fn]?\b"
)
PERSON = (
    r"(?iuU)\b(Technologist|Manager|Director|Engineer|Specialist|Consultant|Expert|Officer|Head|Chief|Supervisor|Coordinator|Analyst|"
    r"CEO|CFO|CTO|COO|Owner|Founder|President|VP|Vice)\b|\bfor\s+(Dyeing|Finishing|Production|Quality|Sales|Marketing)\b"
)
MACHINE = (
    r"(?iuU)^(Brückner|Monforts|Krantz|Artos|Santex|Babcock|Goller)\s+(Stenter|Tenter|Machine|Ram|Range|Line|System|Equipment)\b|"
    r"^Stenter\s+(Machine|Frame|Range|Line)|^(Horizontal|Vertical)\s+(Chain|Kette)|\bGleitstein\b|\bKluppen\b|\bBuchse\b"
)
ARTICLE = r"(?iuU)^(the|of|in|a|an|to|for|with|from|by)\s+\w+$"
ADJECTIVE_NOUN = (
    r"(?iuU)^(upcoming|new|latest|modern|advanced|sustainable|technical|home|quality|german|turkish|brazilian)\s+"
    r"(textile|textiles|machinery|machine|machines|fabric|fabrics|finishing|dyeing)s?$"
)
GENERIC_PHRASE = r"(?iuU)^(\w+\s+){0,3}(textile|textiles|fabric|fabrics|finishing|dyeing|weaving|spinning|mills?|manufacturing)s?$"
PARTS_SUPPLIER = (
    r"(?iuU)\b(spare\s*parts?|parts?\s*supplier|parts?\s*trading|machinery\s*parts?|machine\s*parts?|spares?\s*stock|trading\s*company|trading\s*co|"
    r"import\s*export|consultancy|consulting|solutions?\s*provider|machinery\s*dealer|equipment\s*dealer|reseller|distributor)\b"
)
URL_LIKE = r"(?i)^(https?://|www\.)|\.(com|org|net)(/|$)"
ENTITY_PRIORITY = {"end_user": 100, "brand": 60, "unknown": 40, "intermediary": 10, "association": 0}


def col_or_empty(df: DataFrame, name: str) -> Column:
    return text_of(name) if name in df.columns else F.lit("")


def has_value(c: str | Column) -> Column:
    return clean(c).isNotNull()


def words_of(c: Column) -> Column:
    return F.filter(F.split(c, r"\s+"), lambda w: w != "")


# --- sanitising and contracts -------------------------------------------------------------------------------------------------------------


def sanitise(leads: DataFrame) -> DataFrame:
    """Leads with a company; web addresses and words for nothing leave the country, aliases are resolved, white space is squeezed."""
    country = F.when(F.col("country").rlike(URL_LIKE), "").otherwise(normalize_country("country"))
    return once(leads, company=squeezed(text_of("company"))).where("company != ''").withColumn("country", country)


#: Names that are page furniture, generic names, signs of addresses, and other names of countries, in lead contracts.
CONTRACT_NOISE = (
    "view basket", "new expertise", "energy", "yarn", "clients", "home_", "istanbul event", "sign in", "menu", "header", "footer", "nav", "cookie", "privacy policy", "terms", "about us",
    "contact us", "read more", "learn more", "click here", "subscribe", "newsletter", "section", "slide", "tab", "button", "link", "loading", "please wait", "error", "404", "403",
    "search results", "no results", "empty", "undefined", "null", "textile world", "textile machinery", "textile industry", "view all", "see more", "show more", "load more",
)
CONTRACT_GENERIC = ("textile", "textiles", "fabric", "fabrics", "yarn", "energy", "machine", "machines", "equipment", "parts")
CONTRACT_URL = r"(?i)https?://|www\.|\.com|\.org|\.net|\.edu|\.gov"
CONTRACT_EMAIL = r"@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}"
CONTRACT_COUNTRIES = {
    "türkiye": "Turkey", "turkiye": "Turkey", "brasil": "Brazil", "brezilya": "Brazil", "mısır": "Egypt", "misir": "Egypt", "fas": "Morocco", "tunus": "Tunisia", "hindistan": "India",
    "çin": "China", "bangladeş": "Bangladesh", "arjantin": "Argentina", "kolombiya": "Colombia", "şili": "Chile", "ekvador": "Ecuador", "meksika": "Mexico",
}
CERTIFICATE_SITE = "oeko-tex.com"


def stripped(c: str) -> Column:
    return F.regexp_replace(text_of(c), r"^\s+|\s+$", "")


def contract_errors(leads: DataFrame) -> DataFrame:
    """leads with errors: what company, country and website have wrong, in this order, one error for each at most."""
    company, country, website = stripped("company"), stripped("country"), stripped("website")
    name = F.lower(company)
    of_company: list[Rule] = [
        (company == "", "company_empty"),
        (name.isin(*CONTRACT_NOISE) | name.rlike(r"^page \d$"), "company_noise"),
        (F.length(company) < 3, "company_short"),
        (name.isin(*CONTRACT_GENERIC), "company_generic"),
        (company.rlike(CONTRACT_URL), "company_url"),
        (company.rlike(CONTRACT_EMAIL), "company_email"),
    ]
    of_country: list[Rule] = [(country.rlike(CONTRACT_URL), "country_url"), (country.rlike(CONTRACT_EMAIL), "country_email")]
    of_website: list[Rule] = [(website.contains("@") & ~website.startswith("http"), "website_email")]
    return leads.withColumn("errors", F.array_compact(F.array(*map(first_reason, (of_company, of_country, of_website)))))


def contract(leads: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid). Invalid leads stay as they are, with their errors.

    Of valid ones the company is stripped, another name of a country becomes its own and an empty one null; a website
    without a scheme gets one and what is no address becomes null; e-mails that are none are left out; a certificate
    site's page moves to source_url (where that is empty), as it isn't the lead's website."""
    checked = contract_errors(leads)
    country, website = stripped("country"), stripped("website")
    table = F.create_map(*[F.lit(x) for kv in CONTRACT_COUNTRIES.items() for x in kv])
    site = F.when(website.startswith("http") | website.startswith("www."), website).when(website.contains(".") & ~website.contains("@"), F.concat(F.lit("https://"), website))
    certified = F.coalesce(site.contains(CERTIFICATE_SITE), F.lit(False))
    new = {
        "company": stripped("company"),
        "country": F.when(country != "", F.coalesce(F.try_element_at(table, F.lower(country)), country)),
        "website": F.when(~certified, site),
        "source_url": F.when(certified & (col_or_empty(leads, "source_url") == ""), site).otherwise(F.col("source_url") if "source_url" in leads.columns else F.lit(None).cast("string")),
    }
    if "emails" in leads.columns:
        new["emails"] = F.filter(F.transform("emails", lambda e: F.trim(e)), lambda e: e.rlike(CONTRACT_EMAIL))
    ok = F.size("errors") == 0
    return checked.where(ok).withColumns(new).drop("errors"), checked.where(~ok)


def error_counts(checked: DataFrame) -> DataFrame:
    return checked.select(F.explode("errors").alias("error")).groupBy("error").agg(F.count("*").alias("n"))


# --- noise and customers ------------------------------------------------------------------------------------------------------------------


def is_noise(name: Column, generic: Iterable[str] = D.NAME_GENERIC) -> Column:
    """Whether a name is no company's: too short, generic, an event, or bare."""
    t, generic = F.lower(F.trim(text_of(name))), list(generic)
    words = words_of(t)
    one = (F.size(words) == 1) & t.isin(generic)
    two = (F.size(words) == 2) & (F.get(words, F.lit(0)).isin(generic) | F.get(words, F.lit(1)).isin(generic))
    short = (F.length(t) < 5) & ~t.rlike(NAME_SUFFIX)
    return (F.length(t) < 3) | one | two | t.rlike(NAME_EVENT) | t.rlike(NAME_BARE) | t.rlike(NAME_YEAR) | short


def is_non_customer(name: Column, context: Column, indicators: Iterable[str] = D.NON_CUSTOMER) -> Column:
    """Whether an indicator stands in name or context; institute with technology and chamber with reaction don't count."""
    t = F.lower(F.concat_ws(" ", text_of(name), text_of(context)))
    plain = [w for w in indicators if w not in ("institute", "chamber")]
    special = lambda t: (t.contains("institute") & ~t.contains("technology")) | (t.contains("chamber") & ~t.contains("reaction"))
    return let(t, lambda t: contains_any(t, plain) | special(t))


def clean_dataset(leads: DataFrame, domains: Iterable[str] = D.DOMAIN_BLOCKLIST) -> DataFrame:
    """leads with reject_reason, and without blocked websites (kept in invalid_domain_cleared; needs_discovery is set)."""
    site = clean("website")
    bad = site.isNotNull() & blocked(site, domains)
    out = leads.withColumn("reject_reason", F.when(is_noise(F.col("company")), "noise_company_name"))
    return out.withColumn("invalid_domain_cleared", F.when(bad, site)).withColumn("needs_discovery", bad).withColumn("website", F.when(~bad, site))


def fast_filter(leads: DataFrame) -> DataFrame:
    """leads with reject_reason by address, path and description; trusted sources pass."""
    url = F.lower(F.coalesce(clean("website"), col_or_empty(leads, "source_url")))
    path = F.regexp_extract(url, r"^(?:[a-z][a-z0-9+.-]*://)?[^/?#]*([^?#]*)", 1)
    meta = F.lower(col_or_empty(leads, "meta_description"))
    named = lambda kind, word: F.when(word.isNotNull(), F.concat(F.lit(f"{kind}_blacklist:"), word))
    found = lambda x, words: let(x, lambda t: first_word(t, words))
    reason = F.coalesce(named("domain", found(url, D.FAST_DOMAINS)), named("path", found(path, D.FAST_PATHS)), named("meta", found(meta, D.FAST_META)))
    return leads.withColumn("reject_reason", F.when(~low("source_type").isin(*D.FAST_TRUSTED), reason))


# --- entity gate --------------------------------------------------------------------------------------------------------------------------


def is_parts_supplier(company: Column, context: Column) -> Column:
    return F.lower(company).rlike(PARTS_SUPPLIER) | let(F.lower(context), lambda t: contains_any(t, D.GATE_PARTS_SIGNALS))


def gate_rules(company: Column, source_url: Column, lower: Column | None = None) -> list[Rule]:
    """The entity gate's rules in order; a reason begins with its category and a colon. ``lower`` is the trimmed name in lower case, where it is there already."""
    lower = F.lower(F.trim(company)) if lower is None else lower
    words = words_of(lower)
    legal = company.rlike(LEGAL)
    countries = "|".join(D.GATE_COUNTRIES)
    own = F.filter(words, lambda w: ~w.isin("of", "the", "and", "for", "in", "on", "to"))
    generic = F.forall(own, lambda w: w.isin(*D.GATE_GENERIC))
    tell = lambda kind, x=company: F.concat(F.lit(f"{kind}: "), x)
    part = F.substring(company, 1, 50)
    oem, media, domain = first_word(lower, [x for x in D.GATE_OEM if len(x) > 4]), first_word(lower, D.GATE_MEDIA), first_word(F.lower(source_url), D.GATE_DOMAINS)
    first = F.substring(company, 1, 1)
    return [
        (F.length(F.trim(company)) < 3, tell("Name too short")),
        (lower.isin(*D.GATE_MENU), tell("Website menu item")),
        (company.rlike(HEADLINE) & ~legal, tell("Headline", part)),
        (lower.rlike(rf"^({countries})\s*(s\.?a\.?|ltd\.?|inc\.?|corp\.?|llc|gmbh|limited)?$"), tell("Country name as company")),
        (company.rlike(ARTICLE), tell("Article fragment")),
        (company.rlike(TITLE), tell("Title pattern", part)),
        (company.rlike(SENTENCE), tell("Sentence fragment", part)),
        (company.rlike(PERSON), tell("Person/role pattern", part)),
        (lower.isin(*D.GATE_GARBAGE), tell("Garbage word")),
        ((first == F.lower(first)) & (F.length(company) > 2), tell("Truncated name", F.substring(company, 1, 30))),
        (company.rlike(ADJECTIVE_NOUN), tell("Adjective + generic noun")),
        (lower.isin(*D.GATE_OEM), tell("OEM manufacturer")),
        (oem.isNotNull(), tell("Contains OEM manufacturer name", oem)),
        (lower.isin(*D.GATE_MEDIA), tell("News/media site")),
        (media.isNotNull(), tell("Contains news site name", media)),
        (company.rlike(MACHINE), tell("Machine/product name", part)),
        (company.rlike(GENERIC_PHRASE) & ~legal & (F.size(words) <= 4), tell("Generic phrase")),
        ((F.size(words) == 1) & lower.isin(*D.GATE_GENERIC), tell("Single generic term")),
        (F.size(words).between(1, 3) & generic, tell("All generic terms")),
        (domain.isNotNull(), tell("Rejected domain", domain)),
        (F.length(company) > 80, F.lit("Name too long")),
        ((F.length(company) - F.length(F.replace(company, F.lit(":"))) > 1) | company.contains("|"), tell("Multiple colons/pipes", part)),
        (company.rlike(r"^\d+\s+") & ~lower.contains("no."), tell("Starts with number", part)),
    ]


def entity_gate(leads: DataFrame) -> DataFrame:
    """leads with entity_grade (A, B, C or REJECT), entity_score, gate_reason and is_parts_supplier (which makes an A or B a C)."""
    company, source = text_of("company"), low("source_type")
    site, proof = has_value("website"), has_value(col_or_empty(leads, "evidence_url"))
    count = F.size(words_of(company))
    score = F.when(company.rlike(LEGAL), 2).otherwise(0) + F.when(count >= 2, 1).when((count == 1) & (F.length(company) < 4), -1).otherwise(0)
    score = score + F.when(source.isin(*D.GATE_HIGH_SOURCES), 2).when(source.isin(*D.GATE_MEDIUM_SOURCES) & (site | proof), 1).otherwise(0)
    score = score + site.cast("int") + proof.cast("int")
    work = once(leads, __lower=F.lower(F.trim(company)))
    reason = first_reason(gate_rules(company, col_or_empty(leads, "source_url"), F.col("__lower")))
    out = once(work, gate_reason=reason).drop("__lower").withColumn("entity_score", score)
    parts = Words(words_of_columns(leads, ("context",), D.GATE_PARTS_SIGNALS)).any(D.GATE_PARTS_SIGNALS)
    out = out.withColumn("is_parts_supplier", F.lower(company).rlike(PARTS_SUPPLIER) | parts)
    grade = banded(F.col("entity_score"), [(4, "A"), (2, "B")], "C")
    return out.withColumn("entity_grade", F.when(F.col("gate_reason").isNotNull(), "REJECT").when(F.col("is_parts_supplier"), "C").otherwise(grade))


def entity_type(leads: DataFrame) -> DataFrame:
    """leads with entity_type (associations first, then intermediaries, end users, brands), should_process and entity_priority."""
    groups = (D.ENTITY_ASSOCIATION, D.ENTITY_INTERMEDIARY, D.ENTITY_END_USER, D.ENTITY_BRAND)
    work = leads.withColumn("__m", words_of_columns(leads, ("company", "context", "website_content"), *groups))
    m = Words(F.col("__m"))
    kind = F.when(m.any(D.ENTITY_ASSOCIATION), "association").when(m.any(D.ENTITY_INTERMEDIARY), "intermediary")
    kind = kind.when(m.any(D.ENTITY_END_USER), "end_user").when(m.any(D.ENTITY_BRAND), "brand").otherwise("unknown")
    table = F.create_map(*[F.lit(x) for kv in ENTITY_PRIORITY.items() for x in kv])
    out = work.withColumn("entity_type", kind).drop("__m")
    return out.withColumn("should_process", ~F.col("entity_type").isin("association", "intermediary")).withColumn("entity_priority", table[F.col("entity_type")])


# --- selections ---------------------------------------------------------------------------------------------------------------------------


def role_filter(leads: DataFrame) -> DataFrame:
    """leads with drop_reason: role, noise and non-customer, joined by +."""
    rules: list[Rule] = [
        (~F.col("role").isin("CUSTOMER", "UNKNOWN"), F.concat(F.lit("role:"), F.col("role"))),
        (is_noise(F.col("company")), "noise"),
        (is_non_customer(F.col("company"), F.col("context")), "non_customer"),
    ]
    return leads.withColumn("drop_reason", let(reasons(rules), lambda x: F.when(F.size(x) > 0, F.array_join(x, "+"))))


def enrichment_need(leads: DataFrame) -> DataFrame:
    """leads with enrichment_reason: no_website, non_company_domain:x, invalid_url or no_email; null where nothing is needed."""
    site = clean("website")
    domain = first_word(F.lower(host(site)), D.DOMAIN_BLOCKLIST)
    mails = F.size("emails") if "emails" in leads.columns else F.lit(0)
    reason = first_reason([
        (site.isNull(), "no_website"),
        (domain.isNotNull(), F.concat(F.lit("non_company_domain:"), domain)),
        (~site.contains("."), "invalid_url"),
        (mails <= 0, "no_email"),
    ])
    return leads.withColumn("enrichment_reason", reason)


def export_filter(leads: DataFrame, *, least_score: float = 0, exempt_regions: Iterable[str] = (), sources: Iterable[str] | None = None) -> DataFrame:
    """Leads of the given sources, of enough score, with a website or in an exempt region, that are no parts suppliers and of grade
    A or B, or C with a website."""
    site = has_value("website")
    ok = (F.coalesce("score", F.lit(0.0)) >= least_score) & (site | F.col("region").isin(*exempt_regions) if tuple(exempt_regions) else site)
    ok = ok & ~F.col("is_parts_supplier") & (F.col("entity_grade").isin("A", "B") | ((F.col("entity_grade") == "C") & site))
    return leads.where(ok & (F.lit(True) if sources is None else F.col("source_type").isin(*sources)))


def contract_report(leads: DataFrame) -> DataFrame:
    """One row: rows, shares of missing companies, countries and websites, and the rate of repeated (company, country)."""
    missing = lambda c: (F.sum(clean(c).isNull().cast("long")) / F.count("*")).alias(f"missing_{c}")
    # distinct counts in one aggregation that is combined on the map side; nulls count as equal
    key = F.struct(F.col("company"), F.col("country"))
    repeated = (1 - F.count_distinct(key) / F.count("*")).alias("duplicate_rate")
    return leads.agg(F.count("*").alias("n_rows"), missing("company"), missing("country"), missing("website"), repeated)


# --- schema repair and name noise of fetched lists ----------------------------------------------------------------------------------------

#: Phrases that are page furniture, and menu words, in names taken from pages.
PAGE_PHRASES = r"(?iuU)^(view basket|add to cart|read more|learn more|click here|sign in|log in|contact us|about us|home|privacy policy|cookie policy|terms.*|all rights reserved.*)$"
NAVIGATION = ("cookie", "javascript", "skip to", "toggle", "subscribe", "newsletter", "copyright")


def repaired(leads: DataFrame, countries: dict[str, Iterable[str]]) -> DataFrame:
    """leads whose country, where it is a web address, is the first of the table's countries with a word in address or context (else null),
    and whose website is null where it is an e-mail or no address."""
    t = F.lower(F.concat_ws(" ", col_or_empty(leads, "address"), text_of("context")))
    known = let(t, lambda t: F.coalesce(*[F.when(contains_any(t, w), c) for c, w in countries.items()]))
    site = clean("website")
    return leads.withColumn("country", F.when(F.col("country").rlike(URL_LIKE), known).otherwise(F.col("country"))).withColumn("website", F.when(site.contains("@") | ~site.contains("."), F.lit(None).cast("string")).otherwise(site))


def is_page_noise(name: Column) -> Column:
    """Whether a name taken from a page is furniture: a known phrase, generic, short, holding a navigation word or a line break."""
    t = F.lower(F.trim(text_of(name)))
    return t.rlike(PAGE_PHRASES) | t.isin(*D.GATE_GENERIC) | (F.length(t) < 3) | contains_any(t, NAVIGATION) | text_of(name).contains("\n")


def target_filter(leads: DataFrame, regions: Iterable[str], roles: Iterable[str] = ("CUSTOMER", "UNKNOWN")) -> DataFrame:
    """Leads of the regions with a website that is no directory's; a role that is there must be one of those listed."""
    site = has_value("website") & ~blocked("website", D.DOMAIN_BLOCKLIST)
    role = F.col("role").isNull() | F.col("role").isin(*roles) if "role" in leads.columns else F.lit(True)
    return leads.where(F.col("region").isin(*regions) & site & role)


def same_host_evidence(leads: DataFrame, details: str = "evidence_details") -> DataFrame:
    """leads with n_own and n_external: evidence items (url, type) on the lead's own host and on others."""
    own = host("website")
    there = F.coalesce(F.col(details), F.array().cast("array<struct<url:string,type:string>>"))
    same = lambda d: (host(d["url"]) == own) & (own != "")
    other = lambda d: (host(d["url"]) != own) & (host(d["url"]) != "") & (own != "")
    return leads.withColumn("n_own", F.size(F.filter(there, same))).withColumn("n_external", F.size(F.filter(there, other)))
