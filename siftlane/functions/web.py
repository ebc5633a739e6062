"""Functions on web addresses, HTML and JSON columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from siftlane.functions.text import clean, contains_any, sorted_distinct, squeezed, text_of

#: Second-level labels under which domains are registered, dropped page parts, patterns.
SECOND_LEVEL = ("com", "co", "org", "net", "edu", "gov")
DROPPED = ("script", "style", "noscript", "nav", "footer", "header")
MAILTO = r"""(?i)href=["']mailto:([^"'?]+)"""
TEL = r"""(?i)href=["']tel:([^"']+)"""
HREF = r"""(?i)<a[^>]+href=["']([^"']+)["']"""
LD_JSON = r"""(?is)<script[^>]+type=["']application/ld\+json["'][^>]*>(.*?)</script>"""


def host(c: str | Column, keep_www: bool = True) -> Column:
    """The host of an address, lower case; of one without a scheme what stands before the first slash."""
    t = F.lower(F.trim(text_of(c)))
    h = F.regexp_extract(F.regexp_replace(t, "^[a-z][a-z0-9+.-]*://", ""), "^[^/?#]*", 0)
    return h if keep_www else F.regexp_replace(h, r"^www\.", "")


def domain_key(c: str | Column) -> Column:
    """The key under which websites are the same: the host with its www., or the whole address without a scheme."""
    t = F.lower(text_of(c))
    return F.when(t.rlike("^[a-z][a-z0-9+.-]*://[^/?#]"), F.regexp_extract(t, "^[a-z][a-z0-9+.-]*://([^/?#]*)", 1)).otherwise(t)


def registrable(c: str | Column) -> Column:
    """The registered domain: three labels where the second last is one of SECOND_LEVEL, else two."""
    h = F.regexp_replace(host(c, keep_www=False), r":\d+$", "")
    labels = F.split(h, r"\.")
    three = F.element_at(F.slice(F.concat(F.array(F.lit("")), labels), -2, 2), 1).isin(*SECOND_LEVEL) & (F.size(labels) > 2)
    return F.when(three, F.substring_index(h, ".", -3)).otherwise(F.substring_index(h, ".", -2))


def clean_domain(c: str | Column) -> Column:
    """A plain domain without scheme, www., path or port; null if it isn't one."""
    t = F.regexp_replace(F.lower(F.trim(text_of(c))), r"^https?://", "")
    t = F.regexp_replace(F.regexp_replace(F.regexp_replace(t, r"^www\.", ""), r"[/?#].*$", ""), r":\d+$", "")
    return F.when(t.rlike(r"^[a-z0-9]([a-z0-9-]*[a-z0-9])?(\.[a-z0-9]([a-z0-9-]*[a-z0-9])?)+$"), t)


def with_scheme(c: str | Column) -> Column:
    """An address with https:// in front if it has no scheme; null if it stands for nothing."""
    t = clean(c)
    return F.when(t.rlike("^(?i)https?://"), t).otherwise(F.concat(F.lit("https://"), t))


def blocked(c: str | Column, domains: Iterable[str]) -> Column:
    """Whether a domain or address holds one of the listed parts before its path."""
    t = F.regexp_replace(F.lower(F.trim(text_of(c))), r"^https?://", "")
    return contains_any(F.substring_index(t, "/", 1), domains)


def top_level(c: str | Column) -> Column:
    """The last label of a host."""
    return F.substring_index(F.regexp_replace(host(c), r":\d+$", ""), ".", -1)


def main_text(html: str | Column) -> Column:
    """What a page says: without comments, dropped parts and tags; the commonest entities decoded."""
    t = F.regexp_replace(text_of(html), r"(?s)<!--.*?-->", " ")
    for tag in DROPPED:
        t = F.regexp_replace(t, rf"(?is)<{tag}\b[^>]*>.*?</{tag}\s*>", " ")
    t = F.regexp_replace(t, r"<[^>]*>", " ")
    for a, b in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        t = F.replace(t, F.lit(a), F.lit(b))
    return squeezed(t)


def mailtos(html: str | Column) -> Column:
    return sorted_distinct(F.transform(F.regexp_extract_all(text_of(html), F.lit(MAILTO), F.lit(1)), lambda x: F.lower(F.trim(x))))


def telephones(html: str | Column) -> Column:
    return sorted_distinct(F.transform(F.regexp_extract_all(text_of(html), F.lit(TEL), F.lit(1)), lambda x: F.trim(x)))


def hrefs(html: str | Column) -> Column:
    return F.regexp_extract_all(text_of(html), F.lit(HREF), F.lit(1))


def organisation(html: str | Column) -> Column:
    """(name, email, telephone, sameAs) of the first linked-data block."""
    block = F.regexp_extract(text_of(html), LD_JSON, 1)
    return F.from_json(block, "name string, email string, telephone string, sameAs array<string>")


def synonyms(json: str | Column, keys: Iterable[str]) -> Column:
    """The first value of a JSON object under any of the keys."""
    t = F.col(json) if isinstance(json, str) else json
    return F.coalesce(*[F.get_json_object(t, f"$.{k}") for k in keys])


def page_template(url: str | Column) -> Column:
    """An address with its page number replaced by {num}; null if it has none."""
    t = text_of(url)
    query = F.when(t.rlike(r"[?&](page|p|pg|offset)=\d+"), F.regexp_replace(t, r"([?&](?:page|p|pg|offset)=)\d+", "$1{num}"))
    return F.coalesce(query, F.when(t.rlike(r"/page/\d+"), F.regexp_replace(t, r"/page/\d+", "/page/{num}")))
