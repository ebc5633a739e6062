"""URL filters: a rule list, and empirical-Bayes reputations of hosts for what no rule decides.

A url's host is what stands behind the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased;
its path is what follows up to ``?``, ``#`` or the end. A null url, or one without ``://``, has neither.

Rules fit a host and all its subdomains if the path starts with the rule's; the longest rule wins.

Reputation: labelled pages give each host a number of pages and of bad ones. Suffix, registered
domain and host form a tree of beta-binomial models: the rate of a suffix is shrunk to that of
all pages, a domain's to its suffix's, a host's to its domain's. How strongly is estimated for
each level from all its units by moments (the spread of their rates beyond that of counting).
A host is blocked if the lower bound of its posterior rate (mean less ``z`` deviations) is above
``limit``; hosts without labels have their domain's posterior. Counts are summed by host before
anything is joined, so a host of many pages is a row.

Nulls: labels with a null id or outcome are left out; a page's outcome is bad if any of its labels
is. Without labels every rate is ``limit`` / 2 and nothing is blocked. Repeated pages get equal
verdicts.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftlane.llm.common import checkpointed
from siftlane.operators.components import joined_by_key

#: The suffixes of several labels that count unless a table is given; all others have one.
SUFFIXES = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.nz", "co.jp", "com.br", "com.tr", "com.mx", "com.ar", "co.in", "co.za", "com.cn")


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def rest_of(url: Column) -> Column:
    """What follows the first ://, else null."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    host = F.regexp_extract(rest_of(url), r"\A[^/?#]*", 0)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(rest_of(url), r"\A[^/?#]*(/[^?#]*)?", 1), F.lit(""))


def fitting_rule(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """The text of the longest rule that fits, else null."""
    out = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == r.host) | F.endswith(host, F.lit(f".{r.host}"))) & F.startswith(path, F.lit(r.path))
        out = F.when(fits, r.text).otherwise(out)
    return out


def suffix_labels(host: Column, suffixes: Iterable[str]) -> Column:
    """How many labels the host's suffix has: those of the longest of the table's that it ends with, else one."""
    by_size: dict[int, list[str]] = {}
    for s in suffixes:
        by_size.setdefault(s.count(".") + 1, []).append(s)
    out = F.lit(1)
    for k in sorted(by_size):
        out = F.when(F.substring_index(host, ".", -k).isin(*by_size[k]), k).otherwise(out)
    return out


def tail_labels(host: Column, n: Column) -> Column:
    return F.array_join(F.slice(F.split(host, "[.]"), -F.least(n, F.size(F.split(host, "[.]"))), n), ".")


def is_address(host: Column) -> Column:
    return host.rlike(r"^[\d.]+(:\d+)?$")


def suffix_of(host: Column, suffixes: Iterable[str] = SUFFIXES) -> Column:
    return tail_labels(host, suffix_labels(host, suffixes))


def domain_of(host: Column, suffixes: Iterable[str] = SUFFIXES) -> Column:
    """The suffix and one label more; an address of numbers is its own domain."""
    return F.when(is_address(host), host).otherwise(tail_labels(host, suffix_labels(host, suffixes) + 1))


def shrunk(units: DataFrame, parent: Column, least: float, most: float) -> DataFrame:
    """units (n, bad) with strength and rate: the posterior mean under a beta prior around ``parent``.

    The intra-class correlation rho by moments is the excess of the squared deviations over that of
    counting, divided by what full correlation would add; the prior's strength is 1 / rho - 1.
    """
    spread = units.withColumn("m", parent).where("n > 0")
    moments = spread.agg(
        F.sum(F.pow(F.col("bad") - F.col("n") * F.col("m"), 2) / F.col("n")).alias("seen"),
        F.sum(F.col("m") * (1 - F.col("m"))).alias("counting"),
        F.sum(F.col("m") * (1 - F.col("m")) * (F.col("n") - 1)).alias("more"),
    ).first()
    rho = (moments.seen - moments.counting) / moments.more if moments.more else least
    strength = 1 / min(most, max(least, rho)) - 1
    return units.withColumn("strength", F.lit(strength)).withColumn("rate", (F.lit(strength) * parent + F.col("bad")) / (F.lit(strength) + F.col("n")))


@dataclass
class Reputation:
    """Posterior (host: n, rate, strength), (domain: rate, strength), (suffix: rate) and the rate of all pages."""

    hosts: DataFrame
    domains: DataFrame
    suffixes: DataFrame
    rate: float
    strength: float
    suffix_table: tuple[str, ...] = SUFFIXES


def reputation(outcomes: DataFrame, *, limit: float = 0.5, least: float = 0.001, most: float = 0.9, suffixes: Iterable[str] = SUFFIXES) -> Reputation:
    """Reputations from labelled pages: host string, bad boolean. suffixes: the table of public suffixes of several labels."""
    suffix_table = tuple(suffixes)
    known = outcomes.where("host is not null and host != '' and bad is not null")
    hosts = known.groupBy("host").agg(F.count("*").alias("n"), F.sum(F.col("bad").cast("long")).alias("bad"))
    hosts = checkpointed(hosts.withColumn("domain", domain_of(F.col("host"), suffix_table)).withColumn("suffix", suffix_of(F.col("host"), suffix_table)))
    add = [F.sum("n").alias("n"), F.sum("bad").alias("bad")]
    domains = checkpointed(hosts.groupBy("domain", "suffix").agg(*add))
    suffixes = domains.groupBy("suffix").agg(*add)
    whole = suffixes.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    rate = (whole.bad + limit / 2) / (whole.n + 1) if whole.n else limit / 2
    suffixes = checkpointed(shrunk(suffixes, F.lit(rate), least, most).select("suffix", F.col("rate").alias("suffix_rate")))
    domains = shrunk(domains.join(suffixes, "suffix"), F.col("suffix_rate"), least, most)
    domains = checkpointed(domains.select("domain", F.col("rate").alias("domain_rate"), (F.col("strength") + F.col("n")).alias("domain_weight")))
    hosts = shrunk(hosts.join(domains, "domain"), F.col("domain_rate"), least, most)
    strength = hosts.select("strength").first()
    hosts = checkpointed(hosts.select("host", "rate", (F.col("strength") + F.col("n")).alias("weight")))
    return Reputation(hosts, domains, suffixes, rate, strength[0] if strength else 1 / least - 1, suffix_table)


def filter_urls(pages: DataFrame, known: Reputation, rules: tuple[Rule, ...], *, url_col: str = "url", limit: float = 0.5, z: float = 1.645) -> DataFrame:
    """pages with host, path, rule, bad_rate, bad_bound and verdict (new columns win over old ones of their names)."""
    added = ("host", "path", "rule", "bad_rate", "bad_bound", "verdict")
    kept = [c for c in pages.columns if c not in added]
    url = F.col("__url")
    work = pages.select(*kept, F.col(url_col).cast("string").alias("__url")).select(*kept, host_of(url).alias("host"), path_of(url).alias("path"))
    work = work.withColumn("rule", fitting_rule(F.col("host"), F.col("path"), rules))
    hosts = known.hosts.select("host", F.col("rate").alias("__rate"), F.col("weight").alias("__weight"))
    domains = known.domains.select(F.col("domain").alias("__domain"), F.col("domain_rate").alias("__drate"))
    suffixes = known.suffixes.select(F.col("suffix").alias("__suffix"), F.col("suffix_rate").alias("__srate"))
    # one row for each host of the pages, so that a host of many pages meets the tree once; few very common hosts are broadcast
    each = work.groupBy("host").agg(F.count("*").alias("__n"))
    each = each.withColumn("__domain", domain_of(F.col("host"), known.suffix_table)).withColumn("__suffix", suffix_of(F.col("host"), known.suffix_table))
    decided = each.join(hosts, "host", "left").join(domains, "__domain", "left").join(suffixes, "__suffix", "left")
    mean = F.coalesce("__rate", "__drate", "__srate", F.lit(known.rate))
    weight = F.coalesce("__weight", F.lit(known.strength))
    bound = mean - z * F.sqrt(mean * (1 - mean) / (weight + 1))
    decided = checkpointed(decided.select("host", "__n", mean.alias("bad_rate"), bound.alias("bad_bound")))
    by_rule = F.lit(None).cast("string")
    for r in rules:
        by_rule = F.when(F.col("rule") == r.text, r.verdict).otherwise(by_rule)
    own = F.when(F.col("bad_bound") > limit, "block").otherwise("allow")
    total = decided.agg(F.sum("__n")).first()[0] or 0
    return joined_by_key(work, decided, "host", "__n", total).select(*kept, "host", "path", "rule", "bad_rate", "bad_bound", F.coalesce(by_rule, own).alias("verdict"))
