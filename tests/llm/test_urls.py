"""URL filters against plain rules, plain shrinkage, and DuckDB."""

import math
import re

import duckdb
import pytest

from siftlane.llm import registry, sql, urls

URLS = [
    None, "", "no scheme", "http://", "HTTP://WWW.Example.ORG/es/x", "https://example.org/en/1", "https://example.org/EN/1", "https://notexample.org/es/",
    "https://a.com?x=/fr/", "https://a.com#/de/", "https://a.com/fr/?q#z", "https://com/de/", "ftp://b.co.uk/x://y", "https://é.ORG/ü?", "https://user@h.net:80/p", "http://10.0.0.1:8080/en/", "x://y.org", "https://example.org/es/" + "a" * 50_000,
]


def plain(url):
    rest = url.split("://", 1)[1] if url and "://" in url else None
    if rest is None:
        return "", "", None
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    path = re.split("[?#]", rest[len(host) :], maxsplit=1)[0]
    host = re.sub("[A-Z]", lambda m: m.group().lower(), host)
    fits = [r.text for r in registry.URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return host, path, max(fits, key=len) if fits else None


def plain_strength(units, parent):
    seen = sum((bad - n * parent(u)) ** 2 / n for u, (n, bad) in units.items())
    counting = sum(parent(u) * (1 - parent(u)) for u in units)
    more = sum(parent(u) * (1 - parent(u)) * (n - 1) for u, (n, _) in units.items())
    return 1 / min(0.9, max(0.001, (seen - counting) / more if more else 0.001)) - 1


def plain_rates(outcomes, limit=0.5):
    def gather(key):
        out = {}
        for h, bad in outcomes:
            if h and bad is not None:
                n, b = out.get(key(h), (0, 0))
                out[key(h)] = (n + 1, b + bad)
        return out

    domain, suffix = (lambda h: ".".join(h.split(".")[-2:])), (lambda h: h.split(".")[-1])
    hosts, domains, suffixes = gather(str), gather(domain), gather(suffix)
    n, b = sum(n for n, _ in hosts.values()), sum(b for _, b in hosts.values())
    whole = (b + limit / 2) / (n + 1)
    shrink = lambda units, parent: {u: ((k := plain_strength(units, parent)) * parent(u) + b) / (k + n) for u, (n, b) in units.items()}
    s = shrink(suffixes, lambda u: whole)
    d = shrink(domains, lambda u: s[suffix(u)])
    k = plain_strength(hosts, lambda u: d[domain(u)])
    return {u: ((k * d[domain(u)] + b) / (k + n), k + n) for u, (n, b) in hosts.items()}


@pytest.mark.parametrize("given", [URLS, []])
def test_hosts_paths_and_rules(spark, given):
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(given)], "page_id long, url string").selectExpr("*", "'x' as host", "7 as rate")
    known = urls.reputation(spark.createDataFrame([], "host string, bad boolean"))
    got = urls.filter_urls(pages, known, registry.URL_RULES)
    assert got.columns == ["page_id", "url", "rate", "host", "path", "rule", "bad_rate", "bad_bound", "verdict"]
    verdicts = {r.text: r.verdict for r in registry.URL_RULES}
    assert {r.page_id: (r.host, r.path, r.rule) for r in got.collect()} == {i: plain(u) for i, u in enumerate(given)}
    assert all(r.verdict == verdicts.get(r.rule, "allow") for r in got.collect())


def test_reputation(spark):
    outcomes = []
    for i in range(40):
        bad = 0.95 if i % 8 == 0 else 0.1
        outcomes += [(f"h{i % 5}.d{i}.{'com' if i % 2 else 'net'}", j < bad * 30) for j in range(30)] + [(f"d{i}.com", False)]
    outcomes += [(None, True), ("", True), ("h.d.com", None)]
    known = urls.reputation(spark.createDataFrame(outcomes, "host string, bad boolean"))
    want = plain_rates(outcomes)
    got = {r.host: (r.rate, r.weight) for r in known.hosts.collect()}
    assert got.keys() == want.keys()
    for h, (rate, weight) in want.items():
        assert math.isclose(got[h][0], rate, rel_tol=1e-9) and math.isclose(got[h][1], weight, rel_tol=1e-9)
    pages = spark.createDataFrame([(1, "http://h0.d0.net/x"), (2, "http://h1.d1.com/x"), (3, "http://new.d0.net/"), (4, "http://never.seen.xyz/"), (5, "http://h0.d0.net/x")], "page_id long, url string")
    judged = {r.page_id: r.verdict for r in urls.filter_urls(pages, known, ()).collect()}
    assert judged[1] == judged[5] == "block" and judged[2] == judged[4] == "allow"


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_matches_sql(spark, sf):
    base = f"/root/testdata/{sf}"
    con = duckdb.connect()
    for t in ("pages", "labels"):
        con.execute(f"create view {t} as select * from '{base}/{t}.parquet'")
    want = sorted(con.execute(sql.OP5_URLS).fetchall())
    assert sorted(map(tuple, registry.op5_urls(spark, base).collect())) == want and want


def test_suffix_table_is_a_parameter(spark):
    from pyspark.sql import functions as F

    table = ("gov.xx", "city.gov.xx", "co.uk")
    hosts = ["a.b.city.gov.xx", "city.gov.xx", "b.gov.xx", "w.b.gov.xx", "x.co.uk", "a.x.co.uk", "a.b.com", "com", "", "10.1.2.3:80", "a..b"]
    df = spark.createDataFrame([(h,) for h in hosts], "h string")
    got = [tuple(r) for r in df.select("h", urls.suffix_of(F.col("h"), table), urls.domain_of(F.col("h"), table)).collect()]

    def plain_parts(h):
        labels = h.split(".")
        n = max([s.count(".") + 1 for s in table if h == s or h.endswith("." + s)], default=1)
        domain = h if re.fullmatch(r"[\d.]+(:\d+)?", h) else ".".join(labels[-(n + 1) :])
        return h, ".".join(labels[-n:]), domain

    assert got == [plain_parts(h) for h in hosts]


def test_a_very_common_host(spark):
    """A host of most pages is joined by a broadcast of its row, with the rows that a shuffle gives."""
    outcomes = spark.createDataFrame([("hot.com", True)] * 30 + [("cold.net", False)] * 30, "host string, bad boolean")
    pages = spark.range(4000).selectExpr("id page_id", "concat('http://', if(id % 10 < 8, 'hot.com', concat('h', id % 500, '.net')), '/x') url")
    got = urls.filter_urls(pages, urls.reputation(outcomes), ()).groupBy("host").count().collect()
    assert sum(r["count"] for r in got) == 4000 and max(r["count"] for r in got) == 3200 and len(got) == 101
