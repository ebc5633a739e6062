"""DuckDB SQL of the queries that SQL can express."""

OP5_URLS = r"""
WITH base AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages
), parts AS (
  SELECT page_id,
         coalesce(translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*(/[^?#]*)?', 1), '') AS path
  FROM base
), named AS (
  SELECT page_id, host, path, string_split(host, '.') AS l,
         array_to_string(string_split(host, '.')[-2:], '.') IN ('co.uk', 'org.uk', 'ac.uk', 'gov.uk', 'com.au', 'net.au', 'org.au', 'co.nz', 'co.jp', 'com.br', 'com.tr', 'com.mx', 'com.ar', 'co.in', 'co.za', 'com.cn') AS two
  FROM parts
), tree AS (
  SELECT page_id, host, path,
         CASE WHEN regexp_matches(host, '^[0-9.]+(:[0-9]+)?$') THEN host WHEN two THEN array_to_string(l[-3:], '.') ELSE array_to_string(l[-2:], '.') END AS domain,
         CASE WHEN two THEN array_to_string(l[-2:], '.') ELSE l[-1] END AS suffix
  FROM named
), outcome AS (
  SELECT doc_id, max(CASE WHEN quality = 0 OR coalesce(toxic, 0) = 1 THEN 1 ELSE 0 END) AS bad FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id
), h AS (
  SELECT host, domain, suffix, count(*)::DOUBLE AS n, sum(bad)::DOUBLE AS bad FROM tree JOIN outcome ON page_id = doc_id WHERE host <> '' GROUP BY ALL
), d AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM h GROUP BY ALL),
s AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM d GROUP BY ALL),
w AS (SELECT CASE WHEN coalesce(sum(n), 0) > 0 THEN (sum(bad) + 0.25) / (sum(n) + 1) ELSE 0.25 END AS m FROM s),
ks AS (SELECT 1 / least(0.9, greatest(0.001, coalesce((sum(pow(bad - n * m, 2) / n) - sum(m * (1 - m))) / nullif(sum(m * (1 - m) * (n - 1)), 0), 0.001))) - 1 AS k FROM s, w),
ps AS (SELECT suffix, (k * m + bad) / (k + n) AS rate FROM s, w, ks),
dm AS (SELECT d.*, rate AS m FROM d JOIN ps USING (suffix)),
kd AS (SELECT 1 / least(0.9, greatest(0.001, coalesce((sum(pow(bad - n * m, 2) / n) - sum(m * (1 - m))) / nullif(sum(m * (1 - m) * (n - 1)), 0), 0.001))) - 1 AS k FROM dm),
pd AS (SELECT domain, (k * m + bad) / (k + n) AS rate FROM dm, kd),
hm AS (SELECT h.*, rate AS m FROM h JOIN pd USING (domain)),
kh AS (SELECT 1 / least(0.9, greatest(0.001, coalesce((sum(pow(bad - n * m, 2) / n) - sum(m * (1 - m))) / nullif(sum(m * (1 - m) * (n - 1)), 0), 0.001))) - 1 AS k FROM hm),
ph AS (SELECT host, (k * m + bad) / (k + n) AS rate, k + n AS weight FROM hm, kh),
judged AS (
  SELECT page_id, t.host, path, coalesce(ph.rate, pd.rate, ps.rate, w.m) AS rate, coalesce(weight, kh.k) AS weight,
         CASE WHEN (t.host = 'example.org' OR t.host LIKE '%.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
              WHEN (t.host = 'example.org' OR t.host LIKE '%.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
              WHEN (t.host = 'com' OR t.host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
              WHEN (t.host = 'com' OR t.host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/'
              WHEN (t.host = 'org' OR t.host LIKE '%.org') AND starts_with(path, '/') THEN 'org/' END AS rule
  FROM tree t CROSS JOIN w CROSS JOIN kh LEFT JOIN ph ON t.host = ph.host LEFT JOIN pd ON t.domain = pd.domain LEFT JOIN ps ON t.suffix = ps.suffix
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN rate - 1.645 * sqrt(rate * (1 - rate) / (weight + 1)) > 0.5 THEN 'block' ELSE 'allow' END AS verdict
FROM judged
"""

OP12_VECTOR_CODES = r"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * x::DOUBLE) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), dims AS (SELECT max(len(v)) // 16 AS width FROM kept
), parts AS (
  SELECT vec_id, p, list_slice(v, p * width + 1, (p + 1) * width) AS w FROM kept, dims, range(0, 16) AS r(p)
), b0 AS (
  SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, w AS c FROM parts JOIN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT 64) USING (vec_id)
), a1 AS (
  SELECT vec_id, p, w, arg_min(e, (list_sum(list_transform(list_zip(w, c), lambda x: (x[1] - x[2]) * (x[1] - x[2]))), e)) AS e FROM parts JOIN b0 USING (p) GROUP BY vec_id, p, w
), m1 AS (
  SELECT p, e, list(m ORDER BY k) AS c FROM (SELECT p, e, k, CAST(floor(sum(w[k]) / count(*)) AS BIGINT) AS m FROM a1, range(1, 1 + (SELECT width FROM dims)) AS r(k) GROUP BY p, e, k) GROUP BY p, e
), b1 AS (
  SELECT b.p, b.e, coalesce(m.c, b.c) AS c FROM b0 b LEFT JOIN m1 m ON b.p = m.p AND b.e = m.e
), a2 AS (
  SELECT vec_id, p, w, arg_min(e, (list_sum(list_transform(list_zip(w, c), lambda x: (x[1] - x[2]) * (x[1] - x[2]))), e)) AS e FROM parts JOIN b1 USING (p) GROUP BY vec_id, p, w
), m2 AS (
  SELECT p, e, list(m ORDER BY k) AS c FROM (SELECT p, e, k, CAST(floor(sum(w[k]) / count(*)) AS BIGINT) AS m FROM a2, range(1, 1 + (SELECT width FROM dims)) AS r(k) GROUP BY p, e, k) GROUP BY p, e
), b2 AS (
  SELECT b.p, b.e, coalesce(m.c, b.c) AS c FROM b1 b LEFT JOIN m2 m ON b.p = m.p AND b.e = m.e
), coded AS (
  SELECT vec_id, p, min((list_sum(list_transform(list_zip(w, c), lambda x: (x[1] - x[2]) * (x[1] - x[2]))), e)) AS best FROM parts JOIN b2 USING (p) GROUP BY vec_id, p
), summed AS (
  SELECT vec_id, string_agg(printf('%02x', best[2]), '' ORDER BY p) AS code, CAST(sum(best[1]) AS BIGINT) AS error FROM coded GROUP BY vec_id
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) FROM b2) AS codebooks_sha256
FROM summed JOIN kept USING (vec_id)
"""

OP11_PREFIX_TRIE = r"""
WITH own AS (
  SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')} ORDER BY turn NULLS FIRST) AS t FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), h AS (
  SELECT conv_id, t, xor(4294967295, list_reduce(list_concat([4294967295], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda ch: CAST(ord(ch) AS BIGINT))),
         lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1))))) % 4 AS h FROM own
), seq AS (
  SELECT h.conv_id, list_concat(coalesce(g.t, [])[1:h], h.t[h + 1:]) AS s FROM h LEFT JOIN own g ON g.conv_id = h.conv_id - h.conv_id % 20
), prefixes AS (
  SELECT conv_id, d AS depth, s[1:d] AS p, len(s) = d AS ends FROM seq, LATERAL (SELECT unnest(range(0, len(s) + 1)) AS d)
), node AS (
  SELECT p, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         (count(*) - 1) * CASE WHEN depth > 0 THEN len(regexp_extract_all(p[depth].text, '[^\x20\x09-\x0D]+')) ELSE 0 END AS saved,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM prefixes GROUP BY p, depth
), tree AS (
  SELECT c.*, q.conv_id AS parent_conv_id, coalesce(k.n, 0) AS n_children
  FROM node c LEFT JOIN node q ON q.depth = c.depth - 1 AND q.p = c.p[1:c.depth - 1] LEFT JOIN (SELECT p[1:depth - 1] AS p, count(*) AS n FROM node WHERE depth > 0 GROUP BY ALL) k ON k.p = c.p
), below AS (
  SELECT p[1:d] AS p, sum(saved) AS saved, count(*) FILTER (n_children = 0) AS leaves FROM tree, LATERAL (SELECT unnest(range(0, depth + 1)) AS d) GROUP BY ALL
)
SELECT conv_id, depth, parent_conv_id, n_convs, n_children, leaves AS n_leaves, CAST(b.saved AS BIGINT) AS saved_tokens, ends_sha256 FROM tree JOIN below b USING (p)
"""

OP13_MINHASH = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')] ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS sh FROM d
), x AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS h FROM s),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k, any_value(a.n) AS na, any_value(b.n) AS nb FROM x a JOIN x b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
l AS (SELECT a, b FROM c WHERE 100 * k >= 80 * (na + nb - k)), e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS n, doc_id AS m FROM s UNION SELECT r.n, e.b FROM r JOIN e ON e.a = r.m)
SELECT doc_id, len(sh) AS n_shingles, least AS component_id, doc_id = least AS kept FROM s JOIN (SELECT n, min(m) AS least FROM r GROUP BY n) ON n = doc_id
"""
