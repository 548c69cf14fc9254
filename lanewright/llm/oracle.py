"""SQL checks of the queries that SQL can express, for DuckDB."""

from __future__ import annotations

_DEDUP = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
g AS (SELECT text, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY text)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(text) AS text_sha256
FROM t JOIN g USING (text)
"""

_WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
n AS (SELECT *, octet_length(encode(html))::BIGINT AS payload_bytes FROM p),
g AS (SELECT html, max(page_id) AS first_id FROM n WHERE payload_bytes >= 1000 GROUP BY html),
j AS (SELECT n.*, first_id, coalesce(page_id < first_id, false) AS again FROM n LEFT JOIN g USING (html))
SELECT page_id, payload_bytes, sha1(html) AS payload_digest,
  CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN again THEN first_id END AS refers_to
FROM j
"""

_URLS = r"""
WITH rules(rule, rhost, rpath, rverdict) AS (VALUES
  ('com/', 'com', '/', 'allow'), ('example.com/en/', 'example.com', '/en/', 'block'),
  ('www.example.com/en/', 'www.example.com', '/en/', 'allow'),
  ('net/es/', 'net', '/es/', 'block'), ('net/fr/', 'net', '/fr/', 'block')),
cut AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
parsed AS (SELECT page_id,
    translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
fits AS (SELECT page_id, max(length(rule)) AS size FROM parsed JOIN rules
  ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY page_id),
best AS (SELECT p.page_id, rule, rverdict FROM parsed p JOIN fits USING (page_id) JOIN rules
  ON length(rule) = size AND (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT page_id, host, path, rule, coalesce(rverdict, 'allow') AS verdict
FROM parsed LEFT JOIN best USING (page_id)
"""

_COLLOCATIONS = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda x: x <> '') AS words FROM d),
p AS (SELECT lang, words, unnest([1, 2, 3, 4]) AS size FROM w),
g AS (SELECT lang, size, unnest(list_transform(range(1, len(words) - size + 2), lambda i: words[i:i + size - 1])) AS words
  FROM p WHERE len(words) >= size),
f AS (SELECT lang, size, words, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 30),
n AS (SELECT lang, sum(len(words))::BIGINT AS n FROM w GROUP BY lang),
inner_ AS (SELECT lang, f, words, size, unnest(range(2, size)) AS part FROM f WHERE size > 2),
inside AS (SELECT lang, f, unnest(list_transform(range(1, size - part + 2), lambda i: words[i:i + part - 1])) AS words
  FROM inner_),
most AS (SELECT lang, words, max(f) AS most FROM inside GROUP BY ALL),
c AS (SELECT f.lang, f.words, f.size, f.f AS a FROM f LEFT JOIN most USING (lang, words)
  WHERE f.size > 1 AND (most IS NULL OR 100 * most::HUGEINT < 80 * f.f::HUGEINT)),
k AS (SELECT *, unnest(range(1, size)) AS k FROM c),
s AS (SELECT k.*, x.f AS l, y.f AS r, ((2000000::HUGEINT * a) // (x.f + y.f))::BIGINT AS score
  FROM k JOIN f x ON k.lang = x.lang AND k.words[1:k.k] = x.words
  JOIN f y ON k.lang = y.lang AND k.words[k.k + 1:] = y.words),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, k) = 1),
t AS (SELECT lang, array_to_string(words, ' ') AS phrase, a, l, r, score FROM b)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
  phrase, a, l, r, n, score
FROM t JOIN n USING (lang) QUALIFY rank <= 2000
"""

_NEGATIVES = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, embedding
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c AS (SELECT vec_id, label, i, floor(256 * embedding[i]::DOUBLE)::BIGINT AS x
  FROM (SELECT vec_id, label, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM v)),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, sum(a.x * b.x)::BIGINT AS score
  FROM c a JOIN c b USING (i) WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
  GROUP BY a.vec_id, b.vec_id, a.label = b.label),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id,
  row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY rank <= 5
"""

ORACLE = {
    "op5_exact_dedup": _DEDUP,
    "op7_warc": _WARC,
    "op10_url_filter": _URLS,
    "op11_collocations": _COLLOCATIONS,
    "op13_hard_negatives": _NEGATIVES,
}
