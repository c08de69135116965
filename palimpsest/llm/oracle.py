"""SQL for the queries that SQL can express."""

from __future__ import annotations

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def repeats(size: int) -> str:
    """Documents without the words of sequences that start in a document with a smaller id."""
    return f"""
WITH docs AS (SELECT doc_id, {WORDS} AS words FROM documents),
starts AS (SELECT doc_id, words, unnest(range(1, len(words) - {size - 2})) AS i FROM docs),
windows AS (
  SELECT doc_id, i, array_to_string(words[i:i + {size - 1}], ' ') AS sequence FROM starts
),
first AS (SELECT sequence, min(doc_id) AS least FROM windows GROUP BY sequence),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + {size})) AS j
  FROM windows JOIN first USING (sequence) WHERE least < doc_id
),
removed AS (SELECT doc_id, list(j) AS js FROM gone GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
  CAST(coalesce(len(js), 0) AS BIGINT) AS n_removed,
  sha256(CASE WHEN js IS NULL THEN array_to_string(words, ' ') ELSE array_to_string(list_transform(
    list_filter(range(1, len(words) + 1), lambda j: NOT list_contains(js, j)), lambda j: words[j]), ' ') END
  ) AS kept_sha256
FROM docs LEFT JOIN removed USING (doc_id)
"""


VECTORS = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.98
),
reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
)
SELECT a AS vec_id, CAST((SELECT count(*) FROM links WHERE links.a = reach.a) AS BIGINT) AS n_links,
  min(b) AS component_id, a = min(b) AS kept
FROM reach GROUP BY reach.a
"""


NEAR = f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, {WORDS} AS words FROM documents WHERE doc_id IS NOT NULL
),
bags AS (
  SELECT doc_id, shingle, count(*) AS c FROM (
    SELECT doc_id, unnest(CASE WHEN len(words) < 5 THEN [array_to_string(words, ' ')] ELSE
      list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) END
    ) AS shingle
    FROM docs WHERE len(words) > 0
  ) GROUP BY ALL
),
sizes AS (SELECT doc_id, sum(c) AS n FROM bags GROUP BY doc_id),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, sum(least(x.c, y.c)) AS c
  FROM bags x JOIN bags y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY ALL
),
links AS (
  SELECT a, b FROM common JOIN sizes s ON s.doc_id = a JOIN sizes t ON t.doc_id = b
  WHERE CAST(c AS DOUBLE) / CAST(s.n + t.n - c AS DOUBLE) >= 0.8
),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
)
SELECT a AS doc_id, min(b) AS class_id, a = min(b) AS kept FROM reach GROUP BY a
"""


URLS = r"""
WITH parts AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages
),
urls AS (
  SELECT page_id, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(substr(rest, length(h) + 1), '^[^?#]*') AS path
  FROM (SELECT *, regexp_extract(rest, '^[^/?#]*') AS h FROM parts)
),
rules(rule_host, rule_path, rule_verdict) AS (VALUES
  ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
  ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
),
fits AS (
  SELECT *, rule_host || rule_path AS rule, row_number() OVER (
    PARTITION BY page_id, host, path ORDER BY length(rule_host || rule_path) DESC, rule_host || rule_path
  ) AS place
  FROM (SELECT DISTINCT page_id, host, path FROM urls) u JOIN rules
  ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
)
SELECT page_id, host, path, rule, coalesce(rule_verdict, CASE WHEN listed THEN 'block' ELSE 'allow' END) AS verdict,
  listed
FROM (
  SELECT *, list_has_any(string_split_regex(host, '[.-]'), ['ads', 'adult', 'bets', 'casino', 'gambling',
    'malware', 'pills', 'poker', 'porn', 'spam', 'warez']) AS listed FROM urls
) LEFT JOIN (SELECT page_id, host, path, rule, rule_verdict FROM fits WHERE place = 1) USING (page_id, host, path)
"""


RESAMPLING = r"""
WITH RECURSIVE table_of(i, step, c) AS (
  SELECT i, 0, i FROM range(256) t(i)
  UNION ALL
  SELECT i, step + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM table_of WHERE step < 8
),
crc AS (SELECT list(c ORDER BY i) AS steps FROM table_of WHERE step = 8),
texts AS (
  SELECT 0 AS side, doc_id AS id, text FROM documents UNION ALL SELECT 1, NULL, text FROM benchmark
),
found AS (
  SELECT side, id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM texts
),
occurring AS (SELECT side, id, unnest(words) AS word FROM found),
spelled AS (
  SELECT word, list_transform(range(1, CAST(octet_length(encode(word)) AS BIGINT) + 1),
    lambda i: CAST('0x' || substr(hex(encode(word)), 2 * i - 1, 2) AS BIGINT)) AS bytes
  FROM (SELECT DISTINCT word FROM occurring)
),
hashed AS (
  SELECT word, xor(list_reduce(bytes, lambda c, b: xor(c >> 8, steps[xor(c & 255, b) + 1]), 4294967295), 4294967295) % 10000 AS bucket
  FROM spelled, crc
),
counts AS (SELECT bucket, count(*) FILTER (side = 0) AS s, count(*) FILTER (side = 1) AS t FROM occurring JOIN hashed USING (word) GROUP BY bucket),
totals AS (SELECT sum(s) AS s_all, sum(t) AS t_all FROM counts),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln(CAST(t + 1 AS DOUBLE) * CAST(s_all + 10000 AS DOUBLE)
    / (CAST(s + 1 AS DOUBLE) * CAST(t_all + 10000 AS DOUBLE)))) AS BIGINT) AS gain FROM counts, totals
),
weights AS (
  SELECT id, sum(gain) AS weight FROM occurring JOIN hashed USING (word) JOIN gains USING (bucket) WHERE side = 0 GROUP BY id
),
scored AS (
  SELECT id AS doc_id, CAST(len(words) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
    CAST('0x' || substr(sha256('2024:' || id), 1, 8) AS BIGINT) AS h
  FROM found LEFT JOIN weights USING (id) WHERE side = 0
),
noisy AS (
  SELECT doc_id, n_features, weight,
    weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM scored
),
placed AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM noisy WHERE n_features >= 20
)
SELECT doc_id, n_features, weight, score, CAST(CASE WHEN place <= n * 10 // 100 THEN place END AS BIGINT) AS rank
FROM noisy LEFT JOIN placed USING (doc_id)
"""


COLLOCATIONS = r"""
WITH pieces AS (
  SELECT doc_id, coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
),
worded AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
grams AS (
  SELECT lang, unnest(w) AS phrase, 1 AS size FROM worded
  UNION ALL SELECT lang, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])), 2 FROM worded
  UNION ALL SELECT lang, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])), 3 FROM worded
),
f AS (SELECT lang, phrase, size, count(*) AS f FROM grams GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE size = 1 GROUP BY lang),
candidates AS (SELECT lang, phrase, size, f AS a, string_split(phrase, ' ') AS w FROM f WHERE size > 1 AND f >= 10),
cuts AS (
  SELECT lang, phrase, a, k, array_to_string(w[:k], ' ') AS one, array_to_string(w[k + 1:], ' ') AS two
  FROM (SELECT *, unnest(range(1, size)) AS k FROM candidates)
),
scored AS (
  SELECT c.lang, c.phrase, c.a, k, x.f AS l, y.f AS r,
    CAST(1000000::HUGEINT * a * a // (x.f::HUGEINT * y.f) AS BIGINT) AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = one JOIN f y ON y.lang = c.lang AND y.phrase = two
),
weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_ AS (
  SELECT lang, phrase, max(a) AS longer FROM (
    SELECT lang, a, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS phrase FROM candidates WHERE size = 3
  ) GROUP BY ALL
),
kept AS (
  SELECT weakest.* FROM weakest LEFT JOIN inner_ USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 50 * a
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""


ORACLE = {
    "op12_collocations": COLLOCATIONS,
    "op13_importance_resampling": RESAMPLING,
    "op3_url_filters": URLS,
    "op5_minhash_dedup": NEAR,
    "op7_embedding_dedup": VECTORS,
    "op6_substring_dedup": repeats(13),
    "op8_suffix_dedup": repeats(50),
}
