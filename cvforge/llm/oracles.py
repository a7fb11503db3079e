"""DuckDB SQL for the dealt queries that SQL can express, written apart from the operators."""

from __future__ import annotations

from cvforge.llm.url_filter import SOFT_TERMS, STRICT_TERMS

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP5 = f"""
WITH RECURSIVE item AS (
  SELECT item_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
pattern AS (
  SELECT DISTINCT CAST(item_id AS VARCHAR) AS item_id, least(10, len(w)) AS size,
         array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM item WHERE len(w) > 0)),
doc AS (
  SELECT doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
place AS (
  SELECT doc_id, size, i, array_to_string(w[i : i + size - 1], ' ') AS win
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
        FROM doc, (SELECT DISTINCT size FROM pattern) WHERE len(w) >= size)),
hit AS (SELECT doc_id, i, place.size, item_id FROM place JOIN pattern USING (size, win)),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids FROM hit GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
""".replace("WITH RECURSIVE", "WITH")

_term = lambda t: f"regexp_matches(u, '(^|[^a-z0-9]){t}([^a-z0-9]|$)')"

OP9 = f"""
WITH parts AS (
  SELECT page_id, url, {LOWER.format("coalesce(regexp_extract(url, '://([^/?#]*)', 1), '')")} AS host,
         coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path, {LOWER.format("coalesce(url, '')")} AS u
  FROM pages),
rules(rule_host, rule_path, said) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
  ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
best AS (
  SELECT page_id, url, max_by(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
         max_by(said, length(rule_host || rule_path)) AS said
  FROM parts JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY page_id, url)
SELECT parts.page_id, host, path, rule,
       CASE WHEN rule IS NOT NULL THEN said
            WHEN {" OR ".join(map(_term, STRICT_TERMS))} THEN 'block'
            WHEN {" + ".join(f"CAST({_term(t)} AS INT)" for t in SOFT_TERMS)} >= 2 THEN 'block' ELSE 'allow' END AS verdict
FROM parts LEFT JOIN best ON parts.page_id = best.page_id AND parts.url IS NOT DISTINCT FROM best.url
"""

OP10 = """
WITH sums AS (
  SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
firsts AS (SELECT payload_digest, min(page_id) AS first_id FROM sums WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first_id IS NULL OR first_id = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first_id <> page_id THEN first_id END AS refers_to
FROM sums LEFT JOIN firsts USING (payload_digest)
"""

OP11 = f"""
WITH t AS (SELECT doc_id, {LOWER.format("coalesce(text, '')")} AS t FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM t WINDOW w AS (PARTITION BY t)
"""

OP12 = f"""
WITH pieces AS (
  SELECT lang, row_number() OVER () AS piece, list_filter(string_split_regex(t, '[\\x20\\x09]+'), lambda x: x <> '') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({LOWER.format("coalesce(text, '')")}, '[.,;:!?\\x0A-\\x0D]')) AS t FROM documents)),
f AS (
  SELECT lang, m, p, count(*) AS f FROM (
    SELECT lang, m, array_to_string(w[i : i + m - 1], ' ') AS p
    FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM pieces, (VALUES (1), (2), (3), (4)) AS s(m) WHERE len(w) >= m))
  GROUP BY ALL),
cand AS (SELECT lang, m, p, f AS a, string_split(p, ' ') AS w FROM f WHERE m > 1 AND f >= 30),
cuts AS (
  SELECT c.lang, c.p, c.m, c.w, c.a, k, h.f AS l, t.f AS r, (2000000 * c.a::HUGEINT) // (h.f + t.f)::HUGEINT AS score
  FROM (SELECT *, lang || chr(9) || array_to_string(w[1 : k], ' ') AS head, lang || chr(9) || array_to_string(w[k + 1 : m], ' ') AS tail
        FROM (SELECT *, unnest(range(1, m)) AS k FROM cand)) AS c
  JOIN (SELECT lang || chr(9) || p AS head, f FROM f) AS h ON h.head = c.head
  JOIN (SELECT lang || chr(9) || p AS tail, f FROM f) AS t ON t.tail = c.tail),
low AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
held AS (
  SELECT lang, p, max(a) AS longer FROM (
    SELECT lang, a, array_to_string(w[i : i + n - 1], ' ') AS p
    FROM (SELECT *, unnest(range(1, m - n + 2)) AS i FROM cand, (VALUES (2), (3)) AS s(n) WHERE n < m))
  GROUP BY ALL),
best AS (
  SELECT low.lang, p, a, l, r, score, row_number() OVER (PARTITION BY low.lang ORDER BY score DESC, a DESC, p) AS rank
  FROM low LEFT JOIN held USING (lang, p) WHERE longer IS NULL OR 100 * longer < 80 * a)
SELECT lang, rank, p AS phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM best JOIN (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE m = 1 GROUP BY lang) USING (lang) WHERE rank <= 2000
"""

OP13 = """
WITH said AS (SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic FROM labels GROUP BY doc_id),
words AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
fails AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         concat(CASE WHEN len(w) < 200 THEN 'A' ELSE '' END,
                CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END,
                CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) THEN 'C' ELSE '' END,
                CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END,
                CASE WHEN words.doc_id > min(words.doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END) AS x
  FROM words LEFT JOIN said USING (doc_id)),
counts AS (SELECT part, x, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM fails GROUP BY ALL),
letter(f) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS o FROM letter a, letter b, letter c, letter d, letter e
  WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
steps AS (SELECT o, step, o[step] AS f, o[1 : step - 1] AS before FROM (SELECT o, unnest(range(1, 6)) AS step FROM orders)),
told AS (
  SELECT part, o, step, f, n, good, toxic, x, contains(x, f) AS fails,
         len(list_filter(string_split(before, ''), lambda b: b <> '' AND contains(x, b))) > 0 AS gone FROM counts, steps),
found AS (
  SELECT part, o AS filter_order, CAST(step AS INT) AS step, f,
         sum(CASE WHEN NOT gone AND NOT fails THEN n ELSE 0 END)::BIGINT AS kept,
         sum(CASE WHEN NOT gone AND fails THEN n ELSE 0 END)::BIGINT AS removed,
         sum(CASE WHEN gone AND fails THEN n ELSE 0 END)::BIGINT AS redundant,
         sum(CASE WHEN x = f THEN n ELSE 0 END)::BIGINT AS unique_fails,
         sum(CASE WHEN NOT gone AND fails THEN good ELSE 0 END)::BIGINT AS good_lost,
         sum(CASE WHEN NOT gone AND fails THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM told GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
FROM found
"""

ORACLES: dict[str, str] = {
    "op5_decontam": OP5, "op9_urls": OP9, "op10_warc": OP10,
    "op11_exact_dedup": OP11, "op12_collocations": OP12, "op13_filter_audit": OP13,
}
