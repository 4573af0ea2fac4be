"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from millrace.llm.licenses import BLOCK_COMMENT, BLOCK_END, COMMENT, TEMPLATES, THRESHOLD, WEAK, whole_texts

URL_FILTER = r"""
WITH u AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), '^[\s\S]*?://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '^[\s\S]*?://([^/?#]*)([^?#]*)', 2) AS path
  FROM pages
), rules(verdict, host, path) AS (
  VALUES ('block', 'com', '/en/'), ('allow', 'example.com', '/en/7'), ('allow', 'net', '/de/'), ('block', 'example.net', '/de/8'), ('block', 'org', '/es/')
), hit AS (
  SELECT u.page_id, u.host, u.path, r.host || r.path AS rule, r.verdict,
         row_number() OVER (PARTITION BY u.page_id ORDER BY length(r.host || r.path) DESC, length(r.host) DESC, r.verdict) AS rn
  FROM u JOIN rules r ON ('.' || u.host) LIKE ('%.' || r.host) AND starts_with(u.path, r.path)
)
SELECT u.page_id, u.host, u.path, hit.rule, coalesce(hit.verdict, 'allow') AS verdict
FROM u LEFT JOIN hit ON u.page_id = hit.page_id AND hit.rn = 1
"""


NEAR_DUPLICATES = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                 ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM words
), items AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM items a JOIN items b ON a.x = b.x AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
), edges AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach(node, root) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT e.b, r.root FROM reach r JOIN edges e ON e.a = r.node WHERE r.root < e.b
), labels AS (
  SELECT node, min(root) AS component_id FROM reach GROUP BY node
)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, l.component_id, s.doc_id = l.component_id AS kept
FROM sets s JOIN labels l ON l.node = s.doc_id
"""


CONTAMINATION = r"""
WITH w AS (
  SELECT 'd' AS side, CAST(doc_id AS VARCHAR) AS id, text FROM documents UNION ALL SELECT 'b', CAST(item_id AS VARCHAR), text FROM benchmark
), t AS (
  SELECT side, id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM w
), windows AS (
  SELECT DISTINCT id, k, array_to_string(w[i:i + k - 1], ' ') AS win
  FROM (SELECT id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM (SELECT id, w, least(10, len(w)) AS k FROM t WHERE side = 'b' AND len(w) > 0))
), lens AS (
  SELECT DISTINCT k FROM windows
), grams AS (
  SELECT id, k, i, array_to_string(w[i:i + k - 1], ' ') AS win
  FROM (SELECT t.id, t.w, lens.k, unnest(range(1, len(t.w) - lens.k + 2)) AS i FROM t, lens WHERE t.side = 'd')
), hits AS (
  SELECT g.id, g.i, g.k, v.id AS item FROM grams g JOIN windows v ON g.k = v.k AND g.win = v.win
), words AS (
  SELECT id, count(DISTINCT i + j) AS n_hit FROM (SELECT id, i, unnest(range(0, k)) AS j FROM hits) GROUP BY id
), found AS (
  SELECT id, list_sort(list(DISTINCT item) FILTER (item IS NOT NULL)) AS items FROM hits GROUP BY id
)
SELECT d.doc_id, CAST(len(t.w) AS BIGINT) AS n_words, CAST(coalesce(words.n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(len(f.items), 0) AS BIGINT) AS n_items,
       sha256(coalesce(array_to_string(f.items, ','), '')) AS items_sha256, coalesce(words.n_hit, 0) > 0 AS contaminated
FROM documents d JOIN t ON t.side = 'd' AND t.id = CAST(d.doc_id AS VARCHAR) LEFT JOIN words ON words.id = t.id LEFT JOIN found f ON f.id = t.id
"""


def _terms(text: str) -> str:
    return f"list_filter(list_transform(regexp_split_to_array(lower(coalesce({text}, '')), '[^a-z0-9.]+'), lambda w: trim(w, '.')), lambda w: w <> '')"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


#: Every unit is compared with every template it may match, and every file with all licence files above it.
LICENCES = f"""
WITH templates(template, licence, whole, text) AS (
  VALUES {", ".join(f"({i}, {_quoted(licence)}, {i >= len(TEMPLATES)}, {_quoted(text)})" for i, (licence, text) in enumerate([*TEMPLATES, *whole_texts()]))}
), tt AS (
  SELECT template, licence, whole, term, count(*) AS tf FROM (SELECT template, licence, whole, unnest({_terms("text")}) AS term FROM templates) GROUP BY template, licence, whole, term
), docs AS (
  SELECT doc_id, coalesce(source, 'none') || '/' || coalesce(lang, 'none') || '/d' || (doc_id // 10) AS dir, CASE WHEN doc_id % 10 = 0 THEN 'LICENSE' ELSE doc_id || '.txt' END AS name, text,
         regexp_split_to_array(coalesce(text, ''), '\\r\\n|\\r|\\n') AS lines FROM documents
), frequency AS (
  SELECT term, count(*) AS df FROM (SELECT DISTINCT doc_id, unnest({_terms("text")}) AS term FROM docs) WHERE term IN (SELECT term FROM tt) GROUP BY term
), idf AS (
  SELECT t.term, ln((1.0 + (SELECT count(*) FROM docs)) / (1.0 + coalesce(f.df, 0))) + 1 AS idf FROM (SELECT DISTINCT term FROM tt) t LEFT JOIN frequency f ON t.term = f.term
), weights AS (
  SELECT template, licence, whole, tt.term, tf * idf AS w FROM tt JOIN idf ON tt.term = idf.term
), norms AS (
  SELECT template, sqrt(sum(w * w)) AS norm FROM weights GROUP BY template
), led AS (
  SELECT doc_id, lines, coalesce(list_position(list_transform(lines, lambda x: NOT regexp_matches(x, '{COMMENT}')), true) - 1, len(lines)) AS led,
         CASE WHEN regexp_matches(lines[1], '{BLOCK_COMMENT}') THEN coalesce(list_position(list_transform(lines, lambda x: regexp_matches(x, '{BLOCK_END}')), true), len(lines)) ELSE 0 END AS block FROM docs
), units AS (
  SELECT doc_id, unnest(lines) AS text, generate_subscripts(lines, 1) - 1 AS unit FROM docs
  UNION ALL SELECT doc_id, array_to_string(lines[1:greatest(led, block)], ' '), -1 FROM led WHERE greatest(led, block) > 0
  UNION ALL SELECT doc_id, array_to_string(lines, ' '), -2 FROM docs WHERE name = 'LICENSE'
), counted AS (
  SELECT doc_id, unit, term, count(*) AS tf FROM (SELECT doc_id, unit, unnest({_terms("text")}) AS term FROM units) GROUP BY doc_id, unit, term
), weighed AS (
  SELECT doc_id, unit, c.term, tf * coalesce(idf, ln(1.0 + (SELECT count(*) FROM docs)) + 1) AS u FROM counted c LEFT JOIN idf ON c.term = idf.term
), lengths AS (
  SELECT doc_id, unit, sqrt(sum(u * u)) AS length FROM weighed GROUP BY doc_id, unit
), dots AS (
  SELECT doc_id, unit, template, licence, sum(u * w) AS dot FROM weighed JOIN weights ON weighed.term = weights.term WHERE unit < 0 OR NOT whole GROUP BY doc_id, unit, template, licence
), scored AS (
  SELECT d.doc_id, d.unit, licence, round(dot / (norm * length), 6) AS score FROM dots d JOIN norms ON d.template = norms.template JOIN lengths l ON l.doc_id = d.doc_id AND l.unit = d.unit
), best AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY licence <> '{WEAK}' DESC, score DESC, unit, licence DESC) AS rn FROM scored WHERE score >= {THRESHOLD}
), own AS (
  SELECT d.doc_id, d.dir, d.name, b.licence, b.score, CAST(b.unit AS INTEGER) AS unit FROM docs d LEFT JOIN best b ON b.doc_id = d.doc_id AND b.rn = 1
), above AS (
  SELECT o.doc_id, g.licence, g.score, len(string_split(o.dir, '/')) - len(string_split(g.dir, '/')) AS depth,
         row_number() OVER (PARTITION BY o.doc_id ORDER BY len(g.dir) DESC, g.licence <> '{WEAK}' DESC, g.score DESC, g.licence DESC) AS rn
  FROM own o JOIN own g ON g.name = 'LICENSE' AND g.licence IS NOT NULL AND (o.dir = g.dir OR starts_with(o.dir, g.dir || '/')) WHERE o.licence IS NULL
)
SELECT o.doc_id, o.dir || '/' || o.name AS path, coalesce(o.licence, a.licence) AS licence, coalesce(o.score, a.score) AS score, o.unit,
       CASE WHEN o.licence IS NOT NULL THEN 'file' WHEN a.licence IS NOT NULL THEN 'directory' END AS found_in, CAST(a.depth AS INTEGER) AS depth
FROM own o LEFT JOIN above a ON a.doc_id = o.doc_id AND a.rn = 1
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_minhash_near_dedup": NEAR_DUPLICATES, "op8_benchmark_decontamination": CONTAMINATION, "op9_license_scan": LICENCES, "op10_url_filter": URL_FILTER}
