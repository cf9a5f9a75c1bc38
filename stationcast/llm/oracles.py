"""DuckDB SQL of the queries that SQL can express, written from their definitions."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACED = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
PLAIN = (rf"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), "
         r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

MIX = f"""
WITH docs AS (
  SELECT doc_id, source, CAST(len({SPACED}) AS BIGINT) AS size,
    (CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':'
                             || md5(coalesce(text, ''))), 1, 13) AS BIGINT) + 0.5::DOUBLE)
      / 4503599627370496::DOUBLE AS u
  FROM documents),
sources AS (
  SELECT source, CAST(SUM(size) AS BIGINT) AS source_size,
    CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
      WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM docs GROUP BY source),
filled AS (
  SELECT source_size, weight, row_number() OVER (ORDER BY 3 * source_size / weight, source) AS k,
    coalesce(SUM(3 * source_size) OVER before, 0) AS caps,
    (SELECT SUM(weight) FROM sources) - coalesce(SUM(weight) OVER before, 0) AS open_weight
  FROM sources
  WINDOW before AS (ORDER BY 3 * source_size / weight, source
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (
  -- the first source, by how soon it is full, that its share does not fill
  SELECT min_by(CAST((SELECT SUM(source_size) FROM sources) - caps AS DOUBLE) / open_weight, k)
    AS share
  FROM filled
  WHERE CAST((SELECT SUM(source_size) FROM sources) - caps AS DOUBLE) / open_weight * weight
        < 3 * source_size),
targets AS (
  SELECT source, source_size,
    CASE WHEN share IS NULL OR share * weight >= 3 * source_size THEN CAST(3 * source_size AS DOUBLE)
         ELSE share * weight END AS target
  FROM sources, level),
expected AS (
  SELECT d.*, source_size, target,
    least(coalesce(target / nullif(CAST(source_size AS DOUBLE), 0), 0), 3.0::DOUBLE) AS copies_wanted
  FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source),
parts AS (
  SELECT *, CAST(floor(copies_wanted) AS BIGINT) AS whole,
    copies_wanted - floor(copies_wanted) AS p FROM expected),
ranked AS (
  SELECT *, CASE WHEN p > 0 THEN ((u / (1 - u)) / (p / (1 - p)))
                                 / (1 + (u / (1 - u)) / (p / (1 - p))) END AS rank,
    target - SUM(whole * size) OVER (PARTITION BY source) AS words_left FROM parts),
placed AS (
  SELECT *, SUM(size) OVER (PARTITION BY source, rank) AS tied,
    SUM(size) OVER (PARTITION BY source ORDER BY rank RANGE UNBOUNDED PRECEDING) AS up_to
  FROM ranked)
SELECT doc_id, size, source_size, target,
  CAST(whole + CASE WHEN rank IS NOT NULL AND up_to - tied / 2 <= words_left THEN 1 ELSE 0 END AS INT)
    AS copies,
  CAST((whole + CASE WHEN rank IS NOT NULL AND up_to - tied / 2 <= words_left THEN 1 ELSE 0 END)
       * size AS BIGINT) AS taken
FROM placed"""

URLS = rf"""
WITH split AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3)
                       ELSE '' END AS rest FROM pages),
hosts AS (
  SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw, rest FROM split),
parts AS (
  SELECT page_id, translate(raw, '{UPPER}', '{LOWER}') AS host,
    regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM hosts),
rules(rule, host_part, path_part, verdict) AS (VALUES
  ('com/', 'com', '/', 'allow'), ('example.com/en/', 'example.com', '/en/', 'block'),
  ('www.example.com/en/', 'www.example.com', '/en/', 'allow'),
  ('net/es/', 'net', '/es/', 'block'), ('net/fr/', 'net', '/fr/', 'block')),
best AS (
  SELECT page_id, max_by(rule, length(rule)) AS rule, max_by(verdict, length(rule)) AS verdict
  FROM parts JOIN rules
    ON (host = host_part OR ends_with(host, '.' || host_part)) AND starts_with(path, path_part)
  GROUP BY page_id),
spam AS (
  SELECT page_id, greatest(
    CASE WHEN regexp_matches(host, '\bcasino\b') THEN 'casino' END,
    CASE WHEN regexp_matches(host, '\bfree-bets?\b') THEN 'bets' END,
    CASE WHEN regexp_matches(host, '\bcheap-pills?\b') THEN 'pills' END,
    CASE WHEN regexp_matches(host || path, '\b(xxx|porn)\b') THEN 'adult' END) AS pattern
  FROM parts)
SELECT p.page_id, p.host, p.path, b.rule, s.pattern,
  coalesce(b.verdict, CASE WHEN s.pattern IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM parts p JOIN spam s USING (page_id) LEFT JOIN best b USING (page_id)"""

PASSAGES = f"""
WITH docs AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, {SPACED} AS w FROM documents),
grams AS (
  SELECT r, s, md5(array_to_string(w[s:s + 34], ' ')) AS g
  FROM (SELECT r, w, unnest(generate_series(1, len(w) - 34)) AS s FROM docs WHERE len(w) >= 35)),
again AS (SELECT r, s FROM grams WHERE g IN (SELECT g FROM grams GROUP BY g HAVING COUNT(*) > 1)),
gone AS (SELECT DISTINCT r, unnest(generate_series(s, s + 34)) AS p FROM again),
words AS (SELECT r, unnest(w) AS word, unnest(generate_series(1, len(w))) AS p FROM docs),
kept AS (
  SELECT r, string_agg(word, ' ' ORDER BY p) AS text, COUNT(*) AS n
  FROM words ANTI JOIN gone USING (r, p) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
  CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (r)"""

HITS = f"""
WITH docs AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {PLAIN} AS w FROM documents),
items AS (SELECT CAST(item_id AS VARCHAR) AS item, {PLAIN} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item, k, array_to_string(w[s:s + k - 1], ' ') AS g
  FROM (SELECT item, w, least(len(w), 10) AS k,
               unnest(generate_series(1, greatest(len(w) - 9, 1))) AS s
        FROM items WHERE len(w) > 0)),
grams AS (
  SELECT r, s, k, array_to_string(w[s:s + k - 1], ' ') AS g
  FROM (SELECT r, w, k, unnest(generate_series(1, len(w) - k + 1)) AS s
        FROM docs, (SELECT DISTINCT k FROM windows) WHERE len(w) >= k)),
hits AS (SELECT DISTINCT r, s, k, item FROM grams JOIN windows USING (g, k)),
words AS (SELECT r, COUNT(DISTINCT p) AS n
          FROM (SELECT r, unnest(generate_series(s, s + k - 1)) AS p FROM hits) GROUP BY r),
named AS (SELECT r, COUNT(*) AS n, string_agg(item, ',' ORDER BY item) AS list
          FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(words.n, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(named.n, 0) AS BIGINT) AS n_items, sha256(coalesce(list, '')) AS items_sha256,
  words.n IS NOT NULL AS contaminated
FROM docs LEFT JOIN words USING (r) LEFT JOIN named USING (r)"""

VECTORS = """
WITH RECURSIVE unit AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)
           / sqrt(list_sum(list_transform(embedding, lambda y: CAST(y AS DOUBLE) * y)))) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM unit a JOIN unit b
    ON a.vec_id <> b.vec_id AND list_dot_product(a.v, b.v) >= 0.9),
reach AS (
  SELECT vec_id AS node, vec_id AS other FROM embeddings
  UNION SELECT reach.node, links.b FROM reach JOIN links ON links.a = reach.other),
components AS (SELECT node, MIN(other) AS component_id FROM reach GROUP BY node),
degree AS (SELECT a, COUNT(*) AS n FROM links GROUP BY a)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN components ON node = vec_id LEFT JOIN degree ON a = vec_id"""

LINES = rf"""
WITH docs AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
lines AS MATERIALIZED (
  SELECT r, doc_id, unnest(l) AS line, unnest(generate_series(1, len(l))) AS p FROM docs),
keyed AS (
  SELECT *, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''),
                                     '[\x20\x09-\x0D]+$', ''), '{UPPER}', '{LOWER}') AS key FROM lines),
owners AS (
  SELECT key, MIN(doc_id) AS owner FROM keyed WHERE length(key) >= 10
  GROUP BY key HAVING COUNT(DISTINCT doc_id) > 1),
kept AS (
  SELECT r, string_agg(line, chr(10) ORDER BY p) AS text, COUNT(*) AS n
  FROM keyed LEFT JOIN owners USING (key) WHERE owner IS NULL OR owner = doc_id GROUP BY r)
SELECT doc_id, CAST(len(l) AS BIGINT) AS n_lines,
  CAST(len(l) - coalesce(n, 0) AS BIGINT) AS n_dropped, sha256(coalesce(text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (r)"""

MANIFEST = f"""
WITH RECURSIVE leaves AS MATERIALIZED (
  SELECT doc_id, lang, h || coalesce(octet_length(encode(text)) || ':' || text, '-') AS row_text,
    h || coalesce(octet_length(encode(text)) || ':' || translate(text, '{UPPER}', '{LOWER}'), '-') AS low,
    -- CRC-32 of the id's digits, bit by bit
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(
        string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT))),
      lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)),
        lambda x, k: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) AS crc
  FROM (SELECT *, array_to_string(list_transform(
          [CAST(doc_id AS VARCHAR), source, lang, CAST(n_chars AS VARCHAR)],
          lambda v: coalesce(octet_length(encode(v)) || ':' || v, '-')), '') AS h FROM documents)),
placed AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place
  FROM (SELECT doc_id, lang, sha256(row_text) AS leaf,
          CASE WHEN crc % 3 = 0 THEN sha256(low) ELSE sha256(row_text) END AS given FROM leaves)),
levels AS (
  SELECT lang, 0 AS level, list(leaf ORDER BY place) AS l FROM placed GROUP BY lang
  UNION ALL
  SELECT lang, level + 1, list_transform(range(0, len(l), 8),
    lambda i: sha256(array_to_string(l[i + 1:i + 8], ''))) FROM levels WHERE len(l) > 1),
subroots AS (
  SELECT lang, l[1] AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place
  FROM levels WHERE len(l) = 1),
tops AS (
  SELECT 0 AS level, list(subroot ORDER BY place) AS l FROM subroots HAVING COUNT(*) > 0
  UNION ALL
  SELECT level + 1, list_transform(range(0, len(l), 8),
    lambda i: sha256(array_to_string(l[i + 1:i + 8], ''))) FROM tops WHERE len(l) > 1),
nodes AS (
  SELECT 0 AS stage, lang, level, unnest(l) AS digest, unnest(range(len(l))) AS place
  FROM levels WHERE len(l) > 1
  UNION ALL
  SELECT 1, NULL, level, unnest(l), unnest(range(len(l))) FROM tops WHERE len(l) > 1),
runs AS MATERIALIZED (
  SELECT stage, lang, level, place // 8 AS run, list(digest ORDER BY place) AS members
  FROM nodes GROUP BY ALL),
paths AS (
  SELECT 0 AS stage, p.doc_id, p.leaf, p.place AS row_place, p.lang, p.lang AS tree, p.place
  FROM placed p
  UNION ALL
  SELECT 1, p.doc_id, p.leaf, p.place, p.lang, NULL, s.place
  FROM placed p JOIN subroots s ON p.lang IS NOT DISTINCT FROM s.lang),
steps AS (
  SELECT p.lang, p.row_place, p.stage, level, members, (p.place >> (3 * level)) % 8 AS k
  FROM paths p JOIN runs r ON p.stage = r.stage AND p.tree IS NOT DISTINCT FROM r.lang
    AND p.place >> (3 * level + 3) = r.run),
proofs AS (
  SELECT lang, row_place, list(array_to_string(members[1:k], '') || '|'
                               || array_to_string(members[k + 2:], '') ORDER BY stage, level) AS path
  FROM steps GROUP BY ALL)
SELECT *, folded_root = root AS verified FROM (
SELECT doc_id, leaf, subroot, (SELECT l[1] FROM tops WHERE len(l) = 1) AS root,
  sha256(replace(array_to_string(coalesce(path, []), ''), '|', '')) AS proof_sha256,
  list_reduce(list_prepend(given, coalesce(path, [])),
    lambda d, s: sha256(split_part(s, '|', 1) || d || split_part(s, '|', 2))) AS folded_root
FROM placed JOIN subroots ON placed.lang IS NOT DISTINCT FROM subroots.lang
LEFT JOIN proofs ON placed.lang IS NOT DISTINCT FROM proofs.lang AND placed.place = proofs.row_place)"""

ORACLES = {
    "op3_pareto_mix": MIX,
    "op5_url_rules": URLS,
    "op6_recompression": PASSAGES,
    "op7_iterative_quantisation": VECTORS,
    "op9_positional_index": HITS,
    "op12_merkle_manifest": MANIFEST,
    "op13_line_bitmaps": LINES,
}
