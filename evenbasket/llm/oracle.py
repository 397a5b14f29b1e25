"""DuckDB SQL of the queries that SQL can express, written apart from the operators."""

_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

NEAR_DEDUP = rf"""
WITH RECURSIVE words AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
      ELSE [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)] END) AS s FROM words)
), sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS MATERIALIZED (
  SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2)
  JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * k >= 85 * (p.n + q.n - k)
), reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.other
), least AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, component_id = d.doc_id AS kept
FROM documents d JOIN least USING (doc_id) LEFT JOIN sizes USING (doc_id)
"""

DECONTAMINATION = rf"""
WITH item_words AS MATERIALIZED (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), patterns AS MATERIALIZED (
  SELECT DISTINCT item, n, p FROM (
    SELECT item, least(len(w), 10) AS n, unnest([array_to_string(w[i:i + least(len(w), 10) - 1], ' ') FOR i IN range(1, len(w) - least(len(w), 10) + 2)]) AS p
    FROM item_words WHERE len(w) > 0)
), doc_words AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), spots AS (
  SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc_words, (SELECT DISTINCT n FROM patterns) WHERE len(w) >= n
), found AS MATERIALIZED (
  SELECT r, i, spots.n, item FROM spots JOIN patterns ON spots.n = patterns.n AND array_to_string(w[i:i + spots.n - 1], ' ') = p
), hits AS (SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS k FROM found) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT r, item FROM found) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN hits USING (r) LEFT JOIN items USING (r)
"""

#: Reserved strings get a backslash behind their first character, and so do those that have backslashes there.
_ESCAPED_SQL = r"""regexp_replace({0}, '([<\[])(\\*)(s>|/s>|INST\]|/INST\]|<SYS>>|</SYS>>|\|im_start\|>|\|im_end\|>|\|endoftext\|>)', '\1\\\2\3', 'g')"""

CHAT = f"""
WITH given AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text)) AS loss_sha256,
  CAST(sum(length(role) + length({_ESCAPED_SQL.format("text")}) + length('<s>') + 1 + length('</s>') + 1) AS BIGINT) AS formatted_chars
FROM given GROUP BY conv_id
"""

URL_RULES = f"""
WITH rules(host, path, verdict) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
cut AS (SELECT row_number() OVER () AS r, page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT r, page_id, {_LOWER.format("regexp_extract(rest, '^[^/?#]*')")} AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut
), best AS (
  SELECT r, arg_max(rules.host || rules.path, length(rules.host || rules.path)) AS rule, arg_max(verdict, length(rules.host || rules.path)) AS verdict
  FROM parts JOIN rules ON (parts.host = rules.host OR ends_with(parts.host, '.' || rules.host)) AND starts_with(parts.path, rules.path) GROUP BY r
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parts LEFT JOIN best USING (r)
"""

FILL_IN_MIDDLE = r"""
WITH own AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS l,
    sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
), drawn AS (
  SELECT *, CAST(len(l) AS BIGINT) AS n, CAST('0x' || h[1:8] AS BIGINT) % (len(l) + 1) AS x, CAST('0x' || h[9:16] AS BIGINT) % (len(l) + 1) AS y,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') THEN 'plain'
      WHEN CAST('0x' || h[25:32] AS BIGINT) % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM own
), cut AS (
  SELECT *, array_to_string(l[1:least(x, y)], '') AS prefix, array_to_string(l[least(x, y) + 1:greatest(x, y)], '') AS middle,
    array_to_string(l[greatest(x, y) + 1:len(l)], '') AS suffix FROM drawn
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM cut
"""

SQL = {
    "op2_chat_round_trip": CHAT,
    "op7_url_rules": URL_RULES,
    "op8_minhash_near_dedup": NEAR_DEDUP,
    "op10_benchmark_decontamination": DECONTAMINATION,
    "op13_fill_in_middle": FILL_IN_MIDDLE,
}
