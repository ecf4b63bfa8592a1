"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

OP3 = """
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
  FROM documents
), keyed AS (
  SELECT doc_id, place, line, translate(regexp_replace(line, '^[ \\x09-\\x0D]+|[ \\x09-\\x0D]+$', '', 'g'),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), shared AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), judged AS (
  SELECT k.doc_id, k.place, k.line, s.keeper IS NOT NULL AND s.keeper <> k.doc_id AS gone
  FROM keyed k LEFT JOIN shared s ON k.key = s.key
)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN gone THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

OP8 = """
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), item_words AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), phrases AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(list_slice(w, i, i + least(13, len(w)) - 1), ' ') AS phrase
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS i FROM item_words WHERE len(w) > 0)
), places AS (
  SELECT doc_id, i, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS phrase
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM words, (SELECT DISTINCT n FROM phrases) WHERE len(w) >= n)
), hits AS (
  SELECT doc_id, i, p.n, item_id FROM places p JOIN phrases q ON p.phrase = q.phrase AND p.n = q.n
), hit_words AS (
  SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hits) GROUP BY doc_id
), hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM words LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""

#: The crc32 of an ASCII text, bit by bit.
CRC = """xor(list_reduce(
      list_concat([4294967295::UBIGINT], list_transform(string_split({text}, ''), lambda ch: CAST(ord(ch) AS UBIGINT))),
      lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
        lambda x, bit: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::UBIGINT) ELSE x >> 1 END)
    ), 4294967295::UBIGINT)"""

# States: 0 nothing yet, 1 behind a system turn, 2 behind a user turn, 3 behind an assistant turn.
OP12 = (
    """
WITH RECURSIVE told AS (
  SELECT conv_id, turn, coalesce(CAST(conv_id AS VARCHAR), ' ') AS c, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS label
  FROM conversations
), harmed AS (
  SELECT *, """
    + CRC.format(text="label")
    + """ % 20 AS harm FROM told
), damaged AS (
  SELECT c, turn, CASE WHEN harm = 4 THEN 'user' ELSE role END AS role,
    CASE harm WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN harm = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM harmed WHERE harm <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, text, copy) AS i,
    rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare FROM damaged
), judged AS (
  SELECT *, left(role, 1) AS initial, bare = '' AS blank,
    bare <> '' AND row_number() OVER (PARTITION BY c, role, text ORDER BY i) > 1 AS repeated,
    lag(left(role, 1)) OVER (PARTITION BY c ORDER BY i) AS before
  FROM placed
), faults AS (
  SELECT *, NOT blank AND NOT repeated AND right(bare, 1) NOT IN ('.', '!', '?') AS short FROM judged
), gaps(k, q, q2, letters, lines) AS (
  -- up to two inserted turns: from state, to state, edits, lines
  VALUES (0, 0, 0, '', []::VARCHAR[]), (0, 1, 1, '', []), (0, 2, 2, '', []), (0, 3, 3, '', []),
    (1, 0, 2, 'I', ['user:']), (1, 1, 2, 'I', ['user:']), (1, 2, 3, 'I', ['assistant:']), (1, 3, 2, 'I', ['user:']),
    (2, 0, 3, 'II', ['user:', 'assistant:']), (2, 1, 3, 'II', ['user:', 'assistant:']),
    (2, 2, 2, 'II', ['assistant:', 'user:']), (2, 3, 3, 'II', ['user:', 'assistant:'])
), edits(letter, q, initial, q2, role, cost) AS (
  VALUES ('D', 0, NULL, 0, NULL, 2), ('D', 1, NULL, 1, NULL, 2), ('D', 2, NULL, 2, NULL, 2), ('D', 3, NULL, 3, NULL, 2),
    ('K', 0, 's', 1, NULL, 0), ('K', 0, 'u', 2, NULL, 0), ('K', 1, 'u', 2, NULL, 0), ('K', 2, 'a', 3, NULL, 0), ('K', 3, 'u', 2, NULL, 0),
    ('R', 0, NULL, 2, 'user', 1), ('R', 1, NULL, 2, 'user', 1), ('R', 2, NULL, 3, 'assistant', 1), ('R', 3, NULL, 2, 'user', 1)
), ways AS (
  SELECT DISTINCT c, 0 AS i, 0 AS q, 0 AS cost, '' AS audit, []::VARCHAR[] AS made FROM told
  UNION ALL
  SELECT c, i, q, cost, audit, made FROM (
    SELECT w.c, w.i + 1 AS i, e.q2 AS q, w.cost + 5 * g.k + e.cost + CASE WHEN short AND letter <> 'D' THEN 5 ELSE 0 END AS cost,
      w.audit || g.letters || letter AS audit,
      list_concat(list_concat(w.made, g.lines), CASE WHEN letter = 'D' THEN [] ELSE [coalesce(e.role, r.role) || ':' || r.text] END) AS made,
      row_number() OVER (PARTITION BY w.c, e.q2 ORDER BY w.cost + 5 * g.k + e.cost + CASE WHEN short AND letter <> 'D' THEN 5 ELSE 0 END,
        w.audit || g.letters || letter) AS best
    FROM ways w JOIN faults r ON r.c = w.c AND r.i = w.i + 1 JOIN gaps g ON g.q = w.q JOIN edits e ON e.q = g.q2
    WHERE letter = 'D' OR NOT blank AND NOT repeated AND (e.initial IS NULL OR e.initial = r.initial)
  ) WHERE best = 1
), ended AS (
  SELECT w.c, w.cost + 5 * g.k AS cost, w.audit || g.letters AS audit, list_concat(w.made, g.lines) AS made,
    row_number() OVER (PARTITION BY w.c ORDER BY w.cost + 5 * g.k, w.audit || g.letters) AS best
  FROM ways w JOIN gaps g ON g.q = w.q WHERE g.q2 IN (0, 3) AND w.i = (SELECT count(*) FROM faults f WHERE f.c = w.c)
), counted AS (
  SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
    count(*) FILTER (repeated) AS duplicate, count(*) FILTER (short) AS truncated,
    count(*) FILTER (before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faults GROUP BY c
)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(cost AS BIGINT) AS cost, audit,
  sha256(array_to_string(made, chr(10))) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, c FROM told) JOIN ended USING (c) LEFT JOIN counted USING (c) WHERE best = 1
"""
)

OP13 = (
    """
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS p
  FROM conversations WHERE conv_id IS NOT NULL
), talks AS (
  SELECT c, c - c % 100 AS lender, """
    + CRC.format(text="CAST(c AS VARCHAR)")
    + """ % 6 AS h
  FROM (SELECT DISTINCT conv_id AS c FROM turns)
), rebuilt AS (
  SELECT c, 0 AS part, p, role, text FROM talks JOIN turns ON conv_id = lender AND p <= h
  UNION ALL SELECT c, 1, p, role, text FROM talks JOIN turns ON conv_id = c AND p > h
), steps AS (
  SELECT c, row_number() OVER w AS d, length(text) AS chars,
    string_agg(md5(length(role) || ':' || role || text), ',') OVER w AS prefix
  FROM rebuilt WINDOW w AS (PARTITION BY c ORDER BY part, p)
), members AS (
  SELECT c, d, chars, prefix FROM steps UNION ALL SELECT c, 0, 0, '' FROM talks
), ended AS (
  SELECT *, d = max(d) OVER (PARTITION BY c) AS is_end FROM members
), nodes AS (
  SELECT prefix, d AS depth, min(c) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars,
    coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (is_end), '') AS ends, bool_and(is_end) AS leaf,
    CASE WHEN d > 1 THEN left(prefix, length(prefix) - 33) WHEN d = 1 THEN '' END AS parent
  FROM ended GROUP BY prefix, d
), sums AS (
  SELECT m.prefix, CAST(sum(CASE WHEN n.leaf THEN 1 ELSE 0 END) AS BIGINT) AS n_leaves,
    CAST(sum((n.n_convs - 1) * n.chars) AS BIGINT) AS saved_tokens
  FROM nodes n JOIN members m ON m.c = n.conv_id AND m.d <= n.depth GROUP BY m.prefix
), children AS (
  SELECT parent, count(*) AS n_children FROM nodes GROUP BY parent
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, n_leaves,
  saved_tokens, sha256(n.ends) AS ends_sha256
FROM nodes n JOIN sums USING (prefix) LEFT JOIN children ON children.parent = n.prefix LEFT JOIN nodes p ON p.prefix = n.parent
"""
)

LLM_ORACLE: dict[str, str] = {"op3_line_dedup": OP3, "op8_fm_index": OP8, "op12_iterative_deepening": OP12, "op13_depth_bands": OP13}
