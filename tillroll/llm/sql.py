"""The operators that SQL can express, in DuckDB's words. The others learn, or tokenize, or
have no fixed result columns, and are tested against brute force."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(pattern: str) -> str:
    text = f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')"
    return f"regexp_extract_all({text}, '{pattern}')"


_ITEM_WORDS = _words(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_SHINGLE_WORDS = _words(r"[^\x20\x09-\x0D]+")

OP4 = f"""
WITH d AS (SELECT doc_id, {_ITEM_WORDS} AS w FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item, {_ITEM_WORDS} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item, w[p:p + least(len(w), 13) - 1] AS win
  FROM i, unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS u(p) WHERE len(w) > 0
),
sizes AS (SELECT DISTINCT len(win) AS n FROM win),
places AS (
  SELECT doc_id, p, n, w[p:p + n - 1] AS win
  FROM d, sizes, unnest(range(1, len(w) - n + 2)) AS u(p) WHERE len(w) >= n
),
found AS (SELECT doc_id, p, n, item FROM places JOIN win USING (win)),
hits AS (
  SELECT doc_id, count(*) AS n_hit
  FROM (SELECT DISTINCT doc_id, unnest(range(p, p + n)) FROM found) GROUP BY doc_id
),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP6 = r"""
WITH rows_ AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
),
turns AS (
  SELECT *, '### ' || role || ': ' AS head,
    regexp_replace(text, '(### [A-Za-z0-9.*_%+-]*: |</turn>)', '\\\1', 'g') AS body FROM rows_
),
joined AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, head, body) AS said,
    coalesce(string_agg(text, '' ORDER BY turn, head, body) FILTER (role = 'assistant'), '') AS loss,
    CAST(sum(length(head) + length(body) + 9) AS BIGINT) AS formatted_chars
  FROM turns GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars,
  sha256(loss) AS loss_sha256, formatted_chars, true AS round_trip
FROM joined
"""

OP8 = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_SHINGLE_WORDS} AS w FROM documents),
sets AS (
  SELECT DISTINCT doc_id, array_to_string(w[p:p + 4], ' ') AS shingle
  FROM d, unnest(range(1, greatest(len(w) - 5, 0) + 2)) AS u(p) WHERE len(w) > 0
),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared
  FROM sets a JOIN sets b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2
),
links AS (
  SELECT x, y FROM pairs JOIN sizes s ON s.doc_id = x JOIN sizes t ON t.doc_id = y
  WHERE 100 * shared >= 75 * (s.n + t.n - shared)
),
sides AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (
  SELECT doc_id, doc_id AS other FROM d
  UNION SELECT r.doc_id, s.y FROM reach r JOIN sides s ON s.x = r.other
),
lowest AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM d JOIN lowest USING (doc_id) LEFT JOIN sizes USING (doc_id)
"""

OP11 = r"""
WITH crc_table AS MATERIALIZED (
  SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)),
    lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
),
own AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i
  FROM conversations WHERE conv_id IS NOT NULL
),
sizes AS (SELECT c, max(i) AS n FROM own GROUP BY c),
convs AS (
  SELECT s.c, s.c - s.c % 100 AS base, n, xor(list_reduce(list_prepend(4294967295,
      list_transform(range(1, length(s.c::VARCHAR) + 1), lambda i: ord((s.c::VARCHAR)[i]))),
    lambda x, y: xor(x >> 8, t[(xor(x, y) & 255) + 1])), 4294967295) % 6 AS h
  FROM sizes s, crc_table
),
taken AS (
  SELECT convs.*, least(h, coalesce(b.n, 0)) AS m FROM convs LEFT JOIN sizes b ON b.c = base
),
turns AS (
  SELECT t.c, o.i AS d, role, text FROM taken t JOIN own o ON o.c = t.base AND o.i <= t.m
  UNION ALL SELECT t.c, o.i - h + m, role, text FROM taken t JOIN own o ON o.c = t.c AND o.i > h
),
paths AS MATERIALIZED (
  SELECT c, d, text, list({'role': role, 'text': text}) OVER (PARTITION BY c ORDER BY d) AS path,
    max(d) OVER (PARTITION BY c) AS n FROM turns
  UNION ALL SELECT c, 0, '', [], 0 FROM taken WHERE m + greatest(n - h, 0) = 0
  UNION ALL SELECT c, 0, '', [], -1 FROM taken WHERE m + greatest(n - h, 0) > 0
),
nodes AS MATERIALIZED (
  SELECT min(c) AS conv_id, d, path, min(text) AS text, count(*) AS n_convs,
    string_agg(c, ',' ORDER BY c) FILTER (d = n) AS ends
  FROM paths GROUP BY d, path
),
named AS MATERIALIZED (SELECT p.c, p.d, x.conv_id FROM paths p JOIN nodes x ON x.d = p.d AND x.path = p.path),
tree AS MATERIALIZED (
  SELECT x.*, up.conv_id AS parent_conv_id FROM nodes x
  LEFT JOIN named up ON up.c = x.conv_id AND up.d = x.d - 1
),
kids AS (SELECT parent_conv_id AS conv_id, d - 1 AS d, count(*) AS n FROM tree WHERE d > 0 GROUP BY ALL),
full_ AS (
  SELECT tree.*, coalesce(kids.n, 0) AS n_children FROM tree LEFT JOIN kids USING (conv_id, d)
),
below AS (
  SELECT a.conv_id, a.d, sum((x.n_children = 0)::INT) AS n_leaves,
    sum((x.n_convs - 1) * length(x.text)) AS saved
  FROM full_ x JOIN named a ON a.c = x.conv_id AND a.d <= x.d GROUP BY ALL
)
SELECT conv_id, d AS depth, parent_conv_id, n_convs, n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
  CAST(saved AS BIGINT) AS saved_tokens, sha256(coalesce(ends, '')) AS ends_sha256
FROM full_ JOIN below USING (conv_id, d)
"""

OP13 = r"""
WITH d AS (SELECT doc_id, coalesce(lang, 'und') AS lang,
  regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]') AS pieces FROM documents WHERE text IS NOT NULL),
p AS (SELECT lang, regexp_extract_all(unnest(pieces), '[^\x20\x09]+') AS w FROM d),
grams AS (
  SELECT lang, k, unnest(list_transform(range(1, greatest(len(w) - k, -1) + 2),
    lambda s: array_to_string(w[s:s + k - 1], ' '))) AS phrase FROM p, range(1, 6) AS u(k)
),
f AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL),
frequent AS MATERIALIZED (SELECT * FROM f WHERE f >= 100),
total AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
cand AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM frequent WHERE k >= 2),
cuts AS (
  SELECT c.*, i, array_to_string(w[1:i], ' ') AS head, array_to_string(w[i + 1:], ' ') AS tail
  FROM cand c, unnest(range(1, k)) AS u(i)
),
scored AS (
  SELECT c.lang, c.phrase, c.k, a, i, h.f AS l, t.f AS r, n,
    CAST(1000::HUGEINT * a * n // (h.f::HUGEINT * t.f) AS BIGINT) AS score
  FROM cuts c JOIN frequent h ON h.lang = c.lang AND h.phrase = c.head
  JOIN frequent t ON t.lang = c.lang AND t.phrase = c.tail JOIN total ON total.lang = c.lang
),
least AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, i) = 1
),
inner_ AS (
  SELECT lang, array_to_string(w[s:s + m - 1], ' ') AS phrase, max(a) AS longer
  FROM cand, range(2, 5) AS u(m), unnest(range(1, greatest(k - m, -1) + 2)) AS v(s) WHERE m < k GROUP BY ALL
),
alone AS (
  SELECT b.* FROM least b LEFT JOIN inner_ USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 100 * a
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
  phrase, a, l, r, n, score
FROM alone QUALIFY rank <= 2000
"""

ORACLES = {
    "op4_decontaminate": OP4,
    "op6_chat_format": OP6,
    "op8_near_duplicates": OP8,
    "op11_prefix_trie": OP11,
    "op13_collocations": OP13,
}
