"""DuckDB SQL of the operators that SQL can express, over the same tables.

The others are tested against brute force in tests/llm: extraction by a trained
field (1), byte removal (2), bootstrapping (4), tiling (7), a trained network (8)
and tokenization (9, 11, 13)."""

from __future__ import annotations

_CONTROL = r"""\\|<s>|</s>|\[INST\]|\[/INST\]|\[SYS\]|\[/SYS\]|\[ROLE\]|\[:\]|\[/ROLE\]|<\|image\|>|<\|audio\|>|<\|document\|>"""


def _escaped(text: str) -> str:
    return f"length({text}) + len(regexp_extract_all({text}, '{_CONTROL}'))"


CHAT = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), ''))
    AS loss_sha256,
  CAST(3 + sum({_escaped('text')} + CASE role WHEN 'user' THEN 13 WHEN 'assistant' THEN 4 WHEN 'system' THEN 11
                                       ELSE 16 + {_escaped('role')} END) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id"""

NEAR = r"""
WITH RECURSIVE rows_ AS (
  SELECT row_number() OVER () AS rid, doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
    lambda w: w <> '') AS w
  FROM documents
),
sets AS (
  SELECT rid, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM rows_
),
items AS (SELECT rid, len(s) AS n, unnest(s) AS x FROM sets),
pairs AS (
  SELECT a.rid AS a, b.rid AS b, a.n AS na, b.n AS nb, count(*) AS i
  FROM items a JOIN items b ON a.x = b.x AND a.rid < b.rid GROUP BY ALL
),
links AS (
  SELECT a, b FROM pairs WHERE 100 * i >= 85 * (na + nb - i)
  UNION ALL SELECT b, a FROM pairs WHERE 100 * i >= 85 * (na + nb - i)
),
reach AS (
  SELECT rid, rid AS other FROM sets WHERE len(s) > 0
  UNION SELECT reach.rid, links.b FROM reach JOIN links ON reach.other = links.a
),
least AS (
  SELECT reach.rid, min(o.doc_id) AS component_id FROM reach JOIN sets o ON reach.other = o.rid GROUP BY reach.rid
)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles,
  CASE WHEN len(s) = 0 THEN doc_id ELSE component_id END AS component_id,
  coalesce(doc_id = CASE WHEN len(s) = 0 THEN doc_id ELSE component_id END, component_id IS NULL) AS kept
FROM sets LEFT JOIN least USING (rid)"""

TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
),
scored AS (
  SELECT q.vec_id AS query_id, x.vec_id, CAST(list_dot_product(q.e, x.e) AS BIGINT) AS score
  FROM v q JOIN v x ON q.vec_id % 50 = 0 AND q.vec_id <> x.vec_id
)
SELECT query_id, CAST(row_number() OVER best AS INTEGER) AS rank, vec_id, score FROM scored
WINDOW best AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER best <= 5"""

_VALUE = "[A-Za-z0-9+/_.=-]+"
_ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?""" + _VALUE
#: kind, pattern, whether a match passes
_SECRETS = (
    ("assign", _ASSIGN, r"""length(regexp_extract(h, '[:=]\x20*["'']?(""" + _VALUE + """)$', 1)) >= 6"""),
    ("access", "AKIA[A-Z0-9]+", "length(h) >= 20"),
    ("hex", "[0-9a-f]+", "length(h) >= 24"),
    ("pem", "-----BEGIN (?:[A-Z]{1,20} ){0,3}PRIVATE KEY-----", "true"),
)


def _found(rank: int, kind: str, pattern: str, passes: str) -> str:
    """Matches and the pieces between them; a match starts after all that is before it."""
    return f"""
  SELECT rid, {rank} AS rank, '{kind}' AS kind, s, s + length(h) AS e FROM (
    SELECT rid, h, CAST(list_sum(list_transform(p[1:i], lambda x: length(x))) AS BIGINT)
      + CAST(coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS s
    FROM (SELECT rid, m, p, unnest(range(1, len(m) + 1)) AS i, unnest(m) AS h FROM (
      SELECT rid, regexp_extract_all(t, '{pattern}') AS m, string_split_regex(t, '{pattern}') AS p FROM d))
    WHERE {passes})"""


SECRETS = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
f AS ({" UNION ALL ".join(_found(i, *row) for i, row in enumerate(_SECRETS))}
),
g AS (
  SELECT rid, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
    count(*) FILTER (kind = 'hex') AS n_hex,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) FILTER (kind <> 'pem') AS base,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) AS spans
  FROM f GROUP BY rid
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (rid)"""

SEARCH = r"""
WITH words_ AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents
),
size_ AS (SELECT count(*) FILTER (len(w) > 0) AS n, CAST(sum(len(w)) AS BIGINT) AS total FROM words_),
tf AS (SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(w) AS term FROM words_) GROUP BY rid, term),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * n + 2) / (2 * df + 1))) AS BIGINT) AS weight
  FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), size_
),
items AS (
  SELECT row_number() OVER () AS iid, item_id, list_distinct(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS w FROM benchmark
),
asked AS (SELECT iid, item_id, unnest(w) AS term FROM items),
scores AS (
  SELECT iid, item_id, rid, doc_id,
    CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * len(w) * n) // total)))) AS BIGINT) AS score
  FROM asked JOIN weights USING (term) JOIN tf USING (term) JOIN words_ USING (rid), size_
  GROUP BY iid, item_id, rid, doc_id
)
SELECT item_id, CAST(row_number() OVER best AS INTEGER) AS rank, doc_id, score FROM scores WHERE score > 0
WINDOW best AS (PARTITION BY iid ORDER BY score DESC, doc_id NULLS LAST)
QUALIFY row_number() OVER best <= 50"""

ORACLES = {
    "op3_chat_parts": CHAT,
    "op5_minhash_near_dedup": NEAR,
    "op6_voronoi_top_k": TOP_K,
    "op10_secret_ledger": SECRETS,
    "op12_ranked_search": SEARCH,
}
