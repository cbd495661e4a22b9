"""SQL for the operators' queries that SQL can express, for an independent engine."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

_WORDS = r"""list_filter(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')"""

ORACLE["op2_winnowing"] = rf"""
WITH item AS (SELECT item_id, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
win AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS t
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item WHERE len(w) > 0)
),
doc AS (SELECT doc_id, {_WORDS} AS w FROM documents),
place AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM doc),
hit AS (
  SELECT doc_id, item_id, i, win.n FROM place
  JOIN (SELECT DISTINCT n FROM win) l ON i + l.n - 1 <= len(w)
  JOIN win ON win.n = l.n AND win.t = array_to_string(w[i:i + l.n - 1], ' ')
),
words AS (
  SELECT doc_id, count(DISTINCT i + j) AS n_hit
  FROM (SELECT doc_id, i, unnest(range(0, n)) AS j FROM hit) GROUP BY doc_id
),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM hit) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

# Each kind: name, place in the order, part, pattern, group, certain from, weak from.
_KINDS = [
    ("assign", 0, "secret", r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']? *[:=] *["'']?([A-Za-z0-9+/_.=-]+)""", 2, 12, 4),
    ("access", 1, "identifier", "AKIA[A-Z0-9]+", 0, 18, 12),
    ("hex", 2, "secret", "[0-9a-f]+", 0, 16, 1 << 30),
    ("user", 3, "identifier", r"""([Uu][Ss][Ee][Rr]_?[Nn][Aa][Mm][Ee]|[Uu][Ss][Ee][Rr]_?[Ii][Dd]|[Uu][Ss][Ee][Rr]|[Ll][Oo][Gg][Ii][Nn]|[Aa][Cc][Cc][Oo][Uu][Nn][Tt]|[Cc][Ll][Ii][Ee][Nn][Tt]_?[Ii][Dd])["'']? *[:=] *["'']?([A-Za-z0-9._@+-]+)""", 2, 1 << 30, 3),
    ("endpoint", 4, "endpoint", r"""([Hh][Tt][Tt][Pp][Ss]?|[Ff][Tt][Pp]|[Ss][Ss][Hh]|[Aa][Mm][Qq][Pp]|[Rr][Ee][Dd][Ii][Ss]|[Mm][Yy][Ss][Qq][Ll]|[Pp][Oo][Ss][Tt][Gg][Rr][Ee][Ss]|[Mm][Oo][Nn][Gg][Oo][Dd][Bb]|[Ss]3)://[^\x00-\x20"''<>]+""", 0, 1 << 30, 10),
]

_FOUND = "\nUNION ALL\n".join(
    f"""SELECT doc_id, '{name}' AS kind, {place} AS place, '{part}' AS part, {sure} AS sure, {weak} AS weak,
  string_split_regex(coalesce(text, ''), '{pattern}') AS gaps,
  regexp_extract_all(coalesce(text, ''), '{pattern}', 0) AS hits,
  regexp_extract_all(coalesce(text, ''), '{pattern}', {group}) AS vals FROM documents"""
    for name, place, part, pattern, group, sure, weak in _KINDS
)

ORACLE["op3_credential_links"] = rf"""
WITH found AS ({_FOUND}),
each AS (
  SELECT *, list_sum(list_transform(gaps[1:i], lambda x: length(x)))
    + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0) AS s
  FROM (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM found)
  WHERE length(vals[i]) >= least(sure, weak)
),
cand AS (
  SELECT doc_id, kind, place, part, s::BIGINT AS s, (s + length(hits[i]))::BIGINT AS e, length(vals[i]) >= sure AS ok
  FROM each
),
near AS (
  SELECT c.*, ok
    OR (part = 'identifier' AND EXISTS (FROM cand x WHERE x.doc_id = c.doc_id AND x.part = 'secret' AND x.s <= c.e + 200 AND x.e >= c.s - 200))
    OR (part = 'secret' AND EXISTS (FROM cand x WHERE x.doc_id = c.doc_id AND x.part IN ('identifier', 'endpoint') AND x.s <= c.e + 200 AND x.e >= c.s - 200))
    OR (part = 'endpoint' AND EXISTS (FROM cand x WHERE x.doc_id = c.doc_id AND x.part = 'secret' AND x.s <= c.e + 200 AND x.e >= c.s - 200)
      AND EXISTS (FROM cand x WHERE x.doc_id = c.doc_id AND x.part = 'identifier' AND x.s <= c.e + 200 AND x.e >= c.s - 200)) AS told
  FROM cand c
),
listed AS (
  SELECT doc_id, count(*) FILTER (ok AND kind = 'assign') AS n_assign,
    count(*) FILTER (ok AND kind = 'access') AS n_access, count(*) FILTER (ok AND kind = 'hex') AS n_hex,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, place) FILTER (ok) AS base,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, place) FILTER (told) AS spans
  FROM near GROUP BY doc_id
)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
  coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents LEFT JOIN listed USING (doc_id)
"""

ORACLE["op9_segment_bounds"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024.0::DOUBLE * x::DOUBLE)::HUGEINT) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT a.vec_id AS query_id, b.vec_id,
    list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i]))::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q) WHERE a.vec_id % 100 = 0
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 10
"""

ORACLE["op13_stripes"] = r"""
WITH piece AS (
  SELECT lang, list_filter(string_split_regex(p, '[\x20\x09]+'), lambda w: w <> '') AS w
  FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p
    FROM documents
  )
),
total AS (SELECT lang, sum(len(w))::BIGINT AS n FROM piece GROUP BY lang),
every AS (
  SELECT lang, k, phrase, count(*) AS f
  FROM (
    SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
    FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i
      FROM (SELECT *, unnest(range(1, 6)) AS k FROM piece) WHERE len(w) >= k)
  ) GROUP BY lang, k, phrase HAVING count(*) >= 100
),
cut AS (
  SELECT lang, phrase, f, w, unnest(range(1, k)) AS c
  FROM (SELECT *, string_split(phrase, ' ') AS w FROM every WHERE k > 1)
),
scored AS (
  SELECT cut.lang, cut.phrase, cut.f AS a, x.f AS l, y.f AS r, n, c,
    (1000::HUGEINT * cut.f * n) // (x.f::HUGEINT * y.f) AS score
  FROM cut JOIN every x ON x.lang = cut.lang AND x.phrase = array_to_string(w[1:c], ' ')
  JOIN every y ON y.lang = cut.lang AND y.phrase = array_to_string(w[c + 1:], ' ')
  JOIN total ON total.lang = cut.lang
),
lowest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) AS nth FROM scored) WHERE nth = 1
),
kept AS (
  SELECT * FROM lowest s WHERE NOT EXISTS (
    FROM every e WHERE e.lang = s.lang AND e.f >= s.a AND len(e.phrase) > len(s.phrase)
      AND contains(' ' || e.phrase || ' ', ' ' || s.phrase || ' ')
  )
)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
WHERE rank <= 2000
"""
