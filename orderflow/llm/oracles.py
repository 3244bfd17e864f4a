"""The SQL (DuckDB) of the queries that SQL can express."""

from __future__ import annotations

from orderflow.llm import licenses

_WORDS = (
    "regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
    r" '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)


def _list(words: list[str]) -> str:
    return "[" + ", ".join(f"'{word}'" for word in words) + "]"


def _at(phrase: str) -> str:
    tests = " AND ".join(f"words[i + {n + 1}] = '{word}'" for n, word in enumerate(phrase.split()))
    return f"list_filter(range(len(words)), lambda i: {tests})"


def _notice(label: str, text: str, pattern: str) -> str:
    words = licenses._split(text)
    distinct = sorted(set(words))
    need = licenses._needed(distinct, licenses.THRESHOLD)
    return f"('{label}', {_list(distinct)}, {need}, {licenses.width_of(words, licenses.THRESHOLD)}, '{pattern}')"


_NOTICES = ",\n  ".join(_notice(*notice) for notice in licenses.NOTICES)
_PHRASES = list(licenses.PHRASES.items())

LICENSES = f"""
WITH t AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT rid, doc_id, {_WORDS.format("text")} AS words FROM t),
p AS (SELECT rid, doc_id, words, {", ".join(f"{_at(phrase)} AS at{n}" for n, (phrase, _) in enumerate(_PHRASES))} FROM w),
b AS (
  SELECT rid, doc_id, words, {" || ".join(f"at{n}" for n in range(len(_PHRASES)))} AS places,
    list_sort(list_filter([{", ".join(f"CASE WHEN len(at{n}) > 0 THEN '{label}' END" for n, (_, label) in enumerate(_PHRASES))}],
      lambda x: x IS NOT NULL)) AS base
  FROM p),
notices(label, tokens, need, width, pattern) AS (VALUES {_NOTICES}),
-- A pattern that no text shows, no window of it does.
shown AS (SELECT * FROM w JOIN notices ON regexp_matches(' ' || array_to_string(words, ' ') || ' ', pattern)),
windows AS (
  SELECT rid, label, tokens, need, pattern, words[start + 1 : start + width] AS window_words
  FROM (SELECT *, unnest(range(greatest(len(words) - width + 1, 1))) AS start FROM shown)),
shares AS (
  SELECT rid, label, need, len(tokens) AS n, len(list_intersect(list_distinct(window_words), tokens)) AS shared FROM windows
  WHERE regexp_matches(' ' || array_to_string(window_words, ' ') || ' ', pattern)),
hits AS (SELECT rid, label, shared / n AS share FROM shares WHERE shared >= need),
own AS (SELECT rid, list(DISTINCT label) AS own, max(share) AS best FROM hits GROUP BY rid)
SELECT doc_id, len(words) AS n_words, len(places) AS n_base, list_min(places) AS first_word, list_max(places) AS last_word,
  array_to_string(base, ',') AS base_labels,
  array_to_string(list_sort(list_distinct(base || coalesce(own, []))), ',') AS labels,
  CASE WHEN len(base) > 0 THEN 1.0::DOUBLE ELSE coalesce(best, 0.0)::DOUBLE END AS score
FROM b LEFT JOIN own USING (rid)
"""

TOPK = """
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM usable q JOIN usable c ON c.vec_id <> q.vec_id WHERE q.vec_id % 20 = 0),
ranked AS (
  SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""

JACCARD = r"""
WITH RECURSIVE t AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS body FROM documents),
w AS (SELECT rid, doc_id, body, regexp_extract_all(lower(body), '[\p{L}\p{N}_]+') AS words FROM t),
s AS (
  SELECT rid, doc_id, len(words) = 0 AS bare, list_sort(list_distinct(
    CASE WHEN len(words) = 0 THEN [body] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
      ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) END)) AS grams
  FROM w),
c AS (SELECT grams, bare, min(doc_id) AS copy_id, count(*) AS n_copies, row_number() OVER () AS cls FROM s GROUP BY grams, bare),
g AS (SELECT cls, len(grams) AS n, unnest(grams) AS gram FROM c WHERE NOT bare),
links AS (
  SELECT a.cls AS x, b.cls AS y FROM g a JOIN g b ON a.gram = b.gram AND a.cls <> b.cls
  GROUP BY a.cls, b.cls, a.n, b.n HAVING count(*) >= 0.8 * (a.n + b.n - count(*)) - 1e-9),
reach(x, y) AS (SELECT cls, cls FROM c UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
least AS (SELECT x AS cls, min(copy_id) AS class_id FROM reach JOIN c ON c.cls = y GROUP BY x),
counts AS (SELECT x AS cls, count(*) AS n_links FROM links GROUP BY x)
SELECT doc_id, class_id, copy_id, n_copies, coalesce(n_links, 0) AS n_links, doc_id = class_id AS stays
FROM s JOIN c USING (grams, bare) JOIN least USING (cls) LEFT JOIN counts USING (cls)
"""
