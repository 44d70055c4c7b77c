"""The queries that SQL can express, as DuckDB SQL over the same tables.

Written apart from the Spark code: whole texts are split and joined by
plain window, list and join clauses, links are followed by a recursive query.
"""

from __future__ import annotations

#: Fixed by the contracts: words are cut at these characters.
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def source_divergence(least_documents: int = 10, most_terms: int = 10) -> str:
    terms = r"regexp_extract_all(coalesce(text, ''), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')"
    distance = "(p - q) * (p - q) // (p + q)"
    return f"""
WITH docs AS (
  SELECT row_number() OVER () AS row_no, coalesce(lang, '') AS lang, coalesce(source, '') AS source, {terms} AS terms FROM documents
),
spread AS (SELECT row_no, lang, source, {_LOWER.format('unnest(terms)')} AS term FROM docs),
kept AS (
  SELECT lang, term, count(*)::HUGEINT AS total FROM spread GROUP BY ALL HAVING count(DISTINCT row_no) >= {least_documents}
),
counts AS (
  SELECT s.lang, s.source, s.term, count(*)::HUGEINT AS n FROM spread s JOIN kept k USING (lang, term) GROUP BY ALL
),
lang_sums AS (
  SELECT l.lang, coalesce(sum(k.total), 0)::HUGEINT AS n, count(k.term)::HUGEINT AS v
  FROM (SELECT DISTINCT lang FROM docs) l LEFT JOIN kept k USING (lang) GROUP BY ALL
),
sums AS (
  SELECT g.lang, g.source, coalesce(sum(c.n), 0)::HUGEINT AS n
  FROM (SELECT DISTINCT lang, source FROM docs) g LEFT JOIN counts c USING (lang, source) GROUP BY ALL
),
priced AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         1 + 1000000000 * (coalesce(c.n, 0) + 2) // (g.n + 2 * l.v) AS p,
         1 + 1000000000 * (k.total + 2) // (l.n + 2 * l.v) AS lang_p
  FROM sums g JOIN lang_sums l USING (lang) JOIN kept k USING (lang) LEFT JOIN counts c USING (lang, source, term)
),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)), 0)::BIGINT AS value
  FROM sums a JOIN sums b ON b.lang = a.lang AND b.source <> a.source
  LEFT JOIN priced x ON x.lang = a.lang AND x.source = a.source
  LEFT JOIN priced y ON y.lang = a.lang AND y.source = b.source AND y.term = x.term
  GROUP BY ALL
),
apart AS (
  SELECT lang, source, term AS item, ({distance})::BIGINT AS value
  FROM (SELECT lang, source, term, n, p, lang_p AS q FROM priced) WHERE n > 0 AND p > q
),
ranked AS (
  SELECT lang, source, 'pair' AS part, item, value,
         row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INTEGER AS rank FROM pairs
  UNION ALL
  SELECT lang, source, 'term', item, value,
         row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INTEGER AS rank FROM apart
)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= {most_terms}"""


#: crc32 of a decimal id, a byte at a time, each byte in eight shifts.
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT)),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)), lambda x, i: xor(x // 2, 3988292384 * (x % 2)))))"""


def prefix_trie() -> str:
    return f"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS k
  FROM conversations WHERE conv_id IS NOT NULL
),
convs AS (
  SELECT conv_id, conv_id - ((conv_id % 5) + 5) % 5 AS base, ({_CRC}) % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM turns)
),
rebuilt AS (
  SELECT c.conv_id, t.k, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.base AND t.k <= c.h
  UNION ALL
  SELECT c.conv_id, t.k, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.k > c.h
),
paths AS (
  SELECT c.conv_id, coalesce(list(md5(strlen(r.role) || ':' || r.role || r.text) ORDER BY r.k) FILTER (WHERE r.k IS NOT NULL), []) AS path,
         coalesce(list(strlen(r.text) ORDER BY r.k) FILTER (WHERE r.k IS NOT NULL), []) AS sizes
  FROM convs c LEFT JOIN rebuilt r USING (conv_id) GROUP BY c.conv_id
),
steps AS (
  SELECT conv_id, d, len(path) AS n, array_to_string(path[1:d], ',') AS node,
         CASE WHEN d > 0 THEN array_to_string(path[1:d - 1], ',') END AS parent, CASE WHEN d > 0 THEN sizes[d] ELSE 0 END AS size
  FROM (SELECT *, unnest(range(len(path) + 1)) AS d FROM paths)
),
nodes AS (
  SELECT d, node, min(conv_id) AS conv_id, min(parent) AS parent, count(*) AS n_convs, min(size) AS size,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE n = d), '')) AS ends_sha256
  FROM steps GROUP BY d, node
),
families AS (SELECT d - 1 AS d, parent AS node, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL),
own AS (
  SELECT n.*, coalesce(f.n_children, 0) AS n_children FROM nodes n LEFT JOIN families f ON f.d = n.d AND f.node = n.node
),
subtrees AS (
  SELECT s.d, s.node, count(*) FILTER (WHERE o.n_children = 0) AS n_leaves, sum((o.n_convs - 1) * o.size)::BIGINT AS saved_tokens
  FROM own o JOIN steps s ON s.conv_id = o.conv_id AND s.d <= o.d GROUP BY ALL
)
SELECT o.conv_id, o.d AS depth, p.conv_id AS parent_conv_id, o.n_convs, o.n_children, t.n_leaves, t.saved_tokens, o.ends_sha256
FROM own o JOIN subtrees t ON t.d = o.d AND t.node = o.node
LEFT JOIN own p ON p.d = o.d - 1 AND p.node = o.parent"""


def _linked(percent: int, size: int = 5) -> str:
    """Shingle sets, links and components of documents at ``percent`` similarity."""
    run = " || ' ' || ".join(f"words[i{f' + {k}' if k else ''}]" for k in range(size))
    return f"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS row_no, doc_id, {_LOWER.format("coalesce(text, '')")} AS text FROM documents
),
cut AS (SELECT row_no, doc_id, {_WORDS} AS words FROM docs),
shingles AS (
  SELECT DISTINCT row_no, {run} AS shingle FROM (SELECT *, unnest(range(1, len(words) - {size - 2})) AS i FROM cut WHERE len(words) >= {size})
  UNION ALL
  SELECT row_no, array_to_string(words, ' ') FROM cut WHERE len(words) BETWEEN 1 AND {size - 1}
),
sizes AS (SELECT row_no, count(*) AS n FROM shingles GROUP BY 1),
shared AS (SELECT row_no, shingle FROM shingles WHERE shingle IN (SELECT shingle FROM shingles GROUP BY 1 HAVING count(*) > 1)),
pairs AS (
  SELECT a.row_no AS one, b.row_no AS other, count(*) AS common
  FROM shared a JOIN shared b ON a.shingle = b.shingle AND a.row_no < b.row_no GROUP BY ALL
),
links AS (
  SELECT one, other FROM pairs JOIN sizes x ON x.row_no = one JOIN sizes y ON y.row_no = other
  WHERE 100 * common >= {percent} * (x.n + y.n - common)
),
both_ways AS (SELECT one, other FROM links UNION ALL SELECT other, one FROM links),
reached AS (
  SELECT row_no, row_no AS other FROM docs
  UNION
  SELECT r.row_no, b.other FROM reached r JOIN both_ways b ON b.one = r.other
),
found AS (
  SELECT d.row_no, d.doc_id, coalesce(s.n, 0) AS n_shingles, c.component_id
  FROM docs d LEFT JOIN sizes s USING (row_no)
  JOIN (SELECT r.row_no, min(o.doc_id) AS component_id FROM reached r JOIN docs o ON o.row_no = r.other GROUP BY 1) c USING (row_no)
)"""


def near_duplicates() -> str:
    return _linked(75) + """
SELECT doc_id, n_shingles, component_id, doc_id IS NOT DISTINCT FROM component_id AS kept FROM found"""


def ngram_join() -> str:
    return _linked(80) + """
SELECT doc_id, n_shingles, component_id FROM found"""
