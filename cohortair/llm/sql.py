"""DuckDB text of the queries that SQL can express, each by brute force."""

from __future__ import annotations

from cohortair.llm.collocations import LEAST, TOP
from cohortair.llm.common import LOWER, UPPER
from cohortair.llm.decontaminate import WORD
from cohortair.llm.licenses import CONTAINMENT, PHRASES, TEMPLATES
from cohortair.llm.queries import SHARD_BYTES, WINDOW


def words(text: str) -> str:
    return f"regexp_extract_all(translate(coalesce({text}, ''), '{UPPER}', '{LOWER}'), '{WORD}')"


def contamination(length: int) -> str:
    """Every window of every item at every place of every document."""
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {words("text")} AS words FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item, {words("text")} AS words FROM benchmark),
w AS (
  SELECT DISTINCT item, list_slice(words, CAST(s AS BIGINT), CAST(s + least({length}, len(words)) - 1 AS BIGINT)) AS win
  FROM (SELECT item, words, unnest(range(1, greatest(len(words) - {length} + 1, 1) + 1)) AS s FROM i WHERE len(words) > 0)
),
sizes AS (SELECT DISTINCT len(win) AS n FROM w),
p AS (
  SELECT r, s, n, list_slice(words, CAST(s AS BIGINT), CAST(s + n - 1 AS BIGINT)) AS win
  FROM (SELECT r, words, n, unnest(range(1, len(words) - n + 2)) AS s FROM d, sizes WHERE len(words) >= n)
),
h AS (SELECT p.r, p.s, p.n, w.item FROM p JOIN w ON p.win = w.win),
c AS (
  SELECT r, count(DISTINCT k) AS n_hit
  FROM (SELECT r, unnest(range(s, s + n)) AS k FROM (SELECT DISTINCT r, s, n FROM h)) GROUP BY r
),
t AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM h GROUP BY r)
SELECT d.doc_id, CAST(len(d.words) AS BIGINT) AS n_words, coalesce(c.n_hit, 0) AS n_hit,
  coalesce(t.n_items, 0) AS n_items, sha256(coalesce(t.items, '')) AS items_sha256,
  coalesce(c.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c ON d.r = c.r LEFT JOIN t ON d.r = t.r"""


def licenses(containment: float) -> str:
    """Every phrase at every place, every template against every line."""
    phrases = ", ".join(f"('{p.label}', string_split('{p.text}', ' '))" for p in PHRASES)
    templates = ", ".join(f"('{t.label}', list_distinct(string_split('{t.text}', ' ')))" for t in TEMPLATES)
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, text, {words("text")} AS words FROM documents),
phrase(label, parts) AS (VALUES {phrases}),
notice(label, parts) AS (VALUES {templates}),
s AS (SELECT r, words, unnest(range(1, len(words) + 1)) AS k FROM d),
b AS (
  SELECT r, label, k - 1 AS start FROM s JOIN phrase
  ON words[k] = parts[1] AND list_slice(words, CAST(k AS BIGINT), CAST(k + len(parts) - 1 AS BIGINT)) = parts
),
base AS (
  SELECT r, count(*) AS n_base, min(start) AS first_word, max(start) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM b GROUP BY r
),
lines AS (
  SELECT DISTINCT r, list_distinct({words("line")}) AS found
  FROM (SELECT r, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM d)
),
m AS (
  SELECT r, label, len(list_intersect(found, parts)) / len(parts) AS score FROM lines, notice
  WHERE len(found) > 0 AND len(list_intersect(found, parts)) >= ceil({containment} * len(parts) - 1e-9)
),
more AS (
  SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
  FROM (SELECT r, label FROM b UNION SELECT r, label FROM m) GROUP BY r
),
best AS (SELECT r, max(score) AS score FROM m GROUP BY r)
SELECT d.doc_id, CAST(len(d.words) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base,
  first_word, last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
  CAST(CASE WHEN n_base > 0 THEN 1 ELSE coalesce(score, 0) END AS DOUBLE) AS score
FROM d LEFT JOIN base ON d.r = base.r LEFT JOIN more ON d.r = more.r LEFT JOIN best ON d.r = best.r"""


def shards(limit: int) -> str:
    """Every prefix of up to 40 bits, the shortest that fits."""
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, CAST(strlen(coalesce(text, '')) AS BIGINT) AS bytes,
    lpad(bin(CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT)), 60, '0') AS bits
  FROM documents
),
p AS (SELECT r, doc_id, bytes, deep, left(bits, deep) AS shard FROM (SELECT *, unnest(range(0, 41)) AS deep FROM d)),
f AS (
  SELECT deep, shard, CAST(sum(bytes) AS BIGINT) AS shard_bytes, count(*) AS shard_rows FROM p
  GROUP BY ALL HAVING sum(bytes) <= {limit} OR count(*) = 1
)
SELECT doc_id, shard, CAST(deep AS INTEGER) AS shard_bits, shard_bytes, shard_rows
FROM (
  SELECT p.r, p.doc_id, f.*, row_number() OVER (PARTITION BY p.r ORDER BY f.deep) AS k
  FROM p JOIN f ON p.deep = f.deep AND p.shard = f.shard
) WHERE k = 1"""


def collocations(least: int, top: int) -> str:
    """Every phrase of up to three words of every piece, every cut, every longer candidate."""
    return f"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang,
    regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\\x0A-\\x0D]') AS pieces
  FROM documents
),
p AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM (SELECT lang, unnest(pieces) AS piece FROM d)),
g AS (
  SELECT lang, array_to_string(w[i:i + k - 1], ' ') AS phrase
  FROM p, range(1, len(w) + 1) AS t(i), range(1, 4) AS s(k) WHERE i + k - 1 <= len(w)
),
c AS MATERIALIZED (SELECT lang, phrase, count(*) AS f, len(string_split(phrase, ' ')) AS words FROM g GROUP BY ALL),
n AS (SELECT lang, sum(f) AS n FROM c WHERE words = 1 GROUP BY lang),
cand AS (SELECT lang, phrase, words, f AS a, string_split(phrase, ' ') AS parts FROM c WHERE words >= 2 AND f >= {least}),
halves AS (
  SELECT lang, phrase, a, k, array_to_string(parts[1:k], ' ') AS left_part, array_to_string(parts[k + 1:], ' ') AS right_part
  FROM cand, range(1, 3) AS t(k) WHERE k < words
),
with_left AS MATERIALIZED (
  SELECT h.*, l.f AS l FROM halves h JOIN c AS l ON l.lang = h.lang AND l.phrase = h.left_part
),
cut AS (
  SELECT h.lang, h.phrase, a, k, l, r.f AS r, (CAST(a AS HUGEINT) * a * 1000000) // (CAST(l AS HUGEINT) * r.f) AS score
  FROM with_left h JOIN c AS r ON r.lang = h.lang AND r.phrase = h.right_part
),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS o FROM cut) WHERE o = 1),
inner_parts AS (
  SELECT lang, a AS outer_a, array_to_string(parts[1:words - 1], ' ') AS phrase FROM cand WHERE words >= 3
  UNION ALL
  SELECT lang, a AS outer_a, array_to_string(parts[2:], ' ') AS phrase FROM cand WHERE words >= 3
),
kept AS (
  SELECT * FROM best b WHERE NOT EXISTS (
    SELECT 1 FROM inner_parts o WHERE o.lang = b.lang AND o.phrase = b.phrase AND 100 * o.outer_a >= 50 * b.a
  )
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT ranked.lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l,
  CAST(r AS BIGINT) AS r, CAST(n.n AS BIGINT) AS n, CAST(score AS BIGINT) AS score, CAST(k AS BIGINT) AS k
FROM ranked JOIN n ON ranked.lang = n.lang WHERE rank <= {top}"""


ORACLES: dict[str, str] = {
    "op2_decontamination": contamination(WINDOW),
    "op3_licenses": licenses(CONTAINMENT),
    "op5_sharding": shards(SHARD_BYTES),
    "op13_collocations": collocations(LEAST, TOP),
}
