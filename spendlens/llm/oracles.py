"""Operators in DuckDB SQL, for those that SQL can express."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACED = r"regexp_split_to_array(translate(coalesce(text, ''), '{}', '{}'), '[\x20\x09-\x0D]+')".format(UPPER, LOWER)
ALNUM = (
    r"regexp_extract_all(translate(coalesce(text, ''), '{}', '{}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')".format(UPPER, LOWER)
)

EPSILON_GRID = """
WITH RECURSIVE u AS (
  SELECT vec_id, label, e, sqrt(list_dot_product(e, e)) AS n
  FROM (SELECT vec_id, label, [x::DOUBLE FOR x IN embedding] AS e FROM embeddings
        WHERE embedding IS NOT NULL AND label IS NOT NULL
          AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0)
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE a.n > 0 AND b.n > 0 AND list_dot_product(a.e, b.e) / (a.n * b.n) >= 0.93
), reach AS (
  SELECT vec_id AS id, vec_id AS root FROM embeddings
  UNION SELECT l.b, r.root FROM reach r JOIN links l ON r.id = l.a
), roots AS (SELECT id, min(root) AS component_id FROM reach GROUP BY id)
SELECT vec_id, (SELECT count(*) FROM links WHERE a = vec_id) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN roots ON id = vec_id
"""

_LINKED = """
{items}, sized AS (SELECT id, len(shingles) AS n FROM sets),
flat AS (SELECT id, unnest(shingles) AS shingle FROM sets),
links AS (
  SELECT a.id AS a, b.id AS b
  FROM (SELECT x.id AS a, y.id AS b, count(*) AS shared FROM flat x JOIN flat y USING (shingle) WHERE x.id < y.id GROUP BY ALL) p
  JOIN sized a ON a.id = p.a JOIN sized b ON b.id = p.b
  WHERE 100 * shared >= {percent} * (a.n + b.n - shared)
), both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT id, id AS root FROM sets
  UNION SELECT l.b, r.root FROM reach r JOIN both_ways l ON r.id = l.a
), roots AS (SELECT id, min(root) AS root FROM reach GROUP BY id)
"""
_SHINGLES = "list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, greatest(len(w) - 4, 1) + 1)])"

SUPERMINHASH = (
    "WITH RECURSIVE words AS (SELECT doc_id AS id, [x FOR x IN "
    + SPACED
    + " IF x <> ''] AS w FROM documents)"
    + _LINKED.format(
        items=f", sets AS (SELECT id, CASE WHEN len(w) = 0 THEN [] ELSE {_SHINGLES} END AS shingles FROM words)", percent=85
    )
    + """
SELECT id AS doc_id, n AS n_shingles, root AS component_id, root = id AS kept FROM sized JOIN roots USING (id)
"""
)

PARAGRAPHS = (
    "WITH RECURSIVE marked AS (SELECT doc_id, string_split("
    "regexp_replace(coalesce(text, ''), '([.!?]) ', '\\1' || chr(10), 'g'), chr(10)) AS cut FROM documents),"
    " lines AS (SELECT doc_id, unnest(cut) AS text, unnest(range(len(cut))) AS number FROM marked),"
    " words AS (SELECT doc_id * 1048576 + number AS id, doc_id, number, [x FOR x IN "
    + SPACED
    + " IF x <> ''] AS w FROM lines)"
    + _LINKED.format(items=f", sets AS (SELECT id, {_SHINGLES} AS shingles FROM words WHERE len(w) >= 20)", percent=80)
    + """,
gone AS (
  SELECT doc_id, count(*) AS n, string_agg(number::VARCHAR, ',' ORDER BY number) AS removed
  FROM roots JOIN words USING (id) WHERE root <> id GROUP BY doc_id
), counted AS (SELECT doc_id, count(*) FILTER (WHERE trim(text) <> '') AS n FROM lines GROUP BY doc_id)
SELECT doc_id, counted.n AS n_paragraphs, coalesce(gone.n, 0) AS n_removed, coalesce(removed, '') AS removed
FROM counted LEFT JOIN gone USING (doc_id)
"""
)

DECONTAMINATION = f"""
WITH item_words AS (SELECT item_id::VARCHAR AS item_id, {ALNUM} AS w FROM benchmark),
cut AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size, unnest([array_to_string(w[i:i + 9], ' ')
         FOR i IN range(1, greatest(len(w) - 9, 1) + 1)]) AS gram
  FROM item_words WHERE len(w) > 0
), doc_words AS (SELECT doc_id, {ALNUM} AS w FROM documents),
doc_grams AS (
  SELECT doc_id, size, unnest(range(1, len(w) - size + 2)) AS first,
         unnest([array_to_string(w[i:i + size - 1], ' ') FOR i IN range(1, len(w) - size + 2)]) AS gram
  FROM doc_words, (SELECT DISTINCT size FROM cut) WHERE len(w) >= size
), found AS (SELECT doc_id, item_id, first, size FROM doc_grams JOIN cut USING (size, gram)),
hit AS (SELECT doc_id, count(DISTINCT word) AS n_hit FROM (SELECT doc_id, unnest(range(first, first + size)) AS word FROM found) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
  FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""

PFAIR_MIX = """
WITH RECURSIVE sizes AS (SELECT coalesce(source, '') AS source, count(*) AS n, sqrt(count(*)) AS size FROM documents GROUP BY 1),
ranked AS (
  SELECT *, count(*) OVER () - row_number() OVER (ORDER BY size DESC, source) AS smaller,
    sum(size) OVER (ORDER BY size DESC, source ROWS UNBOUNDED PRECEDING) AS from_here,
    ceil(count(*) OVER () * 10 / 1000.0)::BIGINT * 1000 AS total
  FROM sizes
), free AS (SELECT *, (total - smaller) * size >= from_here AS free FROM ranked),
shares AS (
  SELECT source, n, total, free, CASE WHEN free
    THEN (total - count(*) FILTER (NOT free) OVER ()) * size / sum(size) FILTER (free) OVER () ELSE 1 END AS share
  FROM free
), parts AS (
  SELECT source, n, total, floor(share)::BIGINT
    + CASE WHEN row_number() OVER (ORDER BY free DESC, share - floor(share) DESC, source) <= total - sum(floor(share)) OVER () THEN 1 ELSE 0 END AS w
  FROM shares
), one AS (
  SELECT list(w ORDER BY source) AS ws, list(n ORDER BY source) AS ns, list(source ORDER BY source) AS ss, count(*) AS k,
    max(total) AS p FROM parts
), slots AS (
  SELECT 0::BIGINT AS t, [0::BIGINT FOR w IN ws] AS taken,
    list_min([(p + ws[i] - 1) // ws[i] * 100000 + i FOR i IN range(1, k + 1)]) % 100000 AS pick
  FROM one
  UNION ALL
  SELECT t + 1, had,
    list_min([((had[i] + 1) * p + ws[i] - 1) // ws[i] * 100000 + i FOR i IN range(1, k + 1) IF had[i] * p // ws[i] <= t + 1]) % 100000
  FROM (SELECT t, p, ws, k, [taken[j] + CASE WHEN j = pick THEN 1 ELSE 0 END FOR j IN range(1, len(taken) + 1)] AS had
        FROM slots, one WHERE t < p - 1)
), pattern AS (SELECT t, ss[pick] AS source, taken[pick] AS nth, taken FROM slots, one),
numbered AS (
  SELECT doc_id, coalesce(source, '') AS source,
    row_number() OVER (PARTITION BY coalesce(source, '') ORDER BY md5(doc_id::VARCHAR), doc_id) - 1 AS nth
  FROM documents
), placed AS (
  SELECT doc_id, d.source, d.nth // 64 AS block, d.nth % 64 AS place, w, d.nth // 64 // w AS cycle, t, taken
  FROM numbered d JOIN parts USING (source) JOIN pattern p ON p.source = d.source AND p.nth = d.nth // 64 % w
), horizon AS (
  SELECT min((n + 63) // 64 // w * total + t) AS h FROM parts p JOIN pattern USING (source) WHERE nth = (n + 63) // 64 % w
)
SELECT doc_id, source, block, place::INT AS place, cycle * p + t AS slot,
  list_sum([least(ns[j], 64 * (cycle * ws[j] + taken[j])) FOR j IN range(1, k + 1)])::BIGINT + place AS position,
  block * p // w AS release, ((block + 1) * p + w - 1) // w AS deadline, cycle * p + t < h AS in_balance
FROM placed, one, horizon
"""

ORACLES: dict[str, str] = {
    "op1_epsilon_grid": EPSILON_GRID,
    "op2_pfair_mix": PFAIR_MIX,
    "op4_superminhash": SUPERMINHASH,
    "op5_decontamination": DECONTAMINATION,
    "op10_paragraphs": PARAGRAPHS,
}
