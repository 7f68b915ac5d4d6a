"""DuckDB SQL of the queries that SQL can state."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _terms(text: str) -> str:
    return (f"regexp_extract_all(translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}'), "
            r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")


LEXICAL_SEARCH = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_terms('text')} AS terms FROM documents),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM d) GROUP BY ALL),
doc AS (SELECT r, doc_id, CAST(len(terms) AS BIGINT) AS n FROM d WHERE len(terms) > 0),
total AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM doc),
w AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
      FROM tf, total GROUP BY term),
norm AS (SELECT r, doc_id, 75 + (25 * n * n_docs) // n_terms AS m FROM doc, total),
q AS (SELECT i, item_id, term, count(*) AS times
      FROM (SELECT row_number() OVER () AS i, item_id, unnest({_terms('text')}) AS term FROM benchmark) GROUP BY ALL),
s AS (SELECT i, item_id, r, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
      FROM q JOIN w USING (term) JOIN tf USING (term) JOIN norm USING (r) GROUP BY ALL),
ranked AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score
           FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""

HARD_NEGATIVES = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS vector
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id AS other_id,
             CAST(list_inner_product(a.vector, b.vector) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
n AS (SELECT p.*, other_id AS negative_id, score AS negative_score,
             CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank
      FROM p JOIN s USING (anchor_id)
      WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""

_RULES = {"few_words": "n_words < 50", "repeats": "100 * n_repeat_words > 50 * n_words", "symbols": "10 * n_symbols > n_words",
          "dup_lines": "10 * n_dup_lines > 3 * n_lines", "word_length": "word_chars < 2 * n_words OR word_chars > 12 * n_words"}

QUALITY_RULES = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM documents),
words AS (SELECT r, doc_id, source, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM d),
word AS (SELECT r, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM words),
win AS (SELECT r, i, w AS a, lead(w) OVER q AS b, lead(w, 2) OVER q AS c FROM word WINDOW q AS (PARTITION BY r ORDER BY i)),
again AS (SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS n FROM win WHERE c IS NOT NULL),
covered AS (SELECT DISTINCT r, unnest([i, i + 1, i + 2]) AS i FROM again WHERE n > 1),
reps AS (SELECT r, count(*) AS n_repeat_words FROM covered GROUP BY r),
line AS (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d),
lines AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
          FROM line WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
m AS (SELECT words.r, doc_id, source, CAST(len(words) AS BIGINT) AS n_words,
             CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
      FROM words LEFT JOIN reps USING (r) LEFT JOIN lines USING (r)),
f AS (SELECT source, unnest([RULES]) AS failed, unnest([NAMES]) AS rule FROM m WHERE source IS NOT NULL),
h AS (SELECT source, rule, CAST(count(*) AS DOUBLE) AS n, CAST(count(*) FILTER (failed) AS DOUBLE) AS k FROM f GROUP BY ALL),
t AS (SELECT rule, count(*) AS hosts, sum(n) AS n, sum(k) / sum(n) AS mean, sum(n * n) AS n2, sum(k * k / n) AS q FROM h GROUP BY rule),
p AS (SELECT rule, mean, CASE WHEN mean > 0 AND mean < 1 AND hosts > 1 AND n - n2 / n - (hosts - 1) > 0
        THEN least(greatest(((q - n * mean * mean) / (mean * (1 - mean)) - (hosts - 1)) / (n - n2 / n - (hosts - 1)), 1e-6), 1 - 1e-6)
        ELSE 0.01 END AS rho FROM t),
bad AS (SELECT DISTINCT source FROM h JOIN p USING (rule) WHERE (k + mean * (1 / rho - 1)) / (n + (1 / rho - 1)) > 0.5),
v AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT coalesce(source IN (SELECT source FROM bad), false) AS kept FROM v
""".replace("RULES", ", ".join(_RULES.values())).replace("NAMES", ", ".join(f"'{r}'" for r in _RULES))

DECONTAMINATION = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_terms('text')} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_terms('text')} AS w FROM benchmark),
item AS (SELECT DISTINCT item, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS span
         FROM (SELECT item, w, least(len(w), 13) AS n, unnest(generate_series(1, greatest(len(w) - 12, 1))) AS i FROM b WHERE len(w) > 0)),
span AS (SELECT r, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS span
         FROM (SELECT r, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d, (SELECT DISTINCT n FROM item) WHERE len(w) >= n)),
hit AS (SELECT r, i, n, item FROM span JOIN item USING (n, span)),
covered AS (SELECT r, count(DISTINCT p) AS n_hit
            FROM (SELECT r, unnest(generate_series(i, i + n - 1)) AS p FROM (SELECT DISTINCT r, i, n FROM hit)) GROUP BY r),
named AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items
          FROM hit WHERE item IS NOT NULL GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN covered USING (r) LEFT JOIN named USING (r)
"""
