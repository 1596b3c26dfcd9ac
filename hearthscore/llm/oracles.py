"""DuckDB SQL that checks the text queries SQL can express."""

ORACLE: dict[str, str] = {}

LOWER_AZ = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE["op9_exact_dedup"] = f"""
WITH d AS (
  SELECT doc_id, sha256({LOWER_AZ.format("coalesce(text, '')")}) AS text_sha256 FROM documents
), numbered AS (
  SELECT doc_id, text_sha256,
         max(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size,
         row_number() OVER (PARTITION BY text_sha256, doc_id) AS copy
  FROM d
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AND copy = 1 AS kept, text_sha256
FROM numbered
"""

# One row per part, order and step, from the masks of failed filters.
ORACLE["op13_filter_audit"] = """
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT *, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS words,
         min(doc_id) OVER (PARTITION BY text) AS first_id
  FROM d
), l AS (
  SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS bad FROM labels GROUP BY doc_id
), m AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(bad, 0) AS bad,
         (len(words) < 200)::INT
         + 2 * (100 * len(list_distinct(words)) < 50 * len(words))::INT
         + 4 * (100 * len(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text))::INT
         + 8 * regexp_matches(text, '[#$%&*|]')::INT
         + 16 * coalesce(first_id < w.doc_id, false)::INT AS mask
  FROM w LEFT JOIN l ON l.doc_id = w.doc_id
), cells AS (
  SELECT part, mask, count(*) AS n, sum(good) AS good, sum(bad) AS bad FROM m GROUP BY part, mask
), letters AS (
  SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS t(letter, bit)
), prefixes AS (
  SELECT '' AS prefix, 0 AS applied, 0 AS step, '' AS letter, 0 AS bit
  UNION ALL
  SELECT prefix || l.letter, applied | l.bit, step + 1, l.letter, l.bit
  FROM prefixes p JOIN letters l ON p.applied & l.bit = 0
), metrics AS (
  SELECT part, prefix, step, letter,
         sum(CASE WHEN mask & applied = 0 THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN mask & (applied - bit) = 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN mask & (applied - bit) <> 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN mask & (applied - bit) = 0 AND mask & bit <> 0 THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN mask & (applied - bit) = 0 AND mask & bit <> 0 THEN bad ELSE 0 END) AS toxic_lost
  FROM prefixes CROSS JOIN cells WHERE step > 0 GROUP BY part, prefix, step, letter
), walked AS (
  SELECT m.*, o.prefix AS filter_order
  FROM metrics m JOIN prefixes o ON o.step = 5 AND starts_with(o.prefix, m.prefix)
)
SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed,
       redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails,
       good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley
FROM walked
"""
