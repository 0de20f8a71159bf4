"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

#: The checksum of a word's bytes, by the usual table of 256 remainders.
_CHECKSUMS = """
remainders AS (
  SELECT list_transform(range(256), lambda n: list_reduce(range(8),
    lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n)) AS rem),
spelled AS (SELECT word, hex(encode(word)) AS digits FROM (SELECT DISTINCT word FROM all_words)),
coded AS (
  SELECT word, xor(list_reduce(
    list_transform(range(len(digits) // 2),
                   lambda i: CAST('0x' || substr(digits, 2 * i + 1, 2) AS BIGINT)),
    lambda c, b: xor(c >> 8, rem[1 + (xor(c, b) & 255)]), 4294967295), 4294967295) % 10000 AS bucket
  FROM spelled, remainders)"""

_WORDS = (
    r"unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
    r"'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'))"
)

_RESAMPLE = rf"""WITH
doc_words AS (SELECT doc_id, {_WORDS} AS word FROM documents),
target_words AS (SELECT {_WORDS} AS word FROM benchmark),
all_words AS (SELECT word FROM doc_words UNION ALL SELECT word FROM target_words),{_CHECKSUMS},
s AS (SELECT bucket, count(*) AS s FROM doc_words JOIN coded USING (word) GROUP BY ALL),
t AS (SELECT bucket, count(*) AS t FROM target_words JOIN coded USING (word) GROUP BY ALL),
sums AS (SELECT (SELECT count(*) FROM doc_words) AS all_s, (SELECT count(*) FROM target_words) AS all_t),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln(CAST((coalesce(t, 0) + 1) * (all_s + 10000) AS DOUBLE)
                                      / ((s + 1) * (all_t + 10000)))) AS BIGINT) AS gain
  FROM s LEFT JOIN t USING (bucket), sums),
weights AS (
  SELECT doc_id, count(*) AS n_features, CAST(sum(gain) AS BIGINT) AS weight
  FROM doc_words JOIN coded USING (word) JOIN gains USING (bucket) GROUP BY doc_id),
scored AS (
  SELECT d.doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln(
           (CAST('0x' || substr(sha256('2024:' || d.doc_id), 1, 8) AS BIGINT) + 0.5) / 4294967296.0
         ))) AS BIGINT) AS score
  FROM documents d LEFT JOIN weights USING (doc_id)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place,
         count(*) OVER (PARTITION BY n_features >= 20) AS n
  FROM scored)
SELECT doc_id, n_features, weight, score,
       CASE WHEN n_features >= 20 AND place <= 10 * n // 100 THEN place END AS rank
FROM placed"""

_NEGATIVES = """WITH
usable AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT a.id AS anchor_id, b.id AS other, a.label = b.label AS alike,
         CAST(list_sum(list_transform(range(1, len(a.x) + 1), lambda i: a.x[i] * b.x[i])) AS BIGINT) AS score
  FROM usable a JOIN usable b ON a.id <> b.id WHERE a.id % 100 = 0),
positives AS (
  SELECT * FROM scores WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT p.anchor_id, p.other AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.other ORDER BY n.score DESC, n.other) AS INTEGER) AS rank,
       n.other AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scores n ON n.anchor_id = p.anchor_id AND NOT n.alike
  AND 80 * p.score <= 100 * n.score AND n.score <= p.score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.other ORDER BY n.score DESC, n.other) <= 5"""

ORACLE: dict[str, str] = {"op11_hard_negatives": _NEGATIVES, "op13_resample": _RESAMPLE}
