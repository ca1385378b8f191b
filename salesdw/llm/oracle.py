"""The same results in DuckDB SQL, where SQL can express them on whole tables."""

from __future__ import annotations

# Words are runs of anything but the six white-space characters; regexp_split keeps an empty first or last part.
HOST_QUALITY = r"""
WITH base AS (
  SELECT row_number() OVER () AS row_id, doc_id, source, coalesce(text, '') AS t FROM documents
), words AS (
  SELECT row_id, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM base
), windows AS (
  SELECT row_id, i, array_to_string(w[i:i + 7], ' ') AS win
  FROM words, unnest(range(1, len(w) - 6)) AS r(i)
), twice AS (
  SELECT row_id, i FROM (SELECT row_id, i, count(*) OVER (PARTITION BY row_id, win) AS n FROM windows) WHERE n > 1
), gaps AS (
  SELECT row_id, least(8, coalesce(lead(i) OVER (PARTITION BY row_id ORDER BY i) - i, 8)) AS own FROM twice
), repeats AS (
  SELECT row_id, sum(own) AS n FROM gaps GROUP BY row_id
), measured AS (
  SELECT doc_id, source, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
  FROM base JOIN words USING (row_id) LEFT JOIN repeats USING (row_id)
), judged AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
         n_symbols > 0.1 * greatest(n_words, 1) AS f1,
         n_dup_lines > 0.02 * greatest(n_words, 1) AS f2,
         word_chars / greatest(n_words, 1) < 2.5 OR word_chars / greatest(n_words, 1) > 12.0 AS f3
  FROM measured
), hosts AS (
  SELECT source, count(*) AS n, sum((n_words < 20)::INT) AS k1, sum((100 * n_repeat_words > 30 * n_words)::INT) AS k2,
         sum(f1::INT) AS k3, sum(f2::INT) AS k4, sum(f3::INT) AS k5
  FROM judged GROUP BY source
), rates AS (
  SELECT source, n, unnest([k1, k2, k3, k4, k5]) AS k, unnest([1, 2, 3, 4, 5]) AS rule FROM hosts
), moments AS (
  SELECT rule, avg(k / n) AS m, var_pop(k / n) - avg(k / n) * (1 - avg(k / n)) * avg(1 / n) AS v FROM rates GROUP BY rule
), shrunken AS (
  SELECT source, rule, CASE WHEN v <= 0 THEN m ELSE (k + m * (m * (1 - m) / v - 1)) / (n + m * (1 - m) / v - 1) END AS rate
  FROM rates JOIN moments USING (rule)
), verdicts AS (
  SELECT source, max(rate) > 0.5 AS bad, bool_or(rule = 3 AND rate > 0.25) AS b1, bool_or(rule = 4 AND rate > 0.25) AS b2,
         bool_or(rule = 5 AND rate > 0.25) AS b3
  FROM shrunken GROUP BY source
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT (bad OR (b1 AND f1) OR (b2 AND f2) OR (b3 AND f3)) AS kept
FROM judged JOIN verdicts ON judged.source IS NOT DISTINCT FROM verdicts.source
"""


def llm_sql() -> dict[str, str]:
    return {"op4_host_quality_rules": HOST_QUALITY}
