"""The queries of this subpackage in DuckDB SQL, where SQL can express them."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_EXACT = f"""
WITH rows AS (
  SELECT doc_id, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS norm FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(norm) AS text_sha256
FROM rows WINDOW same AS (PARTITION BY norm)"""

# Filling the sources in the order of their limit to their weight: a source is full as long
# as its part of what is left reaches its limit; the first that is not full sets the part
# that a weight of 1 gets.
_MIXING = r"""
WITH rows AS (
  SELECT doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5('mix:' || coalesce(doc_id || ':', '') || coalesce(text, '')) AS key
  FROM documents),
sizes AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM rows GROUP BY source),
weighted AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS place,
         CAST([3, 1, 2][(place - 1) % 3 + 1] AS DOUBLE) AS weight,
         source_size * 2.0::DOUBLE AS most, 1.5::DOUBLE * sum(source_size) OVER () AS total
  FROM sizes),
filled AS (
  SELECT *, (total - coalesce(sum(most) OVER before, 0))
            / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS each_weight
  FROM weighted
  WINDOW before AS (ORDER BY most / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
first_open AS (
  SELECT each_weight AS part FROM filled WHERE most > each_weight * weight
  ORDER BY most / weight, place LIMIT 1),
targets AS (
  SELECT source, source_size,
         coalesce(least(weight * (SELECT part FROM first_open), most), most) AS target
  FROM filled),
placed AS (
  SELECT r.*, source_size, target, CAST(round(target) AS BIGINT) AS budget,
         CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS epochs,
         budget - epochs * source_size AS rest,
         sum(size) OVER (PARTITION BY r.source ORDER BY key
                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS before
  FROM rows r JOIN targets t ON r.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(epochs * size + greatest(0, least(size, rest - before)) AS BIGINT) AS taken
FROM placed"""

ORACLE_SQL = {
    "op2_exact_dedup": _EXACT,
    "op3_mixing": _MIXING,
}
