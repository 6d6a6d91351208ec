"""op2: documents without later repeated runs of lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from recolith.llm.op2_lines import dedup
from recolith.llm.runtime import table


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(table(spark, sf_dir, "documents").select("doc_id", "text"), counts=True)


SQL = r"""
WITH raw AS (SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents),
ln AS (SELECT doc_id, pos, trim(s, ' ' || chr(9) || chr(13) || chr(11) || chr(12)) AS s FROM (SELECT doc_id, unnest(l) AS s, unnest(range(len(l))) AS pos FROM raw)),
lw AS (SELECT doc_id, pos, s, len(regexp_extract_all(s, '[^ \t\r\x0B\f]+')) AS w FROM ln WHERE s <> ''),
c AS (SELECT *, sum(w) OVER (PARTITION BY doc_id ORDER BY pos) AS upto FROM lw),
win AS (
  SELECT a.doc_id, min(b.pos) AS lo, max(b.pos) AS hi, string_agg(b.s, chr(10) ORDER BY b.pos) AS g FROM c a JOIN c b ON a.doc_id = b.doc_id AND b.upto - b.w BETWEEN a.upto - a.w AND a.upto - a.w + 49 GROUP BY a.doc_id, a.pos HAVING sum(b.w) >= 50
  UNION SELECT a.doc_id, min(b.pos), max(b.pos), string_agg(b.s, chr(10) ORDER BY b.pos) FROM c a JOIN c b ON a.doc_id = b.doc_id AND b.upto BETWEEN a.upto - 49 AND a.upto GROUP BY a.doc_id, a.pos HAVING sum(b.w) >= 50
),
later AS (SELECT doc_id, lo, hi FROM (SELECT *, min({'d': doc_id, 'l': lo}) OVER (PARTITION BY g) AS f FROM win) WHERE {'d': doc_id, 'l': lo} > f),
gone AS (SELECT DISTINCT doc_id, unnest(range(lo, hi + 1)) AS pos FROM later),
g AS (SELECT doc_id, list(pos) AS p FROM gone GROUP BY doc_id)
SELECT doc_id, CASE WHEN p IS NULL THEN text ELSE array_to_string(list_filter(l, lambda x, i: NOT list_contains(p, i - 1)), chr(10)) END AS text,
  CASE WHEN coalesce(text, '') = '' THEN 0 ELSE len(l) END::BIGINT AS n_lines, coalesce(len(p), 0)::BIGINT AS n_deleted
FROM raw LEFT JOIN g USING (doc_id)
"""
