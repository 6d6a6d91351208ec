"""op7: stupid-backoff score of every document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recolith.llm.op7_backoff import backoff_scores
from recolith.llm.runtime import table


def op7_stupid_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = backoff_scores(table(spark, sf_dir, "documents"))
    per_word = F.when(F.col("n_words") > 0, F.col("log_score") / F.col("n_words")).otherwise(F.lit(0.0))
    return out.select("doc_id", "n_words", F.round(per_word, 6).alias("log_score_per_word"))


SQL = r"""
WITH w AS (
  SELECT doc_id, unnest(l) AS w, generate_subscripts(l, 1) AS i FROM (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS l FROM documents)
), g AS (
  SELECT doc_id, i, w AS c, lag(w) OVER o AS b, lag(w, 2) OVER o AS a FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY i)
), n AS (
  SELECT doc_id, i, a, b, c, count(*) OVER () - count(*) OVER (PARTITION BY doc_id) AS words,
    count(*) OVER (PARTITION BY c) - count(*) OVER (PARTITION BY doc_id, c) AS n1,
    count(*) OVER (PARTITION BY b, c) - count(*) OVER (PARTITION BY doc_id, b, c) AS n2,
    count(*) OVER (PARTITION BY a, b, c) - count(*) OVER (PARTITION BY doc_id, a, b, c) AS n3
  FROM g
), x AS (
  SELECT *, lag(n1) OVER o AS m1, lag(n2) OVER o AS m2 FROM n WINDOW o AS (PARTITION BY doc_id ORDER BY i)
), s1 AS (
  SELECT *, CASE WHEN n1 > 0 THEN n1 / words ELSE 1 / (2.0 * (words + 1)) END::DOUBLE AS s FROM x
), s2 AS (
  SELECT * REPLACE (CASE WHEN b IS NULL THEN s WHEN n2 > 0 THEN n2 / m1 ELSE 0.4::DOUBLE * s END::DOUBLE AS s) FROM s1
), s3 AS (
  SELECT * REPLACE (CASE WHEN a IS NULL THEN s WHEN n3 > 0 THEN n3 / m2 ELSE 0.4::DOUBLE * s END::DOUBLE AS s) FROM s2
), t AS (SELECT doc_id, count(*) AS n_words, sum(ln(s)) AS total FROM s3 GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_words, 0)::BIGINT AS n_words, round(coalesce(total / n_words, 0), 6) AS log_score_per_word
FROM documents d LEFT JOIN t USING (doc_id)
"""
