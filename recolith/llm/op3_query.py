"""op3: near duplicates among all embeddings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from recolith.llm.op3_embeddings import near_duplicates
from recolith.llm.runtime import table


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))


#: All pairs of a label by cosine, and reachability over them; for small tables.
SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
), u AS (
  SELECT vec_id, label, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS n FROM v
), l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE a.n > 0 AND b.n > 0 AND isfinite(a.n) AND isfinite(b.n) AND list_dot_product(a.e, b.e) / (a.n * b.n) >= 0.98
), r AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a
), c AS (SELECT a, min(b) AS root FROM r GROUP BY a)
SELECT c.a AS vec_id, (SELECT count(*) FROM l WHERE l.a = c.a)::BIGINT AS n_links, c.root AS component_id, c.a = c.root AS kept FROM c
"""
