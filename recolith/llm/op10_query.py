"""op10: benchmark passages in every document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from recolith.llm.op10_winnow import decontaminate
from recolith.llm.runtime import table


def op10_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


SQL = r"""
WITH dw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
iw AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, w[i:i + 9] AS g FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM iw WHERE len(w) > 0)),
lens AS (SELECT DISTINCT len(g) AS n FROM win),
dg AS (SELECT doc_id, i, n, w[i:i + n - 1] AS g FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw, lens WHERE len(w) >= n)),
hit AS (SELECT doc_id, i, n, item_id FROM dg JOIN win USING (g)),
hw AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
hi AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hit) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN hw USING (doc_id) LEFT JOIN hi USING (doc_id)
"""
