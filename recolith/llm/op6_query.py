"""op6: all documents in eight shards of near equal bytes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recolith.llm.op6_shard import shard
from recolith.llm.runtime import table


def op6_histogram_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shard(table(spark, sf_dir, "documents"))
    crc = F.coalesce(F.crc32(F.encode("text", "UTF-8")), F.lit(0).cast("bigint"))
    return out.select("doc_id", "size", crc.alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
