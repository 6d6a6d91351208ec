"""op9: personal data in every document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from recolith.llm.op9_pii import detect
from recolith.llm.runtime import table


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect(table(spark, sf_dir, "documents"))
