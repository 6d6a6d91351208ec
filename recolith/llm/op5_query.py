"""op5: quality of every document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from recolith.llm.op5_quality import classify
from recolith.llm.runtime import table


def op5_weak_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
