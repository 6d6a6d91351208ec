"""op1: SentencePiece digests of every document."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from recolith.llm.op1_sentencepiece import digests
from recolith.llm.runtime import table


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
