"""op4: every document's ids, written to wavelet shards and read back."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from recolith.llm.op4_wavelet import read_documents, write
from recolith.llm.runtime import Scratch, table


def op4_wavelet_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark)
    path = scratch.path("wavelet")
    write(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    scratch.paths.append(path)
    return scratch.last(read_documents(spark, path, with_tokens=False), "read")
