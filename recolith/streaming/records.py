"""Cleaning and candidate votes over a stream of reference records against static targets. Both are stateless maps
and a stream-static join, so there is no state and no watermark; ranking is done per micro-batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from recolith.functions.cleaning import clean_records
from recolith.operators.blocking import TOP_K, ranked


def clean_stream(records: DataFrame) -> DataFrame:
    return clean_records(records)


def rank_stream(records: DataFrame, targets: DataFrame, path: str, checkpoint: str, k: int = TOP_K) -> StreamingQuery:
    """Writes ranked candidates of each micro-batch under ``path``/batch=n; a batch that is run again overwrites its own."""
    cleaned = clean_records(targets)

    def run(batch: DataFrame, n: int) -> None:
        ranked(clean_records(batch), cleaned, k).write.mode("overwrite").parquet(f"{path}/batch={n}")

    return records.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
