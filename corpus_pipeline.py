"""Corpus pipeline: the stages are applied in order, each to the rows that the one before kept.

Quality drops poor and toxic documents; line dedup cuts later repeats of runs of 50 or more words, and drops
documents of which nothing is left; near-duplicate removal keeps the smallest id of each group; decontamination
drops documents that hold a window of a benchmark item; the last stage encodes what is left, with byte spans.

Defined results, in all stages: a null or empty text stays, as it says nothing against itself. Columns of other names
pass through, whatever they are called, up to the last stage, which returns id, ids and spans only. Equal rows are one
document and the near-duplicate stage keeps one of them; rows that share only an id, or have none, are judged by
their texts; those without an id take no part in near-duplicate groups and stay. Empty tables give empty results.
Texts are read whole, however long.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from recolith.llm import op1_sentencepiece, op2_lines, op5_quality, op8_minhash, op10_winnow
from recolith.llm.runtime import Scratch, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither scorer rejects. Labels teach one labeller; without any it has no opinion. Ids only choose the
    training sample, so null and repeated ids do no harm; ties in its order are broken by id."""
    return op5_quality.clean(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later repeats of runs of 50 or more words; one that loses every line with words goes. The
    earliest place, by id (null first), text and line, keeps its lines; equal rows are one place and are cut alike."""
    return op2_lines.dedup(docs, drop_emptied=True)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group, and all that have no words. Of equal rows one stays. Rows that
    share an id stay or go together, by the document that op8 takes for that id; rows without an id stay."""
    scratch = Scratch(spark)
    found = op8_minhash.near_duplicates(docs.select("doc_id", "text"))
    gone = scratch.save(found.filter("not kept").select("doc_id"), "gone")  # its own table, so the planner knows its size
    again = scratch.save(docs.groupBy("doc_id").count().filter("count > 1 and doc_id is not null").select("doc_id"), "again")
    left = docs.join(gone, "doc_id", "left_anti").select(docs.columns)
    if again.isEmpty():
        return left
    twice = docs.join(again, "doc_id", "left_semi").join(gone, "doc_id", "left_anti").select(docs.columns).dropDuplicates(["doc_id", "text"])
    return left.join(again, "doc_id", "left_anti").select(docs.columns).unionByName(twice)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item, by id and text, so null and repeated ids do no harm. Items
    without words have no window."""
    return op10_winnow.clean(docs, table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per document, null and repeated ids included: doc_id, ids and byte spans; a null text has the end id only."""
    return op1_sentencepiece.encode(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("encoding", encoding),
]

#: The classifier and SentencePiece have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark)
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = scratch.save(docs, name)
            scratch.clear(keep=1)
    return docs
