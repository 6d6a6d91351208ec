"""Recall benchmark of blocking on a sample of references, among true targets and distractors."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recolith.functions.cleaning import clean_records
from recolith.operators.blocking import TOP_K, block_scores, top_k
from recolith.operators.evaluation import blocking_recall, reduction_ratio
from recolith.operators.pairs import truth_pairs
from recolith.plans.model import sample


def pool(targets: DataFrame, truth: DataFrame, per_file: int = 12_500) -> DataFrame:
    """True targets, and the leading rows of each target file that are not true."""
    real = truth.select(F.col("target_id").alias("entity_id")).distinct()
    rest = targets.join(real, "entity_id", "left_anti")
    order = Window.partitionBy(F.substring("entity_id", 1, 2)).orderBy("load_seq", "entity_id")
    lead = rest.withColumn("__k", F.row_number().over(order)).filter(F.col("__k") <= per_file).drop("__k")
    return targets.join(real, "entity_id", "left_semi").unionByName(lead.select(targets.columns))


def run(references: DataFrame, targets: DataFrame, truth_table: DataFrame, n: int = 3000, k: int = TOP_K) -> dict[str, float]:
    """Recall, mean candidates, reduction ratio and references per second."""
    refs = sample(references, "entity_id", n)
    truth = truth_pairs(truth_table).join(refs.select(F.col("entity_id").alias("s1_id")), "s1_id", "left_semi")
    a, b = clean_records(refs), clean_records(pool(targets, truth))
    began = time.time()
    ranked = top_k(block_scores(a, b), k).persist()
    ranked.count()
    took = time.time() - began
    recall, ratio, size = blocking_recall(truth, ranked).first(), reduction_ratio(a, b, ranked).first(), a.count()
    ranked.unpersist()
    return {"recall": recall.recall, "mean_candidates": recall.mean_candidates, "reduction": ratio.reduction, "references_per_second": size / took}
