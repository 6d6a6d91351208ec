"""End-to-end plans: block, train, predict."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recolith.functions.cleaning import clean_records
from recolith.operators.blocking import TOP_K, ranked
from recolith.operators.pairs import distractors, pair_features, sampled_targets, training_pairs
from recolith.plans import model


def first_references(references: DataFrame, limit: int | None) -> DataFrame:
    """The first so many references, country by country and by id within one; all without a limit."""
    return references if limit is None else references.orderBy("clean_country", "entity_id").limit(limit)


def candidates(references: DataFrame, targets: DataFrame, k: int = TOP_K, sample_limit: int | None = None) -> DataFrame:
    """Ranked candidates of cleaned records; ``sample_limit`` takes the first references over all countries only."""
    return ranked(first_references(references, sample_limit), targets, k)


def training_sample(references: DataFrame, targets: DataFrame, truth: DataFrame, n_references: int = 12_000, n_targets: int = 40_000, seed: int = 731) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(references, targets, truth) to train on where all are too many: a uniform sample of references, their true pairs,
    and the targets of these with a uniform sample of the others."""
    refs = model.sample(references, "entity_id", n_references, seed)
    real = truth.join(refs.select(F.col("entity_id").alias("s1_id")), "s1_id", "left_semi")
    return refs, sampled_targets(targets, real, n_targets, seed), real


def train(references: DataFrame, targets: DataFrame, truth: DataFrame, settings: model.Settings | None = None, k: int = TOP_K, n_references: int | None = None, n_targets: int = 40_000) -> model.Bundle:
    """A tuned bundle from raw records and true pairs: groups are split first, then pairs are made, the trees are
    fitted on one part and the threshold is chosen on the other, references without candidates included. With
    ``n_references`` it is trained on a sample (training_sample)."""
    if n_references is not None:
        references, targets, truth = training_sample(references, targets, truth, n_references, n_targets)
    refs, tgts = clean_records(references), clean_records(targets)
    ranked = candidates(refs, tgts, k)
    pairs = training_pairs(ranked, distractors(refs, tgts, truth, ranked), truth)
    features = model.holdout(pair_features(pairs, refs, tgts), "s1_id").persist()
    entities = model.holdout(refs.select(F.col("entity_id").alias("s1_id")), "s1_id").filter("is_test").select("s1_id")
    bundle = model.fit(features.filter("not is_test"), settings)
    scored = model.predict(bundle, features.filter("is_test")).select("s1_id", "target_id", "prob")
    model.tune(bundle, entities, truth.join(entities, "s1_id", "left_semi"), scored)
    features.unpersist()
    return bundle


def evaluate(references: DataFrame, targets: DataFrame, truth: DataFrame, settings: model.Settings | None = None, folds: int = 5, k: int = TOP_K) -> DataFrame:
    """Cross-validation of the whole plan on raw records: a row for each held-out fold."""
    refs, tgts = clean_records(references), clean_records(targets)
    ranked = candidates(refs, tgts, k)
    pairs = training_pairs(ranked, distractors(refs, tgts, truth, ranked), truth)
    features = pair_features(pairs, refs, tgts).persist()
    out = model.cross_validate(features, refs.select(F.col("entity_id").alias("s1_id")), truth, settings, folds)
    features.unpersist()
    return out


def predict(bundle: model.Bundle, references: DataFrame, targets: DataFrame, k: int = TOP_K, threshold: float | None = None, sample_limit: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(ranked candidates, matches with prob) of raw records; matches are candidates that reach the threshold."""
    refs, tgts = clean_records(references), clean_records(targets)
    ranked = candidates(refs, tgts, k, sample_limit)
    scored = model.predict(bundle, pair_features(ranked.select("s1_id", "target_id"), refs, tgts))
    limit = bundle.threshold if threshold is None else threshold
    return ranked, scored.filter(F.col("prob") >= limit).select("s1_id", "target_id", "prob")
