"""Pair classifier: gradient-boosted trees, group folds, Platt calibration, threshold choice, storage."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recolith.lexicon import FEATURES
from recolith.operators.evaluation import best_threshold, macro_f05, threshold_sweep
from recolith.operators.truth import Truth
from recolith.plans import boosting


@dataclass
class Settings:
    """Trees, step, depth and leaves, least rows of a leaf, share of rows and features of a tree, the weight of positive
    pairs, and the group folds. A model is fitted to all pairs of its groups."""

    trees: int = 200
    step: float = 0.05
    depth: int = 6
    leaves: int = 31
    least: int = 20
    rows: float = 1.0
    columns: str = "0.8"
    positive_weight: float = 5.0
    seed: int = 42
    folds: int = 3


@dataclass
class Bundle:
    """Fold models (trees, base margin, sigmoid), the threshold, and the feature list they were made for."""

    models: list[dict]
    threshold: float = 0.5
    features: list[str] = field(default_factory=lambda: list(FEATURES))


def fold(column: str, k: int, seed: int = 42):
    """Fold of a group: all pairs of a reference share it, so none leaks."""
    return F.pmod(F.xxhash64(F.col(column), F.lit(seed)), F.lit(k)).cast("int")


def sample(df: DataFrame, key: str, n: int, seed: int = 731) -> DataFrame:
    """A uniform sample of n rows that depends on keys and seed only."""
    return df.orderBy(F.xxhash64(F.col(key), F.lit(seed)), key).limit(n)


def holdout(df: DataFrame, key: str, share: float = 0.2, seed: int = 42) -> DataFrame:
    """Adds is_test: about that share of groups, by hash."""
    return df.withColumn("is_test", F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(1000)) < int(share * 1000))


def check_classes(pairs: DataFrame) -> int:
    """Both classes must be there; returns the number of pairs."""
    row = pairs.agg(F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") == 0).alias("neg")).first()
    if not row.pos or not row.neg:
        raise ValueError(f"training needs both classes, found {row.pos} positive and {row.neg} negative pairs")
    return row.pos + row.neg


def _arrow(rows: np.ndarray) -> pa.Array:
    """Rows of bytes as binary values."""
    ends = np.arange(0, rows.size + 1, rows.shape[1], dtype=np.int32)
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(rows))])


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in FEATURES], axis=1)


def _members(batch: pa.RecordBatch) -> list[tuple[int, np.ndarray]]:
    """Each part in the batch with its rows."""
    lists = batch.column("parts")
    part, row = lists.flatten().to_numpy(), np.repeat(np.arange(len(lists)), lists.value_lengths().fill_null(0).to_numpy())
    return [(int(p), row[part == p]) for p in np.unique(part)]


def _edges(rows: DataFrame) -> dict[int, list[np.ndarray]]:
    """For each part the upper bounds of the bins of each feature, but the last: exact quantiles of all of its pairs, at
    the ranks k / BINS of them. Values are counted, and only the bounds reach the driver."""

    def count(batches):
        for batch in batches:
            x, lists = _matrix(batch), [tuple(v or ()) for v in batch.column("parts").to_pylist()]
            for some in sorted(set(lists)):
                own = [i for i, v in enumerate(lists) if v == some]
                for f in range(x.shape[1]):
                    value, n = np.unique(x[own, f], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([some] * len(n), pa.list_(pa.int32())), pa.array(np.full(len(n), f, np.int32)), pa.array(value), pa.array(n)], ["parts", "feature", "value", "n"])

    whole = Window.partitionBy("part", "feature")
    counts = rows.select("parts", *FEATURES).mapInArrow(count, "parts array<int>, feature int, value double, n bigint").groupBy("parts", "feature", "value").agg(F.sum("n").alias("n"))
    counts = counts.select(F.explode("parts").alias("part"), "feature", "value", "n").groupBy("part", "feature", "value").agg(F.sum("n").alias("n"))
    counts = counts.withColumns({"upto": F.sum("n").over(whole.orderBy("value")), "all": F.sum("n").over(whole)})

    def ranks(upto):
        """How many of the ranks lie below."""
        return F.least(F.lit(boosting.BINS - 1), F.floor((boosting.BINS * upto - 1) / F.greatest(F.col("all") - 1, F.lit(1))))

    bounds = counts.filter((F.col("upto") < F.col("all")) & (ranks(F.col("upto")) > F.greatest(ranks(F.col("upto") - F.col("n")), F.lit(0))))
    found: dict[int, list[list[float]]] = {}
    for r in sorted(bounds.select("part", "feature", "value").collect()):
        found.setdefault(r.part, [[] for _ in FEATURES])[r.feature].append(r.value)
    return {p: [np.array(x, float) for x in lists] for p, lists in found.items()}


def _fit_parts(pairs: DataFrame, parts, s: Settings) -> dict[int, Bundle]:
    """A bundle for each number in the array column ``parts`` of the pairs: for each group fold trees on the others, and a
    sigmoid on their margins of the fold. Every pair counts: it goes to the task of each of its models as bins, sorted
    there, so that equal ones become one row with its counts. Only fitted models, of bounded size, reach the driver."""
    check_classes(pairs)
    rows = pairs.select(parts.alias("parts"), fold("s1_id", s.folds, s.seed).alias("fold"), F.col("label").cast("int").alias("label"), *[F.col(c).cast("double").alias(c) for c in FEATURES])
    edges, folds = _edges(rows), s.folds
    none = [np.zeros(0) for _ in FEATURES]

    def encode(batches):
        for batch in batches:
            x, y, k = _matrix(batch), batch.column("label").to_numpy(), batch.column("fold").to_numpy()
            for p, own in _members(batch):
                codes = boosting.encode(x[own], edges.get(p, none))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), p, np.int32)), pa.array(k[own]), pa.array(y[own]), _arrow(codes)], ["part", "fold", "label", "codes"])

    def run(batches):
        slot, kept = None, None
        for batch in batches:
            slots, starts = np.unique(batch.column("slot").to_numpy(), return_index=True)
            for i, begin in zip(slots, starts, strict=True):
                if i != slot and kept is not None:
                    yield done(slot, kept)
                if i != slot:
                    slot, kept = i, (boosting.Store(len(FEATURES)), boosting.Store(len(FEATURES)))
                end = begin + int((batch.column("slot").to_numpy() == i).sum())
                some = batch.slice(begin, end - begin)
                codes = np.frombuffer(b"".join(some.column("codes").to_pylist()), np.uint8).reshape(len(some), -1)
                y, own = some.column("label").to_numpy() == 1, some.column("own").to_numpy(zero_copy_only=False)
                for mine, to in zip((~own, own), kept, strict=True):
                    to.add(codes[mine], y[mine])
        if kept is not None:
            yield done(slot, kept)

    def done(slot: int, kept) -> pa.RecordBatch:
        part, k = divmod(int(slot), folds)
        bounds = edges.get(part, none)
        (codes, pos, neg), (mine, mine_pos, mine_neg) = (x.rows() for x in kept)
        trees, base = boosting.fit_rows(codes, pos, neg, bounds, s)
        a, b = boosting.fit_scale(boosting.Scorer(trees, len(FEATURES), bounds).of_bins(base, mine), mine_pos, mine_pos + mine_neg)
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([k], pa.int32()), pa.array([json.dumps({"trees": trees, "base": base, "a": a, "b": b})])], ["part", "model", "fit"])

    bins = rows.mapInArrow(encode, "part int, fold int, label int, codes binary")
    models = bins.select(F.explode(F.sequence(F.lit(0), F.lit(folds - 1))).alias("model"), "*")
    models = models.select((F.col("part") * folds + F.col("model")).alias("slot"), (F.col("fold") == F.col("model")).alias("own"), "label", "codes")
    placed = models.repartitionById((max(edges, default=0) + 1) * folds, F.col("slot")).sortWithinPartitions("slot", "own", "codes")  # the rows' order must not depend on the shuffle
    found: dict[int, Bundle] = {}
    for r in sorted(placed.mapInArrow(run, "part int, model int, fit string").collect()):
        found.setdefault(r.part, Bundle([])).models.append(json.loads(r.fit))
    return found


def fit(pairs: DataFrame, settings: Settings | None = None) -> Bundle:
    """A calibrated bundle of fold models."""
    return _fit_parts(pairs, F.array(F.lit(0)), settings or Settings())[0]


def predict(bundle: Bundle, pairs: DataFrame) -> DataFrame:
    """The pairs with prob, the mean of the calibrated models."""
    models, names = bundle.models, bundle.features

    def run(features: pd.DataFrame) -> pd.Series:
        x = features[names].to_numpy(float)
        total = np.zeros(len(x))
        for m, margin in zip(models, boosting.all_margins(models, x), strict=True):
            total += 1 / (1 + np.exp(-np.clip(m["a"] * margin + m["b"], -500, 500)))
        return pd.Series(total / len(models))

    prob = F.pandas_udf(run, "double")(F.struct(*[F.col(c).cast("double").alias(c) for c in names]))
    return pairs.withColumn("prob", prob)


def tune(bundle: Bundle, entities: DataFrame, truth: DataFrame, scored: DataFrame) -> Bundle:
    row = best_threshold(threshold_sweep(entities, truth, scored)).first()
    bundle.threshold = row.threshold if row else 0.5
    return bundle


def cross_validate(pairs: DataFrame, entities: DataFrame, truth: DataFrame | Truth, settings: Settings | None = None, k: int = 3) -> DataFrame:
    """(fold, threshold, f05, precision, recall) for held-out groups, all folds at once, and mean and population deviation by ``summary``."""
    s = settings or Settings()
    spark: SparkSession = pairs.sparkSession
    rows, mine = [], fold("s1_id", k, s.seed + 1)
    bundles = _fit_parts(pairs, F.filter(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: i != mine), s)
    tests = [predict(bundles[i], pairs.filter(mine == i)).select("s1_id", "target_id", "prob") for i in range(k)]
    scored = reduce(DataFrame.union, tests).persist()
    best = {r.fold: r.threshold for r in best_threshold(threshold_sweep(entities, truth, scored, mine.alias("fold")), "fold").collect()}
    limits = [float(best.get(i, 0.5)) for i in range(k)]
    chosen = scored.filter(F.col("prob") >= F.get(F.array(*map(F.lit, limits)), mine))
    found = {r.fold: r for r in macro_f05(entities, truth, chosen, mine.alias("fold")).collect()}
    scored.unpersist()
    for i in range(k):
        m = found.get(i)
        rows.append((i, limits[i], m and m.f05, m and m.precision, m and m.recall))
    return spark.createDataFrame(rows, "fold int, threshold double, f05 double, precision double, recall double")


def summary(folds: DataFrame) -> DataFrame:
    names = ("f05", "precision", "recall")
    return folds.agg(*[F.avg(c).alias(f"mean_{c}") for c in names], *[F.stddev_pop(c).alias(f"std_{c}") for c in names])


def importances(bundle: Bundle, n: int = 5) -> list[tuple[str, float]]:
    """The n features whose splits gain most, as shares."""
    total = [0.0] * len(bundle.features)
    for m in bundle.models:
        for t in m["trees"]:
            for f, gain in zip(t["feature"], t["gain"], strict=True):
                total[max(f, 0)] += gain
    whole = sum(total) or 1.0
    return sorted(zip(bundle.features, (v / whole for v in total), strict=True), key=lambda x: -x[1])[:n]


def save(bundle: Bundle, spark: SparkSession, path: str) -> None:
    note = json.dumps({"models": bundle.models, "threshold": bundle.threshold, "features": bundle.features})
    spark.createDataFrame([(note,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def load(spark: SparkSession, path: str) -> Bundle:
    """A stored bundle; one made for other features is refused."""
    note = json.loads(spark.read.text(path).first().value)
    if note["features"] != FEATURES:
        raise ValueError("the stored model was made for other features")
    return Bundle(note["models"], note["threshold"], note["features"])
