"""The pipeline's stages on planted cases."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from recolith.llm import op5_quality


def prose(rng, n):
    return " ".join("".join(rng.choice("bdfgklmnprst") + rng.choice("aeiou") for _ in range(rng.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    rng = random.Random(11)
    clean = {k: f"The {prose(rng, 50)} and the {prose(rng, 40)} of the {prose(rng, 9)}." for k in range(120)}
    passage, item = prose(rng, 60), prose(rng, 30)
    rows = dict(clean)
    rows[200] = clean[3]
    rows[201] = clean[4].replace(".", " indeed.")
    rows[202] = f"The first of the {prose(rng, 40)}\n{passage}\nand the end of the {prose(rng, 30)}"
    rows[203] = f"The other of the {prose(rng, 40)}\n{passage}\nand the rest of the {prose(rng, 30)}"
    rows[204] = f"The test of the {prose(rng, 20)} {item} and the {prose(rng, 20)}"
    for k in range(205, 215):
        rows[k] = f"You {rng.choice(op5_quality.INSULTS)} and the {prose(rng, 30)} {rng.choice(op5_quality.INSULTS)} {rng.choice(op5_quality.SLURS)}"
    folder = tmp_path_factory.mktemp("tables")
    docs = [(k, t, "en", "src", len(t)) for k, t in rows.items()] + [(300, None, None, None, None), (301, "", "en", "src", 0)]
    spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([(k, 1, int(205 <= k < 215)) for k in rows], "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder), rows, passage


def test_stages(spark, planted):
    folder, rows, passage = planted
    docs, kept = spark.read.parquet(f"{folder}/documents.parquet"), {}
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == columns
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        kept[name] = {r.doc_id: r.text for r in docs.collect()}
    everything = set(rows) | {300, 301}
    assert set(kept["quality"]) == everything - set(range(205, 215))
    after = kept["line_dedup"]
    assert 200 not in after and passage in after[202] and passage not in after[203] and after[203].count("\n") == 1
    assert 201 not in kept["near_dedup"] and set(range(120)) <= set(kept["near_dedup"])
    assert set(kept["near_dedup"]) - set(kept["decontamination"]) == {204}
    assert {300, 301} <= set(kept["decontamination"])


def test_run(spark, planted):
    folder, *_ = planted
    out = corpus_pipeline.run(spark, folder)
    assert out.columns == ["doc_id", "ids", "starts", "ends"] and out.filter(F.size("ids") < 1).count() == 0
    assert {r.doc_id for r in out.select("doc_id").collect()} == set(range(120)) | {202, 203, 300, 301}


def test_empty_tables(spark, planted, tmp_path):
    folder, *_ = planted
    for t in ("documents", "benchmark", "labels"):
        spark.read.parquet(f"{folder}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
