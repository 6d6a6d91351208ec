import math
import re

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from recolith.functions import similarity as sim
from recolith.functions.cleaning import clean_records
from recolith.operators import audit, blocking, evaluation, keys, pairs, sets, validation
from recolith.operators.truth import GroupTruth
from recolith.__main__ import main
from recolith.plans import benchmark, boosting, linkage, model, report
from recolith.queries import QUERIES
from recolith.sources import fixtures, records, view
from recolith.streaming.records import rank_stream

def frame(spark, *names):
    out = None
    for name in names:
        df = fixtures.sample(spark, name)
        out = df if out is None else out.union(df)
    return out.coalesce(1).withColumn("load_seq", F.monotonically_increasing_id())


@pytest.fixture(scope="module")
def data(spark):
    refs, targets = clean_records(frame(spark, "train_source1")), clean_records(frame(spark, "train_source2", "train_source3"))
    return refs, targets, fixtures.sample(spark, "train_ground_truth")


def key_set(spark, core, address, country):
    df = spark.createDataFrame([("S1-1", core, address, country)], "entity_id string, core_name string, clean_address string, clean_country string")
    return {f"{r.country}#{r.key_type}#{r.key}" for r in keys.blocking_keys(df).collect()}


def test_keys(spark):
    got = key_set(spark, "amazon web services", "410 terry ave n seattle wa 98109", "US")
    assert {"US#CN#amazon web services", "US#1W#amazon", "US#2W#amazon_web", "US#PFX4#amaz", "US#PIN_NAME#98109_amazon"} <= got
    got = key_set(spark, "societe generale", "29 blvd haussmann 75009 paris", "FR")
    assert {"FR#CN#societe generale", "FR#1W#societe", "FR#2W#societe_generale", "FR#PFX4#soci", "FR#PIN_NAME#75009_societe", "FR#ADDR#29_haussmann"} <= got
    assert key_set(spark, "", "", "") == set()
    assert all(k.startswith("UNK#") for k in key_set(spark, "abcd", "", ""))


def test_country_isolation_and_recall(spark, data):
    refs, targets, truth = data
    ranked = blocking.top_k(blocking.block_scores(refs, targets))
    country = {r.entity_id: r.clean_country for r in refs.union(targets).collect()}
    assert all(country[r.s1_id] == country[r.target_id] for r in ranked.collect())
    row = evaluation.blocking_recall(pairs.truth_pairs(truth), ranked).first()
    assert row.recall >= 90
    assert evaluation.reduction_ratio(refs, targets, ranked).first().reduction > 0.7


def test_top_k_ties_and_lists(spark):
    scores = spark.createDataFrame([("S1-1", f"S2-{i:02d}", 3) for i in range(30)], "s1_id string, target_id string, score bigint")
    out = blocking.top_k(scores, 25)
    assert out.count() == 25
    refs = spark.createDataFrame([("S1-1",), ("S1-2",)], "entity_id string")
    lists = {r[0]: r[1] for r in blocking.candidate_lists(refs, out).collect()}
    assert lists["S1-2"] == "" and lists["S1-1"].startswith("S2-00,S2-01")


def test_tiers_cut_before_duplicates(spark):
    refs = spark.createDataFrame([("S1-1", "US", "acme", "acme", "12345")], "entity_id string, country string, core string, pfx string, postal string")
    rows = [(f"S2-{i}", i, "US", "acme", "acme", "12345" if i > 2 else "") for i in range(6)]
    index = spark.createDataFrame(rows, "entity_id string, load_seq bigint, country string, core string, pfx string, postal string")
    got = [(r.target_id, r.tier) for r in blocking.tiered_top_k(refs, index, 3).orderBy("rank").collect()]
    assert got == [("S2-0", 1), ("S2-1", 1), ("S2-2", 1)]


def values(spark, rows, f):
    df = spark.createDataFrame(rows, "a string, b string")
    return [r.o for r in df.select(f(F.col("a"), F.col("b")).alias("o")).collect()]


def test_levenshtein(spark):
    got = values(spark, [("apple", "apple"), ("", "apple"), ("apple", ""), ("apple", "apply"), ("", "")], sim.levenshtein_ratio)
    assert [round(x, 2) for x in got] == [1.0, 0.0, 0.0, 0.8, 1.0]


def test_jaro_winkler(spark):
    got = values(spark, [("google", "google"), ("", "google"), ("martha", "marhta"), ("starbucks", "star of india grocery")], sim.jaro_winkler)
    assert got[:2] == [1.0, 0.0] and math.isclose(got[2], 0.9611, abs_tol=1e-4) and math.isclose(got[3], 0.727, abs_tol=1e-3)


def slow_jaro_winkler(a, b):
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    reach, used, left = max(0, max(len(a), len(b)) // 2 - 1), [False] * len(b), []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not used[j] and b[j] == c:
                used[j] = True
                left.append(c)
                break
    m = len(left)
    if not m:
        return 0.0
    right = [c for c, u in zip(b, used) if u]
    t = sum(x != y for x, y in zip(left, right)) / 2
    jaro = (m / len(a) + m / len(b) + (m - t) / m) / 3
    p = 0
    while p < 4 and p < min(len(a), len(b)) and a[p] == b[p]:
        p += 1
    return jaro + p * 0.1 * (1 - jaro)


@given(st.text("abc", max_size=12), st.text("abc", max_size=12))
def test_jaro_winkler_by_definition(a, b):
    assert math.isclose(sim.jaro_winkler_value(a, b), slow_jaro_winkler(a, b))
    assert 0 <= sim.jaro_winkler_value(a, b) <= 1


def test_features_bounds_and_order(spark, data):
    from recolith.lexicon import FEATURES

    refs, targets, _ = data
    every = refs.select(F.col("entity_id").alias("s1_id")).crossJoin(targets.select(F.col("entity_id").alias("target_id")))
    out = pairs.pair_features(every, refs, targets)
    assert [c for c in out.columns if c.startswith("feat_")] == FEATURES
    for r in out.collect():
        assert all(0 <= r[c] <= 1 for c in FEATURES if c != "feat_name_length_diff")
        assert r.feat_postal_exact_match in (0.0, 0.5, 1.0) and r.feat_is_s2 + r.feat_is_s3 == 1


F05 = [([], [], (1, 1, 1)), ([], ["S2-9"], (0, 0, 0)), (["S2-1"], [], (0, 0, 0)), (["S2-1"], ["S2-1"], (1, 1, 1)), (["S2-1"], ["S2-1", "S2-2"], (5 / 9, 0.5, 1))]


@pytest.mark.parametrize(("true", "pred", "want"), F05)
def test_f05(spark, true, pred, want):
    schema = "s1_id string, target_id string"
    entities = spark.createDataFrame([("S1-1",)], "s1_id string")
    t, p = (spark.createDataFrame([("S1-1", x) for x in ids], schema) for ids in (true, pred))
    row = evaluation.macro_f05(entities, t, p.union(spark.createDataFrame([("S1-7", "S2-1")], schema))).first()
    assert tuple(round(x, 6) for x in row) == tuple(round(x, 6) for x in want)


def test_sweep_against_each_threshold(spark):
    schema = "s1_id string, target_id string"
    entities = spark.createDataFrame([(f"S1-{i}",) for i in range(4)], "s1_id string")
    truth = spark.createDataFrame([("S1-0", "S2-1"), ("S1-1", "S2-2"), ("S1-1", "S2-3")], schema)
    rows = [("S1-0", "S2-1", 0.9), ("S1-0", "S2-5", 0.3), ("S1-1", "S2-2", 0.55), ("S1-1", "S2-3", 0.05), ("S1-2", "S2-1", 0.4)]
    scored = spark.createDataFrame(rows, schema + ", prob double")
    for r in evaluation.threshold_sweep(entities, truth, scored).filter("step % 17 = 0").collect():
        m = evaluation.macro_f05(entities, truth, scored.filter(F.col("prob") >= r.threshold)).first()
        assert math.isclose(m.f05, r.f05) and math.isclose(m.precision, r.precision) and math.isclose(m.recall, r.recall)
    assert evaluation.best_threshold(evaluation.threshold_sweep(entities, truth, scored)).count() == 1


def test_distractors(spark, data):
    refs, targets, truth = data
    real = pairs.truth_pairs(truth)
    ranked = blocking.top_k(blocking.block_scores(refs, targets)).select("s1_id", "target_id")
    extra = pairs.distractors(refs, targets, real, ranked)
    got = {tuple(r) for r in extra.collect()}
    assert not got & {tuple(r) for r in real.union(ranked).collect()}
    labelled = pairs.training_pairs(ranked, extra, real)
    per = labelled.filter("label = 0").groupBy("s1_id").count().collect()
    assert all(r["count"] >= 3 for r in per)


def test_audits(spark, data):
    refs, targets, truth = data
    c = audit.truth_cardinality(truth).first()
    assert (c.total, c.singletons, c.one_to_one, c.one_to_many, c.largest, c.mean_matches) == (10, 2, 6, 2, 2, 1.0)
    s = audit.truth_sources(truth).first()
    assert (s.s2_only, s.s3_only, s.both) == (4, 2, 2)
    assert {tuple(r) for r in audit.country_counts(refs.unionByName(targets)).collect()} == {("US", 12), ("IN", 12)}
    bad = spark.createDataFrame([("S1-1",), ("S1-1",), ("S2-x",), ("S1-b ad",)], "entity_id string")
    row = audit.id_audit(bad, 1).first()
    assert (row.total, row.duplicates, row.wrong_prefix, row.bad_format, row.duplicate_examples) == (4, 1, 1, 2, "S1-1")
    nulls = {r["column"]: r for r in audit.null_profile(spark.createDataFrame([("a", " "), ("b", None)], "x string, y string")).collect()}
    assert (nulls["y"].missing, nulls["y"].whitespace_only, nulls["x"].missing) == (2, 1, 0)
    assert audit.open_set_preserved(refs, spark.createDataFrame([("FR",)], "country string")).first()[0]


def test_region_profile_of_the_samples(spark):
    every = frame(spark, "train_source1", "train_source2", "train_source3", "test_source1", "test_source2", "test_source3")
    r = audit.region_profile(every).first()
    assert (r.france_records, r.france_accents, r.france_postal, r.france_street, r.france_legal) == (11, 6, 10, 11, 4)
    assert (r.india_pin, r.india_landmark, r.us_zip) == (16, 4, 15)
    test = frame(spark, "test_source1", "test_source2", "test_source3")
    assert {tuple(x) for x in audit.country_counts(test).collect()} == {("FR", 11), ("US", 5), ("IN", 4)}


def test_benchmark(spark, data):
    refs, targets, truth = data
    out = benchmark.run(refs, targets, truth)
    assert out["recall"] >= 90 and out["reduction"] > 0.7


def test_commands(spark, tmp_path, capsys):
    folder = str(tmp_path)
    assert main(["generate", folder]) == 0 and main(["audit", folder]) == 0
    assert "Ids of source 3" in capsys.readouterr().out
    assert main(["train", folder, "--trees", "3"]) == 0
    assert main(["predict", folder, "--threshold", "0.1"]) == 0
    text = (tmp_path / "matching_results.tsv").read_text()
    assert text.count("\n") == 11 and text.startswith("source1_entity_id\tmatched_entity_ids\n")
    assert main(["validate", folder, "--check-ids"]) == 0
    ids = [line.split("\t")[0] for line in text.splitlines()[1:]]
    assert ids == [line.split("\t")[0] for line in (tmp_path / "test_source1.tsv").read_text().splitlines()[1:]]
    capsys.readouterr()
    assert main(["package", folder, "--team", "The Team"]) == 0 and (tmp_path / "the_team.zip").exists()
    (tmp_path / ".matching_results.tsv.crc").unlink(missing_ok=True)
    (tmp_path / "matching_results.tsv").write_text("broken\n")
    assert main(["package", folder, "--team", "x"]) == 1 and main(["package", folder, "--team", "x", "--skip-validation"]) == 0
    assert main(["cv", folder, "--trees", "3", "--folds", "2"]) == 0 and "mean_f05" in capsys.readouterr().out
    assert main(["demo", str(tmp_path / "demo"), "--trees", "3", "--threshold", "0.1"]) == 0


def lines(spark, *text):
    return spark.createDataFrame(list(enumerate(text, 1)), "line_no bigint, value string")


def test_validation(spark):
    required = spark.createDataFrame([("S1-1",), ("S1-2",)], "entity_id string")
    known = spark.createDataFrame([("S2-1",)], "entity_id string")
    head, chead = "source1_entity_id\tmatched_entity_ids", "source1_entity_id\tcandidate_entity_ids"
    good = validation.validation_report(lines(spark, head, "S1-1\tS2-1", "S1-2\t"), lines(spark, chead, "S1-1\tS2-1", "S1-2\t"), required, known)
    assert good.count() == 0 and validation.is_valid(good)
    broken = lines(spark, head, "S1-1\tS2-1,S2-1", "S1-1\tS1-4", "S1-3\tX", "oops", "", "S1-1\tS2-7")
    found = {r.rule: r for r in validation.validation_report(broken, None, required, known).collect()}
    assert set(found) == {"V3_no_tab", "V4_duplicate_row", "V5_repeated_id", "V6_self_match", "V7_prefix", "V8_unknown_id", "V9_missing_row", "V10_extra_row", "V11_no_candidate_file"}
    csv = validation.validation_report(lines(spark, "a,b"), None, required)
    assert {r.rule for r in csv.collect()} == {"V2_comma_separated", "V11_no_candidate_file"}


def test_validation_query_reads_both_files(spark, tmp_path):
    rows = [(i, f"one two three four {'five' * (i % 4)}", "en") for i in range(12)]
    rows += [(291, "six seven eight nine", "en"), (292, "six seven eight nine", "en")]  # alike, but 291 has no country
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    missed = {r.s1_id for r in QUERIES["subset_anti"](spark, str(tmp_path)).collect()}
    found = {(r.file, r.rule): r for r in QUERIES["validation_report_both"](spark, str(tmp_path)).collect()}
    assert "S1-00000291" in missed and found["matching", "V11_not_candidate"].examples == "S1-00000291"
    assert ("candidate", "V3_no_tab") in found and ("candidate", "V11_no_candidate_file") not in found
    assert not any(rule == "V11_no_candidate_file" for _, rule in found)


def test_files(spark, data, tmp_path):
    path = tmp_path / "s.tsv"
    path.write_text("entity_id\tbusiness_name\tbusiness_address\tcountry\nS1-1\tA\t\tUS\nS1-2\tB\tx\tFR\textra\n")
    df = records.read_tsv(spark, str(path))
    assert df.filter("entity_id = 'S1-1'").first().business_address == ""
    assert records.read_tsv(spark, str(tmp_path / "none.tsv")).count() == 0
    row = audit.schema_audit(records.read_lines(spark, str(path)), ["entity_id", "business_name", "business_address", "country"]).first()
    assert (row.header_ok, row.n_rows, row.n_ragged, row.first_ragged[0].line_no) == (True, 2, 1, 3)
    refs, targets, _ = data
    ranked = blocking.top_k(blocking.block_scores(refs, targets))
    matches, candidates = records.write_results(refs, ranked, ranked.filter("rank = 1"), str(tmp_path / "out"))
    text = "".join(sorted(p.read_text() for p in (tmp_path / "out/matching_results").glob("part-*")))
    assert '"' not in text and "S1-00005\t\n" in text
    for folder in (matches, candidates):
        records.write_tsv(records.read_tsv(spark, folder, records.TRUTH), folder + "_one", single=True)
        records.publish(spark, folder + "_one", folder + ".tsv")
    found = validation.validation_report(records.read_lines(spark, matches + ".tsv"), records.read_lines(spark, candidates + ".tsv").withColumn("value", F.regexp_replace("value", "matched_entity_ids", "candidate_entity_ids")), refs, targets)
    assert validation.is_valid(found)
    z = report.package(" My Team ", [matches + ".tsv"], str(tmp_path), found)
    assert z.name == "my_team.zip" and "| rule |" in report.markdown("Audit", {"findings": found}).replace("| file | rule |", "| rule |")


def test_sets(spark):
    a = spark.createDataFrame([("S1-1", ["a", "b"])], "s1_id string, ids array<string>")
    b = spark.createDataFrame([("S1-1", ["b"])], "s1_id string, ids array<string>")
    assert tuple(sets.list_comparison(a, b).first()) == ("S1-1", 1, 2, 1, False)


def test_model(spark, data, tmp_path):
    refs, targets, truth = data
    raw = ["entity_id", "business_name", "business_address", "country", "load_seq"]
    settings = model.Settings(trees=3, depth=2, folds=2)
    real = pairs.truth_pairs(truth)
    ranked = blocking.top_k(blocking.block_scores(refs, targets)).select("s1_id", "target_id")
    features = pairs.pair_features(pairs.training_pairs(ranked, pairs.distractors(refs, targets, real, ranked), real), refs, targets)
    folds = features.withColumn("f", model.fold("s1_id", 3)).groupBy("s1_id").agg(F.countDistinct("f").alias("n"))
    assert folds.filter("n > 1").count() == 0
    bundle = model.fit(features, settings)
    model.save(bundle, spark, str(tmp_path / "m"))
    again = model.load(spark, str(tmp_path / "m"))
    p, q = ({tuple(r) for r in model.predict(m, features).select("s1_id", "target_id", F.round("prob", 9)).collect()} for m in (bundle, again))
    assert p == q and len(model.importances(bundle)) == 5
    ranked, matched = linkage.predict(bundle, refs.select(raw), targets.select(raw), threshold=0.0)
    assert matched.count() == ranked.count()
    with pytest.raises(ValueError, match="both classes"):
        model.fit(features.filter("label = 1"), settings)


def test_trees_learn_and_stop(spark):
    import numpy as np

    rng = np.random.default_rng(0)
    x = rng.random((600, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.3)).astype(float)
    s = model.Settings(trees=60, positive_weight=1.0, columns="1.0")
    trees, base = boosting.fit_trees(x[:400], y[:400], s)
    assert len(trees) == 60 and all(len(t["feature"]) <= 2 * s.leaves - 1 for t in trees)
    got = boosting.margins(trees, base, x[400:]) > 0
    assert (got == (y[400:] > 0)).mean() > 0.93
    a, b = boosting.fit_scale(boosting.margins(trees, base, x[400:]), y[400:])
    assert a > 0 and abs((1 / (1 + np.exp(-(a * boosting.margins(trees, base, x[400:]) + b)))).mean() - y[400:].mean()) < 0.01
    t = trees[0]  # a tree's split gains what its two sides gain, by definition
    p = 1 / (1 + np.exp(-base))
    g, h, down = p - y[:400], np.full(400, p * (1 - p)), x[:400, t["feature"][0]] <= t["limit"][0]
    score = lambda w: g[w].sum() ** 2 / h[w].sum()
    assert np.isclose(t["gain"][0], score(down) + score(~down) - score(down | True))
    assert boosting.fit_trees(x, np.ones(600), s)[0] == [] and boosting.fit_scale(np.zeros(3), np.ones(3)) == (1.0, 0.0)


def test_equal_rows_count_as_often_as_they_come():
    import numpy as np

    rng = np.random.default_rng(1)
    x = rng.integers(0, 5, (4000, 3)).astype(float)
    y = (rng.random(4000) < 0.2 + 0.15 * x[:, 0]).astype(float)
    s = model.Settings(trees=12, depth=4)
    edges = boosting._edges(x)
    bins = boosting.encode(x, edges)
    kept = boosting.Store(3)
    order = np.lexsort(bins.T)
    kept.add(bins[order], y[order] == 1)
    codes, pos, neg = kept.rows()
    assert len(codes) == 125 and pos.sum() == y.sum() and (pos + neg).sum() == 4000
    one, every = boosting.fit_rows(codes, pos, neg, edges, s), boosting.fit_trees(x, y, s)
    got, want = (boosting.margins(*m, x) for m in (one, every))
    assert np.allclose(got, want) and len(set(want)) > 20
    walk = [boosting.Scorer(every[0], 3)._walk(t, boosting.encode(x, boosting.Scorer(every[0], 3).cuts)) for t in every[0]]
    assert np.allclose(want, every[1] + sum(walk))
    a, b = boosting.fit_scale(want, y), boosting.fit_scale(np.repeat(want, 2), np.repeat(y, 2) / 2, np.full(8000, 0.5))
    assert np.allclose(a, b)
    chunk, boosting.CHUNK, small, boosting.IN_MEMORY = boosting.CHUNK, 100, boosting.IN_MEMORY, 64
    try:  # many chunks and files give the same trees
        assert np.allclose(boosting.margins(*boosting.fit_trees(x, y, s), x), want)
    finally:
        boosting.CHUNK, boosting.IN_MEMORY = chunk, small


def _many_pairs(spark, n: int, positive: str):
    """Pairs whose label the hash of their number decides, in features that say little."""
    from recolith.lexicon import FEATURES

    df = spark.range(n).selectExpr("concat('S1-', id % 997) as s1_id", "concat('S2-', id) as target_id", f"cast({positive} as int) as label", "id")
    return df.select("s1_id", "target_id", "label", *[F.pmod(F.xxhash64("id", F.lit(k)), F.lit(3 + 5 * k)).cast("double").alias(c) for k, c in enumerate(FEATURES)])


def test_bounds_are_quantiles_of_all_pairs(spark):
    import numpy as np

    from recolith.lexicon import FEATURES

    pairs_ = _many_pairs(spark, 3001, "id % 2").repartition(5)
    rows = pairs_.select(F.when(F.col("target_id") < "S2-2", F.array(F.lit(0))).otherwise(F.array(F.lit(0), F.lit(1))).alias("parts"), "target_id", *FEATURES)
    got = model._edges(rows)
    for part, mine in ((0, rows), (1, rows.filter("size(parts) = 2"))):
        want = boosting._edges(np.array([tuple(r) for r in mine.select(*FEATURES).collect()]))
        assert all(np.array_equal(a, b) for a, b in zip(got[part], want, strict=True))


def test_models_are_fitted_to_every_pair(spark):
    """More pairs than the former bound of 200,000: the base margin of each model tells how many pairs it has read."""
    import numpy as np

    pairs_ = _many_pairs(spark, 230_000, "pmod(xxhash64(id, 9), 7) = 0").persist()
    s = model.Settings(trees=1, depth=1, positive_weight=1.0)
    folds = pairs_.groupBy(model.fold("s1_id", s.folds, s.seed).alias("f")).agg(F.sum("label").alias("pos"), F.count("*").alias("n")).collect()
    bundle = model.fit(pairs_, s)
    for k, m in enumerate(bundle.models):
        pos, n = (sum(r[c] for r in folds if r.f != k) for c in ("pos", "n"))
        assert np.isclose(m["base"], np.log(pos / (n - pos)), rtol=1e-12)
    pairs_.unpersist()


def test_cross_validation_counts_each_fold_alone(spark, data):
    refs, targets, truth = data
    real = pairs.truth_pairs(truth)
    s = model.Settings(trees=2, depth=2, folds=2)
    ranked = blocking.top_k(blocking.block_scores(refs, targets)).select("s1_id", "target_id")
    features = pairs.pair_features(pairs.training_pairs(ranked, pairs.distractors(refs, targets, real, ranked), real), refs, targets).persist()
    entities = refs.select(F.col("entity_id").alias("s1_id"))
    got = {r.fold: r for r in model.cross_validate(features, entities, real, s, 2).collect()}
    mine = model.fold("s1_id", 2, s.seed + 1)
    bundles = model._fit_parts(features, F.filter(F.sequence(F.lit(0), F.lit(1)), lambda i: i != mine), s)
    for i in range(2):
        scored = model.predict(bundles[i], features.filter(mine == i))
        some, own = entities.filter(mine == i), real.filter(mine == i)
        best = model.tune(bundles[i], some, own, scored).threshold
        m = evaluation.macro_f05(some, own, scored.filter(F.col("prob") >= best)).first()
        assert got[i].threshold == best and [got[i][c] for c in ("f05", "precision", "recall")] == pytest.approx([m.f05, m.precision, m.recall])
    features.unpersist()


def test_sampled_training(spark, data):
    refs, targets, truth = data
    real = pairs.truth_pairs(truth)
    a, b, c = linkage.training_sample(refs, targets, real, n_references=4, n_targets=3)
    ids = {r.entity_id for r in a.collect()}
    assert len(ids) == 4 and {r.s1_id for r in c.collect()} == ids & {r.s1_id for r in real.collect()}
    mine, pool = {r.target_id for r in c.collect()}, [r.entity_id for r in b.collect()]
    assert mine <= set(pool) and len(pool) == len(set(pool)) and 0 <= len(set(pool) - mine) <= 3
    assert {r.entity_id for r in linkage.training_sample(refs, targets, real, 4, 3)[1].collect()} == set(pool)
    first = linkage.first_references(refs, 3).orderBy("clean_country", "entity_id").collect()
    want = refs.orderBy("clean_country", "entity_id").limit(3).collect()
    assert [r.entity_id for r in first] == [r.entity_id for r in want] and linkage.candidates(refs, targets, sample_limit=3).select("s1_id").distinct().count() <= 3


def test_tiers_cut_before_the_join(spark):
    rows = [(f"S2-{i:03d}", i, "US", "acme", "acme", "") for i in range(60)]
    index = spark.createDataFrame(rows, "entity_id string, load_seq long, country string, core string, pfx string, postal string")
    refs = index.limit(1).withColumn("entity_id", F.lit("S1-1"))
    got = [r.target_id for r in blocking.tiered_top_k(refs, index, 5).orderBy("rank").collect()]
    assert got == [f"S2-{i:03d}" for i in range(5)]
    plan = blocking.tiered_top_k(refs, index, 5)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2


def test_model_queries_run_the_whole_model(spark, tmp_path, monkeypatch):
    rows = [(i, f"one two three four {i % 4}", "en") for i in range(12)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    seen = {}

    def stop(name):
        def run(*args, settings=None, k=None):
            settings = next((x for x in args if isinstance(x, model.Settings)), settings)
            seen[name] = settings or model.Settings(), next((x for x in args if isinstance(x, int)), k)
            raise InterruptedError

        return run

    for where, name in ((model, "fit"), (model, "cross_validate"), (linkage, "train")):
        monkeypatch.setattr(where, name, stop(name))
    for query in ("gbt_scores", "cv_summary", "match_results"):
        with pytest.raises(InterruptedError):
            QUERIES[query](spark, str(tmp_path))
    spark.catalog.clearCache()
    assert all(s == model.Settings() for s, _ in seen.values()) and set(seen) == {"fit", "cross_validate", "train"}
    assert seen["cross_validate"][1] == 5


def test_stream(spark, data, tmp_path):
    refs, targets, _ = data
    raw = ["entity_id", "business_name", "business_address", "country"]
    refs.select(raw).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(refs.select(raw).schema).parquet(str(tmp_path / "in"))
    rank_stream(stream, targets.select(raw), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    want = blocking.top_k(blocking.block_scores(refs, targets))
    got = spark.read.parquet(str(tmp_path / "out")).select(want.columns)
    assert got.exceptAll(want).count() == 0 and got.count() == want.count()


def _keyed(spark, rows):
    return spark.createDataFrame(rows, "entity_id string, core_name string, clean_address string, clean_country string")


def test_copies_are_scored_once(spark):
    refs = _keyed(spark, [(f"S1-{i:04d}", "acme foods", "12 rose lane 12345", "US") for i in range(600)] + [("S1-x", "acme tools", "", "US")])
    targets = _keyed(spark, [(f"S2-{i:04d}", "acme foods", "12 rose lane 12345", "US") for i in range(700)] + [("S3-0", "acme tools", "", "US"), ("S3-1", "acme foods", "", "")])
    (a, _), (b, _) = blocking._classes(refs), blocking._classes(targets)
    assert blocking._shared(a, b, None).count() < 40  # keys that classes share, not pairs of records
    scores = blocking.block_scores(refs, targets)
    found = {tuple(r): n for *r, n in scores.groupBy("score").agg(F.count("*"), F.countDistinct("s1_id", "target_id")).select("score", "count(1)", "count(DISTINCT s1_id, target_id)").collect()}
    assert sum(n for _, n in found) == sum(found.values()) == 601 * 701
    few = blocking.ranked(refs, targets, 7)
    assert {tuple(r) for r in few.collect()} == {tuple(r) for r in blocking.top_k(scores, 7).collect()}
    assert few.filter("s1_id = 'S1-0000'").orderBy("rank").first().target_id == "S2-0000"


def test_keys_of_an_id_are_a_set(spark):
    """A repeated id counts each key once, as in the SQL, and has the keys of all its rows."""
    refs = _keyed(spark, [("S1-1", "acme foods", "", "US")] * 2 + [("S1-1", "zenith", "", "FR")])
    targets = _keyed(spark, [("S2-1", "acme foods", "", "US"), ("S2-2", "zenith", "", "FR"), (None, "zenith", "", "FR")])
    got = {r.target_id: r.score for r in blocking.block_scores(refs, targets).collect()}
    once = {r.target_id: r.score for r in blocking.block_scores(_keyed(spark, [("S1-1", "acme foods", "", "US"), ("S1-2", "zenith", "", "FR")]), targets).collect()}
    assert got == once and set(got) == {"S2-1", "S2-2"}


def test_view_reads_the_first_words_only(spark, tmp_path):
    texts = ["", " a  b\tc", "a b c d e f g", "one", "a \n", "x y z", None, "a b c d  ", "\t\t" + "w" * 5000 + " q r s t u v"]
    rows = [(i, t, "en") for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    for r in view.records(spark, str(tmp_path)).collect():
        words = [*re.split("[ \t\r\n\f]+", texts[r.doc_id] or ""), *[""] * 5][:5]
        form = view.FORMS[r.doc_id % 5]
        assert r.business_name == " ".join([*words[:3], *[form] * bool(form)]) and r.business_address.startswith(f"{100 + len(words[0]) * 10 + len(words[1])} {words[3]} Street, {words[4]}")
    assert "{0,4}" in view.records(spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()  # no split of whole texts


def test_grouped_truth_equals_listed_truth(spark):
    """Groups give what their listed pairs give, and no operator lists the pairs of a large group."""
    refs = spark.createDataFrame([(f"S1-{i:03d}", "US" if i % 4 else "FR") for i in range(60)], "entity_id string, clean_country string")
    targets = spark.createDataFrame([(f"S{2 + i % 2}-{i:03d}", "US" if i % 3 else "FR", i * 7 % 301) for i in range(300)], "entity_id string, clean_country string, load_seq int")
    group = F.when(F.col("n") < 40, "x").otherwise(F.concat(F.lit("g"), (F.col("n") % 9).cast("string")))
    a = refs.select(F.col("entity_id").alias("s1_id"), F.substring("entity_id", 4, 3).cast("int").alias("n")).select("s1_id", group.alias("group")).filter("s1_id <> 'S1-050'")
    b = targets.select(F.col("entity_id").alias("target_id"), (F.substring("entity_id", 4, 3).cast("int") % 200).alias("n")).select("target_id", group.alias("group"))
    b = b.union(spark.createDataFrame([(f"S2-y{i}", "x") for i in range(400)], "target_id string, group string"))  # more than a chunk
    grouped, listed = GroupTruth(a, b), a.join(b, "group").select("s1_id", "target_id")
    ids = refs.select(F.col("entity_id").alias("s1_id"))
    near = ids.crossJoin(targets.select(F.col("entity_id").alias("target_id"))).filter("s1_id <> 'S1-007' and (pmod(xxhash64(s1_id, target_id), 40) = 0 or (target_id < 'S2-030' and s1_id < 'S1-030'))")
    scored = near.withColumn("prob", F.pmod(F.xxhash64("s1_id", "target_id"), F.lit(100)) / 100)

    def same(f):
        left, right = ([tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in f(t).collect()] for t in (grouped, listed))
        assert left and sorted(left, key=str) == sorted(right, key=str)

    same(lambda t: pairs.label_pairs(near, t))
    same(lambda t: sets.outside(t, near))
    same(lambda t: pairs.distractors(refs, targets, t, near))
    same(lambda t: evaluation.per_entity(ids, t, near))
    same(lambda t: evaluation.threshold_sweep(ids, t, scored))
    same(lambda t: evaluation.blocking_recall(t, near))

    def lists(df):
        return df.groupBy("s1_id").agg(F.collect_set("target_id").alias("ids"))

    same(lambda t: sets.truth_comparison(t, near) if t is grouped else sets.list_comparison(lists(t), lists(near)))


@pytest.mark.parametrize("name", ["label_pairs", "id_set_ops", "f05_per_entity", "macro_f05", "best_threshold", "blocking_recall"])
def test_no_join_of_all_true_pairs(spark, name):
    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join " in line]
    assert joins and not any("head" in line and "lang" in line and "Inner, ((head" in line for line in joins)


@pytest.mark.parametrize("limit", [None, 30])
def test_common_keys_are_met_in_sets(spark, monkeypatch, limit):
    monkeypatch.setattr(blocking, "COMMON", 4)
    # every name begins alike, some share a rare second word or an address besides, copies included
    row = lambda s, i: (f"S{s}-{i:03d}", f"{'acme' if i % 7 else 'acmes'} w{i % 23}x {i % 3}", f"{i % 11} street{i % 29} ny", "US" if i % 5 else "FR")
    refs, targets = _keyed(spark, [row(1, i) for i in range(90)]), _keyed(spark, [row(2 + i % 2, i) for i in range(200)])
    a, b = keys.blocking_keys(refs).withColumnRenamed("entity_id", "s1_id"), keys.blocking_keys(targets).withColumnRenamed("entity_id", "target_id")
    if limit:
        b = b.join(b.groupBy(blocking.KEY).count().filter(f"count > {limit}"), blocking.KEY, "left_anti")
    want = a.join(b, blocking.KEY).groupBy("s1_id", "target_id").agg(F.sum(keys.weight()).alias("score"))
    assert sorted(map(tuple, blocking.block_scores(refs, targets, limit).collect())) == sorted(map(tuple, want.collect()))
    top = blocking.top_k(want, 6).select("s1_id", "target_id", "score", "rank")
    assert sorted(map(tuple, blocking.ranked(refs, targets, 6, limit).collect())) == sorted(map(tuple, top.collect()))
    (left, _), (right, _) = blocking._classes(refs), blocking._classes(targets)
    assert blocking._Shared(left, right, limit).near.count() < want.count() / 2


def test_features_move_only_what_they_read(spark, data, capsys):
    refs, targets, truth = data
    out = pairs.pair_features(pairs.truth_pairs(truth), refs, targets, full=False)
    out.select("s1_id", "target_id", "feat_name_levenshtein_ratio").explain()
    plan = capsys.readouterr().out
    assert "levenshtein" in plan and "clean_address" not in plan and "sequence(" not in plan
