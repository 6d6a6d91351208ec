"""python -m recolith generate|demo|audit|benchmark|train|cv|predict|validate|package FOLDER [options]: commands over a folder of TSV files."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from recolith.operators import audit, validation
from recolith.operators.pairs import truth_pairs
from recolith.plans import benchmark, linkage, model, report
from recolith.sources import fixtures, records


def main(args: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="recolith", description=__doc__)
    p.add_argument("command", choices=["generate", "demo", "audit", "benchmark", "train", "cv", "predict", "validate", "package"])
    p.add_argument("folder")
    p.add_argument("--model", help="folder of the stored model; FOLDER/model if left out")
    p.add_argument("--threshold", type=float, help="decision threshold in place of the tuned one")
    p.add_argument("--trees", type=int, default=200)
    p.add_argument("--folds", type=int, default=5, help="held-out folds of cv")
    p.add_argument("--sample-limit", type=int, help="only the first so many references of the prediction")
    p.add_argument("--sample-references", type=int, help="train on a sample of so many references and 40,000 targets besides theirs")
    p.add_argument("--team", default="team", help="name of the package")
    p.add_argument("--skip-validation", action="store_true", help="package files that break the contract too")
    p.add_argument("--check-ids", action="store_true", help="also look for unknown target ids")
    a = p.parse_args(args)
    spark = SparkSession.builder.appName("recolith").getOrCreate()
    where = a.model or f"{a.folder}/model"

    def part(kind: str):
        refs = records.read_targets(spark, f"{a.folder}/{kind}_source1.tsv")  # with its order
        return refs, records.read_targets(spark, *[f"{a.folder}/{kind}_source{k}.tsv" for k in (2, 3)])

    if a.command == "generate":
        print("\n".join(fixtures.write_samples(spark, a.folder)))
        return 0
    if a.command == "demo":
        fixtures.write_samples(spark, a.folder)
        steps = [["train", "--trees", str(a.trees)], ["predict", *(["--threshold", str(a.threshold)] if a.threshold is not None else [])], ["validate"]]
        return max(main([step[0], a.folder, *step[1:]]) for step in steps)
    refs, targets = part("test" if a.command in ("predict", "validate", "package") else "train")
    if a.command == "predict":
        ranked, matched = linkage.predict(model.load(spark, where), refs, targets, threshold=a.threshold, sample_limit=a.sample_limit)
        for path in records.write_results(refs, ranked, matched, a.folder):
            one = path + ".parts"
            second = "candidate_entity_ids" if path.endswith("candidate_pairs") else "matched_entity_ids"
            rows = records.read_tsv(spark, path, records.TRUTH).toDF("source1_entity_id", second)
            records.write_tsv(records.in_file_order(rows, refs), one, single=True)
            records.publish(spark, one, path + ".tsv")
        return 0
    if a.command in ("validate", "package"):
        names = [f"{a.folder}/{n}.tsv" for n in ("matching_results", "candidate_pairs")]
        lines = [records.read_lines(spark, f"{a.folder}/{n}.tsv") if records.exists(spark, f"{a.folder}/{n}.tsv") else None for n in ("matching_results", "candidate_pairs")]
        if lines[0] is None:
            print("matching_results.tsv is missing")
            return 1
        found = validation.validation_report(lines[0], lines[1], refs, targets if a.check_ids else None)
        if a.command == "package":
            try:
                print(report.package(a.team, [n for n, x in zip(names, lines, strict=True) if x is not None], a.folder, None if a.skip_validation else found))
            except ValueError as e:
                print(e)
                return 1
            return 0
        print(report.markdown("Validation", {"findings": found}))
        return 0 if validation.is_valid(found) else 1
    truth = records.read_tsv(spark, f"{a.folder}/train_ground_truth.tsv", records.TRUTH)
    if a.command == "benchmark":
        print(json.dumps(benchmark.run(refs, targets, truth)))
    elif a.command == "train":
        model.save(linkage.train(refs, targets, truth_pairs(truth), model.Settings(trees=a.trees), n_references=a.sample_references), spark, where)
    elif a.command == "cv":
        rows = linkage.evaluate(refs, targets, truth_pairs(truth), model.Settings(trees=a.trees), a.folds)
        print(report.markdown("Cross-validation", {"Folds": rows, "Summary": model.summary(rows)}))
    else:
        every = refs.unionByName(targets).drop("load_seq")
        tables = {"Missing values": audit.null_profile(every), "Lengths": audit.length_stats(every), "Ground truth": audit.truth_cardinality(truth), "Sources": audit.truth_sources(truth), "Countries": audit.country_counts(every), "Regions": audit.region_profile(every)}
        for k in (1, 2, 3):
            tables[f"Ids of source {k}"] = audit.id_audit(every.filter(F.col("entity_id").startswith(f"S{k}-")), k)
        print(report.markdown("Data audit", tables))
    return 0


if __name__ == "__main__":
    sys.exit(main())
