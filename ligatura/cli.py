"""Command line of the linkage pipeline: ``python -m ligatura.cli <step> --data-dir D --work-dir W ...``."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ligatura.operators import blocking, evaluate, lexicon, pairs, validate
from ligatura.operators.checkpoint import Checkpoint, Stopwatch
from ligatura.plans.linkage import Workspace
from ligatura.sources import files

STEPS = ("folds", "build-lexicon", "prepare", "blocking", "pair-features", "train", "leakage-check", "select-threshold", "tune-thresholds", "predict", "evaluate", "validate", "subset", "checkpoints", "ablation", "evaluate-policies", "report")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("step", choices=STEPS)
    for name, options in {
        "--data-dir": {}, "--work-dir": {}, "--split": {"choices": ("train", "test"), "default": "train"}, "--folds": {"type": int, "default": 4}, "--scheme": {"choices": ("group", "country"), "default": "group"},
        "--seed": {"default": "7"}, "--min-count": {"type": int, "default": lexicon.MIN_COUNT}, "--df-cap": {"type": int, "default": blocking.DF_CAP}, "--topk": {"type": int, "default": blocking.TOP_K},
        "--min-score": {"type": float, "default": blocking.MIN_SCORE}, "--recall-k": {"type": int, "default": 10}, "--max-rank": {"type": int, "default": blocking.TOP_K}, "--rounds1": {"type": int, "default": 20},
        "--rounds2": {"type": int, "default": 15}, "--drop-features": {"default": ""}, "--no-stage2": {"action": "store_true"}, "--checkpoint": {"default": None}, "--resume": {"action": "store_true"},
        "--method": {"choices": ("train", "density", "prior"), "default": "density"}, "--ratio": {"type": float}, "--class-by": {"default": "country"}, "--min-support": {"type": int, "default": 200},
        "--min-gain": {"type": float, "default": 1e-4}, "--out-dir": {"default": "output"}, "--policy": {"default": None}, "--threshold": {"type": float}, "--decoder": {"choices": ("threshold", "expected_f"), "default": "threshold"},
        "--pred": {}, "--truth": {}, "--source1": {}, "--matching": {}, "--candidate": {}, "--test-dir": {}, "--check-ids": {"action": "store_true"}, "--share": {"type": float, "default": 0.05},
        "--decoy-mult": {"type": float, "default": 1.0}, "--test-share": {"type": float, "default": 0.0}, "--test-decoy-mult": {"type": float, "default": 2.0}, "--canary-rounds": {"type": int, "default": 10}, "--groups": {"default": ""}, "--policies": {"default": ""},
    }.items():
        p.add_argument(name, **options)
    return p


def lists(spark: SparkSession, path: str, column: str):
    return files.read_tsv(spark, path, ("s", column))


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"ligatura {a.step}").getOrCreate()
    work = Workspace(spark, a.data_dir, a.work_dir)
    checkpoint = lambda: Checkpoint.resolve(a.work_dir, a.checkpoint)
    watch = Stopwatch()
    said: object = None
    with watch.stage(a.step):
        if a.step == "folds":
            work.folds(a.folds, a.scheme, a.seed)
        elif a.step == "build-lexicon":
            work.lexicon(a.min_count)
        elif a.step == "prepare":
            work.prepare(a.split)
        elif a.step == "blocking":
            work.block(a.split, a.topk, a.recall_k, a.df_cap, a.min_score)
        elif a.step == "pair-features":
            work.features(a.split, a.max_rank, a.min_score)
        elif a.step == "train":
            said = work.train(a.checkpoint or "default", (a.rounds1, a.rounds2), not a.no_stage2, tuple(x for x in a.drop_features.split(",") if x), a.resume).manifest
        elif a.step == "leakage-check":
            said = work.leakage_check(checkpoint(), a.canary_rounds)
        elif a.step == "select-threshold":
            said = work.select_threshold(checkpoint(), a.method, a.ratio)
        elif a.step == "tune-thresholds":
            said = json.loads(work.tune_thresholds(checkpoint(), a.class_by, a.min_support, a.min_gain).to_json())
        elif a.step == "predict":
            work.predict(checkpoint(), a.out_dir, a.threshold, a.policy, a.decoder)
        elif a.step == "evaluate":
            m = lambda path: lists(spark, path, "m").select("s", F.filter(F.split(F.coalesce("m", F.lit("")), ","), lambda x: x != "").alias("m"))
            per = evaluate.per_entity(m(a.pred), m(a.truth))
            said = {"overall": evaluate.summary(per).first().asDict()}
            if a.source1:
                c = files.read_tsv(spark, a.source1).select(F.col("entity_id").alias("s"), F.coalesce("country", F.lit("")).alias("country"))
                said["per_country"] = {r["country"]: r.asDict() for r in evaluate.summary(per.join(c, "s", "left"), "country").collect()}
        elif a.step == "validate":
            required = files.read_tsv(spark, f"{a.test_dir}/test_source1.tsv").select(F.col("entity_id").alias("s"))
            known = None
            if a.check_ids:
                known = files.union_sources(*(files.read_tsv(spark, f"{a.test_dir}/test_{s}.tsv") for s in files.SOURCES[1:])).select(F.col("entity_id").alias("t"))
            found = [r.asDict() for r in validate.format_findings(spark, a.matching, files.TRUTH_COLUMNS).limit(50).collect()]
            found += [r.asDict() for r in validate.findings(lists(spark, a.matching, "ids"), required, known).limit(50).collect()]
            said = {"errors": found}
            if a.candidate:
                said["outside_candidates"] = validate.outside_candidates(lists(spark, a.matching, "ids"), lists(spark, a.candidate, "ids")).count()
        elif a.step == "subset":
            work.subset(a.out_dir, a.share, a.decoy_mult, a.test_share, a.test_decoy_mult)
        elif a.step == "ablation":
            said = work.ablate(checkpoint(), (a.rounds1, a.rounds2), tuple(a.groups.split(",")) if a.groups else tuple(pairs.ABLATION))
        elif a.step == "evaluate-policies":
            truth = files.explode_ids(files.read_tsv(spark, a.truth or f"{a.data_dir}/test/subset_ground_truth.tsv", ("s", "ids")), "s", "ids")
            said = work.evaluate_policies(checkpoint(), truth, a.policies.split(","))
        elif a.step == "report":
            said = work.report(checkpoint())
        elif a.step == "checkpoints":
            said = Checkpoint.listed(a.work_dir)
    print(json.dumps({"result": said, "profile": watch.rows}, indent=1, default=str))
    failed = (a.step == "leakage-check" and not said["ok"]) or (a.step == "validate" and said["errors"])
    return int(bool(failed))


if __name__ == "__main__":
    sys.exit(main())
