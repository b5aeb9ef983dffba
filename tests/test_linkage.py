"""The whole linkage pipeline on a small generated data folder."""

import random

from ligatura import cli
from ligatura.operators.checkpoint import Checkpoint
from ligatura.plans.linkage import Workspace
from ligatura.sources import files
from pyspark.sql import functions as F


def write_split(spark, folder, split, n, seed):
    rng = random.Random(seed)
    first, second = "acme blue crown delta eagle fox grand hill iron jade".split(), "tools foods motors books clinic travel paints media".split()
    s, t2, t3, truth = [], [], [], []
    for k in range(n):
        name, street = f"{rng.choice(first)} {rng.choice(second)} {rng.choice(first)}", f"{rng.randrange(1, 99)} {rng.choice(first)} Street, {rng.choice(second)}ville"
        s.append((f"S1-{k}", name.title() + " Inc", street, "US"))
        ids = []
        for j, out in ((2, t2), (3, t3)):
            if rng.random() < 0.6:
                out.append((f"S{j}-{k}", name.title() + rng.choice([" LLC", "", " Inc"]), street.replace("Street", "St"), "US"))
                ids.append(f"S{j}-{k}")
        t2.append((f"S2-9{k:03d}", f"{rng.choice(second)} {rng.choice(first)}", f"{rng.randrange(1, 99)} {rng.choice(second)} Road, Otherton", "US"))
        truth.append((f"S1-{k}", ",".join(ids)))
    for source, rows in zip(files.SOURCES, (s, t2, t3), strict=True):
        files.write_tsv(spark.createDataFrame(rows, files.text_schema(files.RECORD_COLUMNS)), files.source_path(folder, split, source))
    files.write_tsv(spark.createDataFrame(truth, files.text_schema(files.TRUTH_COLUMNS)), f"{folder}/{split}/{split}_ground_truth.tsv")


def test_end_to_end(spark, tmp_path):
    data, work = f"{tmp_path}/data", f"{tmp_path}/work"
    write_split(spark, data, "train", 80, 1)
    write_split(spark, data, "test", 40, 2)
    w = Workspace(spark, data, work)
    w.folds(2)
    w.lexicon()
    for split in ("train", "test"):
        w.prepare(split)
        w.block(split)
        w.features(split)
    ck = w.train("one", (4, 3))
    assert Checkpoint.resolve(work).name == "one" and files.read_json(f"{work}/blocking_recall.json")["3"] > 0.8
    audit = w.leakage_check(ck)
    assert audit["groups_in_one_fold"] == audit["pairs_in_one_fold"] == audit["pairs_scored_twice"] == 0
    w.select_threshold(ck)
    w.predict(ck, f"{tmp_path}/out")
    lists = files.read_tsv(spark, f"{tmp_path}/out/matching_results", files.TRUTH_COLUMNS)
    assert lists.count() == 40
    truth = files.read_tsv(spark, f"{data}/test/test_ground_truth.tsv", files.TRUTH_COLUMNS)
    both = lists.join(truth.toDF("source1_entity_id", "true"), "source1_entity_id").where(F.coalesce("matched_entity_ids", F.lit("")) == F.coalesce("true", F.lit("")))
    assert both.count() >= 30
    assert cli.main(["checkpoints", "--work-dir", work, "--data-dir", data]) == 0
    assert cli.main(["validate", "--work-dir", work, "--data-dir", data, "--test-dir", f"{data}/test", "--matching", f"{tmp_path}/out/matching_results", "--check-ids"]) == 0
