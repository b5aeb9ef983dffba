"""Blocking, decisions, calibration, files and registry against plain definitions."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ligatura.operators import blocking, calibrate, decide, evaluate, folds, isolation, lexicon, relational, validate
from ligatura.operators.checkpoint import Checkpoint
from ligatura.sources import files


def test_blocking_against_definition(spark):
    rng = random.Random(3)
    rows = [(f"S{1 + k % 2}-{k}", "AB"[k // 2 % 2], b, f"{b}:{rng.randrange(12)}") for k in range(40) for b in blocking.BLOCKS for _ in range(4)]
    f = spark.createDataFrame(sorted(set(rows)), "id string, country string, block string, feature string")
    entities = f.where("id like 'S1-%'").select("id", "country").distinct()
    ix = blocking.Index(f.where("id like 'S1-%'"), f.where("id like 'S2-%'"), entities)
    got = {(r["t"], r["s"]): round(r["score"], 9) for r in ix.retrieve(2, 1000, 0.0).collect()}
    data, ents = sorted(set(rows)), {(r["id"], r["country"]) for r in entities.collect()}
    n = {c: sum(x == c for _, x in ents) for c in "AB"}
    df = {}
    for i, c, b, x in data:
        if i.startswith("S1"):
            df[c, b, x] = df.get((c, b, x), 0) + 1
    w = {(i, c, b, x): math.log1p(n.get(c, 0) / df[c, b, x]) if (c, b, x) in df else math.log1p(n.get(c, 0)) for i, c, b, x in data}
    norm = {}
    for (i, _, b, _), v in w.items():
        norm[i, b] = norm.get((i, b), 0) + v * v
    want = {}
    for t in {i for i, *_ in data if i.startswith("S2")}:
        score = {}
        for (i, c, b, x), v in w.items():
            if i == t:
                for s, _ in ents:
                    if (s, c, b, x) in w:
                        score[s] = score.get(s, 0) + v * w[s, c, b, x] / math.sqrt(norm[t, b] * norm[s, b])
        for s in sorted(score, key=lambda s: (-round(score[s], 9), s))[:2]:
            want[t, s] = round(score[s], 9)
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-8 for k in want)


def links_of(rng, n=300):
    ents, links = [], []
    for s in range(n):
        nt = rng.randrange(3)
        ents.append((f"s{s:04d}", nt))
        links += [(f"t{s}_{k}", f"s{s:04d}", round(rng.betavariate(9, 1.2), 4), True, False, "AB"[s % 2]) for k in range(nt)]
        links += [(f"d{s}_{k}", f"s{s:04d}", round(rng.random() * (0.35 if s % 2 else 0.75), 4), False, True, "AB"[s % 2]) for k in range(rng.randrange(3))]
    return ents, links


@pytest.fixture(scope="module")
def decision(spark):
    ents, links = links_of(random.Random(5))
    return (
        spark.createDataFrame(links, "t string, s string, p double, tp boolean, decoy boolean, key string").cache(),
        spark.createDataFrame(ents, "s string, nt long").cache(), ents, links,
    )


def slow_macro(ents, links, thr, weight=1.0):
    total = 0.0
    for s, nt in ents:
        mine = [x for x in links if x[1] == s and x[2] >= (thr(x) if callable(thr) else thr)]
        tp = sum(x[3] for x in mine)
        np_ = sum(1.0 if x[3] or not x[4] else weight for x in mine)
        if nt == 0:
            total += np_ == 0
        elif tp:
            pr, re = tp / np_, tp / nt
            total += 1.25 * pr * re / (0.25 * pr + re)
    return total / len(ents)


@pytest.mark.parametrize("weight", [1.0, 2.0])
def test_sweep_equals_single_points(decision, weight):
    links, ents, e, li = decision
    rows = {r["threshold"]: r for r in decide.sweep(links, ents, decoy_weight=weight).collect()}
    assert list(sorted(rows)) == decide.GRID
    for t in (0.05, 0.34, 0.35, 0.5, 0.74, 0.98):
        assert rows[t]["macro_f05"] == pytest.approx(slow_macro(e, li, t, weight)) and rows[t]["links"] == sum(x[2] >= t for x in li)
        assert decide.metrics_at(links, ents, t, weight).first()["macro_f05"] == pytest.approx(rows[t]["macro_f05"])


def test_class_policy_beats_global(decision):
    links, ents, e, li = decision
    policy = decide.fit_policy(links, ents, ["country"], decide.GRID[::4], min_support=10, passes=2)
    assert set(policy.thresholds) == {"A", "B"} and policy.scheme == "per_class"
    at = lambda x: policy.thresholds[x[5]]
    assert slow_macro(e, li, at) >= slow_macro(e, li, policy.default) - 1e-12
    few = decide.fit_policy(links, ents, ["country"], decide.GRID[::8], min_support=10_000)
    assert set(few.thresholds.values()) == {few.default}
    again = decide.ThresholdPolicy.from_json(policy.to_json())
    assert again == policy
    again.unseen = "max"
    assert again.fallback() == max(policy.thresholds.values())
    with pytest.raises(ValueError):
        decide.parse_class_by("nothing")


def test_assign_breaks_ties_by_id(spark):
    p = spark.createDataFrame([("t", "b", 0.9), ("t", "a", 0.9), ("u", "c", 0.2)], "t string, s string, p double")
    assert [tuple(r) for r in decide.assign(p, 0.5).collect()] == [("t", "a", 0.9)]


def test_best_prefix_maximises_expected_f():
    rng = random.Random(2)
    for _ in range(30):
        q = sorted((rng.random() for _ in range(rng.randint(1, 6))), reverse=True)
        value = []
        for k in range(len(q) + 1):
            v = 0.0
            for bits in itertools.product((0, 1), repeat=len(q)):
                pr = math.prod(p if b else 1 - p for p, b in zip(q, bits, strict=True))
                a, n = sum(bits[:k]), sum(bits)
                v += pr * (float(n == 0) if k == 0 else 1.25 * a / (0.25 * n + k))
            value.append(v)
        assert value[decide.best_prefix(q)] == pytest.approx(max(value))


def test_calibration(spark):
    rng = np.random.default_rng(1)
    y = (rng.random(8000) < 0.25).astype(int)
    z = np.where(y, 2.0, -2.0) + rng.normal(0, 2, 8000)
    df = spark.createDataFrame([(i, float(1 / (1 + math.exp(-2.0 * v - 0.5))), int(w)) for i, (v, w) in enumerate(zip(z, y, strict=True))], "i long, p double, y int").cache()
    platt = calibrate.fit_platt(df, "p", "y")
    assert 0.3 < platt["a"] < 0.8 and platt["log_loss"] < platt["identity_log_loss"]
    iso = calibrate.fit_isotonic(df, "p", "y", ["i"], 100)
    assert iso["y"] == sorted(iso["y"])
    out = df.select("y", calibrate.apply(platt, "p").alias("a"), calibrate.apply(iso, "p").alias("b"))
    assert calibrate.metrics(out, "a", "y").first()["ece"] < calibrate.metrics(df, "p", "y").first()["ece"]
    assert out.agg(F.avg("b")).first()[0] == pytest.approx(y.mean(), abs=0.02)
    apart = spark.createDataFrame([(1e-7, 0)] * 50 + [(0.99999, 1)] * 50, "p double, y int")
    assert abs(calibrate.fit_platt(apart, "p", "y")["a"]) < 1e3
    odds = spark.createDataFrame([(0.5,), (0.9,)], "p double").select(calibrate.shift_prior("p", 0.5)).collect()
    assert [r[0] for r in odds] == pytest.approx([1 / 3, 0.45 / 0.55])


def test_relational(spark):
    df = spark.createDataFrame([("a", 1.0, 1), ("a", 3.0, 2), ("a", 3.0, 3), ("b", 2.0, 4)], "k string, v double, i int")
    assert {r["k"]: r["i"] for r in relational.argmax_per_key(df, ["k"], "v", ["i"]).collect()} == {"a": 2, "b": 4}
    assert {r["i"]: r["x"] for r in df.select("i", relational.second_best("v", ["k"]).alias("x")).collect()} == {1: 3.0, 2: 3.0, 3: 3.0, 4: None}
    ranks = relational.ranked(spark.range(100).withColumn("x", (F.col("id") * 37) % 100), [F.asc("x")], "r").collect()
    assert all(r["r"] == r["x"] + 1 for r in ranks)
    plan = relational.top_per_key(df, ["k"], [F.desc("v")], 1)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_folds_and_lexicon(spark):
    ents = spark.createDataFrame([(f"S1-{k}", f"g{k // 2}", "A") for k in range(20)], "entity_id string, group_key string, country string")
    s = folds.group_folds(ents)
    assert s.groupBy("group_key").agg(F.countDistinct("fold").alias("n")).where("n > 1").count() == 0
    truth = spark.createDataFrame([("S1-3", "S2-1")], "s string, t string")
    f = {r["id"]: r["fold"] for r in folds.record_folds(s, spark.createDataFrame([("S2-1",), ("S2-9",)], "entity_id string"), truth).collect()}
    assert f["S2-1"] == f["S1-3"] and f["S2-9"] == -1
    pairs = spark.createDataFrame([(k % 2, "राम मार्केटिंग", "Ram Marketing", "दिल्ली", "Delhi") for k in range(4)], "fold int, t_name string, s_name string, t_addr string, s_addr string")
    lex = lexicon.fold_lexicons(lexicon.name_alignments(pairs), pairs.select("fold"))
    assert {r["value"] for r in lex.where("fold is null").collect()} == {"ram", "marketing"} and lex.where("fold = 0").count() == 2
    met, n = lexicon.address_cooccurrences(pairs)
    assert met.first()["value"] == "delhi" and n.agg(F.sum("n")).first()[0] == 4


def test_files_round_trip(spark, tmp_path):
    rows = [("S1-1", 'say "hi"', None, "US"), ("S1-2", "  lead", "x,y", "")]
    files.write_tsv(spark.createDataFrame(rows, files.text_schema(files.RECORD_COLUMNS)), f"{tmp_path}/a.tsv", one_file=True)
    assert [tuple(r) for r in files.read_tsv(spark, f"{tmp_path}/a.tsv").orderBy("entity_id").collect()] == [rows[0], ("S1-2", "  lead", "x,y", None)]
    s = spark.createDataFrame([("S1-1",), ("S1-2",)], "s string")
    lists = files.id_lists(s, spark.createDataFrame([("S1-1", "S3-2"), ("S1-1", "S2-1"), ("S1-1", "S2-1")], "s string, t string"), "ids")
    assert {r[0]: r[1] for r in lists.collect()} == {"S1-1": "S2-1,S3-2", "S1-2": ""}
    assert files.explode_ids(lists, "source1_entity_id", "ids").count() == 2
    found = {(r["check"], r["id"]) for r in validate.findings(spark.createDataFrame([("S1-1", "S2-1,S2-1,S1-5,Q")], "s string, ids string"), s).collect()}
    assert found == {("repeated_id", "S1-1"), ("self_match", "S1-5"), ("wrong_prefix", "Q"), ("missing_entity", "S1-2")}
    calls = []
    build = lambda: calls.append(1) or s
    for _ in range(2):
        assert files.cached_table(spark, f"{tmp_path}/c", build).count() == 2
    assert len(calls) == 1


def test_checkpoints(tmp_path):
    ck = Checkpoint(str(tmp_path), "one").create({"a": 1}, {})
    ck.mark("oof", x=2)
    ck.publish()
    assert Checkpoint.resolve(str(tmp_path)).done("oof") and Checkpoint.listed(str(tmp_path)) == ["one"]
    with pytest.raises(FileExistsError):
        Checkpoint(str(tmp_path), "one").create({"a": 1}, {})
    with pytest.raises(ValueError):
        Checkpoint(str(tmp_path), "one").create({"a": 2}, {}, resume=True)


def test_evaluation(spark):
    truth = spark.createDataFrame([("a", ["x", "y"]), ("b", []), ("c", None), ("d", ["z"])], "s string, m array<string>")
    pred = spark.createDataFrame([("a", ["x"]), ("c", ["q"])], "s string, m array<string>")
    r = evaluate.macro_f(pred, truth).first()
    assert r["macro_f05"] == pytest.approx((1.25 * 0.5 / (0.25 + 0.5) + 1 + 0 + 0) / 4) and r["singleton_acc"] == 0.5


def test_overlap_queries_meet_every_pair_that_shares_a_word(spark):
    from ligatura.plans import relational_queries as rq

    d = "/root/testdata/sf0.001"
    words = lambda t: t.lower().split(" ")
    docs, items = (spark.read.parquet(f"{d}/{n}.parquet").collect() for n in ("documents", "benchmark"))
    want = {}
    for x in docs:
        for y in items:
            a, b = words(x["text"]), words(y["text"])
            if c := len(set(a) & set(b)):
                want[x["doc_id"], y["item_id"]] = (c, len(set(b)) - c, round(c / max(len(a) + len(b) - c, 1), 6))
    assert any(i % 40 != j % 40 for i, j in want)
    assert {(r["doc_id"], r["item_id"]): (r["common"], r["missing"]) for r in rq.list_overlap(spark, d).collect()} == {k: v[:2] for k, v in want.items()}
    got = rq.jaccard_features(spark, d).collect()
    assert len(got) == len(want) and all(abs(r["jacc"] - want[r["doc_id"], r["item_id"]][2]) < 2e-6 for r in got)


def test_format_findings(spark, tmp_path):
    def of(text):
        (tmp_path / "f.tsv").write_text(text)
        return sorted(tuple(r) for r in validate.format_findings(spark, f"{tmp_path}/f.tsv", ("a", "b")).collect())

    assert of("a\tb\n1\t2\n") == [] and [c for c, _ in of("")] == ["empty_file"]
    assert of("a,b\n1,2\n") == [("not_tab_separated", "a,b")] and of("a\tc\n") == [("wrong_header", "a\tc")]
    assert of("a\tb\n1\n1\t2\t3\n") == [("wrong_field_count", "1"), ("wrong_field_count", "1\t2\t3")]


def test_leakage_audit_equals_single_aucs(spark):
    import random

    rng = random.Random(4)
    rows = [(float(rng.randint(0, 5)), rng.random(), int(rng.random() < 0.4)) for _ in range(300)]
    df = spark.createDataFrame([(a, b, y, float(y)) for a, b, y in rows], "a double, b double, label int, c double")
    got = {r["feature"]: (r["auc"], r["suspicious"]) for r in evaluate.leakage_audit(df, ["a", "b", "c"]).collect()}
    for f in "abc":
        want = relational.rank_sum_auc(df, f, "label").first()["auc"]
        assert abs(got[f][0] - want) < 1e-9 and got[f][1] == (f == "c")


def test_shuffled_labels_keep_each_fold_and_teach_nothing(spark):
    import random

    rng = random.Random(5)
    rows = [(f"t{k}", f"s{k}", k % 3, (k + 1) % 3, int(k % 4 == 0), float(k % 4), rng.random()) for k in range(600)]
    df = spark.createDataFrame(rows, "t string, s string, s_fold int, t_fold int, label int, x double, y double").cache()
    mixed = isolation.shuffled(df)
    count = lambda d: {r["s_fold"]: r["n"] for r in d.groupBy("s_fold").agg(F.sum("label").alias("n")).collect()}
    assert count(mixed) == count(df) and mixed.count() == 600
    assert mixed.where("label = 1 and x = 0").count() < 90  # the label no longer follows the feature
    assert isolation.canary_auc(df, ("x", "y"), [0, 1, 2], 2) < isolation.CANARY_LIMIT + 0.05


def test_lexicon_leaks(spark):
    counts = spark.createDataFrame([(0, "a"), (1, "a"), (0, "b"), (1, "c")], "fold int, key string")
    lexicons = spark.createDataFrame([(0, "a"), (0, "b"), (0, "c"), (None, "b")], "fold int, key string")
    assert [tuple(r) for r in isolation.lexicon_leaks(counts, lexicons).collect()] == [(0, "b")]


def test_subset_has_a_disjoint_labelled_holdout(spark, tmp_path):
    from ligatura.plans.linkage import Workspace
    from ligatura.sources import files
    from tests.test_linkage import write_split

    write_split(spark, f"{tmp_path}/data", "train", 300, 3)
    Workspace(spark, f"{tmp_path}/data", f"{tmp_path}/work").subset(f"{tmp_path}/out", 0.4, 1.0, 0.3, 1.5)
    ids = {split: {r["entity_id"] for r in files.read_records(spark, f"{tmp_path}/out", split).collect()} for split in ("train", "test")}
    assert ids["train"] and ids["test"] and not ids["train"] & ids["test"]
    truth = files.read_truth(spark, f"{tmp_path}/out/test/subset_ground_truth.tsv")
    assert {r["t"] for r in truth.collect()} | {r["s"] for r in truth.collect()} <= ids["test"] and truth.count() > 0


def test_markdown():
    assert evaluate.markdown([{"a": 1.0, "b": None}, {"a": 0.5, "b": 2}], 2) == "| a | b |\n| - | - |\n| 1.00 | - |\n| 0.50 | 2 |\n"
    assert evaluate.markdown([]) == ""


@pytest.mark.parametrize("cells", [1, 1 << 23])
def test_retrieval_sums_pairs_within_chunks(spark, monkeypatch, cells):
    for name, value in (("CHUNK", 7), ("PRODUCTS", 20), ("CELLS", cells)):
        monkeypatch.setattr(blocking, name, value)
    rng = random.Random(6)
    rows = sorted({(f"S{1 + k % 2}-{k}", "AB"[k // 2 % 2], b, f"{b}:{rng.randrange(9)}") for k in range(60) for b in blocking.BLOCKS for _ in range(3)})
    f = spark.createDataFrame(rows, "id string, country string, block string, feature string")
    entities = f.where("id like 'S1-%'").select("id", "country").distinct()
    ix = blocking.Index(f.where("id like 'S1-%'"), f.where("id like 'S2-%'"), entities)
    pairs = ix.retrieve(2, 8, 0.3)
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [t#" not in plan and "FlatMapGroupsInArrow" in plan  # no table of all pairs
    s = {(r["country"], r["block"], r["feature"], r["id"]): r["w"] for r in ix.s.where("df <= 8").collect()}
    score = {}
    for r in ix.t.where("df between 1 and 8").collect():
        for (*key, i), w in s.items():
            if key == [r["country"], r["block"], r["feature"]]:
                score.setdefault(r["id"], {}).setdefault(i, 0.0)
                score[r["id"]][i] += w * r["w"]
    want = {(t, i): (k, round(x, 9)) for t, of in score.items() for k, (i, x) in enumerate(sorted(of.items(), key=lambda e: (-round(e[1], 9), e[0]))[:2]) if round(x, 9) >= 0.3}
    assert {(r["t"], r["s"]): (r["rank"], round(r["score"], 9)) for r in pairs.collect()} == want and want


def _corpus(spark, folder):
    """Documents of few words, with copies, as a data folder."""
    rng = random.Random(7)
    texts = [" ".join(rng.choice("abcdefgh") * 3 for _ in range(rng.randint(3, 14))) for _ in range(60)]
    rows = [(k, texts[k % 60], "en" if k % 60 % 2 else "fr") for k in range(119)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(f"{folder}/documents.parquet")
    return str(folder)


def _pairs_made_once(spark, d):
    from ligatura.plans import views

    return views.pairs(spark, d).storageLevel.useMemory and views.truth(views.records(spark, d)).storageLevel.useMemory


def test_calibration_under_shift_makes_pairs_once(spark, tmp_path):
    from ligatura.plans import decision_queries as dq
    from ligatura.plans import views

    d = _corpus(spark, tmp_path)
    got = {r["scenario"]: r["brier"] for r in dq.calibration_under_shift(spark, d).collect()}
    assert _pairs_made_once(spark, d) and set(got) == {"train_distribution", "matched_x0.5", "source_2_only", "indic_only"}
    true = {(r["t"], r["s"]) for r in views.truth(views.records(spark, d)).collect()}
    rows = [(r["t"], r["p"] - ((r["t"], r["s"]) in true)) for r in views.pairs(spark, d).collect()]
    for name, part in (("train_distribution", rows), ("source_2_only", [r for r in rows if r[0][1] == "2"])):
        assert got[name] == pytest.approx(sum(e * e for _, e in part) / len(part))


def test_calibration_under_shift_equals_the_populations(spark):
    rng = random.Random(8)
    pairs = [(f"t{k}", f"s{j}", rng.randint(0, 20) / 20, 2 + k % 2, k % 5 == 0) for k in range(200) for j in range(3)]
    df = spark.createDataFrame(pairs, "t string, s string, p double, t_src int, t_indic boolean")
    truth = spark.createDataFrame([(f"t{k}", f"s{k % 4}") for k in range(0, 200, 2)], "t string, s string")
    names = ["matched_x0.5", "singletons_x2", "source_2_only", "source_4_only", "indic_only"]
    shifted = evaluate.calibration_under_shift(df, truth, names)
    plan = shifted._jdf.queryExecution().optimizedPlan().toString()
    assert sum("Join LeftOuter" in line for line in plan.splitlines()) == 2  # pairs to truth, names to metrics
    got = {r["scenario"]: (r["log_loss"], r["brier"], r["ece"]) for r in shifted.collect()}
    for name in ["train_distribution", *names]:
        p, t = (df, truth) if name == "train_distribution" else evaluate.scenario(name, df, truth)
        true, rows = {(r["t"], r["s"]) for r in t.collect()}, p.collect()
        if not rows:
            assert got[name] == (None, None, None)
            continue
        py = [(r["p"], float((r["t"], r["s"]) in true)) for r in rows]
        bins = {}
        for x, y in py:
            bins.setdefault(min(math.floor(x * 15), 14), []).append((x, y))
        clip = lambda x: min(max(x, calibrate.EPS), 1 - calibrate.EPS)
        want = (
            -sum(y * math.log(clip(x)) + (1 - y) * math.log(1 - clip(x)) for x, y in py) / len(py), sum((x - y) ** 2 for x, y in py) / len(py),
            sum(abs(sum(x for x, _ in b) - sum(y for _, y in b)) for b in bins.values()) / len(py),
        )
        assert got[name] == pytest.approx(want)


def test_threshold_transfer_makes_pairs_once(spark, tmp_path):
    from ligatura.plans import decision_queries as dq

    d = _corpus(spark, tmp_path)
    got = {r["method"]: r["threshold"] for r in dq.threshold_transfer(spark, d).collect()}
    assert _pairs_made_once(spark, d)
    p, t, e, links, ents = dq._all(spark, d)
    for method, weight in (("train", 1.0), ("density", 2.0)):
        assert got[method] == decide.best_threshold(decide.sweep(links, ents.select("s", "nt"), dq.GRID, weight)).first()["threshold"]
    assert set(got) == {"train", "density", "prior"}


def test_ranks_hold_beyond_the_sample_of_range_partitioning(spark):
    n = 800_000
    df = spark.range(n).select("id", (F.xxhash64("id") % 5000).alias("x"), (F.col("id") % 2).alias("y"))
    ranks = relational.ranked(df, [F.asc("x"), F.asc("id")], "r").agg(F.min("r"), F.max("r"), F.countDistinct("r")).first()
    assert tuple(ranks) == (1, n, n)
    bins = {r["bin"]: r["w"] for r in relational.equal_frequency_bins(df, "x", "y", ["id"], 10).collect()}
    assert bins == dict.fromkeys(range(10), n // 10)
    cum = relational.ranked_cumulative(df.withColumn("n", F.lit(1)), ["x", "id"], "n").agg(F.max("cum"), F.countDistinct("cum")).first()
    assert tuple(cum) == (n, n)


def test_leakage_audit_makes_features_once(spark):
    made = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def feature(x):
        made.add(1)
        return float(x % 7)

    df = spark.range(200).select((F.col("id") % 2).alias("label"), feature("id").alias("a"))
    assert [r["feature"] for r in evaluate.strongest(evaluate.leakage_audit(df, ["a"])).collect()] == ["a"]
    assert made.value == 200


def test_cosines_meet_both_records_without_a_row_a_feature(spark, tmp_path):
    rng = random.Random(8)
    rows = sorted({(f"S{1 + k % 2}-{k}", "AB"[k // 2 % 2], b, f"{rng.randrange(9)}") for k in range(60) for b in blocking.BLOCKS for _ in range(3) if (k + len(b)) % 5})
    rows.append(("S2-alone", "A", "name", "of no entity"))
    f = spark.createDataFrame(rows, "id string, country string, block string, feature string")
    ix = blocking.Index(f.where("id like 'S1-%'"), f.where("id like 'S2-%'"), f.where("id like 'S1-%'").select("id", "country").distinct())
    ids = {side: sorted({r[0] for r in rows if r[0].startswith(side)}) for side in ("S1", "S2")}
    given = [(t, s, 0.5) for t in [*ids["S2"], "S2-unknown"] for s in [*ids["S1"], "S1-unknown"]]
    pairs = spark.createDataFrame(given, "t string, s string, score double")
    w = {}
    for r in ix.s.unionByName(ix.t).collect():
        w.setdefault(r["id"], {})[r["block"], r["country"], r["feature"]] = r["w"]
    want = {
        (t, s): tuple(sum(x * w.get(s, {}).get(key, 0.0) for key, x in w.get(t, {}).items() if key[0] == b) for b in blocking.BLOCKS) for t, s, _ in given
    }
    for index in (ix, ix.stored(f"{tmp_path}/weights")):
        out = index.cosines(pairs)
        joins = [line for line in out._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join " in line]
        assert not any("feature#" in line and ("w_t#" in line or "s#" in line) for line in joins) and any("(t#" in line for line in joins)
        got = {(r["t"], r["s"]): tuple(r[f"cos_{b}"] for b in blocking.BLOCKS) for r in out.collect()}
        assert len(got) == len(given)
        assert all(got[key] == pytest.approx(x, abs=1e-12) for key, x in want.items()) and any(any(x) for x in want.values())
        assert all(got[t, s] == (0.0, 0.0, 0.0) for t, s, _ in given if "unknown" in t + s or t == "S2-alone")


def test_features_shuffle_pairs_by_each_side_once(spark, tmp_path):
    from ligatura.plans import decision_queries as dq

    d = _corpus(spark, tmp_path)
    plan = dq.pair_features(spark, d)._jdf.queryExecution().executedPlan().toString()
    assert len(plan) < 200_000  # the driver holds it several times
    assert "regexp_replace" not in plan.split("InMemoryRelation")[0]  # records aren't normalised for each use
