"""The linkage pipeline over a data folder of tab-separated sources, stage by stage, each a table in the work folder.

train split: folds -> lexicon -> prepare -> blocking -> pair features -> cross-fitted models -> calibration -> thresholds
test split:  prepare -> blocking -> pair features -> scores -> policy -> id lists
"""

from __future__ import annotations

import json

from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ligatura.functions import textnorm as tn
from ligatura.operators import blocking, calibrate, decide, evaluate, folds, isolation, lexicon, model, pairs
from ligatura.operators.checkpoint import Checkpoint
from ligatura.operators.relational import hash_range
from ligatura.sources import files


class Workspace:
    """Tables of one data folder and work folder."""

    def __init__(self, spark: SparkSession, data_dir: str, work_dir: str):
        self.spark, self.data, self.work = spark, data_dir, work_dir

    def table(self, split: str, name: str) -> str:
        return f"{self.work}/{split}/{name}"

    def read(self, split: str, name: str) -> DataFrame:
        return self.spark.read.parquet(self.table(split, name))

    def truth(self) -> DataFrame:
        return files.read_truth(self.spark, f"{self.data}/train/train_ground_truth.tsv")

    # ------------------------------------------------------------------ stages

    def folds(self, k: int = folds.FOLDS, scheme: str = "group", seed: str = folds.SEED) -> DataFrame:
        rec = files.read_records(self.spark, self.data, "train")
        s = rec.where("src = 1").withColumn("group_key", tn.group_key(tn.norm_name("business_name", "country")["n_core"], "country"))
        s = folds.country_folds(s) if scheme == "country" else folds.group_folds(s, k, seed)
        out = folds.record_folds(s, rec.where("src <> 1"), self.truth())
        groups = s.select(F.col("entity_id").alias("id"), "group_key")
        files.write_table(out.join(groups, "id", "left"), self.table("train", "folds"))
        return self.read("train", "folds")

    def lexicon(self, least: int = lexicon.MIN_COUNT) -> None:
        rec = files.read_records(self.spark, self.data, "train").select("entity_id", "business_name", "business_address")
        fold = self.read("train", "folds").select("id", "fold")
        t, s = rec.toDF("t", "t_name", "t_addr"), rec.toDF("s", "s_name", "s_addr")
        both = self.truth().join(t, "t").join(s, "s").join(fold.withColumnRenamed("id", "s"), "s")
        script = both.where(tn.is_indic("t_name") | tn.is_indic("t_addr"))
        names = lexicon.name_alignments(script)
        met, _ = lexicon.address_cooccurrences(script)
        for kind, counts in (("names", names), ("addresses", met)):
            files.write_table(counts, self.table("train", f"counts_{kind}"))
            files.write_table(lexicon.fold_lexicons(counts, fold.where("fold >= 0").select("fold"), least), self.table("train", f"lexicon_{kind}"))

    def prepare(self, split: str) -> DataFrame:
        """All records normalised; a training record uses the lexicon that its own fold had no part in."""
        rec = files.read_records(self.spark, self.data, split)
        entries = [self.read("train", f"lexicon_{kind}") for kind in ("names", "addresses")] if files.exists(self.table("train", "lexicon_names")) else None
        normal = lambda df, fold: tn.normalize(df, "business_name", "business_address", "country", tuple(lexicon.as_map(e, fold) for e in entries) if entries else None)
        if split != "train":
            out = normal(rec, None)
        else:
            known = rec.join(self.read("train", "folds").withColumnRenamed("id", "entity_id"), "entity_id", "left")
            numbers = [r["fold"] for r in self.read("train", "folds").select("fold").distinct().collect()]  # a handful
            out = None
            for k in sorted(numbers):
                part = normal(known.where(F.coalesce("fold", F.lit(-1)) == k), k if k >= 0 else None)
                out = part if out is None else out.unionByName(part)
        files.write_table(out, self.table(split, "records"))
        return self.read(split, "records")

    def block(self, split: str, k: int = blocking.TOP_K, recall_k: int = 10, df_cap: int = blocking.DF_CAP, min_score: float = blocking.MIN_SCORE) -> DataFrame:
        rec = self.read(split, "records")
        f = blocking.explode_features(rec)
        src = rec.select(F.col("entity_id").alias("id"), "src")
        both = f.join(src, "id")
        ix = blocking.Index(both.where("src = 1").drop("src"), both.where("src <> 1").drop("src"), rec.where("src = 1")).stored(self.table(split, "weights"))
        found = ix.retrieve(max(k, recall_k) if split == "train" else k, df_cap, min_score)
        files.write_table(found, self.table(split, "retrieved"))
        found = self.read(split, "retrieved")
        if split == "train":
            files.write_json({r["k"]: r["recall"] for r in blocking.recall_at_k(found, self.truth(), recall_k).collect()}, f"{self.work}/blocking_recall.json")
        files.write_table(ix.cosines(found.where(F.col("rank") < k)), self.table(split, "candidates"))
        return self.read(split, "candidates")

    def features(self, split: str, max_rank: int = blocking.TOP_K, min_score: float = blocking.MIN_SCORE) -> DataFrame:
        c = blocking.tighten(self.read(split, "candidates"), max_rank, min_score)
        files.write_table(pairs.features(c, self.read(split, "records"), self.truth() if split == "train" else None), self.table(split, "pairs"))
        return self.read(split, "pairs")

    def train(self, name: str = "default", rounds: tuple[int, int] = (20, 15), stage2: bool = True, drop: tuple[str, ...] = (), resume: bool = False) -> Checkpoint:
        """Cross-fitted models, out-of-fold scores, calibration, thresholds: a checkpoint."""
        ck = Checkpoint(self.work, name).create({"rounds": list(rounds), "stage2": stage2, "drop": list(drop)}, files.fingerprint(f"{self.data}/train"), resume)
        f = self.read("train", "folds").select("id", "fold")
        ready = folds.pair_folds(self.read("train", "pairs"), f).withColumns({c: F.lit(0.0) for c in drop})
        files.write_table(ready, ck.path("ready"))
        ready = self.spark.read.parquet(ck.path("ready"))
        numbers = sorted(r["fold"] for r in f.where("fold >= 0").select("fold").distinct().collect())
        hn = self.read("train", "records").select(F.col("entity_id").alias("id"), "a_hn")
        if not ck.done("oof"):
            scored, first, second = model.two_stages(ready, hn, numbers, rounds, stage2)
            files.write_table(scored, ck.path("oof_raw"))
            for stage, fitted in (("stage1", first), ("stage2", second)):
                for k, m in zip(numbers, fitted, strict=False):
                    m.write().overwrite().save(ck.path(f"{stage}_fold{k}"))
            ck.mark("oof", importance=model.importance(first[0], pairs.STAGE_1)[:20])
        oof = self.spark.read.parquet(ck.path("oof_raw"))
        cal = calibrate.fit_platt(oof, "p2", "label")
        files.write_table(oof.select("t", "s", "label", "s_fold", "t_fold", "p1", "p2", calibrate.apply(cal, "p2").alias("p")), ck.path("oof"))
        full = model.classifier(rounds[0]).fit(model.vectors(ready, pairs.STAGE_1))
        full.write().overwrite().save(ck.path("stage1"))
        if stage2:
            contextual = pairs.stage2_context(self._with_numbers(oof.select("t", "s", "p1"), "train")).drop("t_hn", "s_hn", "p1")
            both = oof.select("t", "s", "label", "p1", *pairs.STAGE_1).join(contextual, ["t", "s"])
            model.classifier(rounds[1]).fit(model.vectors(both, pairs.STAGE_2)).write().overwrite().save(ck.path("stage2"))
        files.write_json(cal, ck.path("calibration.json"))
        links, ents = self.links(ck)
        best = decide.best_threshold(decide.sweep(links, ents)).first()
        files.write_json({"threshold": best["threshold"], "macro_f05": best["macro_f05"], "stage2": stage2}, ck.path("model.json"))
        ck.mark("train", calibration=cal, threshold=best["threshold"])
        ck.publish()
        return ck

    def _with_numbers(self, scored: DataFrame, split: str) -> DataFrame:
        hn = self.read(split, "records").select("entity_id", F.coalesce("a_hn", F.lit("")).alias("hn"))
        return scored.join(hn.toDF("t", "t_hn"), "t").join(hn.toDF("s", "s_hn"), "s")

    def links(self, ck: Checkpoint, class_by: str = "") -> tuple[DataFrame, DataFrame]:
        """The written link table (with class keys) and entity table (with folds) of a checkpoint's out-of-fold scores."""
        rec = self.read("train", "records")
        oof = self.spark.read.parquet(ck.path("oof")).select("t", "s", "p")
        links = decide.class_keys(decide.link_table(oof, self.truth()), rec.withColumnRenamed("entity_id", "id"), class_by)
        path = ck.path(f"links_{'_'.join(decide.parse_class_by(class_by)) or 'all'}")
        files.write_table(links, path)
        ents = decide.entity_table(rec.where("src = 1").select(F.col("entity_id").alias("s")), self.truth())
        fold = self.read("train", "folds").select(F.col("id").alias("s"), "fold")
        return self.spark.read.parquet(path), ents.join(fold, "s", "left")

    def select_threshold(self, ck: Checkpoint, method: str = "density", ratio: float | None = None) -> float:
        rec = {s: self.read(s, "records").select("src") for s in ("train", "test")}
        r = ratio if ratio is not None else decide.decoy_ratio(rec["train"], rec["test"], self.truth()).first()["ratio"]
        links, ents = self.links(ck)
        choice = decide.transfer_thresholds(links, ents.select("s", "nt"), self.spark.read.parquet(ck.path("oof")), self.truth(), r)
        for name, t in choice.items():
            self._save(ck, decide.ThresholdPolicy(t, name=f"global_{name}", fit={"ratio": r}))
        files.write_json({**files.read_json(ck.path("model.json")), "threshold": choice[method], "method": method, "ratio": r}, ck.path("model.json"))
        return choice[method]

    @staticmethod
    def _save(ck: Checkpoint, policy: decide.ThresholdPolicy) -> str:
        path = ck.path("thresholds", f"{policy.name.replace('|', '_')}.json")
        files.write_json(json.loads(policy.to_json()), path)
        return path

    @staticmethod
    def _policy(path: str) -> decide.ThresholdPolicy:
        return decide.ThresholdPolicy.from_json(json.dumps(files.read_json(path)))

    def tune_thresholds(self, ck: Checkpoint, class_by: str, min_support: int = 200, min_gain: float = 1e-4) -> decide.ThresholdPolicy:
        """A per-class policy if it beats the global one on held-out folds, else the global one."""
        links, ents = self.links(ck, class_by)
        name = "|".join(decide.parse_class_by(class_by))
        numbers = sorted(r["fold"] for r in ents.select("fold").distinct().collect())
        scores = decide.nested_comparison(links.withColumn(f"key_{name}", F.col("key")), ents, {name: decide.parse_class_by(class_by)}, numbers, min_support=min_support)
        chosen = decide.select_configuration(scores, min_gain)
        plain = ents.select("s", "nt")
        policy = decide.fit_policy(links, plain, decide.parse_class_by(class_by) if chosen != "global" else [], min_support=min_support)
        policy.fit["nested"] = scores
        files.write_json({"policy": self._save(ck, policy)}, ck.path("selected.json"))
        ck.log({"class_by": class_by, "nested": scores, "chosen": chosen})
        return policy

    def score_test(self, ck: Checkpoint) -> DataFrame:
        """(t, s, p) of the test pairs, written once and reused."""

        def build() -> DataFrame:
            p = self.read("test", "pairs")
            first = model.probability(GBTClassificationModel.load(ck.path("stage1")), model.vectors(p, pairs.STAGE_1), "p1").drop("features")
            if files.read_json(ck.path("model.json"))["stage2"]:
                both = pairs.stage2_context(self._with_numbers(first, "test")).drop("t_hn", "s_hn")
                first = model.probability(GBTClassificationModel.load(ck.path("stage2")), model.vectors(both, pairs.STAGE_2), "p2")
            else:
                first = first.withColumn("p2", F.col("p1"))
            return first.select("t", "s", "p1", "p2", calibrate.apply(files.read_json(ck.path("calibration.json")), "p2").alias("p"))

        made_of = {"model": ck.manifest["created"], "trained": files.fingerprint(ck.folder, "model.json"), "pairs": files.fingerprint(self.table("test", "pairs"), ".parquet")}
        return files.cached_table(self.spark, self.table("test", f"scores_{ck.name}"), build, made_of)

    def predict(self, ck: Checkpoint, out_dir: str, threshold: float | None = None, policy_file: str | None = None, decoder: str = "threshold") -> DataFrame:
        """Links of the test split and the two id-list files."""
        scored = self.score_test(ck)
        rec = self.read("test", "records")
        selected = ck.path("selected.json")
        if threshold is not None:
            policy = decide.ThresholdPolicy(threshold)
        elif policy_file or files.exists(selected):
            policy = self._policy(policy_file or files.read_json(selected)["policy"])
        else:
            policy = decide.ThresholdPolicy(files.read_json(ck.path("model.json"))["threshold"])
        if decoder == "expected_f":
            links = decide.expected_f_decode(scored)
        else:
            keyed = decide.class_keys(scored, rec.withColumnRenamed("entity_id", "id"), policy.class_by)
            links = decide.argmax_per_key(keyed, ["t"], "p", ["s"]).where(F.col("p") >= policy.column()).select("t", "s", "p")
        s = rec.where("src = 1").select(F.col("entity_id").alias("s")).orderBy("s")
        files.write_tsv(files.id_lists(s, links, "matched_entity_ids").orderBy("source1_entity_id"), f"{out_dir}/matching_results")
        files.write_tsv(files.id_lists(s, scored, "candidate_entity_ids").orderBy("source1_entity_id"), f"{out_dir}/candidate_pairs")
        return links

    def leakage_check(self, ck: Checkpoint, canary_rounds: int = 10) -> dict:
        """Group, pair and lexicon isolation, one score a pair, no feature that gives the label away, nothing learned from shuffled labels."""
        f = self.read("train", "folds")
        s = f.where("group_key is not null").select("group_key", "fold")
        out = {r["check"]: r["violations"] for r in folds.isolation_audit(s, f, self.truth()).collect()}
        oof = self.spark.read.parquet(ck.path("oof"))
        out["pairs_scored_twice"] = oof.groupBy("t", "s").count().where("count > 1").count()
        out["true_pairs_across_folds"] = oof.where("label = 1 and s_fold <> t_fold").count()
        for kind in ("names", "addresses"):
            lexicons, counts = (self.table("train", f"{name}_{kind}") for name in ("lexicon", "counts"))
            if files.exists(lexicons):
                out[f"lexicon_{kind}_leaks"] = isolation.lexicon_leaks(self.spark.read.parquet(counts), self.spark.read.parquet(lexicons)).count()
        ready = self.spark.read.parquet(ck.path("ready"))
        audit = evaluate.leakage_audit(ready, list(pairs.STAGE_1))
        out["features_that_leak"] = audit.where("suspicious").count()
        numbers = sorted(r["s_fold"] for r in ready.select("s_fold").distinct().collect())  # a handful
        auc = isolation.canary_auc(ready, pairs.STAGE_1, numbers, canary_rounds)
        out["learned_from_shuffled_labels"] = int(not auc < isolation.CANARY_LIMIT)
        found = {"canary_auc": auc, "cross_fold_share": oof.agg(evaluate.cross_fold_share(oof)).first()[0], "strongest": {r["feature"]: r["auc"] for r in evaluate.strongest(audit).collect()}}
        return out | {"ok": not any(out.values())} | found

    def ablate(self, ck: Checkpoint, rounds: tuple[int, int] = (20, 15), groups: tuple[str, ...] = tuple(pairs.ABLATION)) -> list[dict]:
        """The model without each group of features: rows in ``ablation.json`` and as Markdown."""
        ready = self.spark.read.parquet(ck.path("ready"))
        numbers = sorted(r["s_fold"] for r in ready.select("s_fold").distinct().collect())  # a handful
        rec = self.read("train", "records")
        entities = rec.where("src = 1").select(F.col("entity_id").alias("s"))
        rows = model.ablation(ready, rec.select(F.col("entity_id").alias("id"), "a_hn"), numbers, self.truth(), entities, {g: pairs.ABLATION[g] for g in groups}, rounds)
        files.write_json(rows, f"{self.work}/ablation.json")
        files.write_json(evaluate.markdown(rows), f"{self.work}/ablation.md.json")
        return rows

    def evaluate_policies(self, ck: Checkpoint, truth: DataFrame, policy_files: list[str]) -> list[dict]:
        """Every policy on the labelled hold-out in the test split, the first as the base."""
        rec = self.read("test", "records").withColumnRenamed("entity_id", "id")
        entities = decide.entity_table(rec.where("src = 1").select(F.col("id").alias("s")), truth)
        policies = {p.name: p for p in map(self._policy, policy_files)}
        rows = [r.asDict() for r in evaluate.holdout_policies(self.score_test(ck).select("t", "s", "p"), truth, entities, rec, policies).collect()]  # a row a policy
        files.write_json(rows, f"{self.work}/holdout_policies.json")
        ck.log({"kind": "holdout", "results": rows})
        return rows

    def report(self, ck: Checkpoint) -> str:
        """What is known of a run, as Markdown."""
        m = files.read_json(ck.path("model.json"))
        links, ents = self.links(ck)
        numbers = sorted(r["fold"] for r in ents.select("fold").distinct().collect())  # a handful
        per_fold = [r.asDict() for r in evaluate.per_fold_best(links, ents, m["threshold"], numbers).orderBy("fold").collect()]
        at = decide.metrics_at(links, ents.select("s", "nt"), m["threshold"]).first().asDict()
        parts = [f"# Run {ck.name}", evaluate.markdown([at]), "## Per fold", evaluate.markdown(per_fold)]
        for title, path in (("Retrieval", f"{self.work}/blocking_recall.json"), ("Ablation", f"{self.work}/ablation.json"), ("Policies on the hold-out", f"{self.work}/holdout_policies.json")):
            if files.exists(path):
                found = files.read_json(path)
                parts += [f"## {title}", evaluate.markdown(found if isinstance(found, list) else [{"k": k, "recall": v} for k, v in found.items()])]
        return "\n\n".join(parts)

    def subset(self, out_dir: str, share: float, decoy_mult: float = 1.0, test_share: float = 0.0, test_decoy_mult: float = 2.0) -> None:
        """A smaller data folder: whole name groups of entities, all their true records, and a share of decoys.

        With ``test_share`` also a labelled hold-out as its test split: name groups and decoys that training hasn't, with
        ``test_decoy_mult`` times the decoys.
        """
        rec, truth = files.read_records(self.spark, self.data, "train"), self.truth()
        key = F.concat_ws("|", F.lower("business_name"), "country")
        decoys = rec.where("src <> 1").join(truth.select(F.col("t").alias("entity_id")), "entity_id", "left_anti")
        end = share * decoy_mult
        plan = [("train", (0.0, share), (0.0, end), "train_ground_truth")]
        if test_share:
            plan.append(("test", (share, share + test_share), (end, end + test_share * test_decoy_mult), "subset_ground_truth"))
        for split, own, drawn, name in plan:
            s = hash_range(rec.where("src = 1"), key, *own)
            ids = s.select(F.col("entity_id").alias("s"))
            matched = truth.join(ids, "s", "left_semi").select(F.col("t").alias("entity_id"))
            kept = s.select("entity_id").unionByName(matched).unionByName(hash_range(decoys, "entity_id", *drawn).select("entity_id"))
            chosen = rec.join(kept.distinct(), "entity_id", "left_semi")
            for k, source in enumerate(files.SOURCES):
                files.write_tsv(chosen.where(F.col("src") == k + 1).select(*files.RECORD_COLUMNS), files.source_path(out_dir, split, source))
            files.write_tsv(files.id_lists(ids, truth, "matched_entity_ids"), f"{out_dir}/{split}/{name}.tsv")
