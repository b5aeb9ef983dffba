import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ligatura.llm import quality_classifier as qc
from ligatura.llm import quality_rules as qr
from ligatura.llm.docstats import BASE, base_counts
from ligatura.llm.textkit import Words, blocks


def slow_base(text):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    return [len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)]


TEXTS = ["", None, " \n", "a b c a b c", "é ü|x\n\nsame line\nsame line \nsame line", "x\ty\x0bz\r\nx\ty\x0bz", "a a a a a", "日本語 # <b> 日本語", "one two", "w " * 5000]


def test_base_counts_match_definition():
    column = pa.array(TEXTS, pa.string())
    for limit in (1, 50, 1 << 20):
        got = np.concatenate([base_counts(Words(buf, bounds)) for _, buf, bounds in blocks(column, limit)])
        assert got.tolist() == [slow_base(t) for t in TEXTS]


def labels(spark, docs):
    return docs.where("doc_id >= 20").select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"), F.lit(0).alias("toxic"))


def test_rules_edge_cases(spark, odd_docs, no_docs):
    forest = qr.fit(odd_docs, labels(spark, odd_docs))
    rows = qr.judge(odd_docs, forest).collect()
    assert len(rows) == odd_docs.count()
    assert all(r["base_failed"] for r in rows if r["n_words"] < 50) and not any(r["kept"] for r in rows if r["base_failed"])
    assert qr.judge(no_docs, forest).count() == 0
    none = qr.fit(odd_docs, labels(spark, no_docs))
    assert all(r["kept"] != r["base_failed"] for r in qr.judge(odd_docs, none).collect())
    extra = odd_docs.withColumns({"score": F.lit("x"), "kept": F.lit(None).cast("string"), "x": F.lit(1)})
    kept = qr.filter_documents(extra, none)
    assert kept.schema == extra.schema and {r["doc_id"] for r in kept.collect()} >= {20, 21}


def test_forest_is_monotone_and_learns():
    rng = np.random.default_rng(0)
    x = rng.random((600, 3))
    y = ((x[:, 0] + 0.2 * rng.random(600)) < 0.5).astype(float)
    forest = qr.fit_forest(x, y, np.array([-1, 0, 1]))
    assert ((forest.score(x) >= 0.5) == (y == 1)).mean() > 0.9
    grid = np.tile(x[:50], (20, 1, 1))
    grid[:, :, 0] = np.linspace(0, 1, 20)[:, None]
    assert (np.diff(np.stack([forest.score(g) for g in grid]), axis=0) <= 1e-12).all()


def test_pool_and_classifier(spark, odd_docs, no_docs):
    assert qc.pool(np.ones(4), np.array([0.1, 0.5, 0.3, 0.9])).tolist() == pytest.approx([0.1, 0.4, 0.4, 0.9])
    stats = qc.with_statistics(odd_docs).cache()
    model = qc.fit(stats, labels(spark, odd_docs))
    scores = qc.score(stats, model).collect()
    assert len(scores) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in scores)
    assert {r["score"] for r in qc.score(stats, qc.fit(stats, labels(spark, no_docs))).collect()} == {1.0}
    assert qc.score(qc.with_statistics(no_docs), model).count() == 0


def test_held_out_accuracy(spark):
    out = qc.op1_quality_classifier(spark, "/root/testdata/sf0.01")
    known = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    m = out.join(known, "doc_id").where("held_out").toPandas()
    assert (m["predicted"] == m["quality"]).mean() > 0.95


def test_base_fields_on_all_documents(spark):
    got = {r["doc_id"]: [r[c] for c in BASE] for r in qr.op5_quality_rules(spark, "/root/testdata/sf0.001").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    assert got == {r["doc_id"]: slow_base(r["text"]) for r in docs}
