from pyspark.sql import functions as F

import corpus_pipeline
from ligatura.llm.common import written


def test_stages_in_turn(spark):
    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = written(stage(spark, docs, d), name)
        assert out.columns == docs.columns
        docs = out
        counts.append(docs.count())
    assert counts[0] > counts[1] >= counts[2] >= counts[3] == counts[4] > 0
    assert docs.where(F.col("text").rlike(r"[A-Za-z0-9]@mail[0-9]\.example\.com")).count() == 0
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, d)
    assert pieces.select("doc_id").distinct().count() == docs.count()


def test_stages_keep_odd_columns_and_meet_odd_rows(spark, odd_docs, no_docs, tmp_path):
    d = f"file://{tmp_path}"
    odd_docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"), F.lit(0).alias("toxic")).write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(1, "how many apples of three kinds does the farmer carry home today after lunch")], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    named = {"_id": F.lit("mine"), "_key": F.lit("own"), "row": F.lit(1), "kept": F.lit(2), "sid": F.lit(3), "spans": F.lit("s"), "a.b": F.lit("x")}
    for docs in (odd_docs.withColumns(named), no_docs.withColumns(named)):
        n = docs.count()
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = written(stage(spark, docs, d), name)
            assert out.columns == docs.columns and out.count() <= n
            assert {(r["_id"], r["_key"], r["row"], r["kept"], r["sid"], r["spans"], r["a.b"]) for r in out.collect()} <= {("mine", "own", 1, 2, 3, "s", "x")}
        pieces = corpus_pipeline.STAGES[-1][1](spark, docs, d)
        assert (pieces.where("start = 0").count()) == n


def test_workers_hold_nothing_of_other_operators(spark, odd_docs):
    """Python workers are used again and again: the tokenizer's memory of a packing goes when another operator's task begins."""
    from ligatura.llm import common, near_duplicates, retrieval_packing

    def kept(batches):
        import pyarrow as pa

        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([len(common.KEPT)] * b.num_rows, pa.int64())], ["kept"])

    one = odd_docs.coalesce(1)
    asked = lambda: one.select("doc_id").mapInArrow(kept, "kept long").agg(F.max("kept")).first()[0]
    left = []
    for work in (lambda: retrieval_packing.pack(one), lambda: near_duplicates.sketches(one, 5, 0.8)):
        for _ in range(16):  # every worker of this session
            work().count()
        left.append(max(asked() for _ in range(16)))
    assert left[0] > 0 and left[1] == 0
