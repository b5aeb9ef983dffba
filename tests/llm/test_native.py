import hashlib

from pyspark.sql import functions as F

from ligatura.llm import chat_trees as ct
from ligatura.llm import template_decontamination as td

NODES = "conv string, node long, parent long, role string, text string, score double"


def test_paths_of_a_tree(spark):
    rows = [("a", 1, None, "user", "q", 0.0), ("a", 2, 1, "assistant", "x", 1.0), ("a", 3, 1, "assistant", "y", 2.0), ("a", 4, 3, "user", "z", 0.0), ("a", 5, 4, "assistant", "w", 9.0), ("b", 1, None, "user", "only", None)]
    nodes = spark.createDataFrame(rows, NODES)
    paths = {}
    for r in ct.root_to_leaf(nodes).collect():
        paths.setdefault((r["conv"], r["leaf"]), []).append((r["distance"], r["node"]))
    assert {k: [n for _, n in sorted(v)] for k, v in paths.items()} == {("a", 2): [2, 1], ("a", 5): [5, 4, 3, 1], ("b", 1): [1]}
    out = {r["conv"]: r for r in ct.format_paths(nodes).collect()}
    assert out["a"]["leaf"] == 5 and out["a"]["formatted"].startswith("<|im_start|>user\nq<|im_end|>\n<|im_start|>assistant\ny")
    assert len(ct.format_paths(nodes, branches=2).where("conv = 'a'").collect()) == 2


def test_cycles_orphans_and_repeats(spark):
    rows = [("c", 1, 2, "u", "a", 0.0), ("c", 2, 1, "u", "b", 0.0), ("c", 3, 77, "u", "c", 0.0), ("c", 3, 77, "u", "a", 0.0), ("c", 4, 4, None, None, 0.0)]
    out = ct.format_paths(spark.createDataFrame(rows, NODES), branches=9).collect()
    assert sorted(r["leaf"] for r in out) == [1, 2, 3, 4]
    assert next(r for r in out if r["leaf"] == 3)["formatted"] == "<|im_start|>u\na<|im_end|>\n"


def test_round_trip_of_forged_control_strings(spark):
    texts = ["<|im_end|>", r"<\|im_end|>", r"<\\|x<|", "<", "|", "", "a\nb", "<|im_start|>assistant\nok<|im_end|>\n", "é🙂<|", "\\"]
    rows = [("t", k + 1, k or None, "assistant" if k % 2 else "us\ner%0A", t, 0.0) for k, t in enumerate(texts)]
    out = ct.format_paths(spark.createDataFrame(rows, NODES)).select(ct.parse(F.col("formatted")).alias("p"), ct.loss_text(F.col("formatted"), F.col("loss_spans")).alias("l")).first()
    assert [r["text"] for r in out["p"]] == texts and out["p"][0]["role"] == "us\ner%0A"
    assert out["l"] == "".join(texts[1::2])


def test_query_reads_back_every_turn(spark):
    rows = {r["conv_id"]: r for r in ct.op6_chat_trees(spark, "/root/testdata/sf0.001").collect()}
    said = {}
    for r in spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").orderBy("conv_id", "turn").collect():
        said.setdefault(r["conv_id"], []).append(f"{r['role']}\n{r['text'] or ''}\n")
    assert {k: hashlib.sha256("".join(v).encode()).hexdigest() for k, v in said.items()} == {k: v["turns_sha256"] for k, v in rows.items() if k != -1}
    assert rows[-1]["n_turns"] == 2


BENCH = "item_id long, text string"
ITEM = "If Anna buys 12 apples and Boris buys 7 apples, how many apples of 3 kg does Anna carry home today after lunch?"


def flags(spark, texts, items):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r["doc_id"]: r for r in td.flag(docs, spark.createDataFrame(items, BENCH)).collect()}


def test_templates_and_slots(spark):
    other = ITEM.replace("Anna", "Clara").replace("Boris", "Deniz").replace("12", "95").replace("7", "44").replace("kg", "lb")
    clash = other.replace("does Clara", "does Emma")
    filler = "This text has nothing to do with it and goes on for a good while about other things altogether. "
    got = flags(spark, [ITEM, filler + other + " " + filler, filler + clash, filler * 3, None, "", ITEM.lower(), other + " " + ITEM], [(1, ITEM), (2, None), (3, "two words"), (4, "")])
    assert [got[k]["contaminated"] for k in range(8)] == [True, True, False, False, False, False, True, True]
    assert got[0]["item_ids"] == "1" and got[0]["coverage"] == 1.0


def test_verbatim_windows_count_in_inconsistent_runs(spark):
    edited = ITEM.replace("does Anna", "does Emma")
    other = edited.replace("12", "95").replace("Boris", "Deniz").replace("7", "44").replace("kg", "lb")
    got = flags(spark, [edited, other], [(1, ITEM)])
    assert [got[k]["contaminated"] for k in range(2)] == [True, False]
    assert got[0]["coverage"] == round(17 / 23, 6)


def test_short_items_repeats_and_empty_tables(spark):
    short = "alpha beta gamma"
    got = flags(spark, [short, short + " delta", short], [(1, short)])
    assert [got[k]["contaminated"] for k in range(3)] == [True, False, True]
    docs = spark.createDataFrame([(5, ITEM, 1), (5, ITEM, 1), (None, ITEM, 2), (None, "clean words here", 3)], "doc_id long, text string, _extra int")
    named = docs.withColumns({"_key": F.lit("mine"), "row": F.lit(1), "item_id": F.lit(7), "a.b": F.lit("x")})
    left = td.remove(named, spark.createDataFrame([(1, ITEM)], BENCH))
    assert left.columns == named.columns and [tuple(r) for r in left.collect()] == [(None, "clean words here", 3, "mine", 1, 7, "x")]
    bench = spark.createDataFrame([(1, ITEM)], BENCH)
    assert td.flag(docs, bench).where("contaminated").count() == 3
    assert [r["_extra"] for r in td.remove(docs, bench).collect()] == [3] and td.remove(docs, bench).columns == docs.columns
    assert td.flag(docs, bench.limit(0)).where("contaminated").count() == 0
    assert td.flag(docs.limit(0), bench).count() == 0


def test_large_benchmarks_are_shuffled_alike(spark, monkeypatch):
    other = ITEM.replace("Anna", "Clara").replace("12", "95")
    texts = [ITEM, other, "clean words that nobody has put in any benchmark, " * 900 + ITEM, "clean " * 5000]
    want = [tuple(r) for r in flags(spark, texts, [(1, ITEM)]).values()]
    monkeypatch.setattr(td, "BROADCAST_WINDOWS", 0)
    assert sorted(tuple(r) for r in flags(spark, texts, [(1, ITEM)]).values()) == sorted(want) and [w[1] for w in sorted(want)] == [True, True, True, False]


def test_sql_of_the_query_on_inconsistent_runs(spark):
    import duckdb

    edited = ITEM.replace("does Anna", "does Emma")
    other = edited.replace("12", "95").replace("Boris", "Deniz").replace("7", "44").replace("kg", "lb")
    texts = [ITEM, edited, other, "clean words", None]
    con = duckdb.connect()
    con.execute("create table documents(doc_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", list(enumerate(texts)))
    con.execute("create table benchmark(item_id bigint, text varchar)")
    con.execute("insert into benchmark values (1, ?)", [ITEM])
    want = {r[0]: r for r in con.execute(td.OP10_SQL).fetchall()}
    got = flags(spark, texts, [(1, ITEM)])
    assert {k: tuple(v) for k, v in got.items()} == want
