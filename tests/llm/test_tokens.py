import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from ligatura.llm import retrieval_packing as rp
from ligatura.llm import token_files as tf
from ligatura.llm import tokens as tk

ODD = [
    "", None, "a \n b  c\n\nd \t x", "  lead", "trail  \n", "don't I'LL x's ", " a  b", "é é", "123 45a1 _x", "<|endoftext|> x", "a\x1cb", "ΟΔΟΣ ος",
    "İstanbul", "a​b", "\n\n\n", "x\r\n y", "日本語 \U0001f642", "foo,bar. (baz) qux!!", "A.B.C, 'tis",
]


@pytest.mark.parametrize("name", list(tk.CUTS))
def test_ids_equal_the_library(name):
    library, cache = Tokenizer.from_file(tk.tokenizer_path(name)), tk.ChunkCache(name, limit=3)
    for _ in range(2):
        ids, bounds = cache.encode(ODD)
        got = [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        assert got == [[*library.encode(t or "", add_special_tokens=False).ids, 2] for t in ODD]


def test_plain_chunks_are_spelled_in_bytes_at_little_cost():
    import time

    slow = lambda chunks: [c.encode().decode("latin-1").translate(tk._BYTES) for c in chunks]
    letters = [chr(c) for c in range(0x41, 0x100) if chr(c).isalpha() and tk._PLAIN.fullmatch(chr(c))]
    odd = [*letters, *(a + b for a in letters for b in letters), " Ã", "Ãé", "Ééà", "!?;", " a"]
    assert all(tk._PLAIN.fullmatch(c) for c in odd)
    assert tk.byte_characters(odd) == slow(odd) and tk.byte_characters(["a"]) == ["a"]
    rng = np.random.default_rng(1)
    words = [" " + "".join(rng.choice(letters[:52], 8)) + "é" * (k % 5 == 0) for k in range(10_000)]  # as in prose: few letters are accented
    took = []
    for way in (slow, tk.byte_characters):
        began = time.process_time()
        for _ in range(5):
            way(words)
        took.append(time.process_time() - began)
    assert took[1] < 0.5 * took[0], took


def test_token_files(spark, odd_docs, no_docs, tmp_path):
    path = f"file://{tmp_path}/t"
    tf.write_tokens(odd_docs.withColumn("ids", odd_docs.source), path)
    rows = sorted(tf.read_tokens(spark, path).collect(), key=lambda r: (r["shard"], r["start_in_shard"]))
    ids = [r["doc_id"] for r in rows]
    assert ids == sorted(ids, key=lambda x: (x is not None, x)) and len(rows) == odd_docs.count()
    assert all(len(r["ids"]) == r["n_tokens"] and r["ids"][-1] == 2 for r in rows)
    tf.write_tokens(no_docs, path + "0")
    assert tf.read_tokens(spark, path + "0").count() == 0


def test_query_offsets(spark):
    rows = sorted(tf.op7_token_files(spark, "/root/testdata/sf0.001").collect(), key=lambda r: r["doc_id"])
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    library, at = Tokenizer.from_file(tk.tokenizer_path("byte_bpe_50k.json")), 0
    for r in rows:
        ids = np.array([*library.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids, 2], "<u4")
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


@pytest.mark.parametrize("shard_tokens", [500, 2_000_000])
def test_packing_is_a_partition(spark, odd_docs, no_docs, shard_tokens):
    assert rp.pack(no_docs).count() == 0
    docs = odd_docs.where("doc_id is not null and doc_id <> 5")
    every = rp.pack(odd_docs.withColumn("offset", odd_docs.source), shard_tokens=shard_tokens).toPandas()
    assert every[every["doc_id"].isna()]["start"].tolist()[:1] == [0] and (every[every["doc_id"] == 5]["start"] == 0).sum() == 2  # null and repeated ids are packed
    twice = every[every["doc_id"] == 5]
    assert twice["length"].sum() == 2 * twice["doc_tokens"].iloc[0]
    pieces = rp.pack(docs.withColumn("offset", docs.source), shard_tokens=shard_tokens).toPandas()
    library = Tokenizer.from_file(tk.tokenizer_path("word_bpe_49k.json"))
    for r in docs.collect():
        ids = np.array([*library.encode(r["text"] or "", add_special_tokens=False).ids, 2], "<u4")
        at = 0
        for q in pieces[pieces["doc_id"] == r["doc_id"]].sort_values("start").itertuples():
            assert q.start == at and q.doc_tokens == len(ids) and q.ids_crc32 == zlib.crc32(ids[at : at + q.length].tobytes())
            at += q.length
        assert at == len(ids)
    for _, w in pieces.sort_values("offset").groupby("sequence_id"):
        assert w["offset"].tolist() == [0, *w["length"].cumsum()[:-1]]
    sizes = pieces.groupby("sequence_id")["length"].sum()
    assert (sizes <= 4096).all() and all(s & (s - 1) == 0 for s in sizes)  # no padding at all


def test_neighbours_follow_their_seed():
    ids = np.array([5, 6, 7, 8, 9, 2, 50, 51, 52, 2, 5, 6, 7, 8, 2, 60, 61, 2], np.uint16)
    bounds = np.array([0, 6, 10, 15, 18])
    assert rp.order_by_retrieval(ids, bounds, 4096)[:2] == [0, 2]
    assert sorted(rp.order_by_retrieval(ids, bounds, 4096)) == [0, 1, 2, 3]


def slow_order(ids, bounds, room):
    """The packing order by BM25 over dictionaries, all terms and all neighbours."""
    from collections import Counter
    from math import log1p

    docs = [Counter(ids[a:b].tolist()) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    size = np.diff(bounds).tolist()
    df, n, mean = Counter(t for d in docs for t in d), len(docs), max(sum(size) / len(size), 1)
    impact = lambda t, k: np.rint(rp.STEPS * log1p((n - df[t] + 0.5) / (df[t] + 0.5)) * docs[k][t] * (rp.K1 + 1) / (docs[k][t] + rp.K1 * (1 - rp.B + rp.B * size[k] / mean)))
    out, seed = [], None
    while len(out) < n:
        if seed is None:
            seed = min((k for k in range(n) if k not in out), key=lambda k: (-size[k], k))
            out.append(seed)
            room -= size[seed]
        if room <= 0:
            room = rp.WINDOW - (-room) % rp.WINDOW
        score = {k: sum(impact(t, k) for t in docs[seed] if t in docs[k]) for k in range(n) if k not in out}
        following = None
        for k in sorted((k for k in score if score[k] > 0), key=lambda k: (-score[k], k)):
            out.append(k)
            room -= size[k]
            if room <= 0:
                following = k if room < 0 else None
                room = rp.WINDOW - (-room) % rp.WINDOW
                break
        seed = following
    return out


@pytest.mark.parametrize(("vocabulary", "window", "common"), [(40, 64, 8), (400, 200, 8), (40, 64, 2), (3000, 100, 1), (100, 4096, 8)])
def test_order_equals_slow_bm25(monkeypatch, vocabulary, window, common):
    monkeypatch.setattr(rp, "WINDOW", window)
    monkeypatch.setattr(rp, "COMMON", common)
    monkeypatch.setattr(rp, "FIRST_RANKED", 3)
    rng = np.random.default_rng(vocabulary)
    sizes = rng.integers(1, 40, 120)
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    ids = (rng.zipf(1.3, bounds[-1]) % vocabulary + 3).astype(np.uint16)
    assert rp.order_by_retrieval(ids, bounds, window) == slow_order(ids, bounds, window)
