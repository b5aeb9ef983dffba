import re
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from ligatura.llm import near_duplicates as nd
from ligatura.llm.components import components
from tests.llm.conftest import DOCS, prose


def slow_sets(rows, k):
    low = lambda s: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)
    out = []
    for r in rows:
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", low(r["text"] or "")) if x]
        out.append(frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else []))
    return out


def slow_components(rows, k, percent=80):
    sets = slow_sets(rows, k)
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, j in combinations(range(len(rows)), 2):
        common = len(sets[i] & sets[j])
        if common and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
            up[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    for i, r in enumerate(rows):
        if r["doc_id"] is not None:
            least[root(i)] = min(least.get(root(i), r["doc_id"]), r["doc_id"])
    return [(r["doc_id"], len(s), least.get(root(i)) if r["doc_id"] is not None else None) for i, (r, s) in enumerate(zip(rows, sets, strict=True))]


def family(seed, n, edits, first):
    import random

    rng, base, out = random.Random(seed), prose(seed, 120).split(), []
    for k in range(n):
        w = list(base)
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(999)}"
        out.append((first + k, " ".join(w), "en", "s", 1))
    return out


def compare(docs, k):
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in nd.duplicate_classes(docs, k).collect()), key=str)
    assert got == sorted(slow_components(docs.collect(), k), key=str)


@pytest.mark.parametrize("k", [4, 5])
def test_brute_force_with_odd_rows(spark, odd_docs, k):
    compare(odd_docs, k)


def test_families_small_and_with_deep_branching(spark, monkeypatch):
    rows = [*family(1, 60, 6, 0), *family(2, 40, 3, 100), *((200 + k, prose(900 + k, 60), "en", "s", 1) for k in range(30))]
    docs = spark.createDataFrame(rows, DOCS).cache()
    compare(docs, 4)
    monkeypatch.setattr(nd, "LEAF", 12)
    monkeypatch.setattr(nd, "LEVELS", 2)
    monkeypatch.setattr(nd, "ROUNDS", ((0, 1), (1, 8)))
    compare(docs, 4)


def test_blocks_of_a_large_node_are_exact(spark, monkeypatch):
    base, rows = prose(5, 60), []
    for k in range(30):  # texts that share half their words, each with one near copy
        own = base + " " + prose(500 + k, 60)
        rows += [(2 * k, own, "en", "s", 1), (2 * k + 1, own + " end", "en", "s", 1)]
    monkeypatch.setattr(nd, "LEAF", 12)
    monkeypatch.setattr(nd, "LEVELS", 1)
    monkeypatch.setattr(nd, "ROUNDS", ((0, 1),))
    monkeypatch.setattr(nd, "with_pivot", lambda nodes: nodes.where("false").select("node", "sid", "n", *nd.BITS, "comp"))
    one = lambda entries, threshold, trees: entries.select(F.lit(1).cast("long").alias("node"), "sid", F.col("n_shingles").alias("n"), *nd.BITS, "comp")
    monkeypatch.setattr(nd, "first_nodes", one)
    compare(spark.createDataFrame(rows, DOCS).cache(), 4)


def test_groups_of_many_shingles_are_compared_by_blocks(spark, monkeypatch):
    rows = [*family(3, 50, 6, 0), *family(4, 30, 5, 100)]
    monkeypatch.setattr(nd, "GROUP_SHINGLES", 700)
    compare(spark.createDataFrame(rows, DOCS).cache(), 4)


def test_links_of_a_group_are_exact():
    rng = np.random.default_rng(4)
    for _ in range(200):
        base = rng.integers(0, 1 << 60, 40)
        sets = [np.unique(np.where(rng.random(40) < 0.12, rng.integers(0, 1 << 60, 40), base)) for _ in range(int(rng.integers(2, 14)))]
        comp = rng.integers(0, 6, len(sets))
        want, got = list(range(6)), list(range(6))
        for i, j in combinations(range(len(sets)), 2):
            common = len(set(sets[i]) & set(sets[j]))
            if 100 * common >= 80 * (len(sets[i]) + len(sets[j]) - common):
                want = [min(want[comp[i]], want[comp[j]]) if x in (want[comp[i]], want[comp[j]]) else x for x in want]
        for i, j in nd.links_of(np.arange(len(sets)), comp, sets, 80):
            common = len(set(sets[i]) & set(sets[j]))
            assert 100 * common >= 80 * (len(sets[i]) + len(sets[j]) - common)
            got = [min(got[comp[i]], got[comp[j]]) if x in (got[comp[i]], got[comp[j]]) else x for x in got]
        assert got == want


def test_a_link_is_not_hidden_by_pairs_that_only_seem_alike(spark):
    """A is alike with B and C by sketch, under the threshold by its full set; B and C are linked."""
    base = [f"w{k}" for k in range(400)]
    a = [*base[:330], *(f"a{k}" for k in range(70))]
    rows = [(1, " ".join(a), "en", "s", 1), (2, " ".join(base), "en", "s", 1), (3, " ".join([*base, "end"]), "en", "s", 1)]
    compare(spark.createDataFrame(rows, DOCS), 4)


def test_alike_within_finds_every_pair():
    rng = np.random.default_rng(6)
    node = np.sort(rng.integers(0, 9, 60))
    sets = [set(rng.integers(0, 40, 30).tolist()) for _ in range(60)]
    hashes = [np.sort(nd.mix(np.array(sorted(s), np.uint64))) for s in sets]
    size = np.array([len(h) for h in hashes])
    bits = nd.two_bits(nd.minwise(np.concatenate(hashes), size)).view(np.uint64)
    comp = rng.integers(0, 30, 60)
    up = nd.alike_within(node, size, comp, bits, 80)
    want = np.arange(60)
    for i, j in combinations(range(60), 2):
        same = sum(int(bits[i, k] ^ bits[j, k]) >> (2 * b) & 3 == 0 for k in range(4) for b in range(32))
        if node[i] == node[j] and comp[i] != comp[j] and 100 * min(size[i], size[j]) >= 80 * max(size[i], size[j]) and same >= nd.least_alike(0.8):
            want[want == max(want[i], want[j])] = min(want[i], want[j])
    assert up.tolist() == want.tolist()


def test_empty_and_extra_columns(spark, no_docs, odd_docs):
    assert nd.duplicate_classes(no_docs).count() == 0 and nd.deduplicate(no_docs).count() == 0
    extra = odd_docs.withColumns({"sid": F.lit("x"), "kept": F.lit(1), "node": F.lit(2), "_id": F.lit("mine"), "_key": F.lit("own"), "key": F.lit(3), "row": F.lit(4), "a.b": F.lit(5)})
    kept = nd.deduplicate(extra)
    assert kept.columns == extra.columns
    rows = kept.collect()
    ids = [r["doc_id"] for r in rows]
    assert 9 not in ids and ids.count(5) == 1 and 1 in ids and 2 in ids and None in ids
    assert {(r["_id"], r["_key"], r["key"], r["row"], r["a.b"]) for r in rows} == {("mine", "own", 3, 4, 5)}


def test_one_row_of_each_class_stays(spark):
    a, b, c = prose(1, 90), prose(2, 90), prose(3, 90)
    rows = [(5, a, "en", "s", 1), (5, a, "en", "s", 1), (5, a + " end", "en", "s", 1), (5, b, "en", "s", 1), (7, b, "en", "s", 1), (8, a, "en", "s", 1), (9, c, "en", "s", 1), (3, c, "en", "s", 1), (None, c, "en", "s", 1)]
    kept = sorted((r["doc_id"] or 0, r["text"]) for r in nd.deduplicate(spark.createDataFrame(rows, DOCS)).collect())
    assert [k[0] for k in kept] == [0, 3, 5, 5] and kept[1][1] == c and {k[1] for k in kept[2:]} <= {a, a + " end", b} and b in {k[1] for k in kept[2:]}


def test_components(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(1, 40)] + [(100, 99), (99, 98), (7, 7), (5, 6)], "a long, b long").repartition(5)
    got = {r["node"]: r["root"] for r in components(edges).collect()}
    assert got == {**dict.fromkeys(range(1, 41), 1), 98: 98, 99: 98, 100: 98}
