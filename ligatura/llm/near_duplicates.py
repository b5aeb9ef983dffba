r"""Operator 3: near-duplicate classes by a chosen-path set similarity join over minwise sketches.

Every text becomes its set of word shingles (64-bit hashes, all of them). Equal sets collapse into one entry first, by
partial aggregation; an entry carries two bits of each of ``COORDINATES`` minwise values, 32 bytes. ``TREES`` independent
trees branch over the entries: a node picks one coordinate, and with probability 1/threshold - 1 a second, and each entry
goes to the child of its minwise value there, so that a pair at the threshold meets in about one child of a node on
average, whatever the depth. Node rows are slim: node, entry, size, component and those 32 bytes.

Nodes are compared exhaustively, in numpy, on the 32 bytes. What is alike across components forms groups, and only for
the entries of groups are texts read again: each group gets its full shingle sets and every pair of it that is in two
components is decided on them, so nothing is joined before it is certain. A group that was decided in one tree isn't
decided again in another. Trees are looked at in ``ROUNDS``; after each the components are known, and nodes and pairs
within one component fall away, so a large group of copies costs a few links an entry. A node of more than ``LEAF``
entries is first dealt into blocks of half that size, each with the node's pivot; what is still in more than one component
then branches again, and after ``LEVELS`` is compared block by block. All sets are treated alike, whatever their size.

Recall: alikeness is asked for ``DEVIATIONS`` standard deviations under what a pair at the threshold has on average; such
a pair fails that test in 4 of 100,000 cases, and is missed by all of 16 trees with probability about 1e-12 at depth 1 and
1e-5 at depth 4.

Nulls and edge cases: null or empty text has an empty set and is a component of its own; a text of fewer than k words is
one shingle; a very long text is one set like any other; equal sets are linked; a null doc_id has a null component and is
kept; rows that repeat a doc_id are rows of their own, each in the component of its own text; an empty table gives no
rows; other columns are ignored by the join and kept by ``deduplicate``, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ligatura.llm.common import afresh, arrow_rows, joined_evenly, scratch, table, written
from ligatura.llm.components import components, unite
from ligatura.llm.textkit import Words, blocks, mix

COORDINATES = 128
TREES = 16
#: Trees that are looked at together: the first finds most links, so that the later ones have little left.
ROUNDS = ((0, 1), (1, 4), (4, TREES))
LEAF = 4000
LEVELS = 8
DEVIATIONS = 4.0
BROADCAST_IDS = 1_000_000
#: Rows of an Arrow batch with texts or sets, and with numbers only; rows compared at once; shingles of a group.
TEXT_ROWS, SLIM_ROWS = 500, 20_000
COMPARED_ROWS = 100_000
GROUP_SHINGLES = 2_000_000
BITS = ["s0", "s1", "s2", "s3"]
SLIM = "node long, sid long, n long, s0 long, s1 long, s2 long, s3 long"
_FIVES = np.uint64(0x5555555555555555)
_rng = np.random.default_rng(20240229)
_A = _rng.integers(1, 1 << 32, COORDINATES, dtype=np.uint32) | np.uint32(1)
_B = _rng.integers(1, 1 << 32, COORDINATES, dtype=np.uint32)


def set_ids(text: np.ndarray, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(sizes, 64-bit ids) of the ``n`` sets given as rows (text, hash) by text; the id of an empty set is 0."""
    size = np.bincount(text, minlength=n)
    ids, has = np.zeros(n, np.uint64), size > 0
    if has.any():
        ids[has] = mix(np.add.reduceat(mix(hashes), (np.cumsum(size) - size)[has]) + size[has].astype(np.uint64))
    return size, ids.view(np.int64)


def minwise(hashes: np.ndarray, size: np.ndarray) -> np.ndarray:
    """(n, COORDINATES) minwise values of the sets of ``size``; those of an empty set are the largest."""
    values, has = np.full((len(size), COORDINATES), 0xFFFFFFFF, np.uint32), size > 0
    if has.any():
        first = (np.cumsum(size) - size)[has]
        short = (hashes >> np.uint64(32)).astype(np.uint32)
        for k in range(COORDINATES):
            values[has, k] = np.minimum.reduceat(short * _A[k] + _B[k], first)
    return values


def two_bits(values: np.ndarray) -> np.ndarray:
    """Two bits of each minwise value, 32 values in an integer: (n, 4)."""
    bits = ((values * np.uint32(0x9E3779B1)) >> np.uint32(30)).astype(np.uint64).reshape(len(values), -1, 32)
    return np.bitwise_or.reduce(bits << np.arange(0, 64, 2, dtype=np.uint64), axis=2).view(np.int64)


def least_alike(threshold: float) -> int:
    """How many of the COORDINATES two-bit values entries must share to be called alike."""
    share = threshold + (1 - threshold) / 4
    return int(COORDINATES * share - DEVIATIONS * (COORDINATES * share * (1 - share)) ** 0.5)


def _picks(parent: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The coordinate that each node picks, a second one, and whether it takes that too."""
    pick = mix(parent)
    one = (pick % np.uint64(COORDINATES)).astype(np.int64)
    step = ((pick >> np.uint64(8)) % np.uint64(COORDINATES - 1)).astype(np.int64) + 1
    return one, (one + step) % COORDINATES, (pick >> np.uint64(20)).astype(np.float64) / float(1 << 44) < 1 / threshold - 1


def _child(parent: np.ndarray, coordinate: np.ndarray, value: np.ndarray) -> np.ndarray:
    key = value.astype(np.uint64) | (coordinate.astype(np.uint64) << np.uint64(32))
    return mix(parent * np.uint64(0x9E3779B97F4A7C15) + mix(key)).view(np.int64)


def children(parent: np.ndarray, values: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, child node) for entries in nodes ``parent`` with minwise ``values``."""
    one, two, again = _picks(parent, threshold)
    rows = np.concatenate([np.arange(len(parent)), np.flatnonzero(again)])
    coordinate = np.concatenate([one, two[again]])
    return rows, _child(parent[rows], coordinate, values[rows, coordinate])


def roots(threshold: float, trees: range) -> list[tuple[np.uint64, int]]:
    """(root node, coordinate) of the first branchings of some trees."""
    parent = mix(np.array(trees, np.uint64) + np.uint64(1))
    one, two, again = _picks(parent, threshold)
    return [(p, int(c)) for k, p in enumerate(parent) for c in (one[k], two[k])[: 1 + int(again[k])]]


# -------------------------------------------------------------- entries and nodes


def sketches(docs: DataFrame, k: int, threshold: float) -> DataFrame:
    """doc_id, key (hash of the text), n_shingles, sid (null for an empty set), the two bits and v0, v1, ...: the minwise
    values that the first branchings of all trees ask for."""
    asked = [c for _, c in roots(threshold, range(TREES))]
    names = [f"v{i}" for i in range(len(asked))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, buf, bounds in blocks(batch.column("text")):
                n = len(bounds) - 1
                text, hashes = Words(buf, bounds, lower=True).shingles(k)
                size, ids = set_ids(text, hashes, n)
                values = minwise(hashes, size)
                columns = [pa.array(size.astype(np.int64)), pa.array(ids, mask=size == 0), *map(pa.array, two_bits(values).T), *(pa.array(values[:, c].view(np.int32)) for c in asked)]
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(first, n) for c in ("doc_id", "key")), *columns], ["doc_id", "key", "n_shingles", "sid", *BITS, *names])

    schema = "doc_id long, key long, n_shingles long, sid long, " + ", ".join(f"{c} long" for c in BITS) + "".join(f", {c} int" for c in names)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("key"), "text").mapInArrow(afresh(run), schema)


def placed(rows: DataFrame, comp: DataFrame | None) -> DataFrame:
    """``rows`` with their entry's component, the entry itself as far as no link is known."""
    if comp is None:
        return rows.withColumn("comp", F.col("sid"))
    return rows.join(comp.select(F.col("node").alias("sid"), F.col("root").alias("comp")), "sid", "left").withColumn("comp", F.coalesce("comp", "sid"))


def first_nodes(entries: DataFrame, threshold: float, trees: range) -> DataFrame:
    """The node rows of the first level of some trees, with comp."""
    skipped = len(roots(threshold, range(trees.start)))
    chosen = roots(threshold, trees)
    names = [f"v{skipped + i}" for i in range(len(chosen))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            same = [batch.column(c) for c in ("sid", "n", *BITS, "comp")]
            for (parent, coordinate), name in zip(chosen, names, strict=True):
                value = batch.column(name).to_numpy().view(np.uint32)
                node = _child(np.full(len(value), parent), np.full(len(value), coordinate), value)
                yield pa.RecordBatch.from_arrays([pa.array(node), *same], ["node", "sid", "n", *BITS, "comp"])

    return entries.select("sid", F.col("n_shingles").alias("n"), *BITS, "comp", *names).mapInArrow(afresh(run), SLIM + ", comp long")


def on_texts(asked: DataFrame, docs: DataFrame, k: int, body: Callable, schema: str) -> DataFrame:
    """``body(sids, lists, text, hashes, size)`` on the texts of some entries.

    ``asked`` is a written table of rows (sid, doc_id, item): a text is read once for all its items.
    """
    few = asked.count() <= BROADCAST_IDS  # some 50 MB at most; beyond it both sides are shuffled
    lists = asked.groupBy("sid", "doc_id").agg(F.collect_list("item").alias("items"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(lists) if few else lists, "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, buf, bounds in blocks(batch.column("text")):
                n = len(bounds) - 1
                text, hashes = Words(buf, bounds, lower=True).shingles(k)
                size, ids = set_ids(text, hashes, n)
                sids = batch.column("sid").slice(first, n).to_numpy()
                right = np.flatnonzero((ids == sids) & (size > 0))  # a doc_id may have other texts as well
                if len(right):
                    yield body(right, sids, batch.column("items").slice(first, n), hashes, size)

    return texts.select("sid", "items", "text").mapInArrow(afresh(run), schema)


def _repeated(right: np.ndarray, items: pa.ListArray) -> tuple[np.ndarray, pa.Array]:
    """(row, item) of all items of some rows."""
    chosen = items.take(pa.array(right))
    return np.repeat(right, np.diff(chosen.offsets.to_numpy())), chosen.flatten()


def branch(nodes: DataFrame, entries: DataFrame, docs: DataFrame, k: int, threshold: float) -> DataFrame:
    """The next level of ``nodes`` (node, sid)."""
    asked = written(nodes.select("sid", F.col("node").alias("item")).join(entries.select("sid", "doc_id"), "sid"), "branching")

    def body(right: np.ndarray, sids: np.ndarray, items: pa.ListArray, hashes: np.ndarray, size: np.ndarray) -> pa.RecordBatch:
        values = minwise(hashes, size)
        row, parent = _repeated(right, items)
        which, child = children(parent.to_numpy().view(np.uint64), values[row], threshold)
        row = row[which]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (child, sids[row], size[row].astype(np.int64), *two_bits(values)[row].T)], ["node", "sid", "n", *BITS])

    return on_texts(asked, docs, k, body, SLIM)


def _block(n: Column) -> Column:
    return F.pmod(F.xxhash64("sid", "node"), n.cast("long"))


def in_blocks(nodes: DataFrame) -> DataFrame:
    """Large nodes as nodes that hold every two of a node's blocks."""
    n = F.ceil(F.col("size") / (LEAF // 2))
    spread = nodes.withColumns({"own": _block(n), "other": F.explode(F.sequence(F.lit(0).cast("long"), n - 1))})
    return spread.withColumn("node", F.xxhash64("node", F.least("own", "other"), F.greatest("own", "other"))).select("node", "sid", "n", *BITS)


def with_pivot(nodes: DataFrame) -> DataFrame:
    """Large nodes as their blocks, each with the node's pivot, the entry of least hash."""
    n = F.ceil(F.col("size") / (LEAF // 2))
    same = ["sid", "n", *BITS, "comp"]
    pivot = nodes.groupBy("node", "size").agg(F.min(F.struct(F.xxhash64("node", "sid").alias("h"), *same)).alias("p"))
    pivots = pivot.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), n - 1))).select(F.xxhash64("node", "block").alias("node"), *(F.col(f"p.{c}").alias(c) for c in same))
    return nodes.withColumn("node", F.xxhash64("node", _block(n))).select("node", *same).unionByName(pivots)


# --------------------------------------------------------------------- comparison


def alike_within(node: np.ndarray, n: np.ndarray, comp: np.ndarray, bits: np.ndarray, percent: int) -> np.ndarray:
    """For rows sorted by node, the least row that each is alike with, directly or through others of its node.

    Every pair of a node that is in two components and whose sizes allow a link is compared: rows at distance 1, then 2,
    and so on, all nodes at once.
    """
    up, least = np.arange(len(node)), least_alike(percent / 100)
    d, here = 1, np.flatnonzero(node[:-1] == node[1:])
    while len(here):
        there = here + d
        ask = (up[here] != up[there]) & (comp[here] != comp[there]) & (100 * np.minimum(n[here], n[there]) >= percent * np.maximum(n[here], n[there]))
        a, b = here[ask], there[ask]
        if len(a):
            x = bits[a] ^ bits[b]
            near = COORDINATES - np.bitwise_count((x | (x >> np.uint64(1))) & _FIVES).sum(axis=1) >= least
            unite(up, a[near], b[near])
        d += 1
        here = here[here + d < len(node)]
        here = here[node[here] == node[here + d]]
    return up


def groups_of(node: np.ndarray, sid: np.ndarray, n: np.ndarray, comp: np.ndarray, bits: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(group, row) of entries that are alike, for rows sorted by node; the group's name tells its entries.

    A group of more than GROUP_SHINGLES shingles becomes groups of every two of its blocks, which are of half that size.
    """
    none = np.zeros(0, np.int64)
    if not len(node):
        return none, none
    first = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
    mixed = np.minimum.reduceat(comp, first) != np.maximum.reduceat(comp, first)
    kept = np.flatnonzero(np.repeat(mixed, np.diff(np.append(first, len(node)))))
    if not len(kept):
        return none, none
    label = alike_within(node[kept], n[kept], comp[kept], bits[kept], percent)
    order = np.argsort(label, kind="stable")
    count = np.bincount(label)
    order = order[count[label[order]] > 1]
    if not len(order):
        return none, none
    rows, label = kept[order], label[order]
    first = np.flatnonzero(np.concatenate([[True], label[1:] != label[:-1]]))
    size = np.diff(np.append(first, len(rows)))
    name = mix(np.add.reduceat(mix(sid[rows].view(np.uint64)), first) + size.astype(np.uint64))
    total = np.add.reduceat(n[rows], first)
    group = np.repeat(name, size)
    heavy = np.repeat(total > GROUP_SHINGLES, size)
    out = [(group[~heavy].view(np.int64), rows[~heavy])]
    for g in np.flatnonzero(total > GROUP_SHINGLES):
        own = rows[first[g] : first[g] + size[g]]
        block = (np.cumsum(n[own]) - n[own]) // (GROUP_SHINGLES // 2)
        for i in range(int(block[-1]) + 1):
            for j in range(i + (block[-1] > 0), int(block[-1]) + 1):
                both = own[(block == i) | (block == j)]
                out.append((np.full(len(both), mix(name[g : g + 1] + np.uint64((i << 20) + j))[0]).view(np.int64), both))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def groups(nodes: DataFrame, percent: int) -> DataFrame:
    """(group, sid, comp): entries whose sketches are alike across components, by node."""
    names = ["node", "sid", "n", "comp", *BITS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(rows: list[np.ndarray]) -> pa.RecordBatch:
            node, sid, n, comp, *bits = rows
            group, at = groups_of(node, sid, n, comp, np.stack(bits, axis=1).view(np.uint64), percent)
            return pa.RecordBatch.from_arrays([pa.array(x) for x in (group, sid[at], comp[at])], ["group", "sid", "comp"])

        held: list[list[np.ndarray]] = []
        count = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append([batch.column(c).to_numpy() for c in names])
            count += batch.num_rows
            if count >= COMPARED_ROWS:
                rows = [np.concatenate(x) for x in zip(*held, strict=True)]
                end = int(np.searchsorted(rows[0], rows[0][-1], "left"))  # the last node may go on
                if end:
                    yield found([x[:end] for x in rows])
                held, count = [[x[end:] for x in rows]], count - end
        if held:
            yield found([np.concatenate(x) for x in zip(*held, strict=True)])

    return nodes.select(*names).repartition("node").sortWithinPartitions("node").mapInArrow(afresh(run), "group long, sid long, comp long").distinct()


def links_of(sid: np.ndarray, comp: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links of a group by its full sets: enough of them to span every link between its components.

    One entry after the other, outside the largest component of those left, is compared with all others through an
    inverted index of the group's shingles, which gives the exact sizes of all its intersections.
    """
    _, once = np.unique(sid, return_index=True)
    sid, sets = sid[once], [sets[i] for i in once]
    n = np.array([len(s) for s in sets])
    _, up = np.unique(comp[once], return_inverse=True)
    if len(sid) == 2:
        common = len(np.intersect1d(*sets, assume_unique=True))
        return [(int(sid[0]), int(sid[1]))] if up[0] != up[1] and 100 * common >= percent * (n.sum() - common) else []
    _, term = np.unique(np.concatenate(sets), return_inverse=True)
    start = np.concatenate([[0], np.cumsum(n)])
    held_by = np.repeat(np.arange(len(sid)), n)[np.argsort(term, kind="stable")]
    first = np.concatenate([[0], np.cumsum(np.bincount(term))])
    left, out = np.arange(len(sid)), []
    while True:
        labels, counts = np.unique(up[left], return_counts=True)
        if len(labels) < 2:
            return out
        i = left[up[left] != labels[counts.argmax()]][0]
        left = left[left != i]
        own = term[start[i] : start[i + 1]]
        count = first[own + 1] - first[own]
        at = np.arange(int(count.sum())) + np.repeat(first[own] - (np.cumsum(count) - count), count)
        common = np.bincount(held_by[at], minlength=len(sid))
        for j in np.flatnonzero((100 * common >= percent * (n[i] + n - common)) & (up != up[i])):
            if up[j] != up[i]:
                up[up == up[j]] = up[i]
                out.append((int(sid[i]), int(sid[j])))


def links(asked: DataFrame, entries: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """(a, b): linked entries of written groups (group, sid, comp)."""
    items = written(asked.select("sid", F.struct("group", "comp").alias("item")).join(entries.select("sid", "doc_id"), "sid"), "asked")

    def body(right: np.ndarray, sids: np.ndarray, items: pa.ListArray, hashes: np.ndarray, size: np.ndarray) -> pa.RecordBatch:
        row, item = _repeated(right, items)
        sets = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32)), pa.array(hashes.view(np.int64)))
        return pa.RecordBatch.from_arrays([item.field("group"), item.field("comp"), pa.array(sids[row]), sets.take(pa.array(row))], ["group", "comp", "sid", "shingles"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: int | None = None
        held: list[tuple[int, int, np.ndarray]] = []

        def found() -> list[tuple[int, int]]:
            sid, comp, sets = zip(*held, strict=True)
            return links_of(np.array(sid), np.array(comp), list(sets), percent)

        for batch in batches:
            out: list[tuple[int, int]] = []
            sets = batch.column("shingles")
            bounds, values = sets.offsets.to_numpy(), sets.values.to_numpy()
            for at, (group, comp, sid) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("group", "comp", "sid")), strict=True)):
                if group != open_:
                    out += found() if held else []
                    open_, held = group, []
                held.append((sid, comp, values[bounds[at] : bounds[at + 1]]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out, strict=True)], ["a", "b"])
        out = found() if held else []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out, strict=True)], ["a", "b"])

    sets = on_texts(items, docs, k, body, "group long, comp long, sid long, shingles array<long>")
    return sets.repartition("group").sortWithinPartitions("group").mapInArrow(afresh(run), "a long, b long").distinct()


# ------------------------------------------------------------------------ classes


class _Search:
    """The links found so far, their components, and the groups that are decided."""

    def __init__(self, docs: DataFrame, entries: DataFrame, k: int, percent: int):
        self.docs, self.entries, self.k, self.percent = docs, entries, k, percent
        self.links: DataFrame | None = None
        self.comp: DataFrame | None = None
        self.decided: DataFrame | None = None

    def take(self, nodes: DataFrame) -> None:
        spark = self.docs.sparkSession
        with arrow_rows(spark, SLIM_ROWS):
            asked = groups(nodes, self.percent)
            if self.decided is not None:
                asked = asked.join(self.decided, "group", "left_anti")
            asked = written(asked, "groups")
        if asked.isEmpty():
            return
        names = asked.select("group").distinct()
        self.decided = written(names if self.decided is None else self.decided.unionByName(names), "decided")
        with arrow_rows(spark, TEXT_ROWS):
            found = written(links(asked, self.entries, self.docs, self.k, self.percent), "links")
        if not found.isEmpty():
            self.links = found if self.links is None else self.links.unionByName(found)
            self.comp = written(components(self.links), "components")

    def round(self, trees: range) -> None:
        threshold, nodes = self.percent / 100, None
        for level in range(LEVELS + 1):
            now = first_nodes(placed(self.entries, self.comp), threshold, trees) if nodes is None else placed(nodes, self.comp)
            if level == LEVELS:  # nodes of two blocks: compared whatever their size
                return self.take(now)
            large = written(now.groupBy("node").agg(F.count("*").alias("size")).where(F.col("size") > LEAF), "large")
            if large.isEmpty():
                return self.take(now)
            few = large.count() <= BROADCAST_IDS
            large = F.broadcast(large) if few else large
            apart = written(now.join(large, "node"), "nodes")  # used again and again
            self.take(now.join(large.select("node"), "node", "left_anti").unionByName(with_pivot(apart)))
            now = placed(apart.drop("comp"), self.comp)
            mixed = written(now.groupBy("node").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low != high").select("node"), "mixed")
            if mixed.isEmpty():
                return None
            now = now.join(F.broadcast(mixed) if few else mixed, "node", "left_semi")
            with arrow_rows(self.docs.sparkSession, TEXT_ROWS):
                nodes = written(branch(now, self.entries, self.docs, self.k, threshold) if level < LEVELS - 1 else in_blocks(now), "nodes")
        return None


def _classes(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """doc_id, key, n_shingles, sid, root (the class's name) and component (its least doc_id) of every row."""
    with arrow_rows(docs.sparkSession, TEXT_ROWS):
        rows = written(sketches(docs, k, percent / 100), "sketches")
    carried = [c for c in rows.columns if c not in ("doc_id", "key", "sid")]
    # doc_id is null only for sets that no row with an id has
    grouped = rows.where("sid is not null").groupBy("sid").agg(F.min("doc_id").alias("doc_id"), *(F.first(c).alias(c) for c in carried))
    entries = written(grouped.where("doc_id is not null"), "entries")
    search = _Search(docs, entries, k, percent)
    for first, last in ROUNDS:
        search.round(range(first, last))
    if search.comp is None:
        classes = entries.select("sid", F.col("sid").alias("root"), F.col("doc_id").alias("component"))
    else:
        of = written(placed(entries.select("sid", "doc_id"), search.comp), "placed")
        lowest = of.groupBy("comp").agg(F.min("doc_id").alias("component"))
        classes = written(joined_evenly(of.select("sid", "comp"), lowest, "comp"), "classes").select("sid", F.col("comp").alias("root"), "component")
    return rows.select("doc_id", "key", "n_shingles", "sid").join(classes, "sid", "left").withColumn("component", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")))


def duplicate_classes(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of ``docs``."""
    with scratch(docs.sparkSession):
        out = _classes(docs, k, percent)
        kept = F.coalesce(F.col("doc_id") == F.col("component"), F.lit(True))
        return written(out.select("doc_id", "n_shingles", F.col("component").alias("component_id"), kept.alias("kept")), "classes", keep=True)


def deduplicate(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each class, all columns.

    It is the row of the class's least doc_id; of several texts with that id the one of least hash, and of rows that
    repeat both one. Empty texts aren't linked with anything and all stay, as do rows without an id.
    """
    with scratch(docs.sparkSession):
        rows = written(_classes(docs, k, percent).where("sid is not null and doc_id is not null").select("doc_id", "key", "root", "component"), "members")
        chosen = rows.where("doc_id = component").groupBy("root").agg(F.min("doc_id").alias("doc_id"), F.min("key").alias("key")).select("doc_id", "key")
        repeats = rows.join(chosen, ["doc_id", "key"], "left_semi").groupBy("doc_id", "key").agg(F.count("*").alias("n")).where("n > 1").select("doc_id", "key")
        goes = rows.join(chosen, ["doc_id", "key"], "left_anti").select("doc_id", "key").distinct()
        repeats, goes = written(repeats, "repeats", keep=True), written(goes, "goes", keep=True)
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    d = docs.select(whole.alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("key"))

    def without(left: DataFrame, right: DataFrame) -> DataFrame:
        few = right.count() <= BROADCAST_IDS  # some 40 MB at most; beyond it both sides are shuffled
        return left.join(F.broadcast(right) if few else right, ["doc_id", "key"], "left_anti")

    kept = without(d, goes)
    if not repeats.isEmpty():
        again = kept.join(repeats, ["doc_id", "key"], "left_semi").groupBy("doc_id", "key").agg(F.first("row").alias("row"))
        kept = without(kept, repeats).select("row").unionByName(again.select("row"))
    return kept.select("row.*")


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_classes(table(spark, sf_dir, "documents"), k=4, percent=80)
