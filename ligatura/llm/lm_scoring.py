"""Operator 4: cross-entropy difference of a target and a background bigram model over one vocabulary.

Target texts are those labelled of good quality and not toxic; the background is all texts. Every word and every pair of
all texts is in both models, so that they grow with the input; there is no cut-off. With c a model's counts, K(v) the
pairs that begin with v and a the smoothing mass, p(w|v) = (c(v,w) + (a + c(v) - K(v)) p(w)) / (c(v) + a), which sums to
one; p(w) adds one to each count and leaves one for a word not seen. A text's score is its mean loss per word under the
target less that under the background: lower is more like the target.

No model is broadcast. Texts become blocks of about ``BLOCK_WORDS`` words (local word numbers and the block's own
vocabulary). A block sends its distinct words, and its distinct pairs, as sorted 64-bit hashes with its own counts, in parts
by hash range; each part adds up all blocks' counts and sends the totals back to every block, in the order of the block's
own keys, so that keys travel once. A word that every text holds is one entry a block, so no key is hot, and a block
holds all it needs to score its texts. Memory is bounded by a block and by a part of about ``PART_ROWS`` entries.

Nulls and edge cases: null or empty text has no words, losses and score 0; a very long text is read whole, as a block of
its own if need be; null labels and ids choose no target texts; with no target texts the target model is the uniform
smoothing alone; repeated rows count and are scored each, with equal results; an empty table gives no rows; two words or
pairs of equal 64-bit hash would share their counts; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ligatura.llm.common import arrow_rows, scratch, table, written
from ligatura.llm.textkit import Words, blocks, mix

BLOCK_WORDS = 1_000_000
BLOCK_TEXTS = 100_000
PART_ROWS = 500_000
SMOOTHING = 20.0
BROADCAST_IDS = 1_000_000
#: Rows of an Arrow batch with texts, with whole blocks (also of the Parquet reader), and with parts of blocks.
TEXT_ROWS, BLOCK_ROWS, PART_BATCH = 1000, 4, 200
#: What a block counts of a word: occurrences in target and all texts, and how often it is a text's last word there.
WORD_COUNTS, PAIR_COUNTS = 4, 2
_BLOCK = "block long, asks boolean, counts boolean, doc_ids array<long>, sizes binary, targets binary, words binary, n_words long, places binary, n_places long"


def planes(values: np.ndarray) -> bytes:
    """Unsigned integers byte by byte, lowest first, without the upper bytes that all lack."""
    wide = values.astype(np.uint64, copy=False)
    n = max(1, -(-int(wide.max()).bit_length() // 8)) if len(wide) else 1
    return bytes([n]) + np.ascontiguousarray(wide).view(np.uint8).reshape(-1, 8)[:, :n].T.tobytes()


def unplaned(data: bytes, n: int, at: int = 0) -> tuple[np.ndarray, int]:
    """(``n`` integers as written at ``at`` by ``planes``, where they end)."""
    width = data[at]
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8, n * width, at + 1).reshape(width, n).T
    return out.view(np.uint64).ravel(), at + 1 + n * width


def coded(data: bytes) -> bytes:
    """Counts are mostly small and word numbers recur: an entropy coder, which shuffles lack, takes most of their bytes."""
    return len(data).to_bytes(8, "little") + pa.compress(data, "zstd", asbytes=True)


def decoded(data: bytes) -> bytes:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True)


def packed(keys: np.ndarray) -> bytes:
    """Sorted 64-bit keys, as their differences."""
    return coded(planes(np.diff(keys, prepend=np.uint64(0))))


def unpacked(data: bytes, n: int) -> np.ndarray:
    return np.cumsum(unplaned(decoded(data), n)[0], dtype=np.uint64)


def as_bytes(counts: np.ndarray) -> bytes:
    """Counts (columns, n) as binary."""
    return coded(b"".join(map(planes, counts)))


def as_counts(data: bytes, columns: int, n: int) -> np.ndarray:
    data, out, at = decoded(data), np.empty((columns, n), np.int64), 0
    for k in range(columns):
        column, at = unplaned(data, n, at)
        out[k] = column.view(np.int64)
    return out


def block_table(docs: DataFrame, asks: bool, counts: bool) -> DataFrame:
    """The blocks of rows (doc_id, text, is_target)."""
    names = [c.split()[0] for c in _BLOCK.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        parts: list[tuple] = []

        def emit() -> pa.RecordBatch:
            ids = pa.concat_arrays([p[0] for p in parts])
            hashes = np.concatenate([p[1] for p in parts])
            words, places = np.unique(hashes, return_inverse=True)
            sizes, targets = np.concatenate([p[2] for p in parts]), np.concatenate([p[3] for p in parts])
            parts.clear()
            block = number if counts else ~number
            row = [pa.array([block]), pa.array([asks]), pa.array([counts]), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)]
            binary = [pa.array([v], pa.binary()) for v in (sizes.astype(np.int64).tobytes(), targets.astype(np.uint8).tobytes(), packed(words), coded(planes(places)))]
            return pa.RecordBatch.from_arrays([*row, *binary[:3], pa.array([len(words)]), binary[3], pa.array([len(places)])], names)

        held = texts = 0
        for batch in batches:
            flags = batch.column("is_target").to_numpy(zero_copy_only=False).astype(bool)
            for first, buf, bounds in blocks(batch.column("text")):
                w = Words(buf, bounds, lower=True)
                parts.append((batch.column("doc_id").slice(first, w.n_texts), w.hashes, w.counts, flags[first : first + w.n_texts]))
                held, texts = held + len(w.hashes), texts + w.n_texts
                if held >= BLOCK_WORDS or texts >= BLOCK_TEXTS:
                    yield emit()
                    held, texts, number = 0, 0, number + 1
        if parts:
            yield emit()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "is_target").mapInArrow(run, _BLOCK)


class Block:
    """A block's words and pairs with its own counts."""

    def __init__(self, row: dict):
        self.sizes, self.counts = np.frombuffer(row["sizes"], np.int64), row["counts"]
        n, targets = int(self.sizes.sum()), row["targets"]
        self.places = unplaned(decoded(row["places"]), n)[0].view(np.int64)
        self.words = unpacked(row["words"], row["n_words"])
        flags = np.repeat(np.frombuffer(targets, np.uint8), self.sizes).astype(float)
        self.flags = flags
        has = self.sizes[self.sizes > 0]
        self.first = np.zeros(len(self.places), bool)
        self.first[np.cumsum(has) - has] = True
        self.last = np.append(self.first[1:], True) if len(self.places) else self.first

    def word_counts(self) -> np.ndarray:
        n = len(self.words)
        if not self.counts:
            return np.zeros((WORD_COUNTS, n), np.int64)
        weights = (self.flags, None, self.flags * self.last, self.last.astype(float))
        return np.stack([np.bincount(self.places, w, n).astype(np.int64) for w in weights])

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(keys in order, counts, places of pairs' second words, which key is theirs)."""
        at = np.flatnonzero(~self.first)
        code, which = np.unique(self.places[at - 1] * len(self.words) + self.places[at], return_inverse=True)
        v, w = np.divmod(code, max(len(self.words), 1))
        keys = mix(mix(self.words[v]) * np.uint64(0x9E3779B97F4A7C15) + self.words[w])
        order = np.argsort(keys, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        which = rank[which]
        counts = [np.bincount(which, x, len(keys)).astype(np.int64) * self.counts for x in (self.flags[at], None)]
        return keys[order], np.stack(counts), at, which


def _sent(all_blocks: DataFrame, pairs: bool, bits: int) -> DataFrame:
    """(part, block, asks, n, keys, counts): what the blocks send to each part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                b = Block(row)
                keys, counts = b.pairs()[:2] if pairs else (b.words, b.word_counts())
                part = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
                first = np.flatnonzero(np.diff(part, prepend=-1))
                ends = np.append(first[1:], len(part))
                data = [packed(keys[x:y]) for x, y in zip(first, ends, strict=True)], [as_bytes(counts[:, x:y]) for x, y in zip(first, ends, strict=True)]
                same = [pa.array([row["block"]] * len(first), pa.int64()), pa.array([row["asks"]] * len(first), pa.bool_())]
                yield pa.RecordBatch.from_arrays([pa.array(part[first]), *same, pa.array(ends - first), *(pa.array(x, pa.binary()) for x in data)], ["part", "block", "asks", "n", "keys", "counts"])

    names = ["block", "asks", "counts", "sizes", "targets", "words", "n_words", "places"]
    return all_blocks.select(*names).mapInArrow(run, "part long, block long, asks boolean, n long, keys binary, counts binary")


def _totals(sent: DataFrame, columns: int) -> DataFrame:
    """(block, part, n, totals, found): the totals of a block's keys, in their order; ``found`` counts each key that the texts hold once."""

    def added(rows: list[dict]) -> pa.RecordBatch:
        keys = np.concatenate([unpacked(r["keys"], r["n"]) for r in rows])
        own = np.concatenate([as_counts(r["counts"], columns, r["n"]) for r in rows], axis=1)
        order = np.argsort(keys, kind="stable")
        first = np.flatnonzero(np.concatenate([[True], keys[order][1:] != keys[order][:-1]]))
        sums = np.add.reduceat(own[:, order], first, axis=1)
        total = np.empty_like(own)
        total[:, order] = np.repeat(sums, np.diff(np.append(first, len(keys))), axis=1)
        ends = np.cumsum([r["n"] for r in rows])
        asked = [(r["block"], r["part"], r["n"], as_bytes(total[:, e - r["n"] : e]), 0) for r, e in zip(rows, ends.tolist(), strict=True) if r["asks"]]
        asked.append((None, rows[0]["part"], 0, None, int((sums[1] > 0).sum())))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*asked, strict=True), kinds, strict=True)], ["block", "part", "n", "totals", "found"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if held and row["part"] != held[0]["part"]:
                    yield added(held)
                    held = []
                held.append(row)
        if held:
            yield added(held)

    return sent.repartition("part").sortWithinPartitions("part", "block").mapInArrow(run, "block long, part long, n long, totals binary, found long")


@dataclass
class Models:
    """Both models, as the blocks of the texts that they count."""

    blocks: DataFrame
    words: tuple[int, int]  # words of the target and of all texts


def fit(docs: DataFrame) -> Models:
    """Both models from rows (doc_id, text, is_target)."""
    with arrow_rows(docs.sparkSession, TEXT_ROWS):
        made = written(block_table(docs, asks=True, counts=True), "blocks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(np.frombuffer(a, np.int64), np.frombuffer(b, np.uint8)) for a, b in zip(batch.column("sizes").to_pylist(), batch.column("targets").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array([int(a @ b) for a, b in rows], pa.int64()), pa.array([int(a.sum()) for a, _ in rows], pa.int64())], ["target", "every"])

    n = made.select("sizes", "targets").mapInArrow(run, "target long, every long").agg(F.sum("target"), F.sum("every")).first()
    return Models(made, (n[0] or 0, n[1] or 0))


def losses(block: Block, word_totals: np.ndarray, pair_totals: np.ndarray, at: np.ndarray, which: np.ndarray, sums: tuple[float, float]) -> np.ndarray:
    """(2, places): the loss of every word under the target and the background."""
    out = np.zeros((2, len(block.places)))
    v, w = block.places[at - 1], block.places[at]
    for m in range(2):
        p = (word_totals[m] + 1) / sums[m]
        out[m] = -np.log(p[block.places])
        c, ends = word_totals[m], word_totals[2 + m]
        out[m, at] = -np.log((pair_totals[m, which] + (SMOOTHING + ends[v]) * p[w]) / (c[v] + SMOOTHING))
    return out


def score(docs: DataFrame, models: Models, counted: bool = False) -> DataFrame:
    """doc_id, n_tokens, target_loss, background_loss and score of every row; ``counted`` if ``docs`` are those of the models."""
    spark = docs.sparkSession
    asking = models.blocks
    if not counted:
        with arrow_rows(spark, TEXT_ROWS):
            asking = written(block_table(docs.select("doc_id", "text", F.lit(False).alias("is_target")), asks=True, counts=False), "asking")
    every = models.blocks if counted else models.blocks.withColumn("asks", F.lit(False)).unionByName(asking)
    places = every.agg(F.sum("n_places")).first()[0] or 0
    bits = min(40, max(0, int(places // PART_ROWS).bit_length()))
    with arrow_rows(spark, PART_BATCH, BLOCK_ROWS):
        words = written(_totals(_sent(every, False, bits), WORD_COUNTS), "words")
    distinct = words.agg(F.sum("found")).first()[0] or 0
    sums = tuple(float(n + distinct + 1) for n in models.words)
    header = asking.drop("asks", "n_places").withColumn("kind", F.lit(0))
    rows = header
    for kind, totals in ((1, words), (2, _totals(_sent(every, True, bits), PAIR_COUNTS))):
        rows = rows.unionByName(totals.where("block is not null").drop("found").withColumn("kind", F.lit(kind)), allowMissingColumns=True)

    def scored(rows: list[dict]) -> pa.RecordBatch:
        head = rows[0]
        block = Block(head)
        keys, _, at, which = block.pairs()
        both = []
        for kind, columns, n in ((1, WORD_COUNTS, len(block.words)), (2, PAIR_COUNTS, len(keys))):
            got = np.concatenate([np.zeros((columns, 0), np.int64), *(as_counts(r["totals"], columns, r["n"]) for r in rows if r["kind"] == kind)], axis=1)
            if got.shape[1] != n:
                raise ValueError(f"block {head['block']}: {got.shape[1]} totals for {n} keys")
            both.append(got)
        by_place = losses(block, *both, at, which, sums)
        text = np.repeat(np.arange(len(block.sizes)), block.sizes)
        target, every = (np.bincount(text, x, len(block.sizes)) / np.maximum(block.sizes, 1) for x in by_place)
        return pa.RecordBatch.from_arrays([pa.array(head["doc_ids"], pa.int64()), pa.array(block.sizes), *map(pa.array, (target, every, target - every))], ["doc_id", "n_tokens", "target_loss", "background_loss", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if held and row["block"] != held[0]["block"]:
                    yield scored(held)
                    held = []
                held.append(row)
        if held:
            yield scored(held)

    dealt = rows.repartition("block").sortWithinPartitions("block", "kind", "part")
    with arrow_rows(spark, PART_BATCH, BLOCK_ROWS):
        return written(dealt.mapInArrow(run, "doc_id long, n_tokens long, target_loss double, background_loss double, score double"), "scores", keep=True)


def with_target(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text, is_target): the labelled texts of good quality that aren't toxic."""
    ids = labels.where("doc_id is not null and quality = 1 and coalesce(toxic, 0) = 0").select(F.col("doc_id").cast("long").alias("doc_id")).distinct().withColumn("is_target", F.lit(True))
    few = ids.count() <= BROADCAST_IDS  # some 16 MB at most; beyond it both sides are shuffled
    joined = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(ids) if few else ids, "doc_id", "left")
    return joined.select("doc_id", "text", F.coalesce("is_target", F.lit(False)).alias("is_target"))


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_target(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    with scratch(spark):
        return score(docs, fit(docs), counted=True)
