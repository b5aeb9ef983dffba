"""Operator 2: lexical retrieval packing.

Each task tokenises its documents and works on shards of at most ``shard_tokens`` ids (or one longer document). A shard
has a BM25 inverted index over its own documents: postings sorted by term, with impacts precomputed from term
frequencies, lengths and the shard's document frequencies, as whole 64ths so that sums are exact. Greedily, the longest
unused document is the seed; all its terms are looked up, and the unused neighbours of highest BM25 score follow it until
the window of 4,096 ids is full or no unused document shares a term with the seed. The document that crosses the window's
end is cut, and its rest seeds the next window, so windows hold no padding. Terms that an eighth of the unused documents
hold are kept as dense rows, the others as postings; when half of the indexed documents are used, the index is cut down to
the rest, so that a lookup costs what is left to find, also in a shard of very many very short texts. What the last window of a shard lacks is filled from the next shard; at the end of a task the rest is cut into
windows of powers of two, which need no padding either. There is no shuffle, and memory is bounded by a shard.

Nulls and edge cases: a null or empty text is one piece, its end id; a very long text spans many windows; a null doc_id
is packed like any other; ties in length or score go to the document that comes first; repeated rows are documents of
their own; an empty table has no pieces; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ligatura.llm.common import table
from ligatura.llm.tokens import END_ID, crc32, text_slices, worker_cache

TOKENIZER = "word_bpe_49k.json"
WINDOW = 4096
SHARD_TOKENS = 2_000_000
K1, B = 1.2, 0.75
#: Steps of an impact; a term that one in so many documents holds has a dense row; neighbours ranked at first.
STEPS, COMMON, FIRST_RANKED = 64, 8, 64
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class ShardIndex:
    """BM25 over the documents of one shard, by token id."""

    def __init__(self, ids: np.ndarray, bounds: np.ndarray):
        n = len(bounds) - 1
        doc = np.repeat(np.arange(n, dtype=np.int64), np.diff(bounds))
        key, tf = np.unique((doc << 16) | ids, return_counts=True)
        self.doc_of, self.term_of = key >> 16, key & 0xFFFF
        self.doc_first = np.searchsorted(self.doc_of, np.arange(n + 1))
        size = np.diff(bounds)
        norm = K1 * (1 - B + B * size / max(size.mean(), 1))
        df = np.bincount(self.term_of, minlength=1 << 16)
        idf = np.log1p((n - df + 0.5) / (df + 0.5))
        self.impact = np.rint(STEPS * idf[self.term_of] * tf * (K1 + 1) / (tf + norm[self.doc_of]))
        self.n = n
        self._index(np.ones(n, bool))

    def _index(self, free: np.ndarray) -> None:
        """Postings and dense rows of the documents that are free."""
        keep = free[self.doc_of]
        self.docs, place = np.flatnonzero(free), np.cumsum(free) - 1
        order = np.argsort(self.term_of[keep], kind="stable")
        term = self.term_of[keep][order]
        self.post_doc, self.post_impact = place[self.doc_of[keep][order]], self.impact[keep][order]
        df = np.bincount(term, minlength=1 << 16)
        self.post_first = np.concatenate([[0], np.cumsum(df)])
        common = np.flatnonzero(df * COMMON > len(self.docs))
        self.row = np.full(1 << 16, -1)
        self.row[common] = np.arange(len(common))
        self.dense = np.zeros((len(common), len(self.docs)), np.float32)  # whole numbers far below 2**24: sums are exact
        inside = self.row[term] >= 0
        self.dense[self.row[term[inside]], self.post_doc[inside]] = self.post_impact[inside]

    def neighbours(self, seed: int, free: np.ndarray) -> Iterator[int]:
        """All free documents that share a term with the seed, those of the highest score first."""
        if 2 * free.sum() < len(self.docs):
            self._index(free)
        terms = self.term_of[self.doc_first[seed] : self.doc_first[seed + 1]]
        common = self.row[terms]
        rare = terms[common < 0]
        first, count = self.post_first[rare], self.post_first[rare + 1] - self.post_first[rare]
        at = np.arange(int(count.sum())) + np.repeat(first - (np.cumsum(count) - count), count)
        if (common >= 0).any():
            asked = np.zeros(len(self.dense), np.float32)
            asked[common[common >= 0]] = 1
            score = asked @ self.dense + np.bincount(self.post_doc[at], self.post_impact[at], len(self.docs))
            found = np.flatnonzero((score > 0) & free[self.docs])
            score = score[found]
        else:
            found, place = np.unique(self.post_doc[at], return_inverse=True)
            score = np.bincount(place, self.post_impact[at], len(found))
            ok = (score > 0) & free[self.docs[found]]
            found, score = found[ok], score[ok]
        wanted = FIRST_RANKED
        while len(found):  # ranked as far as they are asked for
            best = np.ones(len(found), bool) if len(found) <= wanted else score >= np.partition(score, len(found) - wanted)[len(found) - wanted]
            yield from self.docs[found[best][np.lexsort((found[best], -score[best]))]].tolist()
            found, score, wanted = found[~best], score[~best], wanted * 4


def order_by_retrieval(ids: np.ndarray, bounds: np.ndarray, room: int) -> list[int]:
    """All documents of a shard, so that windows of WINDOW ids (the first has ``room``) hold a seed and its neighbours."""
    size = np.diff(bounds)
    index = ShardIndex(ids, bounds)
    free = np.ones(index.n, bool)
    by_size = np.lexsort((np.arange(index.n), -size))
    out: list[int] = []
    cursor, seed = 0, -1
    while len(out) < index.n:
        if seed < 0:
            while not free[by_size[cursor]]:
                cursor += 1
            seed = int(by_size[cursor])
            out.append(seed)
            free[seed] = False
            room -= int(size[seed])
        if room <= 0:  # the seed's own windows; its rest opens the next
            room = WINDOW - (-room) % WINDOW
        following = -1
        for d in index.neighbours(seed, free):
            out.append(d)
            free[d] = False
            room -= int(size[d])
            if room <= 0:
                following = d if room < 0 else -1
                room = WINDOW - (-room) % WINDOW
                break
        seed = following
    return out


class Packer:
    """Puts documents end to end into windows and tells the pieces."""

    def __init__(self, first_sequence: int):
        self.sequence = first_sequence
        self.pending: list[tuple] = []  # pieces of the open window: (doc_id, start, ids, doc_tokens)
        self.filled = 0

    def room(self) -> int:
        return WINDOW - self.filled

    def _close(self, pieces: list[tuple]) -> Iterator[tuple]:
        offset = 0
        for doc_id, start, ids, total in pieces:
            yield doc_id, start, len(ids), crc32(ids), total, self.sequence, offset
            offset += len(ids)
        self.sequence += 1

    def add(self, doc_id: int | None, ids: np.ndarray) -> Iterator[tuple]:
        start = 0
        while start < len(ids):
            take = min(self.room(), len(ids) - start)
            self.pending.append((doc_id, start, ids[start : start + take].copy(), len(ids)))
            self.filled += take
            start += take
            if self.filled == WINDOW:
                yield from self._close(self.pending)
                self.pending, self.filled = [], 0

    def finish(self) -> Iterator[tuple]:
        """Cut the open window into powers of two, the largest first."""
        left = self.filled
        queue = self.pending[::-1]
        while left:
            want = 1 << (left.bit_length() - 1)
            left -= want
            pieces = []
            while want:
                doc_id, start, ids, total = queue.pop()
                if len(ids) > want:
                    queue.append((doc_id, start + want, ids[want:], total))
                    ids = ids[:want]
                pieces.append((doc_id, start, ids, total))
                want -= len(ids)
            yield from self._close(pieces)
        self.pending, self.filled = [], 0


def pack(docs: DataFrame, tokenizer: str = TOKENIZER, path: str | None = None, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """The pieces of all documents, as rows of ``SCHEMA``."""
    names = SCHEMA.replace(" long", "").split(", ")

    def batch_of(pieces: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*pieces, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = worker_cache(tokenizer, path)
        packer = Packer(TaskContext.get().partitionId() << 40)
        shard: list[tuple[np.ndarray, np.ndarray, list]] = []

        def flush() -> Iterator[pa.RecordBatch]:
            ids = np.concatenate([s[0] for s in shard])
            sizes = np.concatenate([np.diff(s[1]) for s in shard])
            bounds = np.concatenate([[0], np.cumsum(sizes)])
            doc_ids = [d for s in shard for d in s[2]]
            shard.clear()
            pieces = [p for k in order_by_retrieval(ids, bounds, packer.room()) for p in packer.add(doc_ids[k], ids[bounds[k] : bounds[k + 1]])]
            if pieces:
                yield batch_of(pieces)

        held = 0
        for batch in batches:
            doc_ids = batch.column("doc_id").to_pylist()
            for first, texts in text_slices(batch.column("text")):
                ids, bounds = cache.encode(texts, END_ID)
                shard.append((ids, bounds, doc_ids[first : first + len(texts)]))
                held += len(ids)
                if held >= shard_tokens:
                    yield from flush()
                    held = 0
        if shard:
            yield from flush()
        pieces = list(packer.finish())
        if pieces:
            yield batch_of(pieces)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SCHEMA)


def op2_retrieval_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
