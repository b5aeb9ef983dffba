"""Operator 8: language identification by a linear-chain conditional random field over words.

Every word of a text gets a language by forward-backward, so code-switched texts are labelled word by word; a document's
language is the one with the largest mean posterior over its words. Emissions add hashed weights of the word itself, its
prefixes and suffixes of 1 to 3 bytes and its byte trigrams, and lexicon log-odds; transitions are learned with them.
Training maximises the conditional likelihood (Adam on forward-backward gradients) on the driver, from at most
``rows_per_language`` documents of each language, the first by hash of the id; half of the training chains are spliced
from two languages, so that transitions see switches. A training document gives an excerpt of at most ``EXCERPT``
characters, at a place chosen by hash; ``CHAIN`` is the length of training chains only. In prediction every text is one
chain over all its words, whatever their number; texts of like length run side by side.

Only rows whose crc32 remainder modulo 4 is not 2 train. Nulls and edge cases: null text, or a text without a letter, is
``und`` with score 0; a very long text is one long chain; rows with null lang train nothing; with no training rows all is
``und``; with one language that language is certain; repeated rows are labelled alike, and rows that repeat an id train at
most once; equal posteriors go to the language first in the alphabet; an empty table gives no rows; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ligatura.llm.common import is_remainder, table
from ligatura.llm.textkit import Words, blocks, mix, per_text

BUCKETS = 1 << 16
CHAIN = 64
ROWS_PER_LANGUAGE, EXCERPT = 400, 20_000
#: Cells (words, padding included) of chains that run side by side, and bytes of texts that are read together.
CELLS, READ_BYTES = 400_000, 8 << 20
_WEIGHTS = (1, 257, 66049)
_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[65:91] = _ASCII_LETTER[97:123] = True


@dataclass
class WordFeatures:
    """Hashed features of the words of a block: affixes and the word by column, trigrams as a flat list with bounds."""

    affixes: np.ndarray  # (n, 7) buckets; unused places hold bucket 0, whose weight stays 0
    trigrams: np.ndarray
    first: np.ndarray  # where each word's trigrams begin
    count: np.ndarray


def word_features(w: Words) -> WordFeatures:
    n = len(w.starts)
    lens = w.ends - w.starts
    pad = np.concatenate([w.buf, np.zeros(3, np.uint8)]).astype(np.int64)
    out = np.zeros((n, 7), np.int64)
    bucket = lambda v, salt: (mix(v.astype(np.uint64) + np.uint64(salt << 32)) % np.uint64(BUCKETS - 1)).astype(np.int64) + 1
    for k in (1, 2, 3):
        ok = lens >= k
        for col, at, salt in ((k - 1, w.starts, k), (k + 2, w.ends - k, 8 + k)):
            v = sum(pad[np.maximum(at, 0) + j] * _WEIGHTS[j] for j in range(k))
            out[:, col] = np.where(ok, bucket(v, salt), 0)
    out[:, 6] = (w.hashes % np.uint64(BUCKETS - 1)).astype(np.int64) + 1
    count = np.maximum(lens - 2, 0)
    first = np.cumsum(count) - count
    at = np.arange(int(count.sum())) - np.repeat(first - w.starts, count)
    grams = pad[at] + pad[at + 1] * 257 + pad[at + 2] * 66049
    return WordFeatures(out, ((grams * 0x9E3779B1) >> 8) % (BUCKETS - 1) + 1, first, count)


@dataclass
class Crf:
    langs: list[str]
    weights: np.ndarray  # (2 * BUCKETS, L): affixes and words, then trigrams
    lexicon: np.ndarray  # (BUCKETS, L): log-odds of words
    lexicon_weight: np.ndarray
    transitions: np.ndarray

    def emissions(self, f: WordFeatures) -> np.ndarray:
        n = len(f.count)
        e = self.lexicon[f.affixes[:, 6]] * self.lexicon_weight
        for k in range(7):
            e += self.weights[f.affixes[:, k]]
        if len(f.trigrams):
            has = np.flatnonzero(f.count)
            e[has] += np.add.reduceat(self.weights[BUCKETS + f.trigrams], f.first[has], axis=0) / np.sqrt(f.count[has])[:, None]
        return e if n else np.zeros((0, len(self.langs)), np.float32)


def posteriors(e: np.ndarray, lengths: np.ndarray, transitions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward and backward values (T, n, L) of chains of emissions (T, n, L), longest first, of their own lengths.

    Step by step over all chains that still go on; both are scaled to sum to one at each word.
    """
    t, n, _ = e.shape
    p = np.exp(e - e.max(axis=2, keepdims=True))
    a = np.exp(transitions)
    alpha, beta = np.empty_like(p), np.ones_like(p)
    alive = np.searchsorted(-lengths, -np.arange(t), "left")  # chains with more than k words
    for k in range(t):
        m = alive[k]
        step = p[k, :m] if k == 0 else (alpha[k - 1, :m] @ a) * p[k, :m]
        alpha[k, :m] = step / np.maximum(step.sum(axis=1, keepdims=True), 1e-300)
    for k in range(t - 2, -1, -1):
        m = alive[k + 1]
        step = (beta[k + 1, :m] * p[k + 1, :m]) @ a.T
        beta[k, :m] = step / np.maximum(step.sum(axis=1, keepdims=True), 1e-300)
    return alpha, beta


def forward_backward(e: np.ndarray, mask: np.ndarray, transitions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Posteriors (n, T, L) of chains (n, T, L) of emissions whose words come first, and expected transition counts (L, L)."""
    lengths = mask.sum(axis=1)
    order = np.argsort(-lengths, kind="stable")
    by_step, ordered = np.ascontiguousarray(e[order].transpose(1, 0, 2)), lengths[order]
    alpha, beta = posteriors(by_step, ordered, transitions)
    inside = (np.arange(e.shape[1])[:, None] < ordered)[:, :, None]
    gamma = np.where(inside, alpha * beta, 0.0)
    gamma /= np.maximum(gamma.sum(axis=2, keepdims=True), 1e-300)
    counts = np.zeros_like(transitions, np.float64)
    a, p = np.exp(transitions), np.exp(by_step - by_step.max(axis=2, keepdims=True))
    for k in range(1, e.shape[1]):
        m = int(inside[k].sum())
        pair = alpha[k - 1, :m, :, None] * a * (p[k, :m] * beta[k, :m])[:, None, :]
        counts += (pair / np.maximum(pair.sum(axis=(1, 2), keepdims=True), 1e-300)).sum(axis=0)
    out = np.empty_like(gamma.transpose(1, 0, 2))
    out[order] = gamma.transpose(1, 0, 2)
    return out, counts


def chains(counts: np.ndarray, length: int = CHAIN) -> tuple[np.ndarray, np.ndarray]:
    """(word index, mask) of shape (n, length): the words of each text in chains that don't cross texts."""
    per = -(-counts // length)
    text = np.repeat(np.arange(len(counts)), per)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(per) - per, per)
    first = (np.cumsum(counts) - counts)[text] + nth * length
    size = np.minimum(counts[text] - nth * length, length)
    mask = np.arange(length) < size[:, None]
    return np.where(mask, first[:, None] + np.arange(length), 0), mask


def fit_crf(texts: list[str], langs: list[str], steps: int = 120, batch: int = 192, rate: float = 0.05, seed: int = 5) -> Crf:
    """Train on texts and their languages."""
    names = sorted(set(langs))
    size = len(names)
    label = np.array([names.index(x) for x in langs])
    column = pa.array(texts, pa.string())
    parts = [Words(buf, bounds, lower=True) for _, buf, bounds in blocks(column, 1 << 30)]
    crf = Crf(names, np.zeros((2 * BUCKETS, size), np.float32), np.zeros((BUCKETS, size), np.float32), np.ones(size, np.float32), np.eye(size) * 2.0)
    if size < 2 or not len(parts[0].starts):
        return crf
    w = parts[0]
    f = word_features(w)
    y = label[w.text]
    half = (w.text % 2) == 0
    seen = np.stack([np.bincount(f.affixes[half & (y == k), 6], minlength=BUCKETS) for k in range(size)], axis=1) + 0.1
    share = np.log(seen / seen.sum(axis=0))
    crf.lexicon = np.clip(share - share.mean(axis=1, keepdims=True), -3, 3).astype(np.float32) * (seen.sum(axis=1, keepdims=True) > 1)
    index, mask = chains(w.counts)
    rng = np.random.default_rng(seed)
    params = [crf.weights, crf.lexicon_weight, crf.transitions]
    moments = [(np.zeros_like(q, np.float64), np.zeros_like(q, np.float64)) for q in params]
    for step in range(1, steps + 1):
        one = rng.integers(0, len(index), batch)
        two = rng.integers(0, len(index), batch)
        ix, mk = index[one].copy(), mask[one].copy()
        cut = rng.integers(8, CHAIN - 8, batch)
        right = (np.arange(CHAIN) >= cut[:, None]) & (np.arange(batch) % 2 == 1)[:, None]
        ix, mk = np.where(right, index[two], ix), np.where(right, mask[two], mk)
        ahead = np.argsort(~mk, axis=1, kind="stable")  # words first, so that chains have no holes
        ix, mk = np.take_along_axis(ix, ahead, 1), np.take_along_axis(mk, ahead, 1)
        used, place = np.unique(ix[mk], return_inverse=True)
        count = f.count[used]
        first = np.cumsum(count) - count
        grams = f.trigrams[np.arange(int(count.sum())) - np.repeat(first - f.first[used], count)]
        sub = WordFeatures(f.affixes[used], grams, first, count)
        e = np.zeros((batch, CHAIN, size))
        e[mk] = crf.emissions(sub)[place]
        gamma, pairs = forward_backward(e, mk, crf.transitions)
        gold = np.zeros_like(gamma)
        gold[mk] = np.eye(size)[y[ix[mk]]]
        diff = np.zeros((len(used), size))
        np.add.at(diff, place, (gold - gamma)[mk])
        both = mk[:, 1:] & mk[:, :-1]
        a, b = y[ix[:, :-1]][both], y[ix[:, 1:]][both]
        g_trans = np.bincount(a * size + b, minlength=size * size).reshape(size, size) - pairs
        g_w = np.zeros((2 * BUCKETS, size))
        per_gram = np.repeat(diff / np.sqrt(np.maximum(count, 1))[:, None], count, axis=0)
        for k in range(size):
            for col in range(7):
                g_w[:BUCKETS, k] += np.bincount(sub.affixes[:, col], diff[:, k], BUCKETS)
            g_w[BUCKETS:, k] = np.bincount(grams, per_gram[:, k], BUCKETS)
        g_w[0] = 0
        g_lex = (crf.lexicon[sub.affixes[:, 6]] * diff).sum(axis=0)
        for q, g, (m, v) in zip(params, (g_w / batch, g_lex / batch, g_trans / batch), moments, strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            q += (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)).astype(q.dtype)
    return crf


def label_words(crf: Crf, w: Words) -> np.ndarray:
    """The posterior of each language for every word of a block; every text is one chain."""
    e = crf.emissions(word_features(w)).astype(np.float64)
    gamma = np.zeros((len(w.starts), len(crf.langs)))
    order = np.argsort(-w.counts, kind="stable")
    order = order[w.counts[order] > 0]
    at = 0
    while at < len(order):
        longest = int(w.counts[order[at]])
        part = order[at : at + max(1, CELLS // longest)]
        part = part[w.counts[part] * 2 > longest]  # those of like length
        at += len(part)
        n = w.counts[part]
        inside = np.arange(longest)[:, None] < n
        ix = np.where(inside, w.first[part] + np.arange(longest)[:, None], 0)
        alpha, beta = posteriors(e[ix], n, crf.transitions)
        got = (alpha * beta)[inside]
        gamma[ix[inside]] = got / np.maximum(got.sum(axis=1, keepdims=True), 1e-300)
    return gamma


def predict(docs: DataFrame, crf: Crf) -> DataFrame:
    """doc_id, lang_pred and score for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("text")
            for first, buf, bounds in blocks(column, READ_BYTES):
                n = len(bounds) - 1
                w = Words(buf, bounds, lower=True)
                letters = per_text(_ASCII_LETTER[buf], bounds) > 0
                for k in np.flatnonzero(~letters & (np.diff(bounds) > 0)):
                    letters[k] = any(map(str.isalpha, column[first + int(k)].as_py()))
                pred, score = np.full(n, "und", object), np.zeros(n)
                if crf.langs and len(w.starts):
                    gamma = label_words(crf, w) if len(crf.langs) > 1 else np.ones((len(w.starts), 1))
                    mean = np.stack([np.bincount(w.text, g, n) for g in gamma.T], axis=1) / np.maximum(w.counts, 1)[:, None]
                    best = mean.argmax(axis=1)
                    ok = letters & (w.counts > 0)
                    pred[ok] = np.array(crf.langs, object)[best[ok]]
                    score[ok] = np.clip(mean[ok, best[ok]], 0, 1)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(first, n), pa.array(pred, pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double")


def fit(docs: DataFrame, rows_per_language: int = ROWS_PER_LANGUAGE) -> Crf:
    """A field trained on a bounded sample of the rows that may train."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "text").where("doc_id is not null and lang is not null and text is not null").where(~is_remainder("doc_id", 4, 2))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    # thinned by a threshold on the hash first, to some four times the rows wanted, so that no language meets whole in one task; a row a language is broadcast
    share = rows.groupBy("lang").agg((4.0 * rows_per_language / F.count("*")).alias("share"))
    thin = F.pmod(F.xxhash64(F.col("doc_id") + 1), F.lit(1 << 20)) <= F.col("share") * (1 << 20)
    chosen = rows.select("doc_id", "lang").join(F.broadcast(share), "lang").where(thin).withColumn("rn", F.row_number().over(order)).where(F.col("rn") <= rows_per_language)
    place = F.pmod(F.xxhash64("text"), F.greatest(F.length("text") - EXCERPT, F.lit(0)) + 1) + 1
    cut = rows.select("doc_id", "lang", F.col("text").substr(place.cast("int"), F.lit(EXCERPT)).alias("text"))
    got = cut.join(F.broadcast(chosen.select("doc_id", "lang").distinct()), ["doc_id", "lang"])  # at most rows_per_language a language
    sample = got.groupBy("doc_id", "lang").agg(F.min("text").alias("text")).toPandas().sort_values(["lang", "doc_id"])  # repeated ids train once
    return fit_crf(sample["text"].to_list(), sample["lang"].to_list())


def op8_language_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return predict(docs, fit(docs)).select("doc_id", is_remainder("doc_id", 4, 2).alias("held_out"), "lang_pred", "score")
