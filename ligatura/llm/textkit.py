"""Vectorised reading of texts: whole Arrow batches become numpy arrays of words, lines and hashes.

A text column is walked in blocks of about a megabyte (a longer text is a block of its own), so that memory
stays bounded by the longest single text. Words are maximal runs of bytes outside ``[\\x20\\x09-\\x0D]``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    """The first ``n`` powers of an odd base modulo 2**64."""
    global _POWERS
    if len(_POWERS) < n:
        size = 1 << max(12, int(n - 1).bit_length())
        p = np.full(size, _BASE, np.uint64)
        p[0] = 1
        _POWERS = np.cumprod(p, dtype=np.uint64)
    return _POWERS


def mix(x: np.ndarray) -> np.ndarray:
    """A finaliser that spreads 64-bit integers (splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Yield (index of the first text, bytes, bounds) for runs of texts of about ``limit`` bytes; null is empty."""
    if column.null_count:
        column = column.fill_null("")
    if len(column) == 0:
        return
    wide = pa.types.is_large_string(column.type)
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        last = min(last, len(column))
        yield first, raw[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def per_text(mask: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """How many bytes of each text the mask holds."""
    total = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def spans(inside: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs of ``inside`` that don't cross a bound."""
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    before = np.zeros_like(inside)
    before[1:] = inside[:-1]
    before[bounds[:-1][bounds[:-1] < len(inside)]] = False
    after = np.zeros_like(inside)
    after[:-1] = inside[1:]
    after[bounds[1:][bounds[1:] > 0] - 1] = False
    return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span; spans are disjoint and in order, and not empty."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lens = ends - starts
    at = np.cumsum(lens) - lens
    off = np.arange(int(lens.sum()), dtype=np.int64) - np.repeat(at, lens)
    val = (buf[off + np.repeat(starts, lens)].astype(np.uint64) + np.uint64(1)) * powers(int(lens.max()))[off]
    return mix(np.add.reduceat(val, at) + lens.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


class Words:
    """The words of a block of texts: byte spans, the text each is in, and 64-bit hashes."""

    def __init__(self, buf: np.ndarray, bounds: np.ndarray, lower: bool = False):
        self.buf = LOWER[buf] if lower else buf
        self.bounds = bounds
        self.n_texts = len(bounds) - 1
        self.starts, self.ends = spans(~SPACE[buf], bounds)
        self.text = np.searchsorted(bounds, self.starts, "right") - 1
        self.counts = np.bincount(self.text, minlength=self.n_texts)
        self.first = np.cumsum(self.counts) - self.counts
        self.hashes = span_hashes(self.buf, self.starts, self.ends)

    def windows(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(index of the first word, hash) of each run of ``k`` words within a text."""
        n = len(self.starts) - k + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        at = np.flatnonzero(self.text[:n] == self.text[k - 1 :])
        h = np.zeros(len(at), np.uint64)
        for j in range(k):
            h = h * np.uint64(0x9FB21C651E98DF25) + self.hashes[at + j]
            h ^= h >> np.uint64(29)
        return at, mix(h)

    def shingles(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(text, hash) of the distinct shingles of every text, by text; a text of fewer than ``k`` words has its whole sequence as one."""
        at, h = self.windows(k)
        text = self.text[at]
        for size in range(1, k):
            short = np.flatnonzero(self.counts == size)
            if len(short):
                g = np.full(len(short), size, np.uint64)
                for j in range(size):
                    g = g * np.uint64(0x9FB21C651E98DF25) + self.hashes[self.first[short] + j]
                    g ^= g >> np.uint64(29)
                text, h = np.concatenate([text, short]), np.concatenate([h, mix(g)])
        order = np.lexsort((h, text))
        text, h = text[order], h[order]
        keep = np.ones(len(h), bool)
        keep[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
        return text[keep], h[keep]
