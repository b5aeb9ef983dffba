"""Exact token ids of a public tokenizer file at the cost of its distinct chunks.

A text is cut where the tokenizer's own pre-tokenisation always cuts, so that each chunk's ids don't depend on what
stands around it. Each distinct chunk is encoded once by the tokenizers library and kept in a bounded memory of the
Python worker; a text's ids are gathered from there in numpy. Texts that hold a special token's string, or characters
on whose class the libraries may differ, go to the library whole.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa

from ligatura.llm.common import KEPT
from ligatura.llm.textkit import blocks

#: Unicode white space, as the inside of a character class; with it the cuts agree with the tokenizers' own.
_WS = "\t-\r " + "".join(map(chr, (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
#: Separators and marks that Python and the tokenizers may class differently, and special tokens: such texts are encoded whole.
_ODD = (*map(chr, (*range(0x1C, 0x20), 0x180E, *range(0x200B, 0x2010), 0x2060, 0xFEFF)), "<|")
_LETTERS = "A-Za-z" + "".join(map(chr, [c for c in range(0xC0, 0x100) if c not in (0xD7, 0xF7)]))
_MARKS = r"!#$%&*,.:;?|"
#: A word of plain letters and the marks after it are chunks of their own: no tokenizer joins the two.
_WORD, _TAIL = f"[{_LETTERS}]+(?=[{_MARKS}]*(?:[{_WS}]|\\Z))", f"(?<=[{_LETTERS}])[{_MARKS}]+(?=[{_WS}]|\\Z)"
CUTS = {
    # words drop white space and are lower-cased one by one
    "word_bpe_49k.json": re.compile(f"{_WORD}|{_TAIL}|[^{_WS}]+"),
    # a single space belongs to the word after it; longer runs of white space end before the last character
    "byte_bpe_50k.json": re.compile(f" ?{_WORD}|{_TAIL}| ?[^{_WS}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]"),
}
_PLAIN = re.compile(f" ?[{_LETTERS}]+|[{_MARKS}]+")
#: The characters by which byte-level BPE writes bytes: printable Latin-1 as itself, the others from U+0100 on.
_SELF = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_BYTES = {b: 0x100 + k for k, b in enumerate(b for b in range(256) if b not in _SELF)}
#: Plain letters beyond ASCII as the characters of their two bytes; first the one that is the first character of all of them.
_TWO_BYTES = [(c, c.encode().decode("latin-1").translate(_BYTES)) for c in ("\xc3", *(c for c in map(chr, range(0xC0, 0x100)) if c not in "\xc3\xd7\xf7"))]
#: Up to here lower-casing needs no context and no character combines with another.
_FAR = re.compile(f"[{chr(0x250)}-{chr(0x10FFFF)}]")


def _near(text: str) -> bool:
    """No character of ``_FAR``; Latin-1 texts, the usual case, are told by one fast pass."""
    try:
        text.encode("latin-1")
        return True
    except UnicodeEncodeError:
        return not _FAR.search(text)


def byte_characters(chunks: list[str]) -> list[str]:
    """Chunks of ``_PLAIN`` as byte-level BPE writes their bytes, all at once: few characters differ, most are themselves."""
    joined = "\0".join(chunks)
    if not joined.isascii():
        for letter, two in _TWO_BYTES:
            joined = joined.replace(letter, two)
    return joined.replace(" ", chr(_BYTES[0x20])).split("\0")


CACHE_CHUNKS = 700_000
END_ID = 2


def tokenizer_path(name: str) -> str:
    """The place of a public tokenizer file."""
    import public_tokenizers

    return public_tokenizers.path(name)


class _Index(dict):
    """Chunk to place; a chunk not seen yet gets the next place and is noted in ``new``."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, chunk: str) -> int:
        self[chunk] = place = len(self)
        self.new.append(chunk)
        return place


class ChunkCache:
    """Ids of chunks seen by this worker: ``start`` and ``size`` index the flat array ``ids``."""

    def __init__(self, name: str, path: str | None = None, limit: int = CACHE_CHUNKS):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path or tokenizer_path(name))
        self.pieces = Tokenizer.from_file(path or tokenizer_path(name))  # takes single pre-tokens, byte by byte as characters
        self.pieces.normalizer = self.pieces.pre_tokenizer = None
        self.cut = CUTS[name]
        self.folds = name == "word_bpe_49k.json"
        self.limit = limit
        self.clear()

    def clear(self) -> None:
        self.at = _Index()
        self.start = np.zeros(0, np.int32)
        self.size = np.zeros(0, np.int32)
        self.ids = np.zeros(0, np.uint16)

    def _learn(self) -> None:
        """Encode the new chunks: plain words and marks, single pre-tokens for certain, as one list; the rest one by one."""
        new, self.at.new = self.at.new, []
        size = np.zeros(len(new), np.int64)
        plain = np.fromiter((_PLAIN.fullmatch(c) is not None for c in new), bool, len(new))
        lists: list[tuple[np.ndarray, np.ndarray]] = []
        for rows, single in ((np.flatnonzero(plain), True), (np.flatnonzero(~plain), False)):
            for k in range(0, len(rows), 10_000):
                part = rows[k : k + 10_000]
                chunks = [new[r] for r in part]
                if single:
                    got = self.pieces.encode(byte_characters(chunks), is_pretokenized=True, add_special_tokens=False)
                    size[part] = np.bincount(np.array(got.word_ids, np.int64), minlength=len(part))
                    lists.append((part, np.array(got.ids, np.uint16)))
                else:
                    ids = [e.ids for e in self.library.encode_batch_fast(chunks, add_special_tokens=False)]
                    size[part] = np.fromiter(map(len, ids), np.int64, len(ids))
                    lists.append((part, np.array(list(chain.from_iterable(ids)), np.uint16)))
        start = np.zeros(len(new), np.int64)
        at = len(self.ids)
        for part, ids in lists:
            start[part] = at + np.cumsum(size[part]) - size[part]
            at += len(ids)
        self.start = np.concatenate([self.start, start.astype(np.int32)])
        self.size = np.concatenate([self.size, size.astype(np.int32)])
        self.ids = np.concatenate([self.ids, *(ids for _, ids in lists)])

    def encode(self, texts: list[str | None], end_id: int = END_ID) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, each closed by ``end_id``; bounds of the texts); null is empty."""
        if len(self.at) > self.limit:
            self.clear()
        place = self.at.__getitem__
        parts, counts = [], []
        whole: dict[int, np.ndarray] = {}
        for k, text in enumerate(texts):
            if text and self.folds and _near(text):
                text = text.lower()
            if text and any(odd in text for odd in _ODD):
                whole[k] = np.array(self.library.encode(texts[k], add_special_tokens=False).ids, np.uint16)
                text = ""
            chunks = self.cut.findall(text or "")
            parts.append(np.fromiter(map(place, chunks), np.int32, len(chunks)))
            counts.append(len(chunks))
        if self.at.new:
            self._learn()
        rows = np.concatenate(parts) if parts else np.zeros(0, np.int32)
        size = self.size[rows].astype(np.int64)
        ends = np.zeros(len(rows) + 1, np.int64)
        np.cumsum(size, out=ends[1:])
        chunk_bounds = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)]).astype(np.int64)
        own = np.diff(ends[chunk_bounds])
        for k, ids in whole.items():
            own[k] = len(ids)
        bounds = np.zeros(len(texts) + 1, np.int64)
        np.cumsum(own + 1, out=bounds[1:])
        out = np.full(int(bounds[-1]), end_id, np.uint16)
        flat = self.ids[np.repeat(self.start[rows] - ends[:-1], size) + np.arange(int(ends[-1]))]
        if whole:
            for k in range(len(texts)):
                out[bounds[k] : bounds[k + 1] - 1] = whole[k] if k in whole else flat[ends[chunk_bounds[k]] : ends[chunk_bounds[k + 1]]]
        else:
            inside = np.ones(len(out), bool)
            inside[bounds[1:] - 1] = False
            out[inside] = flat
        return out, bounds


def worker_cache(name: str, path: str | None = None) -> ChunkCache:
    """The memory of this Python worker for one tokenizer file; it goes when another operator's task begins."""
    key = f"tokens of {path or name}"
    if key not in KEPT:
        KEPT[key] = ChunkCache(name, path)
    return KEPT[key]


def crc32(ids: np.ndarray) -> int:
    """Unsigned crc32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4").tobytes())


def text_slices(column: pa.Array, limit: int = 2_000_000) -> Iterator[tuple[int, list[str | None]]]:
    """(index of the first, texts) of runs of about ``limit`` bytes; a longer text is a run of its own."""
    for begin, _, bounds in blocks(column, limit):
        yield begin, column.slice(begin, len(bounds) - 1).to_pylist()
