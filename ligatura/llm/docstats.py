"""Document statistics, computed for whole texts in numpy: the inputs of the quality models and the base rules."""

from __future__ import annotations

import numpy as np

from ligatura.llm.textkit import SPACE, Words, mix, per_text, span_hashes, spans

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Every feature is a ratio or a logarithm, so that texts of any length share a scale.
FEATURES = (
    "log_words", "mean_word", "symbols_per_char", "dup_line_share", "repeat_share", "upper_share", "digit_share",
    "bang_per_word", "pipe_per_word", "comma_per_word", "stop_per_word", "distinct_share", "log_longest", "words_per_line",
    "wide_share", "same_next_share",
)

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_CONT = (np.arange(256) & 0xC0) == 0x80
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = _UPPER.copy()
_LETTER[97:123] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True


def base_counts(w: Words) -> np.ndarray:
    """The counts of ``BASE`` for each text of a block, as an (n, 5) array of integers."""
    buf, bounds, n = w.buf, w.bounds, w.n_texts
    chars = per_text(~SPACE[buf] & ~_CONT[buf], bounds)
    symbols = per_text(_SYMBOL[buf], bounds)
    starts, ends = spans(buf != 10, bounds)
    dup_lines = np.zeros(n, np.int64)
    if len(starts):
        word = np.zeros(len(buf) + 1, np.int64)
        np.cumsum(~SPACE[buf], out=word[1:])
        full = word[ends] > word[starts]
        starts, ends = starts[full], ends[full]
        text = np.searchsorted(bounds, starts, "right") - 1
        h = span_hashes(buf, starts, ends) ^ mix(text.astype(np.uint64) + np.uint64(7))
        _, where = np.unique(h, return_index=True)
        dup_lines = np.bincount(text, minlength=n) - np.bincount(text[where], minlength=n)
    at, h = w.windows(3)
    covered = np.zeros(len(w.starts), bool)
    if len(at):
        h = h ^ mix(w.text[at].astype(np.uint64) + np.uint64(11))
        order = np.argsort(h, kind="stable")
        s = h[order]
        same = s[1:] == s[:-1]
        twice = np.zeros(len(at), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        for j in range(3):
            covered[at[twice] + j] = True
    repeat = np.bincount(w.text[covered], minlength=n)
    return np.stack([w.counts, chars, symbols, dup_lines, repeat], axis=1).astype(np.int64)


def statistics(w: Words, base: np.ndarray) -> np.ndarray:
    """The values of ``FEATURES`` for each text of a block, as an (n, F) array."""
    buf, bounds, n = w.buf, w.bounds, w.n_texts
    words = np.maximum(base[:, 0], 1).astype(float)
    chars = np.maximum(base[:, 1], 1).astype(float)
    count = lambda byte: per_text(buf == byte, bounds)
    after = np.zeros(len(buf), bool)
    after[1:] = buf[:-1] == 0xC3
    big = _UPPER[buf] | (after & (buf >= 0x80) & (buf <= 0x9E))
    letter = _LETTER[buf] | (after & (buf >= 0x80))
    lines = np.maximum(count(10) + (np.diff(bounds) > 0), 1)
    lens = np.log1p(w.ends - w.starts)
    longest = np.zeros(n)
    np.maximum.at(longest, w.text, lens)
    key = w.hashes ^ mix(w.text.astype(np.uint64) + np.uint64(3))
    _, where = np.unique(key, return_index=True)
    same = np.zeros(len(w.starts), bool)
    if len(same) > 1:
        same[1:] = (w.hashes[1:] == w.hashes[:-1]) & (w.text[1:] == w.text[:-1])
    return np.stack(
        [
            np.log1p(base[:, 0]), chars / words, base[:, 2] / chars, base[:, 3] / lines, base[:, 4] / words,
            per_text(big, bounds) / np.maximum(per_text(letter, bounds), 1), per_text(_DIGIT[buf], bounds) / chars,
            count(33) / words, count(124) / words, count(44) / words, count(46) / words,
            np.bincount(w.text[where], minlength=n) / words, longest, np.log1p(words / lines),
            per_text(_CONT[buf], bounds) / chars, np.bincount(w.text[same], minlength=n) / words,
        ],
        axis=1,
    ).astype(np.float64)
