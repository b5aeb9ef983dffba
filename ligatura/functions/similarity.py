"""String similarities over two columns.

``ratio`` is the normalised indel similarity 100 * 2 * LCS / (len a + len b), rounded nowhere; the token scorers build on it.
Longest common subsequences of a whole Arrow batch are found bit-parallel in numpy, one step for each character position
of the longer column, so a batch costs some fifty vector operations. Two empty strings are alike (100 or 1) under ``ratio``,
``token_sort_ratio`` and ``partial_ratio``; an empty side gives 0 under ``token_set_ratio`` and ``jaro_winkler``, as one
empty side does under all.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType

from ligatura.functions.columns import Value, col, let, split_words

_CODES = np.full(128, 63, np.uint8)
for _k, _c in enumerate("abcdefghijklmnopqrstuvwxyz0123456789 -|&.,_/'"):
    _CODES[ord(_c)] = _k


def lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence, bit-parallel on Python's integers."""
    if not a or not b:
        return 0
    masks: dict[str, int] = {}
    for k, ch in enumerate(b):
        masks[ch] = masks.get(ch, 0) | 1 << k
    full = (1 << len(b)) - 1
    s = full
    for ch in a:
        u = s & masks.get(ch, 0)
        s = ((s + u) | (s - u)) & full
    return len(b) - s.bit_count()


def _coded(strings: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes by position, lengths, which strings are plain); codes of strings that aren't plain are no use."""
    lens = np.fromiter(map(len, strings), np.int64, len(strings))
    ascii_ = np.fromiter((s.isascii() for s in strings), bool, len(strings))
    codes = np.full((len(strings), max(int(lens.max(initial=0)), 1)), 63, np.uint8)
    flat = _CODES[np.frombuffer("".join(s if ok else "?" * len(s) for s, ok in zip(strings, ascii_, strict=True)).encode(), np.uint8)]
    owner = np.repeat(np.arange(len(strings)), lens)
    codes[owner, np.arange(len(owner)) - np.repeat(np.cumsum(lens) - lens, lens)] = flat
    return codes, lens, ascii_ & (np.bincount(owner[flat == 63], minlength=len(strings)) == 0)


def _masks(codes: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """(n, 64): for each code the places, as bits, at which a string of at most 63 characters has it."""
    masks = np.zeros((len(codes), 64), np.uint64)
    row, at = np.nonzero(np.arange(codes.shape[1]) < lens[:, None])
    np.bitwise_or.at(masks, (row, codes[row, at]), np.uint64(1) << at.astype(np.uint64))
    masks[:, 63] = 0
    return masks


def _low(n: np.ndarray) -> np.ndarray:
    """The lowest ``n`` bits, n at most 63."""
    return (np.uint64(1) << n.astype(np.uint64)) - np.uint64(1)


def _in_chunks(a: list[str], b: list[str], fast, one, none: float, least: int = 0) -> np.ndarray:
    """``fast(short codes, lengths, long codes, lengths)`` of plain pairs whose shorter side has 1 to 63 characters (both, if
    ``least`` is set), alike in size side by side; ``one(a, b)`` of the others; ``none`` where a side is empty."""
    out = np.full(len(a), none, np.float64)
    short, long = zip(*((x, y) if len(x) <= len(y) else (y, x) for x, y in zip(a, b, strict=True)), strict=True) if a else ((), ())
    la, lb = np.fromiter(map(len, short), np.int64, len(a)), np.fromiter(map(len, long), np.int64, len(a))
    order = np.lexsort((lb, la))
    order = order[la[order] > 0]
    for k in range(0, len(order), 4096):
        rows = order[k : k + 4096]
        ca, na, pa = _coded([short[i] for i in rows])
        cb, nb, pb = _coded([long[i] for i in rows])
        ok = pa & pb & (na <= 63) & ((nb <= 63) | (least == 0))
        if ok.any():
            out[rows[ok]] = fast(ca[ok], na[ok], cb[ok][:, : int(nb[ok].max())], nb[ok])
        for i in rows[~ok]:
            out[i] = one(a[i], b[i])
    return out


def _lcs_fast(ca: np.ndarray, na: np.ndarray, cb: np.ndarray, nb: np.ndarray) -> np.ndarray:
    masks, full, line = _masks(ca, na), _low(na), np.arange(len(na))
    s = full.copy()
    for j in range(cb.shape[1]):
        u = s & masks[line, cb[:, j]]
        s = ((s + u) | (s - u)) & full
    return na - np.bitwise_count(s)


def lcs_batch(a: list[str], b: list[str]) -> np.ndarray:
    """``lcs`` of many pairs."""
    return _in_chunks(a, b, _lcs_fast, lcs, 0.0).astype(np.int64)


def ratio_batch(a: list[str], b: list[str]) -> np.ndarray:
    total = np.fromiter((len(x) + len(y) for x, y in zip(a, b, strict=True)), np.float64, len(a))
    return np.where(total > 0, 200.0 * lcs_batch(a, b) / np.maximum(total, 1), 100.0)


def _sorted_tokens(s: str) -> str:
    return " ".join(sorted(s.split()))


def token_set_batch(a: list[str], b: list[str]) -> np.ndarray:
    """The best ratio among common tokens, common and own tokens of each side; 100 if common tokens make up a side."""
    n = len(a)
    out = np.zeros(n)
    rows, lefts, rights, commons = [], [], [], []
    for i, (x, y) in enumerate(zip(a, b, strict=True)):
        u, v = set(x.split()), set(y.split())
        if not u or not v:
            continue
        common, du, dv = u & v, u - v, v - u
        if common and (not du or not dv):
            out[i] = 100.0
            continue
        base = " ".join(sorted(common))
        rows.append(i)
        commons.append(base)
        lefts.append((base + " " + " ".join(sorted(du))).strip())
        rights.append((base + " " + " ".join(sorted(dv))).strip())
    if rows:
        best = ratio_batch(lefts, rights)
        base = np.fromiter(map(len, commons), float, len(rows))
        for side in (lefts, rights):
            size = np.fromiter(map(len, side), float, len(rows))
            best = np.maximum(best, np.where(base > 0, 200 * base / (base + size), 0))
        out[rows] = best
    return out


def partial_ratio(a: str, b: str) -> float:
    """The best ratio of the shorter string with a window of the longer one, windows at the ends being shorter too."""
    if not a or not b:
        return 100.0 if a == b else 0.0
    if len(a) > len(b):
        a, b = b, a
    n = len(a)
    best = 0.0
    for s in range(1 - n, len(b)):
        w = b[max(s, 0) : s + n]
        if 2 * min(n, len(w)) * 100 <= best * (n + len(w)):
            continue
        best = max(best, 200 * lcs(a, w) / (n + len(w)))
        if best == 100:
            break
    return best


def _partial_fast(ca: np.ndarray, na: np.ndarray, cb: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """From every place of the longer string the table runs over a window; from the first, its shorter windows count too."""
    masks, full, line = _masks(ca, na), _low(na), np.arange(len(na))
    best = np.zeros(len(na))
    for start in range(cb.shape[1]):
        window = np.minimum(na, nb - start)
        s = full.copy()
        for k in range(max(int(window.max()), 0)):
            u = s & masks[line, cb[:, start + k]]
            s = np.where(k < window, ((s + u) | (s - u)) & full, s)
            if start == 0:
                best = np.maximum(best, np.where(k < window, 200 * (na - np.bitwise_count(s)) / (na + k + 1), 0))
        best = np.maximum(best, np.where(window > 0, 200 * (na - np.bitwise_count(s)) / (na + np.maximum(window, 1)), 0))
    return best


def partial_ratio_batch(a: list[str], b: list[str]) -> np.ndarray:
    """``partial_ratio`` of many pairs."""
    out = _in_chunks(a, b, _partial_fast, partial_ratio, 0.0)
    out[np.fromiter((not x and not y for x, y in zip(a, b, strict=True)), bool, len(a))] = 100.0
    return out


def jaro_winkler_one(a: str, b: str, weight: float = 0.1) -> float:
    if not a or not b:
        return 0.0
    if a == b:
        return 1.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    used = [False] * len(b)
    hits = []
    for i, ch in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not used[j] and b[j] == ch:
                used[j] = True
                hits.append(ch)
                break
    if not hits:
        return 0.0
    m = len(hits)
    swaps = sum(x != y for x, y in zip(hits, (c for c, u in zip(b, used, strict=True) if u), strict=True)) // 2
    jaro = (m / len(a) + m / len(b) + (m - swaps) / m) / 3
    prefix = next((k for k, (x, y) in enumerate(zip(a[:4], b[:4], strict=False)) if x != y), min(4, len(a), len(b)))
    return jaro + prefix * weight * (1 - jaro) if jaro > 0.7 else jaro


def _jaro_fast(ca: np.ndarray, na: np.ndarray, cb: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Each character takes the first free equal one within reach, as bits; what was taken on both sides is compared in order."""
    masks, line, one = _masks(cb, nb), np.arange(len(na)), np.uint64(1)
    reach = np.maximum(nb // 2 - 1, 0)
    hit_a, hit_b = np.zeros(len(na), np.uint64), np.zeros(len(na), np.uint64)
    for i in range(ca.shape[1]):
        inside = _low(np.minimum(nb, i + reach + 1)) & ~_low(np.minimum(np.maximum(i - reach, 0), 63))
        free = np.where(i < na, masks[line, ca[:, i]] & inside & ~hit_b, np.uint64(0))
        taken = free & (~free + one)
        hit_b |= taken
        hit_a |= np.where(taken > 0, one << np.uint64(i), np.uint64(0))
    m = np.bitwise_count(hit_a).astype(np.int64)
    odd = np.zeros(len(na), np.int64)
    x, y = hit_a.copy(), hit_b.copy()
    for _ in range(int(m.max(initial=0))):
        go = x > 0
        p, q = x & (~x + one), y & (~y + one)
        i, j = (np.minimum(np.bitwise_count(z - one), 63).astype(np.int64) for z in (p, q))
        odd += go & (ca[line, np.minimum(i, ca.shape[1] - 1)] != cb[line, np.minimum(j, cb.shape[1] - 1)])
        x, y = x ^ p, y ^ q
    some = np.maximum(m, 1)
    jaro = np.where(m > 0, (m / na + m / nb + (m - odd // 2) / some) / 3, 0.0)
    width = min(4, ca.shape[1], cb.shape[1])
    alike = (ca[:, :width] == cb[:, :width]) & (np.arange(width) < na[:, None])
    prefix = np.cumprod(alike, axis=1).sum(axis=1)
    return np.where(jaro > 0.7, jaro + prefix * 0.1 * (1 - jaro), jaro)


def jaro_winkler_batch(a: list[str], b: list[str]) -> np.ndarray:
    """``jaro_winkler_one`` of many pairs, the shorter string taken first."""
    out = _in_chunks(a, b, _jaro_fast, lambda x, y: jaro_winkler_one(*sorted((x, y), key=len)), 0.0, least=1)
    out[np.fromiter((x == y != "" for x, y in zip(a, b, strict=True)), bool, len(a))] = 1.0
    return out


def _lists(a: pd.Series, b: pd.Series) -> tuple[list[str], list[str]]:
    return a.fillna("").tolist(), b.fillna("").tolist()


@F.pandas_udf(DoubleType())
def _ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series(ratio_batch(*_lists(a, b)))


@F.pandas_udf(DoubleType())
def _token_sort(a: pd.Series, b: pd.Series) -> pd.Series:
    x, y = _lists(a, b)
    return pd.Series(ratio_batch([_sorted_tokens(s) for s in x], [_sorted_tokens(s) for s in y]))


@F.pandas_udf(DoubleType())
def _token_set(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series(token_set_batch(*_lists(a, b)))


@F.pandas_udf(DoubleType())
def _partial(a: pd.Series, b: pd.Series) -> pd.Series:
    x, y = _lists(a, b)
    return pd.Series(partial_ratio_batch(x, y))


@F.pandas_udf(DoubleType())
def _jaro_winkler(a: pd.Series, b: pd.Series) -> pd.Series:
    x, y = _lists(a, b)
    return pd.Series(jaro_winkler_batch(x, y))


def ratio(a: Value, b: Value) -> Column:
    return _ratio(col(a), col(b))


def token_sort_ratio(a: Value, b: Value) -> Column:
    return _token_sort(col(a), col(b))


def token_set_ratio(a: Value, b: Value) -> Column:
    return _token_set(col(a), col(b))


def partial_ratio_column(a: Value, b: Value) -> Column:
    return _partial(col(a), col(b))


def jaro_winkler(a: Value, b: Value) -> Column:
    return _jaro_winkler(col(a), col(b))


def ratio_native(a: Column, b: Column) -> Column:
    """``ratio`` of short strings without a Python worker: a row of the LCS table is folded over the characters of ``a``."""
    chars = lambda s: F.filter(F.split(s, ""), lambda c: c != "")

    def table(x: Column, y: Column) -> Column:
        def row(above: Column, ch: Column) -> Column:
            step = lambda acc, j: F.concat(
                acc,
                F.array(F.when(F.get(y, j) == ch, F.get(above, j) + 1).otherwise(F.greatest(F.get(above, j + 1), F.element_at(acc, -1)))),
            )
            return F.aggregate(F.sequence(F.lit(0), F.size(y) - 1), F.array(F.lit(0)), step)

        last = F.aggregate(x, F.transform(F.sequence(F.lit(0), F.size(y)), lambda _: F.lit(0)), row)
        return F.when((F.size(x) == 0) | (F.size(y) == 0), F.lit(0)).otherwise(F.element_at(last, -1))

    total = F.length(a) + F.length(b)
    common = let(chars(a), lambda x: let(chars(b), lambda y: table(x, y)))
    return F.when(total == 0, F.lit(100.0)).otherwise(F.lit(200.0) * common / total)


def house_number_relation(a: Value, b: Value) -> Column:
    """-1 one missing, 0 equal, 1 suffix, 2 prefix, 3 one digit differs, 4 digits swapped, 5 other; the first that holds."""
    x, y = F.coalesce(col(a), F.lit("")), F.coalesce(col(b), F.lit(""))
    digits = lambda s: F.array_sort(F.split(s, ""))
    differ = F.aggregate(F.zip_with(F.split(x, ""), F.split(y, ""), lambda p, q: (p != q).cast("int")), F.lit(0), lambda acc, v: acc + v)
    same_length = F.length(x) == F.length(y)
    return (
        F.when((x == "") | (y == ""), -1).when(x == y, 0).when(x.endswith(y) | y.endswith(x), 1).when(x.startswith(y) | y.startswith(x), 2)
        .when(same_length & (differ == 1), 3).when(same_length & (digits(x) == digits(y)), 4).otherwise(5)
    )


def tokens_unmatched_batch(xs: list[list[str]], ys: list[list[str]], least: float = 80.0) -> np.ndarray:
    """For each row, how many tokens of x have no like in y: equal, of ratio ``least``, or one a prefix of the other."""
    out = np.zeros(len(xs), np.int64)
    owner, left, right = [], [], []
    for i, (x, y) in enumerate(zip(xs, ys, strict=True)):
        known = set(y)
        for t in x:
            if t in known:
                continue
            if any(len(t) >= 3 and len(u) >= 3 and (t.startswith(u) or u.startswith(t)) for u in y):
                continue
            out[i] += 1
            for u in known:
                if 200 * min(len(t), len(u)) >= least * (len(t) + len(u)):
                    owner.append((i, t))
                    left.append(t)
                    right.append(u)
    if left:
        near = {o for o, r in zip(owner, ratio_batch(left, right), strict=True) if r >= least}
        for i, t in near:
            out[i] -= xs[i].count(t)
    return out


@F.pandas_udf(LongType())
def _tokens_unmatched(a: pd.Series, b: pd.Series) -> pd.Series:
    x, y = _lists(a, b)
    return pd.Series(tokens_unmatched_batch([s.split() for s in x], [s.split() for s in y]))


def tokens_unmatched(a: Value, b: Value) -> Column:
    """Tokens of ``a`` (space-joined) that have no like in ``b``."""
    return _tokens_unmatched(col(a), col(b))


def token_sort_native(a: Value, b: Value) -> Column:
    order = lambda s: F.array_join(F.array_sort(split_words(s)), " ")
    return ratio_native(order(a), order(b))
