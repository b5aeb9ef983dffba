r"""Operator 9: personal data by base rules and a character-level bidirectional LSTM with CRF transitions.

The base finds e-mail addresses, IPv4 addresses, payment cards and phone numbers by the rules below (leftmost, not
overlapping within a kind; matches that fail their check are dropped). The tagger, in numpy, adds what the rules miss,
such as ``name (at) site.org``, ``(555) 010-2345`` or ``4485.1234.5678.9012``: characters become one of some 30 classes,
two LSTMs of ``HIDDEN`` units read them in both directions, and a linear-chain CRF over {other, email, ip, card, phone}
decodes them. No span is accepted without a digit, an at sign or one spelled out, so the tagger reads the stretches of
``REACH`` characters about those; the rest of a text can't give a span. Every such stretch of a whole text is read, in
windows of ``WINDOW`` characters that overlap by ``OVERLAP``; in an overlap each character takes its emissions from the
window in which it stands farther inside, and one path is decoded over the whole stretch, across its windows. Each window
is read from its own ends, so a text's spans don't depend on the texts read with it. Added spans must be valid for their
kind (number of digits, their ranges, Luhn) and not touch a base span.

Training: windows of a bounded sample of documents (``sample_rows`` rows, the first by hash of the id, of each an excerpt of
at most ``EXCERPT`` characters at a place chosen by hash), with their base spans as labels and with generated items,
regular and irregular, planted between words; Adam on the CRF likelihood, on the driver.

Nulls and edge cases: null text is empty and has no spans; a very long text is read whole; equal starts of different kinds
are listed by kind; repeated rows give equal results; a null doc_id is kept and trains nothing; with an empty table only
generated windows train and there are no rows; other columns pass ``redact`` untouched and are ignored by ``find``.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ligatura.llm.common import mapped_rows, table

KINDS = ("email", "ip", "card", "phone")
WINDOW, OVERLAP, REACH = 512, 128, 128
HIDDEN = 32
SAMPLE_ROWS, EXCERPT = 1500, 20_000
#: Windows read at once; always so many, so that equal windows meet equal arithmetic whatever stands beside them.
ROWS = 128

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_SITE = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGITS = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = int(d) * (1 + k % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind index, start, end) of the base rules, by kind and start; end exclusive, in code points."""
    out = []
    at, last = text.find("@"), 0
    while at >= 0:  # the local part reaches back to the previous match at most; a site must follow
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        site = _SITE.match(text, at + 1) if start < at else None
        if site:
            out.append((0, start, site.end()))
            last = site.end()
        at = text.find("@", max(at + 1, last))
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append((1, *m.span()))
    for m in _CARD.finditer(text):
        digits = _DIGITS.sub("", m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append((2, *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_DIGITS.sub("", m[0])) <= 15:
                out.append((3, *m.span()))
    return out


# ------------------------------------------------------------------ characters

_SINGLE = " \n@.-+()[]/:,_%=\"'#&|<>*"
N_CLASSES = 7 + len(_SINGLE)
_CLASS = np.zeros(0x250, np.uint8)  # 0: any other character
for _c in range(0x250):
    _ch = chr(_c)
    if _ch.isascii() and _ch.isdigit():
        _CLASS[_c] = 1
    elif _ch.isascii() and _ch.islower():
        _CLASS[_c] = 2
    elif _ch.isascii() and _ch.isupper():
        _CLASS[_c] = 3
    elif _ch.isalpha():
        _CLASS[_c] = 4
    elif _ch in _SINGLE:
        _CLASS[_c] = 7 + _SINGLE.index(_ch)
_CLASS[[ord("a"), ord("t")]] = 5  # of "at"
_CLASS[[ord("d"), ord("o")]] = 6  # of "dot"


def classes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(points < len(_CLASS), _CLASS[np.minimum(points, len(_CLASS) - 1)], 0).astype(np.uint8)


# ----------------------------------------------------------------------- model


@dataclass
class Tagger:
    """Two LSTMs (input tables by class, recurrent weights), an output layer and CRF transitions."""

    tables: list[np.ndarray]  # per direction (N_CLASSES, 4H): input, forget, output gates, then the candidate
    recurrent: list[np.ndarray]  # per direction (H, 4H)
    out: np.ndarray  # (2H, 5)
    bias: np.ndarray  # (5,)
    transitions: np.ndarray  # (5, 5)

    def params(self) -> list[np.ndarray]:
        return [*self.tables, *self.recurrent, self.out, self.bias, self.transitions]


def new_tagger(seed: int = 3, hidden: int = HIDDEN) -> Tagger:
    rng = np.random.default_rng(seed)
    tables = [rng.normal(0, 0.3, (N_CLASSES, 4 * hidden)).astype(np.float32) for _ in range(2)]
    for t in tables:
        t[:, hidden : 2 * hidden] += 1.0  # remember at first
    recurrent = [rng.normal(0, 1 / hidden**0.5, (hidden, 4 * hidden)).astype(np.float32) for _ in range(2)]
    k = len(KINDS) + 1
    return Tagger(tables, recurrent, rng.normal(0, 1 / hidden**0.5, (2 * hidden, k)).astype(np.float32), np.zeros(k, np.float32), np.eye(k, dtype=np.float32))


def run_lstm(codes: np.ndarray, tab: np.ndarray, rec: np.ndarray, keep: list | None = None) -> np.ndarray:
    """States (T, B, H) over codes (T, B)."""
    t, b = codes.shape
    hidden = rec.shape[0]
    h3 = 3 * hidden
    states = np.empty((t, b, hidden), np.float32)
    h = np.zeros((b, hidden), np.float32)
    c = np.zeros((b, hidden), np.float32)
    half = np.ones(4 * hidden, np.float32)
    half[:h3] = 0.5  # a sigmoid is 0.5 + 0.5 tanh(x / 2)
    tab, rec = tab * half, rec * half
    z = np.empty((b, 4 * hidden), np.float32)
    for k in range(t):
        np.matmul(h, rec, out=z)
        z += tab[codes[k]]
        np.tanh(z, out=z)
        gates = z[:, :h3] * np.float32(0.5) + np.float32(0.5)
        before = c
        c = gates[:, hidden : 2 * hidden] * c + gates[:, :hidden] * z[:, h3:]
        squashed = np.tanh(c)
        h = np.multiply(gates[:, 2 * hidden :], squashed, out=states[k])
        if keep is not None:
            keep.append((gates, z[:, h3:].copy(), before, squashed))
    return states


def turned(x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Columns of ``x`` (T, B, ...) turned about within their own lengths; what follows stays."""
    t = np.arange(len(x))[:, None]
    return x[np.where(t < lengths, lengths - 1 - t, t), np.arange(x.shape[1])]


def emissions(model: Tagger, codes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """(T, B, 5) over codes (T, B) of columns of their own lengths; each is read from its own ends."""
    hidden = model.recurrent[0].shape[0]
    e = run_lstm(codes, model.tables[0], model.recurrent[0]) @ model.out[:hidden]
    e += turned(run_lstm(turned(codes, lengths), model.tables[1], model.recurrent[1]), lengths) @ model.out[hidden:]
    return e + model.bias


def viterbi(e: np.ndarray, transitions: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Best labels (T, B) of emissions (T, B, K) over each column's own length, 0 beyond it."""
    t, b, k = e.shape
    back = np.zeros((t, b, k), np.uint8)
    score, same = e[0].copy(), np.arange(k, dtype=np.uint8)
    for i in range(1, t):
        options = score[:, :, None] + transitions
        go = (i < lengths)[:, None]
        back[i] = np.where(go, options.argmax(axis=1), same)
        score = np.where(go, options.max(axis=1) + e[i], score)
    labels = np.zeros((t, b), np.uint8)
    rows = np.arange(b)
    labels[-1] = score.argmax(axis=1)
    for i in range(t - 1, 0, -1):
        labels[i - 1] = back[i, rows, labels[i]]
    labels[np.arange(t)[:, None] >= lengths] = 0
    return labels


def _loss_gradients(model: Tagger, codes: np.ndarray, gold: np.ndarray) -> list[np.ndarray]:
    """Gradients of the mean CRF log-likelihood, in the order of ``params``; codes and gold are (T, B)."""
    t, b = codes.shape
    k = len(model.bias)
    hidden = model.recurrent[0].shape[0]
    kept: list[list] = [[], []]
    states = [run_lstm(codes, model.tables[0], model.recurrent[0], kept[0]), run_lstm(codes[::-1], model.tables[1], model.recurrent[1], kept[1])]  # all of one length
    both = np.concatenate([states[0], states[1][::-1]], axis=2)
    e = (both @ model.out + model.bias).astype(np.float64)
    a = np.exp(model.transitions.astype(np.float64))
    p = np.exp(e - e.max(axis=2, keepdims=True))
    alpha, beta = np.empty_like(p), np.empty_like(p)
    alpha[0], beta[-1] = p[0] / p[0].sum(axis=1, keepdims=True), 1.0
    for i in range(1, t):
        x = (alpha[i - 1] @ a) * p[i]
        alpha[i] = x / x.sum(axis=1, keepdims=True)
    for i in range(t - 2, -1, -1):
        x = (beta[i + 1] * p[i + 1]) @ a.T
        beta[i] = x / x.sum(axis=1, keepdims=True)
    gamma = alpha * beta
    gamma /= gamma.sum(axis=2, keepdims=True)
    pair = alpha[:-1, :, :, None] * a * (p[1:] * beta[1:])[:, :, None, :]
    pair /= pair.sum(axis=(2, 3), keepdims=True)
    g_trans = np.bincount((gold[:-1].astype(int) * k + gold[1:]).ravel(), minlength=k * k).reshape(k, k) - pair.sum(axis=(0, 1))
    d_e = (np.eye(k)[gold] - gamma).astype(np.float32) / b
    d_both = d_e @ model.out.T
    grads: list[list[np.ndarray]] = [[], []]
    for way in range(2):
        d_states = d_both[:, :, :hidden] if way == 0 else d_both[::-1, :, hidden:]
        seq = codes if way == 0 else codes[::-1]
        rec = model.recurrent[way]
        g_tab, g_rec = np.zeros((N_CLASSES, 4 * hidden)), np.zeros(rec.shape)
        d_h, d_c = np.zeros((b, hidden), np.float32), np.zeros((b, hidden), np.float32)
        for i in range(t - 1, -1, -1):
            gates, g, before, squashed = kept[way][i]
            d_h = d_h + d_states[i]
            d_c = d_c + d_h * gates[:, 2 * hidden :] * (1 - squashed**2)
            d_z = np.concatenate([d_c * g, d_c * before, d_h * squashed, d_c * gates[:, :hidden]], axis=1)
            d_z *= np.concatenate([gates * (1 - gates), 1 - g**2], axis=1)
            one_hot = np.zeros((b, N_CLASSES), np.float32)
            one_hot[np.arange(b), seq[i]] = 1
            g_tab += one_hot.T @ d_z
            if i:
                g_rec += states[way][i - 1].T @ d_z
            d_h = d_z @ rec.T
            d_c = d_c * gates[:, hidden : 2 * hidden]
        grads[way] = [g_tab, g_rec]
    flat = both.reshape(-1, 2 * hidden)
    return [grads[0][0], grads[1][0], grads[0][1], grads[1][1], flat.T @ d_e.reshape(-1, k), d_e.sum(axis=(0, 1)), g_trans / b]


def train(windows: list[tuple[np.ndarray, np.ndarray]], steps: int = 260, batch: int = 64, length: int = 96, rate: float = 0.03, seed: int = 11) -> Tagger:
    """Fit on (classes, labels) windows of at least ``length`` characters; shorter ones are padded by other text."""
    model = new_tagger()
    rng = np.random.default_rng(seed)
    moments = [(np.zeros(q.shape), np.zeros(q.shape)) for q in model.params()]
    for step in range(1, steps + 1):
        codes, gold = np.zeros((length, batch), np.uint8), np.zeros((length, batch), np.uint8)
        for col, w in enumerate(rng.integers(0, len(windows), batch)):
            x, y = windows[w]
            shift = int(rng.integers(0, max(1, len(x) - length + 1)))
            n = min(length, len(x) - shift)
            codes[:n, col], gold[:n, col] = x[shift : shift + n], y[shift : shift + n]
        decay = rate * min(1.0, 2 * (1 - step / (steps + 1)))
        for q, g, (m, v) in zip(model.params(), _loss_gradients(model, codes, gold), moments, strict=True):
            g = np.clip(g, -5, 5)
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            q += (decay * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-5)).astype(np.float32)
    return model


# -------------------------------------------------------------- training texts


def generated_item(rng: np.random.Generator) -> tuple[int, str]:
    """(label, text): an item of a kind (label 1 to 4), or a harmless look-alike (label 0)."""
    digits = lambda n: "".join(map(str, rng.integers(0, 10, n)))
    name = lambda: "".join(chr(97 + c) for c in rng.integers(0, 26, int(rng.integers(3, 9))))
    pick = lambda *x: x[int(rng.integers(0, len(x)))]
    kind = int(rng.integers(0, 6))
    if kind == 0:
        site = f"{name()}{pick('', digits(1))}.{pick('com', 'org', 'net', 'example.com', 'co.uk')}"
        user = name() + pick("", "." + name(), "." + digits(2), "_" + digits(2))
        return 1, pick(f"{user}@{site}", f"{user}@{site}", f"{user} (at) {site}", f"{user} [at] {site}", f"{user} at {name()} dot com")
    if kind == 1:
        return 2, ".".join(str(x) for x in rng.integers(0, 256, 4))
    if kind == 2:
        d = digits(int(pick(15, 15, 15, 18)))
        d += str(next(c for c in range(10) if luhn(d + str(c))))
        sep = pick("", "", " ", "-", ".", "/")
        return 3, sep.join(d[i : i + 4] for i in range(0, len(d), 4))
    if kind == 3:
        a, b, c = digits(3), digits(3), digits(4)
        return 4, pick(f"+1 ({a}) {b}-{c}", f"+{digits(2)} {a} {b} {c}", f"({a}) {b}-{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"+1.{a}.{b}.{c}", f"00{digits(2)} {a} {b} {c}")
    hexa = "".join(pick(*"0123456789abcdef") for _ in range(40))
    return 0, pick(
        digits(int(rng.integers(1, 9))), f"{digits(4)}-{digits(2)}-{digits(2)}", f"{digits(2)}:{digits(2)}", f"{digits(1)}.{digits(1)}.{digits(2)}", f'token = "{hexa}"',
        f"{digits(1)},{digits(3)}.{digits(2)}", f"({digits(4)})", f"{digits(2)} - {digits(2)}", f"@{name()}", f"{digits(2)}/{digits(2)}/{digits(4)}", f"page={digits(1)}&ref=x",
    )


def training_windows(texts: list[str], seed: int = 2, n: int = 4000, length: int = 160) -> list[tuple[np.ndarray, np.ndarray]]:
    """Windows of the sampled texts with their base spans, each with one generated item planted between two words."""
    rng = np.random.default_rng(seed)
    filler = ["lorem ipsum dolor sit amet, consetetur sadipscing. Elitr sed diam nonumy eirmod tempor invidunt ut labore et dolore magna aliquyam erat sed diam voluptua at vero."]
    source = [t for t in texts if len(t) > 40] or filler
    spans = [base_spans(t) for t in source]
    with_span = [i for i, s in enumerate(spans) if s]
    out = []
    for k in range(n):
        pool = with_span if with_span and k % 3 == 0 else range(len(source))
        i = pool[int(rng.integers(0, len(pool)))]
        t, found = source[i], spans[i]
        if k % 3 == 0 and found:
            _, s, e = found[int(rng.integers(0, len(found)))]
            a = max(0, (s + e) // 2 - length // 2)
        else:
            a = int(rng.integers(0, max(1, len(t) - length)))
        piece = t[a : a + length]
        label = np.zeros(len(piece), np.uint8)
        for kind, s, e in found:
            label[max(0, s - a) : max(0, e - a)] = kind + 1
        gaps = [m.start() for m in re.finditer(" ", piece) if not label[m.start()]]
        if k % 3 and gaps:
            g = gaps[int(rng.integers(0, len(gaps)))]
            kind, item = generated_item(rng)
            piece = f"{piece[: g + 1]}{item} {piece[g + 1 :]}"
            label = np.concatenate([label[: g + 1], np.full(len(item), kind, np.uint8), [0], label[g + 1 :]]).astype(np.uint8)
        out.append((classes(piece), label))
    return out


def fit(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Tagger:
    """Train on a bounded sample of the documents with a digit or an at sign, the first by hash."""
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null").where(F.col("text").rlike("@|[0-9]"))
    order = [F.xxhash64("doc_id"), "doc_id"]
    chosen = named.select("doc_id").orderBy(*order).limit(sample_rows).distinct()
    place = F.pmod(F.xxhash64("text"), F.greatest(F.length("text") - EXCERPT, F.lit(0)) + 1) + 1
    cut = named.join(F.broadcast(chosen), "doc_id", "left_semi").select("doc_id", F.col("text").substr(place.cast("int"), F.lit(EXCERPT)).alias("text"))  # at most sample_rows ids
    rows = cut.orderBy(*order, "text").limit(sample_rows).toPandas()  # repeated ids don't add rows
    return train(training_windows(rows["text"].to_list()))


# --------------------------------------------------------------------- tagging


_SPELLED = re.compile(r"[(\[]at[)\]]| dot ")


def stretches(text: str, coded: np.ndarray) -> list[tuple[int, int]]:
    """(start, end) of what lies within REACH of a digit, an at sign or one spelled out: all that can hold a span."""
    at = np.flatnonzero((coded == 1) | (coded == 7 + _SINGLE.index("@")))
    if "at)" in text or "at]" in text or " dot " in text:
        at = np.sort(np.concatenate([at, np.array([m.start() for m in _SPELLED.finditer(text)], np.int64)]))
    if not len(at):
        return []
    far = np.flatnonzero(np.diff(at) > 2 * REACH)
    starts, ends = at[np.concatenate([[0], far + 1])], at[np.concatenate([far, [len(at) - 1]])]
    return [(max(0, int(a) - REACH), min(len(coded), int(b) + REACH + 1)) for a, b in zip(starts, ends, strict=True)]


def label_texts(model: Tagger, texts: list[str]) -> list[np.ndarray]:
    """The label of each character of each text."""
    coded = [classes(t) for t in texts]
    out = [np.zeros(len(c), np.uint8) for c in coded]
    pieces = [(b - a, i, a) for i, (t, c) in enumerate(zip(texts, coded, strict=True)) for a, b in stretches(t, c)]
    pieces.sort()
    stride = WINDOW - OVERLAP
    tiles = [(min(WINDOW, n - s), p, s) for p, (n, _, _) in enumerate(pieces) for s in range(0, max(1, n - OVERLAP), stride)]
    read = [np.empty((n, len(model.bias)), np.float32) for n, _, _ in pieces]
    for k in range(0, len(tiles), ROWS):
        part = tiles[k : k + ROWS]
        lengths = np.ones(ROWS, np.int64)
        codes = np.zeros((max(n for n, _, _ in part), ROWS), np.uint8)
        for col, (n, p, s) in enumerate(part):
            _, i, a = pieces[p]
            codes[:n, col], lengths[col] = coded[i][a + s : a + s + n], n
        e = emissions(model, codes, lengths)
        for col, (n, p, s) in enumerate(part):
            x, y = (0 if s == 0 else OVERLAP // 2), (n if s + n == pieces[p][0] else n - OVERLAP // 2)
            read[p][s + x : s + y] = e[x:y, col]
    for k in range(0, len(pieces), ROWS):
        part = pieces[k : k + ROWS]
        lengths = np.array([n for n, _, _ in part])
        e = np.zeros((int(lengths[-1]), len(part), len(model.bias)), np.float32)
        for col, got in enumerate(read[k : k + ROWS]):
            e[: len(got), col] = got
        for col, (n, i, a) in enumerate(part):
            if col == 0:
                labels = viterbi(e, model.transitions, lengths)
            out[i][a : a + n] = labels[:n, col]
    return out


def runs(labels: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(kind, start, end) of runs of one label."""
    if labels.any():
        edges = np.flatnonzero(np.diff(labels)) + 1
        for a, b in zip(np.r_[0, edges], np.r_[edges, len(labels)], strict=True):
            if labels[a]:
                yield int(labels[a]) - 1, int(a), int(b)


_NUMBERS = re.compile(r"[0-9]+")
_IP_MARKS, _CARD_MARKS, _PHONE_MARKS = (frozenset("0123456789" + m) for m in (" .[]()dot", " ./_-", " ().+/-"))


def accepted(kind: int, text: str) -> bool:
    """Whether an added span is valid for its kind."""
    digits = _DIGITS.sub("", text)
    if kind == 0:
        site = re.split(r"@|\(at\)|\[at\]| at ", text)
        return len(site) == 2 and "\n" not in text and site[0].strip() != "" and ("." in site[1].strip(". ") or " dot " in site[1])
    if kind == 1:
        numbers = _NUMBERS.findall(text)
        return len(numbers) == 4 and _IP_MARKS.issuperset(text) and all(len(x) <= 3 and int(x) <= 255 for x in numbers)
    if kind == 2:
        return 16 <= len(digits) <= 19 and _CARD_MARKS.issuperset(text) and luhn(digits)
    return 10 <= len(digits) <= 15 and _PHONE_MARKS.issuperset(text) and len(text) >= len(digits) + 2


def all_spans(model: Tagger, texts: list[str]) -> list[tuple[list, list]]:
    """(base spans, all spans) of each text, each by kind and start."""
    out = []
    for text, labels in zip(texts, label_texts(model, texts), strict=True):
        base = base_spans(text)
        every = list(base)
        for kind, a, b in runs(labels):
            while b > a and text[b - 1] in " .,;:!?\n-":
                b -= 1
            while a < b and text[a] in " .,;:!?\n-":
                a += 1
            if a < b and accepted(kind, text[a:b]) and not any(s < b and a < e for _, s, e in base):
                every.append((kind, a, b))
        out.append((base, sorted(every)))
    return out


def spell(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def _slices(texts: list[str], limit: int = 1_000_000) -> Iterator[tuple[int, int]]:
    first = total = 0
    for k, t in enumerate(texts):
        if k > first and total + len(t) > limit:
            yield first, k
            first, total = k, 0
        total += len(t)
    if len(texts) > first:
        yield first, len(texts)


def find(docs: DataFrame, model: Tagger) -> DataFrame:
    """doc_id, base counts, base_sha256 and spans of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for first, last in _slices(texts):
                got = all_spans(model, texts[first:last])
                counts = [[sum(k == kind for k, _, _ in base) for base, _ in got] for kind in range(4)]
                sums = [hashlib.sha256(spell(base).encode()).hexdigest() for base, _ in got]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(first, last - first), *(pa.array(c, pa.int64()) for c in counts), pa.array(sums), pa.array([spell(every) for _, every in got])],
                    ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"],
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def redact_text(text: str, spans: list[tuple[int, int, int]]) -> str:
    """Replace each span by its kind in brackets; of overlapping spans the first and then the longest counts."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a < at:
            at = max(at, b)
            continue
        out += [text[at:a], f"[{KINDS[kind].upper()}]"]
        at = b
    return "".join(out) + text[at:]


def redact(docs: DataFrame, model: Tagger) -> DataFrame:
    """``docs`` with personal data replaced in ``text`` (and n_chars, if there, counted anew)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            new: list[str | None] = []
            for first, last in _slices([t or "" for t in texts]):
                part = texts[first:last]
                for t, (_, every) in zip(part, all_spans(model, [t or "" for t in part]), strict=True):
                    new.append(redact_text(t, every) if every else t)
            columns = {name: batch.column(name) for name in batch.schema.names}
            changed = [a is not b for a, b in zip(texts, new, strict=True)]
            columns["text"] = pa.array(new, pa.string())
            if "n_chars" in columns and any(changed):
                old = columns["n_chars"].to_pylist()
                columns["n_chars"] = pa.array([len(t) if c else o for t, c, o in zip(new, changed, old, strict=True)], batch.schema.field("n_chars").type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return mapped_rows(docs, run)


def op9_pii_tagger(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return find(docs, fit(docs))
