"""Hashed text features and the small optimiser that the trained classifiers share.

A text's features are the distinct words and word beginnings it holds (hashed), how dense each pair of neighbouring
character kinds is (lower case, upper case, digit, space, line end, other control, non-ASCII, and every ASCII
punctuation mark), and the share of words that repeat the word before them. Words carry meaning, their beginnings do so
across inflections, and the rest is the look of a text.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from quarry.llm.common import give_back, let_go
from quarry.llm.minhash import word_hashes

WORD_BITS = 18
STEP = 128                   # texts whose features are held at a time
WORDS = 1 << WORD_BITS
_KIND = np.zeros(256, np.int64)
for _b in range(256):
    _c = chr(_b)
    _KIND[_b] = (6 if _b >= 128 else 0 if _c.islower() else 1 if _c.isupper() else 2 if _c.isdigit() else
                 3 if _c == " " else 4 if _c in "\r\n" else 5 if _b < 32 or _b == 127 else 7)
_marks = np.flatnonzero(_KIND == 7)
_KIND[_marks] = 7 + np.arange(len(_marks))
KINDS = int(_KIND.max()) + 1
REPEAT = WORDS + KINDS * KINDS
DIM = REPEAT + 1
BEGINNINGS = (4, 5, 6)       # bytes
LEAST = 5                    # rows that a word must be in to get a weight


@dataclass
class Rows:
    """Sparse rows: row ``i`` has ``index`` and ``value`` from ``begin[i]`` to ``begin[i + 1]``."""
    begin: np.ndarray
    index: np.ndarray
    value: np.ndarray

    def __len__(self) -> int:
        return len(self.begin) - 1

    def row_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self), dtype=np.int32), np.diff(self.begin))

    def take(self, rows: np.ndarray) -> Rows:
        n = np.diff(self.begin)[rows]
        begin = np.concatenate([[0], np.cumsum(n)])
        at = np.repeat((self.begin[rows] - begin[:-1]).astype(np.int32), n) + np.arange(begin[-1], dtype=np.int32)
        return Rows(begin, self.index[at], self.value[at])

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row_of(), weights=self.value * w[self.index], minlength=len(self))


def features(texts: pa.Array, used: np.ndarray | None = None) -> Rows:
    """Features of a batch of texts, or only those marked in ``used``; a null, empty or wordless text has no word
    features."""
    h, words, *begins = word_hashes(texts, BEGINNINGS)
    doc = np.repeat(np.arange(len(words)), words)
    found = []
    for part in (h, *begins):
        at = (part >> np.uint64(64 - WORD_BITS)).astype(np.int64)
        good = part > 0 if used is None else (part > 0) & used[at]
        found.append(doc[good] * WORDS + at[good])
    word = np.unique(np.concatenate(found))
    same = np.bincount(doc[1:][(h[1:] == h[:-1]) & (doc[1:] == doc[:-1])], minlength=len(words))
    text = texts.cast(pa.large_binary()).fill_null(b"")
    counts = []
    for i, raw in enumerate(text):
        kind = _KIND[np.frombuffer(raw.as_buffer(), np.uint8)]
        n = np.zeros(KINDS * KINDS)
        for lo in range(0, len(kind) - 1, 1 << 20):
            part = kind[lo:lo + (1 << 20) + 1]
            n += np.bincount(part[:-1] * KINDS + part[1:], minlength=KINDS * KINDS)
        at = np.flatnonzero(n)
        if same[i]:
            counts.append((np.array([i]), np.array([REPEAT]), np.array([4 * np.sqrt(same[i] / words[i])])))
        counts.append((np.full(len(at), i), at + WORDS, 4 * np.sqrt(n[at] / max(1, len(kind) - 1))))
    row = np.concatenate([word // WORDS, *[c[0] for c in counts]])
    index = np.concatenate([word % WORDS, *[c[1] for c in counts]])
    value = np.concatenate([np.ones(len(word)), *[c[2] for c in counts]])
    order = np.argsort(row, kind="stable")
    begin = np.searchsorted(row[order], np.arange(len(texts) + 1))
    return Rows(begin, index[order].astype(np.int64), value[order])


def pack_rows(r: Rows) -> list[bytes]:
    """Each row as bytes: 32-bit indices, then 32-bit values."""
    return [r.index[a:b].astype(np.int32).tobytes() + r.value[a:b].astype(np.float32).tobytes()
            for a, b in zip(r.begin[:-1], r.begin[1:])]


def packed(text: Column) -> Column:
    """Packed features of a text column."""
    @F.arrow_udf("binary")
    def pack(texts: pa.Array) -> pa.Array:
        let_go(__name__)
        out: list[bytes] = []
        for at in range(0, len(texts), STEP):
            out.extend(pack_rows(features(texts.slice(at, STEP))))
        give_back()
        return pa.array(out, pa.binary())

    return pack(text)


def unpack_rows(raw: list, least: int = 1) -> Rows:
    """Rows from their bytes or Arrow buffers; indices and values stay 32 bits wide. Words in fewer than ``least`` of
    the rows are left out, before anything is put together: they are most of what a sample holds, and
    :func:`telling` would give them no weight."""
    index = [np.frombuffer(r, np.int32, memoryview(r).nbytes // 8) for r in raw]
    seen = np.zeros(DIM, np.int32)
    seen[WORDS:] = least
    for i in index:
        seen[i] += 1                                           # an index stands once in a row
    keep = [seen[i] >= least for i in index]
    n = np.array([k.sum() for k in keep], np.int64)
    begin = np.concatenate([[0], np.cumsum(n)])
    out, value = np.empty(begin[-1], np.int32), np.empty(begin[-1], np.float32)
    for r, i, k, a, b in zip(raw, index, keep, begin[:-1], begin[1:]):
        out[a:b] = i[k]
        value[a:b] = np.frombuffer(r, np.float32, offset=4 * len(i))[k]
    return Rows(begin, out, value)


def telling(r: Rows, label: np.ndarray, z: float = 5.0, least: int = LEAST) -> np.ndarray:
    """Indices worth a weight: pairs of kinds, and words in at least ``least`` rows whose share of rows with some
    label differs from that of the others by ``z`` standard errors."""
    word = r.index < WORDS
    index, row = r.index[word], r.row_of()[word]
    every = np.bincount(index, minlength=WORDS)
    keep = np.zeros(WORDS, bool)
    for k in np.unique(label):
        mine = label == k
        n, m = int(mine.sum()), int((~mine).sum())
        if not n or not m:
            continue
        has = np.bincount(index[mine[row]], minlength=WORDS)
        p = every / (n + m)
        error = np.sqrt(np.maximum(p * (1 - p), 1e-12) * (1 / n + 1 / m))
        keep |= (every >= least) & (np.abs(has / n - (every - has) / m) >= z * error)
    return np.concatenate([np.flatnonzero(keep), np.unique(r.index[~word])])


def restrict(r: Rows, index: np.ndarray) -> Rows:
    """Only the features in ``index`` (ordered), renumbered."""
    at = np.empty(len(r.index), np.int32)
    good = np.zeros(len(r.index), bool)
    for lo in range(0, len(at) if len(index) else 0, 1 << 18):        # in parts: the numbers between are wide
        here = r.index[lo:lo + (1 << 18)]
        found = np.minimum(np.searchsorted(index, here), len(index) - 1)
        at[lo:lo + (1 << 18)], good[lo:lo + (1 << 18)] = found, index[found] == here
    begin = np.append(np.int32(0), np.cumsum(good, dtype=np.int32))[r.begin].astype(np.int64)
    return Rows(begin, at[good], r.value[good])


def minimise(f: Callable[[np.ndarray], tuple[float, np.ndarray]], x: np.ndarray, steps: int = 100,
             memory: int = 10, small: float = 1e-5) -> np.ndarray:
    """L-BFGS with backtracking. ``f`` gives value and gradient."""
    value, grad = f(x)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        if np.abs(grad).max(initial=0) < small:
            break
        d, a = grad.copy(), []
        for s, y in reversed(past):
            a.append((s @ d) / (s @ y))
            d -= a[-1] * y
        if past:
            s, y = past[-1]
            d *= (s @ y) / (y @ y)
        for (s, y), k in zip(past, reversed(a)):
            d += s * (k - (y @ d) / (s @ y))
        slope, rate = grad @ d, 1.0 if past else min(1.0, 1 / np.abs(grad).sum())
        while True:
            new, (v, g) = x - rate * d, f(x - rate * d)
            if v <= value - 1e-4 * rate * slope or rate < 1e-10:
                break
            rate /= 2
        if rate < 1e-10:
            break
        s, y = new - x, g - grad
        if s @ y > 1e-12:
            past = [*past[-(memory - 1):], (s, y)]
        x, value, grad = new, v, g
    return x


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))
