"""Vectorised word splitting, window hashing and winnowing over batches of UTF-8 texts.

Words and windows are hashed by polynomials modulo 2**64 and a mixing step, from
prefix sums: any window's hash takes one subtraction and one product.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_BYTE_BASE = 0x9E3779B97F4A7C15
_WORD_BASE = 0xD6E8FEB86659FD93
_BLOCK = 1 << 20

_NOT_SPACE = np.ones(256, bool)
_NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
_ALNUM = np.zeros(256, bool)
_ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_SAME = np.arange(256, dtype=np.uint8)
_FOLD = _SAME.copy()
_FOLD[0x41:0x5B] += 32

#: Word classes by name: which bytes belong to a word (after folding), and the folding.
CLASSES = {"space": (_NOT_SPACE, _SAME), "alnum_lower": (_ALNUM, _FOLD)}


_POWERS: dict = {}


def powers(base: int, n: int, inverse: bool = False) -> np.ndarray:
    """base ** i for i < n, or of its inverse; those for one block are kept."""
    kept = _POWERS.get((base, inverse))
    if kept is None or len(kept) < n:
        kept = np.full(max(n, 1 << 16), pow(base, -1, 1 << 64) if inverse else base, np.uint64)
        kept[0] = 1
        kept = np.multiply.accumulate(kept)
        if n <= 4 * _BLOCK:
            _POWERS[base, inverse] = kept
    return kept[:n]


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@dataclass
class Words:
    """Words of a run of texts; doc and first say to which text each belongs."""

    buf: bytes
    starts: np.ndarray
    ends: np.ndarray
    doc: np.ndarray
    first: np.ndarray  # index of each text's first word, and the end
    hashes: np.ndarray
    prefix: np.ndarray

    def window(self, at: np.ndarray, length) -> np.ndarray:
        """Hash of the words [at, at + length)."""
        raw = self.prefix[at + length] - self.prefix[at]
        inv = powers(_WORD_BASE, int(at.max()) + 1 if at.size else 1, inverse=True)
        return mix(raw * inv[at] + np.atleast_1d(np.asarray(length, np.uint64)) * np.uint64(_BYTE_BASE))

    def windows(self, length: int) -> np.ndarray:
        """Hash of the window at every word at which one fits."""
        n = len(self.hashes) - length + 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        raw = self.prefix[length:] - self.prefix[:n]
        return mix(raw * powers(_WORD_BASE, n, inverse=True) + np.uint64(length * _BYTE_BASE & (1 << 64) - 1))

    def whole(self, length: int) -> np.ndarray:
        """Starts of the windows of that length which stay inside one text."""
        n = len(self.hashes) - length + 1
        if n <= 0:
            return np.zeros(0, np.int64)
        return np.flatnonzero(self.doc[:n] == self.doc[length - 1 :])


def _word_hashes(b: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: np.ndarray) -> np.ndarray:
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = max(int(np.searchsorted(ends, starts[i] + _BLOCK, "right")), i + 1)
        lo, hi = int(starts[i]), int(ends[j - 1])
        sums = np.zeros(hi - lo + 1, np.uint64)
        values = fold[b[lo:hi]].astype(np.uint64)
        values += np.uint64(1)
        values *= powers(_BYTE_BASE, hi - lo)
        np.cumsum(values, out=sums[1:])
        s, e = starts[i:j] - lo, ends[i:j] - lo
        out[i:j] = (sums[e] - sums[s]) * powers(_BYTE_BASE, hi - lo, inverse=True)[s]
        i = j
    return mix(out + (ends - starts).astype(np.uint64))


def scan(texts: list[bytes], kind: str) -> Words:
    table, fold = CLASSES[kind]
    buf = b"\n".join(texts) + b"\n"
    b = np.frombuffer(buf, np.uint8)
    inside = np.zeros(len(b) + 1, bool)
    inside[1:] = table[fold[b]]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[0::2], edges[1::2]
    at = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=at[1:])
    first = np.searchsorted(starts, at)
    doc = np.repeat(np.arange(len(texts)), np.diff(first))
    hashes = _word_hashes(b, starts, ends, fold)
    prefix = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * powers(_WORD_BASE, len(hashes)), out=prefix[1:])
    return Words(buf, starts, ends, doc, first, hashes, prefix)


def sliding_argmin(v: np.ndarray, width: int) -> np.ndarray:
    """Index of the leftmost least value of every window of that width."""
    at, span = np.arange(len(v)), 1
    while span < width:
        step = min(span, width - span)
        right = v[step:] < v[:-step]
        at = np.where(right, at[step:], at[:-step])
        v = np.where(right, v[step:], v[:-step])
        span += step
    return at


def anchors(words: Words, window: int, gram: int):
    """Winnowed anchors: (anchor, first window, last window, seed hash), one row each.

    Every window of `window` words takes the leftmost least hash among its grams of
    `gram` words; windows of equal words so take anchors at the same offset. An anchor
    stands for the run of windows that took it.
    """
    s = words.whole(window)
    if not s.size:
        none = np.zeros(0, np.int64)
        return none, none, none, np.zeros(0, np.uint64)
    grams = words.windows(gram)
    took = sliding_argmin(grams, window - gram + 1)[s]
    cut = np.flatnonzero(took[1:] != took[:-1]) + 1
    lo, hi = s[np.r_[0, cut]], s[np.r_[cut - 1, len(s) - 1]]
    at = took[np.r_[0, cut]]
    return at, lo, hi, grams[at]


def covered(n: int, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Which of n places lie in any [lo, hi)."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, lo, 1)
    np.add.at(step, hi, -1)
    return np.cumsum(step[:-1]) > 0
