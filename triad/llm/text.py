"""Word and shingle fingerprints of whole texts, vectorised over batches of texts.

Words are maximal runs outside blank, tab, line feed, vertical tab, form feed and carriage return. A word's
64-bit fingerprint is a polynomial over random byte weights, read off one prefix sum per batch, so no
Python runs per word. Fingerprints depend on the bytes only and agree between tasks and runs.
"""

from __future__ import annotations

import numpy as np
import pandas as pd

_BLANKS = b"\t\n\x0b\x0c\r"
TO_BLANK = bytes.maketrans(_BLANKS, b" " * len(_BLANKS))
LOWER_TO_BLANK = bytes.maketrans(_BLANKS + bytes(range(65, 91)), b" " * len(_BLANKS) + bytes(range(97, 123)))

_rng = np.random.default_rng(20240607)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_STEP = [np.uint64(int(x) | 1) for x in _rng.integers(1, 2**63, 2, dtype=np.uint64)]
_pow = {"n": 0}

#: Bytes of text handled at once; a longer text is handled alone.
BATCH_BYTES = 1 << 21


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if _pow["n"] < n:
        size = max(n, 1 << 16)
        up, down = np.full(size, _BASE), np.full(size, _BASE_INV)
        up[0] = down[0] = np.uint64(1)
        np.multiply.accumulate(up, out=up)
        np.multiply.accumulate(down, out=down)
        if size > 2 * BATCH_BYTES:  # one very long text: do not keep its tables
            return up, down
        _pow.update(n=size, up=up, down=down)
    return _pow["up"], _pow["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """Final avalanche of 64-bit values (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def encoded(texts) -> list[bytes]:
    """UTF-8 of each text, nothing for null."""
    return [t.encode("utf-8", "replace") if isinstance(t, str) else b"" for t in texts]


def batches(raw: list[bytes], limit: int = BATCH_BYTES):
    """Index ranges [a, b) of texts of about ``limit`` bytes together."""
    a = total = 0
    for b, t in enumerate(raw):
        if total and total + len(t) > limit:
            yield a, b
            a, total = b, 0
        total += len(t) + 1
    if a < len(raw):
        yield a, len(raw)


class Words:
    """The words of a batch: ``hash`` (uint64), ``doc`` (index in the batch), ``start``/``end`` (bytes in ``buffer``),
    ``bounds`` (first word of each text, then the number of words)."""

    def __init__(self, raw: list[bytes], table: bytes = TO_BLANK):
        joined = b"\n".join(raw)
        self.source = joined
        self.buffer = joined.translate(table)
        arr = np.frombuffer(self.buffer, np.uint8)
        solid = np.empty(len(arr) + 2, bool)
        solid[0] = solid[-1] = False
        np.not_equal(arr, 32, out=solid[1:-1])
        edge = np.flatnonzero(solid[1:] != solid[:-1])
        self.start, self.end = edge[0::2], edge[1::2]
        lengths = np.fromiter(map(len, raw), np.int64, len(raw)) + 1
        self.offsets = np.concatenate([[0], np.cumsum(lengths)])
        self.bounds = np.searchsorted(self.start, self.offsets)
        self.bounds[-1] = len(self.start)
        self.doc = np.repeat(np.arange(len(raw)), np.diff(self.bounds))
        if len(self.start):
            up, down = _powers(len(arr) + 1)
            sums = np.empty(len(arr) + 1, np.uint64)
            sums[0] = 0
            np.cumsum(_BYTE[arr] * up[:len(arr)], out=sums[1:])
            self.hash = mix((sums[self.end] - sums[self.start]) * down[self.start])
        else:
            self.hash = np.empty(0, np.uint64)

    def lines(self) -> tuple[np.ndarray, np.ndarray]:
        """Line number within the text of each word, and the number of lines of each text."""
        breaks = np.flatnonzero(np.frombuffer(self.source, np.uint8) == 10)
        upto = np.searchsorted(breaks, self.offsets[:-1])  # breaks before each text, joints included
        line = np.searchsorted(breaks, self.start) - upto[self.doc]
        after = np.append(upto[1:], len(breaks) + 1)
        return line, after - upto

    def shingles(self, k: int, which: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Fingerprints of all runs of ``k`` words inside one text, and the index of their first words."""
        n = len(self.hash) - k + 1
        if n <= 0:
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        at = np.flatnonzero(self.doc[:n] == self.doc[k - 1:])
        return mix(run_hash(self.hash, k, which))[at], at


def run_hash(h: np.ndarray, k: int, which: int = 0) -> np.ndarray:
    """Order-sensitive combination of every run of ``k`` word fingerprints; ``which`` picks one of two families."""
    step, n = _STEP[which], len(h) - k + 1
    out = np.full(n, np.uint64(k))
    for j in range(k):
        out *= step
        out += h[j:j + n]
    return out


def word_sets(raw: list[bytes], k: int, table: bytes = LOWER_TO_BLANK):
    """Per text: the sorted distinct fingerprints of its ``k``-word shingles; a text of fewer words has its whole
    sequence as the one shingle; a text without words has none."""
    for a, b in batches(raw):
        w = Words(raw[a:b], table)
        h, at = w.shingles(k)
        cut = np.searchsorted(at, w.bounds)
        for i in range(b - a):
            lo, hi = w.bounds[i], w.bounds[i + 1]
            if hi - lo >= k:
                yield np.unique(h[cut[i]:cut[i + 1]])
            elif hi > lo:
                yield mix(run_hash(w.hash[lo:hi], hi - lo))
            else:
                yield np.empty(0, np.uint64)


def column(values, dtype=object) -> pd.Series:
    return pd.Series(values, dtype=dtype)
