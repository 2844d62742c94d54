"""Array code for words of whole texts: spans, 64-bit word hashes, rolling window hashes.

Words are runs of bytes other than space and 0x09-0x0D.  A word's hash is a
polynomial over its bytes modulo 2**64 read off prefix sums, then mixed; a
window's hash is a polynomial over its words' hashes, mixed again.
"""

from __future__ import annotations

import numpy as np

MULTIPLIERS = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)  # odd, so they have inverses modulo 2**64
SEGMENT = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the output (splitmix64's constants)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_spans(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the words of a byte array."""
    inside = np.empty(len(buf) + 2, bool)
    inside[0] = inside[-1] = False
    inside[1:-1] = (buf != 32) & ((buf < 9) | (buf > 13))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2]


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    if n > 1:
        out[1] = base
        k = 2
        while k < n:  # doubling: base**(k + i) = base**k * base**i
            m = min(k, n - k)
            out[k : k + m] = out[:m] * np.uint64(int(out[k - 1]) * base % (1 << 64))
            k += m
    return out


class WordHasher:
    """Hashes words with one of MULTIPLIERS; keeps its table of powers between calls."""

    def __init__(self, which: int = 0):
        self.base = MULTIPLIERS[which]
        self.inverse = pow(self.base, -1, 1 << 64)
        self.up = self.down = np.ones(0, np.uint64)

    def __call__(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        out = np.empty(len(starts), np.uint64)
        k = 0
        while k < len(starts):
            # a segment: whole words within SEGMENT bytes, or one longer word
            lo = int(starts[k])
            j = max(k + 1, int(np.searchsorted(ends, lo + SEGMENT, "right")))
            hi = int(ends[j - 1])
            if hi - lo + 1 > len(self.up):
                self.up, self.down = _powers(self.base, hi - lo + 1), _powers(self.inverse, hi - lo + 1)
            sums = np.zeros(hi - lo + 1, np.uint64)
            np.cumsum((buf[lo:hi].astype(np.uint64) + np.uint64(1)) * self.up[: hi - lo], out=sums[1:])
            s, e = starts[k:j] - lo, ends[k:j] - lo
            out[k:j] = mix((sums[e] - sums[s]) * self.down[s] + (e - s).astype(np.uint64))
            k = j
        return out


def window_hashes(words: np.ndarray, width: int, which: int = 0) -> np.ndarray:
    """Hash of every run of ``width`` consecutive words; entry i starts at word i."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    factor = np.uint64(MULTIPLIERS[1 - which] | 1)
    acc = words[:n].copy()
    for j in range(1, width):
        acc *= factor
        acc += words[j : j + n]
    return mix(acc)
