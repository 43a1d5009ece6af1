"""64-bit hashes of words and word shingles, computed on whole byte arrays with numpy.

A word's hash is a polynomial over its UTF-8 bytes modulo 2**64, taken from one running sum
over the text and mixed; a shingle's hash mixes a weighted sum of its words' hashes.
"""

from __future__ import annotations

import numpy as np

_ODD = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def mixed(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finalizer."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def numbers(n: int, seed: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit numbers."""
    start = np.uint64((seed * _ODD) & _MASK)
    return mixed(start + np.arange(1, n + 1, dtype=np.uint64) * np.uint64(_ODD))


class Hasher:
    """Holds the tables, which grow to the longest text met."""

    def __init__(self, lower: bool = True):
        values = np.arange(256)
        if lower:
            values = np.where((values >= 65) & (values <= 90), values + 32, values)
        self.byte = numbers(256, 1)[values]
        self.space = np.zeros(256, bool)
        self.space[[32, 9, 10, 11, 12, 13]] = True
        self.base = 0x5851F42D4C957F2D
        self.inverse = pow(self.base, -1, 1 << 64)
        self._grow(1 << 12)

    def _grow(self, n: int) -> None:
        with np.errstate(over="ignore"):
            self.up = np.cumprod(np.full(n, self.base, np.uint64))
            self.down = np.cumprod(np.full(n, self.inverse, np.uint64))

    def words(self, text: str | None) -> np.ndarray:
        """A hash for each word ``[^\\x20\\x09-\\x0D]+`` of the text, in order."""
        b = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
        if len(b) > len(self.up):
            self._grow(1 << int(len(b)).bit_length())
        inside = np.zeros(len(b) + 2, np.int8)
        inside[1:-1] = ~self.space[b]
        edge = np.diff(inside)
        start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        if not len(start):
            return np.zeros(0, np.uint64)
        run = np.zeros(len(b) + 1, np.uint64)
        np.cumsum(self.byte[b] * self.up[: len(b)], out=run[1:])
        return mixed((run[end] - run[start]) * self.down[start])

    def shingles(self, text: str | None, size: int) -> np.ndarray:
        """Sorted distinct shingles of ``size`` words; the whole sequence where it is shorter."""
        w = self.words(text)
        if not len(w):
            return w
        n, weights = max(len(w) - size + 1, 1), numbers(size, 2) | np.uint64(1)
        short = len(w) if len(w) < size else size
        total = np.full(n, short * 0x632BE59BD9B4E019 & _MASK, np.uint64)
        for k in range(short):
            total += w[k : k + n] * weights[k]
        return np.unique(mixed(total))
