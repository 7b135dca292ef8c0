"""Whole batches of texts as one array of code points.

Per-character Python is far too slow for a corpus, so the operators of this
package scan texts with NumPy: the texts of a block are joined, decoded to
UTF-32 and classified by one table look-up; words, lines and n-grams are then
ranges and prefix sums of that array.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np

LETTER, DIGIT, SPACE, UPPER, PUNCT, BREAK, MARKED = 1, 2, 4, 8, 16, 32, 64
#: The Unicode property White_Space, and the line breaks among it.
WHITE_SPACE = (*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
LINE_BREAKS = (10, 11, 12, 13, 0x85, 0x2028, 0x2029)
#: The same as a class for Java's and RE2's regular expressions.
WS_CLASS = r"\t-\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


@lru_cache(1)
def classes() -> np.ndarray:
    """Class bits of every code point."""
    t = np.zeros(sys.maxunicode + 1, np.uint8)
    for lo, hi in ((0, 0x33480), (0xE0000, 0xE0200)):  # no letters are assigned elsewhere
        for c in range(lo, hi):
            k = unicodedata.category(chr(c))
            if k[0] == "L":
                t[c] = LETTER | (UPPER if k in ("Lu", "Lt") else 0)
            elif k[0] == "N":
                t[c] = DIGIT
            elif k[0] == "P":
                t[c] = PUNCT
            elif k[0] == "M":
                t[c] = MARKED
    t[list(WHITE_SPACE)] |= SPACE
    t[list(LINE_BREAKS)] |= BREAK
    return t


def mix(x: np.ndarray) -> np.ndarray:
    """Finalises 64-bit hashes; wraps around on purpose."""
    x = x ^ (x >> np.uint64(30))  # the only new array
    x *= _MIX1
    x ^= x >> np.uint64(27)
    x *= _MIX2
    x ^= x >> np.uint64(31)
    return x


_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, 1 << 20)
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        for k, b in enumerate((_BASE, inverse)):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            _powers[k] = np.cumprod(p, dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


def range_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of codes[start:end] for each range, from prefix sums of a polynomial."""
    if not len(codes):
        return np.zeros(len(starts), np.uint64)
    up, down = _power_tables(len(codes) + 1)
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum((codes.astype(np.uint64) + np.uint64(0x51ED27)) * up[:-1], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def window_hashes(codes: np.ndarray, q: int) -> np.ndarray:
    """range_hashes of all ranges of q codes, by slices."""
    up, down = _power_tables(len(codes) + 1)
    sums = np.zeros(len(codes) + 1, np.uint64)
    x = codes.astype(np.uint64)
    x += np.uint64(0x51ED27)
    x *= up[:-1]
    np.cumsum(x, out=sums[1:])
    h = sums[q:] - sums[:-q]
    h *= down[: len(h)]
    h += np.uint64(q)
    return mix(h)


class Block:
    """Some texts, joined: codes, cls (class bits), offsets (len(texts) + 1)."""

    def __init__(self, texts: list[str]):
        self.n = len(texts)
        self.codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        self.offsets = np.zeros(self.n + 1, np.int64)
        np.cumsum(np.fromiter(map(len, texts), np.int64, self.n), out=self.offsets[1:])
        self.cls = classes()[self.codes]

    def firsts(self) -> np.ndarray:
        """Places where a text begins, within the array."""
        f = self.offsets[:-1]
        return f[f < len(self.codes)]

    def runs(self, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the maximal runs of mask, none across two texts."""
        if not len(mask):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        first = np.zeros(len(mask), bool)
        first[self.firsts()] = True
        before = np.empty_like(mask)
        before[0] = False
        before[1:] = mask[:-1]
        before &= ~first
        after = np.empty_like(mask)
        after[-1] = False
        after[:-1] = mask[1:] & ~first[1:]
        return np.flatnonzero(mask & ~before), np.flatnonzero(mask & ~after) + 1

    def words(self) -> tuple[np.ndarray, np.ndarray]:
        """Maximal runs of letters and digits."""
        return self.runs((self.cls & (LETTER | DIGIT)) != 0)

    def owner(self, places: np.ndarray) -> np.ndarray:
        """The text that holds each place."""
        return np.searchsorted(self.offsets, places, side="right") - 1


def blocks(texts: list[str], most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about `most` characters together; a longer text stands alone."""
    at, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > most:
            yield at, i
            at, size = i, 0
        size += len(t)
    if at < len(texts):
        yield at, len(texts)


def spread(counts: np.ndarray) -> np.ndarray:
    """0..c-1 for each count c, concatenated."""
    total = int(counts.sum())
    ends = np.cumsum(counts)
    return np.arange(total) - np.repeat(ends - counts, counts)
