"""Words, word hashes and hashes of word sequences, vectorised over many texts at once.

A word is a run of bytes other than U+0020 and U+0009 to U+000D.  These separators are single bytes in
UTF-8 that occur in no other character, so bytes may be scanned.  A word's hash is a polynomial over its
bytes modulo 2**64, taken from one running sum; a sequence's hash is the same over word hashes.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np

SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_BYTE_VALUES = np.random.Generator(np.random.PCG64(0x5EED)).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_LOWER = np.arange(256)
_LOWER[ord("A"):ord("Z") + 1] += 32
_FOLDED_VALUES = _BYTE_VALUES[_LOWER]
_BYTE_BASE, _WORD_BASE = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95  # odd, so invertible modulo 2**64


@lru_cache(maxsize=4)
def _powers(base: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    n = 1 << bits

    def rising(b: int) -> np.ndarray:
        factors = np.full(n, b, np.uint64)
        factors[0] = 1
        return np.cumprod(factors, dtype=np.uint64)

    return rising(base), rising(pow(base, -1, 1 << 64))


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of ``base`` and of its inverse modulo 2**64, for at least ``n`` exponents."""
    return _powers(base, max(20, int(n).bit_length()))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit (SplitMix64's finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass(frozen=True)
class Words:
    """Words of several texts: byte ranges in ``buffer``; text i has words ``offsets[i]`` to ``offsets[i + 1]``."""

    buffer: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    offsets: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.offsets)

    def hashes(self, fold: bool = False) -> np.ndarray:
        """One 64-bit hash a word; ``fold`` takes A-Z as a-z."""
        up, down = powers(_BYTE_BASE, len(self.buffer) + 1)
        values = (_FOLDED_VALUES if fold else _BYTE_VALUES)[self.buffer]
        running = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * up[:len(values)], out=running[1:])
        return mixed((running[self.ends] - running[self.starts]) * down[self.starts]
                     + (self.ends - self.starts).astype(np.uint64))


def split_words(texts: list[bytes], separator: np.ndarray = SEPARATOR) -> Words:
    buffer = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    outside = separator[buffer]
    edges = np.flatnonzero(np.diff(outside, prepend=True))
    starts, ends = edges[0::2], edges[1::2]
    firsts = np.cumsum([0, *(len(t) + 1 for t in texts)])
    return Words(buffer, starts, ends, np.searchsorted(starts, firsts))


def sequence_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` consecutive words, as if all belonged to one text."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    up, down = powers(_WORD_BASE, len(hashes) + 1)
    running = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * up[:len(hashes)], out=running[1:])
    count = len(hashes) - n + 1
    return mixed((running[n:] - running[:count]) * down[:count] + np.uint64(n))


def span_hashes(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of the words from each start to each end; a span has the same value as ``sequence_hashes`` gives it."""
    up, down = powers(_WORD_BASE, len(hashes) + 1)
    running = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * up[:len(hashes)], out=running[1:])
    return mixed((running[ends] - running[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def range_hash(hashes: np.ndarray) -> int:
    """Hash of one whole sequence; the same value as ``sequence_hashes`` gives it."""
    return int(sequence_hashes(hashes, len(hashes))[0]) if len(hashes) else 0
