"""Words and word shingles of many texts at once, as numpy arrays.

A word is a run of ``[^\\x20\\x09-\\x0D]`` with A-Z lower-cased. The functions work on the UTF-8 bytes of
a slice of whole texts (see ``common.byte_slices``), so a batch costs a few array passes and no
Python step per word.
"""

from __future__ import annotations

import numpy as np

SEED = 20240611
_rng = np.random.default_rng(SEED)
BYTE_CODE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BYTE_CODE[65:91] = BYTE_CODE[97:123]  # A-Z as a-z
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 2**64))
SHINGLE_CODE = _rng.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_powers = {"base": np.ones(1, np.uint64), "inverse": np.ones(1, np.uint64)}


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits in which every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _grown(name: str, step: np.uint64, n: int) -> np.ndarray:
    have = _powers[name]
    while len(have) < n:
        have = np.concatenate([have, have * (have[-1:] * step)])
    _powers[name] = have
    return have[:n]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    return _grown("base", BASE, n), _grown("inverse", BASE_INVERSE, n)


def prefix_hash(data: np.ndarray, code: np.ndarray = BYTE_CODE) -> np.ndarray:
    """H with H[j]-H[i] = sum of code(byte k) * BASE**k over i <= k < j, modulo 2**64."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(code[data] * powers(len(data))[0], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return mixed((prefix[ends] - prefix[starts]) * powers(len(prefix))[1][starts])


def spans(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the index of its text. Words never cross texts."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    solid = ~IS_SPACE[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    last = solid.copy()
    last[:-1] &= ~solid[1:]
    edges = offs[1:-1]
    inner = edges[(edges > 0) & (edges < len(data))]
    first[inner] |= solid[inner]
    last[inner - 1] |= solid[inner - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offs, starts, "right") - 1


class Words:
    """Word hashes of a slice of texts; ``at[i]:at[i+1]`` are the words of text i."""

    def __init__(self, data: np.ndarray, offs: np.ndarray):
        self.starts, self.ends, self.doc = spans(data, offs)
        self.hash = span_hash(prefix_hash(data), self.starts, self.ends) if len(self.doc) else np.zeros(0, np.uint64)
        self.at = np.searchsorted(self.doc, np.arange(len(offs)))

    def _sums(self, size: int) -> np.ndarray:
        n = max(0, len(self.hash) - size + 1)
        out = np.zeros(n, np.uint64)
        for k in range(size):
            out += self.hash[k : k + n] * SHINGLE_CODE[k]
        return out

    def windows(self, size: int) -> np.ndarray:
        """Hash of the ``size`` words from each word on (across texts too: callers cut by ``at``)."""
        return mixed(self._sums(size))

    def sequences(self, size: int) -> np.ndarray:
        """As windows, for whole sequences that are shorter than a shingle."""
        return mixed(self._sums(size) + np.array([size], np.uint64) * SHINGLE_CODE[-1:])


def short_shingle(words: np.ndarray) -> np.ndarray:
    """The one shingle of a text with fewer words than a shingle: its whole sequence."""
    length = np.array([len(words)], np.uint64) * SHINGLE_CODE[-1:]
    return mixed(np.sum(words * SHINGLE_CODE[: len(words)], dtype=np.uint64, keepdims=True) + length)


def shingles(words: Words, windows: np.ndarray, i: int, size: int) -> np.ndarray:
    """Shingle hashes of text i in order, repeats included. ``windows`` = words.windows(size)."""
    lo, hi = words.at[i], words.at[i + 1]
    if hi - lo >= size:
        return windows[lo : hi - size + 1]
    return short_shingle(words.hash[lo:hi]) if hi > lo else np.zeros(0, np.uint64)
