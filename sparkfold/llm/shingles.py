"""Word hashes and shingle sets of many texts at once, in numpy.

Words are runs of bytes other than 0x20 and 0x09-0x0D.  A word's 64-bit hash is a
polynomial over a random value for each byte (A-Z count as a-z when ``lower``),
taken from running sums, so the cost is a few array operations a byte.  Two of n
different words or shingles share a hash with probability about n*n / 2**65.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

SPACES = np.zeros(256, dtype=bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
_RANDOM = np.random.default_rng(20240601)
EXACT = _RANDOM.integers(1, 2**64 - 1, 256, dtype=np.uint64)
LOWER = EXACT.copy()
LOWER[65:91] = LOWER[97:123]
PLACES = _RANDOM.integers(1, 2**64 - 1, 64, dtype=np.uint64) | np.uint64(1)
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 2**64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=2)
def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def powers(base: int, n: int) -> np.ndarray:
    return _powers(base, 1 << max(20, (n - 1).bit_length()))[:n]


def word_hashes(texts: list[bytes], lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word in order, end of each text's words in that array)."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    space = SPACES[data]
    before = np.concatenate([[True], space[:-1]])
    starts, ends = np.flatnonzero(~space & before), np.flatnonzero(space & ~before)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((LOWER if lower else EXACT)[data] * powers(BASE, len(data)), dtype=np.uint64)])
    words = mix((sums[ends] - sums[starts]) * powers(INVERSE, len(data))[starts] + (ends - starts).astype(np.uint64))
    text_ends = np.cumsum([len(t) + 1 for t in texts])
    return words, np.searchsorted(starts, text_ends)


def shingle_sets(texts: list[bytes], width: int, lower: bool = True) -> list[np.ndarray]:
    """Each text's sorted distinct shingle hashes: runs of ``width`` words; of fewer words, all of them as one."""
    words, ends = word_hashes(texts, lower)
    n = max(0, len(words) - width + 1)
    runs = np.zeros(n, dtype=np.uint64)
    for j in range(width):
        runs += words[j:j + n] * PLACES[j]
    runs = mix(runs)
    out, start = [], 0
    for end in ends.tolist():
        if end - start >= width:
            out.append(np.unique(runs[start:end - width + 1]))
        elif end > start:
            whole = (words[start:end] * PLACES[:end - start]).sum(dtype=np.uint64) + np.uint64(end - start)
            out.append(mix(np.array([whole], dtype=np.uint64)))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
        start = end
    return out


def slices(texts: list[bytes], size: int = 1_000_000):
    """Index ranges whose texts hold about ``size`` bytes (one longer text stands alone)."""
    start = held = 0
    for i, t in enumerate(texts):
        if held and held + len(t) > size:
            yield start, i
            start, held = i, 0
        held += len(t)
    if start < len(texts):
        yield start, len(texts)
