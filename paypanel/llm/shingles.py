"""Hashed words and word shingles of whole texts, computed on byte arrays.

Words are maximal runs of bytes other than blank and 0x09 to 0x0D, A-Z lower-cased. A word's hash is a
polynomial over a table of random 64-bit values, finished by a mixer; a shingle's hash combines its words'.
"""

from __future__ import annotations

import numpy as np

SLICE = 1 << 21  # bytes hashed together
_RANDOM = np.random.Generator(np.random.PCG64(20240613))
_BYTE = _RANDOM.integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_PLACE = _RANDOM.integers(1, 1 << 63, 64, np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finisher."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hash_slice(data: bytes) -> np.ndarray:
    """Hashes of the words of a piece that starts and ends at word edges."""
    raw = np.frombuffer(data, np.uint8)
    inside = ~_SPACE[raw]
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not starts.size:
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    powers = np.multiply.accumulate(np.full(int(lengths.max()), _STEP, np.uint64))
    sums = np.add.reduceat(_BYTE[raw[inside]] * powers[place], first)
    return mix(sums + lengths.astype(np.uint64))


def word_hashes(text: str) -> np.ndarray:
    """One hash per word, in order."""
    data = text.encode("utf-8", "surrogatepass").lower()
    if len(data) <= SLICE:
        return _hash_slice(data)
    parts, at = [], 0
    raw = np.frombuffer(data, np.uint8)
    while at < len(data):
        end = min(at + SLICE, len(data))
        while end < len(data) and not _SPACE[raw[end]]:
            gap = np.flatnonzero(_SPACE[raw[end : end + SLICE]])
            end = end + int(gap[0]) if gap.size else min(end + SLICE, len(data))
        parts.append(_hash_slice(data[at:end]))
        at = end
    return np.concatenate(parts)


def shingle_set(text: str, width: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``width`` words; of the whole sequence when there are fewer words."""
    words = word_hashes(text)
    if not words.size:
        return words
    n = min(width, words.size)
    count = words.size - n + 1
    total = np.full(count, n, np.uint64) * _STEP
    for k in range(n):
        total += words[k : k + count] * _PLACE[k]
    return np.unique(mix(total))
