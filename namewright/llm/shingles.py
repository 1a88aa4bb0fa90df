"""Word shingles of whole texts as 64-bit hashes, computed in numpy over a batch's bytes.

Words are runs of bytes other than space and U+0009 to U+000D, with A-Z in lower case.  A text's set
holds the distinct shingles of ``width`` words; a text of fewer words gives one shingle, and one
without words an empty set.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from namewright.llm.batches import joined_bytes

BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


VALUES = mix(np.arange(1, 257, dtype=np.uint64) * BASE)
for upper in range(65, 91):
    VALUES[upper] = VALUES[upper + 32]
BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True

_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i < n."""
    if len(_powers.get("up", ())) < n:
        for name, base in (("up", BASE), ("down", INVERSE)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"][:n], _powers["down"][:n]


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each word of a string column, and where each row's words begin (one more than rows)."""
    raw, bounds = joined_bytes(column)
    if len(raw) == 0:
        return np.zeros(0, np.uint64), np.zeros(len(bounds), np.int64)
    word = ~BLANK[raw]
    first = word.copy()
    first[1:] &= ~word[:-1]
    inner = bounds[1:-1]
    inner = inner[inner < len(raw)]
    first[inner] = word[inner]
    starts = np.flatnonzero(first)
    last = word.copy()
    last[:-1] &= ~word[1:]
    last[inner - 1] = np.where(inner > 0, word[inner - 1], last[inner - 1])
    ends = np.flatnonzero(last) + 1
    up, down = powers(len(raw))
    sums = np.cumsum(VALUES[raw] * up)
    hashes = (sums[ends - 1] - np.where(starts > 0, sums[starts - 1], np.uint64(0))) * down[starts]
    return mix(hashes + (ends - starts).astype(np.uint64)), np.searchsorted(starts, bounds)


def shingle_sets(column: pa.Array, width: int = 5) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each row."""
    words, at = word_hashes(column)
    odd = [np.uint64(int(v) | 1) for v in mix(np.arange(1000, 1000 + width, dtype=np.uint64))]
    full = np.zeros(0, np.uint64)
    if len(words) >= width:
        n = len(words) - width + 1
        full = words[:n] * odd[0]
        for k in range(1, width):
            full += words[k : n + k] * odd[k]
        full = mix(full)
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if b - a >= width:
            yield np.unique(full[a : b - width + 1])
        elif b > a:
            yield mix(np.sum(words[a:b] * np.array(odd[: b - a]), keepdims=True) + np.uint64(b - a))
        else:
            yield np.zeros(0, np.uint64)


def fingerprint(shingles: np.ndarray) -> bytes:
    """Sixteen bytes that stand for a set."""
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()
