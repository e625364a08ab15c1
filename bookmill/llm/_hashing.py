"""Vectorised tokenising and hashing of UTF-8 texts with numpy.

A word is a maximal run of bytes other than space, tab, line feed, vertical tab, form feed
and carriage return; A-Z count as a-z. Words are hashed to 64 bits without a Python object
per word: the bytes' values times the powers of an odd base are summed once over the whole
buffer, and a word's hash is the difference of two prefix sums, shifted back to power zero.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

U = np.uint64
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15
_VALUES = np.random.default_rng(20240501).integers(1, 2**63, 256, dtype=np.uint64)
_VALUES[65:91] = _VALUES[97:123]
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose output bits all depend on all input bits."""
    x = x ^ (x >> U(33))
    x = x * U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U(33))
    x = x * U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U(33))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n-1 of the base and of its inverse modulo 2^64."""
    if len(_powers[0]) < n:
        n = max(n, 1 << 20)
        for k, base in enumerate((_BASE, pow(_BASE, -1, 2**64))):
            p = np.full(n, base, np.uint64)
            p[0] = 1
            _powers[k] = np.multiply.accumulate(p)
    return _powers[0], _powers[1]


def forget_powers() -> None:
    """Give back the powers' memory; they are worked out again when needed."""
    _powers[:] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts in order, and the number of words of each text."""
    lens = np.fromiter(map(len, texts), np.int64, len(texts))
    buf = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    up, down = _power(len(buf) + 1)
    space = SPACE[buf]
    edges = np.flatnonzero(space[1:] != space[:-1]) + 1
    if not space[0]:
        edges = np.concatenate([np.zeros(1, edges.dtype), edges])
    starts, ends = edges[0::2], edges[1::2]
    sums = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_VALUES[buf] * up[: len(buf)], out=sums[1:])
    h = (sums[ends] - sums[starts]) * down[starts]
    h = mix(h + (ends - starts).astype(np.uint64) * U(0xD6E8FEB86659FD93))
    return h, np.diff(np.searchsorted(starts, np.cumsum(lens + 1)), prepend=0)


def shingle_hashes(words: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's runs of `size` words (all its words if fewer), and their number by text."""
    n = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    starts = np.cumsum(counts) - counts
    factors = mix(np.arange(1, size + 1, dtype=np.uint64)) | U(1)
    padded = np.concatenate([words, np.zeros(size, np.uint64)])
    sums = padded[: len(words)] * factors[0]
    for j in range(1, size):
        sums += padded[j : len(words) + j] * factors[j]
    first = np.cumsum(n) - n
    out = sums[np.repeat(starts - first, n) + np.arange(int(n.sum()))]
    short = np.flatnonzero((counts > 0) & (counts < size))
    for j in range(size) if len(short) else ():
        at = short[counts[short] <= j]
        out[first[at]] -= padded[starts[at] + j] * factors[j]
    out[first[short]] += counts[short].astype(np.uint64)
    return mix(out), n


def slices(texts: list[bytes], limit: int, most: int = 1 << 15) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of at most `most` texts and `limit` bytes together; a longer text stands alone."""
    start = total = 0
    for k, t in enumerate(texts):
        if k > start and (total + len(t) > limit or k - start >= most):
            yield start, k
            start, total = k, 0
        total += len(t) + 1
    if start < len(texts):
        yield start, len(texts)
