"""Words of many texts at once: their places and 64-bit hashes, as arrays."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
#: Bytes of text handled at once.
SLAB_BYTES = 1 << 20


@lru_cache(maxsize=4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, up to n."""
    up, down = np.full(n, _BASE, np.uint64), np.full(n, pow(_BASE, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijection of 64-bit values that spreads all bits."""
    x = x ^ np.uint64(seed * 0xD6E8FEB86659FD93 & _MASK)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def hashed_words(data: bytes, blank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of each maximal run of bytes that are not ``blank`` (a table of 256)."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    a = np.frombuffer(data, np.uint8)
    edge = np.flatnonzero(np.diff(np.r_[True, blank[a], True]))
    start, end = edge[::2], edge[1::2]
    up, down = _powers(1 << max(20, n.bit_length()))
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((a.astype(np.uint64) + np.uint64(1)) * up[:n], out=total[1:])
    return start, mix((total[end] - total[start]) * down[start])


def slab_bounds(sizes: list[int], most: int = SLAB_BYTES):
    """Bounds of runs of items of about ``most`` bytes; at least one item each."""
    start = held = 0
    for i, size in enumerate(sizes):
        if held and held + size > most:
            yield start, i
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield start, len(sizes)
