"""Minimal perfect hash over 128-bit keys, built and probed with numpy.

Level by level, every remaining key is hashed into a bit array; keys alone in
their slot set its bit, the others go on to the next, smaller level. A key's
index is the rank of its bit, so n keys use exactly 0..n-1.
"""

from __future__ import annotations

import numpy as np

MIX_A, MIX_B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
SLOTS_PER_KEY = 2


def slots(h1: np.ndarray, h2: np.ndarray, level: int, size: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = h1 + h2 * np.uint64(2 * level + 1)
        x = (x ^ (x >> np.uint64(32))) * MIX_A
        x = (x ^ (x >> np.uint64(29))) * MIX_B
        x ^= x >> np.uint64(32)
    return (x % np.uint64(size)).astype(np.int64)


def build(h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(slots of each level, packed bits of all levels); the keys must be distinct."""
    sizes, bits = [], []
    while len(h1):
        size = max(8, SLOTS_PER_KEY * len(h1) + 7 >> 3 << 3)
        at = slots(h1, h2, len(sizes), size)
        alone = np.bincount(at, minlength=size) == 1
        sizes.append(size)
        bits.append(np.packbits(alone))
        left = ~alone[at]
        h1, h2 = h1[left], h2[left]
    return np.array(sizes, np.int64), np.concatenate(bits) if bits else np.zeros(0, np.uint8)


def ranks(packed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bits, number of ones before each bit)."""
    bits = np.unpackbits(packed).astype(bool)
    return bits, np.cumsum(bits, dtype=np.int32) - bits


def index(h1: np.ndarray, h2: np.ndarray, sizes: np.ndarray, bits: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Index of each key, -1 for one that no level holds."""
    out = np.full(len(h1), -1, np.int64)
    todo, start = np.arange(len(h1)), 0
    for level, size in enumerate(sizes):
        at = slots(h1[todo], h2[todo], level, int(size)) + start
        hit = bits[at]
        out[todo[hit]] = before[at[hit]]
        todo, start = todo[~hit], start + int(size)
    return out
