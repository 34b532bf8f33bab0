"""A minimal perfect hash over 64-bit keys, built and queried in numpy.

Each level hashes the keys that are left into twice as many bits; keys alone
on their bit are placed there, the others go on to the next level.  The slot
of a key is the number of set bits before its own, so n keys get the slots
0..n-1.  A key that was never inserted gets some slot or none; the stored
fingerprint tells it apart.
"""

from __future__ import annotations

import io

import numpy as np

BITS_PER_KEY = 2
MAX_LEVELS = 48


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit mix of the keys, another one for each seed."""
    x = keys.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & 0xFFFFFFFFFFFFFFFF)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mixed(keys, 1_000_003) >> np.uint64(32)).astype(np.uint32)


class MinimalPerfectHash:
    """``slots(keys)``: 0..n-1 for the inserted keys, -1 where no level answers."""

    def __init__(self, bits: np.ndarray, sizes: np.ndarray):
        self.bits = bits  # bytes of all levels, one after the other
        self.sizes = sizes  # bits of each level, multiples of 8
        self.first = np.concatenate(([0], np.cumsum(sizes)))
        ones = np.unpackbits(bits).reshape(-1, 8).sum(1) if len(bits) else np.zeros(0, np.int64)
        self.before = np.concatenate(([0], np.cumsum(ones)))  # set bits before each byte

    @classmethod
    def of(cls, keys: np.ndarray) -> MinimalPerfectHash:
        """From distinct keys."""
        left = keys.astype(np.uint64)
        levels: list[np.ndarray] = []
        while len(left):
            if len(levels) == MAX_LEVELS:
                raise ValueError("keys are not distinct")
            size = -(-max(8, len(left) * BITS_PER_KEY) // 8) * 8
            at = (mixed(left, len(levels)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(np.packbits(alone))
            left = left[~alone[at]]
        bits = np.concatenate(levels) if levels else np.zeros(0, np.uint8)
        return cls(bits, np.array([len(x) * 8 for x in levels], np.int64))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        keys = keys.astype(np.uint64)
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, size in enumerate(self.sizes):
            if not len(left):
                break
            at = (mixed(keys[left], level) % np.uint64(size)).astype(np.int64) + self.first[level]
            byte, shift = at >> 3, at & 7
            held = self.bits[byte]
            hit = ((held >> (7 - shift)) & 1).astype(bool)
            earlier = held & (0xFF00 >> shift & 0xFF).astype(np.uint8)
            count = np.unpackbits(earlier[:, None], axis=1).sum(1)
            out[left[hit]] = (self.before[byte] + count)[hit]
            left = left[~hit]
        return out

    def save(self) -> dict[str, np.ndarray]:
        return {"bits": self.bits, "sizes": self.sizes}


def packed(arrays: dict[str, np.ndarray]) -> bytes:
    """Named arrays as one numpy archive."""
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def unpacked(data: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(data), allow_pickle=False) as found:
        return {k: found[k] for k in found.files}
