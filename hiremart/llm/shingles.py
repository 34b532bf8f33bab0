"""Word shingles of texts as sorted arrays of 64-bit fingerprints, in numpy.

A word is hashed from its bytes with a polynomial over random byte values, a
shingle from the hashes of its words in order, and both are mixed to the last
bit.  Two different shingles share a fingerprint with probability 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

SHINGLE = 5
SEGMENT_BYTES = 1 << 20

#: A-Z to lower case; the six white-space bytes to a blank.
FOLD = bytes(0x20 if c == 0x20 or 0x09 <= c <= 0x0D else c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))
STEP = 0x9E3779B97F4A7C15
_VALUES = np.random.default_rng(1).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2**64."""
    if len(_powers[0]) < n:
        for k, base in enumerate((STEP, pow(STEP, -1, 1 << 64))):
            row = np.full(n, base, np.uint64)
            row[0] = 1
            _powers[k] = np.cumprod(row, dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


def _segment_words(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of each word of folded text."""
    codes = np.frombuffer(data, np.uint8)
    inside = np.concatenate(([False], codes != 0x20, [False]))
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edge[::2], edge[1::2]
    up, down = _powers_to(len(codes) + 1)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_VALUES[codes] * up[: len(codes)], dtype=np.uint64)))
    return mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64)), start


def word_hashes(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts, in order, and the number of words of each text."""
    hashes: list[np.ndarray] = []
    counts = np.zeros(len(texts), np.int64)
    k = 0
    while k < len(texts):
        joined, size = [], 0
        first = k
        while k < len(texts) and (not joined or size + len(texts[k] or b"") < SEGMENT_BYTES):
            joined.append(texts[k] or b"")
            size += len(joined[-1]) + 1
            k += 1
        if len(joined) == 1 and size > SEGMENT_BYTES:  # one long text, cut between words
            data = joined[0].translate(FOLD)
            at = 0
            while at < len(data):
                cut = data.find(b" ", at + SEGMENT_BYTES)
                cut = len(data) if cut < 0 else cut
                found, _ = _segment_words(data[at:cut])
                hashes.append(found)
                counts[first] += len(found)
                at = cut
            continue
        found, start = _segment_words(b" ".join(joined).translate(FOLD))
        bounds = np.cumsum([len(t) + 1 for t in joined])
        counts[first:k] = np.diff(np.concatenate(([0], np.searchsorted(start, bounds))))
        hashes.append(found)
    return (np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)), counts


def _sequence(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every n words in a row."""
    size = len(words) - n + 1
    out = np.full(size, n, np.uint64)
    for k in range(n):
        out = mix(out * np.uint64(STEP) + words[k : k + size])
    return out


def shingle_sets(texts: list[bytes | None], n: int = SHINGLE) -> Iterator[np.ndarray]:
    """Sorted distinct shingle fingerprints of each text: all n words in a row, or the
    whole sequence of a text with fewer words; empty without words."""
    words, counts = word_hashes(texts)
    every = _sequence(words, n) if len(words) >= n else np.zeros(0, np.uint64)
    at = 0
    for count in counts.tolist():
        if count >= n:
            yield np.unique(every[at : at + count - n + 1])
        elif count:
            yield _sequence(words[at : at + count], count)
        else:
            yield np.zeros(0, np.uint64)
        at += count


def min_hashes(tokens: np.ndarray, n: int) -> list[int]:
    """Least values of the tokens under n hash functions, as signed 64-bit integers; 0 for an empty set."""
    if not len(tokens):
        return [0] * n
    return [int(mix(tokens + np.uint64(STEP * (k + 1) & 0xFFFFFFFFFFFFFFFF)).min().astype(np.int64)) for k in range(n)]
