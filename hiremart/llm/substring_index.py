"""Repeated fixed-length byte strings within a block, by a Burrows-Wheeler transform.

``repeat_classes`` sorts the suffixes of a block, drops the ranks of the sorting,
takes the transform, and finds where neighbouring suffixes share fewer than
``length`` bytes: starting from the empty string, every interval of suffixes with
a common prefix is extended backward by each byte that precedes it.  The right
border of a new interval of prefix length l + 1 that no shorter prefix has
marked is a place where the common prefix has l bytes, so the values come out in
ascending order, level by level, and the expansion stops at ``length``.
"""

from __future__ import annotations

import numpy as np


SEPARATOR = 1
BYTE = 2  # a byte b is the symbol b + BYTE; 0 ends the block
SYMBOL_BITS = 9
PACKED = 7


def suffix_order(text: np.ndarray) -> np.ndarray:
    """All suffixes of ``text`` in order; its last symbol is the only 0.

    Prefix doubling from packed symbols; only suffixes that still share a rank are sorted again."""
    n = len(text)
    padded = np.concatenate((text.astype(np.int64), np.zeros(PACKED, np.int64)))
    key = np.zeros(n, np.int64)
    for k in range(PACKED):
        key = key << SYMBOL_BITS | padded[k : k + n]
    order = np.argsort(key)
    first = _group_starts(key[order])
    rank = np.full(n + 1, -1, np.int64)
    rank[order] = first
    open_at = np.flatnonzero(_shared(first))
    have = PACKED
    while len(open_at):
        at = order[open_at]
        key = rank[at] * (n + 1) + rank[np.minimum(at + have, n)] + 1
        turn = np.argsort(key)
        order[open_at] = at = at[turn]
        first = open_at[_group_starts(key[turn])]
        rank[at] = first
        open_at = open_at[_shared(first)]
        have *= 2
    return order


def _group_starts(ranked: np.ndarray) -> np.ndarray:
    """For sorted values the place of the first equal one."""
    new = np.concatenate(([True], ranked[1:] != ranked[:-1]))
    return np.maximum.accumulate(np.where(new, np.arange(len(ranked)), 0))


def _shared(first: np.ndarray) -> np.ndarray:
    """Which places hold a value that their group shares with another place."""
    same = first[1:] == first[:-1]
    return np.concatenate((same, [False])) | np.concatenate(([False], same))


def short_prefix_borders(text: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """For every place in ``order``: whether it shares fewer than ``length`` bytes with the place before."""
    n = len(text)
    before = text[order - 1].astype(np.uint16)  # the transform; the end stands before the first symbol
    by_byte = np.argsort(before, kind="stable")
    back = np.empty(n, np.int64)  # place of the suffix that is one byte longer
    back[by_byte] = np.arange(n)
    border = np.zeros(n + 1, bool)
    border[0] = border[n] = True
    low, high = np.zeros(1, np.int64), np.full(1, n, np.int64)
    for _ in range(length):
        size = high - low
        inside = np.repeat(low - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        owner = np.repeat(np.arange(len(low)), size)
        place = back[inside]
        ranked = np.argsort(place)
        place, owner, byte = place[ranked], owner[ranked], before[inside[ranked]]
        cut = np.flatnonzero((place[1:] != place[:-1] + 1) | (owner[1:] != owner[:-1]) | (byte[1:] != byte[:-1])) + 1
        low, high = place[np.concatenate(([0], cut))], place[np.concatenate((cut - 1, [len(place) - 1]))] + 1
        new = ~border[high]
        low, high = low[new], high[new]
        border[high] = True
        if not len(low):
            break
    return border[:n]


def repeat_classes(text: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """A number for each start, equal for equal strings of ``length`` symbols.

    ``text`` holds symbols (bytes plus ``BYTE``, and ``SEPARATOR`` between
    pieces); ``starts`` are places from which ``length`` bytes can be read."""
    text = np.append(text, 0)
    order = suffix_order(text)
    number = np.empty(len(text), np.int64)
    number[order] = np.cumsum(short_prefix_borders(text, order, length))
    return number[starts]
