"""Runs of periodic repetition among the words of a text.

A run is a stretch of words with smallest period q, at least ``LEAST_PERIODS``
periods and ``LEAST_WORDS`` words long, that no neighbouring word extends.

Runs are found by the branching-tandem test on an enhanced suffix array:

1. The texts of a block are numbered into one string of symbols; a symbol
   belongs to one text, so no repeat reaches across texts.
2. Prefix doubling gives the suffix array, its inverse, and the rank of every
   piece of 2**k words; two pieces are equal exactly if their ranks are.
   From the ranks follow the common prefixes of neighbours in the array.
3. One sweep with a stack over the common prefixes gives each interval of a
   common prefix as bounds, depth and children; no tree is made.
4. Of every interval all children but the largest are listed.  For a listed
   suffix i and depth d, suffix i + d or i - d inside the interval's bounds (by the
   inverse array), with another symbol following, makes a square that ends where its
   repetition ends.
5. Each square is rotated left as far as it goes, in steps of powers of two by
   the ranks; squares that reach the same stretch are one run, of the least period.

Scale: one map over the documents without a shuffle.  A block holds
``BLOCK_WORDS`` words, or one longer text; time and memory are n log n in it.

Defined results: null and empty texts have 0 words and no run; a null key rewrites
nothing; repeated rows get equal results; an empty table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hiremart.llm.common import record_batch, utf8

LEAST_PERIODS = 4
LEAST_WORDS = 6
BLOCK_WORDS = 400_000

Run = tuple[int, int, int]  # start, length, period


def symbols_of(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of all words, distinct from text to text, and the place where each text begins."""
    codes, base, begins = [], 0, [0]
    for words in texts:
        known: dict[bytes, int] = defaultdict()
        known.default_factory = known.__len__
        codes.append(np.fromiter(map(known.__getitem__, words), np.int64, len(words)) + base)
        base += len(known)
        begins.append(begins[-1] + len(words))
    return np.concatenate(codes) if codes else np.zeros(0, np.int64), np.array(begins)


class SuffixArray:
    """Order of all suffixes, common prefixes of neighbours, and ranks of pieces of 2**k symbols.

    ``ranks[k]`` has one more place, -1, for the end; the last one is the inverse array.
    """

    def __init__(self, symbols: np.ndarray):
        n = len(symbols)
        before = np.concatenate([[0], np.cumsum(np.bincount(symbols))])
        order = np.argsort(symbols, kind="stable")
        rank = np.append(before[symbols], -1).astype(np.int32)
        self.ranks = [rank]
        step, open_at = 1, np.arange(n)
        while True:
            # places in the order whose group holds more than one suffix
            first = rank[order[open_at]]
            alone = np.diff(np.concatenate([[-1], first])) != 0
            alone &= np.diff(np.concatenate([first, [-1]])) != 0
            open_at = open_at[~alone]
            if not len(open_at):
                break
            at = order[open_at]
            key = rank[at].astype(np.int64) * (n + 2) + rank[np.minimum(at + step, n)] + 1
            turn = np.argsort(key, kind="stable")
            key = key[turn]
            order[open_at] = at = at[turn]
            new = np.diff(key, prepend=-1) != 0
            rank = rank.copy()
            rank[at] = open_at[np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))]
            self.ranks.append(rank)
            step *= 2
        self.order, self.inverse, self.symbols = order, rank, symbols
        self.common = self._common()

    def _common(self) -> np.ndarray:
        """Length of the common prefix of each suffix with the one before it in the order."""
        common = np.zeros(len(self.order), np.int64)
        if not len(common):
            return common
        alike = np.flatnonzero(self.ranks[0][self.order[1:]] == self.ranks[0][self.order[:-1]]) + 1
        a, b = self.order[alike].astype(np.int64), self.order[alike - 1].astype(np.int64)
        length = np.zeros(len(alike), np.int64)
        for k in range(len(self.ranks) - 1, -1, -1):
            same = self.ranks[k][a] == self.ranks[k][b]
            length += same << k
            a, b = a + (same << k), b + (same << k)
        common[alike] = length
        return common

    def rotated_left(self, start: np.ndarray, period: np.ndarray) -> np.ndarray:
        """Least start to which each square of ``period`` can be moved while its words repeat."""
        start = start.copy()
        for k in range(len(self.ranks) - 1, -1, -1):
            there = start - (1 << k)
            same = there >= 0
            same[same] = self.ranks[k][there[same]] == self.ranks[k][there[same] + period[same]]
            start[same] = there[same]
        return start


def intervals(common: np.ndarray) -> tuple[np.ndarray, ...]:
    """Children of all intervals of a common prefix of one symbol or more.

    Returns first and last place of each child, and of its interval the depth, first and last place, and number."""
    positive = common > 0
    after = np.concatenate([[False], positive[:-1]])
    ahead = np.concatenate([positive[1:], [False]])
    places = np.append(np.flatnonzero(positive | after | ahead), len(common))
    values = common[places[:-1]].tolist() + [0]
    m = len(values)
    smaller_before, smaller_after, end_of_child, first_split = [0] * m, [0] * m, [0] * m, list(range(m))
    stack: list[int] = []
    for i, v in enumerate(values):
        while stack and values[stack[-1]] > v:
            j = stack.pop()
            smaller_after[j] = i
            end_of_child[j] = end_of_child[j] or i
        if not v:
            stack = [i]
            continue
        top = stack[-1]
        if values[top] == v:
            end_of_child[top], smaller_before[i], first_split[i] = i, smaller_before[top], first_split[top]
        else:
            smaller_before[i] = top
        stack.append(i)
    split = np.flatnonzero(np.array(values, np.int64) > 0)
    low, high = places[np.array(smaller_before)[split]], places[np.array(smaller_after)[split]] - 1
    depth, number = common[places[split]], np.array(first_split)[split]
    begin, end = places[split], places[np.array(end_of_child)[split]] - 1
    lead = number == split  # an interval's first child lies before its first split
    return tuple(np.concatenate([x, y[lead]]) for x, y in ((begin, low), (end, begin - 1), (depth, depth), (low, low), (high, high), (number, number)))


def branching_squares(s: SuffixArray) -> tuple[np.ndarray, np.ndarray]:
    """Start and period of every square whose repetition ends where the square ends."""
    begin, end, depth, low, high, number = intervals(s.common)
    size = end - begin + 1
    turn = np.lexsort((-size, number))
    largest = np.diff(number[turn], prepend=-1) != 0
    small = turn[~largest]
    begin, depth, low, high, size = begin[small], depth[small], low[small], high[small], size[small]
    of = np.repeat(np.arange(len(small)), size)
    place = np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size) + begin[of]
    i, d, low, high = s.order[place], depth[of], low[of], high[of]
    n, starts, periods = len(s.symbols), [], []
    symbols = np.append(s.symbols, -1)
    for start in (i, i - d):
        inside = (start >= 0) & (start + d < n)
        other = np.where(inside, start + (d if start is i else 0), 0)  # the suffix that has to lie in the interval too
        place = s.inverse[other]
        inside &= (place >= low) & (place <= high)
        inside[inside] = symbols[start[inside] + d[inside]] != symbols[np.minimum(start[inside] + 2 * d[inside], n)]
        starts.append(start[inside])
        periods.append(d[inside])
    return np.concatenate(starts), np.concatenate(periods)


def runs(texts: list[list[bytes]], *, least_periods: int = LEAST_PERIODS, least_words: int = LEAST_WORDS) -> list[list[Run]]:
    """Runs of each text, by start and period."""
    found: list[list[Run]] = [[] for _ in texts]
    symbols, begins = symbols_of(texts)
    if not len(symbols):
        return found
    s = SuffixArray(symbols)
    square, period = branching_squares(s)
    start, end = s.rotated_left(square, period), square + 2 * period
    turn = np.lexsort((period, end, start))
    start, end, period = start[turn], end[turn], period[turn]
    new = (np.diff(start, prepend=-1) != 0) | (np.diff(end, prepend=-1) != 0)  # of one stretch the least period
    new &= end - start >= np.maximum(least_words, least_periods * period)
    text = np.searchsorted(begins, start, "right") - 1
    for k, a, b, q in zip(text[new].tolist(), start[new].tolist(), end[new].tolist(), period[new].tolist()):
        found[k].append((a - int(begins[k]), b - a, q))
    for x in found:
        x.sort(key=lambda r: (r[0], r[2]))
    return found


def collapsed(words: list[bytes], found: list[Run]) -> list[bytes]:
    """The words without those that a run repeats after its first period."""
    if not found:
        return words
    keep = np.ones(len(words), bool)
    for start, length, period in found:
        keep[start + period : start + length] = False
    return [words[k] for k in np.flatnonzero(keep)]


def strongest(found: list[Run]) -> Run | None:
    """The run of most periods; ties: least start, then period."""
    return min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if found else None


def repeated_tail(key: int | None, words: list[bytes]) -> list[bytes]:
    """The words with the tail of every tenth key (by crc32) made periodic, as a test of the detection."""
    h = zlib.crc32(str(key).encode()) if key is not None else 1
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * ((n - a) // p + 1))[: n - a]


#: ``runs_of``'s columns after the key.
RESULT = "n_words long, runs array<struct<start:long,length:long,period:long>>, kept binary"


def _blocks(batches: Iterator[pa.RecordBatch], rewrite: Callable | None):
    """Keys, words and runs of some texts at a time."""
    for batch in batches:
        keys, texts = batch.column(0).to_pylist(), []
        done = held = 0
        for k, text in enumerate(utf8(batch.column(1))):
            words = text.split() if text else []  # of bytes: at \x20 and \x09-\x0D
            texts.append(rewrite(keys[k], words) if rewrite else words)
            held += len(words)
            if held >= BLOCK_WORDS:
                yield batch.column(0).slice(done, len(texts)), texts, runs(texts)
                done, held, texts = k + 1, 0, []
        if texts:
            yield batch.column(0).slice(done, len(texts)), texts, runs(texts)


def runs_of(docs: DataFrame, *, key: str = "doc_id", text: str = "text", rewrite: Callable | None = None) -> DataFrame:
    """Key, number of words, runs, and the text (UTF-8) without what runs repeat, of every document."""
    def run(batches):
        for keys, texts, found in _blocks(batches, rewrite):
            yield record_batch({
                key: (keys, None), "n_words": ([len(w) for w in texts], pa.int64()),
                "runs": ([[dict(zip(("start", "length", "period"), r)) for r in x] for x in found], pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))),
                "kept": ([b" ".join(collapsed(w, x)) for w, x in zip(texts, found)], pa.binary()),
            })

    source = docs.select(F.col(key), F.col(text).cast("string").alias("text"))
    return source.mapInArrow(run, f"`{key}` {source.schema[0].dataType.simpleString()}, {RESULT}")


def runs_digest(docs: DataFrame, *, rewrite: Callable | None = repeated_tail) -> DataFrame:
    """The contract's columns, one row per document."""
    def run(batches):
        for keys, texts, found in _blocks(batches, rewrite):
            best = [strongest(x) or (None, None, None) for x in found]
            yield record_batch({
                "doc_id": (keys, None), "n_runs": ([len(x) for x in found], pa.int64()),
                "start": ([b[0] for b in best], pa.int64()), "length": ([b[1] for b in best], pa.int64()), "period": ([b[2] for b in best], pa.int64()),
                "exponent_milli": ([1000 * b[1] // b[2] if b[2] else None for b in best], pa.int64()),
                "runs_sha256": ([hashlib.sha256("".join(f"{a},{n},{q}\n" for a, n, q in x).encode()).hexdigest() for x in found], pa.string()),
                "collapsed_sha256": ([hashlib.sha256(b" ".join(collapsed(w, x))).hexdigest() for w, x in zip(texts, found)], pa.string()),
                "n_words": ([len(w) for w in texts], pa.int64()),
            })

    source = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string, n_words long")
