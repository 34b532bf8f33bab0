"""Byte-level BPE encoding and decoding by corpus-level merge replay.

Text is cut into pieces by the tokenizer's pattern.  The distinct pieces of a
block of documents are laid out as one chain of symbols; an inverted index
leads from each pair of neighbours to its positions.  Merges are applied in
rank order: the lowest rank present is taken from a heap, all its positions
are merged, and only the touched neighbours enter the index again.  Where a merge
can create a pair of lower or equal rank, only the leftmost place of each
piece is merged at a time, so every piece sees its merges exactly in the order
that a piece-by-piece encoder uses.

A piece longer than ``LONG_PIECE`` is replayed alone, with its places in one heap by rank and
position, so that a long run without a break costs n log n too.

Scale: documents are only mapped.  Texts are cut into words at single blanks and line ends, which no piece
of the pattern reaches across (``WORD_PATTERNS``; other patterns and white space give pieces at once).  A worker
numbers the words it meets and keeps their ids in one packed array; beyond ``KEPT_WORDS`` it drops those not
met for longest.  Merges are replayed for the new words of up to ``BLOCK_BYTES`` of text at a time, so memory is
bounded whatever the partition holds; a very long text is cut into blocks of pieces too.

Defined results: null and empty texts give no ids; the ids of a text depend on
that text alone, so repeated rows, ties and the way rows are dealt out do not
matter; other columns are passed on untouched.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hiremart.llm.common import record_batch, worker_cache

BLOCK_BYTES = 16 << 20
KEPT_WORDS = 600_000
LONG_PIECE = 1024
DECODED_AT_ONCE = 1 << 20

#: Fixed value: the pattern of byte-level tokenizers whose pieces begin with a blank or hold none.
WORD_PATTERNS = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+",)
#: White space and controls other than blank and line end, and the mark that cuts words.
OTHER_SPACE = re.compile(r"[^\S \n]|[\x01\x1c-\x1f\u200b\u180e\ufeff]")


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a base64 rank file."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class MergeReplay:
    """Encoder and decoder over one rank table."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.pattern = regex.compile(pattern)
        self.token = {rank: token for token, rank in ranks.items()}
        self.tokens = np.array([*map(self.token.get, range(max(self.token) + 1)), None], object)[:-1]
        self.by_word = pattern in WORD_PATTERNS
        self.words = Words()
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        # every way to make a token of two others: left and right rank, packed, and the rank made
        pairs = sorted(
            (ranks[token[:i]] << 32 | ranks[token[i:]], rank)
            for token, rank in ranks.items() for i in range(1, len(token)) if token[:i] in ranks and token[i:] in ranks
        )
        self.pair = np.array([k for k, _ in pairs] or [-1], np.int64)
        self.made = np.array([r for _, r in pairs] or [-1], np.int64)
        # ranks whose token is part of an earlier one: their merges can bring a lower rank into a piece
        early = self.made <= np.maximum(self.pair >> 32, self.pair & 0xFFFFFFFF)
        self.turns_back = set(np.concatenate((self.pair[early] >> 32, self.pair[early] & 0xFFFFFFFF)).tolist())

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank that each pair of symbols makes, -1 for none."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        return np.where(self.pair[at] == key, self.made[at], -1)

    def replay(self, pieces: list[bytes]) -> list[tuple[int, ...]]:
        """Ids of each piece; all merges of the block in rank order."""
        out: list[tuple[int, ...]] = [(self.ranks[p],) if p in self.ranks else self.replay_long(p) if len(p) > LONG_PIECE else () for p in pieces]
        open_ = [k for k, ids in enumerate(out) if not ids and pieces[k]]
        if not open_:
            return out
        sizes = np.array([len(pieces[k]) for k in open_])
        symbol = self.byte[np.frombuffer(b"".join([pieces[k] for k in open_]), np.uint8)]
        n = len(symbol)
        ends = np.cumsum(sizes)
        owner = np.repeat(np.arange(len(open_)), sizes)
        before, after = np.arange(-1, n - 1), np.arange(1, n + 1)
        before[ends - sizes], after[ends - 1] = -1, -1
        gone = np.zeros(n, bool)
        index: dict[int, list[np.ndarray]] = {}  # inverted index: rank a pair makes -> left positions
        heap: list[int] = []

        def enter(places: np.ndarray) -> None:
            made = self._ranks(symbol[places], symbol[after[places]])
            places, made = places[made >= 0], made[made >= 0]
            order = np.argsort(made, kind="stable")
            places, made = places[order], made[order]
            cuts = np.flatnonzero(np.diff(made)) + 1
            for group, rank in zip(np.split(places, cuts), made[np.concatenate(([0], cuts))].tolist() if len(made) else []):
                if rank not in index:
                    index[rank] = []
                    heapq.heappush(heap, rank)
                index[rank].append(group)

        enter(np.flatnonzero(after >= 0))
        while heap:
            rank = heapq.heappop(heap)
            at = np.unique(np.concatenate(index.pop(rank)))
            at = at[after[at] >= 0]
            at = at[self._ranks(symbol[at], symbol[after[at]]) == rank]  # the others have lost a neighbour
            if not len(at):
                continue
            if rank in self.turns_back:  # the leftmost place of each piece only, the rest later
                first = np.concatenate(([True], owner[at][1:] != owner[at][:-1]))
                if not first.all():
                    index[rank] = [at[~first]]
                    heapq.heappush(heap, rank)
                at = at[first]
            else:  # places that share a symbol: every second one from the left
                joined = np.concatenate(([False], after[at[:-1]] == at[1:]))
                if joined.any():
                    count = np.arange(len(at))
                    at = at[(count - np.maximum.accumulate(np.where(joined, 0, count))) % 2 == 0]
            right = after[at]
            follow = after[right]
            symbol[at] = rank
            after[at], after[right], gone[right] = follow, -1, True
            some = follow >= 0
            before[follow[some]] = at[some]
            previous = before[at]
            enter(np.unique(np.concatenate((at[some], previous[previous >= 0]))))
        ids = symbol[~gone].tolist()
        start = 0
        for k, end in zip(open_, np.cumsum(np.bincount(owner[~gone], minlength=len(open_))).tolist()):
            out[k] = tuple(ids[start:end])
            start = end
        return out

    def replay_long(self, piece: bytes) -> tuple[int, ...]:
        """Ids of one long piece: its places wait in a heap by rank, then position."""
        symbol = self.byte[np.frombuffer(piece, np.uint8)]
        made = self._ranks(symbol[:-1], symbol[1:])
        n, shift = len(symbol), len(piece).bit_length()
        heap = ((made << shift) | np.arange(n - 1))[made >= 0].tolist()
        heapq.heapify(heap)
        symbol, due = symbol.tolist(), [*made.tolist(), -1]  # due: rank that a place and its right neighbour make
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        mask, find, token = (1 << shift) - 1, self.ranks.get, self.token
        while heap:
            entry = heapq.heappop(heap)
            rank, at = entry >> shift, entry & mask
            if due[at] != rank:  # a neighbour is gone
                continue
            right = after[at]
            follow = after[right]
            symbol[at], after[at], due[right] = rank, follow, -1
            if follow >= 0:
                before[follow] = at
            for place, other in ((before[at], at), (at, follow)):
                if place < 0:
                    continue
                due[place] = find(token[symbol[place]] + token[symbol[other]], -1) if other >= 0 else -1
                if due[place] >= 0:
                    heapq.heappush(heap, due[place] << shift | place)
        ids, at = [], 0
        while at >= 0:
            ids.append(symbol[at])
            at = after[at]
        return tuple(ids)

    def _cut(self, text: str) -> list[str]:
        """Words of a text, each of whole pieces; the pieces themselves where it cannot be cut at blanks."""
        if self.by_word and not OTHER_SPACE.search(text):
            words = text.replace(" ", "\x01 ").replace("\n", "\x01\n\x01").split("\x01")
            if " " not in words and "" not in words:  # else white space stands together, or at an end
                return words
        return self.pattern.findall(text)

    def _blocks(self, text: str) -> Iterator[list[str]]:
        """Pieces of a long text, some at a time."""
        block: list[str] = []
        used = 0
        for match in self.pattern.finditer(text):
            block.append(match[0])
            used += len(match[0])
            if used >= BLOCK_BYTES:
                yield block
                block, used = [], 0
        yield block

    def encode_all(self, texts: Iterable[str | None]) -> Iterator[np.ndarray]:
        """Ids (unsigned 32-bit) of each text, in order."""
        held: list[np.ndarray] = []
        used = 0
        for text in texts:
            if text and len(text) > BLOCK_BYTES:
                yield from self._emit(held)
                held, used = [], 0
                parts = []
                for block in self._blocks(text):
                    parts.extend(self._emit([self.words.numbers(block)]))
                yield np.concatenate(parts)
                continue
            held.append(self.words.numbers(self._cut(text) if text else []))
            used += len(text or "")
            if used >= BLOCK_BYTES or len(self.words.fresh) >= KEPT_WORDS:
                yield from self._emit(held)
                held, used = [], 0
        yield from self._emit(held)

    def _emit(self, held: list[np.ndarray]) -> Iterator[np.ndarray]:
        fresh = self.words.fresh
        if fresh:
            pieces = [self.pattern.findall(w) for w in fresh] if self.by_word else [[w] for w in fresh]
            distinct = list(set().union(*pieces))
            ids = dict(zip(distinct, (np.array(x, "<u4").tobytes() for x in self.replay([p.encode() for p in distinct]))))
            self.words.learn([b"".join(map(ids.__getitem__, x)) for x in pieces])
        for numbers in held:
            yield self.words.ids(numbers)
        self.words.forget(held, KEPT_WORDS)

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of the ids, joined from the tokens."""
        return b"".join([b"".join(self.tokens[ids[at : at + DECODED_AT_ONCE]].tolist()) for at in range(0, len(ids), DECODED_AT_ONCE)])


class _Index(dict):
    """Number of each word; new ones are listed in ``fresh``."""

    def __init__(self):
        super().__init__()
        self.fresh: list[str] = []

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        self.fresh.append(word)
        return number


class Words:
    """Words met, by number, and their ids in one packed array."""

    def __init__(self):
        self.index = _Index()
        self.flat = np.zeros(1 << 16, np.uint32)
        self.bounds = np.zeros(1, np.int64)
        self.met = np.zeros(0, np.int64)  # round in which a word was last met
        self.round = 0

    @property
    def fresh(self) -> list[str]:
        return self.index.fresh

    def numbers(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.index.__getitem__, words), np.int32, len(words))

    def learn(self, ids: list[bytes]) -> None:
        """Ids of the fresh words, little-endian unsigned 32-bit."""
        new = np.frombuffer(b"".join(ids), "<u4")
        used = int(self.bounds[-1])
        if used + len(new) > len(self.flat):
            self.flat = np.concatenate((self.flat[:used], np.zeros(max(len(new), used) + len(new), np.uint32)))
        self.flat[used : used + len(new)] = new
        self.bounds = np.concatenate((self.bounds, used + np.cumsum([len(x) // 4 for x in ids], dtype=np.int64)))
        self.index.fresh = []

    def ids(self, numbers: np.ndarray) -> np.ndarray:
        start, size = self.bounds[numbers], self.bounds[numbers + 1] - self.bounds[numbers]
        end = np.cumsum(size)
        if not len(end):
            return np.zeros(0, np.uint32)
        return self.flat[np.repeat(start - (end - size), size) + np.arange(end[-1])]

    def forget(self, held: list[np.ndarray], most: int) -> None:
        """Beyond ``most`` words, keep half as many: those met last."""
        self.round += 1
        n = len(self.index)
        self.met = np.concatenate((self.met, np.zeros(n - len(self.met), np.int64)))
        for numbers in held:
            self.met[numbers] = self.round
        if n <= most:
            return
        keep = np.sort(np.argsort(-self.met, kind="stable")[: most // 2])
        kept = np.zeros(n, bool)
        kept[keep] = True
        index = _Index()
        for word, k in zip(self.index, kept.tolist()):
            if k:
                index[word] = len(index)
        self.flat = np.append(self.ids(keep), np.zeros(1 << 16, np.uint32))
        self.bounds = np.concatenate(([0], np.cumsum(self.bounds[keep + 1] - self.bounds[keep])))
        self.met, self.index = self.met[keep], index


def encoder(path: str, pattern: str) -> MergeReplay:
    """The worker's encoder for a rank file that every machine has at ``path``."""
    kept, key = worker_cache("bpe"), (path, pattern)
    if key not in kept:
        kept[key] = MergeReplay(load_ranks(path), pattern)
    return kept[key]


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, ids, n_tokens, and SHA-256 of the ids (little-endian unsigned 32-bit) and of their decoded bytes."""

    def run(batches):
        replay = encoder(ranks_path, pattern)
        for batch in batches:
            ids = [x.astype(np.int32) for x in replay.encode_all(batch.column(1).to_pylist())]
            yield record_batch({
                "doc_id": (batch.column(0), None), "ids": (ids, pa.list_(pa.int32())), "n_tokens": ([len(x) for x in ids], pa.int64()),
                "ids_sha256": ([hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in ids], pa.string()),
                "decoded_sha256": ([hashlib.sha256(replay.decode(x)).hexdigest() for x in ids], pa.string()),
            })

    source = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, ids array<int>, n_tokens long, ids_sha256 string, decoded_sha256 string")


def bpe_digest(docs: DataFrame, ranks_path: str, pattern: str, **names) -> DataFrame:
    """The contract's columns, one row per document (digests taken where the ids are made)."""
    key, text = names.get("key", "doc_id"), names.get("text", "text")

    def run(batches):
        replay = encoder(ranks_path, pattern)
        for batch in batches:
            counts, ids_sha, decoded_sha = [], [], []
            for ids in replay.encode_all(batch.column(1).to_pylist()):
                counts.append(len(ids))
                ids_sha.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
                decoded_sha.append(hashlib.sha256(replay.decode(ids)).hexdigest())
            yield record_batch({
                "doc_id": (batch.column(0), None), "n_tokens": (counts, pa.int64()),
                "ids_sha256": (ids_sha, pa.string()), "decoded_sha256": (decoded_sha, pa.string()),
            })

    source = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
