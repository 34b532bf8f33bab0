"""Benchmark decontamination with a generalised suffix automaton of words.

The benchmark items, lower-cased and split into words, form one suffix
automaton whose symbols are word numbers.  Documents are streamed through it
word by word; the state and the longest matching length tell which windows of
which items end at every word.  A window is ``window`` consecutive words of an
item; a shorter item, if it has words, is one window.

Scale: documents are only mapped, never shuffled, where the items fit one automaton.  It is built from
at most ``MAX_BLOCK_BYTES`` of item text (about 130 MB of memory); a larger benchmark is cut into
blocks of items with an automaton each, and every block streams over all
documents, so nothing unbounded is broadcast.  Then only the ids, spans and items of documents with hits are
written for each block, and are joined to the documents once, at the end.  The driver reads the items and
builds the automata, and holds one block and its automaton at a time.

Defined results: null or word-less text has no words and no hits; null or
word-less items have no windows; repeated items count by distinct item id;
a null item id is left out of the id list but its windows still hit; empty
tables give no rows or no hits.  Input columns other than the named ones are
not read, so clashing names do no harm.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hiremart.llm.common import record_batch, utf8, written
from hiremart.operators.materialize import broadcast_if_small

WINDOW = 13
MAX_BLOCK_BYTES = 1 << 20

#: ASCII letters lower-cased, digits and all non-ASCII bytes kept, the rest blank.
WORD_BYTES = bytes(
    c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else c + 32 if 0x41 <= c <= 0x5A else 0x20
    for c in range(256)
)


def words(text: bytes | None) -> list[bytes]:
    return text.translate(WORD_BYTES).split() if text else []


class SuffixAutomaton:
    """Generalised suffix automaton over word numbers, with item marks.

    ``step`` maps each state's words to states, ``link`` holds suffix links
    and ``size`` the longest string of each state.  ``marks(state, length)``
    lists the windows that end where a stream stands.
    """

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.vocab: dict[bytes, int] = {}
        self.step: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.size = [0]
        coded = [(i, [self.vocab.setdefault(w, len(self.vocab)) for w in ws]) for i, ws in items if ws]
        for _, seq in coded:
            last = 0
            for word in seq:
                last = self._extend(last, word)
        self.shortest = min((min(window, len(seq)) for _, seq in coded), default=0)
        self._mark(coded)

    def _extend(self, last: int, word: int) -> int:
        step, link, size = self.step, self.link, self.size
        known = step[last].get(word)
        if known is not None:
            return known if size[known] == size[last] + 1 else self._clone(last, word, known)
        new = self._state({}, 0, size[last] + 1)
        at = last
        while at >= 0 and word not in step[at]:
            step[at][word] = new
            at = link[at]
        if at >= 0:
            target = step[at][word]
            link[new] = target if size[target] == size[at] + 1 else self._clone(at, word, target)
        return new

    def _state(self, step: dict[int, int], link: int, size: int) -> int:
        self.step.append(step)
        self.link.append(link)
        self.size.append(size)
        return len(self.size) - 1

    def _clone(self, at: int, word: int, target: int) -> int:
        copy = self._state(dict(self.step[target]), self.link[target], self.size[at] + 1)
        self.link[target] = copy
        while at >= 0 and self.step[at].get(word) == target:
            self.step[at][word] = copy
            at = self.link[at]
        return copy

    def _mark(self, coded: list[tuple[str | None, list[int]]]) -> None:
        """items[(state)]: ids by window length, at the state that holds the window."""
        self.items: dict[int, dict[int, set]] = {}
        for item, seq in coded:
            length = min(self.window, len(seq))
            state = matched = 0
            for k, word in enumerate(seq):
                state, matched = self.step[state][word], matched + 1
                if matched > length:
                    matched = length
                while self.size[self.link[state]] >= matched:
                    state = self.link[state]
                if k + 1 >= length:
                    self.items.setdefault(state, {}).setdefault(length, set()).add(item)
        # nearest marked ancestor, so that a walk up the links meets marked states only
        self.up = [-1] * len(self.size)
        for state in sorted(range(1, len(self.size)), key=self.size.__getitem__):
            parent = self.link[state]
            self.up[state] = parent if parent in self.items else self.up[parent] if parent > 0 else -1

    def marks(self, state: int, length: int):
        """(window length, item ids) of each window that ends here."""
        if state not in self.items:
            state = self.up[state]
        while state > 0:
            for n, ids in self.items[state].items():
                if n <= length:
                    yield n, ids
            state = self.up[state]

    def scan(self, ws: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Maximal hit spans [start, end) in words, and the ids of the items found."""
        spans: list[tuple[int, int]] = []
        found: set = set()
        if len(ws) < self.shortest or not self.shortest:
            return spans, found
        coded = np.fromiter(map(self.vocab.get, ws, repeat(-1)), np.int32, len(ws))
        unknown = np.flatnonzero(coded < 0)  # a word of no item ends every match
        edges = np.concatenate(([-1], unknown, [len(ws)]))
        for run in np.flatnonzero(np.diff(edges) > self.shortest):
            start = int(edges[run]) + 1
            state = length = 0
            for k, word in enumerate(coded[start : edges[run + 1]].tolist(), start):
                while state and word not in self.step[state]:
                    state = self.link[state]
                    length = self.size[state]
                nxt = self.step[state].get(word)
                if nxt is None:
                    length = 0
                    continue
                state, length = nxt, length + 1
                if length < self.shortest:
                    continue
                longest = 0
                for n, ids in self.marks(state, length):
                    longest = max(longest, n)
                    found |= ids
                if longest:
                    low = k + 1 - longest
                    while spans and spans[-1][1] >= low:  # overlapping or touching
                        low = min(low, spans.pop()[0])
                    spans.append((low, k + 1))
        return spans, found


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _blocks(benchmark: DataFrame, item: str, text: str, max_bytes: int) -> Iterator[list[tuple[str | None, list[bytes]]]]:
    """The items, one block of at most about ``max_bytes`` of text at a time (one item at least; an empty block without items)."""
    items = benchmark.select(F.col(item).cast("string").alias("i"), F.col(text).alias("t")).where(F.col("t").isNotNull())
    block: list = []
    used = 0
    for row in items.toLocalIterator():
        n = len(row["t"].encode())
        if used and used + n > max_bytes:
            yield block
            block, used = [], 0
        block.append((row["i"], words(row["t"].encode())))
        used += n
    yield block


def match_items(
    docs: DataFrame, benchmark: DataFrame, *, key: str = "doc_id", text: str = "text", item: str = "item_id",
    item_text: str = "text", window: int = WINDOW, max_block_bytes: int = MAX_BLOCK_BYTES, carry: bool = False,
) -> DataFrame:
    """One row per document: doc_id, text, n_words, spans (maximal hit spans in words), items (sorted ids);
    with ``carry`` also row, the whole input row as a struct."""
    spark = docs.sparkSession
    blocks = _blocks(benchmark, item, item_text, max_block_bytes)

    def automaton_of(block: list):
        shared = spark.sparkContext.broadcast(SuffixAutomaton(block, window))
        block.clear()
        return shared

    # rows that share id and text have the same hits
    name = [F.col(key).alias("doc_id"), F.xxhash64(F.col(text).cast("string")).alias("h")]
    source = docs.select(*name, F.col(text).cast("string").alias("text"), *([F.struct("*").alias("row")] if carry else []))
    shared = automaton_of(next(blocks))
    block = next(blocks, None)
    if block is None:
        return _with_hits(source, shared)
    hits = None
    while True:
        found = written(_hits(source.select("doc_id", "h", "text"), shared), "decontaminate-hits")
        hits = found if hits is None else hits.unionByName(found)
        shared.unpersist()
        if block is None:
            break
        shared = automaton_of(block)
        block = next(blocks, None)
    each = hits.distinct().groupBy("doc_id", "h").agg(F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("items")).alias("items"))
    each = broadcast_if_small(written(each, "decontaminate-found").select(F.col("doc_id").alias("_d"), F.col("h").alias("_h"), "spans", "items"))
    joined = source.join(each, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("h") == F.col("_h")), "left")
    return _with_hits(joined.select(*source.columns, "spans", "items"), None)


SPAN = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def _spans(found: list[tuple[int, int]]) -> list[dict]:
    return [{"start": a, "end": b} for a, b in found]


def _hits(source: DataFrame, shared) -> DataFrame:
    """doc_id, h, spans and items of the documents that one automaton hits."""

    def run(batches):
        for batch in batches:
            found = [shared.value.scan(words(t)) for t in utf8(batch.column(2))]
            hit = pa.array([bool(spans) for spans, _ in found], pa.bool_())
            rows = {
                "doc_id": (batch.column(0), None), "h": (batch.column(1), None), "spans": ([_spans(spans) for spans, _ in found], SPAN),
                "items": ([sorted(x for x in items if x is not None) for _, items in found], pa.list_(pa.string())),
            }
            yield record_batch(rows).filter(hit)

    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, h long, spans array<struct<start:int,end:int>>, items array<string>")


def _with_hits(source: DataFrame, shared) -> DataFrame:
    """``match_items``'s rows: scanned by the automaton ``shared``, or, where that is None, from the spans and items that the rows bring."""
    carried = ["row"] if "row" in source.columns else []

    def run(batches):
        for batch in batches:
            column = {n: batch.column(k) for k, n in enumerate(batch.schema.names)}
            counts, spans, items = [], [], []
            known = zip(column["spans"].to_pylist(), column["items"].to_pylist()) if shared is None else repeat(None)
            for t, found in zip(utf8(column["text"]), known):
                ws = words(t)
                if shared is not None:
                    hit, ids = shared.value.scan(ws)
                else:
                    hit, ids = merged([(s["start"], s["end"]) for s in found[0] or ()]), set(found[1] or ())
                counts.append(len(ws))
                spans.append(_spans(hit))
                items.append(sorted(x for x in ids if x is not None))
            yield record_batch({
                "doc_id": (column["doc_id"], None), "text": (column["text"], None), "n_words": (counts, pa.int64()),
                "spans": (spans, SPAN), "items": (items, pa.list_(pa.string())), **{c: (column[c], None) for c in carried},
            })

    schema = source.select("doc_id", "text", *carried).schema
    out = T.StructType([*schema.fields[:2], *T.StructType.fromDDL("n_words long, spans array<struct<start:int,end:int>>, items array<string>").fields, *schema.fields[2:]])
    return source.mapInArrow(run, out)


def remove_spans(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """``text`` without the bytes from the first to the last word of each span."""
    if not spans:
        return text
    blank = np.frombuffer(text.translate(WORD_BYTES), np.uint8) == 0x20
    inside = np.diff(np.concatenate(([True], blank, [True])).astype(np.int8))
    starts, ends = np.flatnonzero(inside == -1), np.flatnonzero(inside == 1)
    keep = np.ones(len(text), bool)
    for a, b in spans:
        keep[starts[a] : ends[b - 1]] = False
    return np.frombuffer(text, np.uint8)[keep].tobytes()


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, *, key: str = "doc_id", text: str = "text", min_words: int = 1,
    min_share: tuple[int, int] = (1, 20), **options,
) -> DataFrame:
    """Documents with hits, coverage and cleaned text.

    Adds to ``match_items``: n_hit, contaminated (n_hit >= ``min_words`` and
    n_hit / n_words >= ``min_share``) and clean_text, from which the spans of
    contaminated documents are cut.
    """
    top, bottom = min_share
    found = match_items(docs, benchmark, key=key, text=text, **options)
    found = found.withColumn("n_hit", _n_hit())
    found = found.withColumn("contaminated", (F.col("n_hit") >= min_words) & (F.col("n_hit") * bottom >= F.col("n_words") * top))

    names = found.columns

    def clean(batches):
        for batch in batches:
            cut = [
                None if t is None else (remove_spans(t, [(s["start"], s["end"]) for s in spans]) if bad else t).decode("utf-8", "replace")
                for t, spans, bad in zip(utf8(batch.column(names.index("text"))), batch.column(names.index("spans")).to_pylist(), batch.column(names.index("contaminated")).to_pylist())
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cut, pa.string())], names=[*names, "clean_text"])

    schema = found.withColumn("clean_text", F.lit(None).cast("string")).schema
    return found.mapInArrow(clean, schema)


def _n_hit():
    return F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])


def without_contaminated(docs: DataFrame, benchmark: DataFrame, *, min_share: tuple[int, int] = (1, 20), **options) -> DataFrame:
    """The rows of ``docs``, whole, that are not contaminated."""
    found = match_items(docs, benchmark, carry=True, **options)
    bad = (_n_hit() > 0) & (_n_hit() * min_share[1] >= F.col("n_words") * min_share[0])
    return found.where(~bad).select("row.*")


def contamination_digest(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The contract's columns, one row per document."""
    found = match_items(docs, benchmark, **options)
    n_hit = _n_hit()
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        ((n_hit > 0) & (n_hit * 20 >= F.col("n_words"))).alias("contaminated"),
    )

