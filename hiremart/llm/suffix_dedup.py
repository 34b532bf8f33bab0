"""Removal of repeated byte strings across all documents.

Every byte is removed that is covered by a string of ``length`` bytes which also
starts earlier: in a document with a smaller id, or before in the same one.

Strings are compared in blocks by a Burrows-Wheeler transform with
threshold-bounded interval expansion (``substring_index``).  To bring equal
strings into one block, each window of ``length`` bytes is dealt by its
minimizer, the least hash among its pieces of ``CORE`` bytes; a run of windows
with one minimizer travels as one piece of text.

1. Documents with equal texts: all but those with the least id go whole.
2. Minimizers are exchanged as arrays, by hash range.  Those that occur once in the
   corpus cannot be repeated and end there.
3. Only documents with repeated minimizers are read again; the pieces meet by
   minimizer.  Equal pieces are pre-aggregated in the task, and again in the
   block; the different ones that are left make up the transform's text.
4. A minimizer that occurs more than ``HOT`` times, or ``HOT_IN_CHUNK`` times within one
   chunk, would make a group without bound: its windows travel one by one as 96-bit
   fingerprints, pre-aggregated in each task, and are dealt by fingerprint.
5. The repeated windows of a document are united and cut from its bytes.  Documents with
   repeated minimizers are written once, in buckets by their key, so that spans come
   to the texts without a second shuffle of these.

Defined results: null and empty texts have 0 bytes; texts shorter than ``length``
lose nothing; a null doc_id counts as smaller than all others; a row that
repeats another one, id and text, is the same document and gets the same result;
rows that share an id but not the text are both judged by (doc_id, start).
Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hiremart.llm.common import bucketed, discard, record_batch, salted_left_join, shuffle_partitions, utf8, worker_cache, written
from hiremart.llm.shingles import mix
from hiremart.llm.substring_index import BYTE, SEPARATOR, repeat_classes

LENGTH = 100
CORE = 32
UNIT_BYTES = 2 << 20
CHUNK_BYTES = 16 << 20
CHUNK_ROWS = 60_000
HOT = 1_000
HOT_IN_CHUNK = 16
BLOCK_BYTES = 1 << 20

_VALUES = np.random.default_rng(2).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = np.uint64((1 << 24) - 1)


def _core_hashes(codes: np.ndarray, core: int) -> np.ndarray:
    """Hash of every string of ``core`` bytes (a power of two), by doubling."""
    out, size = _VALUES[codes], 1
    while size < core:
        out = mix(out[:-size] * np.uint64(0x9E3779B97F4A7C15) + out[size:])
        size *= 2
    return out


class Runs:
    """Runs of windows with one minimizer: document number, first window, windows, minimizer's hash and place."""

    def __init__(self, doc, start, count, key, anchor):
        self.doc, self.start, self.count, self.key, self.anchor = doc, start, count, key, anchor


def _unit_runs(data: bytes, ends: np.ndarray, length: int, core: int) -> tuple[Runs, np.ndarray]:
    """Runs of the windows of joined texts that lie in one text, and the hashes of all cores."""
    codes = np.frombuffer(data, np.uint8)
    n = len(codes) - length + 1
    hashes = _core_hashes(codes, core)
    least, size, width = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64), 1, length - core + 1
    while size * 2 <= width:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < width:
        least = np.minimum(least[: len(least) - (width - size)], least[width - size :])
    anchor = (least[:n] & _PLACE).astype(np.int64)
    doc = np.searchsorted(ends, np.arange(n), "right")
    inside = np.arange(n) + length <= ends[doc]
    fresh = np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])))
    first = np.flatnonzero(fresh & inside)
    number = np.cumsum(fresh & inside) - 1
    count = np.bincount(number[inside], minlength=len(first)) if len(first) else np.zeros(0, np.int64)
    return Runs(doc[first], first, count, mix(hashes[anchor[first]]), anchor[first]), hashes


def units(texts: list[bytes], length: int, core: int) -> Iterator[tuple[np.ndarray, np.ndarray, bytes, Runs, np.ndarray]]:
    """(document numbers, offsets, bytes, runs, core hashes) of bounded units; places are within the unit,
    and a document's own places are those plus its offset.  A long text makes several units that overlap."""
    k = 0
    while k < len(texts):
        if len(texts[k]) > UNIT_BYTES:
            at = 0
            while at + length <= len(texts[k]):
                part = texts[k][at : at + UNIT_BYTES]
                runs, hashes = _unit_runs(part, np.array([len(part)]), length, core)
                yield np.array([k]), np.array([at]), part, runs, hashes
                at += UNIT_BYTES - length + 1
            k += 1
            continue
        numbers, size = [], 0
        while k < len(texts) and len(texts[k]) <= UNIT_BYTES and (not size or size + len(texts[k]) <= UNIT_BYTES):
            if len(texts[k]) >= length:
                numbers.append(k)
                size += len(texts[k])
            k += 1
        if numbers:
            data = b"".join([texts[i] for i in numbers])
            ends = np.cumsum([len(texts[i]) for i in numbers])
            runs, hashes = _unit_runs(data, ends, length, core)
            yield np.array(numbers), np.concatenate(([0], -ends[:-1])), data, runs, hashes


# ---------------------------------------------------------------------------
# 2. minimizers that occur more than once
# ---------------------------------------------------------------------------

SENT = "bucket int, chunk long, keys binary, docs binary, places binary, hot binary, ids binary"


def _planes(values: np.ndarray) -> bytes:
    steps = np.diff(values.astype(np.uint32), prepend=np.uint32(0)).astype("<u4")
    return steps.view(np.uint8).reshape(-1, 4).T.tobytes()


def _from_planes(data: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(data, np.uint8).reshape(4, -1).T.copy().view("<u4").ravel(), dtype=np.uint32)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    names = ("bucket", "chunk", "keys", "docs", "places", "hot", "ids")
    types = [pa.int32(), pa.int64()] + [pa.binary()] * 5
    return record_batch({n: (list(c), t) for n, t, c in zip(names, types, zip(*rows))})


def _chunk_rows(found: list[tuple], ids: np.ndarray, chunk: int, buckets: int) -> pa.RecordBatch:
    """Rows of one chunk: its minimizers by bucket; those hot within it go without places, which stay in the chunk's own row."""
    key, doc, place = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))
    order = np.lexsort((place, doc, key))
    key, doc, place = key[order], doc[order], place[order]
    fresh = np.concatenate(([True], key[1:] != key[:-1]))[: len(key)]
    first = np.flatnonzero(fresh)
    hot = np.diff(np.concatenate((first, [len(key)]))) >= HOT_IN_CHUNK
    each = hot[np.cumsum(fresh) - 1]
    bits = buckets.bit_length() - 1
    own = [key[first[hot]], key[~each], doc[~each], place[~each]]
    edges = np.arange(buckets + 1, dtype=np.uint64)
    shift, rest = np.uint64(64 - bits), np.uint64(32 - bits)
    hot_bounds, bounds = np.searchsorted(own[0] >> shift, edges), np.searchsorted(own[1] >> shift, edges)
    rows = []
    for b in range(buckets):
        (a, z), (p, q) = hot_bounds[b : b + 2], bounds[b : b + 2]
        if z > a or q > p:
            rows.append((
                b, chunk, _planes((own[1][p:q] >> rest).astype(np.uint32)), own[2][p:q].astype("<u2").tobytes(),
                own[3][p:q].astype("<u4").tobytes(), _planes((own[0][a:z] >> rest).astype(np.uint32)), None,
            ))
    rows.append((chunk % buckets, chunk, None, doc[each].astype("<u2").tobytes(), place[each].astype("<u4").tobytes(), None, ids.astype("<i8").tobytes()))
    return _rows(rows)


def _answer(frame: pd.DataFrame) -> pd.DataFrame:
    """Of one bucket: the places of repeated minimizers, by chunk, and whether they are hot."""
    out: list[tuple] = []
    plain = frame[frame["keys"].notna()]
    if len(plain):
        keys = [_from_planes(x) for x in plain["keys"]]
        hot = [_from_planes(x) for x in plain["hot"]]
        whole = np.concatenate(keys)
        values, number, count = np.unique(whole, return_inverse=True, return_counts=True)
        burning = np.isin(values, np.concatenate(hot)) | (count > HOT)
        state = np.where(burning, 2, np.where(count > 1, 1, 0)).astype(np.uint8)[number]
        at = 0
        for chunk, docs, places, mine in zip(plain["chunk"], plain["docs"], plain["places"], keys):
            s = state[at : at + len(mine)]
            at += len(mine)
            kept = s > 0
            if kept.any():
                out.append((chunk, np.frombuffer(docs, "<u2")[kept].tobytes(), np.frombuffer(places, "<u4")[kept].tobytes(), s[kept].tobytes(), None))
    for row in frame[frame["ids"].notna()].itertuples():
        out.append((row.chunk, row.docs, row.places, b"\2" * (len(row.docs) // 2), row.ids))
    return pd.DataFrame(out, columns=["chunk", "docs", "places", "states", "ids"])


def _by_document(frame: pd.DataFrame) -> pd.DataFrame:
    """Of one chunk: the repeated minimizers of each document."""
    ids = np.frombuffer(frame["ids"].dropna().iloc[0], "<i8").reshape(-1, 2)
    doc = np.frombuffer(b"".join(frame["docs"]), "<u2")
    place, state = np.frombuffer(b"".join(frame["places"]), "<u4"), np.frombuffer(b"".join(frame["states"]), np.uint8)
    order = np.lexsort((place, doc))
    doc, place, state = doc[order], place[order], state[order]
    cut = np.flatnonzero(doc[1:] != doc[:-1]) + 1
    first = np.concatenate(([0], cut)) if len(doc) else np.zeros(0, np.int64)
    owner = doc[first]
    return pd.DataFrame({
        "d": ids[owner, 0], "h": ids[owner, 1], "places": [x.tobytes() for x in np.split(place, cut)][: len(first)],
        "states": [x.tobytes() for x in np.split(state, cut)][: len(first)],
    })


def repeated_minimizers(source: DataFrame, length: int, core: int) -> DataFrame:
    """d, h, places and states of the minimizers that may be repeated (``source``: d, h, text)."""
    buckets = 1 << min(24, (4 * shuffle_partitions(source.sparkSession)).bit_length())

    def run(batches):
        worker_cache("suffix-dedup")
        part, number = TaskContext.get().partitionId(), 0
        found, ids, size = [], [], 0
        for batch in batches:
            texts = [t or b"" for t in utf8(batch.column(2))]
            keys = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1)], 1) if texts else np.zeros((0, 2), np.int64)
            at = 0
            while at < len(texts):  # a batch may hold several chunks
                end, taken = at, 0
                while end < len(texts) and (not taken or taken + size < CHUNK_BYTES) and end - at + len(ids) < CHUNK_ROWS:
                    taken += len(texts[end])
                    end += 1
                for numbers, offsets, _, runs, _ in units(texts[at:end], length, core):
                    found.append((runs.key, numbers[runs.doc] + len(ids), runs.anchor + offsets[runs.doc]))
                ids.extend(keys[at:end])
                size += taken
                at = end
                if size >= CHUNK_BYTES or len(ids) >= CHUNK_ROWS:
                    yield _chunk_rows(found, np.array(ids), part << 24 | number, buckets)
                    found, ids, size, number = [], [], 0, number + 1
        if ids:
            yield _chunk_rows(found, np.array(ids), part << 24 | number, buckets)

    answers = source.select("d", "h", "text").mapInArrow(run, SENT).groupBy("bucket").applyInPandas(
        _answer, "chunk long, docs binary, places binary, states binary, ids binary"
    )
    return answers.groupBy("chunk").applyInPandas(_by_document, "d long, h long, places binary, states binary")


# ---------------------------------------------------------------------------
# 3, 4. pieces and windows meet
# ---------------------------------------------------------------------------

PIECES = "bucket int, kind string, keys binary, ids binary, starts binary, counts binary, body binary"


class _Spans:
    """Removed spans by document, as one row for each document."""

    def __init__(self):
        self.rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def add(self, ids: np.ndarray, start: np.ndarray, end: np.ndarray) -> None:
        if len(start):
            self.rows.append((ids, start, end))

    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not self.rows:
            return np.zeros((0, 2), np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        return tuple(np.concatenate(x) for x in zip(*self.rows))

    def united(self) -> pd.DataFrame:
        ids, start, end = self.arrays()
        order = np.lexsort((start, ids[:, 1], ids[:, 0]))
        ids, start, end = ids[order], start[order], end[order]
        new_doc = np.concatenate(([True], (ids[1:] != ids[:-1]).any(1)))[: len(ids)]
        first_doc = np.flatnonzero(new_doc)
        # unite overlapping spans: ends run on within a document
        base = np.cumsum(new_doc) * (1 << 40)
        reach = np.maximum.accumulate(end + base) if len(end) else end
        fresh = new_doc | np.concatenate(([True], start[1:] + base[1:] > reach[:-1]))[: len(ids)]
        first = np.flatnonzero(fresh)
        last = np.concatenate((first[1:] - 1, [len(ids) - 1])) if len(first) else first
        start, end = start[first], (reach - base)[last]
        cut = np.searchsorted(first, first_doc)[1:]
        return pd.DataFrame({
            "d": ids[first_doc, 0], "h": ids[first_doc, 1],
            "starts": [x.astype("<u4").tobytes() for x in np.split(start, cut)][: len(first_doc)],
            "ends": [x.astype("<u4").tobytes() for x in np.split(end, cut)][: len(first_doc)],
        })


def _later(number: np.ndarray, ids: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Which of the occurrences of each number are not its earliest, by (document id, start)."""
    order = np.lexsort((start, ids[:, 0], number))
    n, d, s = number[order], ids[order, 0], start[order]
    fresh = np.concatenate(([True], n[1:] != n[:-1]))[: len(n)]
    first = np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
    out = np.zeros(len(n), bool)
    out[order] = (d != d[first]) | (s != s[first])
    return out


def _numbered(bodies: list[bytes], keys: np.ndarray) -> np.ndarray:
    """A number for each (key, bytes)."""
    known: dict[tuple[int, bytes], int] = {}
    return np.fromiter((known.setdefault((k, b), len(known)) for k, b in zip(keys.tolist(), bodies)), np.int64, len(bodies))


def _pair_numbers(key: np.ndarray, check: np.ndarray) -> np.ndarray:
    """A number for each pair, equal for equal pairs."""
    order = np.lexsort((check, key))
    k, c = key[order], check[order]
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(np.concatenate(([False], (k[1:] != k[:-1]) | (c[1:] != c[:-1])))[: len(order)])
    return number


def _window_fingerprints(hashes: np.ndarray, at: np.ndarray, length: int, core: int) -> tuple[np.ndarray, np.ndarray]:
    """64 and 32 bits of the windows that start at ``at``, from the hashes of cores that cover them."""
    a, b = np.zeros(len(at), np.uint64), np.ones(len(at), np.uint64)
    for shift in [*range(0, length - core, core), length - core]:
        h = hashes[at + shift]
        a = mix(a * np.uint64(0x9E3779B97F4A7C15) + h)
        b = mix(b * np.uint64(0xD6E8FEB86659FD93) ^ h)
    return a, (b >> np.uint64(32)).astype(np.uint32)


def _travelling(batches, length: int, core: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """Pieces and hot windows of the touched documents, pre-aggregated by chunk, and the spans known by that."""
    names = ("bucket", "kind", "keys", "ids", "starts", "counts", "body")
    types = [pa.int32(), pa.string()] + [pa.binary()] * 5
    shift = np.uint64(64 - (buckets.bit_length() - 1))
    held: dict[str, list] = {}
    size = 0

    def clear():
        held.update(key=[], ids=[], start=[], count=[], body=[], hot=[], check=[], hot_ids=[], hot_start=[])

    def flush() -> Iterator[pa.RecordBatch]:
        spans, rows = _Spans(), []
        if held["body"]:
            key, ids, start, count = (np.concatenate(held[k]) for k in ("key", "ids", "start", "count"))
            number = _numbered(held["body"], key)
            later = _later(number, ids, start)
            spans.add(ids[later], start[later], start[later] + count[later] - 1 + length)
            kept = np.flatnonzero(~later)  # one for each, but for rows that share an id
            kept = kept[np.argsort(key[kept], kind="stable")]
            bounds = np.searchsorted(key[kept] >> shift, np.arange(buckets + 1, dtype=np.uint64))
            for b in range(buckets):
                k = kept[bounds[b] : bounds[b + 1]]
                if len(k):
                    rows.append((b, "piece", key[k].astype("<u8").tobytes(), ids[k].astype("<i8").tobytes(), start[k].astype("<u4").tobytes(),
                                 count[k].astype("<u2").tobytes(), b"".join([held["body"][i] for i in k])))
        if held["hot"]:
            key, check, ids, start = (np.concatenate(held[k]) for k in ("hot", "check", "hot_ids", "hot_start"))
            later = _later(_pair_numbers(key, check), ids, start)
            spans.add(ids[later], start[later], start[later] + length)
            kept = np.flatnonzero(~later)  # one for each, but for rows that share an id
            kept = kept[np.argsort(key[kept], kind="stable")]
            bounds = np.searchsorted(key[kept] >> shift, np.arange(buckets + 1, dtype=np.uint64))
            for b in range(buckets):
                k = kept[bounds[b] : bounds[b + 1]]
                if len(k):
                    rows.append((b, "window", key[k].astype("<u8").tobytes(), ids[k].astype("<i8").tobytes(), start[k].astype("<u4").tobytes(), None, check[k].astype("<u4").tobytes()))
        known = spans.united()
        for row in known.itertuples():
            rows.append((row.h % buckets, "span", None, np.array([row.d, row.h], "<i8").tobytes(), row.starts, row.ends, None))
        if rows:
            yield record_batch({n: (list(c), t) for n, t, c in zip(names, types, zip(*rows))})
        clear()

    clear()
    for batch in batches:
        texts = [t or b"" for t in utf8(batch.column(2))]
        keys = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1)], 1) if texts else np.zeros((0, 2), np.int64)
        places, states = batch.column(3).to_pylist(), batch.column(4).to_pylist()
        for numbers, offsets, data, runs, hashes in units(texts, length, core):
            wanted = np.zeros(len(runs.doc), np.uint8)
            bounds = np.searchsorted(runs.doc, np.arange(len(numbers) + 1))
            for i, number in enumerate(numbers.tolist()):
                mine = slice(bounds[i], bounds[i + 1])
                place, state = np.frombuffer(places[number], "<u4"), np.frombuffer(states[number], np.uint8)
                at = np.searchsorted(place, runs.anchor[mine] + offsets[i])
                at = np.minimum(at, len(place) - 1)
                wanted[mine] = np.where(place[at] == runs.anchor[mine] + offsets[i], state[at], 0)
            own = keys[numbers[runs.doc]]
            start = runs.start + offsets[runs.doc]
            some = np.flatnonzero(wanted == 1)
            if len(some):
                held["key"].append(runs.key[some])
                held["ids"].append(own[some])
                held["start"].append(start[some])
                held["count"].append(runs.count[some])
                low, high = runs.start[some].tolist(), (runs.start[some] + runs.count[some] - 1 + length).tolist()
                held["body"] += [data[a:b] for a, b in zip(low, high)]
                size += sum(high) - sum(low) + 100 * len(some)
            some = np.flatnonzero(wanted == 2)
            if len(some):
                n = runs.count[some]
                step = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
                window = np.repeat(runs.start[some], n) + step
                a, b = _window_fingerprints(hashes, window, length, core)
                held["hot"].append(a)
                held["check"].append(b)
                held["hot_ids"].append(np.repeat(own[some], n, 0))
                held["hot_start"].append(np.repeat(start[some], n) + step)
                size += 40 * len(window)
            if size >= CHUNK_BYTES:
                yield from flush()
                size = 0
    yield from flush()


def _block_spans(key: np.ndarray, ids: np.ndarray, start: np.ndarray, count: np.ndarray, bodies: list[bytes], length: int, spans: _Spans) -> None:
    """Repeated windows among different pieces, by the transform; pieces come sorted by key."""
    text = np.frombuffer((b"".join([b + b"\0" for b in bodies])), np.uint8).astype(np.uint16) + BYTE
    sizes = np.array([len(b) + 1 for b in bodies])
    first = np.cumsum(sizes) - sizes
    text[first + sizes - 1] = SEPARATOR
    step = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    piece = np.repeat(np.arange(len(bodies)), count)
    later = _later(repeat_classes(text, first[piece] + step, length), ids[piece], start[piece] + step)
    at = np.flatnonzero(later)
    if len(at):
        fresh = np.concatenate(([True], (at[1:] != at[:-1] + 1) | (piece[at[1:]] != piece[at[:-1]])))
        low = at[fresh]
        high = np.concatenate((at[np.flatnonzero(fresh)[1:] - 1], at[-1:]))
        spans.add(ids[piece[low]], start[piece[low]] + step[low], start[piece[low]] + step[high] + length)


def _meeting(length: int):
    def meet(frame: pd.DataFrame) -> pd.DataFrame:
        spans = _Spans()
        part = frame[frame["kind"] == "piece"]
        if len(part):
            key = np.concatenate([np.frombuffer(x, "<u8") for x in part["keys"]])
            ids = np.concatenate([np.frombuffer(x, "<i8").reshape(-1, 2) for x in part["ids"]])
            start = np.concatenate([np.frombuffer(x, "<u4") for x in part["starts"]]).astype(np.int64)
            count = np.concatenate([np.frombuffer(x, "<u2") for x in part["counts"]]).astype(np.int64)
            size = count - 1 + length
            whole = b"".join(part["body"])
            end = np.cumsum(size)
            bodies = [whole[a:b] for a, b in zip((end - size).tolist(), end.tolist())]
            number = _numbered(bodies, key)
            later = _later(number, ids, start)
            spans.add(ids[later], start[later], start[later] + size[later])
            kept = np.flatnonzero(~later)  # one for each, but for rows that share an id
            kept = kept[np.argsort(key[kept], kind="stable")]
            _, first, n = np.unique(key[kept], return_index=True, return_counts=True)
            kept = kept[np.repeat(n > 1, n)]  # a piece alone on its minimizer meets nothing
            at = 0
            bound = np.cumsum(size[kept])
            while at < len(kept):  # blocks of bounded size, cut between minimizers
                to = int(np.searchsorted(bound, (bound[at - 1] if at else 0) + BLOCK_BYTES, "right"))
                to = max(at + 1, to)
                while to < len(kept) and key[kept[to]] == key[kept[to - 1]]:
                    to += 1
                k = kept[at:to]
                _block_spans(key[k], ids[k], start[k], count[k], [bodies[i] for i in k], length, spans)
                at = to
        part = frame[frame["kind"] == "window"]
        if len(part):
            key = np.concatenate([np.frombuffer(x, "<u8") for x in part["keys"]])
            check = np.concatenate([np.frombuffer(x, "<u4") for x in part["body"]])
            ids = np.concatenate([np.frombuffer(x, "<i8").reshape(-1, 2) for x in part["ids"]])
            start = np.concatenate([np.frombuffer(x, "<u4") for x in part["starts"]]).astype(np.int64)
            later = _later(_pair_numbers(key, check), ids, start)
            spans.add(ids[later], start[later], start[later] + length)
        for row in frame[frame["kind"] == "span"].itertuples():
            s, e = np.frombuffer(row.starts, "<u4").astype(np.int64), np.frombuffer(row.counts, "<u4").astype(np.int64)
            spans.add(np.repeat(np.frombuffer(row.ids, "<i8").reshape(1, 2), len(s), 0), s, e)
        return spans.united()

    return meet


# ---------------------------------------------------------------------------
# whole
# ---------------------------------------------------------------------------

def _united_spans(starts: list[bytes], ends: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Maximal spans of the union."""
    a = np.concatenate([np.frombuffer(x, "<u4") for x in starts]).astype(np.int64)
    b = np.concatenate([np.frombuffer(x, "<u4") for x in ends]).astype(np.int64)
    order = np.argsort(a, kind="stable")
    a, b = a[order], np.maximum.accumulate(b[order])
    fresh = np.concatenate(([True], a[1:] > b[:-1]))
    return a[fresh], b[np.concatenate((np.flatnonzero(fresh)[1:] - 1, [len(b) - 1]))]


def _keyed(key: str, text: str):
    """Columns d, h and the text without nulls: d and h name a document."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return F.coalesce(F.col(key).cast("long"), F.lit(-(1 << 63))).alias("d"), F.xxhash64(t).alias("h"), t


def _core(length: int) -> int:
    core = CORE
    while core * 2 > length:
        core //= 2
    return core


def _marked(docs: DataFrame, key: str, text: str, length: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(copy of one slim row for each document; the same with ``copy`` for later documents of an equal text;
    d, h, places and states of the repeated minimizers of the others)."""
    d, h, t = _keyed(key, text)
    base = docs.select(
        F.col(key).alias("doc_id"), d, h, F.xxhash64(F.lit(1), t).alias("h2"),
        F.octet_length(t).cast("long").alias("n_bytes"), F.sha2(t.cast("binary"), 256).alias("sha"),
    )
    base = written(base, "suffix-base")
    least = base.groupBy("h", "h2").agg(F.min("d").alias("least"), F.max("d").alias("most")).where("least < most").select("h", "h2", "least")
    flagged = salted_left_join(base, least, ["h", "h2"], F.col("d"))
    flagged = flagged.withColumn("copy", F.coalesce((F.col("d") > F.col("least")) & (F.col("n_bytes") >= length), F.lit(False)))
    places = repeated_minimizers(docs.select(d, h, t.alias("text")), length, _core(length)).dropDuplicates(["d", "h"])
    return base, flagged, places.join(flagged.where("copy").select("d", "h").distinct(), ["d", "h"], "left_anti")


def _spans(touched: DataFrame, length: int) -> DataFrame:
    """d, h and spans (starts and ends of removed bytes) of the documents that lose some; touched: d, h, text, places, states."""
    core = _core(length)
    buckets = 1 << min(24, (4 * shuffle_partitions(touched.sparkSession)).bit_length())
    sent = touched.select("d", "h", "text", "places", "states").mapInArrow(lambda batches: _travelling(batches, length, core, buckets), PIECES)
    spans = sent.groupBy("bucket").applyInPandas(_meeting(length), "d long, h long, starts binary, ends binary")
    return spans.groupBy("d", "h").agg(F.collect_list(F.struct("starts", "ends")).alias("spans"))


def _cut_bytes(text: bytes, found: list[dict]) -> tuple[bytes, int]:
    """What is left without the spans, and how many runs they make."""
    a, b = _united_spans([s["starts"] for s in found], [s["ends"] for s in found])
    parts, at = [], 0
    for x, y in zip(a.tolist(), b.tolist()):
        parts.append(text[at:x])
        at = y
    return b"".join([*parts, text[at:]]), len(a)


def remove_repeats(docs: DataFrame, *, key: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every document."""
    d, h, t = _keyed(key, text)
    base, flagged, places = _marked(docs, key, text, length)
    touched = docs.select(d, h, t.alias("text")).join(places, ["d", "h"]).dropDuplicates(["d", "h"])
    touched = bucketed(touched.select("d", "h", "text", "places", "states"), "suffix-touched", ["d", "h"])

    def digests(batches):
        for batch in batches:
            cut = [(t, *_cut_bytes(t, found)) for t, found in zip(utf8(batch.column(2)), batch.column(3).to_pylist())]
            yield record_batch({
                "d": (batch.column(0), None), "h": (batch.column(1), None), "removed": ([len(t) - len(left) for t, left, _ in cut], pa.int64()),
                "runs": ([n for *_, n in cut], pa.int64()), "left": ([hashlib.sha256(left).hexdigest() for _, left, _ in cut], pa.string()),
            })

    joined = touched.select("d", "h", "text").join(_spans(touched, length), ["d", "h"])
    result = joined.mapInArrow(digests, "d long, h long, removed long, runs long, left string")
    joined = flagged.join(result, ["d", "h"], "left")
    zero = F.lit(0).cast("long")
    nothing = hashlib.sha256(b"").hexdigest()
    return joined.select(
        "doc_id", "n_bytes", F.when(F.col("copy"), F.col("n_bytes")).otherwise(F.coalesce("removed", zero)).alias("n_removed"),
        F.when(F.col("copy"), F.lit(1).cast("long")).otherwise(F.coalesce("runs", zero)).alias("n_spans"),
        F.when(F.col("copy"), F.lit(nothing)).otherwise(F.coalesce("left", "sha")).alias("kept_sha256"),
    )


def without_repeats(docs: DataFrame, *, key: str = "doc_id", text: str = "text", size: str | None = None, length: int = LENGTH) -> DataFrame:
    """The rows of ``docs`` with the repeats cut from their text; ``size`` names a column of character counts to bring up to date.

    The rest of a character that is cut in two goes too.  Documents of which
    nothing is left go; those that had no text stay."""
    d, h, t = _keyed(key, text)
    base, flagged, places = _marked(docs, key, text, length)
    copies = flagged.where("copy").select("d", "h").distinct()
    marks = places.withColumn("copy", F.lit(False)).unionByName(copies.withColumn("copy", F.lit(True)), allowMissingColumns=True)
    rows = docs.select(F.struct("*").alias("row"), d, h).join(marks, ["d", "h"], "left").where(~F.coalesce("copy", F.lit(False)))
    rows = bucketed(rows.select("row", "d", "h", "places", "states"), "suffix-rows", ["d", "h"])
    discard(base)
    own = F.coalesce(F.col("row")[text].cast("string"), F.lit(""))
    # a row that repeats another one is the same document; the buckets hold both, so nothing is shuffled
    touched = rows.where("places is not null").select("d", "h", own.alias("text"), "places", "states").dropDuplicates(["d", "h"])
    spans = _spans(touched, length)
    names = [f"c{k}" for k in range(len(docs.columns))]
    columns = [F.col("row")[c].alias(n) for c, n in zip(docs.columns, names)]
    joined = rows.select("row", "d", "h").join(spans, ["d", "h"], "left").select(*columns, own.alias("text"), "spans")
    schema = T.StructType([T.StructField(n, f.dataType) for n, f in zip(names, docs.schema.fields)])
    at_text, at_size = docs.columns.index(text), None if size is None else docs.columns.index(size)

    def cut(batches):
        for batch in batches:
            columns = batch.columns[: len(names)]
            left = [None if found is None else _cut_bytes(t, found)[0].decode("utf-8", "ignore") for t, found in zip(utf8(batch.column(len(names))), batch.column(len(names) + 1).to_pylist())]
            changed = pa.array([x is not None for x in left], pa.bool_())
            columns[at_text] = pc.if_else(changed, pa.array(left, pa.string()).cast(columns[at_text].type), columns[at_text])
            if at_size is not None:
                sizes = pa.array([None if x is None else len(x) for x in left], pa.int64())
                columns[at_size] = pc.if_else(changed, sizes.cast(columns[at_size].type), columns[at_size])
            yield pa.RecordBatch.from_arrays(columns, names=names).filter(pa.array([x != "" for x in left], pa.bool_()))

    return joined.mapInArrow(cut, schema).toDF(*docs.columns)
