"""Token-id shards with a minimal perfect hash index.

Format.  A dataset is a folder with, for every shard, two files: ``*.ids``,
the raw ids of its documents one after the other (little-endian, two bytes an
id where the vocabulary allows, else four), and ``*.idx``, a numpy archive.  The index has the
minimal perfect hash over the shard's distinct keys and, by slot, a
fingerprint of the key, the place of its first id in the payload and the
number of its first document; by document it has key and length.  The
``manifest`` (Parquet) lists each committed shard with its key range, so a
key is found by one bisection over shards and one slot, whatever the size.

Writing: documents are range-partitioned by key, and each task streams one
shard to a file of its own name.  Only the rows that Spark commits into the
manifest count, so repeated or lost task attempts leave no trace in the data.
Reading goes through the index and checks every fingerprint.

Defined results: null text is empty and holds the end id alone; rows that
share a key are kept, in the order of a hash of their text, and the index
leads to the first of them; a null key sorts first and is not indexed.  An
empty table gives an empty dataset.  Other columns are not read.
"""

from __future__ import annotations

import json
import os
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator
from operator import add

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.models import BPE

from hiremart.llm.bpe import OTHER_SPACE
from hiremart.llm.common import record_batch, shuffle_partitions, worker_cache
from hiremart.llm.perfect_hash import MinimalPerfectHash, fingerprints, packed, unpacked

END_ID = 2
CALL_CHARS = 1 << 21
KEPT_WORDS = 1_200_000
READ_BYTES = 8 << 20

_tokenizers: dict[str, object] = {}


def tokenizer(path: str):
    """The worker's tokenizer, as its file has it: strings of added tokens in a text are those tokens."""
    if path not in _tokenizers:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _tokenizers[path] = Tokenizer.from_file(path)
    return _tokenizers[path]


#: Before a single blank between words no piece of a byte-level tokenizer's pattern reaches across.
WORD_EDGE = re.compile(r"(?<=\S)(?= \S)")
ONE_WORD = re.compile(r" ?\S+")
#: Of a word of Latin letters and then marks, a byte-level pattern makes two pieces: the letters, with the blank before them, and the marks.
#: (In UTF-8: A-Z, a-z, U+00C0 to U+02AF without the signs of multiplication and division.)
LETTERS = re.compile(rb" ?(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]|[\xc4-\xc9][\x80-\xbf]|\xca[\x80-\xaf])+")
MARKS = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
MARK_THEN_LETTER = re.compile(f"[{re.escape(MARKS.decode())}][A-Za-z]")
DOUBLE_SPACE = ("  ", " \n", "\n ", "\n\n")
PIECES_AT_ONCE = 2_000
BYTE_VALUES, PLACE_VALUES = (np.random.default_rng(k).integers(1, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1) for k, n in ((3, 256), (4, 4096)))


def _byte_letters() -> dict[int, str]:
    """The letter by which byte-level vocabularies write each byte."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(others)}


class Pieces:
    """Ids of pieces that are cut as the tokenizer's pattern cuts them: its model gets them many at a time,
    and a piece ends where the lengths of the tokens add up to its own."""

    def __init__(self, found):
        model = json.loads(found.to_str())["model"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        plain = BPE(model["vocab"], merges, cache_capacity=0, ignore_merges=bool(model.get("ignore_merges")))  # each piece comes once
        self.encode = Tokenizer(plain).encode_batch_fast
        self.letters = np.array([ord(c) for _, c in sorted(_byte_letters().items())], "<u4")
        self.letters[ord("\n")] = ord("\n")
        self.size = np.zeros(max(model["vocab"].values()) + 1, np.int64)
        self.size[list(model["vocab"].values())] = [len(token) for token in model["vocab"]]

    @staticmethod
    def fits(found) -> bool:
        """Whether the tokenizer is plain byte-level BPE, of whose added tokens none lies in letters and marks after them."""
        model, vocab = found.model, found.get_vocab(with_added_tokens=False)
        return (
            isinstance(model, BPE) and not (model.dropout or model.continuing_subword_prefix or model.end_of_word_suffix)
            and vocab.keys() >= set(_byte_letters().values())
            and str(found.pre_tokenizer) == "ByteLevel(add_prefix_space=False, trim_offsets=True, use_regex=True)"
            and all(MARK_THEN_LETTER.search(t.content) for t in found.get_added_tokens_decoder().values())
        )

    def of(self, pieces: list[bytes]) -> Iterator[bytes]:
        """Ids of each piece (none holds a line end)."""
        for at in range(0, len(pieces), PIECES_AT_ONCE):
            letters = self.letters[np.frombuffer(b"\n".join([*pieces[at : at + PIECES_AT_ONCE], b""]), np.uint8)]
            spelt = letters.tobytes().decode("utf-32-le").split("\n")[:-1]
            ids = np.array(self.encode([spelt], is_pretokenized=True, add_special_tokens=False)[0].ids, np.uint32)
            ends = np.flatnonzero(letters == ord("\n")) - np.arange(len(spelt))
            reach = np.cumsum(self.size[ids])
            last = np.searchsorted(reach, ends)
            if reach[-1] != ends[-1] or (reach[last] != ends).any():
                raise ValueError("the ids do not spell the pieces")
            raw, bounds = ids.tobytes(), ((last + 1) * 4).tolist()
            yield from (raw[a:b] for a, b in zip([0, *bounds], bounds))


class WordIds:
    """Ids of texts, word by word: each distinct word goes through the tokenizer once while it is remembered.
    At most ``KEPT_WORDS`` are: when half as many have been met, those not met since the time before are dropped.

    For byte-level tokenizers without a normalizer, whose added tokens neither hold white space
    nor take it from beside them; others get whole texts."""

    def __init__(self, path: str):
        found = tokenizer(path)
        self.encode = found.encode_batch_fast
        added = found.get_added_tokens_decoder().values()
        plain = all(not (t.lstrip or t.rstrip or t.single_word or re.search(r"\s", t.content)) for t in added)
        self.by_word = str(found.pre_tokenizer).startswith("ByteLevel") and found.normalizer is None and plain
        self.known: dict[bytes, bytes] = {}  # ids of words, little-endian unsigned 32-bit
        self.before: dict[bytes, bytes] = {}
        line_end = found.encode("\n", add_special_tokens=False).ids
        self.line_end = line_end[0] if len(line_end) == 1 else None
        self.pieces = Pieces(found) if self.by_word and Pieces.fits(found) else None

    def _learn_pieces(self, words: list[bytes]) -> list[bytes]:
        """Learn the words of letters and marks by their pieces, of which many are known words; the other words."""
        cores = [w.rstrip(MARKS) for w in words]
        good = set(filter(LETTERS.fullmatch, set(cores)))
        others = [w for w, c in zip(words, cores) if c not in good]
        if others:
            words = [w for w, c in zip(words, cores) if c in good]
            cores = [c for c in cores if c in good]
        tails = [w[len(c) :] for w, c in zip(words, cores)]
        pieces = good.union(tails)
        pieces.discard(b"")
        ids = {p: x for p in pieces if (x := self.known.get(p)) is not None}
        fresh = list(pieces.difference(ids))
        ids.update(zip(fresh, self.pieces.of(fresh)))
        ids[b""] = b""
        self.known.update(zip(words, map(add, map(ids.__getitem__, cores), map(ids.__getitem__, tails))))
        return others

    def _learn(self, words: list[bytes]) -> None:
        """Learn new words: by piece, or a few thousand at a time with line ends between."""
        if self.pieces is not None:
            words = self._learn_pieces(words)
        texts = [w.decode() for w in words]
        plain = [w for w in texts if ONE_WORD.fullmatch(w)] if self.line_end is not None else []
        for at in range(0, len(plain), 5_000):
            some = plain[at : at + 5_000]
            ids = np.array(self.encode(["\n".join([*some, ""])], add_special_tokens=False)[0].ids, np.uint32)
            ends = np.flatnonzero(ids == self.line_end)
            if len(ends) != len(some):
                continue
            raw, ends = ids.tobytes(), (ends * 4).tolist()
            self.known.update((w.encode(), raw[a:b]) for w, a, b in zip(some, [0, *(e + 4 for e in ends)], ends))
        rest = [t for w, t in zip(words, texts) if w not in self.known]
        for at in range(0, len(rest), 5_000):
            some = rest[at : at + 5_000]
            self.known.update((w.encode(), np.array(e.ids, np.uint32).tobytes()) for w, e in zip(some, self.encode(some, add_special_tokens=False)))

    def _ids_of(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word; the words are distinct."""
        ids = [*map(self.known.get, words)]
        fresh = [w for w, x in zip(words, ids) if x is None]
        if self.before:
            again = {w: x for w in fresh if (x := self.before.get(w)) is not None}
            self.known.update(again)
            fresh = [w for w in fresh if w not in again]
        self._learn(fresh)
        return [self.known[w] if x is None else x for w, x in zip(words, ids)]

    @staticmethod
    def _single_spaced(texts: list[str]) -> np.ndarray:
        """Of which texts the white space is single blanks and line ends between words; no piece reaches across these."""
        codes = np.frombuffer("\n".join(["", *texts, ""]).encode(), np.uint8)
        ends = np.cumsum([len(t.encode()) + 1 for t in texts])  # places of the line ends after the texts
        space = (codes == 32) | (codes == 10)
        double = np.flatnonzero(space[1:] & space[:-1])
        good = np.ones(len(texts) + 1, bool)
        good[np.searchsorted(ends, double)] = False
        good[np.searchsorted(ends, double + 1)] = False
        # first bytes of other white space, and of much else
        some = np.flatnonzero(((codes < 32) & (codes != 10)) | (codes == 0xC2) | (codes == 0xE1) | (codes == 0xE2) | (codes == 0xE3) | (codes == 0xEF))
        for k in np.unique(np.searchsorted(ends, some)).tolist():
            good[k] = good[k] and not OTHER_SPACE.search(texts[k])
        return good[:-1]

    def _at_once(self, texts: list[str]) -> Iterator[np.ndarray]:
        """Ids of single-spaced texts: their words are numbered by a hash of their bytes, and then compared byte by byte."""
        whole = "\n".join(texts).encode()
        codes = np.frombuffer(whole, np.uint8)
        line_end = codes == 10
        first = line_end | (codes == 32)
        first[1:] |= line_end[:-1]
        first[0] = True
        start = np.flatnonzero(first)
        size = np.diff(start, append=len(codes))
        place = np.arange(len(codes)) - np.repeat(start, size)
        hashes = np.add.reduceat(BYTE_VALUES[codes] * PLACE_VALUES[np.minimum(place, len(PLACE_VALUES) - 1)], start)
        number, distinct = pd.factorize(hashes)
        own = np.empty(len(distinct), np.int64)
        own[number[::-1]] = np.arange(len(number))[::-1]
        shift = np.repeat(start[own[number]] - start, size)
        shift += np.arange(len(codes))
        if (size[own[number]] != size).any() or (codes[np.minimum(shift, len(codes) - 1)] != codes).any():  # two words with one hash
            yield from map(self._by_edges, texts)
            return
        words = [whole[a:b] for a, b in zip(start[own].tolist(), (start + size)[own].tolist())]
        ids = self._ids_of(words)
        flat = np.frombuffer(b"".join(ids), np.uint32)
        n = np.array([len(x) // 4 for x in ids])
        begin = np.cumsum(n) - n
        count = n[number]
        end = np.cumsum(count)
        out = flat[np.repeat(begin[number] - (end - count), count) + np.arange(end[-1])]
        at = 0
        for word in np.searchsorted(start, np.cumsum([len(t.encode()) + 1 for t in texts]) - 1).tolist():  # the line end after each text
            upto = int(end[word - 1])
            yield out[at:upto]
            at = int(end[word]) if word < len(end) else upto

    def _by_edges(self, text: str) -> np.ndarray:
        words = [w.encode() for w in WORD_EDGE.split(text)]
        distinct = [*dict.fromkeys(words)]
        ids = dict(zip(distinct, self._ids_of(distinct)))
        return np.frombuffer(b"".join(map(ids.__getitem__, words)), np.uint32)

    def of(self, texts: list[str]) -> Iterator[np.ndarray]:
        if not self.by_word or not texts:
            yield from (np.array(e.ids, np.uint32) for e in self.encode(texts, add_special_tokens=False))
            return
        single = self._single_spaced(texts).tolist()
        at_once = self._at_once([t for t, s in zip(texts, single) if s]) if any(single) else iter(())
        for text, s in zip(texts, single):
            yield next(at_once) if s else self._by_edges(text)
        if len(self.known) > KEPT_WORDS // 2:
            self.known, self.before = {}, self.known


def word_ids(path: str) -> WordIds:
    """The worker's words, kept from task to task."""
    kept = worker_cache("token-shards")
    if path not in kept:
        kept[path] = WordIds(path)
    return kept[path]


def encoded(texts: Iterable[str | None], words: WordIds, end_id: int) -> Iterator[np.ndarray]:
    """Ids of each text with the end id, in order, a bounded number of characters at a time."""
    end = np.array([end_id], np.uint32)
    held: list[str] = []
    used = 0

    def flush():
        for ids in words.of(held):
            yield np.concatenate((ids, end))

    for text in texts:
        text = text or ""
        if used and used + len(text) > CALL_CHARS:
            yield from flush()
            held, used = [], 0
        if len(text) > CALL_CHARS:
            yield np.concatenate([*(ids for part in _parts(text, CALL_CHARS) for ids in words.of([part])), end])
        else:
            held.append(text)
            used += len(text)
    yield from flush()


def _parts(text: str, most: int) -> Iterator[str]:
    """A long text cut between words; whole where it has no such place."""
    start = 0
    while len(text) - start > most:
        edge = WORD_EDGE.search(text, start + most)
        if edge is None:
            break
        yield text[start : edge.start()]
        start = edge.start()
    yield text[start:]


def _file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


def write_shards(
    docs: DataFrame, path: str, tokenizer_path: str, *, key: str = "doc_id", text: str = "text", end_id: int = END_ID,
    shards: int | None = None,
) -> None:
    """Tokenize ``docs`` into a dataset at ``path`` (a URI that all executors reach)."""
    spark = docs.sparkSession
    source = docs.select(F.col(key).cast("long").alias("k"), F.col(text).cast("string").alias("t"))
    source = source.withColumn("h", F.xxhash64("t"))
    dealt = source.repartitionByRange(shards or shuffle_partitions(spark), "k", "h").sortWithinPartitions("k", "h")

    def run(batches):
        store, folder = _file_system(path)
        store.create_dir(folder, recursive=True)
        shard = TaskContext.get().partitionId()
        name = f"shard-{shard:06d}-{uuid.uuid4().hex}"
        wide = tokenizer(tokenizer_path).get_vocab_size() > 1 << 16 or end_id >= 1 << 16
        kind = np.dtype("<u4" if wide else "<u2")
        keys, missing, sizes = [], [], []
        words = word_ids(tokenizer_path)
        with store.open_output_stream(f"{folder}/{name}.ids", buffer_size=1 << 20) as out:
            for batch in batches:
                keys.append(batch.column(0).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
                missing.append(batch.column(0).is_null().to_numpy(zero_copy_only=False))
                for ids in encoded((t.as_py() for t in batch.column(1)), words, end_id):
                    sizes.append(len(ids))
                    out.write(ids.astype(kind).tobytes())
        if not sizes:
            store.delete_file(f"{folder}/{name}.ids")
            return
        keys, missing = np.concatenate(keys), np.concatenate(missing)
        size = np.array(sizes, np.int64)
        with store.open_output_stream(f"{folder}/{name}.idx") as out:
            out.write(packed(_index(keys, missing, size) | {"width": np.array([kind.itemsize])}))
        given = keys[~missing]
        yield record_batch({
            "shard": ([shard], pa.int32()), "name": ([name], pa.string()), "n_docs": ([len(size)], pa.int64()),
            "n_ids": ([int(size.sum())], pa.int64()),
            "first_key": ([int(given[0]) if len(given) else None], pa.int64()),
            "last_key": ([int(given[-1]) if len(given) else None], pa.int64()),
        })

    dealt.select("k", "t").mapInArrow(
        run, "shard int, name string, n_docs long, n_ids long, first_key long, last_key long"
    ).write.parquet(f"{path}/manifest")


def _index(keys: np.ndarray, missing: np.ndarray, sizes: np.ndarray) -> dict[str, np.ndarray]:
    """Hash, fingerprints and places; ``keys`` sorted, so equal keys are neighbours."""
    offset = np.cumsum(sizes) - sizes
    fresh = ~missing
    fresh[1:] &= (keys[1:] != keys[:-1]) | missing[:-1]
    first = np.flatnonzero(fresh)
    distinct = keys[first].view(np.uint64)
    table = MinimalPerfectHash.of(distinct)
    slots = table.slots(distinct)
    by_slot = np.empty_like(first)
    by_slot[slots] = first
    return table.save() | {
        "fingerprint": fingerprints(keys[by_slot].view(np.uint64)), "offset": offset[by_slot], "document": by_slot,
        "keys": keys, "missing": missing, "lengths": sizes.astype(np.uint32),
    }


class Shard:
    """One shard, opened for keyed access."""

    def __init__(self, path: str, name: str):
        self.store, folder = _file_system(path)
        self.payload = f"{folder}/{name}.ids"
        with self.store.open_input_stream(f"{folder}/{name}.idx") as f:
            index = unpacked(f.read())
        self.hash = MinimalPerfectHash(index["bits"], index["sizes"])
        self.fingerprint, self.offset, self.document = index["fingerprint"], index["offset"], index["document"]
        self.keys, self.missing, self.lengths = index["keys"], index["missing"], index["lengths"].astype(np.int64)
        self.width = int(index["width"][0])
        self.ends = np.cumsum(self.lengths)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first id in the payload, document number) of each key; -1 for keys not held."""
        keys = keys.astype(np.int64).view(np.uint64)
        slots = self.hash.slots(keys)
        held = slots >= 0
        held[held] = self.fingerprint[slots[held]] == fingerprints(keys[held])
        at, document = np.full(len(keys), -1, np.int64), np.full(len(keys), -1, np.int64)
        at[held], document[held] = self.offset[slots[held]], self.document[slots[held]]
        return at, document

    def documents(self) -> Iterator[tuple[int, int, np.ndarray]]:
        """(number, first id, ids) of every document, each found through the index."""
        at, first = self.find(self.keys)
        if (at[~self.missing] < 0).any():
            raise ValueError("the index has lost a key")
        starts = self.ends - self.lengths
        at = np.where(self.missing, starts, at + starts - starts[np.where(self.missing, 0, first)])
        kind = np.dtype(f"<u{self.width}")
        with self.store.open_input_file(self.payload) as f:
            k = 0
            while k < len(at):  # neighbours are read together
                end = k + 1
                while end < len(at) and (at[end] + self.lengths[end] - at[k]) * self.width <= READ_BYTES:
                    end += 1
                n = int(at[end - 1] + self.lengths[end - 1] - at[k])
                ids = np.frombuffer(f.read_at(n * self.width, int(at[k]) * self.width), kind)
                for i in range(k, end):
                    yield i, int(at[i]), ids[at[i] - at[k] : at[i] - at[k] + self.lengths[i]]
                k = end


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """Committed shards with ``base``, the number of ids in all shards before (one row a shard)."""
    found = spark.read.parquet(f"{path}/manifest")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return found.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, read back from the files."""

    def run(frames):
        for frame in frames:
            for row in frame.itertuples():
                shard = Shard(path, row.name)
                number, start, size, crc = [], [], [], []
                for i, at, ids in shard.documents():
                    number.append(i)
                    start.append(row.base + at)
                    size.append(len(ids))
                    crc.append(zlib.crc32(ids.astype("<u4").tobytes()))
                key = pd.array(shard.keys[number], "Int64")
                key[shard.missing[number]] = pd.NA
                yield pd.DataFrame({"doc_id": key, "start": start, "n_tokens": size, "ids_crc32": crc})

    rows = manifest(spark, path).select("shard", "name", "base")
    dealt = rows.repartition(shuffle_partitions(spark), "shard")
    return dealt.mapInPandas(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_keys(spark: SparkSession, path: str, keys: DataFrame, key: str = "doc_id") -> DataFrame:
    """doc_id and ids of the wanted keys: bisection over the shards, then the index.

    The shard list (one row a shard) goes to the driver.  A key that is not
    held gives no row, a repeated key each of its documents once.
    """
    shards = manifest(spark, path).where(F.col("first_key").isNotNull()).orderBy("shard").collect()
    names = [r["name"] for r in shards]
    low = np.array([r["first_key"] for r in shards], np.int64)
    high = np.array([r["last_key"] for r in shards], np.int64)

    @F.pandas_udf("array<int>")
    def holders(k: pd.Series) -> pd.Series:
        a, b = np.searchsorted(high, k, "left"), np.searchsorted(low, k, "right")
        return pd.Series([list(range(x, y)) for x, y in zip(a, b)])

    def run(group: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        shard = Shard(path, names[group[0]])
        wanted = frame["k"].to_numpy(np.int64)
        at, document = shard.find(wanted)
        out = []
        with shard.store.open_input_file(shard.payload) as f:
            for k, start, doc in zip(wanted, at, document):
                while start >= 0 and doc < len(shard.keys) and shard.keys[doc] == k:
                    n = int(shard.lengths[doc])
                    raw = np.frombuffer(f.read_at(n * shard.width, int(start) * shard.width), f"<u{shard.width}")
                    out.append((int(k), raw.tolist()))
                    start, doc = start + n, doc + 1
        return pd.DataFrame(out, columns=["doc_id", "ids"])

    wanted = keys.select(F.col(key).cast("long").alias("k")).where(F.col("k").isNotNull()).distinct()
    return wanted.select("k", F.explode(holders("k")).alias("s")).groupBy("s").applyInPandas(run, "doc_id long, ids array<long>")
