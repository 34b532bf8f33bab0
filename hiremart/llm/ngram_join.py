"""N-gram Jaccard join with a token-group matrix.

Two texts link when the Jaccard similarity of their sets of word shingles
reaches ``share`` (75 %).  The join is exact on 64-bit shingle fingerprints:

1. Texts with equal sets are one node, so copies cost one node.
2. Bound over all: a node can only link if 75 % of its shingles occur in
   other nodes.  Shingles are exchanged as arrays, by hash range, pre-aggregated in
   each task; a node that fails the bound links with nothing.
3. Grouping: nodes that share a min-hash meet in blocks of bounded size (a hot
   min-hash is dealt over many blocks), and the components of their exact links are
   the groups of similar documents.  Blocks of ``ROUNDS`` min-hashes are joined.
4. Token-group matrix: first the bound of 2 again, between groups: the union of a group's
   tokens is exchanged as packed arrays, and sets of which less than 75 % lies in other groups
   are done.  The sets that are left, those of one min-hash together, make
   groups of bounded size; a column holds a group's token union.  Of two linked sets the smaller has 6/7 of its shingles in the larger
   one (7 * common >= 3 * (a + b) >= 6 * a), so a set with so many of its shingles in
   other components is a query.  A third of its shingles, the rarest in the matrix, are
   counted against the columns; a column that can still reach 6/7 gets the query, which
   counts its whole overlap with the union, and only where that is enough the group is
   opened and its members are compared through an inverted index.  No link is lost:
   what a query shares with a member, it shares with the union.  A query yields one
   link for each component it meets, so no group's pairs are spelled out.

The components of all links follow by star contraction.  Groups make near
copies cheap: however many there are, they fill one column of the matrix.

Defined results: null and empty texts, and texts without words, have 0 shingles
and are their own component; a text of fewer than five words is one shingle;
rows are documents, so rows that share a doc_id are compared like any others;
a component's id is its least non-null doc_id (null if it has none).  Other columns
are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hiremart.llm.common import discard, record_batch, salted_left_join, shuffle_partitions, utf8, written
from hiremart.llm.components import components
from hiremart.llm.shingles import min_hashes, shingle_sets
from hiremart.operators.materialize import broadcast_if_small

ROUNDS = 2
CHUNK_BYTES = 12 << 20
CHUNK_ROWS = 60_000
BLOCK_TOKENS = 200_000
QUERIES_PER_BLOCK = 5_000
NOBODY = 0xFFFF
MAX_BROADCAST_NODES = 300_000
ROWS_AT_ONCE = 256
ROW_BYTES = 64  # at most, of a row of numbers


def _set_id(tokens: np.ndarray) -> int:
    """Signed 64-bit identity of a set."""
    return int.from_bytes(hashlib.blake2b(tokens.tobytes(), digest_size=8).digest(), "little", signed=True)


def _sets(column: pa.Array) -> Iterator[np.ndarray]:
    texts = utf8(column)
    for at in range(0, len(texts), ROWS_AT_ONCE):
        yield from shingle_sets(texts[at : at + ROWS_AT_ONCE])


# ---------------------------------------------------------------------------
# 1. one row per document
# ---------------------------------------------------------------------------

def document_sets(docs: DataFrame, key: str, text: str) -> DataFrame:
    """doc_id, h (hash of the text), n, node (0 for an empty set) and min-hashes m0, m1, ..."""
    source = docs.select(F.col(key).cast("long").alias("doc_id"), F.xxhash64(F.col(text)).alias("h"), F.col(text).cast("string").alias("t"))

    def run(batches):
        for batch in batches:
            n, node, least = [], [], [[] for _ in range(ROUNDS)]
            for tokens in _sets(batch.column(2)):
                n.append(len(tokens))
                node.append(_set_id(tokens) if len(tokens) else 0)
                for k, m in enumerate(min_hashes(tokens, ROUNDS)):
                    least[k].append(m)
            yield record_batch({
                "doc_id": (batch.column(0), None), "h": (batch.column(1), None), "n": (n, pa.int64()), "node": (node, pa.int64()),
                **{f"m{k}": (m, pa.int64()) for k, m in enumerate(least)},
            })

    return source.mapInArrow(run, "doc_id long, h long, n long, node long, " + ", ".join(f"m{k} long" for k in range(ROUNDS)))


# ---------------------------------------------------------------------------
# 2. the bound over all nodes
# ---------------------------------------------------------------------------

def _planes(values: np.ndarray) -> bytes:
    """Sorted 32-bit numbers as differences, byte by byte, so that their zeros compress."""
    steps = np.diff(values.astype(np.uint32), prepend=np.uint32(0)).astype("<u4")
    return steps.view(np.uint8).reshape(-1, 4).T.tobytes()


def _from_planes(data: bytes) -> np.ndarray:
    steps = np.frombuffer(data, np.uint8).reshape(4, -1).T.copy().view("<u4").ravel()
    return np.cumsum(steps, dtype=np.uint32)


EXCHANGE = "bucket int, chunk long, hashes binary, owners binary, split binary, names binary, sizes binary"


def _exchange(sets: list[np.ndarray], owner: np.ndarray, names: np.ndarray, least: np.ndarray, split: np.ndarray, chunk: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """Rows of one chunk of sets, each with the number of its owner (a node, or a part of a group).

    ``names`` has two numbers for each owner, ``least`` the size of its smallest set, ``split`` marks owners
    of whose group other parts lie elsewhere.  Shingles go by bucket (a power of two of them); then come the chunk's own counts."""
    sizes = np.array([len(s) for s in sets], np.int64)
    tokens, mine = np.concatenate(sets), np.repeat(owner, sizes)
    order = np.argsort(tokens) if len(sets) == len(names) else np.lexsort((mine, tokens))
    tokens, mine = tokens[order], mine[order]
    if len(sets) > len(names):  # a shingle counts once for each owner
        once = np.concatenate(([True], (tokens[1:] != tokens[:-1]) | (mine[1:] != mine[:-1])))
        tokens, mine = tokens[once], mine[once]
    fresh = np.concatenate(([True], tokens[1:] != tokens[:-1]))
    first = np.flatnonzero(fresh)
    many = np.diff(np.concatenate((first, [len(tokens)]))) > 1  # shared within the chunk: counted here
    count = np.bincount(mine[many[np.cumsum(fresh) - 1]], minlength=len(names))
    owners = np.where(many, NOBODY, mine[first]).astype("<u2")
    tokens = tokens[first]
    bits = buckets.bit_length() - 1  # the first bits are the bucket, the next 32 are sent
    bounds = np.searchsorted(tokens >> np.uint64(64 - bits), np.arange(buckets + 1, dtype=np.uint64))
    rest = (tokens >> np.uint64(32 - bits)).astype(np.uint32)
    rows: dict[str, list] = {k: [] for k in ("bucket", "chunk", "hashes", "owners", "split", "names", "sizes")}

    def add(**row) -> None:
        for k in rows:
            rows[k].append(row.get(k))

    parted = np.stack((np.flatnonzero(split), names[split, 0])).astype("<i8").tobytes() if split.any() else None
    for b in range(buckets):
        low, high = bounds[b], bounds[b + 1]
        if high > low:
            add(bucket=b, chunk=chunk, hashes=_planes(rest[low:high]), owners=owners[low:high].tobytes(), split=parted)
    add(bucket=chunk % buckets, chunk=chunk, names=names.astype("<i8").tobytes(), sizes=np.stack((least, count)).astype("<i8").tobytes())
    types = [pa.int32(), pa.int64()] + [pa.binary()] * 5
    yield record_batch({k: (v, t) for (k, v), t in zip(rows.items(), types)})


def _elsewhere(whole: np.ndarray, plain: pd.DataFrame, owners: list[np.ndarray]) -> np.ndarray:
    """Which shingles of a bucket another owner has too; parts of one group are one owner."""
    order = np.argsort(whole, kind="stable")
    ranked = whole[order]
    shared = np.zeros(len(whole), bool)
    if plain["split"].isna().all():  # a chunk has a shingle once
        same = ranked[1:] == ranked[:-1]
        shared[order[1:][same]] = True
        shared[order[:-1][same]] = True
        return shared
    pairs = [None if x is None else np.frombuffer(x, "<i8").reshape(2, -1) for x in plain["split"]]
    groups = np.unique(np.concatenate([p[1] for p in pairs if p is not None]))
    who = []
    for k, (own, pair) in enumerate(zip(owners, pairs)):
        mine = len(groups) + (k << 16) + np.arange(NOBODY + 1)
        if pair is not None:
            mine[pair[0]] = np.searchsorted(groups, pair[1])
        who.append(mine[own])
    who = np.concatenate(who)[order]
    first = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1])))
    mixed = np.minimum.reduceat(who, first) != np.maximum.reduceat(who, first)
    shared[order] = np.repeat(mixed, np.diff(np.concatenate((first, [len(whole)]))))
    return shared


def _answer(frame: pd.DataFrame) -> pd.DataFrame:
    """Of one bucket: for every chunk, how many of each owner's shingles owners of other chunks have too."""
    plain = frame[frame["hashes"].notna()]
    out = {"chunk": [], "owners": [], "counts": [], "names": [], "sizes": []}
    if len(plain):
        hashes = [_from_planes(x) for x in plain["hashes"]]
        owners = [np.frombuffer(x, "<u2") for x in plain["owners"]]
        shared = _elsewhere(np.concatenate(hashes), plain, owners)
        at = 0
        for chunk, own in zip(plain["chunk"], owners):
            hit = own[shared[at : at + len(own)] & (own != NOBODY)]
            at += len(own)
            if len(hit):
                who, n = np.unique(hit, return_counts=True)
                for k, v in zip(out, (chunk, who.astype("<u2").tobytes(), n.astype("<u4").tobytes(), None, None)):
                    out[k].append(v)
    for row in frame[frame["names"].notna()].itertuples():
        for k, v in zip(out, (row.chunk, None, None, row.names, row.sizes)):
            out[k].append(v)
    return pd.DataFrame(out)


def _passing(frame: pd.DataFrame) -> pd.DataFrame:
    """Of one chunk: the owners with 75 % of their least set's shingles in others, and how many they have there."""
    own = frame[frame["names"].notna()].iloc[0]
    names = np.frombuffer(own["names"], "<i8").reshape(-1, 2)
    sizes, count = np.frombuffer(own["sizes"], "<i8").reshape(2, -1)
    count = count.copy()
    for who, n in zip(frame["owners"], frame["counts"]):
        if who is not None:
            count[np.frombuffer(who, "<u2")] += np.frombuffer(n, "<u4")
    good = count * 4 >= sizes * 3
    return pd.DataFrame({"name": names[good, 0], "part": names[good, 1], "seen": count[good]})


def _bounded(sent: DataFrame) -> DataFrame:
    """name, part and seen of the owners that may link."""
    answers = sent.groupBy("bucket").applyInPandas(_answer, "chunk long, owners binary, counts binary, names binary, sizes binary")
    return answers.groupBy("chunk").applyInPandas(_passing, "name long, part long, seen long")


def _buckets(spark) -> int:
    return 1 << min(24, (4 * shuffle_partitions(spark)).bit_length())


def bounded_nodes(docs: DataFrame, text: str) -> DataFrame:
    """Nodes that may link (a node of several chunks may come more than once)."""
    buckets = _buckets(docs.sparkSession)

    def flush(held: dict[int, np.ndarray], chunk: int):
        sets = list(held.values())
        names = np.array([list(held), [0] * len(held)], np.int64).T
        return _exchange(sets, np.arange(len(sets)), names, np.array([len(s) for s in sets]), np.zeros(len(sets), bool), chunk, buckets)

    def run(batches):
        part, number = TaskContext.get().partitionId(), 0
        held: dict[int, np.ndarray] = {}
        size = 0
        for batch in batches:
            for tokens in _sets(batch.column(0)):
                if not len(tokens):
                    continue
                node = _set_id(tokens)
                if node in held:
                    continue
                held[node] = tokens
                size += tokens.nbytes
                if size >= CHUNK_BYTES or len(held) >= CHUNK_ROWS:
                    yield from flush(held, part << 24 | number)
                    held, size, number = {}, 0, number + 1
        if held:
            yield from flush(held, part << 24 | number)

    sent = docs.select(F.col(text).cast("string").alias("t")).mapInArrow(run, EXCHANGE)
    return _bounded(sent).select(F.col("name").alias("node"))


def bounded_members(sets: DataFrame, groups: DataFrame, nodes: int, tokens: int) -> DataFrame:
    """node, g, m0, n and tokens of the sets whose group shares so much with others that they may link there.

    Groups are exchanged as nodes were: the union of a group's tokens in a chunk, or of one of the
    parts that a large group is dealt over.  A set that shares 75 % of its tokens with
    other groups is in a part whose union does, so no set that could link is lost."""
    buckets = _buckets(sets.sparkSession)
    slim = sets.select("node", "n").join(groups.withColumnRenamed("comp", "g"), "node", "left").withColumn("g", F.coalesce("g", "node"))
    slim = written(slim, "ngram-grouped", ROW_BYTES * nodes)
    sums = slim.groupBy("g").agg(F.ceil(F.sum("n") / BLOCK_TOKENS).cast("int").alias("parts")).where("parts > 1")
    placed = salted_left_join(slim, sums, ["g"], F.col("node"))
    split = F.coalesce(F.col("parts"), F.lit(1)) > 1
    part = F.when(split, F.pmod(F.xxhash64("node"), F.col("parts"))).otherwise(F.lit(0)).cast("long")
    placed = written(placed.select("node", "n", "g", part.alias("part"), split.alias("split")), "ngram-placed", ROW_BYTES * nodes)
    dealt = sets.select("node", "tokens").join(placed.select("node", "g", "part", "split"), "node")
    dealt = dealt.select("g", "part", "split", "tokens").repartition("g", "part").sortWithinPartitions("g", "part")

    def run(batches):
        task, number = TaskContext.get().partitionId(), 0
        held: list[np.ndarray] = []
        owner, names, least, parted = [], [], [], []
        size = 0
        for batch in batches:
            for g, part, split, tokens in zip(*(c.to_pylist() for c in batch.columns)):
                if not names or names[-1] != (g, part):
                    if size >= CHUNK_BYTES or len(names) >= CHUNK_ROWS:  # never within a part
                        yield from _exchange(held, np.array(owner), np.array(names, np.int64), np.array(least), np.array(parted), task << 24 | number, buckets)
                        held, owner, names, least, parted, size, number = [], [], [], [], [], 0, number + 1
                    names.append((g, part))
                    least.append(len(tokens) // 8)
                    parted.append(split)
                held.append(np.frombuffer(tokens, "<u8"))
                owner.append(len(names) - 1)
                least[-1] = min(least[-1], len(tokens) // 8)
                size += len(tokens)
        if held:
            yield from _exchange(held, np.array(owner), np.array(names, np.int64), np.array(least), np.array(parted), task << 24 | number, buckets)

    passing = _bounded(dealt.mapInArrow(run, EXCHANGE)).withColumnRenamed("name", "g")
    chosen = placed.join(passing, ["g", "part"]).where("seen * 4 >= n * 3").select("node", "g")
    found = written(sets.select("node", "n", "m0", "tokens").join(chosen, "node").select("node", "g", "n", "m0", "tokens"), "ngram-bounded", ROW_BYTES * nodes + 8 * tokens)
    discard(slim, placed)
    return found


# ---------------------------------------------------------------------------
# 3. groups of similar documents
# ---------------------------------------------------------------------------

def block_links(sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links that span the components of a block's exact similarity graph.

    The token-group matrix in small: groups are the components so far, and
    only members with 75 % of their tokens in other groups are compared."""
    n = np.array([len(s) for s in sets], np.int64)
    m = len(sets)
    number = np.unique(np.concatenate(sets), return_inverse=True)[1]
    end = np.cumsum(n)
    owner = np.repeat(np.arange(m), n)
    order = np.argsort(number, kind="stable")
    posting = owner[order]
    bounds = np.searchsorted(number[order], np.arange(number.max() + 2))
    group = np.arange(m)
    compared = np.zeros(m, bool)
    links: list[tuple[int, int]] = []
    wave = 1
    while True:
        of = group[posting]
        mixed = np.minimum.reduceat(of, bounds[:-1]) != np.maximum.reduceat(of, bounds[:-1])
        elsewhere = np.bincount(owner, mixed[number], m)
        active = np.flatnonzero(~compared & (elsewhere * 4 >= n * 3))
        if not len(active):
            return links
        ranked = active[np.argsort(group[active], kind="stable")]
        start = np.concatenate(([True], group[ranked][1:] != group[ranked][:-1]))
        place = np.arange(len(ranked)) - np.maximum.accumulate(np.where(start, np.arange(len(ranked)), 0))
        for q in ranked[place < wave].tolist():  # some of every group, twice as many each time
            own = number[end[q] - n[q] : end[q]]
            overlap = np.bincount(np.concatenate([posting[bounds[t] : bounds[t + 1]] for t in own[mixed[own]].tolist()]), minlength=m)
            near = np.flatnonzero((overlap * 7 >= (n[q] + n) * 3) & (group != group[q]))
            for other in near.tolist():
                if group[other] != group[q]:
                    links.append((q, other))
                    group[group == group[other]] = group[q]
            compared[q] = True
        wave *= 2


def _block(frame: pd.DataFrame) -> pd.DataFrame:
    out: list[tuple[int, int]] = []
    for _, part in frame.groupby(["m", "part"], sort=False):
        if len(part) > 1:
            nodes = part["node"].to_numpy()
            out += [(nodes[a], nodes[b]) for a, b in block_links([np.frombuffer(t, "<u8") for t in part["tokens"]])]
    return pd.DataFrame(out, columns=["a", "b"], dtype="int64")


def _round_links(sets: DataFrame, k: int) -> DataFrame:
    """Links found among the nodes of each min-hash ``k``; large ones are dealt over blocks of bounded size."""
    slim = sets.select("node", "n", F.col(f"m{k}").alias("m"))
    sums = slim.groupBy("m").agg(F.count(F.lit(1)).alias("c"), F.ceil(F.sum("n") / BLOCK_TOKENS).cast("int").alias("parts"))
    spread = salted_left_join(slim, sums, ["m"], F.col("node")).where("c > 1")
    placed = spread.select("node", "m", F.pmod(F.xxhash64("node", F.lit(k)), F.col("parts")).alias("part"))
    total = sets.agg(F.sum("n")).first()[0] or 0
    buckets = max(2 * shuffle_partitions(sets.sparkSession), -(-int(total) // BLOCK_TOKENS))
    dealt = placed.join(sets.select("node", "tokens"), "node").withColumn("bucket", F.pmod(F.xxhash64("m", "part"), F.lit(buckets)))
    return dealt.groupBy("bucket").applyInPandas(_block, "a long, b long")


# ---------------------------------------------------------------------------
# 4. the token-group matrix
# ---------------------------------------------------------------------------

def _matrix_links(sets: DataFrame, groups: DataFrame, nodes: int, tokens: int) -> DataFrame:
    """Links between different groups: every one that there is (``nodes`` and ``tokens``: how many ``sets`` holds)."""
    bounded = bounded_members(sets, groups, nodes, tokens)
    owned = bounded.select("node", "g", "n", "tokens")

    def unions(batches):
        for batch in batches:
            sizes = [len(t) // 8 for t in batch.column(1).to_pylist()]
            if sum(sizes):
                t = np.frombuffer(b"".join(batch.column(1).to_pylist()), "<i8")
                group = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), sizes)
                order = np.lexsort((group, t))
                t, group = t[order], group[order]
                first = np.flatnonzero(np.concatenate(([True], t[1:] != t[:-1])))
                last = np.concatenate((first[1:], [len(t)])) - 1
                yield record_batch({"t": (pa.array(t[first]), None), "low": (pa.array(group[first]), None), "high": (pa.array(group[last]), None)})

    def exploded(batches):
        for batch in batches:
            nodes = batch.column(0).to_numpy(zero_copy_only=False)
            sizes = [len(t) // 8 for t in batch.column(3).to_pylist()]
            tokens = [np.frombuffer(t, "<i8") for t in batch.column(3).to_pylist()]
            if tokens:
                group = np.repeat(batch.column(1).to_numpy(zero_copy_only=False), sizes)
                yield record_batch({
                    "node": (pa.array(np.repeat(nodes, sizes)), None), "g": (pa.array(group), None),
                    "n": (pa.array(np.repeat(sizes, sizes).astype(np.int64)), None), "t": (pa.array(np.concatenate(tokens)), None),
                })

    union = owned.select("g", "tokens").mapInArrow(unions, "t long, low long, high long")
    wide = union.groupBy("t").agg(F.min("low").alias("low"), F.max("high").alias("high")).where("low < high").select("t")
    cells = owned.mapInArrow(exploded, "node long, g long, n long, t long")
    elsewhere = cells.join(wide, "t", "left_semi")
    # 75 % for a set to be linked at all, 6/7 for the smaller one of two
    seen = elsewhere.groupBy("node", "n").agg(F.count(F.lit(1)).alias("seen")).where("seen * 4 >= n * 3").select("node", "seen")
    most_cells = int(bounded.agg(F.sum("n")).first()[0] or 0)
    shared = written(elsewhere.join(seen, "node"), "ngram-shared", ROW_BYTES * most_cells)
    members = bounded.join(seen, "node", "left_semi")
    most_cells = int(members.agg(F.sum("n")).first()[0] or 0)
    blocks = max(1, -(-most_cells // BLOCK_TOKENS))
    # sets of one min-hash lie together; those of a hot one are dealt over several groups
    sums = members.groupBy("m0").agg(F.ceil(F.sum("n") / BLOCK_TOKENS).cast("int").alias("parts"))
    placed = salted_left_join(members.select("node", "m0"), sums, ["m0"], F.col("node"))
    block = F.pmod(F.xxhash64("m0", F.pmod(F.xxhash64("node"), F.col("parts"))), F.lit(blocks)).cast("int")
    members = written(members.join(placed.select("node", block.alias("block")), "node").select("block", "node", "g", "tokens"), "ngram-members", ROW_BYTES * nodes + 8 * most_cells)
    matrix = written(shared.select("node", "t").join(members.select("node", "block"), "node").select("t", "block").distinct(), "ngram-matrix", ROW_BYTES * most_cells)
    need = F.ceil(F.col("n") * 6 / 7)
    queries = shared.where(F.col("seen") >= need)
    width = matrix.groupBy("t").agg(F.count(F.lit(1)).alias("width"))
    ranked = queries.join(width, "t").withColumn("rank", F.row_number().over(Window.partitionBy("node").orderBy("width", "t")))
    # an overlap of ``need`` leaves at least ``k`` among any seen - need + k shingles
    k = F.ceil(F.col("n") / 3)
    rarest = ranked.where(F.col("rank") <= F.col("seen") - need + k).select("node", "n", "t")
    hits = rarest.join(matrix, "t").groupBy("node", "n", "block").agg(F.count(F.lit(1)).alias("hits")).where(F.col("hits") >= k)
    opened = written(hits.select("node", "block"), "ngram-opened")
    most = opened.groupBy("block").agg(F.count(F.lit(1)).alias("c")).agg(F.max("c")).first()[0] or 0
    shares = max(1, -(-most // QUERIES_PER_BLOCK))
    asked = opened.join(owned.select("node", "g", "tokens"), "node").withColumn("share", F.pmod(F.xxhash64("node"), F.lit(shares)).cast("int"))
    held = members.withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))))
    links = asked.groupBy("block", "share").cogroup(held.groupBy("block", "share")).applyInPandas(_open, "a long, b long")
    links = written(links, "ngram-matrix-links")
    discard(bounded, shared, members, matrix, opened)
    return links


def _open(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
    """Links of the queries into one group: one for each component they meet."""
    links: list[tuple[int, int]] = []
    if len(asked) and len(held):
        sets = [np.frombuffer(t, "<u8") for t in held["tokens"]]
        n = np.array([len(x) for x in sets])
        union, number = np.unique(np.concatenate(sets), return_inverse=True)
        order = np.argsort(number, kind="stable")
        posting = np.repeat(np.arange(len(sets)), n)[order]
        bounds = np.searchsorted(number[order], np.arange(len(union) + 1))
        nodes, groups = held["node"].to_numpy(), held["g"].to_numpy()
        for node, g, raw in zip(asked["node"], asked["g"], asked["tokens"]):
            tokens = np.frombuffer(raw, "<u8")
            at = np.minimum(np.searchsorted(union, tokens), len(union) - 1)
            at = at[union[at] == tokens]
            if 7 * len(at) < 6 * len(tokens):  # the overlap with the union
                continue
            common = np.bincount(np.concatenate([posting[bounds[t] : bounds[t + 1]] for t in at.tolist()]), minlength=len(sets))
            near = np.flatnonzero((7 * common >= 3 * (len(tokens) + n)) & (groups != g))
            links += [(node, nodes[near[i]]) for i in np.unique(groups[near], return_index=True)[1].tolist()]
    return pd.DataFrame(links, columns=["a", "b"], dtype="int64")


def linked_nodes(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents with their node, nodes, node and comp of every node that has a link)."""
    found = written(document_sets(docs, key, text), "ngram-documents")
    passing = bounded_nodes(docs, text).distinct()
    first = found.where("n > 0").groupBy("node").agg(
        F.min(F.struct("doc_id", "h")).alias("r"), F.min("doc_id").alias("own"), F.count(F.lit(1)).alias("copies"), F.first("n").alias("n"),
        *[F.first(f"m{k}").alias(f"m{k}") for k in range(ROUNDS)],
    )
    wanted = first.join(passing, "node").select(F.col("r.doc_id").alias("doc_id"), F.col("r.h").alias("h"), "node", "n", *[f"m{k}" for k in range(ROUNDS)])
    source = docs.select(F.col(key).cast("long").alias("k"), F.xxhash64(F.col(text)).alias("kh"), F.col(text).cast("string").alias("t"))
    wanted = written(wanted, "ngram-wanted", ROW_BYTES * found.count())
    nodes, shingles = wanted.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    texts = source.join(broadcast_if_small(wanted, max_rows=MAX_BROADCAST_NODES), F.col("k").eqNullSafe(F.col("doc_id")) & (F.col("kh") == F.col("h")))

    def tokens(batches):
        for batch in batches:
            sets = list(_sets(batch.column(0)))
            yield record_batch({
                "node": (batch.column(1), None), "n": ([len(s) for s in sets], pa.int64()),
                **{f"m{k}": (batch.column(2 + k), None) for k in range(ROUNDS)},
                "tokens": ([s.astype("<u8").tobytes() for s in sets], pa.binary()),
            })

    schema = "node long, n long, " + ", ".join(f"m{k} long" for k in range(ROUNDS)) + ", tokens binary"
    sets = texts.select("t", "node", *[f"m{k}" for k in range(ROUNDS)]).mapInArrow(tokens, schema).dropDuplicates(["node"])
    sets = written(sets, "ngram-sets", ROW_BYTES * nodes + 8 * shingles)
    links = None
    for k in range(ROUNDS):
        more = _round_links(sets, k)
        links = more if links is None else links.unionByName(more)
    links = written(links, "ngram-links", ROUNDS * ROW_BYTES * nodes, spread=True)
    groups = components(links, "a", "b")
    more = _matrix_links(sets, groups, nodes, shingles)
    whole = components(links.unionByName(more), "a", "b")
    discard(wanted, sets, links, more)
    return found, first, whole


def jaccard_components(docs: DataFrame, **names) -> DataFrame:
    """doc_id, n_shingles and component_id of every document."""
    found, first, whole = linked_nodes(docs, **names)
    members = first.select("node", "own", "copies")
    least = members.join(whole, "node").groupBy("comp").agg(F.min("own").alias("least"))
    linked = salted_left_join(whole, least, ["comp"], F.col("node")).select("node", "least")
    named = members.join(linked.withColumn("linked", F.lit(True)), "node", "left").where("copies > 1 or linked")
    named = named.select("node", F.when(F.col("linked"), F.col("least")).otherwise(F.col("own")).alias("component_id"), F.lit(True).alias("named"))
    out = salted_left_join(found.select("doc_id", "n", "node"), named, ["node"], F.col("doc_id"))
    return out.select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when((F.col("n") > 0) & F.col("named"), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def one_of_each_component(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, whole: of each component the one with the least id (then text hash), and all without shingles."""
    found, first, whole = linked_nodes(docs, key=key, text=text)
    comp = F.coalesce("comp", "node")
    kept = first.select("node", "r").join(whole, "node", "left").groupBy(comp.alias("c")).agg(F.min("r").alias("r"))
    empty = found.where("n = 0").select("doc_id", "h", F.lit(True).alias("empty")).distinct()
    kept = kept.select("r.doc_id", "r.h", F.lit(False).alias("empty")).unionByName(empty)
    rows = docs.select(F.struct("*").alias("row"), F.col(key).cast("long").alias("k"), F.xxhash64(F.col(text)).alias("kh"))
    held = rows.join(kept, F.col("k").eqNullSafe(F.col("doc_id")) & (F.col("kh") == F.col("h")))
    once = held.where("not empty").dropDuplicates(["k", "kh"])
    return once.select("row.*").unionByName(held.where("empty").select("row.*"))
