"""Nearest neighbours by inner product over balanced posting lists.

Index.  Centroids come from k-means with a size penalty on a bounded sample
(``MAX_SAMPLE`` rows by a hash of the id); every row is indexed.  A vector
near a border is replicated: it goes to every list whose centroid is within
``COPY_RATIO`` of its nearest one, ``MAX_COPIES`` at most.  Large lists are dealt
over several blocks, small ones share a block, so that no task gets a list
as long as a hot vector makes it.

Search.  Centroids form a neighbour graph in memory.  A query walks it from
fixed entries and spreads over all centroids within ``OPEN_RATIO`` of the
best one found: distance-ratio pruning.  An easy query opens a list or
two, one far from everything opens many; there is no cap on lists.  A query
opens at least as many lists as hold k rows besides itself, so with fewer rows it
gets them all.  Opened lists are scored exactly, in double precision.

Inner product is turned into distance by one more coordinate,
sqrt(M^2 - |x|^2), with M the largest norm; queries have 0 there.

Scale: one pass to assign, one shuffle of the replicated vectors, one row for
each query and block; a block gives k rows a query at most.

Defined results: vectors that are null, zero, of another length than most, or
that hold nulls or non-finite numbers take no part, as query or candidate; so do
rows without an id; equal rows count once; ties go to the smaller id; an empty
table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hiremart.llm.common import record_batch, written

MAX_SAMPLE = 20_000
MAX_CENTROIDS = 1024
LIST_ROWS = 128
MAX_COPIES = 4
COPY_RATIO = 1.08
OPEN_RATIO = 1.13
NEIGHBOURS = 24
ENTRIES = 16
BEAM = 4
BLOCK_ROWS = 20_000
QUERIES_AT_ONCE = 128
QUERIES_PER_GROUP = 5_000


def balanced_centroids(x: np.ndarray, k: int, rounds: int = 15, weight: float = 0.15, seed: int = 5) -> np.ndarray:
    """k-means whose distances carry a penalty for clusters above the mean size."""
    rng = np.random.default_rng(seed)
    centre = x[rng.choice(len(x), k, replace=False)].copy()
    load = np.ones(k)
    scale = x.var(0).sum()
    for _ in range(rounds):
        cost = (centre**2).sum(1) - 2 * x @ centre.T + weight * scale * np.maximum(0, load - 1)
        own = cost.argmin(1)
        size = np.bincount(own, minlength=k)
        load = 0.5 * load + 0.5 * size * k / len(x)
        total = np.zeros_like(centre)
        np.add.at(total, own, x)
        some = size > 0
        centre[some] = total[some] / size[some, None]
        if (~some).any():
            centre[~some] = x[rng.choice(len(x), int((~some).sum()))]
    return centre


class CentroidGraph:
    """Neighbour graph over the centroids; ``near(x, ratio)`` walks it."""

    def __init__(self, centre: np.ndarray, neighbours: int = NEIGHBOURS, entries: int = ENTRIES):
        self.centre = centre
        self.square = (centre**2).sum(1)
        k = len(centre)
        distance = self.square[:, None] + self.square - 2 * centre @ centre.T
        self.links = np.argsort(distance, 1, kind="stable")[:, 1 : neighbours + 1]
        self.entries = np.unique(np.linspace(0, k - 1, min(k, entries)).astype(int))

    def near(self, x: np.ndarray, ratio: float, least: np.ndarray | None = None, wanted: float = 0) -> tuple[np.ndarray, np.ndarray]:
        """(centroids, squared distances), nearest first, within ``ratio`` of the nearest distance;
        with ``least``, as many more as it takes until these sum to ``wanted``."""
        norm = x @ x
        distance = np.full(len(self.centre), np.inf)
        spread = np.zeros(len(self.centre), bool)
        front = self.entries
        while len(front):
            distance[front] = np.maximum(0, norm + self.square[front] - 2 * self.centre[front] @ x)
            met = np.flatnonzero(np.isfinite(distance) & ~spread)
            radius = distance.min() * ratio**2
            closest = met[np.argsort(distance[met], kind="stable")[:BEAM]]  # on towards the nearest, and all within the ratio
            closest = closest[distance[closest] <= np.sort(distance)[: 2 * BEAM].max()]
            go = np.union1d(closest, met[distance[met] <= radius])
            spread[go] = True
            reached = np.unique(self.links[go]) if len(go) else go
            front = reached[np.isinf(distance[reached])]
        order = np.argsort(distance, kind="stable")
        n = int((distance <= distance.min() * ratio**2).sum())
        if least is not None and least[order[:n]].sum() < wanted:
            if np.isinf(distance).any():  # not all were met: the rest exactly
                distance = np.maximum(0, norm + self.square - 2 * self.centre @ x)
                order = np.argsort(distance, kind="stable")
            n = int(min(len(order), np.searchsorted(np.cumsum(least[order]), wanted) + 1))
        return order[:n], distance[order[:n]]

    def homes(self, x: np.ndarray) -> list[int]:
        """Lists that hold ``x``: the nearest, and those hardly farther."""
        return self.near(x, COPY_RATIO)[0][:MAX_COPIES].tolist()


def usable(table: DataFrame, key: str, vector: str) -> DataFrame:
    """vec_id and vector (doubles as bytes) of the rows that take part, each once."""
    v = F.col(vector).cast("array<double>")
    infinity = F.lit(float("inf"))
    fine = F.forall(v, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < infinity)) & F.exists(v, lambda e: e != 0)
    source = table.select(F.col(key).cast("long").alias("vec_id"), v.alias("v")).where(F.col("vec_id").isNotNull() & fine)
    common = source.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    if not common:
        return source.limit(0).select("vec_id", F.lit(None).cast("binary").alias("x"))

    def run(batches):
        for batch in batches:
            yield record_batch({"vec_id": (batch.column(0), None), "x": ([np.array(r, "<f8").tobytes() for r in batch.column(1).to_pylist()], pa.binary())})

    return source.where(F.size("v") == common[0]["n"]).mapInArrow(run, "vec_id long, x binary").dropDuplicates()


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), "<f8").reshape(len(column), -1)


def nearest(
    table: DataFrame, *, key: str = "vec_id", vector: str = "embedding", k: int = 20, every: int = 20,
    open_ratio: float = OPEN_RATIO,
) -> DataFrame:
    """query_id, rank, vec_id and score: the k nearest rows found for each row whose id ``every`` divides."""
    spark = table.sparkSession
    rows = written(usable(table, key, vector), "vectors")
    schema = "query_id long, rank int, vec_id long, score double"
    n = rows.count()
    if not n:
        return spark.createDataFrame([], schema)

    def norms(batches):
        for batch in batches:
            if batch.num_rows:
                yield record_batch({"m": ([float((_matrix(batch.column(0).to_pylist()) ** 2).sum(1).max())], pa.float64())})

    largest = rows.select("x").mapInArrow(norms, "m double").agg(F.max("m")).first()[0]
    share = min(1.0, MAX_SAMPLE / n)
    drawn = rows.where(F.pmod(F.xxhash64("vec_id", "x"), F.lit(1_000_003)) <= int(share * 1_000_003)).limit(2 * MAX_SAMPLE)
    sample = _matrix([r["x"] for r in drawn.select("x").collect()])  # bounded: 2 * MAX_SAMPLE vectors

    def lifted(x: np.ndarray) -> np.ndarray:
        return np.concatenate((x, np.sqrt(np.maximum(0, largest - (x**2).sum(1)))[:, None]), 1)

    lists = int(min(MAX_CENTROIDS, max(1, n // LIST_ROWS), len(sample)))
    graph = spark.sparkContext.broadcast(CentroidGraph(balanced_centroids(lifted(sample), lists)))

    def assign(batches):
        for batch in batches:
            if batch.num_rows:
                homes = [graph.value.homes(x) for x in lifted(_matrix(batch.column(1).to_pylist()))]
                yield record_batch({"vec_id": (batch.column(0), None), "x": (batch.column(1), None), "homes": (homes, pa.list_(pa.int32()))})

    homes = rows.mapInArrow(assign, "vec_id long, x binary, homes array<int>")
    postings = written(homes.select("vec_id", "x", F.explode("homes").alias("list")), "postings")
    size = np.zeros(lists, np.int64)
    for r in postings.groupBy("list").count().collect():  # a number for each list
        size[r["list"]] = r["count"]
    # blocks: a large list has several, small ones share one
    parts = np.maximum(1, -(-size // BLOCK_ROWS))
    first = np.zeros(lists, np.int64)
    block, filled = 0, 0
    for c in range(lists):
        if parts[c] > 1 or filled + size[c] > BLOCK_ROWS:
            block, filled = block + (filled > 0), 0
        first[c] = block
        filled += int(size[c])
        if parts[c] > 1:
            block, filled = block + int(parts[c]), 0
    queries_in_all = rows.where(F.col("vec_id") % every == 0).count()
    shares = max(1, -(-queries_in_all // QUERIES_PER_GROUP))
    plan = spark.sparkContext.broadcast((size, parts, first))

    @F.pandas_udf("long")
    def block_of(c: pd.Series, h: pd.Series) -> pd.Series:
        _, parts, first = plan.value
        return pd.Series(first[c] + h.to_numpy() % parts[c])

    def opened(batches):
        size, parts, first = plan.value
        for batch in batches:
            out: list[tuple] = []
            for q, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                x = np.append(np.frombuffer(raw, "<f8"), 0.0)
                found, _ = graph.value.near(x, open_ratio, size, (k + 1) * MAX_COPIES)
                wanted: dict[int, list[int]] = {}
                for c in found.tolist():
                    for b in range(int(first[c]), int(first[c] + parts[c])):
                        wanted.setdefault(b, []).append(c)
                out += [(b, q, raw, cs) for b, cs in wanted.items()]
            yield _opened_rows(out)

    queries = rows.where(F.col("vec_id") % every == 0).mapInArrow(opened, "block long, query_id long, x binary, lists array<int>")
    queries = queries.withColumn("share", F.pmod(F.xxhash64("query_id"), F.lit(shares)).cast("int"))
    held = postings.withColumn("block", block_of("list", F.pmod(F.xxhash64("vec_id"), F.lit(1 << 30))))
    held = held.withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))))

    def score(asked: pd.DataFrame, kept: pd.DataFrame) -> pd.DataFrame:
        if not len(asked) or not len(kept):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        ids, lists_, x = kept["vec_id"].to_numpy(), kept["list"].to_numpy(), _matrix(kept["x"])
        out = []
        for at in range(0, len(asked), QUERIES_AT_ONCE):
            part = asked.iloc[at : at + QUERIES_AT_ONCE]
            q = _matrix(part["x"])
            rough = q @ x.T
            for i, (query, open_) in enumerate(zip(part["query_id"], part["lists"])):
                could = np.flatnonzero(np.isin(lists_, open_) & (ids != query))
                if len(could) > MAX_COPIES * k:
                    near = rough[i, could]
                    bar = np.partition(near, -MAX_COPIES * k)[-MAX_COPIES * k]
                    could = could[near >= bar - 1e-9 * max(1.0, abs(bar))]
                exact = (x[could] * q[i]).sum(1)  # the same sum wherever a vector lies
                order = np.lexsort((ids[could], -exact))
                fresh: dict[tuple, None] = dict.fromkeys(zip(ids[could][order].tolist(), exact[order].tolist()))
                out += [(query, v, s) for v, s in list(fresh)[:k]]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    groups = [held.groupBy("block", "share"), queries.groupBy("block", "share")]
    found = groups[1].cogroup(groups[0]).applyInPandas(score, "query_id long, vec_id long, score double").distinct()
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _opened_rows(rows: list[tuple]) -> pa.RecordBatch:
    block, query, x, lists = zip(*rows) if rows else ((), (), (), ())
    return record_batch({
        "block": (list(block), pa.int64()), "query_id": (list(query), pa.int64()), "x": (list(x), pa.binary()),
        "lists": (list(lists), pa.list_(pa.int32())),
    })
