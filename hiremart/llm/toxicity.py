"""Toxicity scores by non-negative positive-unlabelled learning.

Confirmed toxic documents are the positives; all texts that may be learned from
are the unlabelled ones.  A logistic model (numpy) is trained on the
class-prior-corrected risk  pi * E_p[l(f)] + max(0, E_u[l(-f)] - pi * E_p[l(-f)]),
whose second part is kept from going negative.

Features are the words of a text and the beginnings of its words, hashed into
``BINS`` and counted as present or absent.  Document frequencies are counted
over all learnable documents, those of the positive class over all positives;
bins that positives have significantly more often than unlabelled text,
``MAX_FEATURES`` at most, become the features.
The weights are fitted on a bounded sample: ``MAX_POSITIVES`` confirmed and
``MAX_UNLABELLED`` unlabelled documents, taken by a hash of doc_id.

The class prior pi is that of the unlabelled texts, which those who chose what to label need not have met:
wherever a feature has share p among the positives and u among all texts, pi * p <= u, so pi is
the least u / p over features that many positives have (``estimated_prior``), or the share of toxic texts
among the labels if that is less.  It is kept between ``LEAST_PRIOR`` and ``MOST_PRIOR``.

Scale: three passes that only map the texts.  A task sends one vector of
counts for each class, the driver sees ``BINS`` sums, the model broadcast has
``MAX_FEATURES`` weights, and the ids of all positives are broadcast only within
the measured limits of ``broadcast_if_small``; above them they join by shuffle.

Defined results: null and empty texts, and texts without known features, get the score of
the bias, which is at most the prior; null labels and labels of unknown documents teach nothing; a
document with several labels is positive if one of them is; repeated rows get
equal scores.  Without positives the score is 0 for all.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hiremart.llm.common import record_batch, worker_cache, written
from hiremart.operators.materialize import broadcast_if_small

BINS = 1 << 18
MAX_FEATURES = 4096
MAX_POSITIVES = 8_000
MAX_UNLABELLED = 24_000
THRESHOLD = 0.7
LEAST_PRIOR, MOST_PRIOR = 1e-4, 0.99
PRIOR_SHARE = 0.1
BEGINNINGS = (3, 4, 5)
KEPT_WORDS = 300_000
BLOCKS = 64

WORD = re.compile(r"[^\W\d_]+")


class WordBins:
    """Hash bins of a word: itself and its beginnings; bounded memory of words met."""

    def __init__(self):
        self.known: dict[str, tuple[int, ...]] = {}

    def of(self, text: str | None) -> np.ndarray:
        """Distinct bins of a text."""
        known = self.known
        if len(known) > KEPT_WORDS:
            known.clear()
        bins: set[int] = set()
        for word in set(WORD.findall(text.lower())) if text else ():
            found = known.get(word)
            if found is None:
                code = [f"={word}", *(f"{k}{word[:k]}" for k in BEGINNINGS if len(word) > k)]
                found = known[word] = tuple({zlib.crc32(c.encode()) % BINS for c in code})
            bins.update(found)
        return np.fromiter(bins, np.int64, len(bins))


def learnable(key: str = "doc_id"):
    """Rows that labels may be learned from; the others are held out."""
    return F.crc32(F.col(key).cast("string")) % 3 != 1


def _counts(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Documents with each bin, and documents: of all texts (0) and of the positives (1)."""

    def count(batches) -> Iterator[pa.RecordBatch]:
        worker_cache("toxicity")
        bins = WordBins()
        seen, rows = np.zeros((2, BINS), np.int64), np.zeros(2, np.int64)
        for batch in batches:
            for text, positive in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = bins.of(text)
                for kind in (0, 1) if positive else (0,):
                    seen[kind][found] += 1
                    rows[kind] += 1
        for kind in (0, 1):
            full = np.flatnonzero(seen[kind])
            for part in range(BLOCKS):
                inside = full[full * BLOCKS // BINS == part]
                yield record_batch({
                    "kind": ([kind], pa.int32()), "part": ([part], pa.int32()), "rows": ([int(rows[kind]) if part == 0 else 0], pa.int64()),
                    "bins": ([inside.astype("<u4").tobytes()], pa.binary()), "counts": ([seen[kind][inside].astype("<u4").tobytes()], pa.binary()),
                })

    def add(frame):
        import pandas as pd

        total = np.zeros(BINS, np.int64)
        for bins, counts in zip(frame["bins"], frame["counts"]):
            total[np.frombuffer(bins, "<u4")] += np.frombuffer(counts, "<u4")
        full = np.flatnonzero(total)
        return pd.DataFrame({
            "kind": frame["kind"].iloc[:1].to_list(), "rows": [int(frame["rows"].sum())],
            "bins": [full.astype("<u4").tobytes()], "counts": [total[full].astype("<u8").tobytes()],
        })

    sent = texts.select("text", "positive").mapInArrow(count, "kind int, part int, rows long, bins binary, counts binary")
    total, rows = np.zeros((2, BINS), np.int64), np.zeros(2, np.int64)
    # at most 2 * BLOCKS rows with BINS counts of each class in all
    for r in sent.groupBy("kind", "part").applyInPandas(add, "kind int, rows long, bins binary, counts binary").collect():
        total[r["kind"]][np.frombuffer(r["bins"], "<u4")] += np.frombuffer(r["counts"], "<u8").astype(np.int64)
        rows[r["kind"]] += r["rows"]
    return total, rows


def chosen_bins(counts: np.ndarray, rows: np.ndarray, most: int = MAX_FEATURES) -> np.ndarray:
    """Bins that positives have significantly more often, the clearest first."""
    p, u = (counts[1] + 0.5) / (rows[1] + 1), (counts[0] + 0.5) / (rows[0] + 1)
    ratio = np.log(p / u)
    spread = np.sqrt(u * (1 - u) / max(1, rows[1]))
    good = (counts[1] >= 3) & (ratio > 0.7) & (p - u > 4 * spread)
    strength = np.where(good, counts[1] * ratio, 0)
    order = np.argsort(-strength, kind="stable")[:most]
    return np.sort(order[strength[order] > 0])


def estimated_prior(counts: np.ndarray, rows: np.ndarray) -> float:
    """Upper bound of the share of positives among all texts: the least ratio of a bin's shares, u / p, over the
    bins that at least ``PRIOR_SHARE`` of the positives have, each with two standard errors of doubt."""
    p, u = counts[1] / max(1, rows[1]), counts[0] / max(1, rows[0])
    wide = np.flatnonzero(p >= PRIOR_SHARE)
    p, u = p[wide], u[wide]
    low = p - 2 * np.sqrt(p * (1 - p) / max(1, rows[1]))
    high = u + 2 * np.sqrt(u * (1 - u) / max(1, rows[0]))
    return float((high[low > 0] / low[low > 0]).min(initial=1.0))


class Rows:
    """Rows of present features, as column numbers."""

    def __init__(self, found: list[np.ndarray], width: int):
        self.n, self.width = len(found), width
        self.row = np.repeat(np.arange(self.n), [len(x) for x in found])
        self.column = np.concatenate(found).astype(np.int64) if found else np.zeros(0, np.int64)

    def times(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights[self.column], self.n)

    def gathered(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.column, values[self.row], self.width)


def fit(positive: Rows, unlabelled: Rows, prior: float, *, steps: int = 400, rate: float = 0.05, decay: float = 1e-4):
    """Weights and bias of the non-negative risk's minimum (Adam over full batches)."""
    n = positive.width
    w, b = np.zeros(n), 0.0
    m, v = np.zeros(n + 1), np.zeros(n + 1)
    for step in range(1, steps + 1):
        fp, fu = positive.times(w) + b, unlabelled.times(w) + b
        # logistic loss l(z) = log(1 + exp(-z)); slopes of l(f) and l(-f)
        up_p = -1 / (1 + np.exp(np.clip(fp, -30, 30)))
        down_p, down_u = 1 + up_p, 1 / (1 + np.exp(np.clip(-fu, -30, 30)))
        negative = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
        if negative >= 0:
            gp, gu = prior * (up_p - down_p) / len(fp), down_u / len(fu)
        else:  # undo the overfit of the negative part only
            gp, gu = prior * down_p / len(fp), -down_u / len(fu)
        g = np.append(positive.gathered(gp) + unlabelled.gathered(gu) + decay * w, gp.sum() + gu.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return w, b


class Model:
    """Weights by bin; ``score(text)`` in 0 to 1."""

    def __init__(self, bins: np.ndarray, weights: np.ndarray, bias: float):
        self.bins, self.weights, self.bias = bins, weights, bias

    def open(self) -> np.ndarray:
        table = np.zeros(BINS)
        table[self.bins] = self.weights
        return table


def train(
    docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "toxic", label_key: str = "doc_id",
    max_positives: int = MAX_POSITIVES, max_unlabelled: int = MAX_UNLABELLED,
) -> Model:
    """Model from the learnable rows of ``docs`` and the learnable ``labels``."""
    spark = docs.sparkSession
    told = labels.select(F.col(label_key).cast("long").alias("k"), F.col(label).cast("int").alias("y"))
    told = told.where(learnable("k") & F.col("k").isNotNull() & F.col("y").isNotNull())
    told = told.groupBy("k").agg(F.max("y").alias("y"))
    total = told.agg(F.count(F.lit(1)).alias("n"), F.sum(F.when(F.col("y") == 1, 1).otherwise(0)).alias("p")).first()
    if not total["p"]:
        return Model(np.zeros(0, np.int64), np.zeros(0), -np.inf)
    share_told = total["p"] / total["n"]
    ids = told.where("y = 1").select("k")
    chosen = ids.orderBy(F.xxhash64("k"), "k").limit(max_positives).withColumn("s", F.lit(True))  # for the weights only
    ids = written(ids.join(F.broadcast(chosen), "k", "left").select("k", F.coalesce("s", F.lit(False)).alias("s")), "toxicity-positives")
    source = docs.select(F.col(key).cast("long").alias("k"), F.col(text).cast("string").alias("text")).where(learnable("k"))
    marked = source.join(broadcast_if_small(ids), "k", "left")
    marked = marked.select("k", "text", F.col("s").isNotNull().alias("positive"), F.coalesce("s", F.lit(False)).alias("sampled"))
    counts, rows = _counts(marked)
    prior = min(MOST_PRIOR, max(LEAST_PRIOR, min(share_told, estimated_prior(counts, rows))))
    bins = chosen_bins(counts, rows)
    if not len(bins) or not rows.all():
        return Model(np.zeros(0, np.int64), np.zeros(0), float(np.log(prior / (1 - prior))))
    share = min(1.0, max_unlabelled / rows[0])
    shared = spark.sparkContext.broadcast(bins)

    def rows_of(batches):
        wanted = shared.value
        known = WordBins()
        for batch in batches:
            found = [np.flatnonzero(np.isin(wanted, known.of(t), assume_unique=True)) for t in batch.column(0).to_pylist()]
            yield record_batch({"bins": ([x.astype("<u2").tobytes() for x in found], pa.binary()), "sampled": (batch.column(1), None), "drawn": (batch.column(2), None)})

    drawn = F.pmod(F.xxhash64(F.col("k"), F.lit(7)), F.lit(1_000_003)) < F.lit(int(share * 1_000_003))
    sample = marked.withColumn("drawn", drawn).where("sampled or drawn").select("text", "sampled", "drawn")
    matrix = {True: [], False: []}
    # bounded: max_positives + about max_unlabelled rows of feature numbers
    for r in sample.mapInArrow(rows_of, "bins binary, sampled boolean, drawn boolean").collect():
        found = np.frombuffer(r["bins"], "<u2")
        if r["sampled"]:
            matrix[True].append(found)
        if r["drawn"]:  # the unlabelled sample is drawn from all texts, so that it has the class prior
            matrix[False].append(found)

    weights, bias = fit(Rows(matrix[True], len(bins)), Rows(matrix[False], len(bins)), prior)
    return Model(bins, weights, min(bias, float(np.log(prior / (1 - prior)))))


def _probability(z: np.ndarray) -> np.ndarray:
    """0 for a bias of minus infinity, which a model without positives has."""
    with np.errstate(over="ignore"):
        return 1 / (1 + np.exp(-z))


def score(docs: DataFrame, model: Model, *, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score and predicted of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        found = shared.value
        table, bias = found.open(), found.bias
        worker_cache("toxicity")
        bins = WordBins()
        for batch in batches:
            z = np.array([bias + table[bins.of(t)].sum() for t in batch.column(1).to_pylist()])
            p = _probability(z)
            yield record_batch({"doc_id": (batch.column(0), None), "score": (p, pa.float64()), "predicted": ((p >= threshold).astype(np.int32), pa.int32())})

    source = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, score double, predicted int")


def without_toxic(docs: DataFrame, model: Model, *, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, whole, that score below ``threshold``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)

    def run(batches):
        table, bias = shared.value.open(), shared.value.bias
        bins = WordBins()
        for batch in batches:
            z = np.array([bias + table[bins.of(t)].sum() for t in batch.column(at).to_pylist()])
            yield batch.filter(pa.array(_probability(z) < threshold, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def toxicity_digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The contract's columns, one row per document."""
    found = score(docs, train(docs, labels))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "score", "predicted")
