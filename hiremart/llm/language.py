"""Language identification by nearest centroid.

A text becomes a vector of hashed character n-grams (1 to 3 UTF-8 bytes of the
lower-cased text, whatever is no letter being one blank), weighted by
(1 + log tf) * idf and scaled to length 1.  Each language has several
centroids, found by spherical k-means over a bounded sample of its texts, and
a text gets the language of the centroid with the largest cosine.  A text
whose best cosine lies below what the language's own texts reach (a quantile
of the sample) is marked as rejected.

Document frequencies are counted over all learnable documents.  The sample is
bounded: ``MAX_PER_LANGUAGE`` texts a language and ``MAX_SAMPLE`` in all, but one text of each
language at least, taken by a hash of doc_id.

Scale: three passes that only map the texts; a task sends one vector of
``BINS`` counts, k-means runs in one small group a language, and the model that is
broadcast has ``CENTROIDS`` rows of ``BINS`` numbers (131 KB) a language, however many there are.

Defined results: null texts and texts without a letter are ``und`` with score
0; so is everything when nothing can be learned; null languages teach
nothing; ties go to the language that sorts first; repeated rows get equal
predictions.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hiremart.llm.common import record_batch, written
from hiremart.operators.materialize import broadcast_if_small

BINS = 1 << 13
MAX_PER_LANGUAGE = 400
MAX_SAMPLE = 6_000
CENTROIDS = 4
REJECT_QUANTILE = 0.01
UNKNOWN = "und"

LETTER = regex.compile(r"\p{L}")
OTHER = regex.compile(r"[^\p{L}]+")


def gram_counts(text: str | None) -> np.ndarray | None:
    """Counts of the hashed n-grams; None where the text has no letter."""
    if not text or not LETTER.search(text):
        return None
    data = np.frombuffer(f" {OTHER.sub(' ', text.lower())} ".encode(), np.uint8).astype(np.uint32)
    two = data[:-1] * np.uint32(257) + data[1:] + np.uint32(1 << 16)
    three = two[:-1] * np.uint32(263) + data[2:] + np.uint32(1 << 24)
    grams = np.concatenate((data, two, three)) * np.uint32(2654435761)
    return np.bincount(grams >> np.uint32(19), minlength=BINS)


def vectors(texts: list[str | None], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors of the texts with letters, and which these are."""
    rows, held = [], []
    for text in texts:
        counts = gram_counts(text)
        held.append(counts is not None)
        if counts is not None:
            full = np.flatnonzero(counts)
            row = np.zeros(BINS, np.float32)
            row[full] = (1 + np.log(counts[full])) * idf[full]
            rows.append(row / max(1e-12, np.linalg.norm(row)))
    return (np.array(rows, np.float32) if rows else np.zeros((0, BINS), np.float32)), np.array(held, bool)


def learnable(key: str = "doc_id"):
    """Rows that may be learned from; the others are held out."""
    return F.crc32(F.col(key).cast("string")) % 4 != 2


def clustered(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means; starts from the text next to the mean and then those farthest from all starts."""
    start = [int(np.argmax(x @ x.mean(0)))]
    near = x @ x[start[0]]
    while len(start) < min(k, len(x)):
        start.append(int(np.argmin(near)))
        near = np.maximum(near, x @ x[start[-1]])
    centre = x[start]
    for _ in range(rounds):
        own = np.argmax(x @ centre.T, 1)
        total = np.stack([x[own == c].sum(0) if (own == c).any() else centre[c] for c in range(len(centre))])
        centre = total / np.maximum(1e-12, np.linalg.norm(total, axis=1, keepdims=True))
    return centre


class Model:
    """idf, centroids, the language of each, and each language's least cosine."""

    def __init__(self, idf: np.ndarray, centroids: np.ndarray, languages: list[str], least: dict[str, float]):
        order = sorted(range(len(languages)), key=languages.__getitem__)
        self.idf, self.least = idf, least
        self.centroids, self.languages = centroids[order], [languages[k] for k in order]

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float], list[bool]]:
        """Language, cosine clipped to 0..1, and rejected, of each text."""
        if not self.languages:
            return [UNKNOWN] * len(texts), [0.0] * len(texts), [True] * len(texts)
        names, scores, rejected = [], [], []
        for at in range(0, len(texts), 256):
            part = texts[at : at + 256]
            x, held = vectors(part, self.idf)
            cosine = x @ self.centroids.T
            best = iter(np.argmax(cosine, 1)) if len(x) else iter(())
            rows = iter(cosine)
            for has in held:
                if not has:
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    rejected.append(True)
                    continue
                k, row = next(best), next(rows)
                names.append(self.languages[k])
                scores.append(float(min(1.0, max(0.0, row[k]))))
                rejected.append(bool(row[k] < self.least[self.languages[k]]))
        return names, scores, rejected


def train(docs: DataFrame, *, key: str = "doc_id", text: str = "text", language: str = "lang", centroids: int = CENTROIDS) -> Model:
    spark = docs.sparkSession
    source = docs.select(F.col(key).alias("k"), F.col(text).cast("string").alias("text"), F.col(language).cast("string").alias("lang"))
    source = source.where(learnable("k") & F.col("lang").isNotNull() & F.col("text").isNotNull())
    draw = F.pmod(F.xxhash64(F.col("k"), F.lit(7)), F.lit(1_000_003))
    sizes = written(source.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.min(draw).alias("first")), "languages")
    total, languages = sizes.agg(F.sum("n"), F.count(F.lit(1))).first()

    def count(batches):
        seen, rows = np.zeros(BINS, np.int64), 0
        for batch in batches:
            for t in batch.column(0).to_pylist():
                counts = gram_counts(t)
                if counts is not None:
                    seen += counts > 0
                    rows += 1
        yield record_batch({"rows": ([rows], pa.int64()), "seen": ([seen.tolist()], pa.list_(pa.int64()))})

    sent = source.select("text").mapInArrow(count, "rows long, seen array<long>")
    seen = np.zeros(BINS)  # BINS sums come to the driver
    for r in sent.select(F.posexplode("seen").alias("bin", "n")).groupBy("bin").agg(F.sum("n").alias("n")).collect():
        seen[r["bin"]] = r["n"]
    idf = np.log((1 + (total or 0)) / (1 + seen)) + 1
    if not total:
        return Model(idf, np.zeros((0, BINS), np.float32), [], {})
    each = max(1, min(MAX_PER_LANGUAGE, MAX_SAMPLE // languages))
    limits = sizes.select("lang", F.greatest(F.least(F.lit(1.0), each / F.col("n")) * 1_000_003, F.col("first") + 1).alias("below"))
    drawn = source.join(broadcast_if_small(limits), "lang").where(draw < F.col("below"))
    shared = spark.sparkContext.broadcast(idf)

    def grams(batches):
        for batch in batches:
            x, held = vectors(batch.column(1).to_pylist(), shared.value)
            yield record_batch({
                "lang": (batch.column(0).filter(pa.array(held)), None), "x": ([r.astype("<f2").tobytes() for r in x], pa.binary()),
            })

    def centre(frame: pd.DataFrame) -> pd.DataFrame:
        x = np.stack([np.frombuffer(b, "<f2") for b in frame["x"]]).astype(np.float32)
        found = clustered(x, centroids)
        least = float(np.quantile((x @ found.T).max(1), REJECT_QUANTILE))
        return pd.DataFrame({"lang": frame["lang"].iloc[0], "c": [c.astype("<f4").tobytes() for c in found], "least": least})

    sample = drawn.select("lang", "text").mapInArrow(grams, "lang string, x binary")
    rows = sample.groupBy("lang").applyInPandas(centre, "lang string, c binary, least double").collect()
    found = np.array([np.frombuffer(r["c"], "<f4") for r in rows], np.float32).reshape(-1, BINS)
    return Model(idf, found, [r["lang"] for r in rows], {r["lang"]: r["least"] for r in rows})


def identify(docs: DataFrame, model: Model, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, lang_pred, score (cosine) and rejected of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            names, scores, rejected = shared.value.predict(batch.column(1).to_pylist())
            yield record_batch({
                "doc_id": (batch.column(0), None), "lang_pred": (names, pa.string()),
                "score": (scores, pa.float64()), "rejected": (rejected, pa.bool_()),
            })

    source = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double, rejected boolean")


def language_digest(docs: DataFrame) -> DataFrame:
    """The contract's columns and ``rejected``, one row per document."""
    found = identify(docs, train(docs))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")
