"""Toxicity and language: held-out accuracy on the given tables, and odd rows."""

import random

import numpy as np
import pytest

from hiremart.llm import language as L
from hiremart.llm import toxicity as T

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def test_toxicity_held_out(tables):
    docs, labels = tables
    told = {r.doc_id: r.toxic for r in labels.collect()}
    rows = [(r.score, told[r.doc_id], r.predicted) for r in T.toxicity_digest(docs, labels).where("held_out").collect() if r.doc_id in told]
    score, toxic, predicted = map(np.array, zip(*rows))
    rank = np.argsort(np.argsort(score))
    auc = (rank[toxic == 1].mean() - (toxic.sum() - 1) / 2) / (len(toxic) - toxic.sum())
    assert auc > 0.93
    assert toxic[predicted == 1].mean() > 0.85 and predicted[toxic == 1].mean() > 0.8
    assert ((score >= 0.7) == predicted).all()


def test_non_negative_risk_finds_the_features():
    rng = np.random.default_rng(0)
    hidden = rng.random(3000) < 0.2  # toxic texts among the unlabelled
    unlabelled = [np.flatnonzero(rng.random(6) < ([0.8, 0.6, 0.1, 0.1, 0.1, 0.1] if h else [0.02, 0.02, 0.1, 0.1, 0.1, 0.1])) for h in hidden]
    positive = [np.flatnonzero(rng.random(6) < [0.8, 0.6, 0.1, 0.1, 0.1, 0.1]) for _ in range(400)]
    w, b = T.fit(T.Rows(positive, 6), T.Rows(unlabelled, 6), 0.2)
    found = T.Rows(unlabelled, 6).times(w) + b > 0
    assert w[:2].min() > np.abs(w[2:]).max()
    assert (found == hidden).mean() > 0.9


def test_toxicity_odd_rows(spark, documents):
    rng = random.Random(1)
    word = lambda: "".join(rng.choices("abcdefgh", k=5))
    rows = [(k, " ".join([word() for _ in range(20)] + (["zzzbad"] if k % 4 == 0 else []))) for k in range(400)]
    docs = documents(rows + [(1000, None), (1001, ""), (None, "zzzbad"), (4, rows[4][1])])
    told = spark.createDataFrame([(k, int(k % 4 == 0), "h") for k in range(0, 400, 2)] + [(None, 1, "h"), (7, None, "h"), (8, 0, "h")], "doc_id long, toxic int, text string")
    got = T.toxicity_digest(docs, told).collect()
    assert len(got) == 404
    of = {r.doc_id: r for r in got}
    assert of[1000].score == of[1001].score < 0.7 and not of[None].held_out
    assert of[8].score > of[9].score and len({r.score for r in got if r.doc_id == 4}) == 1
    none = T.toxicity_digest(docs, told.where("toxic = 0"))
    assert {(r.score, r.predicted) for r in none.collect()} == {(0.0, 0)}
    assert T.toxicity_digest(documents([]), told).collect() == []
    kept = T.without_toxic(docs, T.train(docs, told))
    assert kept.schema == docs.schema and 280 < kept.count() < 404


def test_language_held_out(tables):
    docs, _ = tables
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    got = L.language_digest(docs).where("held_out").collect()
    assert np.mean([truth[r.doc_id] == r.lang_pred for r in got]) > 0.98
    assert all(0 <= r.score <= 1 for r in got)


def test_language_odd_rows(documents):
    english, german = "the cat and the dog went over there with them ", "der hund und die katze gingen nicht über die straße "
    rows = [(k, (english if k % 2 else german) * (1 + k % 5), "en" if k % 2 else "de") for k in range(120)]
    docs = documents(rows + [(500, None, "en"), (501, "", "de"), (502, "123 ... !", "en"), (503, english, None), (None, german, "xx"), (504, "Ж", None)])
    got = {r.doc_id: r for r in L.language_digest(docs).collect()}
    assert [got[k].lang_pred for k in (500, 501, 502)] == ["und"] * 3 and got[500].score == 0
    assert got[503].lang_pred == "en" and got[None].lang_pred == "de" and got[504].lang_pred in ("en", "de")
    assert {r.lang_pred for r in L.language_digest(documents([(1, "text", None)])).collect()} == {"und"}
    assert L.language_digest(documents([])).collect() == []
    assert all((got[k].lang_pred == ("en" if k % 2 else "de")) for k in range(120))


def test_language_with_very_many_languages_long_texts_and_ties(documents):
    rng = random.Random(8)
    words = {f"x{k}": ["".join(rng.choices("abcdefghijklmnop", k=6)) for _ in range(4)] for k in range(700)}
    rows = [(10 * k + j, " ".join(words[f"x{k}"] * 3), f"x{k}") for k in range(700) for j in range(2)]
    long = " ".join(words["x5"]) * 30_000
    docs = documents(rows + [(9001, long, "x5"), (9002, " ".join(words["x6"] * 3), "y6"), (9002, " ".join(words["x6"] * 3), "y6"), (9003, " ".join(words["x6"] * 3), "x6")])
    model = L.train(docs)
    assert len(set(model.languages)) > 650  # some have only held-out texts
    got = L.identify(docs, model).collect()
    right = [r.lang_pred == f"x{r.doc_id // 10}" for r in got if r.doc_id < 9000 and f"x{r.doc_id // 10}" in model.languages]
    assert np.mean(right) > 0.95
    of = {r.doc_id: r for r in got}
    assert of[9001].lang_pred == "x5"
    assert len({(r.lang_pred, r.score) for r in got if r.doc_id in (9002, 9003)}) == 1
    assert of[9003].lang_pred == min(x for x in ("x6", "y6") if x in model.languages)  # a tie goes to the first


def plain_language(model, text):
    """One document by loops over dicts: n-grams, weights, cosine with every centroid."""
    import math

    if not text or not any(c.isalpha() for c in text):
        return "und", 0.0
    letters = ""
    for c in text.lower():  # whatever is no letter becomes one blank
        letters += c if L.LETTER.match(c) else "" if letters.endswith(" ") else " "
    data = f" {letters} ".encode()
    counts: dict[int, int] = {}
    for i in range(len(data)):
        grams = [data[i]]
        if i + 1 < len(data):
            grams.append((data[i] * 257 + data[i + 1] + (1 << 16)) % 2**32)
        if i + 2 < len(data):
            grams.append((grams[1] * 263 + data[i + 2] + (1 << 24)) % 2**32)
        for g in grams:
            b = g * 2654435761 % 2**32 >> 19
            counts[b] = counts.get(b, 0) + 1
    weight = {b: (1 + math.log(n)) * model.idf[b] for b, n in counts.items()}
    size = math.sqrt(sum(w * w for w in weight.values()))
    best = max(((sum(w / size * float(c[b]) for b, w in weight.items()), -k) for k, c in enumerate(model.centroids)))
    return model.languages[-best[1]], min(1.0, max(0.0, best[0]))


def test_language_equals_a_plain_loop(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = L.train(docs)
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in L.identify(docs, model).collect():
        name, score = plain_language(model, texts[r.doc_id])
        assert r.lang_pred == name and abs(r.score - score) < 1e-4


def test_toxicity_equals_a_plain_loop(spark):
    import math
    import zlib

    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    model = T.train(docs, labels)
    weight = dict(zip(model.bins.tolist(), model.weights.tolist()))
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in T.score(docs, model).collect():
        bins = set()
        for word in T.WORD.findall((texts[r.doc_id] or "").lower()):
            bins |= {zlib.crc32(c.encode()) % T.BINS for c in [f"={word}", *(f"{k}{word[:k]}" for k in T.BEGINNINGS if len(word) > k)]}
        z = model.bias + sum(weight.get(b, 0.0) for b in bins)
        assert abs(r.score - 1 / (1 + math.exp(-z))) < 1e-9 and r.predicted == (r.score >= 0.7)


def test_prior_follows_the_texts_and_not_the_choice_of_labels(spark, documents):
    counts, rows = np.array([[1000, 1200, 480], [500, 480, 200]]), np.array([4000, 500])
    assert 0.25 < T.estimated_prior(counts, rows) < 0.28
    assert T.estimated_prior(np.zeros((2, 3)), np.array([10, 0])) == 1.0
