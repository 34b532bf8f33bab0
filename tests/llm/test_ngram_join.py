"""N-gram Jaccard join against brute force."""

import random
import re

import numpy as np

from hiremart.llm import ngram_join as J
from hiremart.llm.components import components
from hiremart.llm.shingles import shingle_sets

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def brute(rows):
    sets = []
    for _, text in rows:
        w = WORD.findall((text or "").translate(LOWER))
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    own = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]) and own[a] != own[b]:
                own = [own[b] if x == own[a] else x for x in own]
    least = {}
    for k, c in enumerate(own):
        if rows[k][0] is not None:
            least[c] = min(least.get(c, rows[k][0]), rows[k][0])
    return sorted(((r[0], len(s), least.get(c) if s else r[0]) for r, s, c in zip(rows, sets, own)), key=str)


def got(frame):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in frame.collect()), key=str)


def corpus(seed):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    rows = []
    for base in range(12):
        text = rng.choices(words, k=rng.choice([3, 5, 8, 40, 120]))
        for _ in range(rng.randint(1, 6)):  # chains of near copies
            copy = list(text)
            for _ in range(rng.randint(0, max(1, len(copy) // 40))):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append((len(rows) * 3 + 1, rng.choice([" ", "\n", "  "]).join(copy).upper() if rng.random() < 0.3 else " ".join(copy)))
            text = copy if rng.random() < 0.7 else text
    rng.shuffle(rows)
    return rows


def test_random_corpora_match_brute_force(spark, documents):
    rows = corpus(1) + [(10_000 + i, t) for i, t in corpus(2)]
    assert got(J.jaccard_components(documents(rows))) == brute(rows)


def test_nulls_empty_repeated_rows_and_shared_ids(spark, documents):
    line = "one two three four five six seven eight nine ten"
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "a b"), (5, "A  b"), (6, "b a"), (7, line), (7, line), (7, "else here are other words"),
            (None, line), (8, line.upper()), (None, "nobody else has this text at all")]
    assert got(J.jaccard_components(documents(rows))) == brute(rows)


def test_empty_table(spark, documents):
    assert J.jaccard_components(documents([])).collect() == []


def test_one_document_of_each_component_stays_whole(spark, documents):
    line = "one two three four five six seven eight nine ten"
    rows = [(9, line), (3, line + " "), (3, line + " "), (5, None), (6, ""), (7, "something quite different is said over here")]
    kept = J.one_of_each_component(documents(rows))
    assert kept.columns == documents(rows).columns
    assert sorted((r.doc_id, r.text) for r in kept.collect() if r.doc_id != 5) == [(3, line + " "), (6, ""), (7, rows[-1][1])]
    assert kept.where("doc_id = 5").count() == 1


def test_threshold_is_inclusive():
    base = [f"t{k}" for k in range(11)]  # 7 shingles, 6 of them in a text of 10 words: 6 / 7; 3 of 4: exactly 75 %
    a, b = list(shingle_sets([" ".join(base[:8]).encode(), " ".join(base[:7]).encode()]))
    assert (len(a), len(b), len(np.intersect1d(a, b))) == (4, 3, 3)
    assert J.block_links([a, b]) in ([(0, 1)], [(1, 0)])


def test_block_links_span_the_components():
    rng = np.random.default_rng(3)
    base = np.unique(rng.integers(0, 1 << 60, 400).astype(np.uint64))
    sets = []
    for k in range(60):
        keep = rng.random(len(base)) < rng.choice([0.8, 0.9, 0.97])
        sets.append(np.unique(np.concatenate((base[keep], rng.integers(0, 1 << 60, 8).astype(np.uint64)))))
    own = list(range(60))
    for a in range(60):
        for b in range(a):
            both = len(np.intersect1d(sets[a], sets[b]))
            if 7 * both >= 3 * (len(sets[a]) + len(sets[b])) and own[a] != own[b]:
                own = [own[b] if x == own[a] else x for x in own]
    found = list(range(60))
    for a, b in J.block_links(sets):
        found = [found[b] if x == found[a] else x for x in found]
    same = lambda x: [x.index(v) for v in x]
    assert same(found) == same(own)


def test_the_matrix_finds_links_that_grouping_missed(spark, documents, monkeypatch):
    monkeypatch.setattr(J, "_round_links", lambda sets, k: sets.sparkSession.createDataFrame([], "a long, b long"))
    rows = corpus(4)
    assert got(J.jaccard_components(documents(rows))) == brute(rows)


def test_long_texts_are_hashed_like_short_ones():
    words = " ".join(f"word{k % 977}" for k in range(300_000))  # several segments
    whole = next(shingle_sets([words.encode()]))
    part = next(shingle_sets([" ".join(f"word{k % 977}" for k in range(2_000)).encode()]))
    assert len(whole) == 977 and np.isin(part, whole).all()


def test_components_of_paths_and_stars(spark):
    edges = [(k, k + 1) for k in range(30)] + [(100, 100 + k) for k in range(1, 40)] + [(500, 499)]
    found = components(spark.createDataFrame(edges, "a long, b long"), "a", "b")
    assert {(r.node, r.comp) for r in found.collect()} == (
        {(k, 0) for k in range(31)} | {(100 + k, 100) for k in range(40)} | {(499, 499), (500, 499)}
    )
