"""Benchmark decontamination against brute force."""

import hashlib
import random
from collections import defaultdict

import pytest

from hiremart.llm import decontaminate as D


def brute(docs, items, window=13):
    windows = defaultdict(set)
    for item, text in items:
        w = D.words(text.encode() if text is not None else None)
        for k in range(len(w) - min(window, len(w)) + 1) if w else ():
            windows[tuple(w[k : k + min(window, len(w))])].add(item)
    out = []
    for doc, text in docs:
        w = D.words(text.encode() if text is not None else None)
        hit, found = set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if ids := windows.get(tuple(w[k : k + n])):
                    found |= ids
                    hit |= set(range(k, k + n))
        found = sorted(str(x) for x in found if x is not None)
        sha = hashlib.sha256(",".join(found).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(found), sha, len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def bench(spark, items):
    return spark.createDataFrame([(i, t, 1, "z") for i, t in items], "item_id long, text string, n_words int, spans string")


def run(docs, items, **options):
    return sorted(map(tuple, D.contamination_digest(docs, items, **options).collect()), key=str)


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefg") * rng.randint(1, 2)
    items = [(k, " ".join(word() for _ in range(rng.choice([1, 3, 12, 13, 14, 20, 30])))) for k in range(12)]
    docs = []
    for k in range(60):
        parts = [" ".join(word() for _ in range(rng.randint(0, 25)))]
        for _ in range(rng.randint(0, 3)):
            w = rng.choice(items)[1].split()
            a = rng.randint(0, len(w) - 1)
            parts += [" ".join(w[a : a + rng.randint(1, 30)]).upper(), rng.choice(["", "Ünïcode x", "q, q"])]
        docs.append((k, rng.choice([" ", ", ", "\n"]).join(parts)))
    return docs, items


@pytest.mark.parametrize("block", [1 << 20, 60])
def test_random_texts_match_brute_force(spark, documents, block):
    for seed in (1, 2):
        docs, items = corpus(seed)
        assert run(documents(docs), bench(spark, items), max_block_bytes=block) == brute(docs, items)


def test_nulls_empty_and_repeated(spark, documents):
    docs = [(1, None), (2, ""), (3, "... !"), (4, "one two"), (4, "one two"), (None, "One, TWO!"), (5, "one  two three")]
    items = [(7, "one two"), (7, "one two"), (None, "three"), (8, None), (9, ""), (10, "two")]
    assert run(documents(docs), bench(spark, items)) == brute(docs, items)


def test_empty_tables(spark, documents):
    docs = [(1, "some words")]
    assert run(documents(docs), bench(spark, [])) == brute(docs, [])
    assert run(documents([]), bench(spark, [(1, "some")])) == []


def test_contaminated_rows_go_and_clean_rows_stay_whole(spark, documents):
    passage = " ".join(f"p{k}" for k in range(20))
    docs = documents([(1, f"Start {passage} end"), (2, "clean text here"), (3, f"{passage} " + "filler " * 1000), (4, None)])
    kept = D.without_contaminated(docs, bench(spark, [(1, passage)]))
    assert kept.columns == docs.columns
    assert sorted(kept.collect()) == sorted(docs.where("doc_id <> 1").collect())


def test_clean_text_loses_the_spans(spark, documents):
    passage = " ".join(f"p{k}" for k in range(20))
    r = D.decontaminate(documents([(1, f"Start, {passage}. End")]), bench(spark, [(1, passage)])).first()
    assert (r.n_hit, r.contaminated, r.clean_text) == (20, True, "Start, . End")
