"""Repeated strings against brute force, and the transform against direct comparison."""

import hashlib
import random

import numpy as np

from hiremart.llm import substring_index as X
from hiremart.llm import suffix_dedup as S


def brute(rows, length):
    """By (doc_id, start); a null id first; equal rows are one document."""
    seen: dict[bytes, tuple] = {}
    whole = [(float("-inf") if i is None else i, (t or "").encode(), i) for i, t in rows]
    for d, b, _ in whole:
        for k in range(len(b) - length + 1):
            w = b[k : k + length]
            seen[w] = min(seen.get(w, (d, k)), (d, k))
    out = []
    for d, b, i in whole:
        cover = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if seen[b[k : k + length]] < (d, k):
                cover[k : k + length] = b"\1" * length
        kept = bytes(x for x, c in zip(b, cover) if not c)
        runs = sum(c and not (k and cover[k - 1]) for k, c in enumerate(cover))
        out.append((i, len(b), sum(cover), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def run(frame, **options):
    return sorted(map(tuple, S.remove_repeats(frame, **options).collect()), key=str)


def corpus(seed, docs, length):
    rng = random.Random(seed)
    text = lambda n: "".join(rng.choice("abcdeé\n ") for _ in range(n))
    passages = [text(rng.choice([length // 2, length - 1, length, length + 7, 3 * length])) for _ in range(6)]
    rows = []
    for k in range(docs):
        parts = [text(rng.randint(0, 80))]
        for _ in range(rng.randint(0, 4)):
            p = rng.choice(passages)
            a = rng.randint(0, len(p) // 3)
            parts += [p[a:] if rng.random() < 0.5 else p, text(rng.randint(0, 40))]
        rows.append((rng.randint(0, 10_000), "".join(parts)))
    return rows


def test_random_texts_match_brute_force(spark, documents):
    rows = corpus(1, 60, 100)
    assert run(documents(rows)) == brute(rows, 100)


def test_hot_minimizers_match_brute_force(spark, documents, monkeypatch):
    monkeypatch.setattr(S, "HOT", 5)
    rows = corpus(2, 60, 40)
    assert run(documents(rows), length=40) == brute(rows, 40)


def test_periodic_copied_and_short_texts(spark, documents):
    rows = [(5, "ab" * 400), (6, "a" * 333), (7, "x" * 99), (8, "x" * 99), (9, "short"), (3, "ab" * 200), (10, None), (11, ""),
            (12, "copy " * 60), (13, "copy " * 60), (13, "copy " * 60), (14, "copy " * 61), (None, "x" * 100), (15, "y" + "x" * 100)]
    assert run(documents(rows)) == brute(rows, 100)


def test_one_id_with_different_texts(spark, documents):
    rng = random.Random(5)
    p = "".join(rng.choices("abcdefgh", k=150))
    rows = [(1, p + "1"), (1, "22" + p), (1, p + "3"), (0, p[10:140])]
    assert run(documents(rows)) == brute(rows, 100)


def test_very_long_text(spark, documents, monkeypatch):
    monkeypatch.setattr(S, "UNIT_BYTES", 3000)
    rng = random.Random(6)
    p = "".join(rng.choices("abcdefgh", k=9000))
    rows = [(1, p), (2, p[2000:8000] + "q" + p[:500]), (3, "z" + p)]
    assert run(documents(rows)) == brute(rows, 100)


def test_empty_table(spark, documents):
    assert run(documents([])) == []


def test_rows_lose_their_repeats(spark, documents):
    rng = random.Random(7)
    p = "".join(rng.choices("abcdefgh", k=300))
    docs = documents([(1, p), (2, "Before. " + p + " After."), (3, p), (4, None), (5, ""), (6, "untouched")])
    kept = S.without_repeats(docs, size="n_chars")
    assert kept.columns == docs.columns and kept.schema == docs.schema
    got = {r.doc_id: (r.text, r.n_chars) for r in kept.collect()}
    assert got == {1: (p, 300), 2: ("Before.  After.", 15), 4: (None, None), 5: ("", 0), 6: ("untouched", 9)}


def test_repeat_classes_equal_direct_comparison():
    rng = np.random.default_rng(0)
    for _ in range(120):
        length = int(rng.choice([1, 2, 3, 7, 8, 20, 33]))
        text = rng.integers(0, rng.choice([1, 2, 4]) + 1, int(rng.integers(length, 250))).astype(np.uint16) + X.BYTE
        starts = np.arange(len(text) - length + 1)
        known, seen = {}, {}
        want = [known.setdefault(text[i : i + length].tobytes(), i) for i in starts]
        assert [seen.setdefault(c, i) for i, c in enumerate(X.repeat_classes(text, starts, length).tolist())] == want
