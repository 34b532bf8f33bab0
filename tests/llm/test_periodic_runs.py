"""Periodic runs against a plain search over all periods."""

import hashlib
import random
import time

import pytest

from hiremart.llm import periodic_runs as R


def plain(words, least_periods=4, least_words=6):
    """All maximal stretches, period by period; a stretch found before has a smaller period."""
    seen, out, n = set(), [], len(words)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= 2 * q and (i, j + q) not in seen:
                seen.add((i, j + q))
                if j + q - i >= max(least_words, least_periods * q):
                    out.append((i, j + q - i, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def made(rng, n, letters):
    words = []
    while len(words) < n:
        part = [rng.choice(letters) for _ in range(rng.randint(1, 6))]
        words += part * rng.choice([1, 1, 2, 4, 5, 9]) + part[: rng.randint(0, len(part))]
    return words[:n]


@pytest.mark.parametrize("seed", range(30))
def test_runs_equal_the_plain_search(seed):
    rng = random.Random(seed)
    letters = [b"a", b"b", b"c", b"d", b"e"][: rng.randint(1, 5)]
    texts = [made(rng, rng.randint(0, 120), letters) for _ in range(rng.randint(0, 12))]
    assert R.runs(texts) == [plain(t) for t in texts]


def test_bounds_ties_and_overlaps():
    w = lambda s: [c.encode() for c in s]
    assert R.runs([w("aaaaa"), w("aaaaaa"), w("abababab"), w("abababa"), [], w("x")]) == [[], [(0, 6, 1)], [(0, 8, 2)], [], [], []]
    assert R.runs([w("aaaaaab" * 4)])[0] == plain(w("aaaaaab" * 4))
    assert R.strongest([(0, 8, 2), (20, 12, 3), (9, 8, 2)]) == (0, 8, 2) and R.strongest([]) is None
    assert R.collapsed(w("xabababaay"), [(1, 7, 2)]) == w("xabay")


@pytest.mark.parametrize("words", [[b"la"] * 300_000, [b"la"] * 150_000 + [b"x"] + [b"la"] * 150_000, [b"a", b"b", b"c"] * 100_000])
def test_very_long_repetition_is_not_quadratic(words):
    t = time.time()
    found = R.runs([words, [b"q"]])
    assert time.time() - t < 60
    assert found[1] == [] and sum(r[1] for r in found[0]) >= len(words) - 1


def tail(key, words):
    import zlib

    h = zlib.crc32(str(key).encode())
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def expected(key, text):
    words = (text or "").encode().split()
    words = tail(key, words) if key is not None else words
    found = plain(words)
    best = max(found, key=lambda r: (r[1] * 10**9 // r[2], -r[0], -r[2]), default=(None,) * 3)
    gone = {i for a, n, q in found for i in range(a + q, a + n)}
    return (
        len(found), *best, best[1] * 1000 // best[2] if best[2] else None,
        hashlib.sha256("".join("%d,%d,%d\n" % r for r in found).encode()).hexdigest(),
        hashlib.sha256(b" ".join(x for i, x in enumerate(words) if i not in gone)).hexdigest(),
    )


def check(docs, rows):
    got = R.runs_digest(docs).collect()
    have = sorted(((r.doc_id, (r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256)) for r in got), key=str)
    assert have == sorted(((k, expected(k, t)) for k, t in rows), key=str)


def test_digest_on_odd_rows(spark, documents):
    rng = random.Random(5)
    rows = [(k, " ".join(rng.choice("ab cé   　 d".split(" ")) for _ in range(rng.randint(0, 60)))) for k in range(120)]
    rows += [(None, "a b a b a b a b a"), (500, None), (501, ""), (502, " \t\n\x0b\x0c\r "), (503, "x x x x x x x"), (4, rows[4][1]), (4, "other " * 9), (504, "mañana " * 5000)]
    check(documents(rows), rows)
    assert R.runs_digest(documents([])).collect() == []


def test_digest_on_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    check(docs, [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


def test_runs_of_gives_runs_and_kept_text(spark, documents):
    got = {r.doc_id: r for r in R.runs_of(documents([(1, "a b a b a b a b c"), (2, None)])).collect()}
    assert [tuple(x) for x in got[1].runs] == [(0, 8, 2)] and bytes(got[1].kept) == b"a b c" and got[1].n_words == 9
    assert got[2].runs == [] and bytes(got[2].kept) == b""
