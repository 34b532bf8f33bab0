"""The driver holds one block of benchmark items at a time."""

import random

from hiremart.llm import decontaminate as D


def test_blocks_come_one_at_a_time(spark, monkeypatch):
    items = spark.createDataFrame([(k, f"some words of item number {k:03}") for k in range(200)], "item_id long, text string").coalesce(1)
    cut = []
    plain = D.words
    monkeypatch.setattr(D, "words", lambda t: cut.append(1) or plain(t))
    blocks = iter(D._blocks(items, "item_id", "text", 300))
    first = next(blocks)
    assert 0 < len(first) <= 10 and len(cut) <= len(first) + 1
    ids = [i for b in [first, *blocks] for i, _ in b]
    assert sorted(map(int, ids)) == list(range(200))


def test_no_more_than_one_block_is_alive(spark, documents, monkeypatch):
    alive = []
    plain = D._blocks

    def watched(*args):
        for block in plain(*args):
            assert not any(alive)  # the blocks before were let go
            alive.append(block)
            yield block

    monkeypatch.setattr(D, "_blocks", watched)
    items = spark.createDataFrame([(k, f"alpha beta gamma {k}") for k in range(6)], "item_id long, text string").coalesce(1)
    got = D.contamination_digest(documents([(1, "alpha beta gamma 3 and alpha beta gamma 5"), (2, "alpha beta")]), items, max_block_bytes=40).collect()
    assert len(alive) >= 3 and {r.doc_id: (r.n_hit, r.n_items) for r in got} == {1: (8, 2), 2: (0, 0)}


def test_many_blocks_equal_one(spark, documents):
    rng = random.Random(2)
    word = lambda: rng.choice("alpha beta gamma delta epsilon zeta eta theta".split())
    items = [(k, " ".join(word() for _ in range(rng.randint(1, 30)))) for k in range(60)] + [(None, "alpha beta"), (61, None), (62, "")]
    rows = [(k, " ".join(word() for _ in range(rng.randint(0, 80)))) for k in range(40)] + [(None, "alpha beta gamma " * 9), (None, None), (7, "alpha"), (3, ""), (4, "gamma " * 50), (4, "gamma " * 50)]
    bench = spark.createDataFrame(items, "item_id long, text string").coalesce(1)
    docs = documents(rows)
    key = lambda df: sorted(map(str, df.collect()))
    assert key(D.contamination_digest(docs, bench, max_block_bytes=150)) == key(D.contamination_digest(docs, bench))
    assert key(D.match_items(docs, bench, max_block_bytes=150)) == key(D.match_items(docs, bench))
    kept = D.without_contaminated(docs, bench, max_block_bytes=150)
    assert kept.schema == docs.schema and key(kept) == key(D.without_contaminated(docs, bench))


def test_a_block_of_items_stays_small_in_memory():
    import tracemalloc

    rng = random.Random(1)
    vocabulary = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 9))).encode() for _ in range(20_000)]
    items, size = [], 0
    while size < D.MAX_BLOCK_BYTES:
        text = rng.choices(vocabulary, k=120)
        items.append((str(len(items)), text))
        size += sum(map(len, text)) + 120
    tracemalloc.start()
    D.SuffixAutomaton(items)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 400 << 20
