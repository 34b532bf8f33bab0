"""Posting-list search against brute force."""

import numpy as np
import pytest

from hiremart.llm import vector_search as V

SCHEMA = "vec_id long, embedding array<float>, label int, score double, rank int, block long"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, 0.0, 1, 2) for i, v in rows], SCHEMA)


def brute(rows, k, every):
    rows = [(i, np.array(v, np.float32).astype(float)) for i, v in rows]
    out = {}
    for q, x in rows:
        if q % every == 0:
            found = sorted({(-float((v * x).sum()), i) for i, v in rows if i != q})
            out[q] = [(i, -s) for s, i in found[:k]]
    return out


def collected(found):
    out = {}
    for r in sorted(found.collect(), key=lambda r: (r.query_id, r["rank"])):
        assert r["rank"] == len(out.setdefault(r.query_id, [])) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return out


@pytest.mark.parametrize("scaled", [False, True])
def test_recall_and_exact_scores(spark, scaled):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(1500, 16))
    x[:600] = x[:6].repeat(100, 0) + 0.05 * x[:600]
    if scaled:
        x *= rng.uniform(0.2, 3, (1500, 1))
    rows = list(enumerate(x.tolist()))
    want, got = brute(rows, 20, 20), collected(V.nearest(frame(spark, rows)))
    assert want.keys() == got.keys()
    recall = [len({i for i, _ in want[q]} & {i for i, _ in got[q]}) / 20 for q in want]
    assert np.mean(recall) >= 0.9
    exact = dict(rows)
    for q, found in got.items():
        for i, s in found:
            assert s == pytest.approx(float(np.float32(exact[i]).astype(float) @ np.float32(exact[q]).astype(float)), abs=1e-12)


def test_few_rows_ties_and_unusable_vectors(spark):
    nan = float("nan")
    rows = [(0, [1.0, 0.0]), (3, [0.5, 0.5]), (2, [0.5, 0.5]), (1, [0.5, -9.0]), (1, [0.5, -9.0]), (20, [0.0, 2.0])]
    bad = [(40, None), (60, [0.0, 0.0]), (80, [nan, 1.0]), (100, [float("inf"), 0.0]), (120, [None, 1.0]), (140, [1.0, 2.0, 3.0]), (160, []), (None, [1.0, 1.0])]
    got = collected(V.nearest(frame(spark, rows + bad)))
    assert got == brute([r for r in rows], 20, 20)
    assert [i for i, _ in got[0]] == [1, 2, 3, 20]


def test_a_hot_vector_is_dealt_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(V, "BLOCK_ROWS", 50)
    monkeypatch.setattr(V, "QUERIES_PER_GROUP", 7)
    rows = [(k, [1.0, 2.0, 3.0]) for k in range(300)] + [(1000 + k, [float(k), 1.0, 0.0]) for k in range(100)]
    want, got = brute(rows, 20, 20), collected(V.nearest(frame(spark, rows)))
    for q in range(0, 300, 20):
        assert [s for _, s in got[q]] == pytest.approx([s for _, s in want[q]])
    assert got[0] == want[0]


def test_empty_table(spark):
    assert V.nearest(frame(spark, [])).collect() == []
    assert V.nearest(frame(spark, [(1, None)])).collect() == []
