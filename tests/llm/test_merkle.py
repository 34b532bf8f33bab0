"""Merkle manifest against a plain loop."""

import hashlib
import random
import zlib

import duckdb
import pytest

from hiremart.llm import merkle as M
from hiremart.llm import queries

H = lambda t: hashlib.sha256(t.encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def climbed(digests):
    """Top digest, and the siblings (before, after) of every lowest node, level by level."""
    steps, at = [[] for _ in digests], list(range(len(digests)))
    while len(digests) > 1:
        for k, p in enumerate(at):
            run = digests[p - p % 3 : p - p % 3 + 3]
            steps[k].append(("".join(run[: p % 3]), "".join(run[p % 3 + 1 :])))
            at[k] = p // 3
        digests = [H("".join(digests[p : p + 3])) for p in range(0, len(digests), 3)]
    return digests[0], steps


def plain(rows):
    """Contract rows of (doc_id, source, lang, n_chars, text) rows."""
    trees = {}
    for r in rows:
        hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
        changed = (*r[:4], r[4].replace("\n", "")) if hit and r[4] is not None else r
        key = (r[1] is not None, (r[1] or "").encode())
        trees.setdefault(key, []).append((r[0] is not None, r[0] or 0, H("".join(map(field, r))), H("".join(map(field, changed))), r[0]))
    tops = []
    for key in sorted(trees):
        trees[key].sort(key=lambda x: x[:3])
        tops.append((key, *climbed([x[2] for x in trees[key]])))
    if not tops:
        return []
    root, trunk = climbed([t[1] for t in tops])
    out = []
    for (key, subroot, steps), above in zip(tops, trunk):
        for leaf, own in zip(trees[key], steps):
            folded = leaf[3]
            for before, after in own + above:
                folded = H(before + folded + after)
            out.append((leaf[4], leaf[2], subroot, root, H("".join(b + a for b, a in own + above)), folded, folded == root))
    return sorted(out, key=str)


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, tree string, place int, size int, digest string, steps int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "t", 1, 2, "d", 3) for r in rows], SCHEMA)


def found(docs):
    return sorted(map(tuple, M.manifest_digest(docs).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()), key=str)


@pytest.mark.parametrize("n, sources", [(1, 1), (4, 1), (60, 11), (300, 4)])
def test_equals_the_plain_loop(spark, n, sources):
    rng = random.Random(n)
    rows = [(k, f"s{min(rng.randrange(sources), rng.randrange(sources))}", rng.choice(["en", None, ""]), k * 3, "é\n" * rng.randint(0, 3)) for k in range(n)]
    assert found(frame(spark, rows)) == plain(rows)


def test_odd_rows(spark):
    rows = [(None, None, None, None, None), (None, None, None, None, None), (5, None, "en", 1, "a\nb"), (2, "", "en", None, ""), (2, "", "en", None, "\n"), (2, "", "en", None, "\n"),
            (-7, "ö", "a:b", 0, "1:x"), (8, "z", None, -4, "long text\n" * 200_000), (10**18, "Z", "", 2, "\r\n"), (4, "-", "-", 4, "-")]
    assert found(frame(spark, rows)) == plain(rows)
    assert found(frame(spark, [])) == []


def test_only_deleted_line_breaks_break_a_proof(spark):
    rows = [(k, "s", "en", 3, "a\nb" if k % 2 else "ab") for k in range(40)]
    got = {r[0]: r[6] for r in found(frame(spark, rows))}
    assert got == {k: not (k % 2 and zlib.crc32(str(k).encode()) % 2 == 0) for k in range(40)} and len(set(got.values())) == 2


def test_whole_table_and_sql_twin(spark):
    path = "/root/testdata/sf0.001/documents.parquet"
    docs = spark.read.parquet(path)
    got = found(docs)
    assert got == plain([tuple(r) for r in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()])
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}'")
    cursor = con.execute(queries.oracle_sql()["op11_merkle_manifest"])
    names = [c[0] for c in cursor.description]
    order = [names.index(c) for c in ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")]
    assert sorted((tuple(r[k] for k in order) for r in cursor.fetchall()), key=str) == got
