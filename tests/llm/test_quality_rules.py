"""Quality rules against a plain loop over the texts."""

import random
import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from hiremart.llm import queries, quality_rules as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_counts(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    seen = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    inside = {p for i in range(len(words) - 4) if seen[tuple(words[i : i + 5])] > 1 for p in range(i, i + 5)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside), len(lines)


def plain_bin(v):
    s = max(0, v.bit_length() - 6)
    return v >> s << s


def plain_fences(values, least):
    values = sorted(map(plain_bin, values))
    low, high = (next(v for k, v in enumerate(values) if 4 * (k + 1) >= q * len(values)) for q in (1, 3))
    spread = 3 * max(high - low, least)
    return low - spread, high + spread


def plain(rows, least_group):
    """(doc_id, counts, base_failed, kept) of (doc_id, text, lang, source) rows."""
    found = []
    for k, text, lang, source in rows:
        n, chars, symbols, dup, repeat, lines = c = plain_counts(text)
        failed = n < 10 or 100 * repeat > 20 * n
        found.append((k, lang, source, c, failed, None if failed else (1000 * chars // n, 1000 * symbols // n, 1000 * dup // lines, 1000 * repeat // n)))
    out = []
    for k, lang, source, c, failed, ratios in found:
        kept = False
        if not failed:
            for same in (lambda r: r[1:3] == (lang, source), lambda r: r[1] == lang, lambda r: True):
                group = [r[5] for r in found if not r[4] and same(r)]
                if len(group) >= least_group:
                    break
            limits = [plain_fences(v, least) for v, least in zip(zip(*group), (500, 50, 150, 60))]
            kept = all(v <= high for v, (_, high) in zip(ratios, limits)) and ratios[0] >= limits[0][0]
        out.append((k, *c, failed, kept))
    return sorted(out, key=str)


def check(docs, rows, least_group=50):
    got = Q.judged(docs, least_group=least_group).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "base_failed", "kept")
    assert sorted(map(tuple, got.collect()), key=str) == plain(rows, least_group)


def odd(rng, n):
    rows = []
    for k in range(n):
        words = [rng.choice(["été", "the", "of", "to", "in", "word"]) * rng.choice([1, 1, 1, 2]) for _ in range(rng.randint(0, 60))]
        if k % 9 == 0:
            words = [w + rng.choice(["***", "|", "&&"]) for w in words]
        text = "".join(w + rng.choice([" ", " ", " ", "\n", "\t", " \n\n", "\x0b"]) for w in words)
        rows.append((k, text * rng.choice([1, 1, 1, 2]), rng.choice(["en", "de", None]), rng.choice(["a", "a", "b", "c", None])))
    rows += [(None, "just ten words stand in this text and no more", "en", "a"), (900, None, "en", "a"), (901, "", None, None), (902, " \n\t", "fr", ""), (903, "x " * 9, "fr", "-")]
    return rows + [(904, "one two three four five " * 30, "en", "a"), (905, " ".join(f"w{i % 4001}" for i in range(40_000)), "en", "a"), (906, "l" * 500 + " " + "m " * 12, "en", "="), rows[3], rows[3]]


SCHEMA = "doc_id long, text string, lang string, source string, bin long, n long, ratio string, lk string, n_words string, limits int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 7, 7, "x", "y", "z", 1) for r in rows], SCHEMA)


@pytest.mark.parametrize("least_group", [50, 8, 1])
def test_odd_rows_equal_the_plain_loop(spark, least_group):
    rows = odd(random.Random(least_group), 150)
    check(frame(spark, rows), rows, least_group)


def test_whole_table_equals_the_plain_loop(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    check(docs, [tuple(r) for r in docs.select("doc_id", "text", "lang", "source").collect()])


def test_sql_twin(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.001/documents.parquet'")
    cursor = con.execute(queries.oracle_sql()["op12_quality_rules"])
    names = [c[0] for c in cursor.description]
    assert sorted(map(tuple, Q.judged(docs).select(*names).collect())) == sorted(cursor.fetchall())


def test_empty_table_and_all_failing(spark):
    assert Q.judged(frame(spark, [])).collect() == []
    rows = [(1, "short", "en", "a"), (2, None, None, None)]
    check(frame(spark, rows), rows)


def test_passing_keeps_whole_rows(spark):
    rows = odd(random.Random(3), 40)
    docs = frame(spark, rows)
    kept = Q.passing(docs)
    assert kept.columns == docs.columns or set(kept.columns) == set(docs.columns)
    assert {r.doc_id for r in kept.collect()} == {r[0] for r in plain(rows, 50) if r[-1] and r[0] is not None}


def test_sketches_merge_and_stay_within_a_bin(spark):
    values = [random.Random(1).randint(0, 10**6) for _ in range(3000)]
    got = spark.createDataFrame([(v,) for v in values], "v long").select("v", Q.bin_of(F.col("v")).alias("b")).collect()
    assert all(r.b == plain_bin(r.v) and r.b <= r.v <= r.b + r.b / 32 for r in got)


def test_junk_goes_and_clean_stays(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    got = Q.judged(docs).join(labels, "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()
    kept = {r.quality: r.kept for r in got}
    assert kept[1] > 0.95 and kept[0] < 0.1


def test_no_python_in_the_plan(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = Q.judged(docs)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan) and not re.search("Cartesian|NestedLoop", plan)
