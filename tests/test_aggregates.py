"""Totals, ranking, shares, pivots."""

from pyspark.sql import functions as F

from hiremart.operators import aggregates as AG


def test_grand_total_first_and_last(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "k string")
    first = [tuple(r) for r in AG.with_grand_total(df, "k", "n", "ALL", total_first=True).collect()]
    assert first[0] == ("ALL", 4, 1)
    assert sorted(first[1:], key=str) == sorted([("a", 2, 0), ("b", 1, 0), (None, 1, 0)], key=str)
    last = [tuple(r) for r in AG.with_grand_total(df, "k", "n", "TOTAL", total_first=False).collect()]
    assert last[-1] == ("TOTAL", 4, 1) and last[0] == ("a", 2, 0)


def test_grand_total_of_empty_input_has_no_row(spark):
    df = spark.createDataFrame([], "k string")
    assert AG.with_grand_total(df, "k", "n", "ALL", total_first=True).count() == 0


def test_top_n_per_group_and_ties(spark):
    df = spark.createDataFrame(
        [("p", "x", 5), ("p", "y", 5), ("p", "z", 1), ("q", "x", 1)], "g string, item string, n long"
    )
    out = AG.top_n_per_group(df, ["g"], [F.desc("n"), F.asc("item")], 2).orderBy("g", "rn").collect()
    assert [(r.g, r.item, r.rn) for r in out] == [("p", "x", 1), ("p", "y", 2), ("q", "x", 1)]


def test_share_sums_to_one_and_guards_zero(spark):
    df = spark.createDataFrame([("p", "a", 1), ("p", "b", 3), ("q", "a", 0)], "g string, i string, n long")
    out = {(r.g, r.i): (r.total, r.share) for r in AG.share_of_group(df, ["g"], "n", "total").collect()}
    assert out[("p", "a")] == (4, 0.25) and out[("p", "b")] == (4, 0.75)
    assert out[("q", "a")] == (0, None)


def test_bar_top_n_drops_bad_values(spark):
    df = spark.createDataFrame([("a", "3"), ("b", "x"), (None, "9"), ("c", "3"), ("d", "1")], "l string, v string")
    out = [(r.l, r.v) for r in AG.bar_top_n(df, "l", "v", 2).collect()]
    assert out == [("a", 3.0), ("c", 3.0)]


def test_pivot_share_top_rows_and_columns(spark):
    rows = [("p1", "i1", 3, 4, 0.75), ("p1", "i2", 1, 4, 0.25), ("p2", "i1", 1, 1, 1.0), ("p3", "i3", 1, 1, 1.0)]
    df = spark.createDataFrame(rows, "province string, industry string, job_count long, province_job_count long, share double")
    out = AG.pivot_share(df, "province", "industry", "share", "province_job_count", "job_count", 2, 2)
    assert out.columns == ["province", "i1", "i2", "province_job_count"]
    got = [tuple(r) for r in out.collect()]
    assert got == [("p1", 0.75, 0.25, 4), ("p2", 1.0, 0.0, 1)]
