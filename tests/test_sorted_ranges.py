"""Sorted ranges, and the posting files written with them: as many as the rows need, in order."""

import glob

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from hiremart.operators import ordering


@pytest.mark.parametrize("rows", [2_000, 40_000])
def test_posting_files_grow_in_number_not_in_size(spark, scratch, monkeypatch, rows):
    monkeypatch.setattr(ordering, "RANGE_BYTES", 100_000, raising=False)
    monkeypatch.setattr(E, "_fresh", lambda _, name: f"{scratch}/{name}")
    key = (F.col("id") * 7919 % 40_009).alias("o_orderkey")
    orders = spark.range(0, rows, numPartitions=3).select(key, (F.col("id") % 50).alias("o_custkey"), F.lit("F").alias("o_orderstatus"))
    orders.write.parquet(f"{scratch}/orders.parquet")
    found = E.queries()["postings_files"](spark, scratch).orderBy("row_id").collect()
    files = sorted(glob.glob(f"{scratch}/postings/part-*"))
    sizes = []
    for f in files:
        with open(f, encoding="utf-8") as fh:
            sizes.append(sum(1 for _ in fh))
    assert sum(sizes) == rows and len(files) >= 5
    assert max(sizes) < 2_500  # about 100 bytes a row by estimate, ranges cut by a sample
    keys = sorted(k * 7919 % 40_009 for k in range(rows))
    kept = [k for k in keys if k % 5 < 2]  # the other titles are blank or null
    assert [r.row_id for r in found] == list(range(1, len(kept) + 1))
    assert [r.raw_title for r in found] == [["Kế toán trưởng", "  Sales  "][k % 5] for k in kept]


def test_ranges_keep_every_row_in_order(spark, monkeypatch):
    """Null and repeated keys: no row lost, each key in one range, ranges ascending."""
    monkeypatch.setattr(ordering, "RANGE_BYTES", 2_000)
    key = F.when(F.col("id") % 10 != 0, F.col("id") * 37 % 101)
    df = spark.range(0, 1000, numPartitions=3).select(key.alias("k"), "id")
    out = ordering.sorted_ranges(df, ["k"])
    rows = out.select("k", "id", F.spark_partition_id().alias("p"), F.monotonically_increasing_id().alias("m")).collect()
    assert sorted(r.id for r in rows) == list(range(1000))
    seen = [-1 if r.k is None else r.k for r in sorted(rows, key=lambda r: r.m)]
    assert seen == sorted(seen) and len({r.p for r in rows}) > 5
    assert all(len({r.p for r in rows if r.k == k}) == 1 for k in {r.k for r in rows})


def test_ranges_of_no_rows(spark):
    empty = spark.range(0).select("id")
    assert ordering.sorted_ranges(empty, ["id"], at_least=5).collect() == []
