"""Distributed dense numbering."""

import json
import os

from pyspark.sql import functions as F

from hiremart.operators.numbering import dense_index, input_order_ids
from hiremart.sources.postings import read_lines, read_postings_jsonl


def test_dense_index_is_one_to_n_in_order(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7 % 5000).alias("k"), F.lit("x").alias("pad"))
    out = dense_index(df, ["k"], "idx", num_partitions=7).collect()
    pairs = sorted((r.k, r.idx) for r in out)
    assert [p[1] for p in pairs] == list(range(1, 5001))


def test_dense_index_composite_key_with_nulls_first(spark):
    df = spark.createDataFrame([("b", None), ("a", "y"), ("a", None), ("b", "x")], "t string, v string")
    out = dense_index(df, ["t", "v"], "i").orderBy("i").collect()
    assert [(r.t, r.v, r.i) for r in out] == [("a", None, 1), ("a", "y", 2), ("b", None, 3), ("b", "x", 4)]


def test_input_order_ids_follow_lines_within_files(spark, scratch):
    d = os.path.join(scratch, "in")
    os.makedirs(d)
    key = "Tên công việc"
    for f, titles in [("part-0.jsonl", ["a1", "", "a3", "a4"]), ("part-1.jsonl", ["b1", "b2"])]:
        with open(os.path.join(d, f), "w") as fh:
            for t in titles:
                fh.write(json.dumps({key: t}, ensure_ascii=False) + "\n")
    out = read_postings_jsonl(spark, d).orderBy("job_id").collect()
    assert [r.job_id for r in out] == [1, 2, 3, 4, 5]            # dense, the blank title takes no id
    ids = {r.raw_title: r.job_id for r in out}
    assert ids["a1"] < ids["a3"] < ids["a4"] and ids["b1"] < ids["b2"]   # file order kept


def test_input_order_ids_depend_on_the_files_alone(spark, scratch):
    """Three files larger than a split; other split sizes and partition counts give the same ids."""
    d = os.path.join(scratch, "in")
    os.makedirs(d)
    for name, n in (("a", 3000), ("b", 900), ("c", 5000)):
        with open(os.path.join(d, f"{name}.txt"), "w") as fh:
            fh.writelines(f"{name}-{k:05d}\n" for k in range(n))
    seen = []
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("7k", "13k", "1m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            rows = input_order_ids(read_lines(spark, d), "n").collect()
            seen.append([r.line for r in sorted(rows, key=lambda r: r.n)])
            assert sorted(r.n for r in rows) == list(range(1, 8901))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert seen[0] == sorted(seen[0]) and seen[0] == seen[1] == seen[2]


def test_building_numbered_frames_leaves_nothing_cached(spark):
    dense_index(spark.range(50).select("id"), ["id"], "i").count()
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0


def test_dense_index_keeps_a_callers_cache(spark):
    df = spark.range(0, 100).select((F.col("id") * 3).alias("k")).persist()
    df.count()
    dense_index(df, ["k"], "i")
    assert df.storageLevel.useMemory or df.storageLevel.useDisk
    df.unpersist()
