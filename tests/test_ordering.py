"""W1-W3 without repeated input, and O1, O2, O4 as places."""

import random
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hiremart.operators.numbering import dense_index, range_bounds, range_of
from hiremart.operators.ordering import placed


def test_the_input_is_evaluated_once(spark):
    """A counter in the input: one evaluation of each row, whatever the numbering reads."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.range(0, 20_000, numPartitions=5).mapInArrow(count, "id long")
    out = dense_index(df.select((F.col("id") * 7919 % 20_011).alias("k"), F.lit("pad").alias("pad")), ["k"], "i", num_partitions=6)
    assert sorted(r.i for r in out.collect()) == list(range(1, 20_001))
    assert seen.value == 20_000


def test_one_scan_of_the_copy_and_none_of_the_source(spark, scratch):
    path = f"{scratch}/source"
    spark.range(0, 5000).withColumn("pad", F.sha2(F.col("id").cast("string"), 256)).write.parquet(path)
    out = dense_index(spark.read.parquet(path), ["id"], "i")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert path not in plan and len(re.findall("FileScan parquet", plan)) == 1 and "rangepartitioning" not in plan


@pytest.mark.parametrize("n, ranges", [(0, 4), (1, 4), (3, 8), (5000, 1), (5000, 13)])
def test_numbers_follow_a_mixed_order_with_nulls(spark, n, ranges):
    rng = random.Random(n)
    rows = list({(rng.choice([None, "", "a", "á", "b" * 40]), rng.choice([None, -1, 0, 10**15]), k) for k in range(n)})
    df = spark.createDataFrame(rows, "t string, v long, k int")
    got = dense_index(df, ["t", "v", "k"], "i", num_partitions=ranges).orderBy("i").collect()
    want = sorted(rows, key=lambda r: (r[0] is not None, (r[0] or "").encode(), r[1] is not None, r[1] or 0, r[2]))
    assert [(r.t, r.v, r.k) for r in got] == want and [r.i for r in got] == list(range(1, n + 1))


def test_ranges_are_even_and_bounds_few(spark):
    df = spark.range(0, 50_000).select((F.col("id") * 7 % 50_000).alias("k"))
    bounds = range_bounds(df, 16)
    assert 10 <= len(bounds) <= 15
    sizes = [r["count"] for r in df.groupBy(range_of(["k"], df.schema, bounds).alias("p")).count().collect()]
    assert len(sizes) == len(bounds) + 1 and max(sizes) < 2 * 50_000 / 16


def test_binary_search_counts_bounds_not_above(spark):
    schema = T.StructType([T.StructField("k", T.LongType())])
    for n in range(0, 9):
        bounds = [(10 * k,) for k in range(n)]
        df = spark.createDataFrame([(v,) for v in range(-3, 95)], schema)
        got = {r.k: r.p for r in df.select("k", range_of(["k"], schema, bounds).alias("p")).collect()}
        assert got == {v: sum(b[0] <= v for b in bounds) for v in got}


def test_places_descending_and_ascending(spark):
    rows = [("b", 2), ("a", 2), ("c", 9), (None, 2), ("d", None)]
    got = placed(spark.createDataFrame(rows, "name string, n long"), ["-n", "name"]).orderBy("place").collect()
    assert [(r.name, r.n, r.place) for r in got] == [("c", 9, 1), (None, 2, 2), ("a", 2, 3), ("b", 2, 4), ("d", None, 5)]
    ascending = placed(spark.createDataFrame(rows, "name string, n long"), ["n", "name"]).orderBy("place").collect()
    assert [(r.name, r.n) for r in ascending] == [("d", None), (None, 2), ("a", 2), ("b", 2), ("c", 9)]
