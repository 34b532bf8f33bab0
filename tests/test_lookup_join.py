"""J2, join form: hot keys dealt over parts, defaults, repeated lookup rows."""

import random

from pyspark.sql import functions as F

from hiremart.operators.joins import lookup_join


def plain(left, lookup, default):
    by = {}
    for k, v in lookup:
        by.setdefault(k, []).append(v)
    return sorted(((k, i, v if v is not None else default) for k, i in left for v in (by.get(k) if k is not None else None) or [None]), key=str)


def test_equals_a_plain_join(spark):
    rng = random.Random(1)
    left = [(rng.choice([None] * 6 + ["hot"] * 8 + [f"k{j}" for j in range(9)]), i) for i in range(3000)]
    lookup = [("hot", 1), ("hot", 2), ("k1", None), ("k2", 5), ("k3", 6), ("k3", 6), (None, 9), ("unused", 7)]
    a, b = spark.createDataFrame(left, "k string, i int"), spark.createDataFrame(lookup, "k string, v long")
    got = lookup_join(a, b, ["k"], {"v": -1})
    assert got.columns == ["k", "i", "v"] and got.schema["v"].dataType.simpleString() == "bigint"
    assert sorted(map(tuple, got.collect()), key=str) == plain(left, lookup, -1)


def test_empty_sides_and_two_keys(spark):
    a = spark.createDataFrame([("x", 1, "p"), ("x", None, "q")], "k string, j int, t string")
    b = spark.createDataFrame([("x", 1, 4)], "k string, j int, v int")
    assert sorted(map(tuple, lookup_join(a, b, ["k", "j"], {"v": 0}).collect()), key=str) == [("x", 1, "p", 4), ("x", None, "q", 0)]
    assert lookup_join(a.limit(0), b, ["k", "j"], {"v": 0}).collect() == []
    assert {r.v for r in lookup_join(a, b.limit(0), ["k", "j"], {"v": 0}).collect()} == {0}


def test_no_task_joins_a_whole_hot_key(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        left = spark.range(0, 60_000, numPartitions=4).select(F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.col("id")).cast("long").alias("k"), "id")
        lookup = spark.range(0, 60_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
        out = lookup_join(left, lookup, ["k"], {"v": -1})
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 60_000 and max(sizes) < 6_000
    finally:
        for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled"):
            spark.conf.unset(c)
        spark.conf.set("spark.sql.shuffle.partitions", "4")
