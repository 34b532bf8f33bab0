"""Copies of known size go in few files, whatever the number of partitions."""

from pyspark.sql import functions as F

from hiremart.llm import common, components


def test_small_copies_make_few_files(spark):
    rows = spark.range(0, 1000, 1, 40).withColumn("v", F.col("id") % 7)
    for spread in (False, True):
        copy = common.written(rows, "few", 16 * 1000, spread=spread)
        assert len(copy.inputFiles()) <= common.LEAST_FILES
        assert sorted(map(tuple, copy.collect())) == [(k, k % 7) for k in range(1000)]
    assert len(common.written(rows, "each").inputFiles()) == 40


def test_files_grow_with_the_size():
    assert common.files_for(0) == common.LEAST_FILES
    assert common.files_for(1000 * common.FILE_BYTES + 1) == 1001


def test_rounds_of_components_make_few_files(spark, monkeypatch):
    sizes = []
    plain = common.written

    def counted(df, name, *args, **options):
        copy = plain(df, name, *args, **options)
        sizes.append(len(copy.inputFiles()))
        return copy

    monkeypatch.setattr(components, "written", counted)
    before = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "60")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        edges = spark.range(0, 600).select("id", (F.col("id") + F.when(F.col("id") % 6 < 5, 1).otherwise(0)).alias("other"))
        found = {r.node: r.comp for r in components.components(edges, "id", "other").collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before[1])
    assert found == {k: k - k % 6 for k in range(600)}
    assert len(sizes) > 2 and max(sizes) <= common.LEAST_FILES
