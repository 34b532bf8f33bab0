"""K2: a replacing write leaves the old target until the new one is complete; K4: one file from many parts."""

import csv
import glob
import os

import pytest
from pyspark.sql import functions as F

from hiremart.sources.writers import export, write_csv, write_parquet, write_per_key, write_single_csv, write_tsv


def broken(df):
    """``df``, failing in the last of its partitions after others have written."""
    return df.select(*df.columns).where(F.when(F.col("n") == 39, F.raise_error(F.lit("midway"))).otherwise(F.lit(True)).cast("boolean"))


def rows(spark, at):
    return spark.range(at, at + 40, numPartitions=8).select((F.col("id") - at).alias("n"), F.concat(F.lit("v"), "id").alias("v"))


WRITERS = {
    "tsv": (lambda df, p: write_tsv(df, p, mode="overwrite"), lambda s, p: s.read.text(p)),
    "per_key": (lambda df, p: write_per_key(df, p, "v"), lambda s, p: s.read.text(p)),
    "csv": (write_csv, lambda s, p: s.read.csv(p)),
    "single": (write_single_csv, lambda s, p: s.read.csv(p)),
    "parquet": (write_parquet, lambda s, p: s.read.parquet(p)),
}


@pytest.mark.parametrize("kind", WRITERS)
def test_a_failed_write_leaves_the_old_table(spark, scratch, kind):
    write, read = WRITERS[kind]
    path = os.path.join(scratch, "sub", kind)
    write(rows(spark, 0), path)
    before = sorted(map(tuple, read(spark, path).collect()), key=str)
    with pytest.raises(Exception, match="midway"):
        write(broken(rows(spark, 100)), path)
    assert sorted(map(tuple, read(spark, path).collect()), key=str) == before
    assert [x for x in os.listdir(os.path.dirname(path)) if not x.startswith(".")] == [kind]
    write(rows(spark, 100), path)
    after = sorted(map(tuple, read(spark, path).collect()), key=str)
    assert after != before and len(after) == len(before)
    assert [x for x in os.listdir(os.path.dirname(path)) if not x.startswith(".")] == [kind]


def test_a_table_may_be_replaced_by_what_is_read_from_it(spark, scratch):
    path = os.path.join(scratch, "t")
    write_parquet(rows(spark, 0), path)
    write_parquet(spark.read.parquet(path).where("n < 5"), path)
    assert spark.read.parquet(path).count() == 5


def test_a_target_that_cannot_be_renamed_stays(spark, scratch, monkeypatch):
    from hiremart.sources import writers as W

    path = os.path.join(scratch, "t")
    write_parquet(rows(spark, 0), path)
    real = W._file_system

    class Fs:
        def __init__(self, fs):
            self.fs = fs

        def rename(self, a, b):
            return False if ".new-" in str(a.toString()) else self.fs.rename(a, b)

        def __getattr__(self, name):
            return getattr(self.fs, name)

    def failing(spark, path):
        fs, make = real(spark, path)
        return Fs(fs), make

    monkeypatch.setattr(W, "_file_system", failing)
    with pytest.raises(OSError):
        write_parquet(rows(spark, 100), path)
    assert spark.read.parquet(path).where("v = 'v0'").count() == 1 and os.listdir(scratch) == ["t"]


def test_single_csv_keeps_the_order_of_many_parts(spark, scratch):
    df = spark.range(0, 5000, numPartitions=9).select(F.col("id").alias("n, or so"), F.concat(F.lit('a "q", '), F.col("id").cast("string"), F.lit("\n")).alias("text"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    path = export(df, scratch, "x", "csv-single")
    got = list(csv.reader(open(path, encoding="utf-8", newline="")))
    assert got[0] == ["n, or so", "text"] and got[1:] == [[str(k), f'a "q", {k}\n'] for k in range(5000)]
    assert not glob.glob(path + "*parts*")


def test_job_stage_survives_a_failed_rerun(spark, scratch):
    from hiremart.plans.job import Store

    store = Store(spark, scratch)
    store.write(rows(spark, 0), "t")
    with pytest.raises(Exception, match="midway"):
        store.write(broken(rows(spark, 7)), "t")
    assert store.read("t", None).count() == 40
