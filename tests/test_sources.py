"""S2-S6 readers and K1-K5 writers: round trips in a scratch folder."""

import glob
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hiremart.schemas import JOB_BASE_CLEAN
from hiremart.sources.tables import read_ragged_tsv, read_tsv
from hiremart.sources.writers import export, write_per_key, write_tsv


def _write(path, lines):
    with open(path, "w", encoding="utf-8") as fh:
        fh.write("\n".join(lines) + "\n")


def test_tsv_reader_is_quote_free_and_pads_short_rows(spark, scratch):
    p = os.path.join(scratch, "t.tsv")
    _write(p, [
        '1\t"quoted\tInd\t\tloc\texp\treq\tskill\tedu\ttype',
        "2\tshort\tx",
        "abc\tbad id\t\t\t\t\t\t\t\t",
    ])
    rows = read_tsv(spark, p, JOB_BASE_CLEAN).collect()
    assert rows[0].raw_title == '"quoted' and rows[0].raw_ind == "Ind" and rows[0].raw_sec is None
    assert rows[1].job_id == 2 and rows[1].raw_ind == "x" and rows[1].raw_type is None
    assert rows[2].job_id is None and rows[2].raw_title == "bad id"


def test_ragged_reader_counts_fields(spark, scratch):
    p = os.path.join(scratch, "r.tsv")
    _write(p, ["\t".join(["1"] + ["f"] * 9), "\t".join(["2"] + ["f"] * 8), "\t".join(["x"] + ["f"] * 10)])
    df = read_ragged_tsv(spark, p, ["job_id", "title"] + [f"c{i}" for i in range(8)], id_col="job_id")
    rows = df.orderBy("_ncols").collect()
    assert [r._ncols for r in rows] == [9, 10, 11]
    assert [r.job_id for r in rows] == [2, 1, None]
    assert rows[0].c7 is None   # missing tenth field


def test_tsv_round_trip_keeps_nulls(spark, scratch):
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("n", T.LongType())])
    df = spark.createDataFrame([("x\ty", 1), (None, None), ('"q', 3)], schema)
    path = os.path.join(scratch, "out")
    write_tsv(df, path)
    with pytest.raises(Exception):
        write_tsv(df, path)                       # K1 refuses an existing target
    write_tsv(df, path, mode="overwrite")         # K2 replaces it
    back = spark.read.text(path).collect()
    assert sorted(r.value for r in back) == sorted(['x\ty\t1', '\t', '"q\t3'])


def test_write_per_key_keeps_the_column(spark, scratch):
    df = spark.createDataFrame([(1, "HA NOI", "x"), (2, "DA NANG", "y"), (3, "HA NOI", "z")], "id int, p string, raw string")
    path = os.path.join(scratch, "per_key")
    write_per_key(df, path, "p")
    folders = sorted(os.path.basename(d) for d in glob.glob(os.path.join(path, "key=*")))
    assert folders == ["key=DA NANG", "key=HA NOI"]
    lines = []
    for f in glob.glob(os.path.join(path, "key=HA NOI", "part-*")):
        lines += open(f).read().split("\n")
    assert sorted(x for x in lines if x) == ["1\tHA NOI\tx", "3\tHA NOI\tz"]


def test_export_single_csv_and_parquet(spark, scratch):
    df = spark.createDataFrame([("A", 2), ("B", 1)], "industry string, job_count long").repartition(3)
    target = export(df, scratch, "industry_total", "csv-single")
    assert target.endswith("industry_total.csv") and os.path.isfile(target)
    text = open(target, encoding="utf-8").read().splitlines()
    assert text[0] == "industry,job_count" and sorted(text[1:]) == ["A,2", "B,1"]
    ptarget = export(df, scratch, "industry_total", "parquet")
    assert spark.read.parquet(ptarget).count() == 2
    with pytest.raises(ValueError):
        export(df, scratch, "x", "json")


def test_export_empty_frame_writes_header(spark, scratch):
    df = spark.createDataFrame([], "skill string, job_count long")
    target = export(df, scratch, "empty", "csv-single")
    assert open(target).read().strip() == "skill,job_count"


def test_write_per_key_splits_a_hot_key(spark, scratch):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        df = spark.range(0, 60000, numPartitions=4).select(
            F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise((F.col("id") % 20).cast("string")).alias("k"),
            F.sha2(F.col("id").cast("string"), 256).alias("v"),
        )
        path = os.path.join(scratch, "skew")
        write_per_key(df, path, "k")
        assert len(glob.glob(os.path.join(path, "key=HOT", "part-*"))) > 1
        n = sum(1 for f in glob.glob(os.path.join(path, "key=*", "part-*")) for _ in open(f))
        assert n == 60000
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_single_csv_quotes_like_rfc4180(spark, scratch):
    import csv

    df = spark.createDataFrame([('a "b", c', 1), ("", 2), (None, 3)], "v string, n long")
    target = export(df, scratch, "q", "csv-single")
    rows = list(csv.reader(open(target, encoding="utf-8", newline="")))
    assert rows == [["v", "n"], ['a "b", c', "1"], ["", "2"], ["", "3"]]
