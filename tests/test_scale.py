"""Plan-level checks of the scale decisions (sized broadcast, pruning, spread)."""

import os

from pyspark.sql import functions as F

from hiremart.operators import materialize as M
from hiremart.operators.classify import label_table, rule_chain
from hiremart.functions.text import clean_location
from hiremart.plans.industry import industry_totals
from hiremart.plans.postings import enrich
from hiremart.schemas import JOB_BASE_CLEAN


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_broadcast_only_within_limits(spark):
    small = spark.range(10).withColumnRenamed("id", "k")
    big = spark.range(1000).withColumnRenamed("id", "k")
    within = big.join(M.broadcast_if_small(M.materialize(small)), "k")
    beyond = big.join(M.broadcast_if_small(M.materialize(small), max_rows=5), "k")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in _plan(within)
        assert "BroadcastHashJoin" not in _plan(beyond)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_size_estimate_counts_text_bytes(spark):
    df = spark.createDataFrame([("abc",), ("de",), (None,)], "s string")
    rows, nbytes = M.size_of(df)
    assert rows == 3 and nbytes == 3 * 16 + 5


def test_label_table_falls_back_to_shuffle_join_when_large(spark):
    df = spark.createDataFrame([("Hà Nội",), ("Huế",), ("Hà Nội",)], "loc_key string")
    spark.conf.set("hiremart.broadcast.maxRows", "1")          # a cluster operator's limit
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        labels = label_table(df, "loc_key", rule_chain, "p", prepare=clean_location)
        joined = df.join(labels, "loc_key", "left")
        assert "BroadcastHashJoin" not in _plan(joined)
        assert sorted(r.p for r in joined.collect()) == ["HA NOI", "HA NOI", "THUA THIEN HUE"]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("hiremart.broadcast.maxRows")


def test_readers_repartition_only_where_the_session_says_so(spark):
    narrow = spark.range(0, 100, numPartitions=2)
    assert M.repartitioned(narrow) is narrow
    spark.conf.set("hiremart.read.partitions", "8")
    try:
        assert M.repartitioned(narrow).rdd.getNumPartitions() == 8
    finally:
        spark.conf.unset("hiremart.read.partitions")


def test_columns_are_pruned_to_the_scan(spark, scratch):
    path = os.path.join(scratch, "job_base_clean")
    rows = [(i, "t", "Kinh doanh", None, "Hà Nội", None, None, None, None, None) for i in range(64)]
    spark.createDataFrame(rows, JOB_BASE_CLEAN).repartition(8).write.parquet(path)
    base = spark.read.parquet(path)
    plan = _plan(industry_totals(enrich(base)))
    read_schema = [l for l in plan.split("\n") if "ReadSchema" in l or "FileScan" in l]
    assert any("raw_ind" in l for l in read_schema)
    assert not any("raw_skill" in l or "raw_title" in l for l in read_schema)


def test_filters_reach_the_parquet_scan(spark, scratch):
    path = os.path.join(scratch, "t")
    spark.range(100).select(F.col("id").alias("job_id"), F.lit("x").alias("raw_title")).write.parquet(path)
    plan = _plan(spark.read.parquet(path).where(F.col("job_id") > 50).select("raw_title"))
    assert "PushedFilters: [IsNotNull(job_id), GreaterThan(job_id,50)]" in plan


def test_numbered_rows_are_read_from_the_written_copy(spark, scratch):
    from hiremart.sources.postings import read_postings_jsonl

    with open(os.path.join(scratch, "a.jsonl"), "w", encoding="utf-8") as fh:
        fh.write('{"Tên công việc": "x"}\n')
    plan = _plan(read_postings_jsonl(spark, scratch))
    assert "FileScan parquet" in plan and "FileScan text" not in plan


def test_no_shuffle_carries_a_whole_requirement_text(spark):
    from hiremart.plans.requirements import requirement_long

    rows = [(1, *["x"] * 9)]
    plan = _plan(requirement_long(enrich(spark.createDataFrame(rows, JOB_BASE_CLEAN))))
    exchanges = [line for line in plan.split("\n") if "Exchange" in line]
    assert exchanges and not any("raw_req" in line or "raw_skill" in line for line in exchanges)


def test_driver_plans_have_no_cartesian_or_fallback_joins(spark):
    import __spark_entry__ as E

    for name, fn in E.QUERIES.items():
        plan = _plan(fn(spark, "/root/testdata/sf0.001"))
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin"):
            assert bad not in plan, (name, bad)


def test_driver_plans_beyond_the_broadcast_limits(spark):
    """With every table above the limits, joins are shuffled and the results are the same."""
    import __spark_entry__ as E

    names = ["ordered_rules", "code_lookup", "feature_matrix", "count_by_two_keys", "left_join_default"]
    want = {n: sorted(map(str, E.queries()[n](spark, "/root/testdata/sf0.001").collect())) for n in names}
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "hiremart.broadcast.maxRows": "1", "hiremart.broadcast.maxBytes": "1"}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        for n in names:
            found = E.queries()[n](spark, "/root/testdata/sf0.001")
            bad = ["CartesianProduct", "NestedLoop"] + (["BroadcastHashJoin"] if n != "feature_matrix" else [])
            assert not any(b in _plan(found) for b in bad), n  # its ids broadcast one row per partition, by construction
            assert sorted(map(str, found.collect())) == want[n], n
    finally:
        for k in settings:
            spark.conf.unset(k)
