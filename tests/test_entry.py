"""The driver contract: entry(), queries(), oracle_sql()."""

import __spark_entry__ as E


def test_entry_runs_with_stable_schema(spark):
    df = E.entry(spark)
    assert df.columns == ["industry_name", "total_jobs", "is_total"]
    rows = df.collect()
    assert rows[-1].industry_name == "TONG_TAT_CA"
    assert rows[-1].total_jobs == sum(r.total_jobs for r in rows[:-1])


def test_every_query_has_oracle_sql():
    assert set(E.QUERIES) <= set(E.oracle_sql())


def test_query_columns_match_oracle_columns(spark):
    import duckdb

    con = duckdb.connect()
    for t in ["orders", "customer", "nation", "part", "lineitem", "documents", "labels", "pages", "conversations"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('/root/testdata/sf0.001/{t}.parquet')")
    sql = E.oracle_sql()
    for name in ["industry_total", "ordered_rules", "requirement_totals", "feature_matrix", "share_pivot_top"]:
        spark_cols = sorted(E.queries()[name](spark, "/root/testdata/sf0.001").columns)
        duck_cols = sorted(d[0] for d in con.execute(sql[name]).description)
        assert spark_cols == duck_cols, name
