"""op9_warc against its SQL twin, on the given pages and on odd rows."""

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def rows_of(names, found):
    at = [names.index(n) for n in sorted(names)]
    return sorted((tuple(r[i] for i in at) for r in found), key=str)


def odd_pages(spark, folder):
    big, other = "<p>é\r\n\r\n</p>" * 100, "x" * 1000
    rows = [(1, "a", big), (9, "b", big), (2, None, None), (3, "c", ""), (4, "d", "small"), (6, "e", "small"), (8, "f", other),
            (8, "g", other), (7, "h", other), (None, "i", other), (10, "j", "y" * 999), (11, "k", "y" * 999)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{folder}/pages.parquet")
    return folder, f"{folder}/pages.parquet/*.parquet"


@pytest.mark.parametrize("odd", [False, True])
def test_op9_matches_its_twin(spark, scratch, odd):
    folder, files = odd_pages(spark, scratch) if odd else (SF, f"{SF}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{files}')")
    found = con.execute(E.oracle_sql()["op9_warc"])
    names = [c[0] for c in found.description]
    df = E.queries()["op9_warc"](spark, folder)
    assert sorted(df.columns) == sorted(names)
    twin = rows_of(names, found.fetchall())
    assert len(twin) > 0 and rows_of(df.columns, map(tuple, df.collect())) == twin
