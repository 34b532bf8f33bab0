"""U2, summing opt-in: equal cells added up, in bounded sparse rows; the default keeps its rows."""

from hiremart.plans import features as FT

SCHEMA = "industry_idx long, feature_type_idx long, feature_value_idx long, feature_count long"


def test_cells_are_summed_sorted_and_cut_into_blocks(spark):
    rows = [(1, 6, 9, 4), (1, 6, 9, 5), (1, 1, 2, 1), (-1, 4, 0, 3), (-1, 5, 0, 2), (-1, 4, 0, 1), (1, 4, 10, 7), (1, 4, 25, 1)]
    matrix = spark.createDataFrame(rows, SCHEMA)
    got = {(r.industry_idx, r.block): [tuple(c) for c in r.cells] for r in FT.sparse_rows(matrix, width=10).collect()}
    assert got == {(1, 0): [(2, 1, 1), (9, 6, 9)], (1, 1): [(10, 4, 7)], (1, 2): [(25, 4, 1)], (-1, 0): [(0, 4, 4), (0, 5, 2)]}
    assert FT.sparse_rows(spark.createDataFrame([], SCHEMA)).collect() == []


def test_the_default_matrix_keeps_rows_that_fall_together(spark):
    merged = spark.createDataFrame([("K", "KẾ", "exp", "a", 1), ("K", "KẾT", "exp", "a", 2)], "industry_id string, industry_name string, feature_type string, feature_value string, total_jobs long")
    matrix = FT.feature_matrix(merged, FT.industry_index(merged), FT.feature_value_index(merged))
    assert matrix.count() == 2 and [r.feature_count for r in FT.summed_features(matrix).collect()] == [3]
