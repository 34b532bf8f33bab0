"""Queries that once did less than the whole job: all rows, all cells, all marts."""

from pyspark.sql import functions as F

import __spark_entry__ as E
from hiremart.plans import features as FT
from hiremart.plans import marts as MA

SF = "/root/testdata/sf0.001"


def test_merged_features_hold_every_posting_and_industry(spark):
    e = E._enriched(spark, SF)
    merged = E._merged(spark, SF)
    n = e.count()
    assert n > 0 and e.where("industry_name = 'LOGISTICS'").count() > 0
    per_kind = {r.feature_type: r.n for r in merged.groupBy("feature_type").agg(F.sum("total_jobs").alias("n")).collect()}
    assert [per_kind[k] for k in ("exp", "edu", "type", "location")] == [n] * 4  # one row of each kind a posting
    kinds = {r.feature_type for r in merged.where("industry_id = 'LOGISTICS'").select("feature_type").distinct().collect()}
    assert kinds == {"exp", "edu", "type", "skill", "req", "location"}


def test_location_rows_of_an_unmatched_name_get_the_unknown_industry(spark):
    long = spark.createDataFrame(
        [("exp", "IT", "IT", "1-3 NĂM", 3)],
        "feature_type string, industry_id string, industry_name string, feature_value string, total_jobs long",
    )
    by_location = spark.createDataFrame(
        [("HA NOI", "IT", 2), ("HUE", "LOGISTICS", 4)], "location_name string, industry_name string, total_jobs long"
    )
    merged = FT.merged_features(long, by_location)
    got = {tuple(r) for r in merged.where("feature_type = 'location'").collect()}
    assert got == {("IT", "IT", "location", "HA NOI", 2), ("UNKNOWN", "LOGISTICS", "location", "HUE", 4)}
    matrix = FT.feature_matrix(merged, FT.industry_index(merged), FT.feature_value_index(merged))
    assert sorted(tuple(r) for r in matrix.collect()) == [(1, 1, 1, 3), (1, 6, 2, 2), (2, 6, 3, 4)]


def test_heatmap_has_every_cell_within_the_charts_limits(spark):
    viz = E._by_location_viz(spark, SF)
    provinces = {r[0] for r in viz.select("province").distinct().collect()}
    industries = {r[0] for r in viz.select("industry").distinct().collect()}
    assert len(provinces) > 12 and len(industries) > 5
    cells = E.q_province_industry_heatmap(spark, SF).collect()
    assert len({r.province for r in cells}) == min(25, len(provinces))
    assert len({r.industry for r in cells}) == min(20, len(industries))
    assert len(cells) == min(25, len(provinces)) * min(20, len(industries))


def test_share_matrix_is_cut_at_its_limits_and_filled_with_zero(spark):
    rows = [(f"p{p:02}", f"i{i:02}", 100 - p - i) for p in range(30) for i in range(24) if (p + i) % 7]
    viz = spark.createDataFrame(rows, "province string, industry string, job_count long")
    heat = MA.chart_data({"province_industry_share": MA.province_industry_share(viz)})["province_industry_share_heatmap"]
    got = heat.collect()
    assert len(got) == 25 and len(heat.columns) == 22
    total = {p: sum(n for q, _, n in rows if q == p) for p, _, _ in rows}
    assert {r.province for r in got} == set(sorted(total, key=lambda p: (-total[p], p))[:25])
    count = {(p, i): n for p, i, n in rows}
    for r in got:
        for i in heat.columns[1:-1]:
            assert r[i] == count.get((r.province, i), 0) / total[r.province]
    assert any(r[i] == 0.0 for r in got for i in heat.columns[1:-1])


def test_skill_mart_is_a_query_of_its_own(spark):
    got = E.queries()["requirement_skill_total"](spark, SF)
    skills = E.q_tokenize_explode(spark, SF).groupBy("skill").count().where("skill <> 'UNKNOWN'")
    assert [tuple(r) for r in got.collect()] == [tuple(r) for r in skills.orderBy(F.desc("count"), "skill").limit(MA.SKILL_TOP_K).collect()]
    assert "LIMIT 500" in E.oracle_sql()["requirement_skill_total"]
