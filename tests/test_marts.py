"""M1-M12 on hand-made aggregate inputs shaped like the reference's marts,
"""

from pyspark.sql import functions as F

from hiremart.plans import marts as MA

BY_LOCATION = [
    # location_name, industry_name, total_jobs
    ("AN GIANG", "KINH DOANH", 4), ("AN GIANG", "NHÂN SỰ", 1), ("AN GIANG", "XÂY DỰNG", 1),
    ("AN GIANG", "ĐIỆN", 1), ("AN GIANG", "UNKNOWN", 9),
    ("HA NOI", "KINH DOANH", 10), ("HA NOI", "MARKETING", 6), ("HA NOI", "KẾ TOÁN", 6),
    ("HA NOI", "IT", 2), ("HA NOI", "LUẬT", 1), ("HA NOI", "Y TẾ", 1), ("HA NOI", "KHÔNG HIỂN THỊ X", 3),
    ("UNKNOWN", "KINH DOANH", 2),
]


def _by_location(spark):
    return spark.createDataFrame(BY_LOCATION, "location_name string, industry_name string, total_jobs long")


def test_province_total_drops_only_irrelevant_industries(spark):
    viz = MA.industry_by_location_viz(_by_location(spark))
    got = [tuple(r) for r in MA.province_total(viz).collect()]
    # UNKNOWN province stays; UNKNOWN and 'not displayed' industries go.
    assert got == [("HA NOI", 26), ("AN GIANG", 7), ("UNKNOWN", 2)]


def test_top5_ranks_by_count_then_name(spark):
    viz = MA.industry_by_location_viz(_by_location(spark))
    rows = MA.top_industries_by_province(viz, 5).where(F.col("province") == "HA NOI").collect()
    assert [(r.industry, r.rn) for r in rows] == [
        ("KINH DOANH", 1), ("KẾ TOÁN", 2), ("MARKETING", 3), ("IT", 4), ("LUẬT", 5),
    ]


def test_share_mart_and_invariants(spark):
    viz = MA.industry_by_location_viz(_by_location(spark))
    share = MA.province_industry_share(viz)
    ag = {(r.province, r.industry): r for r in share.collect()}
    assert ag[("AN GIANG", "KINH DOANH")].share == 4 / 7
    assert ag[("AN GIANG", "KINH DOANH")].province_job_count == 7
    sums = share.groupBy("province").agg(F.sum("share").alias("s")).collect()
    assert all(abs(r.s - 1.0) < 1e-12 for r in sums)
    top5 = MA.top_industries_by_province(viz, 5)
    assert top5.groupBy("province").count().agg(F.max("count")).first()[0] <= 5


def test_industry_total_known_and_sums(spark):
    totals = spark.createDataFrame(
        [("KINH DOANH", 16, 0), ("MARKETING", 6, 0), ("UNKNOWN", 9, 0), ("TONG_TAT_CA", 31, 1)],
        "industry_name string, total_jobs long, is_total long",
    )
    m1 = [tuple(r) for r in MA.industry_total_known(totals).collect()]
    assert m1 == [("KINH DOANH", 16), ("MARKETING", 6)]


def test_requirement_marts(spark):
    long = spark.createDataFrame(
        [
            ("exp", "A", "A", "1-3 NĂM", 3), ("exp", "B", "B", "1-3 NĂM", 2), ("exp", "A", "A", None, 4),
            ("type", "A", "A", "KHÁC / KHÔNG HIỂN THỊ", 5), ("type", "A", "A", "TOÀN THỜI GIAN", 1),
            ("skill", "A", "A", "SQL", 2), ("skill", "B", "B", "JAVA", 2), ("skill", "B", "B", "UNKNOWN", 7),
        ],
        "feature_type string, industry_id string, industry_name string, feature_value string, total_jobs long",
    )
    assert [tuple(r) for r in MA.requirement_mart(long, "exp").collect()] == [("1-3 NĂM", 5)]
    assert [tuple(r) for r in MA.requirement_mart(long, "type").collect()] == [("TOÀN THỜI GIAN", 1)]
    assert [tuple(r) for r in MA.requirement_mart(long, "skill").collect()] == [("JAVA", 2), ("SQL", 2)]


def test_chart_data(spark):
    viz = MA.industry_by_location_viz(_by_location(spark))
    marts = {
        "industry_total_known": spark.createDataFrame([("A", 3), ("B", 2)], "industry string, job_count long"),
        "province_total": MA.province_total(viz),
        "province_industry_share": MA.province_industry_share(viz),
        "requirement_skill_total_top500": spark.createDataFrame([("SQL", 2)], "skill string, job_count long"),
        "requirement_experience_total": spark.createDataFrame([("1-3 NĂM", 2)], "experience string, job_count long"),
        "requirement_education_total": spark.createDataFrame([("THPT", 2)], "education string, job_count long"),
        "requirement_employment_type_total": spark.createDataFrame([("X", 2)], "employment_type string, job_count long"),
    }
    charts = MA.chart_data(marts)
    heat = charts["province_industry_share_heatmap"]
    assert heat.columns[0] == "province" and heat.columns[-1] == "province_job_count"
    assert [r.province for r in heat.collect()] == ["HA NOI", "AN GIANG", "UNKNOWN"]
    assert [r.province for r in charts["province_total_top25"].collect()] == ["HA NOI", "AN GIANG", "UNKNOWN"]


def test_facts_table_gives_the_same_three_outputs(spark):
    import __spark_entry__ as E
    from hiremart.plans import industry as IN
    from hiremart.plans import location as LO

    e, labels = E._labelled(spark, "/root/testdata/sf0.001")
    facts = LO.location_industry_facts(e)

    def rows(df):
        return sorted(tuple(r) for r in df.collect())

    assert rows(IN.industry_totals_from_facts(facts)) == rows(IN.industry_totals(e))
    assert rows(LO.province_totals_from_facts(facts, labels)) == rows(LO.province_totals(e, labels))
    assert rows(IN.industry_by_location_from_facts(facts, labels)) == rows(IN.industry_by_location(e, labels))


def test_requirement_long_equals_row_level_counts(spark):
    import __spark_entry__ as E
    from hiremart.plans import requirements as RQ

    e = E._enriched(spark, "/root/testdata/sf0.001")
    for pig in (False, True):
        key = lambda t: tuple((x is None, str(x)) for x in t)
        fast = sorted((tuple(r) for r in RQ.requirement_long(e, pig).collect()), key=key)
        rows = RQ.requirement_items(e, pig).groupBy("feature_type", "industry_id", "industry_name", "feature_value").count()
        slow = sorted((tuple(r) for r in rows.select("feature_type", "industry_id", "industry_name", "feature_value", "count").collect()), key=key)
        assert fast == slow
