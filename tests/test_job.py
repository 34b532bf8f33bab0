"""The whole batch job on a small JSON-lines fixture."""

import glob
import json
import os

import pytest

from hiremart.plans import marts as MA
from hiremart.plans.job import charts_from_exports, presentation_from_tables, run

K = ["Tên công việc", "Ngành nghề", "Lĩnh vực", "Địa điểm", "Số năm kinh nghiệm",
     "Yêu cầu công việc", "Kỹ năng", "Trình độ học vấn", "Loại hình làm việc"]

POSTINGS = [
    {K[0]: "Kế toán trưởng", K[1]: "Kế toán / Kiểm toán", K[2]: "Tài chính", K[3]: "Hà Nội", K[4]: "3 năm",
     K[5]: "Tiếng Anh", K[6]: "Excel, SAP", K[7]: "Đại học trở lên", K[8]: "Toàn thời gian"},
    {K[0]: "Sales", K[1]: "Kinh doanh", K[2]: "Không hiển thị", K[3]: "Quận 7", K[4]: "Dưới 1 năm",
     K[6]: "Bán hàng", K[7]: "Cao đẳng", K[8]: "Bán thời gian"},
    {K[0]: "  ", K[1]: "Kinh doanh", K[3]: "Hà Nội"},                     # dropped: blank title
    {K[0]: "Dev", K[1]: "Công nghệ thông tin, Viễn thông", K[3]: "Đà Nẵng", K[4]: "Trên 5 năm",
     K[6]: "Java; SQL", K[8]: "Khác"},
    {K[0]: "Sales", K[1]: "Kinh doanh", K[3]: "Hà Nội | Đà Nẵng", K[6]: "Không hiển thị"},
    {K[0]: "QA", K[1]: "", K[3]: "", K[6]: ""},                         # empty fields
]


def _write_input(scratch):
    d = os.path.join(scratch, "in")
    os.makedirs(d)
    with open(os.path.join(d, "a.jsonl"), "w", encoding="utf-8") as fh:
        for p in POSTINGS[:3]:
            fh.write("\ufeff" + json.dumps(p, ensure_ascii=False) + "\n")
    with open(os.path.join(d, "b.jsonl"), "w", encoding="utf-8") as fh:
        for p in POSTINGS[3:]:
            fh.write(json.dumps(p, ensure_ascii=False) + "\n")
    return d


def test_job_end_to_end(spark, scratch):
    out_dir = os.path.join(scratch, "out")
    exported = run(spark, _write_input(scratch), out_dir)
    rd = lambda n: spark.read.parquet(os.path.join(out_dir, n))

    base = rd("job_base_clean").orderBy("job_id").collect()
    assert [r.job_id for r in base] == [1, 2, 3, 4, 5]
    assert [r.raw_title for r in base] == ["Kế toán trưởng", "Sales", "Dev", "Sales", "QA"]

    # The empty skill counts as "with skills": the profile sees values as parsed.
    dq = rd("data_quality_stats").first()
    assert (dq.total_jobs, dq.jobs_with_sector, dq.jobs_with_skills, dq.jobs_with_requirement) == (5, 1, 4, 1)

    prov = [tuple(r) for r in rd("final_63_provinces_total").collect()]
    assert prov[0] == ("=== TONG CONG (ALL) ===", 5)
    assert sorted(prov[1:]) == [("DA NANG", 2), ("HA NOI", 1), ("TP HO CHI MINH", 1), ("UNKNOWN", 1)]

    ind = [tuple(r) for r in rd("industry_total").collect()]
    assert ind[-1] == ("TONG_TAT_CA", 5) and ind[0] == ("KINH DOANH", 2)

    log = {r.job_id: (r.province_id, r.province_name) for r in rd("log_location").collect()}
    assert log == {1: (24, "HA NOI"), 2: (58, "TP HO CHI MINH"), 3: (15, "DA NANG"), 4: (15, "DA NANG"), 5: (0, "UNKNOWN")}

    m = rd("mahout_features")
    assert m.where("industry_idx < 1").count() == 0
    # The NULL experience bucket ('Trên 5 năm' under the reference's CASE
    # rule) never matches the value index: its index defaults to 0.
    assert [tuple(r) for r in m.where("feature_value_idx = 0").select("feature_type_idx", "feature_count").collect()] == [(1, 1)]
    n_features = sum(spark.read.parquet(os.path.join(out_dir, f"requirement_analysis/{k}_total")).count()
                     for k in ["exp", "skill", "req", "edu", "type"])
    assert m.count() == n_features + rd("industry_by_location").count()

    parts = glob.glob(os.path.join(exported["requirement_experience_total"], "part-*"))
    exp_csv = [line for k, f in enumerate(parts) for line in open(f, encoding="utf-8").read().splitlines()[1 if k else 0:]]
    # 'Trên 5 năm' becomes NULL under the reference's CASE rule and is dropped.
    assert exp_csv[0] == "experience,job_count"
    assert sorted(exp_csv[1:]) == ["1-3 NĂM,1", "DƯỚI 1 NĂM,1", "KHÔNG YÊU CẦU,2"]
    assert os.path.isdir(os.path.join(out_dir, "ten_tinh", "key=HA NOI"))
    assert os.path.isdir(os.path.join(out_dir, "industry_province_titles", "key=DA_NANG"))


def test_job_tsv_tables(spark, scratch):
    out_dir = os.path.join(scratch, "out")
    run(spark, _write_input(scratch), out_dir, table_format="tsv", export_format="parquet", show=5)
    lines = spark.read.text(os.path.join(out_dir, "industry_total")).collect()
    assert lines[-1].value == "TONG_TAT_CA\t5"
    dq = spark.read.text(os.path.join(out_dir, "data_quality_stats")).first().value
    assert dq == "Data_Quality_Report\t5\t1\t4\t1"
    # the posting with an empty industry is UNKNOWN and leaves the viz marts
    assert spark.read.parquet(os.path.join(out_dir, "viz", "province_total")).count() == 3


def test_left_join_default(spark):
    from hiremart.operators.joins import left_join_default

    left = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "job_id long, t string")
    right = spark.createDataFrame([(1, "HA NOI"), (None, "X")], "job_id long, province_name string")
    for small in (False, True):
        out = left_join_default(left, right, ["job_id"], {"province_name": "UNKNOWN"}, small_right=small)
        assert sorted((r.t, r.province_name) for r in out.collect()) == [("a", "HA NOI"), ("b", "UNKNOWN"), ("c", "UNKNOWN")]


def test_presentation_only_over_reference_layout_tables(spark, scratch):
    from hiremart.plans.job import presentation_from_tables

    def table(name, lines):
        d = os.path.join(scratch, "tables", name)
        os.makedirs(d)
        with open(os.path.join(d, "part-m-00000"), "w", encoding="utf-8") as fh:
            fh.write("".join(line + "\n" for line in lines))

    table("industry_total", ["KINH DOANH\t5", "UNKNOWN\t2", "MARKETING\t3", "TONG_TAT_CA\t10"])
    table("industry_by_location", [
        "HA NOI\tKINH DOANH\t3", "HA NOI\tMARKETING\t1", "HA NOI\tUNKNOWN\t2", "DA NANG\tKINH DOANH\t2",
        "DA NANG\tMARKETING\t2",
    ])
    table("requirement_analysis/exp_total", ["KINH_DOANH\tKINH DOANH\t1-3 NĂM\t4", "UNKNOWN\tUNKNOWN\t\t3"])
    table("requirement_analysis/edu_total", ["KINH_DOANH\tKINH DOANH\tĐẠI HỌC\t5"])
    table("requirement_analysis/type_total", ["KINH_DOANH\tKINH DOANH\tKHÁC / KHÔNG HIỂN THỊ\t5"])
    table("requirement_analysis/skill_total", ["KINH_DOANH\tKINH DOANH\tSQL\t2", "MARKETING\tMARKETING\tSQL\t1"])
    out = presentation_from_tables(spark, os.path.join(scratch, "tables"), export_format="csv-single", show=3, chart_data=True)
    read = lambda n: open(out[n], encoding="utf-8").read().splitlines()
    assert read("industry_total") == ["industry,job_count", "KINH DOANH,5", "MARKETING,3"]
    assert read("province_total") == ["province,province_job_count", "DA NANG,4", "HA NOI,4"]
    assert read("requirement_experience_total") == ["experience,job_count", "1-3 NĂM,4"]
    assert read("requirement_employment_type_total") == ["employment_type,job_count"]
    assert read("requirement_skill_total_top500") == ["skill,job_count", "SQL,3"]
    share = read("province_industry_share")
    assert "HA NOI,KINH DOANH,3,4,0.75" in share
    heat = read("chart_province_industry_share_heatmap")
    assert heat[0] == "province,KINH DOANH,MARKETING,province_job_count"
    assert heat[1:] == ["DA NANG,0.5,0.5,4", "HA NOI,0.75,0.25,4"]
    assert read("chart_requirement_skill_top30") == ["skill,job_count", "SQL,3.0"]


def test_job_on_input_without_valid_postings(spark, scratch):
    d = os.path.join(scratch, "in")
    os.makedirs(d)
    with open(os.path.join(d, "a.jsonl"), "w", encoding="utf-8") as fh:
        fh.write(json.dumps({K[0]: "  ", K[1]: "Kinh doanh"}, ensure_ascii=False) + "\n")
        fh.write("not json at all\n")
    out_dir = os.path.join(scratch, "out")
    exported = run(spark, d, out_dir, chart_data=True, export_format="csv-single")
    rd = lambda n: spark.read.parquet(os.path.join(out_dir, n))
    assert rd("job_base_clean").count() == 0
    assert open(exported["chart_province_industry_share_heatmap"]).read().strip() == "province,province_job_count"
    assert rd("data_quality_stats").count() == 0          # no row, like a GROUP ALL over nothing
    assert rd("final_63_provinces_total").count() == 0
    assert rd("industry_total").count() == 0
    assert rd("mahout_features").count() == 0
    assert open(exported["province_total"], encoding="utf-8").read().strip() == "province,province_job_count"


def test_job_from_a_job_base_clean_table(spark, scratch):
    d = os.path.join(scratch, "job_base_clean")
    os.makedirs(d)
    rows = [
        ["7", "Kế toán", "Kế toán / Kiểm toán", "", "Hà Nội", "3 năm", "", "Excel", "Cử nhân", "Toàn thời gian"],
        ["9", "Dev", "Công nghệ thông tin", "", "Quận 1", "", "", "", "", ""],
    ]
    with open(os.path.join(d, "part-m-00000"), "w", encoding="utf-8") as fh:
        fh.write("".join("\t".join(r) + "\n" for r in rows))
    out_dir = os.path.join(scratch, "out")
    run(spark, d, out_dir, input_format="job_base_clean")
    log = {r.job_id: r.province_name for r in spark.read.parquet(os.path.join(out_dir, "log_location")).collect()}
    assert log == {7: "HA NOI", 9: "TP HO CHI MINH"}
    ind = [tuple(r) for r in spark.read.parquet(os.path.join(out_dir, "industry_total")).collect()]
    assert ind[-1] == ("TONG_TAT_CA", 2)
    assert not os.path.exists(os.path.join(out_dir, "data_quality_stats"))


def test_null_ids_follow_the_reference_counts(spark, scratch):
    # A job_base_clean row whose id is not a number loads with a NULL id: the
    # totals (counted by job_id) skip it but keep its province group, and the
    # industry side (joined on job_id) puts it under UNKNOWN.
    d = os.path.join(scratch, "job_base_clean")
    os.makedirs(d)
    rows = [
        ["1", "A", "Kinh doanh", "", "Hà Nội", "", "", "", "", ""],
        ["x", "B", "Kinh doanh", "", "Hà Nội", "", "", "", "", ""],
    ]
    with open(os.path.join(d, "part-m-00000"), "w", encoding="utf-8") as fh:
        fh.write("".join("\t".join(r) + "\n" for r in rows))
    out_dir = os.path.join(scratch, "out")
    run(spark, d, out_dir, input_format="job_base_clean")
    rd = lambda n: [tuple(r) for r in spark.read.parquet(os.path.join(out_dir, n)).collect()]
    assert rd("final_63_provinces_total") == [("=== TONG CONG (ALL) ===", 1), ("HA NOI", 1)]
    assert rd("industry_total") == [("KINH DOANH", 1), ("TONG_TAT_CA", 1)]
    assert rd("industry_by_location") == [("HA NOI", "KINH DOANH", 1), ("UNKNOWN", "KINH DOANH", 1)]


def test_console_profiles(spark, scratch, capsys):
    from hiremart.plans.job import Store, print_profiles

    out_dir = os.path.join(scratch, "out")
    run(spark, _write_input(scratch), out_dir, table_format="tsv", export_format="parquet")
    capsys.readouterr()
    print_profiles(Store(spark, out_dir, "tsv"), 5)
    text = capsys.readouterr().out
    for heading in ("Postings by industry", "Three leading industries of each province", "Fields per posting line", "Most frequent raw locations"):
        assert f"[{heading}]" in text
    assert "|10    |5    |" in text   # every line of job_base_clean has 10 fields


def test_marts_from_parquet_tables_need_the_right_format(spark, scratch):
    """Tables of another format are an error, never empty marts."""
    out_dir = os.path.join(scratch, "out")
    run(spark, _write_input(scratch), out_dir)
    with pytest.raises(ValueError):
        presentation_from_tables(spark, out_dir)
    found = presentation_from_tables(spark, out_dir, os.path.join(scratch, "again"), "parquet", table_format="parquet")
    assert spark.read.parquet(found["province_total"]).count() == 3


def test_exports_never_replace_the_tables(spark, scratch):
    out_dir = os.path.join(scratch, "out")
    with pytest.raises(ValueError):
        run(spark, _write_input(scratch), out_dir, export_dir=out_dir)


def test_stages_run_over_existing_tables(spark, scratch):
    out_dir = os.path.join(scratch, "out")
    assert run(spark, _write_input(scratch), out_dir, stages=["base"]) == {}
    assert run(spark, None, out_dir, stages=["location", "industry", "requirements"]) == {}
    before = sorted(map(str, spark.read.parquet(os.path.join(out_dir, "industry_total")).collect()))
    run(spark, None, out_dir, stages=["industry"])
    assert sorted(map(str, spark.read.parquet(os.path.join(out_dir, "industry_total")).collect())) == before
    run(spark, None, out_dir, stages=["features"])
    assert spark.read.parquet(os.path.join(out_dir, "mahout_features")).count() > 0
    found = run(spark, None, out_dir, stages=["presentation"], export_format="parquet")
    assert spark.read.parquet(found["province_total"]).count() == 3
    with pytest.raises(ValueError):
        run(spark, None, out_dir, stages=["nothing"])


def test_charts_from_exported_marts(spark, scratch):
    out_dir = os.path.join(scratch, "out")
    assert charts_from_exports(spark, os.path.join(scratch, "absent")) == {}
    run(spark, _write_input(scratch), out_dir, chart_data=True)
    viz = os.path.join(out_dir, "viz")
    found = charts_from_exports(spark, viz)
    assert set(found) == {chart for chart, _ in MA.CHART_SOURCES.values()}
    rows = spark.read.option("header", "true").csv(found["province_total_top25"]).collect()
    assert len(rows) == 3


def test_console_prints_every_province(spark, scratch, capsys):
    out_dir = os.path.join(scratch, "out")
    run(spark, _write_input(scratch), out_dir, show=1)
    text = capsys.readouterr().out
    leading = text.split("[Three leading industries of each province]")[1].split("[")[0]
    by_province = spark.read.parquet(os.path.join(out_dir, "industry_by_location")).where("industry_name <> 'UNKNOWN'")
    for r in by_province.select("location_name").distinct().collect():
        assert r[0] in leading
    assert "20 most frequent" in text and "Postings, some rows" in text
