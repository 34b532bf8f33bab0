"""T1-T10 text functions with the expected values of FIXTURES.md §3."""

from pyspark.sql import functions as F

from helpers import column, one_col
from hiremart.functions import text as TX
from hiremart.plans.postings import industry_id, industry_name

INDUSTRY_CASES = [
    # raw, industry marts name, requirement marts name, requirement id
    (None, "UNKNOWN", "UNKNOWN", "UNKNOWN"),
    ("   ", "UNKNOWN", "UNKNOWN", "UNKNOWN"),
    ("Không hiển thị", "UNKNOWN", "KHÔNG HIỂN THỊ", "KHNG_HIN_TH"),
    ("Kinh doanh", "KINH DOANH", "KINH DOANH", "KINH_DOANH"),
    ("Kế toán / Kiểm toán", "KẾ TOÁN", "KẾ TOÁN", "K_TON"),
    ("Công nghệ thông tin, Viễn thông", "CÔNG NGHỆ THÔNG TIN", "CÔNG NGHỆ THÔNG TIN", "CNG_NGH_THNG_TIN"),
    ("Marketing > Digital", "MARKETING", "MARKETING", "MARKETING"),
    ("  Xây   dựng ", "XÂY DỰNG", "XÂY DỰNG", "XY_DNG"),
    ("/Logistics", "/LOGISTICS", "/LOGISTICS", "LOGISTICS"),
    ("Logistics", "LOGISTICS", "LOGISTICS", "LOGISTICS"),
    ("Ố", "Ố", "Ố", "UNKNOWN"),
    ("Y tế, Dược / Hóa", "Y TẾ", "Y TẾ", "Y_T"),
]


def test_industry_names_and_slugs(spark):
    df = one_col(spark, [c[0] for c in INDUSTRY_CASES], "raw")
    out = df.select(
        industry_name("raw", True).alias("m"),
        industry_name("raw", False).alias("r"),
    ).select("m", "r", industry_id("r").alias("id")).collect()
    assert [(r.m, r.r, r.id) for r in out] == [c[1:] for c in INDUSTRY_CASES]


def test_requirement_name_shortcut_equals_full_chain(spark):
    from hiremart.plans.postings import requirement_industry_name

    raws = [c[0] for c in INDUSTRY_CASES] + [" Không hiển thị", "Không hiển thị / X", "KHÔNG HIỂN THỊ"]
    df = one_col(spark, raws, "raw").select("raw", industry_name("raw", True).alias("m"))
    out = df.select(requirement_industry_name("raw", "m").alias("a"), industry_name("raw", False).alias("b")).collect()
    assert all(r.a == r.b for r in out)


def test_java_trim_strips_control_chars(spark):
    df = one_col(spark, ["\t\x01 a b \n", "   ", None, "x"])
    assert column(df.select(TX.java_trim("v"))) == ["a b", "", None, "x"]


def test_head_segment_rules(spark):
    df = one_col(spark, ["a/b/c", "/a", "abc", "UNKNOWN", "a,b>c", "x/y z", "x/y\u2028z"])
    got = column(df.select(TX.head_segments("v")))
    # the last one keeps its text: a line terminator follows the delimiter
    assert got == ["a", "/a", "abc", "UNKNOWN", "a", "x", "x/y\u2028z"]


def test_slug_deletes_accents(spark):
    df = one_col(spark, ["Kế toán", "  a  b ", "ÁÀ", "x-y_z 1"])
    assert column(df.select(TX.slug_or_unknown("v"))) == ["K_TON", "A_B", "UNKNOWN", "X-Y_Z_1"]


def test_fold_accents_and_separators(spark):
    df = one_col(spark, ["Hà Nội | Đà Nẵng", "Huế...x", "TP.\u00a0Hồ Chí Minh", "Quận 7…", None])
    assert column(df.select(TX.clean_location("v"))) == [
        "ha noi   da nang", "hue x", "tp. ho chi minh", "quan 7 ", "",
    ]


TOKEN_CASES = [
    (None, ["UNKNOWN"]),
    ("", ["UNKNOWN"]),
    ("SQL, Python", ["SQL", "PYTHON"]),
    ("C++; Java", ["C", "JAVA"]),
    ("/", []),
    ("Excel|Word[Office]", ["EXCEL", "WORD", "OFFICE"]),
    (" , ", []),
    ("a,  ,b", ["A", "UNKNOWN", "B"]),
    ("UNKNOWN", ["UNKNOWN"]),
]


def test_tokenize_character_set(spark):
    df = one_col(spark, [c[0] for c in TOKEN_CASES])
    got = [list(x) for x in column(df.select(TX.tokens("v")))]
    assert got == [c[1] for c in TOKEN_CASES]


def test_tokenize_explode_drops_rows_without_tokens(spark):
    df = one_col(spark, ["/", "a;b", " , "])
    assert sorted(column(df.select(F.explode(TX.tokens("v"))))) == ["A", "B"]


def test_json_extraction_edge_cases(spark):
    key = "Tên công việc"
    lines = [
        '\ufeff{"Tên công việc": "Kế toán"}',                       # BOM (removed first)
        '{"Ngành nghề": "X"}',                                       # missing key
        '{"Tên công việc": "A", "Tên công việc": "B"}',              # last one wins
        '{"Tên công việc": "say \\"hi\\""}',                         # cut at first quote
        '{"Tên công việc": 5}',                                      # number -> NULL
        '{"Tên công việc" :   ""}',                                  # empty string stays ''
        '{"Tên công việc": "A", "Tên công việc": 7}',                # last *string* wins
    ]
    df = one_col(spark, lines)
    got = column(df.select(TX.extract_json_string(TX.strip_bom("v"), key)))
    assert got == ["Kế toán", None, "B", "say \\", None, "", "A"]


def test_extract_or_null(spark):
    df = one_col(spark, ["<title>x</title>", "none"])
    assert column(df.select(TX.extract_or_null("v", "<title>([^<]*)"))) == ["x", None]


def test_matches_anywhere_respects_line_terminators(spark):
    df = one_col(spark, ["ha noi", "x\nha noi", None])
    assert column(df.select(TX.matches_anywhere("v", "ha noi"))) == [True, False, None]


def test_matches_whole_is_anchored(spark):
    df = one_col(spark, ["3", "13", "3\n", None])
    assert column(df.select(TX.matches_whole("v", "[123]"))) == [True, False, False, None]


def test_json_parser_mode(spark):
    from hiremart.sources.postings import parse_posting_lines

    lines = one_col(spark, [
        '\ufeff{"Tên công việc": "say \\"hi\\"", "Kỹ năng": 5}',
        '{"Tên công việc": "A", "Tên công việc": "B"}',
        'not json',
    ], "line")
    regex = parse_posting_lines(lines, parser="regex").select("raw_title", "raw_skill").collect()
    json_ = parse_posting_lines(lines, parser="json").select("raw_title", "raw_skill").collect()
    assert [tuple(r) for r in regex] == [('say \\', None), ("B", None), (None, None)]
    assert json_[0].raw_title == 'say "hi"' and json_[0].raw_skill == "5"
    assert json_[2].raw_title is None
