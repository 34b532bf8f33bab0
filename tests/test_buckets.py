"""T11-T13 buckets with FIXTURES.md §3.3 and §3.4 expected values."""

from helpers import column, one_col
from hiremart.functions import buckets as B

EXPERIENCE = [
    (None, "KHÔNG YÊU CẦU", "KHÔNG YÊU CẦU"),
    ("Không hiển thị", "KHÔNG YÊU CẦU", "KHÔNG YÊU CẦU"),
    ("Dưới 1 năm", "DƯỚI 1 NĂM", "DƯỚI 1 NĂM"),
    ("1 năm", "1-3 NĂM", "1-3 NĂM"),
    ("3", "1-3 NĂM", "1-3 NĂM"),
    ("5 - 10 năm", "3-5 NĂM", "3-5 NĂM"),
    ("7 năm", "TRÊN 5 NĂM", "TRÊN 5 NĂM"),
    ("10 năm", "TRÊN 5 NĂM", "TRÊN 5 NĂM"),
    ("0", "0", "0"),
    ("Trên 5 năm", "TRÊN 5 NĂM", None),
    ("Thỏa thuận", "THỎA THUẬN", None),
    ("15 - 100", "3-5 NĂM", "3-5 NĂM"),
]


def test_experience_sql_case(spark):
    df = one_col(spark, [e[0] for e in EXPERIENCE])
    assert column(df.select(B.experience_bucket("v"))) == [e[1] for e in EXPERIENCE]


def test_experience_reference_null_rule(spark):
    df = one_col(spark, [e[0] for e in EXPERIENCE])
    assert column(df.select(B.experience_bucket("v", True))) == [e[2] for e in EXPERIENCE]


def test_experience_staged_equals_inline(spark):
    df = one_col(spark, [e[0] for e in EXPERIENCE])
    staged = B.with_experience(df, "v", "x", True)
    assert column(staged, "x") == [e[2] for e in EXPERIENCE]


EDUCATION = [
    (None, "KHÔNG YÊU CẦU"), ("Khác", "KHÔNG YÊU CẦU"), ("Không giới hạn", "KHÔNG YÊU CẦU"),
    ("Trung học cơ sở (Cấp 2) trở lên", "THCS"), ("Trung học", "THPT"), ("Cử nhân", "ĐẠI HỌC"),
    ("Đại học trở lên", "ĐẠI HỌC"), ("Thạc sĩ", "CAO HỌC"), ("Trung cấp trở lên", "TRUNG CẤP"),
    ("Cao đẳng", "CAO ĐẲNG"), ("Cao đẳng trở lên", "CAO ĐẲNG TRỞ LÊN"),
]
EMPLOYMENT = [
    (None, "KHÁC / KHÔNG HIỂN THỊ"), ("Khác", "KHÁC / KHÔNG HIỂN THỊ"),
    ("Toàn thời gian cố định", "TOÀN THỜI GIAN"), ("Toàn thời gian", "TOÀN THỜI GIAN"),
    ("Toàn thời gian tạm thời", "TOÀN THỜI GIAN"), ("Bán thời gian", "BÁN THỜI GIAN"),
    ("Hợp đồng thời vụ", "THỜI VỤ / HỢP ĐỒNG"), ("Thực tập", "THỰC TẬP"), ("Làm tại nhà", "LÀM TẠI NHÀ"),
]


def test_education(spark):
    df = one_col(spark, [e[0] for e in EDUCATION])
    assert column(df.select(B.education_level("v"))) == [e[1] for e in EDUCATION]


def test_employment_type(spark):
    df = one_col(spark, [e[0] for e in EMPLOYMENT])
    assert column(df.select(B.employment_type("v"))) == [e[1] for e in EMPLOYMENT]


def test_feature_type_codes(spark):
    df = one_col(spark, ["exp", "edu", "type", "skill", "req", "location", "other"])
    assert column(df.select(B.feature_type_code("v"))) == [1, 2, 3, 4, 5, 6, 0]
