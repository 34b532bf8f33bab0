"""Requirement buckets as Column expressions.

The reference writes these as CASE chains.  Spark evaluates ``when`` with
SQL semantics (a NULL condition falls through to the next branch), while
the reference's dataflow language turns the whole CASE into NULL as soon as
one evaluated condition is NULL.  ``experience_bucket`` offers both.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import UNKNOWN, WS, col_, java_trim, matches_anywhere, unknown_if_blank

# --- Fixed values (must equal the reference's bucket labels and inputs) ---
EXP_NOT_REQUIRED_INPUTS = ["KHÔNG YÊU CẦU", "KHÔNG HIỂN THỊ", "UNKNOWN", "NULL"]
EXP_NOT_REQUIRED = "KHÔNG YÊU CẦU"
EXP_UNDER_1 = "DƯỚI 1 NĂM"
EXP_1_3 = "1-3 NĂM"
EXP_3_5 = "3-5 NĂM"
EXP_OVER_5 = "TRÊN 5 NĂM"

EDUCATION_MAP = [
    (["KHÔNG HIỂN THỊ", "UNKNOWN", "KHÔNG GIỚI HẠN", "KHÁC"], "KHÔNG YÊU CẦU"),
    (["TRUNG HỌC CƠ SỞ (CẤP 2) TRỞ LÊN"], "THCS"),
    (["TRUNG HỌC PHỔ THÔNG (CẤP 3) TRỞ LÊN", "TRUNG HỌC"], "THPT"),
    (["ĐẠI HỌC TRỞ LÊN", "CỬ NHÂN"], "ĐẠI HỌC"),
    (["CAO HỌC TRỞ LÊN", "THẠC SĨ"], "CAO HỌC"),
    (["TRUNG CẤP", "TRUNG CẤP TRỞ LÊN"], "TRUNG CẤP"),
]

EMPLOYMENT_TYPE_MAP = [
    (["TOÀN THỜI GIAN CỐ ĐỊNH", "TOÀN THỜI GIAN", "TOÀN THỜI GIAN TẠM THỜI"], "TOÀN THỜI GIAN"),
    (["BÁN THỜI GIAN"], "BÁN THỜI GIAN"),
    (["THỜI VỤ", "HỢP ĐỒNG THỜI VỤ"], "THỜI VỤ / HỢP ĐỒNG"),
    (["THỰC TẬP"], "THỰC TẬP"),
    (["KHÁC", "KHÔNG HIỂN THỊ", "UNKNOWN"], "KHÁC / KHÔNG HIỂN THỊ"),
]

# Feature-type codes of the integer feature matrix (anything else is 0).
FEATURE_TYPE_CODES = [("exp", 1), ("edu", 2), ("type", 3), ("skill", 4), ("req", 5), ("location", 6)]


def leading_digits(c) -> Column:
    """Digits at the start of TRIM(c) (NULL text counts as ''), else NULL."""
    t = java_trim(F.coalesce(col_(c), F.lit("")))
    return F.when(t.rlike("^[0-9]"), F.regexp_extract(t, "^([0-9]+)", 1))


def experience_bucket(c, null_propagates: bool = False) -> Column:
    """Eight-branch experience CASE on a raw text column.

    ``null_propagates=False``: SQL CASE semantics (the CASE as written).
    ``null_propagates=True``: a NULL digit test (text not starting with a
    digit) makes the result NULL unless one of the first two branches hit,
    which is how the reference's engine evaluates it.
    """
    return experience_from(unknown_if_blank(c), leading_digits(c), null_propagates)


def with_experience(df, src: str, out: str, null_propagates: bool = False):
    """T11 with the cleaned text and the digits staged as columns first."""
    df = df.withColumn("_exp_raw", unknown_if_blank(F.col(src))).withColumn("_exp_digits", leading_digits(F.col(src)))
    return df.withColumn(out, experience_from(F.col("_exp_raw"), F.col("_exp_digits"), null_propagates)).drop(
        "_exp_raw", "_exp_digits"
    )


def experience_from(raw: Column, digits: Column, null_propagates: bool = False) -> Column:
    """T11 from UPPER(TRIM(text)) (or 'UNKNOWN') and its leading digits."""
    first_two = raw.isin(*EXP_NOT_REQUIRED_INPUTS) | matches_anywhere(raw, EXP_UNDER_1)
    chain = (
        F.when(raw.isin(*EXP_NOT_REQUIRED_INPUTS), F.lit(EXP_NOT_REQUIRED))
        .when(matches_anywhere(raw, EXP_UNDER_1), F.lit(EXP_UNDER_1))
        .when(digits.rlike("^[123]$"), F.lit(EXP_1_3))
        .when(digits.rlike("^[45]$"), F.lit(EXP_3_5))
        .when(matches_anywhere(raw, "5" + WS + "*-" + WS + "*10"), F.lit(EXP_3_5))
        .when(digits.rlike("^[6-9]$|^[1-9][0-9]+$"), F.lit(EXP_OVER_5))
        .when(matches_anywhere(raw, "TRÊN" + WS + "*5"), F.lit(EXP_OVER_5))
        .when(raw == EXP_UNDER_1, F.lit(EXP_UNDER_1))
        .otherwise(raw)
    )
    if not null_propagates:
        return chain
    return F.when(first_two | digits.isNotNull(), chain)


def _mapped(raw: Column, table) -> Column:
    out = None
    for inputs, label in table:
        cond = raw.isin(*inputs)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out.otherwise(raw)


def education_level(c) -> Column:
    """Education bucket of UPPER(TRIM(c)); unlisted values pass through."""
    return _mapped(unknown_if_blank(c), EDUCATION_MAP)


def employment_type(c) -> Column:
    """Employment-type bucket; unlisted values pass through."""
    return _mapped(unknown_if_blank(c), EMPLOYMENT_TYPE_MAP)


def feature_type_code(c) -> Column:
    """Feature type name -> integer code (0 when unknown)."""
    c = col_(c)
    out = None
    for name, code in FEATURE_TYPE_CODES:
        out = F.when(c == name, F.lit(code)) if out is None else out.when(c == name, F.lit(code))
    return out.otherwise(F.lit(0)).cast("long")


__all__ = [
    "UNKNOWN",
    "experience_bucket",
    "education_level",
    "employment_type",
    "feature_type_code",
    "leading_digits",
]
