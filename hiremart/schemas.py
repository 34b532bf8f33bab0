"""Schemas of the tables the pipeline reads and writes."""

from __future__ import annotations

from pyspark.sql import types as T

RAW_TEXT_COLUMNS = [
    "raw_title", "raw_ind", "raw_sec", "raw_loc", "raw_exp",
    "raw_req", "raw_skill", "raw_edu", "raw_type",
]

# The JSON keys of a raw posting, in the order of RAW_TEXT_COLUMNS.
POSTING_JSON_KEYS = [
    "Tên công việc", "Ngành nghề", "Lĩnh vực", "Địa điểm", "Số năm kinh nghiệm",
    "Yêu cầu công việc", "Kỹ năng", "Trình độ học vấn", "Loại hình làm việc",
]


def _s(name):
    return T.StructField(name, T.StringType(), True)


def _l(name):
    return T.StructField(name, T.LongType(), True)


JOB_BASE_CLEAN = T.StructType([_l("job_id")] + [_s(c) for c in RAW_TEXT_COLUMNS])

INDUSTRY_TOTAL = T.StructType([_s("industry"), _l("job_count")])

INDUSTRY_BY_LOCATION = T.StructType([_s("province"), _s("industry"), _l("job_count")])

REQUIREMENT_TOTAL = T.StructType([_s("industry_code"), _s("industry"), _s("value"), _l("job_count")])
