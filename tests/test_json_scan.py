"""T2 in one scan: equal to the key-by-key extraction, evaluated once."""

import re

from helpers import one_col
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hiremart.functions import text as TX
from hiremart.schemas import POSTING_JSON_KEYS, RAW_TEXT_COLUMNS
from hiremart.sources.postings import parse_posting_lines, valid_postings

KEYS = ["a", "ab", "Kỹ năng"]
PIECES = ['"', '"a"', '"ab"', '"Kỹ năng"', ":", " : ", '""', '"x"', ", ", "7", "\n", "\r\n", "\u2028", "\x85", "\\", "{", "a", "ab"]


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=24).map("".join), min_size=40, max_size=80))
def test_one_scan_equals_key_by_key(spark, lines):
    df = one_col(spark, [*lines, None, ""])
    fields = {k: f"f{i}" for i, k in enumerate(KEYS)}
    got = TX.json_string_fields(df, F.col("v"), fields).collect()
    want = df.select("v", *[TX.extract_json_string("v", k).alias(n) for k, n in fields.items()]).collect()
    assert got == want


def test_key_inside_another_value_and_decoys(spark):
    lines = ['"a": "ab": "x"', '{"a": "1", "a": 7, "a": "2"}', '{"a": "1"\n"a": "2"}', '{"ab": "only"}', '{"a" \t:\x0b "ä "}']
    got = TX.json_string_fields(one_col(spark, lines), F.col("v"), {"a": "a", "ab": "b"}).collect()
    assert [(r.a, r.b) for r in got] == [("ab", "x"), ("2", None), ("1", None), (None, "only"), ("ä ", None)]


def test_a_filter_does_not_repeat_the_scan(spark):
    lines = one_col(spark, ["{}"], "line")
    plan = valid_postings(parse_posting_lines(lines))._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall("regexp_extract_all", plan)) == 1


def test_very_long_line(spark):
    long = "{" + ", ".join(f'"{k}": "{"é" * 50_000}{i}"' for i, k in enumerate(POSTING_JSON_KEYS)) + ', "pad": "' + "x" * 1_000_000 + '"}'
    got = parse_posting_lines(one_col(spark, [long], "line")).first()
    assert [got[c][-1] for c in RAW_TEXT_COLUMNS] == [str(i) for i in range(9)]
