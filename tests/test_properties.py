"""Spark expressions against plain-Python models of the reference semantics,
on generated strings (one Spark job per property)."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from helpers import one_col
from hiremart.functions import text as TX

ALPHABET = "ab /,>;|[]+\t\n\r\u2028\u00a0xyÉéếđ\"':{}5"
TEXTS = st.lists(st.text(alphabet=ALPHABET, max_size=14), min_size=50, max_size=120)
SETTINGS = settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
TERMINATORS = "\n\r\u0085\u2028\u2029"


def java_trim(s):
    i, j = 0, len(s)
    while i < j and ord(s[i]) <= 0x20:
        i += 1
    while j > i and ord(s[j - 1]) <= 0x20:
        j -= 1
    return s[i:j]


def head_model(s, d):
    if s == "UNKNOWN":
        return s
    # MATCHES '([^d]+).*': non-empty prefix without d, and Java's '.' must
    # consume the rest: no line terminator after the first d.
    if not s or s[0] == d:
        return s
    k = s.find(d)
    if k == -1:
        return s
    if any(ch in TERMINATORS for ch in s[k:]):
        return s
    return s[:k]


def tokens_model(s):
    if s is None or java_trim(s) == "":
        return ["UNKNOWN"]
    parts = re.split(r"[\[\],;/|+]", java_trim(s).upper())
    out = []
    for p in parts:
        if p == "":
            continue
        t = java_trim(p)
        out.append("UNKNOWN" if t == "" else t.upper())
    return out


def slug_model(s):
    t = java_trim(s).upper()
    t = re.sub(r"[ \t\n\x0b\f\r]+", "_", t)
    t = re.sub(r"[^A-Z0-9_-]", "", t)
    return t or "UNKNOWN"


@SETTINGS
@given(TEXTS)
def test_head_segment_model(spark, texts):
    df = one_col(spark, texts)
    for d in "/,>":
        got = [r[0] for r in df.select(TX.head_segment("v", d)).collect()]
        assert got == [head_model(s, d) for s in texts]


@SETTINGS
@given(TEXTS)
def test_tokens_model(spark, texts):
    df = one_col(spark, texts)
    got = [list(r[0]) for r in df.select(TX.tokens("v")).collect()]
    assert got == [tokens_model(s) for s in texts]


@SETTINGS
@given(TEXTS)
def test_slug_and_trim_model(spark, texts):
    df = one_col(spark, texts)
    got = df.select(TX.slug_or_unknown("v").alias("s"), TX.java_trim("v").alias("t")).collect()
    assert [r.s for r in got] == [slug_model(s) for s in texts]
    assert [r.t for r in got] == [java_trim(s) for s in texts]


KEYS = ["a", "bb"]
LINE_PARTS = st.lists(
    st.one_of(
        st.tuples(st.sampled_from(KEYS), st.text(alphabet='xy "\\', max_size=5)).map(
            lambda kv: '"%s": "%s"' % kv),
        st.tuples(st.sampled_from(KEYS), st.integers(0, 99)).map(lambda kv: '"%s": %d' % kv),
        st.text(alphabet='xy,{} \u2028"', max_size=6),
    ),
    max_size=6,
).map(lambda parts: "{" + ", ".join(parts) + "}")


def json_model(line, key):
    # find() of '.*"key"\s*:\s*"([^"]*)".*' : the first line segment (Java's
    # '.' stops at terminators) holding a match, and in it the last match.
    pat = re.compile('"' + key + '"[ \t\n\x0b\f\r]*:[ \t\n\x0b\f\r]*"([^"]*)"')
    for seg in re.split("[" + TERMINATORS + "]", line):
        found = None
        for i in range(len(seg)):
            m = pat.match(seg, i)
            if m:
                found = m.group(1)
        if found is not None:
            return found
    return None


@SETTINGS
@given(st.lists(LINE_PARTS, min_size=50, max_size=100))
def test_json_extraction_model(spark, lines):
    df = one_col(spark, lines)
    for key in KEYS:
        got = [r[0] for r in df.select(TX.extract_json_string("v", key)).collect()]
        assert got == [json_model(s, key) for s in lines], key


FRAGMENTS = ["", " ", "1", "3", "5", "7", "12", "0", " - ", "-", "10", "năm", "Năm", "trên", "Trên 5", "dưới 1 năm",
             "DƯỚI 1 NĂM", "không yêu cầu", "Không hiển thị", "null", "thỏa thuận", "\t", "\n", "\u2028", "x"]
EXP_TEXTS = st.lists(
    st.one_of(st.none(), st.lists(st.sampled_from(FRAGMENTS), max_size=4).map("".join)), min_size=60, max_size=120
)


def experience_model(raw, pig_nulls):
    t = java_trim(raw or "")
    r = "UNKNOWN" if raw is None or t == "" else t.upper()
    m = re.match("[0-9]+", t)
    digits = m.group(0) if m else None
    clean = not any(ch in TERMINATORS for ch in r)

    def anywhere(p):
        return clean and re.search(p, r) is not None

    if r in ("KHÔNG YÊU CẦU", "KHÔNG HIỂN THỊ", "UNKNOWN", "NULL"):
        return "KHÔNG YÊU CẦU"
    if anywhere("DƯỚI 1 NĂM"):
        return "DƯỚI 1 NĂM"
    if digits is None and pig_nulls:
        return None           # the reference's CASE turns NULL here
    if digits in ("1", "2", "3"):
        return "1-3 NĂM"
    if digits in ("4", "5"):
        return "3-5 NĂM"
    if anywhere("5[ \t\n\x0b\f\r]*-[ \t\n\x0b\f\r]*10"):
        return "3-5 NĂM"
    if digits is not None and (digits in "6789" and len(digits) == 1 or (len(digits) > 1 and digits[0] != "0")):
        return "TRÊN 5 NĂM"
    if anywhere("TRÊN[ \t\n\x0b\f\r]*5"):
        return "TRÊN 5 NĂM"
    return r


@SETTINGS
@given(EXP_TEXTS)
def test_experience_model(spark, texts):
    from hiremart.functions.buckets import experience_bucket

    df = one_col(spark, texts)
    got = df.select(experience_bucket("v").alias("a"), experience_bucket("v", True).alias("b")).collect()
    assert [r.a for r in got] == [experience_model(s, False) for s in texts]
    assert [r.b for r in got] == [experience_model(s, True) for s in texts]


PLACES = ["Hà Nội", "Vĩnh Phúc", "Quận 7", "Q.07", "district 12", "Huế", "Đà Nẵng", "Tân Uyên", "Bình Dương",
          "Trà Vinh", "Long Hồ", "Johnson", "Negotiable", "Tokyo", "Cần Thơ", "Đồng Văn", " | ", "...", "…", ", ",
          "\u00a0", "\n", " ", "xyz"]
LOC_TEXTS = st.lists(
    st.one_of(st.none(), st.lists(st.sampled_from(PLACES), max_size=3).map("".join)), min_size=60, max_size=120
)


def classify_model(raw):
    from hiremart.functions.provinces import LOCATION_RULES
    from hiremart.functions.text import ACCENT_FAMILIES

    fold = {ch: base for base, chars in ACCENT_FAMILIES for ch in chars}
    s = "".join(fold.get(ch, ch) for ch in (raw or "").lower())
    s = s.replace("\u00a0", " ").replace("|", " ").replace("...", " ").replace("…", " ")
    if s == "":
        return "UNKNOWN"
    if any(ch in TERMINATORS for ch in s):
        return "UNKNOWN"                       # Java's '.' cannot cross a line terminator
    for rule in LOCATION_RULES:               # first rule that occurs anywhere wins
        if re.search(rule.regex(), s):
            return rule.label
    return "UNKNOWN"


@SETTINGS
@given(LOC_TEXTS)
def test_location_classifier_model(spark, texts):
    from hiremart.functions.text import clean_location
    from hiremart.operators.classify import rule_chain

    df = one_col(spark, texts)
    got = [r[0] for r in df.select(rule_chain(clean_location("v"))).collect()]
    assert got == [classify_model(s) for s in texts]
