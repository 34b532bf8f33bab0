"""Ordered location rules, codes and flags (FIXTURES.md §3.1)."""

from pyspark.sql import functions as F

from helpers import one_col
from hiremart.functions.provinces import LOCATION_RULES, PROVINCE_CODES, PROVINCE_RULES
from hiremart.operators.classify import classify_distinct, label_table, location_flags, province_code, rule_chain
from hiremart.functions.text import clean_location

LOCATIONS = [
    (None, "UNKNOWN", 0), ("", "UNKNOWN", 0), ("Không hiển thị", "UNKNOWN", 0),
    ("Negotiable", "UNKNOWN", 0), ("Tokyo, Japan", "OVERSEAS", -1), ("Hà Nội", "HA NOI", 24),
    ("TP. Hồ Chí Minh", "TP HO CHI MINH", 58), ("Quận 7", "TP HO CHI MINH", 58),
    ("Đà Nẵng", "DA NANG", 15), ("Hải Phòng", "HAI PHONG", 27), ("Vĩnh Phúc", "OVERSEAS", -1),
    ("Thủ Đức", "OVERSEAS", -1), ("Vĩnh Long", "NGHE AN", 40), ("Trà Vinh", "NGHE AN", 40),
    ("Long Hồ", "VINH LONG", 61), ("Tân Uyên, Bình Dương", "LAI CHAU", 34), ("Bình Dương", "BINH DUONG", 9),
    ("Hà Nội | Đà Nẵng", "DA NANG", 15), ("Đồng Văn, Hà Giang", "HA NAM", 23), ("Cần Thơ", "CAN THO", 13),
    ("Huế", "THUA THIEN HUE", 56), ("Johnson Plaza", "HA NOI", 24), ("Tây Ninh", "TAY NINH", 52),
    ("Somewhere else", "UNKNOWN", 0),
]


def test_rule_table_shape():
    assert len(LOCATION_RULES) == 65
    assert sum(r.n_alternatives() for r in LOCATION_RULES) == 456
    assert len(PROVINCE_RULES) == 63
    assert sorted(PROVINCE_CODES.values()) == list(range(1, 64))


def test_classifier_expected_values(spark):
    df = one_col(spark, [c[0] for c in LOCATIONS], "raw")
    out = df.select(rule_chain(clean_location("raw")).alias("p")).select("p", province_code("p").alias("code"))
    got = [(r.p, r.code) for r in out.collect()]
    assert got == [(c[1], c[2]) for c in LOCATIONS]


def test_flags(spark):
    df = one_col(spark, ["OVERSEAS", "UNKNOWN", "HA NOI"], "p")
    got = [tuple(r) for r in df.select(*location_flags("p")).collect()]
    assert got == [(1, 0), (0, 1), (0, 0)]


def test_distinct_label_table_preserves_rows(spark):
    raw = [c[0] for c in LOCATIONS] * 3
    df = one_col(spark, raw, "raw").withColumn("loc_key", F.coalesce("raw", F.lit("")))
    labels = label_table(df, "loc_key", rule_chain, "province", prepare=clean_location)
    joined = df.join(labels, "loc_key", "left")
    assert joined.count() == len(raw)                      # the classifier keeps every row
    assert labels.count() == len({r or "" for r in raw})   # one classification per distinct value
    assert joined.where(F.col("province").isNull()).count() == 0


def test_word_shadowing_is_reproduced(spark):
    # 'uc' (OVERSEAS) fires inside other names; 'vinh' (NGHE AN) inside others.
    df = one_col(spark, ["phuc yen", "ben luc", "vinh chau", "dong dang"], "raw")
    got = [r[0] for r in df.select(rule_chain(clean_location("raw"))).collect()]
    assert got == ["OVERSEAS", "OVERSEAS", "NGHE AN", "HA NOI"]


def test_classify_distinct_generic(spark):
    df = one_col(spark, ["Hà Nội", "Huế", "Hà Nội", "Đà Nẵng"], "k")
    out = classify_distinct(df, "k", rule_chain, "p", prepare=clean_location)
    assert sorted(r.p for r in out.collect()) == ["DA NANG", "HA NOI", "HA NOI", "THUA THIEN HUE"]
