"""T14 by whole words, and the composing step of T8."""

import itertools
import re
import unicodedata

import pytest
from helpers import column, one_col

from hiremart.functions import provinces as PV
from hiremart.functions import text as TX
from hiremart.operators.classify import word_label_table
from hiremart.plans.location import location_labels

CASES = {
    "Johnson Plaza": "UNKNOWN", "Vĩnh Phúc": "VINH PHUC", "Hà Nội": "HA NOI", "HN": "HA NOI", "Thủ Đức": "TP HO CHI MINH", "Quận 7": "TP HO CHI MINH",
    "q.12": "TP HO CHI MINH", "q13": "UNKNOWN", "district 09": "TP HO CHI MINH", "Hà Nội | Đà Nẵng": "DA NANG", "Úc": "OVERSEAS", "Tokyo, Japan": "OVERSEAS",
    "Đức Phổ": "QUANG NGAI", "": "UNKNOWN", "n/a": "UNKNOWN", "Bà Rịa - Vũng Tàu": "BA RIA - VUNG TAU", "hue\ndanang": "DA NANG", "…Huế…": "THUA THIEN HUE", "xhue": "UNKNOWN",
    "bên " * 5000 + "huế": "THUA THIEN HUE",
}


def test_whole_words_only(spark):
    df = one_col(spark, list(CASES) * 2, "loc_key")
    got = {r.loc_key: r.p for r in word_label_table(df, "loc_key", "p").collect()}
    assert got == CASES


def test_least_rule_number_wins_against_a_plain_loop(spark):
    names = [k for r in PV.LOCATION_RULES for k in r.keywords][::7]
    texts = [f"{a}, {b}" for a, b in itertools.islice(itertools.combinations(names, 2), 0, None, 11)]
    def plain(text):
        words = " " + " ".join(re.findall(r"\w+", text)) + " "
        for r in PV.LOCATION_RULES:
            if any(" " + " ".join(re.findall(r"\w+", k)) + " " in words for k in r.keywords):
                return r.label
        return "UNKNOWN"
    got = {r.loc_key: r.province_name for r in location_labels(one_col(spark, texts, "loc_key"), match="word").collect()}
    assert got == {t: plain(t) for t in texts}


def test_substring_stays_the_default(spark):
    df = one_col(spark, ["Johnson Plaza", "Vĩnh Phúc"], "loc_key")
    assert {r.loc_key: r.province_name for r in location_labels(df).collect()} == {"Johnson Plaza": "HA NOI", "Vĩnh Phúc": "OVERSEAS"}
    with pytest.raises(ValueError):
        location_labels(df, match="prefix")


def test_keyword_table_is_bounded():
    table = PV.word_keywords()
    assert 400 < len(table) < 1000 and table["uc"] == 1 and table["q 7"] == table["quan 07"] and "q. 7" not in table


def test_every_letter_and_order_of_marks_composes(spark):
    letters = "".join(chars for _, chars in TX.ACCENT_FAMILIES)
    texts, want = [], []
    for c in letters + letters.upper():
        base, *marks = unicodedata.normalize("NFD", c)
        for order in itertools.permutations(marks):
            texts.append(base + "".join(order))
            want.append(c)
        for m in marks:
            rest = "".join(x for x in marks if x != m)
            texts.append(unicodedata.normalize("NFC", base + m) + rest)
            want.append(c)
    assert column(one_col(spark, texts).select(TX.compose_accents("v"))) == want


def test_other_text_is_left_alone_and_folds_like_composed(spark):
    texts = ["plain", "e\u0327", "\u0301x", "n\u0303", "a\u0301\u0302\u0327", "線\u3099", "", None, "Vi\u0302\u0323t Nam\nHa\u0300 No\u0323\u0302i", "o\u031b\u0309" * 20000]
    got = column(one_col(spark, texts).select(TX.compose_accents("v")))
    assert got == [*texts[:8], "Vi\u0302\u0323t Nam\nHà Nội", "ở" * 20000]  # i takes no circumflex
    composed = ["Hà Nội", "TP. Hồ Chí Minh", "Đắk Lắk", "Thừa Thiên Huế", "Mỹ Tho"]
    apart = [unicodedata.normalize("NFD", t) for t in composed]
    assert column(one_col(spark, apart).select(TX.clean_location("v", compose=True))) == column(one_col(spark, composed).select(TX.clean_location("v")))
