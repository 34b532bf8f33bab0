"""Ordered-rule classification over distinct values (T14 at scale).

A rule chain costs dozens of regex scans per row, yet free-text columns
such as locations repeat the same few values.  ``classify_distinct``
classifies each distinct key once and joins the labels back:

* the distinct step is a hash aggregate with map-side combine, so a key
  holding a third of all rows becomes one row per task before the shuffle;
* the label table is broadcast only after its size is measured; beyond the
  limit Spark plans a shuffle join, and AQE splits hot keys on the big side.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.provinces import (
    LOCATION_RULES, OTHER_CODE, OVERSEAS, PROVINCE_CODES, SPECIAL_CODES, UNKNOWN, Rule, word_keywords,
)
from ..functions.text import clean_location, col_, has_line_terminator
from .materialize import broadcast_if_small, materialize


def rule_chain(clean, rules: Sequence[Rule] = LOCATION_RULES, default: str = UNKNOWN) -> Column:
    """First rule whose pattern occurs in ``clean`` wins, else ``default``.

    Equal to a chain of ``MATCHES '.*(p).*'`` tests: NULL/'' is UNKNOWN, and
    a value with a line terminator matches no rule.
    """
    c = col_(clean)
    out = F.when(c.isNull() | (c == ""), F.lit(UNKNOWN)).when(has_line_terminator(c), F.lit(default))
    for r in rules:
        out = out.when(c.rlike(r.regex()), F.lit(r.label))
    return out.otherwise(F.lit(default))


def province_code(name) -> Column:
    """Province name -> code (1..63 alphabetical, OVERSEAS -1, else 0)."""
    pairs = []
    for k, v in {**SPECIAL_CODES, **PROVINCE_CODES}.items():
        pairs += [F.lit(k), F.lit(v)]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), col_(name)), F.lit(OTHER_CODE)).cast("int")


def location_flags(name) -> list[Column]:
    """is_overseas / is_unknown as 0/1 ints."""
    n = col_(name)
    return [
        (n == OVERSEAS).cast("int").alias("is_overseas"),
        (n == UNKNOWN).cast("int").alias("is_unknown"),
    ]


def label_table(
    df: DataFrame,
    key_col: str,
    classify: Callable[[Column], Column],
    out_col: str,
    prepare: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """Distinct ``key_col`` values with their label, computed once.

    ``prepare`` (for example the accent folding) runs once per key in its
    own projection, so the rule chain reads a plain column.  The table is
    materialized and measured once; it comes back with a broadcast hint
    when it is within the size limits, so every later join reuses that
    decision without another measuring job.
    """
    distinct = df.select(key_col).distinct()
    src = F.col(key_col)
    if prepare is not None:
        distinct = distinct.withColumn("_hm_prepared", prepare(src))
        src = F.col("_hm_prepared")
    return broadcast_if_small(materialize(distinct.select(key_col, classify(src).alias(out_col))))


#: A word, for ``word_label_table``.
WORD = "[\\p{L}\\p{N}]+"


def word_label_table(df: DataFrame, key_col: str, out_col: str, rules: Sequence[Rule] = LOCATION_RULES) -> DataFrame:
    """T14 with ``match="word"``: distinct ``key_col`` values with the label of the first rule that has a keyword in them as whole words.

    A cleaned value is cut into words, and its runs of up to as many words as the longest keyword
    has are joined to the keyword table by equality; of the rules met, the least number wins.
    No regex chain runs, and the work for a value grows with its words, not with the rules.
    """
    spark = df.sparkSession
    table = word_keywords(rules)
    keywords = spark.createDataFrame([(k, n) for k, n in table.items()], "_hm_gram string, _hm_rule int")
    longest = max(k.count(" ") + 1 for k in table)
    values = materialize(df.select(key_col).distinct())
    words = values.select(key_col, F.regexp_extract_all(clean_location(key_col), F.lit(WORD), F.lit(0)).alias("_hm_words"))
    grams = F.flatten(F.transform(F.lit(list(range(1, longest + 1))), lambda n: F.when(
        F.size("_hm_words") >= n,
        F.transform(F.sequence(F.lit(1), F.size("_hm_words") - n + 1), lambda i: F.array_join(F.slice("_hm_words", i, n), " ")),
    ).otherwise(F.array().cast("array<string>"))))
    met = words.select(key_col, F.explode(F.array_distinct(grams)).alias("_hm_gram"))
    # the keyword table is fixed: about 700 short rows
    first = met.join(F.broadcast(keywords), "_hm_gram").groupBy(key_col).agg(F.min("_hm_rule").alias("_hm_rule"))
    label = F.coalesce(F.get(F.lit([r.label for r in rules]), F.col("_hm_rule")), F.lit(UNKNOWN))
    return broadcast_if_small(materialize(values.join(first, key_col, "left").select(key_col, label.alias(out_col))))


def classify_distinct(
    df: DataFrame,
    key_col: str,
    classify: Callable[[Column], Column],
    out_col: str,
    labels: DataFrame | None = None,
    prepare: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """Add ``out_col = classify(prepare(key_col))`` classifying distinct keys only.

    ``key_col`` must be non-null (use a coalesced key); pass ``labels`` to
    reuse one label table for several frames.
    """
    labels = labels if labels is not None else label_table(df, key_col, classify, out_col, prepare)
    return df.join(labels, key_col, "left")


def location_key(raw_loc) -> Column:
    """Non-null join key for locations: NULL and '' classify alike."""
    return F.coalesce(col_(raw_loc), F.lit(""))
