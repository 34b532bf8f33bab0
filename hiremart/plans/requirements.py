"""Requirement marts (A3, J2, T10-T13) in one pass over the postings.

The reference builds five tables with five scans and five self-joins on
job_id.  Here each posting emits an array of (kind, text) items, one
``explode`` turns them into rows, and the rows are counted per
(raw industry, kind, text).  Skills and requirements are free text, so they are
cut into tokens before that, in the scan: no shuffle carries a whole paragraph
as a key.  The three drop-down fields travel as they are and
are put into buckets after the count, once per distinct raw value, as is the
industry.  The industry comes from the same row, so no join is needed (ids are
unique and non-null).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.buckets import education_level, employment_type, with_experience
from ..functions.text import tokens
from .postings import industry_id, industry_name, requirement_industry_name

KINDS = ["exp", "skill", "req", "edu", "type"]
VALUE_COLUMNS = {"exp": "exp_required", "skill": "skill_name", "req": "requirement", "edu": "edu_level", "type": "job_type"}
RAW_COLUMNS = {"exp": "raw_exp", "skill": "raw_skill", "req": "raw_req", "edu": "raw_edu", "type": "raw_type"}


TEXT_KINDS = ("skill", "req")


def raw_requirement_counts(postings: DataFrame) -> DataFrame:
    """(raw_ind, kind, raw, _n): postings per raw industry, kind and raw drop-down value or token."""

    def item(kind: str, raw):
        return F.struct(F.lit(kind).alias("kind"), raw.alias("raw"))

    def token_items(kind: str):
        return F.transform(tokens(RAW_COLUMNS[kind]), lambda t: item(kind, t))

    fields = F.array(*[item(k, F.col(RAW_COLUMNS[k])) for k in KINDS if k not in TEXT_KINDS])
    every = F.concat(fields, *[token_items(k) for k in TEXT_KINDS])
    rows = postings.select("raw_ind", F.explode(every).alias("it")).select("raw_ind", "it.kind", "it.raw")
    return rows.groupBy("raw_ind", "kind", "raw").agg(F.count(F.lit(1)).alias("_n"))


def requirement_values(raw_counts: DataFrame, null_propagates: bool = False) -> DataFrame:
    """Normalise aggregated raw rows: industry id/name and the value."""
    df = raw_counts.withColumn("_marts_name", industry_name("raw_ind", hidden_is_unknown=True))
    df = df.withColumn("industry_name", requirement_industry_name("raw_ind", "_marts_name"))
    df = df.withColumn("industry_id", industry_id("industry_name"))
    df = with_experience(df, "raw", "_exp", null_propagates)
    value = (
        F.when(F.col("kind") == "exp", F.col("_exp"))
        .when(F.col("kind") == "edu", education_level("raw"))
        .when(F.col("kind") == "type", employment_type("raw"))
        .otherwise(F.col("raw"))
    )
    return df.select("industry_id", "industry_name", F.col("kind").alias("feature_type"), value.alias("feature_value"), "_n")


def requirement_long(enriched: DataFrame, null_propagates: bool = False) -> DataFrame:
    """feature_type, industry_id, industry_name, feature_value, total_jobs."""
    named = requirement_values(raw_requirement_counts(enriched), null_propagates)
    return named.groupBy("feature_type", "industry_id", "industry_name", "feature_value").agg(
        F.sum("_n").cast("long").alias("total_jobs")
    )


def requirement_items(enriched: DataFrame, null_propagates: bool = False) -> DataFrame:
    """Row-level form: (job_id, industry_id, industry_name, feature_type, feature_value).

    For inspection and tests; the marts use ``requirement_long``.
    """
    df = with_experience(enriched, "raw_exp", "_exp", null_propagates)
    items = F.explode(F.concat(
        F.array(
            F.struct(F.lit("exp").alias("kind"), F.col("_exp").cast("string").alias("value")),
            F.struct(F.lit("edu").alias("kind"), education_level("raw_edu").alias("value")),
            F.struct(F.lit("type").alias("kind"), employment_type("raw_type").alias("value")),
        ),
        F.transform(tokens("raw_skill"), lambda t: F.struct(F.lit("skill").alias("kind"), t.alias("value"))),
        F.transform(tokens("raw_req"), lambda t: F.struct(F.lit("req").alias("kind"), t.alias("value"))),
    )).alias("it")
    return df.select(
        "job_id", F.col("req_industry_id").alias("industry_id"), F.col("req_industry_name").alias("industry_name"), items
    ).select("job_id", "industry_id", "industry_name", F.col("it.kind").alias("feature_type"), F.col("it.value").alias("feature_value"))


def requirement_table(long: DataFrame, kind: str) -> DataFrame:
    """The reference's per-kind table: industry_id, industry_name, <value>, total_jobs."""
    return (
        long.where(F.col("feature_type") == kind)
        .select("industry_id", "industry_name", F.col("feature_value").alias(VALUE_COLUMNS[kind]), "total_jobs")
        .orderBy("industry_id", VALUE_COLUMNS[kind])
    )
