"""Industry marts (A1, A2, A5, O2, O3, T7): totals, by location, titles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import INDUSTRY_TOTAL_LABEL
from ..functions.text import slug_or_unknown
from ..operators.aggregates import with_grand_total
from .location import counts_by_province
from .postings import count_by_raw_industry


def industry_totals(enriched: DataFrame) -> DataFrame:
    """industry_name, total_jobs, is_total: grand total 'TONG_TAT_CA' last.

    Counts per raw industry text first, so the name normalisation runs once
    per distinct text.
    """
    return with_grand_total(
        count_by_raw_industry(enriched, []), "industry_name", "total_jobs", INDUSTRY_TOTAL_LABEL,
        total_first=False, value_expr=F.sum("_n_id"),
    )


def industry_by_location(enriched: DataFrame, labels: DataFrame, sort: bool = True) -> DataFrame:
    """location_name, industry_name, total_jobs (sorted by location, industry).

    ``sort=False`` skips the global sort when the table only feeds further
    aggregates or windows.
    """
    c = counts_by_province(count_by_raw_industry(enriched, ["loc_key"]), labels, ["industry_name"], count_col="_n")
    out = c.select(F.col("province_name").alias("location_name"), "industry_name", "total_jobs")
    return out.orderBy("location_name", "industry_name") if sort else out


def titles_by_location(enriched: DataFrame, labels: DataFrame, sort: bool = True) -> DataFrame:
    """location_name, job_title, total_jobs, location_slug (folder key).

    ``sort=False`` skips the global sort when the rows go to a per-key
    writer, which re-distributes them and sorts within each task anyway.
    """
    c = counts_by_province(enriched, labels, ["job_title"])
    out = c.select(
        F.col("province_name").alias("location_name"),
        "job_title",
        "total_jobs",
        slug_or_unknown(F.col("province_name")).alias("location_slug"),
    )
    return out.orderBy("location_name", "job_title") if sort else out


def industry_totals_from_facts(facts: DataFrame) -> DataFrame:
    """Same as ``industry_totals`` but summed from the location x industry facts."""
    return with_grand_total(
        facts.select("industry_name", "_n_id"), "industry_name", "total_jobs", INDUSTRY_TOTAL_LABEL,
        total_first=False, value_expr=F.sum("_n_id"),
    )


def industry_by_location_from_facts(facts: DataFrame, labels: DataFrame) -> DataFrame:
    """Same as ``industry_by_location`` but from the facts table."""
    c = counts_by_province(facts, labels, ["industry_name"], count_col="_n")
    return c.select(F.col("province_name").alias("location_name"), "industry_name", "total_jobs").orderBy(
        "location_name", "industry_name"
    )
