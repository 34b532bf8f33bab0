"""Location marts (T14-T16, A4, K3 input): log_location, province totals.

Locations are classified once per distinct raw value (``label_table``).
Row-level outputs join the labels back; aggregates first count per raw
location (partial aggregation collapses hot values), then map the few
aggregated rows to provinces and re-aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.provinces import TOTAL_LABEL, UNKNOWN
from ..functions.text import clean_location
from ..operators.aggregates import with_grand_total
from ..operators.classify import label_table, location_flags, province_code, rule_chain, word_label_table
from .postings import count_by_raw_industry


MATCHES = ("substring", "word")


def location_labels(enriched: DataFrame, match: str = "substring") -> DataFrame:
    """(loc_key, province_name) for every distinct location key.

    ``match="substring"`` is the reference's rule; ``"word"`` lets keywords match whole words only.
    Materialized, measured once, broadcast-hinted when small (label_table).
    """
    if match not in MATCHES:
        raise ValueError(f"match {match!r} is none of {', '.join(MATCHES)}")
    if match == "word":
        return word_label_table(enriched.select("loc_key"), "loc_key", "province_name")
    return label_table(enriched.select("loc_key"), "loc_key", rule_chain, "province_name", prepare=clean_location)


def classify_postings(enriched: DataFrame, labels: DataFrame) -> DataFrame:
    """Row-level province for each posting."""
    return enriched.join(labels, "loc_key", "left")


def log_location(enriched: DataFrame, labels: DataFrame) -> DataFrame:
    """job_id, province_id, province_name, is_overseas, is_unknown."""
    c = classify_postings(enriched.select("job_id", "loc_key"), labels)
    return c.select(
        "job_id",
        province_code("province_name").alias("province_id"),
        "province_name",
        *location_flags("province_name"),
    )


def province_details(enriched: DataFrame, labels: DataFrame) -> DataFrame:
    """province_id, province_name, raw_loc: the per-province detail files."""
    c = classify_postings(enriched.select("raw_loc", "loc_key"), labels)
    return c.select(province_code("province_name").alias("province_id"), "province_name", "raw_loc")


def counts_by_province(
    enriched: DataFrame, labels: DataFrame, extra_keys: list[str] | None = None, count_col: str | None = None
) -> DataFrame:
    """Industry-side counts per (province, ``extra_keys``).

    Rows are first counted per raw location (and ``extra_keys``), so the
    label join sees aggregated rows.  ``count_col`` names a column of
    partial counts on input that is already aggregated per raw location;
    such input joins the labels directly, without another shuffle.  A
    posting with a NULL job_id counts under UNKNOWN: the reference attaches
    provinces to these counts by joining on job_id, which a NULL never
    matches.
    """
    extra = list(extra_keys or [])
    if count_col:
        per_key = enriched.select("loc_key", *extra, "_null_id", F.col(count_col).alias("_n"))
    else:
        per_key = enriched.groupBy("loc_key", *extra, F.col("job_id").isNull().alias("_null_id")).agg(
            F.count(F.lit(1)).alias("_n")
        )
    mapped = per_key.join(labels, "loc_key", "left").select(
        F.when(F.col("_null_id"), F.lit(UNKNOWN)).otherwise(F.col("province_name")).alias("province_name"), *extra, "_n"
    )
    return mapped.groupBy("province_name", *extra).agg(F.sum("_n").cast("long").alias("total_jobs"))


def province_totals(enriched: DataFrame, labels: DataFrame) -> DataFrame:
    """city_name, job_count, is_total: grand total first, then count desc.

    Counts postings with a non-NULL job_id, as the reference's total does.
    """
    per_key = enriched.groupBy("loc_key").agg(F.count("job_id").alias("_n"))
    mapped = per_key.join(labels, "loc_key", "left").select(
        F.col("province_name").alias("city_name"), "_n"
    )
    return with_grand_total(mapped, "city_name", "job_count", TOTAL_LABEL, total_first=True, value_expr=F.sum("_n"))


def location_industry_facts(enriched: DataFrame) -> DataFrame:
    """(loc_key, industry_name, _n): the one row-level aggregate behind the
    province totals, the industry totals and industry x location.

    Every posting has exactly one province (UNKNOWN included) and one
    industry name, so each of those three outputs is a sum over this table;
    one scan and one partial-aggregated shuffle serve all three.
    """
    per_raw = count_by_raw_industry(enriched, ["loc_key"])
    return per_raw.groupBy("loc_key", "industry_name", "_null_id").agg(
        F.sum("_n").alias("_n"), F.sum("_n_id").alias("_n_id")
    )


def province_totals_from_facts(facts: DataFrame, labels: DataFrame) -> DataFrame:
    """Same as ``province_totals`` but from the facts table."""
    mapped = facts.join(labels, "loc_key", "left").select(F.col("province_name").alias("city_name"), "_n_id")
    return with_grand_total(mapped, "city_name", "job_count", TOTAL_LABEL, total_first=True, value_expr=F.sum("_n_id"))
