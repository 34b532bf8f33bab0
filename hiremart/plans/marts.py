"""Presentation marts (M1-M12) derived from the aggregate tables.

Inputs are the aggregate tables (industry totals, industry by location,
the requirement long table), so every mart here works on data whose size
is bounded by the number of distinct categories, not by the postings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import INDUSTRY_TOTAL_LABEL, is_irrelevant, is_known_category
from ..operators.aggregates import bar_data, bar_top_n, pivot_share, share_of_group, sum_by_value, top_k, top_n_per_group

REQUIREMENT_MARTS = {
    "exp": ("requirement_experience_total", "experience"),
    "edu": ("requirement_education_total", "education"),
    "type": ("requirement_employment_type_total", "employment_type"),
    "skill": ("requirement_skill_total_top500", "skill"),
}
SKILL_TOP_K = 500


def industry_total_known(industry_totals: DataFrame) -> DataFrame:
    """M1/M2: (industry, job_count) without the grand total or irrelevant names."""
    t = industry_totals.select(F.col("industry_name").alias("industry"), F.col("total_jobs").alias("job_count"))
    if "is_total" in industry_totals.columns:
        t = industry_totals.where(F.col("is_total") == 0).select(
            F.col("industry_name").alias("industry"), F.col("total_jobs").alias("job_count")
        )
    return t.where(is_known_category(F.col("industry"), "UNKNOWN", INDUSTRY_TOTAL_LABEL)).orderBy(
        F.desc("job_count"), F.asc("industry")
    )


def industry_by_location_viz(by_location: DataFrame) -> DataFrame:
    """M3: (province, industry, job_count) with irrelevant industries dropped."""
    t = by_location.select(
        F.col("location_name").alias("province"), F.col("industry_name").alias("industry"), F.col("total_jobs").alias("job_count")
    )
    return t.where(~is_irrelevant(F.col("industry")))


def province_total(by_location_viz: DataFrame) -> DataFrame:
    """M4: (province, province_job_count), count desc."""
    return (
        by_location_viz.groupBy("province")
        .agg(F.sum("job_count").cast("long").alias("province_job_count"))
        .orderBy(F.desc("province_job_count"), F.asc("province"))
    )


def top_industries_by_province(by_location_viz: DataFrame, n: int = 5) -> DataFrame:
    """M5 (n=5) and the console top 3 (n=3): rank by count desc, name asc."""
    return top_n_per_group(by_location_viz, ["province"], [F.desc("job_count"), F.asc("industry")], n).orderBy(
        "province", "rn"
    )


def province_industry_share(by_location_viz: DataFrame) -> DataFrame:
    """M6: (province, industry, job_count, province_job_count, share)."""
    s = share_of_group(by_location_viz, ["province"], "job_count", "province_job_count", "share")
    return s.select("province", "industry", "job_count", "province_job_count", "share")


def requirement_mart(long: DataFrame, kind: str) -> DataFrame:
    """Totals per value over all industries, irrelevant values dropped."""
    _, value_name = REQUIREMENT_MARTS[kind]
    t = long.where(F.col("feature_type") == kind).select(
        F.col("feature_value").alias(value_name), F.col("total_jobs").alias("job_count")
    )
    out = sum_by_value(t, value_name)
    if kind == "skill":
        return top_k(out, [F.desc("job_count"), F.asc(value_name)], SKILL_TOP_K)
    return out.orderBy(F.desc("job_count"), F.asc(value_name))


def requirement_rollup(long: DataFrame) -> DataFrame:
    """A7 over every kind at once: (feature_type, feature_value, job_count)."""
    kept = long.where(~is_irrelevant(F.col("feature_value")))
    return kept.groupBy("feature_type", "feature_value").agg(F.sum("total_jobs").cast("long").alias("job_count"))


def width_profile(ragged: DataFrame) -> DataFrame:
    """Number of lines per field count."""
    return ragged.groupBy("_ncols").agg(F.count(F.lit(1)).cast("long").alias("count")).orderBy("_ncols")


def top_raw_locations(enriched: DataFrame, n: int | None = None) -> DataFrame:
    """Postings per raw location text, count desc."""
    t = enriched.groupBy("raw_loc").agg(F.count(F.lit(1)).cast("long").alias("count"))
    order = [F.desc("count"), F.asc("raw_loc")]
    return top_k(t, order, n) if n else t.orderBy(*order)


NUMBER_COLUMNS = ("job_count", "province_job_count", "share", "rn")


def _heatmap(share: DataFrame) -> DataFrame:
    return pivot_share(share, "province", "industry", "share", "province_job_count", "job_count", 25, 20)


def _bars(label: str, value: str, n: int | None):
    return lambda mart: bar_top_n(mart, label, value, n) if n else bar_data(mart, label, value)


#: Mart -> (chart, how its data is made); drawing itself is out of scope.
CHART_SOURCES = {
    "industry_total_known": ("industry_total_known_top25", _bars("industry", "job_count", 25)),
    "province_total": ("province_total_top25", _bars("province", "province_job_count", 25)),
    "requirement_skill_total_top500": ("requirement_skill_top30", _bars("skill", "job_count", 30)),
    "province_industry_share": ("province_industry_share_heatmap", _heatmap),
    # every bucket, sorted
    **{name: (name, _bars(label, "job_count", None)) for name, label in (REQUIREMENT_MARTS[k] for k in ("exp", "edu", "type"))},
}


def chart_data(marts: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The data behind each chart whose mart is there."""
    return {chart: make(marts[name]) for name, (chart, make) in CHART_SOURCES.items() if name in marts}


def presentation_marts(industry_totals: DataFrame, by_location: DataFrame, long: DataFrame) -> dict[str, DataFrame]:
    """The ten exported tables of the presentation job."""
    known = industry_total_known(industry_totals)
    viz = industry_by_location_viz(by_location)
    marts = {
        "industry_total": known,
        "industry_total_known": known,
        "industry_by_location": viz,
        "province_total": province_total(viz),
        "top5_industries_by_province": top_industries_by_province(viz, 5),
        "province_industry_share": province_industry_share(viz),
    }
    for kind, (name, _) in REQUIREMENT_MARTS.items():
        marts[name] = requirement_mart(long, kind)
    return marts
