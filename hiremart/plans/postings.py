"""Per-posting derived columns shared by every mart (T5-T7 applied).

Industry names are normalised twice in the reference with one difference:
the industry marts treat 'Không hiển thị' as UNKNOWN, the requirement marts
keep it as a real industry.  Both come out of one projection here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import NOT_DISPLAYED, NOT_DISPLAYED_RAW
from ..functions.text import UNKNOWN, col_, collapse_ws, empty_to_unknown, head_segments, java_trim, slug
from ..operators.classify import location_key

HIDDEN_RAW = NOT_DISPLAYED_RAW


def _clean_industry(raw, hidden_is_unknown: bool) -> Column:
    """NULL, blank (and optionally the exact 'not displayed' marker) -> UNKNOWN, else TRIM."""
    alts = "[\\x00-\\x20]*" + ("|" + HIDDEN_RAW if hidden_is_unknown else "")
    marked = F.regexp_replace(col_(raw), "^(?:" + alts + ")\\z", UNKNOWN)
    return F.coalesce(java_trim(marked), F.lit(UNKNOWN))


def industry_name(raw, hidden_is_unknown: bool = True) -> Column:
    """T6 + T5: head segment before '/', ',', '>' then collapse whitespace,
    trim, upper; an empty result is UNKNOWN.

    Every step reads its input once, so the expression stays linear in
    size even when Catalyst inlines it into a pushed-down filter.
    """
    seg = head_segments(_clean_industry(raw, hidden_is_unknown))
    return empty_to_unknown(F.upper(java_trim(collapse_ws(seg))))


def industry_id(name) -> Column:
    """Slug of the industry name; UNKNOWN for UNKNOWN or an empty slug.

    (The slug of 'UNKNOWN' is 'UNKNOWN', so one rule covers both.)
    """
    return empty_to_unknown(slug(col_(name)))


def job_title(raw_title) -> Column:
    return F.upper(java_trim(col_(raw_title)))


def requirement_industry_name(raw, marts_name) -> Column:
    """The requirement marts' industry name from the industry marts' one.

    The two normalisations differ only for a raw value that is exactly the
    'not displayed' marker (UNKNOWN there, its upper-cased text here), so
    one equality test replaces a second run of the regex chain.
    """
    return F.when(col_(raw) == NOT_DISPLAYED_RAW, F.lit(NOT_DISPLAYED)).otherwise(col_(marts_name))


def enrich(postings: DataFrame) -> DataFrame:
    """Columns every downstream mart needs, in narrow projections."""
    df = postings.select("*", industry_name("raw_ind", hidden_is_unknown=True).alias("industry_name"))
    df = df.select("*", requirement_industry_name("raw_ind", "industry_name").alias("req_industry_name"))
    return df.select(
        "job_id",
        "industry_name",
        "req_industry_name",
        industry_id("req_industry_name").alias("req_industry_id"),
        job_title("raw_title").alias("job_title"),
        "raw_loc",
        location_key("raw_loc").alias("loc_key"),
        "raw_ind", "raw_sec", "raw_exp", "raw_req", "raw_skill", "raw_edu", "raw_type",
    )


def count_by_raw_industry(df: DataFrame, keys: list[str]) -> DataFrame:
    """Counts per (keys, industry_name) with the name computed per distinct raw text.

    Postings are first counted per (keys, raw_ind) -- a hash aggregate whose
    map-side combine collapses repeated texts -- and the regex chain of
    ``industry_name`` then runs once per aggregated row, not once per
    posting.  Returns (keys, industry_name, _null_id, _n, _n_id) rows that
    callers sum; a name may appear on several rows.  ``_null_id`` marks
    postings whose job_id is NULL (only a job_base_clean id that is not a
    number): the reference's totals count by job_id and skip them (``_n_id``
    is 0 there), and its industry x location joins on job_id, where a NULL
    never matches.
    """
    per_raw = df.groupBy(*keys, "raw_ind", F.col("job_id").isNull().alias("_null_id")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    return per_raw.select(
        *keys,
        industry_name("raw_ind", hidden_is_unknown=True).alias("industry_name"),
        "_null_id",
        "_n",
        F.when(F.col("_null_id"), F.lit(0)).otherwise(F.col("_n")).cast("long").alias("_n_id"),
    )
