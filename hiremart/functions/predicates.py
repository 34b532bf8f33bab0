"""Predicates of the presentation layer."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col_

# Text that marks a bucket as "not displayed" (upper-cased in
# the marts, as written in the raw postings).
NOT_DISPLAYED = "KHÔNG HIỂN THỊ"
NOT_DISPLAYED_RAW = "Không hiển thị"
INDUSTRY_TOTAL_LABEL = "TONG_TAT_CA"


def is_irrelevant(c) -> Column:
    """NULL, '', 'UNKNOWN' or containing 'KHÔNG HIỂN THỊ' after trim+upper.

    Uses Spark's space-only ``trim``, as the presentation job does.  The
    input is referenced once (NULL -> '' then one anchored regex), so when
    Catalyst pushes this filter below an aggregate and inlines the column's
    expression, it is inlined a single time.
    """
    n = F.coalesce(F.upper(F.trim(col_(c))), F.lit(""))
    return n.rlike("^(?:UNKNOWN)?\\z|" + NOT_DISPLAYED)


def is_known_category(c, *sentinels: str) -> Column:
    """F3 + F4: not irrelevant and not one of ``sentinels`` (NULL -> dropped)."""
    c = col_(c)
    keep = ~is_irrelevant(c)
    if sentinels:
        keep = keep & ~c.isin(*sentinels)
    return F.coalesce(keep, F.lit(False))
