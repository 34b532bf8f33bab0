"""Equi-joins with defaults for unmatched rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .materialize import broadcast_if_small, materialize


def left_join_default(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    defaults: Mapping[str, object],
    *,
    small_right: bool = False,
) -> DataFrame:
    """Left outer equi-join; right columns of unmatched rows take ``defaults``.

    NULL keys never match (plain equality), as in the reference.  By default
    both sides are shuffled on the keys (sort-merge or shuffled hash join;
    AQE splits skewed partitions of the left side).  ``small_right=True``
    materializes the right side and broadcasts it if its measured size is
    within the limits.
    """
    if small_right:
        right = broadcast_if_small(materialize(right))
    return with_defaults(left.join(right, list(on), "left"), defaults)


def with_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """NULLs of the columns of ``defaults`` replaced, the column types kept."""
    return df.select(*[
        F.coalesce(F.col(c), F.lit(defaults[c]).cast(df.schema[c].dataType)).alias(c) if c in defaults else F.col(c) for c in df.columns
    ])


#: Parts that ``lookup_join`` deals the rows of a hot key over.
HOT_PARTS = 32


def lookup_join(left: DataFrame, lookup: DataFrame, on: Sequence[str], defaults: Mapping[str, object], *, parts: int = HOT_PARTS) -> DataFrame:
    """Left outer equi-join with an external lookup of any size; unmatched rows take ``defaults``.

    ``lookup`` may have several rows for a key; NULL keys never match.  A key is hot
    if it has more than 1 / (4 * ``parts``) of the left rows, so there are fewer than
    4 * ``parts`` of them; NULL may be one.  They are found by a pre-aggregated count.  The left rows of a
    hot key are dealt over ``parts`` by a hash of the row, and its lookup rows are repeated
    for each part; all other keys join as they are.
    """
    on = list(on)
    counts = materialize(left.groupBy(*on).agg(F.count(F.lit(1)).alias("_hm_n")))
    total = counts.agg(F.sum("_hm_n")).first()[0] or 0
    hot = [f"_hm_hot_{k}" for k in range(len(on))]
    # fewer than 4 * parts rows by construction
    few = F.broadcast(counts.where(F.col("_hm_n") * 4 * parts > total).select(*[F.col(k).alias(h) for k, h in zip(on, hot)], F.lit(True).alias("_hm_hot")))

    def marked(df: DataFrame) -> DataFrame:
        same = F.lit(True)
        for k, h in zip(on, hot):
            same = same & df[k].eqNullSafe(few[h])
        return df.join(few, same, "left").drop(*hot)

    is_hot, first = F.coalesce(F.col("_hm_hot"), F.lit(False)), F.lit(0)
    part = F.pmod(F.xxhash64(*[F.col(c) for c in left.columns]), F.lit(parts)).cast("int")
    dealt = marked(left).withColumn("_hm_part", F.when(is_hot, part).otherwise(first)).drop("_hm_hot")
    every = F.when(is_hot, F.sequence(first, F.lit(parts - 1))).otherwise(F.array(first))
    spread = marked(lookup).withColumn("_hm_part", F.explode(every)).drop("_hm_hot")
    joined = dealt.join(spread, [*on, "_hm_part"], "left").drop("_hm_part")
    return with_defaults(joined.select(*left.columns, *[c for c in lookup.columns if c not in on]), defaults)
