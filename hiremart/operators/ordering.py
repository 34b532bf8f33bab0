"""Sorted results as data (O1, O2, O4): every row with its place in the order; sorted ranges for ordered files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .materialize import size_of
from .numbering import dense_index

#: Estimated bytes of the rows that one task of ``sorted_ranges`` sorts.
RANGE_BYTES = 32 << 20
#: Part files carry five-digit numbers; beyond these many, their names no longer sort in order.
MOST_RANGES = 100_000


def placed(df: DataFrame, order: Sequence[str], place_col: str = "place") -> DataFrame:
    """``df`` with each row's place, from 1, in ``order``: column names, those with a leading ``-`` descending.

    NULLs come first ascending and last descending, as in ``orderBy``.  Descending columns must be numbers,
    and ``order`` has to tell all rows apart.  The places come from ``dense_index``, so the
    order is that of a distributed sort and no task sees all rows.
    """
    keys, extra = [], {}
    for k, name in enumerate(order):
        if not name.startswith("-"):
            keys.append(name)
            continue
        column = F.col(name[1:])
        extra |= {f"_hm_null_{k}": column.isNull(), f"_hm_down_{k}": -column}
        keys += [f"_hm_null_{k}", f"_hm_down_{k}"]
    return dense_index(df.withColumns(extra) if extra else df, keys, place_col).select(*df.columns, place_col)


def sorted_ranges(df: DataFrame, keys: Sequence[str], at_least: int = 1) -> DataFrame:
    """``df`` cut into ranges of ``keys`` (nulls first), one partition each, each sorted.

    There are as many ranges as ``df``'s measured size has ``RANGE_BYTES``, and ``at_least`` ones, so a task
    sorts the same amount however large ``df`` is.  Rows of equal keys stay in one range.  ``df`` is
    evaluated for its size, for the sampled bounds and for the shuffle: costly columns are better derived afterwards.
    """
    _, nbytes = size_of(df)
    ranges = min(max(at_least, -(-nbytes // RANGE_BYTES)), MOST_RANGES)
    return df.repartitionByRange(ranges, *keys).sortWithinPartitions(*keys)
