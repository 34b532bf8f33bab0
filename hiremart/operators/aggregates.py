"""Counting, grand totals, ranking, shares, pivots.

All aggregates are algebraic (count/sum), so Spark runs a partial
aggregate before every shuffle and a hot key costs one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.predicates import is_irrelevant
from .materialize import materialize


def count_by(df: DataFrame, keys: Sequence[str], count_col: str = "total_jobs", count_expr: Column | None = None) -> DataFrame:
    """A1/A2/A3: one row per key combination with a BIGINT count."""
    expr = count_expr if count_expr is not None else F.count(F.lit(1))
    return df.groupBy(*keys).agg(expr.cast("long").alias(count_col))


def with_grand_total(
    df: DataFrame,
    key: str,
    count_col: str,
    total_label: str,
    *,
    total_first: bool,
    value_expr: Column | None = None,
    flag_col: str = "is_total",
) -> DataFrame:
    """Per-key counts plus one grand-total row, in one pass.

    ``rollup`` computes details and the total together (Expand + one
    aggregate).  The total row is recognised by ``grouping(key)``, never by
    a NULL key, so a real NULL key stays a detail row.  Empty input gives
    no row at all, like a GROUP ALL over nothing.  Rows come sorted: total
    first or last, then count descending, then key.
    """
    expr = value_expr if value_expr is not None else F.count(F.lit(1))
    agg = df.rollup(key).agg(expr.cast("long").alias(count_col), F.grouping(key).cast("long").alias(flag_col))
    labelled = agg.select(
        F.when(F.col(flag_col) == 1, F.lit(total_label)).otherwise(F.col(key)).alias(key),
        count_col,
        flag_col,
    )
    first = F.desc(flag_col) if total_first else F.asc(flag_col)
    return labelled.orderBy(first, F.desc(count_col), F.asc(key))


def top_n_per_group(df: DataFrame, group_cols: Sequence[str], order: Sequence[Column], n: int, rn_col: str = "rn") -> DataFrame:
    """``row_number`` per group, keep rn <= n (WindowGroupLimit)."""
    w = Window.partitionBy(*group_cols).orderBy(*order)
    return df.withColumn(rn_col, F.row_number().over(w).cast("long")).where(F.col(rn_col) <= n)


def share_of_group(
    df: DataFrame, group_cols: Sequence[str], value_col: str, total_col: str, share_col: str = "share"
) -> DataFrame:
    """Group total and value/total (NULL when total <= 0).

    A window sum over the group replaces the reference's self-join.  The
    input is an aggregate (one row per group and item), so a group's
    partition holds at most the number of distinct items.
    """
    total = F.sum(value_col).over(Window.partitionBy(*group_cols)).cast("long")
    out = df.withColumn(total_col, total)
    return out.withColumn(
        share_col,
        F.when(F.col(total_col) > 0, F.col(value_col) / F.col(total_col)).otherwise(F.lit(None).cast("double")),
    )


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """Global top-k (TakeOrderedAndProject: k rows per task, then merge)."""
    return df.orderBy(*order).limit(k)


def sum_by_value(df: DataFrame, value_col: str, count_col: str = "job_count", out_col: str | None = None) -> DataFrame:
    """A7 + F3: drop irrelevant values, re-aggregate counts by value."""
    out_col = out_col or value_col
    kept = df.where(~is_irrelevant(F.col(value_col)))
    return kept.groupBy(F.col(value_col).alias(out_col)).agg(F.sum(count_col).cast("long").alias("job_count"))


def numeric_or_null(c) -> Column:
    """Text or number -> double, NULL when not numeric."""
    return F.col(c).cast("string").try_cast("double") if isinstance(c, str) else c.cast("string").try_cast("double")


def bar_data(df: DataFrame, label_col: str, value_col: str) -> DataFrame:
    """Chart data: drop NULL labels and non-numeric values, sort by
    value descending (ties by label, so the order is deterministic)."""
    v = numeric_or_null(value_col)
    clean = df.select(F.col(label_col), v.alias(value_col)).where(F.col(label_col).isNotNull() & F.col(value_col).isNotNull())
    return clean.orderBy(F.desc(value_col), F.asc(label_col))


def bar_top_n(df: DataFrame, label_col: str, value_col: str, n: int) -> DataFrame:
    """The first ``n`` bars of ``bar_data`` (a top-n chart)."""
    return bar_data(df, label_col, value_col).limit(n)


def pivot_share(
    df: DataFrame,
    row_col: str,
    col_col: str,
    value_col: str,
    row_total_col: str,
    item_count_col: str,
    top_rows: int,
    top_cols: int,
) -> DataFrame:
    """Heat-map matrix of shares.

    Rows: the ``top_rows`` row keys by their total; columns: the ``top_cols``
    column keys by summed count.  Both choices are top-k lists, the features of
    the chart.  A cell is a conditional sum, 0.0 where there is nothing, and
    is named by the value's text, whatever characters it holds (a NULL is
    ``COLUMN_OF_NULL``); rows come by total descending.  The input (an
    aggregate) is materialized once, since both lists and the cells read it.
    """
    df = materialize(df)
    totals = df.select(row_col, row_total_col).where(F.col(row_total_col).isNotNull()).dropDuplicates()
    top_r = top_k(totals, [F.desc(row_total_col), F.asc(row_col)], top_rows)
    col_tot = df.groupBy(col_col).agg(F.sum(item_count_col).alias("_col_total"))
    top_c = top_k(col_tot, [F.desc("_col_total"), F.asc(col_col)], top_cols)
    # at most top_cols values; columns in sorted order, as a pivot table lists them
    values = sorted((r[0] for r in top_c.select(col_col).collect()), key=lambda v: (v is None, str(v)))
    cells = [
        F.coalesce(F.sum(F.when(F.col(col_col).eqNullSafe(F.lit(v)), F.col(value_col))), F.lit(0.0)).alias(column_name(v))
        for v in values
    ]
    chosen = F.coalesce(F.col(col_col).isin([v for v in values if v is not None]), F.lit(False))
    if None in values:
        chosen = chosen | F.col(col_col).isNull()
    key = top_r.select(F.col(row_col).alias("_row"), F.col(row_total_col).alias("_total"))  # at most top_rows rows
    kept = df.where(chosen).join(F.broadcast(key), F.col(row_col).eqNullSafe(F.col("_row")))
    matrix = kept.groupBy(row_col, F.col("_total").alias(row_total_col)).agg(F.count(F.lit(1)).alias("_n"), *cells).drop("_n")
    return matrix.select(row_col, *[quoted(c) for c in matrix.columns[2:]], row_total_col).orderBy(
        F.desc(row_total_col), F.asc(row_col)
    )


COLUMN_OF_NULL = "(null)"


def column_name(value) -> str:
    return COLUMN_OF_NULL if value is None else str(value)


def quoted(name: str) -> Column:
    """A column by its exact name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def unpivoted(matrix: DataFrame, ids: Sequence[str], key: str, value: str) -> DataFrame:
    """One row per cell of a matrix: ``ids``, the column's name and its value."""
    cells = [c for c in matrix.columns if c not in ids]
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("k"), quoted(c).alias("v")) for c in cells])).alias("cell")
    return matrix.select(*ids, pairs).select(*ids, F.col("cell.k").alias(key), F.col("cell.v").alias(value))
