"""Distributed dense numbering.

The reference numbers rows 1..n (a rank without ties) either in input order
or over a sorted distinct set.  A window ``row_number()`` without a
partition would sort everything in one task, so both helpers number rows
inside each partition and add per-partition offsets.  The offset table has
one row per partition, never one per data row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .materialize import broadcast_if_small, materialize

_PID, _POS, _N, _OFF, _FIRST = "_hm_pid", "_hm_pos", "_hm_n", "_hm_off", "_hm_first"


def _running_offsets(counts: DataFrame, order_cols: list[str]) -> DataFrame:
    """Exclusive running sum of ``_N`` in ``order_cols`` order.

    ``counts`` has one row per partition or split; a single ordered window
    over it is fine because its size is bounded by the task count.
    """
    w = Window.orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn(_OFF, F.coalesce(F.sum(_N).over(w), F.lit(0)).cast("long"))


#: Keys sampled for each range; as many rows as this times the ranges come to the driver.
SAMPLED_PER_RANGE = 40


def range_bounds(keys: DataFrame, ranges: int) -> list:
    """Up to ``ranges - 1`` rows of ``keys``, in ascending order (nulls first), that cut it into even ranges.

    They are taken from a sorted sample of ``SAMPLED_PER_RANGE`` rows a range; Spark's own
    range exchange samples as many, but evaluates its whole input for it."""
    total = keys.count()
    wanted = ranges * SAMPLED_PER_RANGE
    sample = keys if total <= wanted else keys.sample(min(1.0, 1.2 * wanted / total), 17)
    rows = sample.distinct().orderBy(*keys.columns).limit(2 * wanted).collect()
    cuts = sorted({k * len(rows) // ranges for k in range(1, ranges)} - {0}) if rows else []
    return [rows[k] for k in cuts]


def range_of(keys: list[str], schema: T.StructType, bounds: list) -> Column:
    """Number of the range that a row's keys fall into: how many bounds are not above them, by binary search."""
    if not bounds:
        return F.lit(0)
    whole = F.array(*[F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(b, schema.fields)]) for b in bounds])
    key = F.struct(*[F.col(k) for k in keys])
    begin = F.struct(F.lit(0).alias("low"), F.lit(len(bounds)).alias("high"))

    def step(at, _):
        middle = F.shiftright(at["low"] + at["high"], 1)
        above = (at["low"] < at["high"]) & (F.get(whole, middle) <= key)
        low = F.when(above, middle + 1).otherwise(at["low"])
        high = F.when(above | (at["low"] >= at["high"]), at["high"]).otherwise(middle)
        return F.struct(low.alias("low"), high.alias("high"))

    halvings = F.sequence(F.lit(1), F.lit(len(bounds).bit_length() + 1))
    return F.aggregate(halvings, begin, step, lambda at: at["low"])


def dense_index(
    df: DataFrame,
    order_cols: list[str],
    index_col: str = "idx",
    start: int = 1,
    num_partitions: int | None = None,
) -> DataFrame:
    """Number rows ``start..start+n-1`` in ``order_cols`` order (nulls first).

    ``order_cols`` must be a total order (unique), so recomputation after a
    lost executor gives the same numbers.  ``df`` is evaluated once, into a
    written copy.  Range bounds and the rows in each range come from that copy's
    key columns alone; then the copy is cut at the bounds, and a row's number is its
    place in its sorted range plus the rows of the ranges before.
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    copy = materialize(df)
    keys = copy.select(*order_cols)
    place = range_of(order_cols, keys.schema, range_bounds(keys, n)).cast("int")
    counts = keys.select(place.alias(_PID)).groupBy(_PID).agg(F.count(F.lit(1)).alias(_N))
    # One row per range: at most ``n`` rows by construction.
    offsets = {r[_PID]: r[_OFF] for r in _running_offsets(counts, [_PID]).select(_PID, _OFF).collect()}
    before = F.array(*[F.lit(offsets.get(k, 0)).cast("long") for k in range(n)])
    cut = copy.withColumn(_PID, place).repartitionById(n, F.col(_PID)).sortWithinPartitions(*order_cols)
    numbered = (F.get(before, F.col(_PID)) + _position() + F.lit(start)).cast("long")
    return cut.select(*df.columns, numbered.alias(index_col))


def _position():
    """Place of a row within its partition, from 0."""
    return F.monotonically_increasing_id() - F.spark_partition_id().cast("long") * F.lit(1 << 33)


#: Columns that a file reader adds for ``input_order_ids``.
SOURCE_COLUMNS = {"_hm_path": "_metadata.file_path", "_hm_block": "_metadata.file_block_start"}


def with_source(df: DataFrame) -> DataFrame:
    """A file scan's rows with the file and block that each comes from."""
    return df.select("*", *[F.col(expr).alias(name) for name, expr in SOURCE_COLUMNS.items()])


def input_order_ids(df: DataFrame, index_col: str = "id", start: int = 1) -> DataFrame:
    """Number rows 1..n in input order: by file path, then by place in the file.

    ``df`` is a scan (filtered or projected, not shuffled) that carries
    ``with_source``'s columns.  The rows are written once with their file, block
    and position; blocks are numbered by (path, start), whatever task read them, so the
    ids depend on the files alone and not on split sizes or core counts.
    Rows filtered out before this call take no id.
    """
    source = list(SOURCE_COLUMNS)
    cols = [c for c in df.columns if c not in source]
    tagged = materialize(df.select(*cols, *source, _position().alias(_POS)))
    # One row per block of input: bounded by the number of splits, not of rows.
    counts = tagged.groupBy(*source).agg(F.count(F.lit(1)).alias(_N), F.min(_POS).alias(_FIRST))
    offsets = materialize(_running_offsets(counts, source).select(*source, _FIRST, _OFF))
    out = tagged.join(broadcast_if_small(offsets), source, "left")
    place = F.col(_OFF) + F.col(_POS) - F.col(_FIRST) + F.lit(start)
    return out.select(place.cast("long").alias(index_col), *cols)
