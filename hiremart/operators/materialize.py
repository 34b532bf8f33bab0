"""Lineage cutting, size-checked broadcast, and the readers' repartitioning.

``materialize`` writes a frame into the folder the cluster names in
``spark.checkpoint.dir`` (a scratch folder only where that is unset, as in
tests) and reads it back: the plan runs once, the copy survives lost
executors, and nothing stays in the session's cache.

``broadcast_if_small`` measures a lookup side before hinting a broadcast.
Above the limits the plain DataFrame is returned, so Spark plans a shuffle
join (with AQE's skew splitting) instead.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_BROADCAST_MAX_ROWS = 2_000_000
DEFAULT_BROADCAST_MAX_BYTES = 64 * 1024 * 1024

_FIXED_WIDTH = {
    T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.LongType: 8,
    T.FloatType: 4, T.DoubleType: 8, T.DateType: 4, T.TimestampType: 8, T.TimestampNTZType: 8,
}


def shared_dir(spark) -> str:
    """The folder all executors share; a scratch one is set where none is and the executors are this machine's."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="hiremart-shared-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once for several consumers and cut its lineage."""
    path = f"{shared_dir(df.sparkSession)}/hiremart-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def estimated_bytes(df: DataFrame) -> F.Column:
    """Per-row size estimate: string/binary length plus fixed widths."""
    parts = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            parts.append(F.coalesce(F.octet_length(F.col(f.name)), F.lit(0)).cast("long"))
        else:
            parts.append(F.lit(_FIXED_WIDTH.get(type(f.dataType), 16)).cast("long"))
    out = F.lit(16).cast("long")
    for p in parts:
        out = out + p
    return out


def size_of(df: DataFrame) -> tuple[int, int]:
    """(rows, estimated bytes) of ``df``; one aggregate job, no collect of rows."""
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(estimated_bytes(df)).alias("b")).first()
    return int(row["n"]), int(row["b"] or 0)


def broadcast_limits(spark) -> tuple[int, int]:
    """(max rows, max bytes) for measured broadcasts; tunable per session with
    ``hiremart.broadcast.maxRows`` and ``hiremart.broadcast.maxBytes``."""
    rows = spark.conf.get("hiremart.broadcast.maxRows", None)
    nbytes = spark.conf.get("hiremart.broadcast.maxBytes", None)
    return (int(rows) if rows else DEFAULT_BROADCAST_MAX_ROWS, int(nbytes) if nbytes else DEFAULT_BROADCAST_MAX_BYTES)


def broadcast_if_small(df: DataFrame, max_rows: int | None = None, max_bytes: int | None = None) -> DataFrame:
    """Broadcast hint only when the measured size is within both limits.

    Callers pass a materialized frame, so the measuring job and the join
    read the same computed data.  Limits default to ``broadcast_limits``.
    """
    default_rows, default_bytes = broadcast_limits(df.sparkSession)
    max_rows = default_rows if max_rows is None else max_rows
    max_bytes = default_bytes if max_bytes is None else max_bytes
    rows, nbytes = size_of(df)
    if rows <= max_rows and nbytes <= max_bytes:
        return F.broadcast(df)
    return df


def repartitioned(df: DataFrame) -> DataFrame:
    """``df`` in ``hiremart.read.partitions`` partitions, where the session sets that.

    A parameter for inputs that Spark cannot split (one compressed file, one
    row group), applied by readers after they have chosen their columns.
    Unset, the scan's own splits are kept.
    """
    n = df.sparkSession.conf.get("hiremart.read.partitions", None)
    return df.repartition(int(n)) if n else df
