"""Tab-separated tables (S2-S6): strict schema reader and ragged reader."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import split_fields


#: No quoting: free text may start with a double quote.
TSV_OPTIONS = {"sep": "\t", "quote": "", "escape": "", "header": "false", "mode": "PERMISSIVE", "encoding": "UTF-8"}


def read_tsv(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """Tab-separated text with a declared schema.

    Quoting is switched off: free text may start with a double quote, and a
    quote-aware parser would swallow the tabs after it.  Empty fields load
    as NULL; short rows are padded with NULL.
    """
    return spark.read.schema(schema).options(**TSV_OPTIONS).csv(path)


def read_ragged_tsv(
    spark: SparkSession, path: str | list[str], names: Sequence[str], id_col: str | None = None
) -> DataFrame:
    """Split each line on tabs (keeping empty trailing fields).

    Picks ``len(names)`` fields (NULL when the line is shorter), keeps the
    field count ``_ncols`` and the line ``_raw``; ``id_col`` is cast to
    long with NULL for text that is not a number.
    """
    raw = spark.read.option("encoding", "UTF-8").text(path).select(F.col("value").alias("_raw"))
    return ragged_fields(raw, "_raw", names, id_col=id_col)


def ragged_fields(df: DataFrame, line_col: str, names: Sequence[str], sep: str = "\t", id_col: str | None = None) -> DataFrame:
    parts = split_fields(F.col(line_col), sep)
    cols = [F.get(parts, i).alias(n) for i, n in enumerate(names)]
    out = df.select(*cols, F.size(parts).cast("long").alias("_ncols"), F.col(line_col).alias("_raw"))
    if id_col is not None:
        out = out.withColumn(id_col, F.col(id_col).try_cast("long"))
    return out


def empty_as_null(df: DataFrame, cols) -> DataFrame:
    """The TSV hand-off rule on any format: an empty text field reads as NULL."""
    cols = set(cols)
    return df.select(*[F.when(F.col(c) != "", F.col(c)).alias(c) if c in cols else F.col(c) for c in df.columns])
