"""Sinks (K1-K5): TSV, one folder per key, CSV (many parts or one file), export switch."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _file_system(spark, path: str):
    """Hadoop file system of ``path`` and a maker of its paths."""
    make = spark._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark._jsc.hadoopConfiguration()), make


def replace_with(spark, path: str, write: Callable[[str], None]) -> None:
    """K2: what ``write`` makes takes the place of ``path``, which stays readable until then.

    ``write`` gets a fresh path beside the target.  Only when it has succeeded is the old
    target renamed away, the new one renamed into place, and the old one deleted.  A write
    that fails leaves the old target as it was; if the second rename fails, the old target is put back.
    """
    path = path.rstrip("/")
    fs, make = _file_system(spark, path)
    mark = uuid.uuid4().hex[:12]
    parent, _, name = path.rpartition("/")
    # names that begin with "_" are passed over by Spark's readers
    fresh, old = (f"{parent}/_{name}.{kind}-{mark}" if parent else f"_{name}.{kind}-{mark}" for kind in ("new", "old"))
    try:
        write(fresh)
    except BaseException:
        fs.delete(make(fresh), True)
        raise
    had = fs.exists(make(path))
    if had and not fs.rename(make(path), make(old)):
        fs.delete(make(fresh), True)
        raise OSError(f"{path} cannot be renamed")
    if not had:
        fs.mkdirs(make(path).getParent())
    if not fs.rename(make(fresh), make(path)):
        if had:
            fs.rename(make(old), make(path))
        fs.delete(make(fresh), True)
        raise OSError(f"{fresh} cannot be renamed to {path}")
    if had:
        fs.delete(make(old), True)


def _saved(df: DataFrame, path: str, mode: str, write: Callable[[str], None]) -> None:
    """``write`` to ``path``, or for ``mode="overwrite"`` in place of it."""
    if mode == "overwrite":
        replace_with(df.sparkSession, path, write)
    else:
        write(path)


def tsv_line(df: DataFrame, cols: list[str] | None = None) -> F.Column:
    """One tab-separated text line per row: fields as text, NULL as empty.

    No quoting or escaping, as the reference's store writes them; a tab
    inside a field therefore shifts the following fields, exactly as it
    does there.
    """
    cols = cols or df.columns
    return F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols])


def write_tsv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """K1/K2: tab-separated text, NULL as an empty field, no quoting.

    ``mode="errorifexists"`` refuses an existing target (K1);
    ``mode="overwrite"`` replaces it when the new one is complete (K2).
    """
    lines = df.select(tsv_line(df).alias("value"))
    _saved(df, path, mode, lambda at: lines.write.mode("errorifexists").text(at))


def write_per_key(
    df: DataFrame,
    path: str,
    key_col: str,
    *,
    mode: str = "overwrite",
    max_records_per_file: int = 1_000_000,
    folder_col: str = "key",
) -> None:
    """K3: one folder per value of ``key_col``, keeping the column in the data.

    ``partitionBy`` takes the partition column out of the files, so a copy
    of the key names the folders while the lines keep every column.  The
    ``rebalance`` hint shuffles by key and lets AQE size the write tasks:
    a key holding a third of all rows is split into many tasks of the
    advisory size (``spark.sql.adaptive.advisoryPartitionSizeInBytes``),
    small keys are coalesced, so each task writes few files and no task
    holds a whole hot key.  ``maxRecordsPerFile`` bounds each file, and the
    lines of each file come sorted (the writer sorts by folder anyway).
    """
    keyed = df.select(
        tsv_line(df).alias("value"),
        F.coalesce(F.col(key_col).cast("string"), F.lit("__NULL__")).alias(folder_col),
    )
    ordered = keyed.hint("rebalance", folder_col).sortWithinPartitions(folder_col, "value")

    def write(at: str) -> None:
        ordered.write.option("maxRecordsPerFile", max_records_per_file).partitionBy(folder_col).text(at)

    _saved(df, path, mode, write)


CSV_OPTIONS = {
    "header": "true",
    "emptyValue": "",       # '' as an empty field, like NULL
    "escape": '"',          # quotes doubled inside quoted fields (RFC 4180)
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def write_csv(df: DataFrame, path: str) -> None:
    """K4 at any size: a folder of CSV part files, each with the header."""
    replace_with(df.sparkSession, path, lambda at: df.write.options(**CSV_OPTIONS).csv(at))


def write_single_csv(df: DataFrame, path: str) -> None:
    """K4 as one CSV file with a header at ``path``.

    The parts are written by all tasks, without headers and in the order of the
    frame's partitions; the file is the header line followed by the parts' bytes,
    copied through a small buffer, so no task and no heap holds all rows.
    """
    spark = df.sparkSession
    fs, make = _file_system(spark, path)
    parts = f"{path}._parts-{uuid.uuid4().hex[:12]}"

    def join(at: str) -> None:
        names = sorted(s.getPath().getName() for s in fs.listStatus(make(parts)) if s.getPath().getName().startswith("part-"))
        out = fs.create(make(at), True)
        try:
            out.write(bytearray(_csv_line(df.columns).encode("utf-8")))
            for name in names:
                part = fs.open(make(f"{parts}/{name}"))
                try:
                    spark._jvm.org.apache.hadoop.io.IOUtils.copyBytes(part, out, 1 << 20, False)
                finally:
                    part.close()
        finally:
            out.close()

    try:
        df.write.options(**{**CSV_OPTIONS, "header": "false"}).csv(parts)
        replace_with(spark, path, join)
    finally:
        fs.delete(make(parts), True)


def _csv_line(values: list[str]) -> str:
    """One CSV line of ``CSV_OPTIONS``."""
    quoted = ['"' + v.replace('"', '""') + '"' if any(c in v for c in ',"\r\n') or v != v.strip() else v for v in values]
    return ",".join(quoted) + "\n"


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    _saved(df, path, mode, lambda at: df.write.parquet(at))


#: K5: format -> (ending, writer).
EXPORTS = {"csv": (".csv", write_csv), "csv-single": (".csv", write_single_csv), "parquet": ("", write_parquet)}


def export(df: DataFrame, out_dir: str, name: str, fmt: str = "csv") -> str:
    """K5: write one mart below ``out_dir`` and return its path.

    Only that path is replaced; a folder that holds tables of the job is refused."""
    if fmt not in EXPORTS:
        raise ValueError(f"export format {fmt!r} is none of {', '.join(EXPORTS)}")
    ending, write = EXPORTS[fmt]
    target = f"{out_dir.rstrip('/')}/{name}{ending}"
    write(df, target)
    return target
