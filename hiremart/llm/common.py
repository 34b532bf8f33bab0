"""Helpers shared by the training-data operators.

* ``work_dir``: a fresh folder below the shared folder that the cluster names
  in ``spark.checkpoint.dir``; only when that is unset (tests) a local one.
* ``written``: write a frame there and read it back, which cuts lineage in a
  way that survives lost executors.
* ``bucketed``: the same, dealt into buckets by keys, so that a join on them moves only the other side.
* ``discard``: delete such copies once nothing reads them any more; ``passing_copies`` deletes
  all that were made inside it.
* ``worker_cache``: what a worker remembers for one operator.
* ``record_batch``: one Arrow batch from Python columns.
"""

from __future__ import annotations

import contextlib
import uuid
import weakref

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hiremart.operators.materialize import shared_dir


def work_dir(spark: SparkSession, name: str) -> str:
    """URI of a fresh folder (not yet made) in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


#: Folder, and table if it is one, of each copy that ``written`` and ``bucketed`` made.
_copies: weakref.WeakKeyDictionary[DataFrame, tuple[str, str | None]] = weakref.WeakKeyDictionary()
_scopes: list[list[tuple[SparkSession, str, str | None]]] = []


def _noted(copy: DataFrame, path: str, table: str | None = None) -> DataFrame:
    _copies[copy] = path, table
    for scope in _scopes:
        scope.append((copy.sparkSession, path, table))
    return copy


def _delete(spark: SparkSession, path: str, table: str | None) -> None:
    if table is not None:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


#: Copies of known size go in files of so many bytes, and in so many at least.
FILE_BYTES = 8 << 20
LEAST_FILES = 12


def files_for(size: int) -> int:
    return max(LEAST_FILES, -(-size // FILE_BYTES))


def written(df: DataFrame, name: str, size: int | None = None, spread: bool = False) -> DataFrame:
    """``df`` computed once into the shared folder, read back with its schema.

    With ``size``, which its bytes do not exceed, it goes in as many files as that needs and not in one
    for each shuffle partition: for each file the local file system starts processes that set its rights.  ``spread``: the
    work before is heavy, so its rows are dealt to the files after it instead of its tasks being joined."""
    path = work_dir(df.sparkSession, name)
    if size is not None:
        df = df.repartition(files_for(size)) if spread else df.coalesce(files_for(size))
    df.write.option("compression", "zstd").parquet(path)
    return _noted(df.sparkSession.read.schema(df.schema).parquet(path), path)


def bucketed(df: DataFrame, name: str, keys: list[str]) -> DataFrame:
    """``df`` computed once into the shared folder as an external table of as many buckets by ``keys`` as
    the session has shuffle partitions, so that joins and aggregates on ``keys`` do not shuffle it again."""
    spark = df.sparkSession
    path, table = work_dir(spark, name), f"{name.replace('-', '_')}_{uuid.uuid4().hex}"
    n = shuffle_partitions(spark)
    writer = df.repartition(n, *keys).write.format("parquet").bucketBy(n, *keys).option("path", path).option("compression", "zstd")
    writer.saveAsTable(table)
    return _noted(spark.table(table), path, table)


def discard(*copies: DataFrame) -> None:
    """Delete copies that were made here; call it when what was derived from them is itself written."""
    for copy in copies:
        if copy in _copies:
            _delete(copy.sparkSession, *_copies.pop(copy))


@contextlib.contextmanager
def passing_copies():
    """Copies that are made inside are deleted at the end, but for those put into the list that it gives."""
    made: list[tuple[SparkSession, str, str | None]] = []
    kept: list[DataFrame] = []
    _scopes.append(made)
    try:
        yield kept
    finally:
        _scopes.remove(made)
        spare = {_copies[c][0] for c in kept if c in _copies}
        for spark, path, table in made:
            if path not in spare:
                _delete(spark, path, table)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


_kept: dict[str, dict] = {}


def worker_cache(operator: str) -> dict:
    """What a Python worker keeps from task to task for ``operator``; the caches of other operators are let go."""
    for other in [k for k in _kept if k != operator]:
        _kept.pop(other).clear()
    return _kept.setdefault(operator, {})


SALTS = 16


def salted_left_join(left: DataFrame, right: DataFrame, keys: list[str], by: Column, salts: int = SALTS) -> DataFrame:
    """``left`` left-joined with the few rows that ``right`` has for each key.

    Rows of one key of ``left`` are dealt over ``salts`` parts by ``by``, and
    ``right`` is repeated for each, so a key that a third of all rows share
    does not fall to one task."""
    dealt = left.withColumn("_salt", F.pmod(F.xxhash64(by), F.lit(salts)).cast("int"))
    spread = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return dealt.join(spread, [*keys, "_salt"], "left").drop("_salt")


def record_batch(columns: dict[str, tuple[list, pa.DataType]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [v if isinstance(v, pa.Array) else pa.array(v, t) for v, t in columns.values()], names=list(columns)
    )


def utf8(column: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a string column, nulls kept."""
    return column.cast(pa.binary()).to_pylist()
