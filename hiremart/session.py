"""SparkSession factory for local runs, tests and the benchmark.

On a cluster, ``spark-submit`` supplies the session; the library only reads
its settings (``spark.checkpoint.dir`` among them).  For local runs a
checkpoint folder is created under /tmp only when none is configured.
"""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int | None = None, app: str = "hiremart") -> SparkSession:
    parts = shuffle_partitions or (int(cores) if str(cores).isdigit() else os.cpu_count() or 8)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.default.parallelism", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("HIREMART_DRIVER_MEMORY", "8g"))
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers, wherever the session was started from.

    ``spark-submit --py-files`` does the same; here it is done once for each application."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="hiremart-package-")) / "hiremart.zip"
    with zipfile.ZipFile(target, "w") as out:
        for f in sorted(package.rglob("*.py")):
            out.write(f, f"{package.name}/{f.relative_to(package)}")
    sc.addPyFile(str(target))
    _shipped.add(sc.applicationId)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the configured checkpoint folder; create a scratch one only if unset."""
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return sc.getCheckpointDir()
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        conf = tempfile.mkdtemp(prefix="hiremart-ckpt-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", conf)
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir()
