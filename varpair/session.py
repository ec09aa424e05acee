"""Session helpers: building a local session for tests/bench and cutting lineage.

On a cluster the session is created by the platform; the library only reads
``spark.checkpoint.dir`` from it.  A default checkpoint folder is set only for a
``local[...]`` session that names none (tests, bench).
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(cpus: int | str = "*", app: str = "varpair", shuffle_partitions: int = 8) -> SparkSession:
    """A local session tuned the way the library expects (AQE on, UI off, UTC)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", os.environ.get("VARPAIR_ADVISORY_BYTES", "16m"))
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # no broadcast from static (estimated) sizes, only what AQE measured as small
        .config("spark.sql.autoBroadcastJoinThreshold", "-1")
        .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "32m")
        .config("spark.sql.optimizer.runtime.bloomFilter.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("VARPAIR_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the session.

    A cluster session names one on shared storage; without it this raises, as
    executors would write to their own disks.  A session on this machine alone
    (``local[...]``: tests, bench) gets a fresh temporary folder.
    """
    current = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getCheckpointDir()
    if not current:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError(f"{CHECKPOINT_KEY} names no shared folder")
        current = tempfile.mkdtemp(prefix="varpair-ckpt-")
        spark.conf.set(CHECKPOINT_KEY, current)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(current)
    return current


def cut_lineage(df: DataFrame, name: str | None = None, eager: bool = True) -> DataFrame:
    """Cut the lineage of ``df`` through the shared checkpoint folder.

    ``eager=True`` (default) writes ``df`` as Parquet under the folder and
    reads it back: a written table survives executor loss (unlike
    ``localCheckpoint``) and carries file sizes for later planning.
    ``eager=False`` uses Spark's reliable ``checkpoint(eager=False)`` into
    the same folder, materialised by the first action.
    """
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/stage-{name or 'df'}-{uuid.uuid4().hex[:12]}"
    if not eager:
        return df.checkpoint(eager=False)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def release_shuffles(spark: SparkSession) -> None:
    """Have the driver collect its garbage: Spark deletes the shuffle files of finished writes only then,
    and a driver with memory to spare may keep them until the end."""
    spark.sparkContext._jvm.System.gc()


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package (``addPyFile``), once per application."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    target = os.path.join(tempfile.mkdtemp(prefix="varpair-tasks-"), "varpair_tasks.zip")
    with zipfile.ZipFile(target, "w") as z:
        for path in sorted(package.rglob("*.py")):
            z.write(path, path.relative_to(package.parent))
    sc.addPyFile(target)
    _shipped.add(sc.applicationId)


def in_tasks(df: DataFrame, fn: Callable, schema) -> DataFrame:
    """``df.mapInArrow(fn, schema)`` with this package at hand on the executors."""
    ship_package(df.sparkSession)
    return df.mapInArrow(fn, schema)
