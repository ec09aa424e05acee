"""Bucketed tables in the shared folder: rows of a key in one sorted file, read without an exchange."""

from __future__ import annotations

import contextlib
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir

_ORDERING = "spark.sql.legacy.bucketedTableScan.outputOrdering"


def write_bucketed(rows: DataFrame, table: str, keys: Sequence[str], order: Sequence[str] = (), buckets: int | None = None) -> DataFrame:
    """Write ``rows`` as ``table``, bucketed by all ``keys`` and sorted by ``order`` (the keys if none is given), and read it back.

    Spark skips the exchange of a join or an aggregate only where it groups by
    exactly the bucket columns, on both sides in as many buckets as there are
    shuffle partitions, so that is the default.  Each bucket is one file.  The
    files are in the folder named by ``spark.checkpoint.dir``: the warehouse of a
    session may be a folder of the driver alone.  A write that fails leaves none.
    """
    spark = rows.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/table-{table}"
    try:
        rows.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*(order or keys)).option("path", path).saveAsTable(table)
    except BaseException:
        drop_bucketed(spark, table)
        raise
    return spark.table(table)


def drop_bucketed(spark: SparkSession, table: str) -> None:
    """Drop a table of ``write_bucketed`` and delete its files."""
    spark.sql(f"DROP TABLE IF EXISTS `{table}`")
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{ensure_checkpoint_dir(spark).rstrip('/')}/table-{table}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextlib.contextmanager
def sorted_scans(spark: SparkSession) -> Iterator[None]:
    """Plans made inside know that a one-file bucket is sorted: a merge join needs no sort of it."""
    before = spark.conf.get(_ORDERING, None)
    spark.conf.set(_ORDERING, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_ORDERING)
        else:
            spark.conf.set(_ORDERING, before)
