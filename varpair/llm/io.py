"""Reading the corpus tables and cutting lineage for the operators of this package."""

from __future__ import annotations

import contextlib
import ctypes
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from varpair.session import cut_lineage

#: Stands for a null doc_id inside the operators; it comes back as null.
NO_ID = 2**63 - 1


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package (``addPyFile``), once per application."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    target = os.path.join(tempfile.mkdtemp(prefix="varpair-code-"), "varpair_code.zip")
    with zipfile.ZipFile(target, "w") as z:
        for path in sorted(package.rglob("*.py")):
            z.write(path, path.relative_to(package.parent))
    sc.addPyFile(target)
    _shipped.add(sc.applicationId)


def release_memory() -> None:
    """Give freed memory back to the system: Python workers are kept for later tasks, and several share an executor."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def in_tasks(df: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """``df.mapInArrow(fn, schema)`` with this package at hand on the executors."""
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from fn(batches)
        release_memory()

    return df.mapInArrow(run, schema)


def keyed(docs: DataFrame, carry: bool = False) -> DataFrame:
    """doc_id, text_key, text and, with ``carry``, all other columns as the struct ``row``.

    Other columns of the table cannot clash with an operator's own.  A null
    doc_id becomes ``NO_ID``; ``text_key`` (a hash of the text) tells rows apart
    that repeat a doc_id with another text, and rows equal in both are each
    answered with the same result.
    """
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), F.xxhash64("text").alias("text_key"), F.col("text").cast("string").alias("text"), *([F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("row")] if carry else []))


def row_type(rows: DataFrame) -> str:
    """DDL of the struct ``row``."""
    return f"row {rows.schema['row'].dataType.simpleString()}"


def with_text(found: DataFrame, text: str, columns: list[str]) -> DataFrame:
    """The carried rows with a new text, in the given columns; n_chars, where there is one, follows the text."""
    pick = {c: F.col("row").getField(c).alias(c) for c in columns if c != "text"}
    pick["text"] = F.col(text).alias("text")
    if "n_chars" in pick:
        pick["n_chars"] = F.length(text).cast("long").alias("n_chars")
    return found.select(*[pick[c] for c in columns])


def real_id(name: str = "doc_id") -> Column:
    return F.when(F.col(name) != NO_ID, F.col(name)).alias(name)


def saved(df: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared folder of the cluster and read back."""
    return cut_lineage(df, name=f"llm-{name}")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only.

    Spark's ``lower`` maps every script, so it serves wherever the text holds no
    upper-case letter beyond A-Z; other texts are translated letter by letter.
    """
    letters = "".join(chr(c) for c in range(65, 91))
    plain = (F.length(text) == F.octet_length(text)) | ~text.rlike(r"[\p{IsUppercase}\p{Lt}&&[^A-Z]]")
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, letters, letters.lower()))
