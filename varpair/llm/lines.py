"""Line deduplication against levelled sorted runs of line hashes.

``LineRuns`` holds, for every line seen so far, its hash and the document that
keeps it, in runs: tables bucketed and sorted by both halves of the hash, one
file a bucket.  A batch of documents is shuffled once and merge-joined with the
runs where they lie (no exchange or sort of a run), adds its own new lines as a
run of level 0, and whenever a level has ``fan_out`` runs they are merged into
one run of the next level.  A hash is in one run only.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varpair.sinks.bucketed import drop_bucketed, sorted_scans, write_bucketed

from .io import ascii_lower, in_tasks, keyed, real_id, row_type, saved

SPACES = " \t\n\x0b\x0c\r"


def line_keys(docs: DataFrame, min_chars: int = 10) -> DataFrame:
    """Every line that counts: doc_id, text_key, position and the 128-bit hash (h1, h2) of its key.

    The key is the line stripped of ASCII white space at both ends, A-Z in lower
    case; keys under ``min_chars`` code points are left out.
    """
    lines = docs.select("doc_id", "text_key", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n", -1)).alias("position", "line"))
    keys = lines.withColumn("key", F.btrim("line", F.lit(SPACES))).filter(F.length("key") >= min_chars).withColumn("key", ascii_lower(F.col("key")))
    return keys.select("doc_id", "text_key", "position", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(7), "key").alias("h2"))


class LineRuns:
    """Levelled sorted runs in the shared folder; a name opens the same runs again in a later session of the catalog."""

    def __init__(self, spark: SparkSession, name: str | None = None, fan_out: int = 3, buckets: int | None = None):
        self.spark, self.fan_out = spark, fan_out
        self.name = name or f"line_runs_{uuid.uuid4().hex[:12]}"
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: dict[int, list[str]] = {}
        for table in spark.catalog.listTables(pattern=f"{name}_l*") if name else []:
            if table.name.startswith(f"{name}_l"):
                self.levels.setdefault(int(table.name[len(self.name) + 2 :].split("_")[0]), []).append(table.name)

    def _write(self, rows: DataFrame, level: int) -> None:
        table = f"{self.name}_l{level}_{uuid.uuid4().hex[:8]}"
        write_bucketed(rows, table, ["h1", "h2"], buckets=self.buckets)
        self.levels.setdefault(level, []).append(table)

    def tables(self) -> list[str]:
        return [t for level in sorted(self.levels) for t in self.levels[level]]

    def drop(self) -> None:
        for table in self.tables():
            drop_bucketed(self.spark, table)
        self.levels = {}

    def merged(self, batch: DataFrame) -> DataFrame:
        """The distinct hashes of a batch (h1, h2, ...) with their owner in the runs, null where they are new."""
        found = batch.withColumn("owner", F.lit(None).cast("long"))
        for table in self.tables():
            run = self.spark.table(table).select(F.col("h1").alias("_h1"), F.col("h2").alias("_h2"), F.col("owner").alias("_owner"))
            joined = found.join(run.hint("merge"), (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2")), "left")
            found = joined.select(*batch.columns, F.coalesce("owner", "_owner").alias("owner"))
        return found

    def add(self, keys: DataFrame) -> DataFrame:
        """Join a batch of line keys with the runs, then add what is new as a run.

        Returns the keys that lose lines: h1, h2 and the doc_id that keeps them.
        Earlier batches go first: a line they hold keeps its document.
        """
        batch = keys.groupBy("h1", "h2").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
        with sorted_scans(self.spark):
            found = saved(self.merged(batch), "lines-batch")
        self._write(found.filter(F.col("owner").isNull()).select("h1", "h2", F.col("first").alias("owner")), 0)
        self.compact()
        return found.select("h1", "h2", F.coalesce("owner", "first").alias("owner"), "last").filter(F.col("owner") != F.col("last")).drop("last")

    def compact(self) -> None:
        """Merge any level with ``fan_out`` runs into one run of the next level."""
        for level in range(len(self.levels)):
            runs = self.levels.get(level, [])
            if len(runs) >= self.fan_out:
                self._write(reduce(DataFrame.unionByName, [self.spark.table(t) for t in runs]), level + 1)
                self.levels[level] = []
                for table in runs:
                    drop_bucketed(self.spark, table)


def _rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[tuple[int, int, str]] = []
        for text, dropped in zip(batch.column("text"), batch.column("dropped")):
            lines = (text.as_py() or "").split("\n")
            gone = set(dropped.as_py() or ())
            kept = [x for i, x in enumerate(lines) if i not in gone] if gone else lines
            out.append((len(lines), len(gone), "\n".join(kept)))
        n, gone, kept = zip(*out) if out else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_key"), batch.column("row"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())],
            names=["doc_id", "text_key", "row", "n_lines", "n_dropped", "kept_text"],
        )


def line_dedup(docs: DataFrame, batches: int = 4, min_chars: int = 10, runs: LineRuns | None = None) -> DataFrame:
    """Drop repeated lines; one row per document: doc_id, text_key, row (its other columns), n_lines, n_dropped, kept_text.

    A key found in two or more documents loses all its lines but those of the
    smallest doc_id; a null or empty text is one empty line; a null doc_id counts
    as the largest; rows that repeat a doc_id are one document.  The documents
    go through the runs in ``batches`` batches of rising doc_id.
    """
    rows = keyed(docs, carry=True)
    spark = docs.sparkSession
    steps = [i / batches for i in range(1, batches)]
    bounds = sorted(set(rows.agg(F.percentile_approx("doc_id", steps)).first()[0] or [])) if steps else []
    number = reduce(lambda a, b: a + b, [(F.col("doc_id") > b).cast("int") for b in bounds], F.lit(0))
    keys = saved(line_keys(rows, min_chars).withColumn("batch", number), "line-keys")
    own = runs or LineRuns(spark)
    try:
        losers = [own.add(keys.filter(F.col("batch") == i)).withColumn("batch", F.lit(i)) for i in range(len(bounds) + 1)]
    finally:
        if runs is None:
            own.drop()
    lost = reduce(DataFrame.unionByName, losers)
    gone = keys.join(lost, ["batch", "h1", "h2"]).filter(F.col("doc_id") != F.col("owner")).groupBy("doc_id", "text_key").agg(F.collect_set("position").alias("dropped"))
    joined = rows.join(gone, ["doc_id", "text_key"], "left").select("doc_id", "text_key", "row", "text", "dropped")
    return in_tasks(joined, _rebuild, f"doc_id long, text_key long, {row_type(rows)}, n_lines long, n_dropped long, kept_text string")


def line_digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 of ``line_dedup``."""
    return line_dedup(docs).select(real_id(), "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))
