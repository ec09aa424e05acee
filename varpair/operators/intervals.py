"""Intervals: merge (W6), range semi-join by a sweep (J15), interval-list rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage, in_tasks
from .joins import natural_join, small_or_shuffled


def merge_intervals(df: DataFrame, chrom: str = "chrom", start: str = "start", end: str = "end") -> DataFrame:
    """Merge overlapping and touching half-open intervals per ``chrom``.

    Gaps and islands as a segmented scan, so one chromosome holding a large
    share of all intervals is still spread over many tasks:

    1. range-partition on ``(chrom, start)`` (sampled bounds): each task
       gets a contiguous slice of the order; the slices are written once to
       the shared checkpoint folder with their number, so the branches below
       read the same slices;
    2. per slice and chromosome, the running max end before each row and the
       slice's own max end / island count;
    3. prefix max / prefix sum over the slices of each chromosome give the
       max end carried into each slice and the island-number offset, joined
       back on ``(slice, chrom)`` without a hint (one row per chromosome and
       slice: the join is a broadcast only if measured small);
    4. a row opens an island when its start lies beyond both the local and
       the carried max end; ``(chrom, island)`` is then aggregated with
       partial min/max, so even one giant island collapses map-side.
    """
    base = df.select(F.col(chrom).alias("_ch"), F.col(start).alias("_s"), F.col(end).alias("_e"))
    ranged = cut_lineage(base.repartitionByRange("_ch", "_s").withColumn("_pid", F.spark_partition_id()), "intervals")
    w = Window.partitionBy("_pid", "_ch").orderBy("_s", "_e")
    staged = ranged.withColumn("_lp", F.max("_e").over(w.rowsBetween(Window.unboundedPreceding, -1)))
    ws = Window.partitionBy("_ch").orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    ends = ranged.groupBy("_pid", "_ch").agg(F.max("_e").alias("_smax"))
    carry = ends.select("_pid", "_ch", F.max("_smax").over(ws).alias("_carry"))
    j = natural_join(staged, carry, "inner", on=["_pid", "_ch"])
    prev = F.greatest(F.col("_lp"), F.col("_carry"))  # greatest skips NULLs
    j = j.withColumn("_new", F.when(prev.isNull() | (F.col("_s") > prev), 1).otherwise(0))
    counts = j.groupBy("_pid", "_ch").agg(F.sum("_new").alias("_k"))
    offs = counts.select("_pid", "_ch", F.coalesce(F.sum("_k").over(ws), F.lit(0)).alias("_off"))
    j = natural_join(j, offs, "inner", on=["_pid", "_ch"])
    j = j.withColumn("_island", F.col("_off") + F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    out = j.groupBy("_ch", "_island").agg(F.min("_s").alias(start), F.max("_e").alias(end))
    return out.select(F.col("_ch").alias(chrom), start, end)


def interval_list_to_bed(lines: DataFrame, text: str = "value") -> DataFrame:
    """Drop ``@`` header lines; ``chrom start end`` with the 1-based
    start made 0-based (half-open)."""
    body = lines.filter(~F.col(text).startswith("@"))
    parts = F.split(F.col(text), "\t")
    return body.select(
        parts[0].alias("chrom"),
        (F.try_element_at(parts, F.lit(2)).try_cast("bigint") - 1).alias("start"),
        F.try_element_at(parts, F.lit(3)).try_cast("bigint").alias("end"),
    )


def points_in_regions(
    points: DataFrame, regions: DataFrame, chrom: str = "chrom", pos: str = "pos", start: str = "start", end: str = "end",
) -> DataFrame:
    """Points with ``start <= pos < end`` for some region of their chrom.

    A plane sweep over range slices: region starts and points are put in one
    order by (chrom, position), and a point lies in a region if the furthest end
    of the regions that start at or before it is beyond it.

    1. regions of one start become the one that reaches furthest (partial max);
    2. starts and points are range-partitioned on the order (sampled bounds;
       points of one position are spread by a hash), sorted, and swept once with
       the running furthest end of their slice; points are written with it,
       together with one row per slice and chrom that holds the slice's own;
    3. the prefix max over the slices of a chrom is carried to each slice.

    A region costs one row whatever its width, and overlapping regions are never
    compared with each point.  Rows with a NULL or an empty region are in none.
    """
    own = regions.select(F.col(chrom).alias("_ch"), F.col(start).cast("long").alias("_x"), F.col(end).cast("long").alias("_e"))
    own = own.where("_ch IS NOT NULL AND _e > _x").groupBy("_ch", "_x").agg(F.max("_e").alias("_e"))
    row = F.struct(*[F.col(f"`{c}`") for c in points.columns])
    asked = points.select(F.col(chrom).alias("_ch"), F.col(pos).cast("long").alias("_x"), row.alias("_row"), F.xxhash64(row).alias("_h")).where("_ch IS NOT NULL AND _x IS NOT NULL")
    both = asked.unionByName(own, allowMissingColumns=True)
    order = ["_ch", "_x", F.col("_row").isNotNull(), "_h"]
    swept = in_tasks(both.repartitionByRange(*order).sortWithinPartitions(*order).select("_ch", "_x", "_e", "_row"), _sweep, T.StructType([both.schema["_ch"], both.schema["_x"], T.StructField("_reach", T.LongType()), T.StructField("_pid", T.IntegerType()), both.schema["_row"]]))
    swept = cut_lineage(swept, "swept")
    ends = swept.where("_row IS NULL").select("_ch", "_pid", "_reach")
    before = Window.partitionBy("_ch").orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    carry = ends.select("_ch", "_pid", F.max("_reach").over(before).alias("_carry")).where("_carry IS NOT NULL")
    found = swept.where("_row IS NOT NULL").join(small_or_shuffled(carry), ["_ch", "_pid"], "left")
    return found.where("greatest(_reach, _carry) > _x").select("_row.*")


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Points with the furthest end of the regions of their chrom that this slice has before them; at the end of each chrom a row without a point."""
    pid, none = TaskContext.get().partitionId(), np.iinfo(np.int64).min
    chrom, reach, seen = None, none, False
    names = ["_ch", "_x", "_reach", "_pid", "_row"]

    def summary(batch: pa.RecordBatch) -> pa.RecordBatch:
        kinds = batch.schema
        return pa.RecordBatch.from_arrays([pa.array([chrom], type=kinds.field("_ch").type), pa.array([None], type=pa.int64()), pa.array([None if reach == none else reach], type=pa.int64()), pa.array([pid], type=pa.int32()), pa.nulls(1, kinds.field("_row").type)], names=names)

    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        last, chroms = batch, batch.column("_ch")
        cuts = np.flatnonzero(pc.not_equal(chroms[1:], chroms[:-1]).to_numpy(zero_copy_only=False)) + 1
        ends = pc.fill_null(batch.column("_e"), none).to_numpy()
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
            if seen and chroms[a].as_py() != chrom:
                yield summary(batch)
                reach = none
            chrom, seen = chroms[a].as_py(), True
            furthest = np.maximum.accumulate(np.maximum(ends[a:b], reach))
            reach = int(furthest[-1])
            part = batch.slice(a, b - a)
            found = pa.array(furthest, mask=furthest == none)
            rows = pa.RecordBatch.from_arrays([part.column("_ch"), part.column("_x"), found, pa.array(np.full(b - a, pid, dtype=np.int32)), part.column("_row")], names=names)
            yield rows.filter(part.column("_row").is_valid())
    if seen:
        yield summary(last)
