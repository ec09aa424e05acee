"""Record-level operators: duplicate marking (W7) and ordered output."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage
from .joins import natural_join, small_or_shuffled


def _descending(df: DataFrame, score: str) -> list[Column]:
    """Sort columns that put the highest score first in ascending order, NULL last."""
    kind, c = df.schema[score].dataType, F.col(score)
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return [c.isNull(), -c.cast("decimal(20,0)")]
    if isinstance(kind, T.DecimalType):
        return [c.isNull(), -c]
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return [c.isNull(), ~F.isnan(c), -c]
    raise TypeError(f"{score} is not a number")


def mark_duplicates(df: DataFrame, key: Sequence[str], score: str, tie: Sequence[str], drop: bool = False) -> DataFrame:
    """Among rows sharing ``key`` (NULL keys match each other) keep the
    highest ``score`` (NULL lowest), ties broken by the smallest ``tie``; the
    others get ``duplicate = true`` (or are dropped).  ``tie`` must identify a
    row within its key.

    One aggregate finds the best (score, tie) of a key, with partial
    aggregation on the map side, so a key holding a third of all rows is
    combined across many tasks; one null-safe join on the key marks the rows.
    """
    ranked = df.withColumn("_rank", F.struct(*[c.alias(f"s{i}") for i, c in enumerate(_descending(df, score))], *tie))
    best = ranked.groupBy(*key).agg(F.min("_rank").alias("_best"))
    out = natural_join(ranked, best, "inner", on=key)
    out = out.select(*df.columns, (~F.col("_rank").eqNullSafe(F.col("_best"))).alias("duplicate"))
    return out.filter(~F.col("duplicate")).drop("duplicate") if drop else out


def ordered_records(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """A total order by ``order`` with the global position as a column.

    The rows are range-partitioned on the sort keys (sampled bounds, so a hot
    leading key does not pin one task with the whole table), sorted, numbered
    within their range and written once to the shared checkpoint folder: range
    counts and rows are then read from the same ranges, whatever columns the
    frame carries.  Position = rows of earlier ranges + number in the range; the
    rows are shuffled once, for the ranges.
    """
    # the id is the number of the range in its upper bits, and the place within it in the lower 33
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id())
    ranged = cut_lineage(ranged, "ordered").withColumn("_pid", F.shiftright("_id", 33))
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # one row per range
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    rank = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return (
        ranged.join(small_or_shuffled(offs), "_pid")
        .withColumn("position", (F.col("_off") + rank).cast("bigint"))
        .select(*df.columns, "position")
    )
