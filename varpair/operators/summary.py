"""Counts and run summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """A3: rows per value, most frequent first (NULL counted as a value)."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), col)


def counts_map(df: DataFrame, col: str) -> DataFrame:
    """A4: value counts as one map-valued row (values must be non-NULL keys)."""
    vc = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return vc.agg(F.map_from_entries(F.collect_list(F.struct(F.col(col), F.col("n")))).alias(f"{col}_counts"))


def observed(df: DataFrame, name: str, null_cols: Sequence[str] = ()) -> tuple[DataFrame, Observation]:
    """A7 + F18: stage row count (and NULL counts) collected while the stage
    runs for its real consumer: no extra pass over the data."""
    obs = Observation(name)
    metrics = [F.count(F.lit(1)).alias("rows")] + [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in null_cols]
    return df.observe(obs, *metrics), obs


def distinct_counts(df: DataFrame, cols: Sequence[str], tuples: Sequence[Sequence[str]] = ()) -> DataFrame:
    """A1 + A2: exact distinct counts of single columns and column tuples in
    one aggregate (Spark plans the distinct counts with an Expand, one shuffle)."""
    aggs = [F.count_distinct(c).alias(f"n_{c}") for c in cols]
    aggs += [F.count_distinct(*t).alias("n_" + "_".join(t)) for t in tuples]
    return df.agg(F.count(F.lit(1)).alias("rows"), *aggs)


def distinct_sketches(df: DataFrame, cols: Sequence[str], tuples: Sequence[Sequence[str]] = (), log_size: int = 12) -> DataFrame:
    """A2 mergeable over runs: rows ``(metric, sketch)``, a HyperLogLog sketch of
    ``2**log_size`` registers for each column and column tuple.

    The metrics have the names of ``distinct_counts``; as there, a value with a
    NULL is none.  A run keeps its rows (a few kilobytes each) beside its exact
    counts; ``merge_sketches`` counts over any number of runs without their data.
    """
    of = lambda names: F.hll_sketch_agg(F.when(~F.greatest(*[F.col(c).isNull() for c in names], F.lit(False)), F.xxhash64(*names)), F.lit(log_size))
    every = [(f"n_{c}", [c]) for c in cols] + [("n_" + "_".join(t), list(t)) for t in tuples]
    one = df.agg(*[of(names).alias(metric) for metric, names in every])
    return one.select(F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("sketch")) for m, _ in every])).alias("r")).select("r.*")


def merge_sketches(sketches: DataFrame) -> DataFrame:
    """``(metric, value, sketch)``: distinct values over all runs whose sketch rows are in ``sketches``.

    The relative standard error is ``1.04 / sqrt(2**log_size)`` (1.6 % at 12);
    ``sketch`` can be kept and merged again.
    """
    union = sketches.groupBy("metric").agg(F.hll_union_agg("sketch", F.lit(False)).alias("sketch"))
    return union.select("metric", F.hll_sketch_estimate("sketch").alias("value"), "sketch")


def summary_long(parts: dict[str, DataFrame]) -> DataFrame:
    """K6 stacked: one-row summaries to ``(stage, metric, value)`` rows via
    ``stack`` per part and ``unionByName``."""
    out = None
    for stage, df in parts.items():
        cols = df.columns
        expr = "stack({n}, {pairs}) as (metric, value)".format(
            n=len(cols), pairs=", ".join(f"'{c}', cast(`{c}` as bigint)" for c in cols)
        )
        long = df.selectExpr(expr).withColumn("stage", F.lit(stage)).select("stage", "metric", "value")
        out = long if out is None else out.unionByName(long)
    return out


def summary_wide(parts: dict[str, DataFrame]) -> DataFrame:
    """K6 side by side: the one-row summaries pasted into one row.  Each part
    is a global aggregate (exactly one row), so pasting is a join on a
    constant key of one-row inputs."""
    out = None
    for stage, df in parts.items():
        one = df.select(F.lit(1).alias("_one"), *[F.col(c).alias(f"{stage}_{c}") for c in df.columns])
        out = one if out is None else out.join(one, "_one")
    return out.drop("_one")
