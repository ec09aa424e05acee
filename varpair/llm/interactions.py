"""Filter interaction audit: which filter removes what under every order of the filters.

A document fails some of the five filters; only how many documents fail the same
set in a part (one source) matters, so Spark counts (part, failure mask) and the
rest works on 32 masks.  Under an order, the step that removes a mask is the
min-plus product of the mask matrix (0 where the mask fails a filter, infinite
where it passes) with the matrix of the filters' positions (the inverse
permutation): the minimum over filters.  Counts are scattered by that step.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .io import NO_ID, in_tasks

FILTERS = "ABCDE"
#: Removal step of a mask that fails no filter.
_NEVER = 99
_COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
_SCHEMA = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in _COUNTS)


def text_failures(text: Column) -> Column:
    """Bits of the four filters that look at the text alone: few words, repeated words, capitals, signs."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    found = F.struct(F.size(words).alias("n"), F.size(F.array_distinct(words)).alias("kinds"))
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]", ""))
    tests = (
        found["n"] < 50,
        100 * found["kinds"].cast("long") < 65 * found["n"].cast("long"),
        100 * capitals.cast("long") > 5 * F.length(text).cast("long"),
        text.rlike("[#$%&*|]"),
    )
    return sum((F.when(t, 1 << bit).otherwise(0) for bit, t in enumerate(tests)), F.lit(0))


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, n, good, toxic: documents of each part by the set of filters they fail.

    The first four bits follow from the text; equal texts share them, so the
    fifth (a smaller doc_id has the same text) needs only the counts of each
    text and the documents of its smallest id.  Texts are told apart by SHA-256.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    facts = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), text_failures(text).alias("mask"), F.unhex(F.sha2(text, 256)).alias("text"))
    marked = labels.groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.max((F.col("quality") == 1).cast("long")).alias("good"), F.max((F.col("toxic") == 1).cast("long")).alias("toxic")).filter("good = 1 OR toxic = 1")
    of_id = facts.join(marked, "id", "left").groupBy("id", "text", "part", "mask").agg(F.count(F.lit(1)).alias("n"), F.sum(F.coalesce("good", F.lit(0))).alias("good"), F.sum(F.coalesce("toxic", F.lit(0))).alias("toxic"))
    counts = ["n", "good", "toxic"]
    of_text = of_id.groupBy("text", "part", "mask").agg(F.min("id").alias("head"), F.min_by(F.struct(*counts), "id").alias("at_head"), *[F.sum(c).alias(c) for c in counts])
    first = F.min("head").over(Window.partitionBy("text"))
    judged = of_text.withColumn("own", F.when(F.col("head") == first, F.col("at_head")))
    none = [F.coalesce(F.col("own").getField(c), F.lit(0)) for c in counts]
    halves = F.array(
        F.struct("mask", *[x.alias(c) for c, x in zip(counts, none)]),
        F.struct((F.col("mask") + 16).alias("mask"), *[(F.col(c) - x).alias(c) for c, x in zip(counts, none)]),
    )
    return judged.select("part", F.inline(halves)).filter("n > 0").groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in counts])


def removal_steps(n_filters: int = len(FILTERS)) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Orders, each filter's position in them, and the step at which each order removes each mask.

    The positions are the inverse permutations (filters x orders, from 1); the
    steps (masks x orders) the min-plus product of masks and positions.
    """
    orders = np.array(list(permutations(range(n_filters))))
    positions = np.argsort(orders, axis=1).T + 1
    masks = np.where(np.arange(1 << n_filters)[:, None] >> np.arange(n_filters) & 1, 0, _NEVER)
    steps = np.min(masks[:, :, None] + positions[None], axis=1)
    return orders, positions, np.where(steps < _NEVER, steps, _NEVER)


def audit_part(n: np.ndarray, good: np.ndarray, toxic: np.ndarray) -> dict[str, np.ndarray]:
    """All counts (orders x steps) of one part from its counts by mask."""
    orders, positions, steps = removal_steps()
    rows, k = np.arange(len(orders)), orders.shape[1]

    def scattered(weight: np.ndarray, at: np.ndarray) -> np.ndarray:
        out = np.zeros((len(orders), k), dtype=np.int64)
        mask, order = np.nonzero(at <= k)
        np.add.at(out, (order, at[mask, order] - 1), weight[mask])
        return out

    removed = scattered(n, steps)
    redundant = np.zeros_like(removed)
    unique = np.zeros_like(removed)
    shapley = np.zeros_like(removed)
    for f in range(k):
        fails = (np.arange(len(n)) >> f & 1).astype(bool)[:, None]
        late = np.where(fails & (steps < positions[f]), positions[f], _NEVER)
        redundant += scattered(n, late)
        unique[rows, positions[f] - 1] = n[1 << f]
        shapley[rows, positions[f] - 1] = removed[rows, positions[f] - 1].sum()
    return {"kept": n.sum() - np.cumsum(removed, axis=1), "removed": removed, "redundant": redundant, "unique_fails": unique, "good_lost": scattered(good, steps), "toxic_lost": scattered(toxic, steps), "shapley": shapley}


def filter_interactions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the five filters and step.

    A: under 50 words; B: under 65 distinct words in 100; C: over 5 capitals
    (A-Z) in 100 code points; D: one of ``#$%&*|``; E: equal to the text of a
    smaller doc_id.  Null text and null source count as empty; a null doc_id
    is the largest; rows that repeat a doc_id count each, and none of them is
    smaller than another.  A document is good or toxic if any of its label rows
    says 1; label rows of a null doc_id are of no document.  No documents give no rows.  Other columns are not read.
    """
    counts = mask_counts(docs, labels)
    cells = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        orders = ["".join(FILTERS[f] for f in order) for order in removal_steps()[0]]
        k = len(FILTERS)
        for batch in batches:
            for part, found in zip(batch.column("part").to_pylist(), batch.column("cells").to_pylist()):
                table = np.zeros((3, 1 << k), dtype=np.int64)
                for x in found:
                    table[:, x["mask"]] = x["n"], x["good"], x["toxic"]
                result = audit_part(*table)
                size = len(orders) * k
                columns = [pa.array([part] * size, type=pa.string()), pa.array(np.repeat(orders, k)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(orders)))]
                yield pa.RecordBatch.from_arrays([*columns, *(pa.array(result[c].ravel()) for c in _COUNTS)], names=["part", "filter_order", "step", *_COUNTS])

    return in_tasks(cells, run, _SCHEMA)
