"""Score tables and peptide ids on stored layouts: scores bucketed by peptide (T5, A10, A11),
ids of a peptide in chunks of bounded size (A9)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sinks.bucketed import write_bucketed
from .records import ordered_records


def store_scores(scores: DataFrame, table: str | None = None, pep: str = "pep", allele: str = "allele", rank: str = "rank",
                 buckets: int | None = None) -> DataFrame:
    """The distinct ``(pep, allele, rank)`` rows as a table bucketed and sorted by peptide.

    ``best_allele``, ``wide_scores`` and ``attach_binders`` over the result read the
    scores where they lie: they group or join by the bucket column, so no plan
    exchanges them again.  Equal rows are one score and are combined before the only
    shuffle, so a bucket holds each (allele, rank) of a peptide once, however often
    a run repeats it.  NULL peptides and ranks are kept.  ``attach_binders``
    streams the peptide side past its bucket: a peptide that most rows carry takes
    one task long, but no memory; for such tables use it on unstored scores,
    where adaptive execution splits the peptide's rows.
    """
    return write_bucketed(scores.select(pep, allele, rank).distinct(), table or f"scores_{uuid.uuid4().hex[:12]}", [pep], [pep, allele, rank], buckets)


def id_chunks(df: DataFrame, pep: str = "pep", id_col: str = "transid", size: int = 10_000) -> DataFrame:
    """A9 with bounded groups: ``(pep, chunk, ids, n)``, the distinct ids of a peptide in sorted arrays.

    The distinct ``(pep, id)`` pairs are put in one order (``ordered_records``), and
    every ``size`` positions of it are a chunk.  So an array holds ``size`` ids at
    most, whether a peptide has one id or most of the table's; the ids of a
    peptide follow each other in its chunks by rising number (which need not
    start at 0).  NULL ids are no ids; a NULL peptide is a peptide.
    """
    pairs = df.select(F.col(pep).alias("pep"), F.col(id_col).alias("id")).where(F.col("id").isNotNull()).distinct()
    placed = ordered_records(pairs, ["pep", "id"]).withColumn("chunk", F.floor((F.col("position") - 1) / F.lit(size)))
    out = placed.groupBy("pep", "chunk").agg(F.sort_array(F.collect_list("id")).alias("ids"), F.count(F.lit(1)).alias("n"))
    return out.select(F.col("pep").alias(pep), "chunk", F.col("ids").alias(id_col), "n")


def chunk_texts(chunks: DataFrame, id_col: str = "transid", sep: str = ";") -> DataFrame:
    """The chunks as text rows for a sink: one line per chunk, never one for a whole peptide."""
    return chunks.withColumn(id_col, F.array_join(id_col, sep))


def groups_of_chunks(chunks: DataFrame, pep: str = "pep", id_col: str = "transid", sep: str = ";") -> DataFrame:
    """The contract's text form of A9 from the chunks: one row per peptide, all its ids joined (for the sink only)."""
    parts = chunk_texts(chunks, id_col, sep).groupBy(pep).agg(F.sort_array(F.collect_list(F.struct("chunk", id_col))).alias("_parts"), F.sum("n").alias("n_ids"))
    return parts.select(pep, F.array_join(f"_parts.{id_col}", sep).alias(id_col), "n_ids")
