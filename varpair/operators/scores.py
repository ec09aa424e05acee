"""Scorer input/output operators: peptide lists (T2, T3), peptide groups (A9),
best allele (A10), wide scores (A11), allele × length grid (J13) and the
binder report (T5, F15, P12, O2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.strings import nth_token
from ..session import cut_lineage
from .kmers import remove_recognised

# Binder threshold and the "no allele" marker.
MAX_RANK = 0.5
UNKNOWN_ALLELE = "unknown"


def scorer_list(df: DataFrame, id_col: str = "transid", with_reference: bool = True) -> DataFrame:
    """Distinct ``(pep, id, source)``; host peptides, plus the reference
    peptides tagged ``donor`` when the branch is autosomal."""
    host = df.select("pep", id_col).withColumn("source", F.lit("host")).distinct()
    if not with_reference:
        return host
    donor = df.select(F.col("ref_pep").alias("pep"), id_col).withColumn("source", F.lit("donor"))
    return host.unionByName(donor).distinct()


def with_length(df: DataFrame, pep: str = "pep") -> DataFrame:
    """The peptide length as a column, the key a per-length split writes by
    (``partitionBy('len')``) instead of one file per length."""
    return df.withColumn("len", F.length(pep))


def peptide_groups(df: DataFrame, pep: str = "pep", id_col: str = "transid", sep: str = ";") -> DataFrame:
    """One row per peptide with its distinct ids, sorted and joined.

    ``(pep, id)`` pairs are deduplicated first (partial aggregation on the
    map side), so a group holds each id once; its size is the number of
    distinct ids carrying the peptide.
    """
    pairs = df.select(pep, id_col).where(F.col(id_col).isNotNull()).distinct()
    return pairs.groupBy(pep).agg(
        F.array_join(F.sort_array(F.collect_list(id_col)), sep).alias(id_col),
        F.count(F.lit(1)).alias("n_ids"),
    )


def best_allele(
    scores: DataFrame,
    pep: str = "pep",
    allele: str = "allele",
    rank: str = "rank",
    max_rank: float = MAX_RANK,
) -> DataFrame:
    """A10: per peptide the lowest rank and its allele (ties: lowest allele
    name); the allele is ``unknown`` when no rank is below ``max_rank``."""
    agg = scores.where(F.col(rank).isNotNull()).groupBy(pep).agg(
        F.min(rank).alias("best_rank"),
        F.min(F.struct(F.col(rank), F.col(allele)))[allele].alias("_allele"),
    )
    return agg.select(
        pep,
        "best_rank",
        F.when(F.col("best_rank") < max_rank, F.col("_allele")).otherwise(F.lit(UNKNOWN_ALLELE)).alias("best_allele"),
    )


def wide_scores(
    scores: DataFrame,
    alleles: Sequence[str],
    pep: str = "pep",
    allele: str = "allele",
    rank: str = "rank",
) -> DataFrame:
    """One row per peptide, one rank column per allele (explicit allele
    list, so the pivot needs no extra pass to discover values)."""
    return scores.groupBy(pep).pivot(allele, list(alleles)).agg(F.min(rank))


def allele_length_grid(alleles: DataFrame, allele: str = "allele", lo: int = 8, hi: int = 11) -> DataFrame:
    """Every allele with every peptide length (generated per allele row,
    no join)."""
    return alleles.select(allele).distinct().withColumn("len", F.explode(F.sequence(F.lit(lo), F.lit(hi))))


def binders(
    scores: DataFrame,
    rank: str = "assign.MSi_ranks",
    allele: str = "assign.MSi_allele",
    max_rank: float = MAX_RANK,
) -> DataFrame:
    """F15 + P12 + A1 + O2: peptides binding below ``max_rank`` with a known
    allele; gene and peptide start/end parsed from the first id of the
    ``;``-joined id list (``gene:transcript:start_end``); distinct rows
    sorted by length and allele."""
    r, a = F.col(f"`{rank}`"), F.col(f"`{allele}`")
    weak = scores.filter((r < max_rank) & F.coalesce(a != UNKNOWN_ALLELE, F.lit(True)))
    first_id = nth_token("transid", ";", 0)
    pos = nth_token(first_id, ":", 2)
    out = weak.select(
        nth_token(first_id, ":", 0).alias("Gene"),
        nth_token(pos, "_", 0).alias("Peptide-Start-Pos"),
        nth_token(pos, "_", 1).alias("Peptide-End-Pos"),
        F.col("pep").alias("Y-Chr-Peptide"),
        F.col("len").alias("Peptide-Length"),
        a.alias(allele),
        r.alias(rank),
    ).distinct()
    return out.orderBy("Peptide-Length", F.col(f"`{allele}`"))


def attach_binders(
    peptides: DataFrame,
    scores: DataFrame,
    rank: str = "rank",
    allele: str = "allele",
    max_rank: float = MAX_RANK,
) -> DataFrame:
    """T5: scores joined to the peptide table on ``pep``, kept below
    ``max_rank`` with a known allele."""
    good = scores.filter((F.col(rank) < max_rank) & F.coalesce(F.col(allele) != UNKNOWN_ALLELE, F.lit(True)))
    return peptides.join(good, "pep", "inner")


def binder_counts(found: DataFrame, pep: str = "pep", gene: str = "gene", allele: str = "best_allele") -> DataFrame:
    """K5 in rows ``(metric, key, value)``: distinct peptides, and rows per gene
    and per allele (NULL is a value).  Counts are partial sums on the map side,
    so a gene or an allele that holds most rows is no hot key."""
    per = lambda metric, c: found.groupBy(F.col(f"`{c}`").cast("string").alias("key")).agg(F.count(F.lit(1)).alias("value")).select(F.lit(metric).alias("metric"), "key", "value")
    total = found.select(pep).where(F.col(pep).isNotNull()).distinct().agg(F.count(F.lit(1)).alias("value")).select(F.lit("peptides").alias("metric"), F.lit(None).cast("string").alias("key"), "value")
    return total.unionByName(per("gene", gene)).unionByName(per("allele", allele))


def binder_summary(found: DataFrame, pep: str = "pep", gene: str = "gene", allele: str = "best_allele") -> DataFrame:
    """K5: the one-row form for the summary file: ``peptides``, ``gene_count`` and
    ``allele`` (maps; their entries are the distinct genes and alleles, a NULL
    is under the empty name)."""
    counts = binder_counts(found, pep, gene, allele)
    entry = F.struct(F.coalesce("key", F.lit("")), "value")
    cell = lambda metric: F.map_from_entries(F.sort_array(F.collect_list(F.when(F.col("metric") == metric, entry))))
    merged = counts.groupBy("metric", F.coalesce("key", F.lit("")).alias("key")).agg(F.sum("value").alias("value"))
    return merged.agg(F.max(F.when(F.col("metric") == "peptides", F.col("value"))).alias("peptides"), cell("gene").alias("gene_count"), cell("allele").alias("allele"))


def score_branch(
    peptides: DataFrame,
    scores: DataFrame,
    donor_proteome: DataFrame | None = None,
    host_proteome: DataFrame | None = None,
    autosomal: bool = True,
    max_rank: float = MAX_RANK,
) -> dict[str, DataFrame]:
    """One scoring branch: what follows the peptide table of a branch, whichever it is.

    ``peptides``: ``pep, ref_pep (autosomal only), gene, transid``; ``scores``:
    ``pep, allele, rank``; proteomes: ``gene, seq``.

    * with proteomes, peptides that the donor's holds, or another gene of the
      host's, are removed (T4);
    * ``scorer_list``: the scorer's input with lengths (T2, T3);
    * ``peptides``: one row per peptide with its ids (A9);
    * ``best``: lowest rank and its allele (A10);
    * ``binders``: peptide rows whose best rank is below ``max_rank`` (T5, F15),
      and ``binder_counts``: their summary in rows (K5).

    The remaining peptides are written once to the shared checkpoint folder, as
    all four tables read them.
    """
    left = peptides
    if donor_proteome is not None and host_proteome is not None:
        left = remove_recognised(left, donor_proteome, host_proteome)
    left = cut_lineage(left, "branch-peptides")
    best = best_allele(scores, max_rank=max_rank)
    found = attach_binders(left.select("pep", "gene", "transid").distinct(), best, "best_rank", "best_allele", max_rank)
    return {
        "scorer_list": with_length(scorer_list(left, "transid", with_reference=autosomal)),
        "peptides": peptide_groups(left),
        "best": best,
        "binders": found,
        "binder_counts": binder_counts(found),
    }
