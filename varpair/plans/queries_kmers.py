"""Queries for peptide chopping, proteome occurrence and scorer tables
(T1–T6, J11, J12, F14, F15, A9–A11, J13, P12)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.kmers import (
    chop,
    drop_full_hits,
    kmers,
    peptides_without_full_hit,
    remove_recognised,
    window_summary,
)
from ..operators.score_store import chunk_texts, id_chunks, store_scores
from ..operators.scores import (
    allele_length_grid,
    attach_binders,
    best_allele,
    binders,
    peptide_groups,
    scorer_list,
    wide_scores,
    with_length,
)
from ..functions.strings import nth_token
from .registry import ORACLE, register
from .standins import (
    ALLELES,
    BENCH_ITEMS,
    DOC_SEQS,
    DONOR_PROTEOME,
    HITS,
    HOST_PROTEOME,
    PEPTIDE_ROWS,
    SCORES,
    with_ctes,
)

_CHOP_SQL = with_ctes(DOC_SEQS) + """,
d AS (SELECT DISTINCT doc_id, replace(mut, '*', '') AS m, replace(ref, '*', '') AS r FROM doc_seqs),
p AS (SELECT doc_id, m, r,
        CAST(CASE WHEN length(m) < 21 THEN coalesce(list_position(list_transform(range(1, least(length(m), length(r)) + 1),
             lambda i: substring(m, i, 1) <> substring(r, i, 1)), true) - 1, 10) ELSE 10 END AS INT) AS pos,
        greatest(length(m), length(r)) AS maxlen
      FROM d),
l AS (SELECT *, unnest(range(8, 12)) AS L FROM p),
w AS (SELECT *, unnest(range(greatest(pos - L + 1, 0), maxlen - L + 1)) AS i FROM l),
c AS (SELECT doc_id, substring(m, i + 1, L) AS pep, substring(r, i + 1, L) AS ref_pep, i AS pep_num,
             pos - L AS pep_mut_loc, L AS pep_length, pos + 1 AS seq_mut_pos FROM w)"""

_SUMMARY_SQL = """
SELECT doc_id, CAST(pep_length AS BIGINT) AS pep_length, count(*) AS n_peps, count(DISTINCT pep) AS n_distinct,
       min(pep) AS min_pep, max(pep) AS max_pep, CAST(min(pep_num) AS BIGINT) AS first_start,
       CAST(max(seq_mut_pos) AS BIGINT) AS seq_mut_pos, CAST(max(pep_mut_loc) AS BIGINT) AS pep_mut_loc
FROM {src} GROUP BY doc_id, pep_length"""


def _summary(peps):
    """Per (document, length): rows, distinct peptides, min/max peptide, first
    start.  Documents that fit a task are summarised where their windows are cut.
    For the others the distinct count is two plain aggregations (per peptide, then
    per group), both with map-side partial aggregation, instead of the
    row-doubling Expand plan of a mixed distinct aggregate."""
    own, crowded = peps.split()
    out = window_summary(own)
    return out if crowded is None else out.unionByName(_summary_of_rows(crowded.windows()))


def _summary_of_rows(df):
    per_pep = df.groupBy("doc_id", "pep_length", "pep").agg(
        F.count(F.lit(1)).alias("_c"),
        F.min("pep_num").alias("_first"),
        F.max("seq_mut_pos").alias("_smp"),
        F.max("pep_mut_loc").alias("_pml"),
    )
    return per_pep.groupBy("doc_id", F.col("pep_length").cast("bigint").alias("pep_length")).agg(
        F.sum("_c").alias("n_peps"),
        F.count(F.lit(1)).alias("n_distinct"),
        F.min("pep").alias("min_pep"),
        F.max("pep").alias("max_pep"),
        F.min("_first").cast("bigint").alias("first_start"),
        F.max("_smp").cast("bigint").alias("seq_mut_pos"),
        F.max("_pml").cast("bigint").alias("pep_mut_loc"),
    )


@register("kmer_chop", _CHOP_SQL + _SUMMARY_SQL.format(src="c"))
def q_kmer_chop(spark, sf):
    """T1 + C12 on whole texts: every 8..11-letter window of each document
    that can hold the change, mutant and reference slices; summarised per
    document and length (count, distinct, min/max peptide, first start)."""
    peps = chop(DOC_SEQS.df(spark, sf), "mut", "ref", keep=["doc_id"], remove_reference_peptides=False, packed=True)
    return _summary(peps)


@register(
    "kmer_absent",
    _CHOP_SQL + """,
g AS (SELECT doc_id, pep_length, pep, count(*) AS n, min(pep_num) AS first, max(seq_mut_pos) AS smp, max(pep_mut_loc) AS pml
      FROM c GROUP BY doc_id, pep_length, pep),
refs AS (SELECT DISTINCT ref_pep FROM c WHERE ref_pep IS NOT NULL),
k AS (SELECT g.* FROM g ANTI JOIN refs ON g.pep = refs.ref_pep)
SELECT doc_id, CAST(pep_length AS BIGINT) AS pep_length, CAST(sum(n) AS BIGINT) AS n_peps, count(*) AS n_distinct,
       min(pep) AS min_pep, max(pep) AS max_pep, CAST(min(first) AS BIGINT) AS first_start,
       CAST(max(smp) AS BIGINT) AS seq_mut_pos, CAST(max(pml) AS BIGINT) AS pep_mut_loc
FROM k GROUP BY doc_id, pep_length""",
)
def q_kmer_absent(spark, sf):
    """T1 + J12 on whole texts: chopped windows whose peptide equals no
    reference peptide anywhere in the table (global anti join)."""
    peps = chop(DOC_SEQS.df(spark, sf), "mut", "ref", keep=["doc_id"], remove_reference_peptides=True, packed=True)
    return _summary(peps)


def _kmer_sql(src: str, cols: str, seq: str, name: str) -> str:
    return f"""{name}_l AS (SELECT *, unnest([8, 9, 10, 11]) AS L FROM (SELECT DISTINCT {cols}, {seq} FROM {src} WHERE {seq} IS NOT NULL)),
{name} AS (SELECT {cols}, substring({seq}, i, L) AS kmer FROM (SELECT *, unnest(range(1, length({seq}) - L + 2)) AS i FROM {name}_l))"""


_RECOG_SQL = with_ctes(BENCH_ITEMS, DONOR_PROTEOME, HOST_PROTEOME) + f""",
{_kmer_sql('bench_items', 'item_id, gene', 'text', 'bk')},
{_kmer_sql('donor_proteome', 'doc_id', 'seq', 'dk')},
{_kmer_sql('host_proteome', 'gene', 'seq', 'hk')},
dh AS (SELECT DISTINCT kmer FROM dk WHERE kmer IN (SELECT kmer FROM bk)),
hh AS (SELECT DISTINCT gene, kmer FROM hk WHERE kmer IN (SELECT kmer FROM bk)),
s1 AS (SELECT item_id, gene, kmer AS pep FROM bk WHERE kmer NOT IN (SELECT kmer FROM dh))
SELECT item_id, gene, pep FROM s1
WHERE NOT EXISTS (SELECT 1 FROM hh WHERE hh.kmer = s1.pep AND hh.gene IS DISTINCT FROM s1.gene)"""


@register("kmer_recognised", _RECOG_SQL)
def q_kmer_recognised(spark, sf):
    """J11 + T4 + T6: benchmark peptides (all 8..11-letter windows) removed
    when they occur exactly in the donor corpus, then when they occur in a
    host-corpus text of another gene (whole texts, k-mer equi-joins)."""
    peps = kmers(BENCH_ITEMS.df(spark, sf), "text", keep=["item_id", "gene"]).withColumnRenamed("kmer", "pep")
    out = remove_recognised(peps, DONOR_PROTEOME.df(spark, sf), HOST_PROTEOME.df(spark, sf), "pep", "gene", "seq")
    return out.select("item_id", "gene", "pep")


@register(
    "hit_filter",
    with_ctes(HITS) + """
SELECT DISTINCT protein_id, peptide_id AS transid, CAST(peptide_len AS BIGINT) AS len, peptide_seq AS pep,
       split_part(peptide_id, ':', 1) AS gene
FROM hits WHERE NOT coalesce(peptide_len = alignment_length AND p_ident = 100, false)""",
)
def q_hit_filter(spark, sf):
    """S9 schema + F14 + P12 + A1: drop full-length perfect alignment rows,
    parse the peptide gene, keep distinct (protein, peptide) rows."""
    h = drop_full_hits(HITS.df(spark, sf))
    return h.select(
        "protein_id", F.col("peptide_id").alias("transid"), F.col("peptide_len").cast("bigint").alias("len"),
        F.col("peptide_seq").alias("pep"), nth_token("peptide_id", ":", 0).alias("gene"),
    ).distinct()


@register(
    "hit_filter_peptides",
    with_ctes(HITS) + """,
p AS (SELECT DISTINCT peptide_id, peptide_seq FROM hits)
SELECT peptide_id, peptide_seq FROM p
WHERE peptide_id NOT IN (SELECT peptide_id FROM hits WHERE peptide_len = alignment_length AND p_ident = 100)""",
)
def q_hit_filter_peptides(spark, sf):
    """Peptide-level form of F14 (Q5): peptides without any full-length perfect hit."""
    h = HITS.df(spark, sf)
    peps = h.select("peptide_id", "peptide_seq").distinct()
    return peptides_without_full_hit(peps, h)


@register(
    "scorer_list",
    with_ctes(PEPTIDE_ROWS) + """
SELECT pep, transid, source, CAST(length(pep) AS BIGINT) AS len FROM (
  SELECT DISTINCT pep, transid, 'host' AS source FROM peptide_rows
  UNION SELECT DISTINCT ref_pep AS pep, transid, 'donor' AS source FROM peptide_rows)""",
)
def q_scorer_list(spark, sf):
    """T2 + T3: host peptides plus donor reference peptides, tagged, distinct,
    with the length that splits the scorer input."""
    out = with_length(scorer_list(PEPTIDE_ROWS.df(spark, sf), "transid", with_reference=True))
    return out.withColumn("len", F.col("len").cast("bigint"))


@register(
    "peptide_groups",
    with_ctes(PEPTIDE_ROWS) + """
SELECT pep, string_agg(DISTINCT transid, ';' ORDER BY transid) AS transid, count(DISTINCT transid) AS n_ids
FROM peptide_rows WHERE transid IS NOT NULL GROUP BY pep""",
)
def q_peptide_groups(spark, sf):
    """One row per peptide, its distinct ids sorted and joined with ';'."""
    return peptide_groups(PEPTIDE_ROWS.df(spark, sf))


@register(
    "best_allele",
    with_ctes(SCORES) + """,
b AS (SELECT pep, min(rank) AS best_rank, arg_min(allele, (rank, allele)) AS a FROM scores WHERE rank IS NOT NULL GROUP BY pep)
SELECT pep, best_rank, CASE WHEN best_rank < 0.5 THEN a ELSE 'unknown' END AS best_allele FROM b""",
)
def q_best_allele(spark, sf):
    """A10: lowest rank per peptide and its allele; 'unknown' above the 0.5 threshold."""
    return best_allele(SCORES.df(spark, sf))


@register(
    "wide_scores",
    with_ctes(SCORES) + "\nSELECT pep, "
    + ", ".join(f"min(CASE WHEN allele = '{a}' THEN rank END) AS \"{a}\"" for a in ALLELES)
    + " FROM scores GROUP BY pep",
)
def q_wide_scores(spark, sf):
    """Wide table of the best rank of each peptide per allele."""
    return wide_scores(SCORES.df(spark, sf), ALLELES)


@register(
    "allele_length_grid",
    """SELECT DISTINCT s_name AS allele, CAST(L AS INT) AS len FROM (SELECT s_name, unnest(range(8, 12)) AS L FROM supplier)""",
)
def q_allele_length_grid(spark, sf):
    """Every allele of the allele list (one per supplier) with every peptide length 8..11."""
    alleles = spark.read.parquet(f"{sf}/supplier.parquet").select(F.col("s_name").alias("allele"))
    return allele_length_grid(alleles).withColumn("len", F.col("len").cast("int"))


@register(
    "binder_report",
    with_ctes(SCORES) + """,
w AS (SELECT DISTINCT split_part(split_part(transid, ';', 1), ':', 1) AS "Gene",
        split_part(split_part(split_part(transid, ';', 1), ':', 3), '_', 1) AS "Peptide-Start-Pos",
        split_part(split_part(split_part(transid, ';', 1), ':', 3), '_', 2) AS "Peptide-End-Pos",
        pep AS "Y-Chr-Peptide", len AS "Peptide-Length", allele AS "assign.MSi_allele", rank AS "assign.MSi_ranks"
      FROM scores WHERE rank < 0.5 AND coalesce(allele <> 'unknown', true))
SELECT * FROM w""",
)
def q_binder_report(spark, sf):
    """F15 + P12 + O2: binders below rank 0.5 with a known allele, gene and
    peptide positions parsed from the id, distinct, ordered by length and allele."""
    s = SCORES.df(spark, sf).select(
        "pep", "transid", "len",
        F.col("allele").alias("assign.MSi_allele"), F.col("rank").alias("assign.MSi_ranks"),
    )
    return binders(s)


@register(
    "binder_join",
    with_ctes(PEPTIDE_ROWS, SCORES) + """
SELECT p.pep, p.transid, p.CHROM, s.allele, s.rank
FROM peptide_rows p JOIN (SELECT pep, allele, rank FROM scores WHERE rank < 0.5 AND coalesce(allele <> 'unknown', true)) s
ON p.pep = s.pep""",
)
def q_binder_join(spark, sf):
    """T5: score rows joined to the peptide table on the peptide, kept below rank 0.5."""
    peps = PEPTIDE_ROWS.df(spark, sf).select("pep", "transid", "CHROM")
    sc = SCORES.df(spark, sf).select("pep", "allele", "rank")
    return attach_binders(peps, sc).select("pep", "transid", "CHROM", "allele", "rank")


@register("stored_best_allele", ORACLE["best_allele"])
def q_stored_best_allele(spark, sf):
    """A10 over the score table stored by peptide: grouped where it lies."""
    return best_allele(store_scores(SCORES.df(spark, sf)))


@register("stored_wide_scores", ORACLE["wide_scores"])
def q_stored_wide_scores(spark, sf):
    """A11 over the score table stored by peptide."""
    return wide_scores(store_scores(SCORES.df(spark, sf)), ALLELES)


@register("stored_binder_join", ORACLE["binder_join"].replace("(SELECT pep, allele, rank", "(SELECT DISTINCT pep, allele, rank"))
def q_stored_binder_join(spark, sf):
    """T5 over the score table stored by peptide, each distinct score once."""
    peps = PEPTIDE_ROWS.df(spark, sf).select("pep", "transid", "CHROM")
    return attach_binders(peps, store_scores(SCORES.df(spark, sf))).select("pep", "transid", "CHROM", "allele", "rank")


@register(
    "peptide_id_chunks",
    with_ctes(PEPTIDE_ROWS) + """,
placed AS (SELECT pep, transid, (row_number() OVER (ORDER BY pep, transid) - 1) // 1000 AS chunk
  FROM (SELECT DISTINCT pep, transid FROM peptide_rows WHERE transid IS NOT NULL))
SELECT pep, CAST(chunk AS BIGINT) AS chunk, string_agg(transid, ';' ORDER BY transid) AS transid, count(*) AS n FROM placed GROUP BY pep, chunk""",
)
def q_peptide_id_chunks(spark, sf):
    """A9 with bounded groups: the ids of a peptide in chunks of 1,000 positions at most."""
    return chunk_texts(id_chunks(PEPTIDE_ROWS.df(spark, sf), size=1000))
