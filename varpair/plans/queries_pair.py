"""Queries of the composed two-sample job: windows and peptides of a
pair, a sample's custom proteome, and the Y-chromosome removal (J4, J5, T1, T6, K3)."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from ..functions import genotype as G
from ..operators.kmers import kmers
from ..operators.sequences import mutated_proteins, strand_members
from ..session import cut_lineage, release_shuffles
from ..sinks.bucketed import drop_bucketed
from . import pair_job
from .queries_kmers import _kmer_sql
from .queries_sequences import (
    _ON1,
    _ON2,
    _SPLICE_SQL,
    _STEP,
    GROUP,
    ORDER,
    _strand_window_sql,
    reference_sequences,
    strands,
)
from .registry import register
from .standins import BENCH_ITEMS, CHANGES, DONOR_PROTEOME, HOST_PROTEOME, TRANSCRIPTS, StandIn, pick, with_ctes

# --- the changes of two samples: a third of the transcripts in the host only, a third in the donor only
_SITE = {
    "CHROM": "concat('chr', cast(l_partkey % 22 + 1 as string))",
    "REF": "mutref",
    "ALT": "mutalt",
    "hugoSymbol": "concat('B', cast(l_partkey % 40 as string))",
    "cDnaChange": "concat('c.', cast(ms as string), vt, cast(l_suppkey as string))",
    "tumorSeqAllele2": "mutalt",
}


def _sample(name: str, gt: str, where: str) -> StandIn:
    columns = {c: e for c, e in CHANGES.columns.items() if c not in ("sample", "GT", "hetsite", "protmut1", "protmut2")}
    site = {c: columns[e] if e in columns else e for c, e in _SITE.items()}
    return StandIn(name, "lineitem", pre=CHANGES.pre, columns={**columns, **site, "GT": gt}, where=where)


HOST = _sample("h_changes", pick("(l_orderkey + l_linenumber) % 3", ["0/1", "1/1", "1/2"]), "l_partkey % 3 <> 0")
DONOR = _sample("d_changes", pick("(l_orderkey + l_suppkey) % 3", ["0/1", "1/1", "0/1"]), "l_partkey % 3 <> 1")
_KEYS = [c for c in pair_job.SITE + pair_job.CHANGE]
_ORDER_SQL = "mutstart, POS, tumorSeqAllele2, cDnaChange"


def _sample_sql(p: str) -> str:
    """Strands and proteins of one sample: the per-sample SQL chain on ``{p}_changes``, grouped by transcript."""
    chain = _SPLICE_SQL[_SPLICE_SQL.index(",\ncz AS") :]
    start, end = chain.index(",\nshifted AS"), chain.index(",\nmembers AS")
    chain = chain[:start] + chain[end:]
    chain = chain.replace("sample, annotationTranscript", "annotationTranscript").replace(" AND t.sample = w.sample", "").replace("t.sample, ", "")
    chain = chain.replace("mutstart, POS, variantType, mutalt, protalt, GT", _ORDER_SQL)
    names = ["cz", "s0", "s1", "s2", "s3", "strands", "members", "m1", "m2", "m3", "sp", "sp2", "tr", "per_tx", "wide", "proteins", "changes"]
    return re.sub(rf"(?<=FROM )({'|'.join(names)})\b|(?<=JOIN )({'|'.join(names)})\b|(?<=\n)({'|'.join(names)})(?= AS \()", lambda m: f"{p}_{m[0]}", chain)


def _shift_sql(s: str, k: int) -> str:
    on = re.sub(r"\b(whichdf|evicted)\b", rf"{s}_\1", (_ON1, _ON2)[k - 1])
    return (
        f"CAST(coalesce(sum(CASE WHEN {on} THEN {_STEP} ELSE 0 END) OVER (PARTITION BY annotationTranscript ORDER BY {_ORDER_SQL}"
        f" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS INT) AS {s}_base_{k}"
    )


def _window_sql(s: str, k: int) -> str:
    on = f"coalesce({s}_whichdf, 0) IN ({k}, 3)"
    masked = f"host_hetsite AND coalesce(host_whichdf, 0) IN ({3 - k}, 3)"
    return f"CASE WHEN {masked} OR coalesce(protstart > length(refProtein), false) THEN '*' ELSE {_strand_window_sql(f'{s}_protmut{k}', f'{s}_base_{k}', on)} END AS {s}_w{k}"


_PAIR_SQL = with_ctes(HOST, DONOR) + _sample_sql("h") + _sample_sql("d") + f""",
paired AS (SELECT {', '.join(f'coalesce(h.{k}, d.{k}) AS {k}' for k in _KEYS)},
     coalesce(h.GT, '0/0') AS host_GT, coalesce(d.GT, '0/0') AS donor_GT, coalesce(h.GT = '1/2', false) AS host_hetsite,
     h.whichdf AS host_whichdf, h.evicted AS host_evicted, d.whichdf AS donor_whichdf, d.evicted AS donor_evicted
   FROM h_strands h FULL OUTER JOIN d_strands d ON {' AND '.join(f'h.{k} IS NOT DISTINCT FROM d.{k}' for k in _KEYS)}),
shifted AS (SELECT *, {', '.join(_shift_sql(s, k) for s in ('host', 'donor') for k in (1, 2))} FROM paired),
refs AS (SELECT annotationTranscript, any_value(refProtein) AS refProtein
         FROM (SELECT annotationTranscript, refProtein FROM h_changes UNION ALL SELECT annotationTranscript, refProtein FROM d_changes) GROUP BY 1),
folded AS (SELECT s.* REPLACE (CASE WHEN host_GT = '1/2' THEN '1/1' ELSE host_GT END AS host_GT,
                               CASE WHEN donor_GT = '1/2' THEN '1/1' ELSE donor_GT END AS donor_GT),
     r.refProtein, coalesce(hp.protmut1, r.refProtein) AS host_protmut1, coalesce(hp.protmut2, r.refProtein) AS host_protmut2,
     coalesce(dp.protmut1, r.refProtein) AS donor_protmut1, coalesce(dp.protmut2, r.refProtein) AS donor_protmut2
   FROM shifted s LEFT JOIN refs r USING (annotationTranscript) LEFT JOIN h_proteins hp USING (annotationTranscript)
        LEFT JOIN d_proteins dp USING (annotationTranscript)
   WHERE coalesce(variantClassification <> 'SILENT', true)),
al AS (SELECT *, split_part(host_GT, '/', 1) AS h1, split_part(host_GT, '/', 2) AS h2, split_part(donor_GT, '/', 1) AS d1, split_part(donor_GT, '/', 2) AS d2 FROM folded),
disc AS (SELECT *, CASE WHEN h1 <> d1 AND h1 <> d2 THEN h1 WHEN h2 <> d1 AND h2 <> d2 THEN h2 END AS ALLELE,
     {', '.join(_window_sql(s, k) for s in ('host', 'donor') for k in (1, 2))}
   FROM al WHERE (h1 <> d1 AND h1 <> d2) OR (h2 <> d1 AND h2 <> d2)),
picked AS (SELECT *, CASE WHEN (coalesce(host_whichdf, 0) <> 2) = (ALLELE = '1') THEN 1 ELSE 2 END AS pick FROM disc WHERE ALLELE IN ('0', '1')
           UNION ALL SELECT *, NULL FROM disc WHERE ALLELE NOT IN ('0', '1')),
windows AS (SELECT CHROM, POS, hugoSymbol, annotationTranscript, proteinChange, ALLELE,
     CASE pick WHEN 1 THEN host_w1 WHEN 2 THEN host_w2 END AS host_sequence,
     CASE pick WHEN 1 THEN donor_w1 WHEN 2 THEN donor_w2 END AS donor_sequence FROM picked)"""


def _tables(spark, sf, standin) -> pair_job.SampleTables:
    changes = standin.df(spark, sf)
    return pair_job.sample_tables(changes.withColumn("loci", G.zygosity("GT")))


def pair(spark, sf):
    return pair_job.pair_and_window(_tables(spark, sf, HOST), _tables(spark, sf, DONOR))


@register("pair_windows", _PAIR_SQL + "\nSELECT * FROM windows")
def q_pair_windows(spark, sf):
    """Two samples' changes to discordances with
    both samples' windows; a transcript that one sample leaves unchanged has its
    reference protein there."""
    return pair(spark, sf).select(
        "CHROM", "POS", "hugoSymbol", "annotationTranscript", "proteinChange", "ALLELE", "host_sequence", "donor_sequence"
    )


@register(
    "pair_peptides",
    _PAIR_SQL + """,
d AS (SELECT DISTINCT CHROM, POS, hugoSymbol, annotationTranscript, proteinChange, replace(host_sequence, '*', '') AS m, replace(donor_sequence, '*', '') AS r
      FROM windows WHERE host_sequence IS NOT NULL AND donor_sequence IS NOT NULL),
p AS (SELECT *, CAST(CASE WHEN length(m) < 21 THEN coalesce(list_position(list_transform(range(1, least(length(m), length(r)) + 1),
             lambda i: substring(m, i, 1) <> substring(r, i, 1)), true) - 1, 10) ELSE 10 END AS INT) AS mp FROM d),
l AS (SELECT *, unnest([8, 9, 10, 11]) AS n FROM p),
w AS (SELECT *, unnest(range(greatest(mp - n + 1, 0), greatest(length(m), length(r)) - n + 1)) AS i FROM l),
c AS (SELECT CHROM, POS, hugoSymbol, annotationTranscript, proteinChange, m, r, i, n, substring(m, i + 1, n) AS pep, substring(r, i + 1, n) AS ref_pep FROM w)
SELECT hugoSymbol || '|' || annotationTranscript || '|' || proteinChange || '|len_' || n || '|num_' || i AS transid, POS, pep, ref_pep
FROM c ANTI JOIN (SELECT DISTINCT ref_pep AS x FROM c) u ON c.pep = u.x""",
)
def q_pair_peptides(spark, sf):
    """T1 + J12 on the pair: the 8..11-letter peptides of the discordances that are no reference peptide."""
    tables = [_tables(spark, sf, x) for x in (HOST, DONOR)]
    windows = cut_lineage(pair_job.pair_and_window(*tables), "pair-windows")
    for t in tables:  # the written windows need them no more
        if t.table:
            drop_bucketed(spark, t.table)
    release_shuffles(spark)
    return pair_job.peptides(windows).select("transid", "POS", "pep", "ref_pep")


_SAMPLES = ", ".join(f"'S{i}'" for i in range(29))


@register(
    "custom_proteome",
    _SPLICE_SQL + ",\n" + TRANSCRIPTS.cte() + f""",
ref AS (SELECT *, unnest([{_SAMPLES}]) AS sample FROM transcripts WHERE mrna IS NOT NULL)
SELECT r.gene, r.ensembl_gene, r.sample, r.ensembl_transcript AS annotationTranscript, p.protmut1, p.protmut2
FROM ref r JOIN proteins p ON p.sample = r.sample AND p.annotationTranscript = r.ensembl_transcript
UNION ALL
SELECT r.gene, r.ensembl_gene, r.sample, r.ensembl_transcript, r.refProtein, r.refProtein
FROM ref r ANTI JOIN proteins p ON p.sample = r.sample AND p.annotationTranscript = r.ensembl_transcript""",
)
def q_custom_proteome(spark, sf):
    """K2's table: mutated proteins of every sample's changed transcripts, the
    reference protein on both strands of its other transcripts."""
    s = strands(spark, sf)
    made = mutated_proteins(s, strand_members(s), GROUP, ORDER, sequences=reference_sequences(spark, sf))
    ref = TRANSCRIPTS.df(spark, sf).withColumnRenamed("ensembl_transcript", "annotationTranscript")
    return pair_job.proteome(made, ref, GROUP, [f"S{i}" for i in range(29)])


_Y_SOURCES = [f"src{i}" for i in range(9)]


@register(
    "y_removal",
    with_ctes(BENCH_ITEMS, DONOR_PROTEOME, HOST_PROTEOME) + f""",
{_kmer_sql('bench_items', 'item_id, gene', 'text', 'bk')},
host_rest AS (SELECT * FROM host_proteome WHERE coalesce(gene NOT IN ({', '.join(f"'{g}'" for g in _Y_SOURCES)}), true)),
{_kmer_sql('host_rest', 'gene', 'seq', 'hk')},
{_kmer_sql('donor_proteome', 'doc_id', 'seq', 'dk')},
s1 AS (SELECT item_id, gene, kmer FROM bk ANTI JOIN (SELECT DISTINCT kmer AS x FROM hk) h ON bk.kmer = h.x)
SELECT item_id, gene, kmer AS pep FROM s1 ANTI JOIN (SELECT DISTINCT kmer AS x FROM dk) d ON s1.kmer = d.x""",
)
def q_y_removal(spark, sf):
    """T6 + K3: benchmark peptides minus those in the host corpus without nine listed sources, minus those in the donor corpus."""
    peps = kmers(BENCH_ITEMS.df(spark, sf), "text", keep=["item_id", "gene"]).withColumnRenamed("kmer", "pep")
    genes = spark.createDataFrame([(g,) for g in _Y_SOURCES], "gene string")
    return pair_job.y_peptides(peps, HOST_PROTEOME.df(spark, sf), DONOR_PROTEOME.df(spark, sf), genes)
