"""Queries of the scoring branches and of cohorts (T2–T5, A9, A10, F15, K5; J3 for several samples)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.pairing import pair_cohort
from ..operators.scores import score_branch
from .queries_kmers import _kmer_sql
from .registry import register
from .standins import _SITE, GTS, PEPTIDE_ROWS, SCORES, SITE_KEYS, StandIn, amino, pick, with_ctes

# --- proteomes that hold some of the peptides: a fifth of the proteins in the donor's,
#     a third in the host's under the peptide's own gene or another
_SEQ = amino("p_partkey", "h")
DONOR_PROTEINS = StandIn("donor_proteins", "part", {"gene": "concat('B', cast(p_partkey % 40 as string))", "seq": _SEQ}, where="p_partkey % 5 = 0")
HOST_PROTEINS = StandIn("host_proteins", "part", {"gene": "concat('B', cast((p_partkey + p_size % 2) % 40 as string))", "seq": _SEQ}, where="p_partkey % 3 = 1")

_BRANCH_SQL = with_ctes(PEPTIDE_ROWS, SCORES, DONOR_PROTEINS, HOST_PROTEINS) + f""",
peps AS (SELECT DISTINCT pep, transid, split_part(transid, ':', 1) AS gene FROM peptide_rows),
{_kmer_sql('donor_proteins', 'gene', 'seq', 'dk')},
{_kmer_sql('host_proteins', 'gene', 'seq', 'hk')},
foreign_peps AS (SELECT * FROM peps ANTI JOIN (SELECT DISTINCT kmer FROM dk) d ON pep = kmer),
own AS (SELECT f.* FROM foreign_peps f WHERE NOT EXISTS (SELECT 1 FROM hk WHERE hk.kmer = f.pep AND hk.gene IS DISTINCT FROM f.gene)),
best AS (SELECT pep, min(rank) AS best_rank, arg_min(allele, (rank, allele)) AS best_allele FROM scores WHERE rank IS NOT NULL GROUP BY pep),
found AS (SELECT o.pep, o.gene, o.transid, b.best_rank, b.best_allele FROM own o JOIN best b ON o.pep = b.pep WHERE b.best_rank < 0.5)"""


def _branch(spark, sf):
    peptides = PEPTIDE_ROWS.df(spark, sf).withColumn("gene", F.split_part("transid", F.lit(":"), F.lit(1)))
    return score_branch(peptides, SCORES.df(spark, sf), DONOR_PROTEINS.df(spark, sf), HOST_PROTEINS.df(spark, sf))


@register("score_branch", _BRANCH_SQL + "\nSELECT * FROM found")
def q_score_branch(spark, sf):
    """T4 + A10 + T5 + F15: peptides that neither proteome explains, with their best allele, below rank 0.5."""
    return _branch(spark, sf)["binders"]


@register(
    "branch_peptides",
    _BRANCH_SQL + "\nSELECT pep, string_agg(DISTINCT transid, ';' ORDER BY transid) AS transid, count(DISTINCT transid) AS n_ids FROM own GROUP BY pep",
)
def q_branch_peptides(spark, sf):
    """T4 + A9: the peptides left of a branch with their ids."""
    return _branch(spark, sf)["peptides"]


@register(
    "binder_summary",
    _BRANCH_SQL + """
SELECT 'peptides' AS metric, CAST(NULL AS VARCHAR) AS key, count(DISTINCT pep) AS value FROM found
UNION ALL SELECT 'gene', gene, count(*) FROM found GROUP BY gene
UNION ALL SELECT 'allele', best_allele, count(*) FROM found GROUP BY best_allele""",
)
def q_binder_summary(spark, sf):
    """K5: distinct peptides, and binders per gene and allele."""
    return _branch(spark, sf)["binder_counts"]


# --- three samples of one cohort; each lacks a third of the sites
def _calls(name: str, i: int) -> StandIn:
    return StandIn(name, "lineitem", {**_SITE, "GT": pick(f"(l_orderkey + {i + 1} * l_linenumber) % 5", GTS), "depth": f"l_linenumber + {i}"}, where=f"l_orderkey % 3 <> {i}")


COHORT = {name: _calls(f"{name}_calls", i) for i, name in enumerate(("father", "mother", "child"))}


def _cohort_sql() -> str:
    on = lambda a, b: " AND ".join(f"{a}.{k} IS NOT DISTINCT FROM {b}.{k}" for k in SITE_KEYS)
    both = ", ".join(f"coalesce(f.{k}, m.{k}) AS {k}" for k in SITE_KEYS)
    keys = ", ".join(f"coalesce(b.{k}, c.{k}) AS {k}" for k in SITE_KEYS)
    cells = ", ".join(f"coalesce({s}_GT, '0/0') AS {s}_GT, {s}_depth" for s in COHORT)
    # the stand-in table repeats a few sites; a repeated site is one site
    return with_ctes(*COHORT.values()) + f""",
f AS (SELECT DISTINCT * FROM father_calls), m AS (SELECT DISTINCT * FROM mother_calls),
b AS (SELECT {both}, f.GT AS father_GT, f.depth AS father_depth, m.GT AS mother_GT, m.depth AS mother_depth FROM f FULL JOIN m ON {on('f', 'm')}),
c AS (SELECT DISTINCT * EXCLUDE (GT, depth), GT AS child_GT, depth AS child_depth FROM child_calls)
SELECT {keys}, {cells} FROM b FULL JOIN c ON {on('b', 'c')}"""


@register("cohort_sites", _cohort_sql())
def q_cohort_sites(spark, sf):
    """J3 for three samples: every site once, paired in one shuffle."""
    return pair_cohort({s: x.df(spark, sf) for s, x in COHORT.items()}, SITE_KEYS)
