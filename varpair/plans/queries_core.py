"""Queries for pairing, genotypes, discordance and joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import genotype as G
from ..operators.pairing import discordant, pair_samples
from .registry import register
from .standins import DONOR_CALLS, HOST_CALLS, SITE_KEYS, with_ctes


def sample_genotypes(spark, sf, standin, sample):
    """Per-sample genotype column and the F5 genotype filter."""
    df = standin.df(spark, sf).withColumn("GT", G.gt_field(sample)).drop(sample)
    return df.filter(F.col("GT").isin(*G.KEPT_GENOTYPES))


_SITE_SQL_KEYS = ", ".join(f"coalesce(h.{k}, d.{k}) AS {k}" for k in SITE_KEYS)
_SITE_SQL_ON = " AND ".join(f"h.{k} IS NOT DISTINCT FROM d.{k}" for k in SITE_KEYS)

PAIRED_SQL = with_ctes(HOST_CALLS, DONOR_CALLS) + f""",
h AS (SELECT {', '.join(SITE_KEYS)}, split_part(host, ':', 1) AS GT FROM host_calls
      WHERE split_part(host, ':', 1) IN ('0/1', '1/1', '1/2')),
d AS (SELECT {', '.join(SITE_KEYS)}, split_part(donor, ':', 1) AS GT FROM donor_calls
      WHERE split_part(donor, ':', 1) IN ('0/1', '1/1', '1/2')),
paired AS (SELECT {_SITE_SQL_KEYS}, coalesce(h.GT, '0/0') AS host_GT, coalesce(d.GT, '0/0') AS donor_GT
           FROM h FULL OUTER JOIN d ON {_SITE_SQL_ON})"""

_DISC_SQL = PAIRED_SQL + """,
folded AS (SELECT * REPLACE (
             CASE WHEN host_GT = '1/2' THEN '1/1' ELSE host_GT END AS host_GT,
             CASE WHEN donor_GT = '1/2' THEN '1/1' ELSE donor_GT END AS donor_GT)
           FROM paired WHERE coalesce(variantClassification <> 'SILENT', true)),
al AS (SELECT *, regexp_split_to_array(host_GT, '[/|]')[1] AS h1, regexp_split_to_array(host_GT, '[/|]')[2] AS h2,
              regexp_split_to_array(donor_GT, '[/|]')[1] AS d1, regexp_split_to_array(donor_GT, '[/|]')[2] AS d2
       FROM folded)
"""


@register(
    "discordance",
    _DISC_SQL
    + """SELECT CHROM, POS, REF, ALT, variantClassification, host_GT, donor_GT,
       CASE WHEN h1 <> d1 AND h1 <> d2 THEN h1 WHEN h2 <> d1 AND h2 <> d2 THEN h2 END AS ALLELE
FROM al
WHERE coalesce(h1 <> d1 AND h1 <> d2, false) OR coalesce(h2 <> d1 AND h2 <> d2, false)""",
)
def q_discordance(spark, sf):
    """F11 + C10 on two samples: genotype split, null-safe full outer pairing,
    silent filter, 1/2 folding, alleles of the host the donor lacks."""
    host = sample_genotypes(spark, sf, HOST_CALLS, "host")
    donor = sample_genotypes(spark, sf, DONOR_CALLS, "donor")
    paired = pair_samples(host, donor, SITE_KEYS)
    out = discordant(paired)
    return out.select(*SITE_KEYS, "host_GT", "donor_GT", G.foreign_allele("host_GT", "donor_GT").alias("ALLELE"))
