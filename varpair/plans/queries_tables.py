"""Queries for annotations, joins, gene sets, summaries, intervals and records
(C2–C4, P2–P13, F2–F8, J1–J10, J14, J15, U1–U6, A1–A8, K5, K6, W6, W7, O2–O4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import genotype as G
from ..functions.strings import compound_id, nth_token
from ..operators import annotations as A
from ..operators.genesets import (
    class_size_histogram,
    class_value_counts,
    expressed_genes,
    fixed_class_counts,
    flag_gene_sets,
    gene_classes,
    tissue_classes,
)
from ..operators.intervals import merge_intervals, points_in_regions
from ..operators.joins import natural_join
from ..operators.pairing import discordant, pair_samples, pick_foreign
from ..operators.records import mark_duplicates, ordered_records
from ..operators.summary import distinct_counts, distinct_sketches, merge_sketches, summary_long, summary_wide
from .queries_core import PAIRED_SQL, sample_genotypes
from .registry import register
from .standins import CHANGES, DONOR_CALLS, HOST_CALLS, SITE_KEYS, TRANSCRIPTS, StandIn, pick, with_ctes

# ----------------------------------------------------------------- stand-ins
ANN_FIELDS = ["hugoSymbol", "variantClassification", "annotationTranscript", "proteinChange"]
_CLS = pick("l_linenumber % 5", ["MISSENSE", "SILENT", "NONSENSE", "FRAME_SHIFT_DEL", "INTRON"])
ANN_VCF = StandIn(
    "ann_vcf",
    "lineitem",
    {
        "CHROM": "concat('chr', cast(l_partkey % 22 + 1 as string))",
        "POS": "l_orderkey * 8 + l_linenumber",
        "INFO": "concat('FUNCOTATION=[', CASE WHEN l_linenumber % 5 = 0 THEN 'Unknown' ELSE concat('G', cast(l_partkey % 50 as string)) END,"
        f" '|', {_CLS}, '|T', cast(l_partkey as string), '|p.A', cast(l_linenumber as string), 'V]#[',"
        " concat('G', cast(l_suppkey % 50 as string)), '|MISSENSE|T', cast(l_suppkey as string), '|',"
        " CASE WHEN l_orderkey % 4 = 0 THEN '' ELSE concat('p.K', cast(l_suppkey % 90 as string), 'E') END, ']',"
        " CASE WHEN l_orderkey % 3 = 0 THEN concat(',[G', cast(l_orderkey % 50 as string), '|NONSENSE|T', cast(l_orderkey as string), '|p.L2P]') ELSE '' END)",
    },
)
FILTER_ROWS = StandIn(
    "filter_rows",
    "orders",
    {
        "o_orderkey": "o_orderkey",
        "variantClassification": pick("o_orderkey % 7", ["MISSENSE", "SILENT", None, "IGR", "NONSENSE", "RNA", "MISSENSE"]),
        "variantType": pick("o_custkey % 5", ["SNP", "ONP", None, "DEL", "INS"]),
        "proteinChange": "CASE o_custkey % 6 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE concat('p.', o_orderpriority) END",
    },
)
GT_ROWS = StandIn(
    "gt_rows",
    "lineitem",
    {
        "POS": "l_orderkey * 8 + l_linenumber",
        "sample": "concat(" + pick("(l_orderkey + l_partkey) % 7", ["0/1", "1/1", "1/2", "0/0", "0|1", "./.", "1/1"])
        + ", ':', cast(l_linenumber as string), ':', cast(l_suppkey as string))",
    },
)
PARTS_GENES = StandIn(
    "parts_genes", "part", {"p_partkey": "p_partkey", "hugoSymbol": "concat('GENE', cast(p_size as string))"}
)
NATION_SET = StandIn("nation_set", "nation", {"symbol": "concat('GENE', cast(n_nationkey as string))"})
REGION_SET = StandIn("region_set", "region", {"symbol": "concat('GENE', cast(r_regionkey * 10 as string))"})
CLASS_TABLE = StandIn(
    "class_table",
    "nation",
    {
        "gvhd_genes": "concat('GENE', cast(n_nationkey as string))",
        "gvhd_classfication": pick(
            "(n_nationkey + n_regionkey) % 6",
            ["lung", "skin", "pan expressed gene", "lung,liver,skin,colon,lacrimal,oral", "colon,oral", "liver,skin,lung"],
        ),
    },
)
TPM = StandIn(
    "tpm", "part", {"Description": "concat('GENE', cast(p_size % 30 as string))", "TPM": "p_retailprice / 40.0"}
)
RNA_LOW = StandIn("rna_low", "lineitem", {"Description": "concat('GENE', cast(l_linenumber * 3 as string))"})
PROT_LOW = StandIn("prot_low", "supplier", {"hgnc_symbol": "concat('GENE', cast(s_suppkey % 30 as string))"})
EVENT_IVS = StandIn(
    "event_ivs",
    "events",
    columns={
        "event_id": "event_id",
        "chrom": "cast(user_id as string)",
        "event_type": "event_type",
        "start": "{SECS}",
        "end": "{SECS} + CAST(floor(value * 60) AS BIGINT)",
    },
)
ID_ROWS = StandIn(
    "id_rows",
    "part",
    {
        "p_partkey": "p_partkey",
        "transid": "concat(p_brand, ':T', cast(p_partkey as string), ':', cast(p_size as string), '_',"
        " cast(p_size + 8 as string), CASE WHEN p_partkey % 3 = 0 THEN concat(';X:T0:1_9') ELSE '' END)",
        "gene": "CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE p_brand END",
        "transcript": "concat('T', cast(p_partkey as string))",
        "change": "concat('p.', p_type)",
        "n": "p_size",
        "i": "p_partkey % 13",
    },
)

# Epoch seconds of the NTZ event time, identical in both engines.
SPARK_SECS = "timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)"
DUCK_SECS = "CAST(floor(epoch(ts)) AS BIGINT)"


def _events_ivs(spark, sf):
    cols = {k: v.replace("{SECS}", SPARK_SECS) for k, v in EVENT_IVS.columns.items()}
    return spark.read.parquet(f"{sf}/events.parquet").selectExpr(*[f"{e} AS `{c}`" for c, e in cols.items()])


def _events_ivs_cte() -> str:
    sel = ", ".join(f'{e.replace("{SECS}", DUCK_SECS)} AS "{c}"' for c, e in EVENT_IVS.columns.items())
    return f"event_ivs AS (SELECT {sel} FROM events)"


# ---------------------------------------------------------------- queries
def _ann_sql() -> str:
    names = ", ".join(f"string_split(a, '|')[{i + 1}] AS {n}" for i, n in enumerate(ANN_FIELDS))
    return with_ctes(ANN_VCF) + f""",
x AS (SELECT CHROM, POS, unnest(flatten(list_transform(string_split(replace(INFO, 'FUNCOTATION=', ''), '#'),
        lambda t: string_split(t, ',')))) AS a0 FROM ann_vcf),
y AS (SELECT CHROM, POS, regexp_replace(a0, '\\[|\\]', '', 'g') AS a FROM x)
SELECT CHROM, POS, {names} FROM y WHERE NOT coalesce(starts_with(a, 'Unknown'), false)"""


@register("annotation_explode", _ann_sql())
def q_annotation_explode(spark, sf):
    """C1 + C2 + C3 + P4 + F2: one row per transcript and allele of the
    annotation string, Unknown annotations dropped, fields named by a list."""
    df = A.explode_annotations(ANN_VCF.df(spark, sf))
    df = A.annotation_fields(df, ANN_FIELDS)
    return df.select("CHROM", "POS", *ANN_FIELDS)


@register(
    "keep_null_filters",
    with_ctes(FILTER_ROWS) + """
SELECT * FROM filter_rows
WHERE coalesce(proteinChange <> '', true)
  AND coalesce(variantClassification NOT IN ('IGR','INTRON','FIVE_PRIME_FLANK','THREE_PRIME_UTR','FIVE_PRIME_UTR',
      'SPLICE_SITE','COULD_NOT_DETERMINE','RNA','LINCRNA','NONSTOP','SILENT'), true)
  AND coalesce(variantType NOT IN ('ONP'), true)""",
)
def q_keep_null_filters(spark, sf):
    """F3 + F4 with pandas NULL semantics: negated predicates keep NULL rows."""
    return A.annotation_filters(FILTER_ROWS.df(spark, sf))


@register(
    "genotype_fields",
    with_ctes(GT_ROWS) + """,
g AS (SELECT POS, split_part(sample, ':', 1) AS GT FROM gt_rows)
SELECT POS, GT, CASE WHEN GT IN ('0/1', '1/2') THEN 'het' WHEN GT = '1/1' THEN 'hom' END AS loci,
       coalesce(GT = '1/2', false) AS hetsite
FROM g WHERE GT IN ('0/1', '1/1', '1/2')""",
)
def q_genotype_fields(spark, sf):
    """P5 + F5 + P6 + P11: genotype field, exact kept genotypes (phased and
    missing dropped), het/hom, multi-allelic site flag."""
    df = A.genotypes(GT_ROWS.df(spark, sf), "sample", gt_out="GT")
    return df.select("POS", "GT", F.col("sample_loci").alias("loci"), G.multiallelic_site("GT").alias("hetsite"))


@register(
    "reference_join",
    with_ctes(CHANGES, TRANSCRIPTS) + """
SELECT c.POS, c.annotationTranscript, t.gene, t.ensembl_gene, CAST(length(t.mrna) AS BIGINT) AS mrna_len
FROM changes c JOIN (SELECT * FROM transcripts WHERE mrna IS NOT NULL) t ON c.annotationTranscript = t.ensembl_transcript
WHERE NOT coalesce(contains(c.proteinChange, '*'), false) AND coalesce(c.variantClassification <> 'IN_FRAME_DEL', true)
  AND c.proteinChange IS NOT NULL""",
)
def q_reference_join(spark, sf):
    """J1 + F6 + F7 + F8: changes joined to the transcript reference on
    differently named keys (reference rows without mRNA removed first)."""
    ref = TRANSCRIPTS.df(spark, sf).filter(F.col("mrna").isNotNull())
    ch = CHANGES.df(spark, sf).select("POS", "annotationTranscript", "proteinChange", "variantClassification")
    ch = ch.withColumn("cDnaChange", F.lit("c.")).transform(A.reference_filters)
    j = ch.join(ref, ch["annotationTranscript"] == ref["ensembl_transcript"], "inner")
    return j.select("POS", "annotationTranscript", "gene", "ensembl_gene", F.length("mrna").cast("bigint").alias("mrna_len"))


N_SAMPLES = 29  # samples S0..S28 of the change table; each is paired with the next


@register(
    "reference_unmatched",
    with_ctes(CHANGES, TRANSCRIPTS) + f""",
hs AS (SELECT DISTINCT sample, annotationTranscript AS t FROM changes),
ds AS (SELECT 'S' || ((CAST(substr(sample, 2) AS INT) + {N_SAMPLES - 1}) % {N_SAMPLES}) AS sample, t FROM hs),
ref AS (SELECT 'S' || unnest(range({N_SAMPLES})) AS sample, ensembl_transcript AS t FROM transcripts WHERE mrna IS NOT NULL)
SELECT sample, t AS transcript, 'no_variant' AS kind FROM (SELECT sample, t FROM ref EXCEPT SELECT sample, t FROM hs)
UNION ALL
SELECT sample, t AS transcript, 'host_only' AS kind FROM (SELECT sample, t FROM hs EXCEPT SELECT sample, t FROM ds)""",
)
def q_reference_unmatched(spark, sf):
    """J2 + J4 for every sample as host and the next one as donor: reference
    transcripts without a change in the host (anti join), and transcripts
    changed in the host but not in the donor (set difference)."""
    host = CHANGES.df(spark, sf).select("sample", F.col("annotationTranscript").alias("t")).distinct()
    number = F.substring("sample", 2, 9).cast("int")
    donor = host.withColumn("sample", F.concat(F.lit("S"), ((number + N_SAMPLES - 1) % N_SAMPLES).cast("string")))
    ref = TRANSCRIPTS.df(spark, sf).filter(F.col("mrna").isNotNull()).select(
        F.explode(F.array(*[F.lit(f"S{i}") for i in range(N_SAMPLES)])).alias("sample"), F.col("ensembl_transcript").alias("t"))
    kinds = {"no_variant": ref.join(host, ["sample", "t"], "left_anti"), "host_only": host.join(donor, ["sample", "t"], "left_anti")}
    parts = [df.select("sample", F.col("t").alias("transcript"), F.lit(k).alias("kind")) for k, df in kinds.items()]
    return parts[0].unionByName(parts[1])


@register("pair_full_outer", PAIRED_SQL + "\nSELECT * FROM paired")
def q_pair_full_outer(spark, sf):
    """J3 + P2 + P7: null-safe natural full outer join of two samples on the
    shared site columns, prefixed genotypes, missing genotype filled 0/0."""
    host = sample_genotypes(spark, sf, HOST_CALLS, "host")
    donor = sample_genotypes(spark, sf, DONOR_CALLS, "donor")
    return pair_samples(host, donor, SITE_KEYS)


@register(
    "attach_left",
    """SELECT c.c_custkey, c.c_name, o.o_orderkey, coalesce(o.o_orderstatus, 'none') AS o_orderstatus, o.o_totalprice
FROM customer c LEFT JOIN (SELECT o_custkey AS c_custkey, o_orderkey, o_orderstatus, o_totalprice FROM orders) o
ON c.c_custkey IS NOT DISTINCT FROM o.c_custkey""",
)
def q_attach_left(spark, sf):
    """J5 + J10 + J14 + P7: null-safe natural left join attaching rows by the
    shared key, with a fill for rows that found nothing."""
    c = spark.read.parquet(f"{sf}/customer.parquet").select("c_custkey", "c_name")
    o = spark.read.parquet(f"{sf}/orders.parquet").select(
        F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_orderstatus", "o_totalprice")
    j = natural_join(c, o, "left")
    return j.withColumn("o_orderstatus", F.coalesce("o_orderstatus", F.lit("none"))).select(
        "c_custkey", "c_name", "o_orderkey", "o_orderstatus", "o_totalprice")


_PICK_SQL = PAIRED_SQL + """,
folded AS (SELECT * REPLACE (
             CASE WHEN host_GT = '1/2' THEN '1/1' ELSE host_GT END AS host_GT,
             CASE WHEN donor_GT = '1/2' THEN '1/1' ELSE donor_GT END AS donor_GT)
           FROM paired WHERE coalesce(variantClassification <> 'SILENT', true)),
al AS (SELECT *, regexp_split_to_array(host_GT, '[/|]')[1] AS h1, regexp_split_to_array(host_GT, '[/|]')[2] AS h2,
              regexp_split_to_array(donor_GT, '[/|]')[1] AS d1, regexp_split_to_array(donor_GT, '[/|]')[2] AS d2,
              CASE POS % 4 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 3 END AS host_whichdf
       FROM folded
       WHERE coalesce(regexp_split_to_array(host_GT, '[/|]')[1] <> regexp_split_to_array(donor_GT, '[/|]')[1]
                  AND regexp_split_to_array(host_GT, '[/|]')[1] <> regexp_split_to_array(donor_GT, '[/|]')[2], false)
          OR coalesce(regexp_split_to_array(host_GT, '[/|]')[2] <> regexp_split_to_array(donor_GT, '[/|]')[1]
                  AND regexp_split_to_array(host_GT, '[/|]')[2] <> regexp_split_to_array(donor_GT, '[/|]')[2], false)),
pk AS (SELECT *, CASE WHEN h1 <> d1 AND h1 <> d2 THEN h1 WHEN h2 <> d1 AND h2 <> d2 THEN h2 END AS ALLELE,
              coalesce(host_whichdf, 0) AS code FROM al),
cat AS (SELECT *, CASE WHEN code <> 2 AND ALLELE = '1' THEN 'c1' WHEN code = 2 AND ALLELE = '1' THEN 'c2'
                       WHEN code <> 2 AND ALLELE = '0' THEN 'c3' WHEN code = 2 AND ALLELE = '0' THEN 'c4' END AS host_condition
        FROM pk)
SELECT CHROM, POS, REF, ALT, ALLELE, host_condition,
  CASE WHEN host_condition IN ('c1', 'c4') THEN concat('H1-', cast(POS as string))
       WHEN host_condition IN ('c2', 'c3') THEN concat('H2-', cast(POS as string)) END AS host_sequence,
  CASE WHEN host_condition IN ('c1', 'c4') THEN concat('D1-', cast(POS as string))
       WHEN host_condition IN ('c2', 'c3') THEN concat('D2-', cast(POS as string)) END AS donor_sequence
FROM cat"""


@register("category_pick", _PICK_SQL)
def q_category_pick(spark, sf):
    """C10 + C11 + P13: foreign allele, category c1..c4 from the strand code,
    and the window column of each sample that category points at."""
    host = sample_genotypes(spark, sf, HOST_CALLS, "host")
    donor = sample_genotypes(spark, sf, DONOR_CALLS, "donor")
    d = discordant(pair_samples(host, donor, SITE_KEYS))
    pos = F.col("POS").cast("string")
    d = d.withColumns({
        "host_whichdf": F.when(F.col("POS") % 4 == 0, 1).when(F.col("POS") % 4 == 1, 2).when(F.col("POS") % 4 == 2, 3),
        "host_seqpad1": F.concat(F.lit("H1-"), pos), "host_seqpad2": F.concat(F.lit("H2-"), pos),
        "donor_seqpad1": F.concat(F.lit("D1-"), pos), "donor_seqpad2": F.concat(F.lit("D2-"), pos),
    })
    out = pick_foreign(d)
    return out.select("CHROM", "POS", "REF", "ALT", "ALLELE", "host_condition", "host_sequence", "donor_sequence")


@register(
    "membership_flags",
    with_ctes(PARTS_GENES, NATION_SET, REGION_SET) + """
SELECT p_partkey, hugoSymbol,
  CASE WHEN hugoSymbol IN (SELECT symbol FROM nation_set) THEN 'yes' ELSE 'no' END AS tissue,
  CASE WHEN hugoSymbol IN (SELECT symbol FROM region_set) THEN 'yes' ELSE 'no' END AS BLOOD
FROM parts_genes""",
)
def q_membership_flags(spark, sf):
    """P10 + S4: yes/no flags for membership in two gene-set tables."""
    sets = {"tissue": NATION_SET.df(spark, sf), "BLOOD": REGION_SET.df(spark, sf)}
    return flag_gene_sets(PARTS_GENES.df(spark, sf), sets).select("p_partkey", "hugoSymbol", "tissue", "BLOOD")


def _classes_sql() -> str:
    return with_ctes(PARTS_GENES, CLASS_TABLE) + """,
j AS (SELECT p.*, c.gvhd_classfication FROM parts_genes p JOIN class_table c ON p.hugoSymbol = c.gvhd_genes),
gc AS (SELECT DISTINCT hugoSymbol, gvhd_classfication FROM j)"""


@register(
    "tissue_classes",
    _classes_sql() + "\nSELECT p_partkey, hugoSymbol, gvhd_classfication FROM j",
)
def q_tissue_classes(spark, sf):
    """J8 + J9: rows of genes with a tissue class, the class attached."""
    j = tissue_classes(PARTS_GENES.df(spark, sf), CLASS_TABLE.df(spark, sf))
    return j.select("p_partkey", "hugoSymbol", "gvhd_classfication")


@register(
    "class_histogram",
    _classes_sql() + """
SELECT 'class' AS kind, gvhd_classfication AS bucket, count(*) AS n FROM gc GROUP BY gvhd_classfication
UNION ALL
SELECT 'n_classes' AS kind, cast(len(string_split(gvhd_classfication, ',')) as string) AS bucket, count(*) AS n
FROM gc GROUP BY len(string_split(gvhd_classfication, ','))""",
)
def q_class_histogram(spark, sf):
    """A1 + A3 + A5: value counts of the classes of distinct (gene, class)
    pairs, and the histogram of the number of classes per gene."""
    gc = gene_classes(tissue_classes(PARTS_GENES.df(spark, sf), CLASS_TABLE.df(spark, sf)))
    vc = class_value_counts(gc).select(F.lit("class").alias("kind"), F.col("gvhd_classfication").alias("bucket"), "n")
    h = class_size_histogram(gc).select(F.lit("n_classes").alias("kind"), F.col("n_classes").cast("string").alias("bucket"), "n")
    return vc.unionByName(h)


def _fixed_sql() -> str:
    one = lambda label, v: f"count_if(coalesce(gvhd_classfication = '{v}', false)) AS \"Genes expressed in {label}\""
    parts = [
        "count_if(coalesce(gvhd_classfication = 'pan expressed gene', false)) AS \"Pan expressed genes\"",
        one("non-hemato tissues", "lung,liver,skin,colon,lacrimal,oral"),
        *[one(t, t) for t in ("lung", "liver", "skin", "colon", "lacrimal", "oral", "hematopoietic")],
        *[f"count_if(coalesce(len(string_split(gvhd_classfication, ',')) = {n}, false)) AS \"Genes expressed by {n} gvhd tissues\"" for n in (2, 3, 4, 5)],
    ]
    return _classes_sql() + "\nSELECT " + ", ".join(parts) + " FROM gc"


@register("class_counts_fixed", _fixed_sql())
def q_class_counts_fixed(spark, sf):
    """Fixed-key class counts (0 when absent) and class-count bins, one row."""
    gc = gene_classes(tissue_classes(PARTS_GENES.df(spark, sf), CLASS_TABLE.df(spark, sf)))
    return fixed_class_counts(gc)


@register(
    "gene_set_algebra",
    with_ctes(TPM, RNA_LOW, PROT_LOW) + """
SELECT DISTINCT gene FROM (
  ((SELECT Description AS gene FROM tpm WHERE TPM > 2.0) INTERSECT (SELECT hgnc_symbol FROM prot_low)
     INTERSECT (SELECT Description FROM rna_low))
  UNION
  ((SELECT Description AS gene FROM tpm WHERE TPM > 32.0) INTERSECT (SELECT Description FROM rna_low)))""",
)
def q_gene_set_algebra(spark, sf):
    """F13 + U1 + U2 + U6: (expressed > 2 ∩ low protein ∩ low RNA) ∪ (expressed > 32 ∩ low RNA)."""
    return expressed_genes(TPM.df(spark, sf), RNA_LOW.df(spark, sf), PROT_LOW.df(spark, sf))


@register(
    "append_missing_columns",
    """SELECT DISTINCT * FROM (
  SELECT c_custkey AS key, c_name AS name, c_nationkey AS nationkey, c_mktsegment AS segment FROM customer
  UNION ALL BY NAME
  SELECT s_suppkey AS key, s_name AS name, s_nationkey AS nationkey FROM supplier)""",
)
def q_append_missing_columns(spark, sf):
    """U4 + U5: append tables whose columns differ (missing ones NULL), then distinct."""
    c = spark.read.parquet(f"{sf}/customer.parquet").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nationkey"),
        F.col("c_mktsegment").alias("segment"))
    s = spark.read.parquet(f"{sf}/supplier.parquet").select(
        F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nationkey"))
    return c.unionByName(s, allowMissingColumns=True).distinct()


_DC_SQL = """SELECT count(*) AS rows, count(DISTINCT l_orderkey) AS n_l_orderkey, count(DISTINCT l_partkey) AS n_l_partkey,
       count(DISTINCT (l_partkey, l_suppkey)) AS n_l_partkey_l_suppkey,
       max(l_quantity) AS max_qty, min(l_quantity) AS min_qty FROM lineitem"""


def _lineitem_counts(spark, sf):
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    dc = distinct_counts(li, ["l_orderkey", "l_partkey"], [("l_partkey", "l_suppkey")])
    mm = li.agg(F.max("l_quantity").alias("max_qty"), F.min("l_quantity").alias("min_qty"))
    return summary_wide({"a": dc, "b": mm}).select(
        *[F.col(f"a_{c}").alias(c) for c in dc.columns], F.col("b_max_qty").alias("max_qty"), F.col("b_min_qty").alias("min_qty"))


@register("distinct_counts", _DC_SQL)
def q_distinct_counts(spark, sf):
    """A1 + A2 + A8: exact distinct counts of columns and column pairs, max and min."""
    return _lineitem_counts(spark, sf)


@register(
    "distinct_sketches",
    f"""SELECT metric, n, true AS within FROM (
  SELECT 'n_l_orderkey' AS metric, n_l_orderkey AS n FROM ({_DC_SQL})
  UNION ALL SELECT 'n_l_partkey', n_l_partkey FROM ({_DC_SQL})
  UNION ALL SELECT 'n_l_partkey_l_suppkey', n_l_partkey_l_suppkey FROM ({_DC_SQL}))""",
)
def q_distinct_sketches(spark, sf):
    """A2 over runs: the sketches of two runs, merged, against the exact counts of both
    together; ``within`` three standard errors."""
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    cols, pairs = ["l_orderkey", "l_partkey"], [("l_partkey", "l_suppkey")]
    runs = [distinct_sketches(li.filter(F.col("l_linenumber") % 2 == i), cols, pairs) for i in (0, 1)]
    exact = summary_long({"all": distinct_counts(li, cols, pairs)}).select("metric", F.col("value").alias("n"))
    near = F.abs(F.col("value") - F.col("n")) <= 3 * 1.04 / 2**6 * F.col("n")
    return merge_sketches(runs[0].unionByName(runs[1])).join(exact, "metric").select("metric", "n", near.alias("within"))


_ORD_COUNTS_SQL = """SELECT count(*) AS rows, count(DISTINCT o_custkey) AS n_o_custkey FROM orders"""


def _order_counts(spark, sf):
    return distinct_counts(spark.read.parquet(f"{sf}/orders.parquet"), ["o_custkey"])


@register(
    "summary_wide",
    f"""SELECT a.rows AS lineitem_rows, a.n_l_orderkey AS lineitem_n_l_orderkey, b.rows AS orders_rows,
       b.n_o_custkey AS orders_n_o_custkey
FROM ({_DC_SQL}) a, ({_ORD_COUNTS_SQL}) b""",
)
def q_summary_wide(spark, sf):
    """K6 (side by side): one-row stage summaries pasted into one row."""
    li = distinct_counts(spark.read.parquet(f"{sf}/lineitem.parquet"), ["l_orderkey"])
    return summary_wide({"lineitem": li, "orders": _order_counts(spark, sf)})


@register(
    "summary_long",
    f"""SELECT 'lineitem' AS stage, 'rows' AS metric, rows AS value FROM ({_DC_SQL})
UNION ALL SELECT 'lineitem', 'n_l_orderkey', n_l_orderkey FROM ({_DC_SQL})
UNION ALL SELECT 'orders', 'rows', rows FROM ({_ORD_COUNTS_SQL})
UNION ALL SELECT 'orders', 'n_o_custkey', n_o_custkey FROM ({_ORD_COUNTS_SQL})""",
)
def q_summary_long(spark, sf):
    """K5 + K6 (stacked): one-row summaries as (stage, metric, value) rows."""
    li = distinct_counts(spark.read.parquet(f"{sf}/lineitem.parquet"), ["l_orderkey"])
    return summary_long({"lineitem": li, "orders": _order_counts(spark, sf)})


_IV_SQL = "WITH " + _events_ivs_cte() + """,
s AS (SELECT chrom, "start", "end", max("end") OVER (PARTITION BY chrom ORDER BY "start", "end"
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pm FROM event_ivs{WHERE}),
t AS (SELECT *, sum(CASE WHEN pm IS NULL OR "start" > pm THEN 1 ELSE 0 END) OVER (PARTITION BY chrom ORDER BY "start", "end"
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island FROM s),
merged AS (SELECT chrom, min("start") AS "start", max("end") AS "end" FROM t GROUP BY chrom, island)"""


@register("interval_merge", _IV_SQL.replace("{WHERE}", "") + "\nSELECT * FROM merged")
def q_interval_merge(spark, sf):
    """W6 + O3: merge overlapping/touching per-user activity intervals
    [ts, ts + value minutes) into islands."""
    return merge_intervals(_events_ivs(spark, sf), "chrom", "start", "end")


@register(
    "interval_semi",
    _IV_SQL.replace("{WHERE}", " WHERE event_type = 'view'") + """
SELECT e.event_id FROM event_ivs e
WHERE e.event_type = 'click' AND EXISTS (SELECT 1 FROM merged m WHERE m.chrom = e.chrom AND e."start" >= m."start" AND e."start" < m."end")""",
)
def q_interval_semi(spark, sf):
    """J15 (+ W6): click events that fall inside a merged view interval of the
    same user — binned range semi join."""
    ev = _events_ivs(spark, sf)
    regions = merge_intervals(ev.filter(F.col("event_type") == "view"), "chrom", "start", "end")
    clicks = ev.filter(F.col("event_type") == "click").select("event_id", "chrom", F.col("start").alias("pos"))
    return points_in_regions(clicks, regions, "chrom", "pos").select("event_id")


@register(
    "mark_duplicates",
    """SELECT event_id, user_id, event_type, score,
  row_number() OVER (PARTITION BY user_id, event_type ORDER BY score DESC NULLS LAST, event_id) > 1 AS duplicate
FROM (SELECT event_id, CASE WHEN user_id <> 8 THEN user_id END AS user_id, nullif(event_type, 'error') AS event_type,
             CASE WHEN value >= 2 THEN CAST(floor(value) AS INT) END AS score FROM events)""",
)
def q_mark_duplicates(spark, sf):
    """Per (user, event type), NULL keys together, keep the highest integer score; the rest are marked."""
    ev = spark.read.parquet(f"{sf}/events.parquet").selectExpr(
        "event_id", "CASE WHEN user_id <> 8 THEN user_id END AS user_id", "nullif(event_type, 'error') AS event_type",
        "CASE WHEN value >= 2 THEN CAST(floor(value) AS INT) END AS score")
    return mark_duplicates(ev, ["user_id", "event_type"], "score", ["event_id"])


_ORDER_KEYS = ["l_partkey", "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice"]


@register(
    "ordered_records",
    "SELECT *, row_number() OVER (ORDER BY " + ", ".join(_ORDER_KEYS) + ") AS position FROM lineitem",
)
def q_ordered_records(spark, sf):
    """O2 + O4: lineitems with all their columns in a total order, the global position as a column
    (range partitioning + per-partition ranks, no single-task sort)."""
    return ordered_records(spark.read.parquet(f"{sf}/lineitem.parquet"), _ORDER_KEYS)


@register(
    "id_parse",
    with_ctes(ID_ROWS) + """
SELECT p_partkey, split_part(split_part(transid, ';', 1), ':', 1) AS gene,
  split_part(split_part(split_part(transid, ';', 1), ':', 3), '_', 1) AS pep_start,
  split_part(split_part(split_part(transid, ';', 1), ':', 3), '_', 2) AS pep_end,
  split_part(transid, ';', 1) AS first_id
FROM id_rows""",
)
def q_id_parse(spark, sf):
    """First id of a ';' list, gene before ':', start/end from 'a_b'."""
    df = ID_ROWS.df(spark, sf)
    first = nth_token("transid", ";", 0)
    pos = nth_token(first, ":", 2)
    return df.select(
        "p_partkey", nth_token(first, ":", 0).alias("gene"), nth_token(pos, "_", 0).alias("pep_start"),
        nth_token(pos, "_", 1).alias("pep_end"), first.alias("first_id"),
    )


@register(
    "compound_id",
    with_ctes(ID_ROWS) + """
SELECT p_partkey, gene || ':' || transcript AS short_id,
  gene || '|' || transcript || '|' || change || '|' || ('len_' || cast(n as string)) || '|' || ('num_' || cast(i as string)) AS peptide_fasta_id
FROM id_rows""",
)
def q_compound_id(spark, sf):
    """Compound ids built with NULL propagation (a NULL part gives a NULL id)."""
    df = ID_ROWS.df(spark, sf)
    return df.select(
        "p_partkey",
        compound_id("gene", "transcript", sep=":").alias("short_id"),
        compound_id("gene", "transcript", "change", F.concat(F.lit("len_"), F.col("n").cast("string")),
                    F.concat(F.lit("num_"), F.col("i").cast("string"))).alias("peptide_fasta_id"),
    )
