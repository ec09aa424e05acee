"""Queries for the per-transcript sequence operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import genotype as G
from ..functions import hgvs
from ..functions.codons import translate
from ..functions.strings import cds_slice
from ..operators.context import context_window
from ..operators.sequences import assign_strands, mutated_proteins, scan_strands, strand_members
from ..session import cut_lineage
from .registry import register
from .standins import CHANGES, TRANSCRIPTS, amino, with_ctes

ORDER = ("mutstart", "POS", "variantType", "mutalt", "protalt", "GT")
GROUP = ("sample", "annotationTranscript")
SEQUENCES = ("mrna", "refProtein", "protmut1", "protmut2")


def changes_with_zygosity(spark, sf):
    return CHANGES.df(spark, sf).withColumn("loci", G.zygosity("GT"))


def sequences(spark, sf):
    """The sequences of every transcript, one row each."""
    rows = CHANGES.df(spark, sf).select("annotationTranscript", *SEQUENCES)
    return rows.groupBy("annotationTranscript").agg(*[F.first(c, ignorenulls=True).alias(c) for c in SEQUENCES])


def reference_sequences(spark, sf):
    """mRNA and protein of every transcript, written once for all that read them."""
    return cut_lineage(sequences(spark, sf).select("annotationTranscript", "mrna", "refProtein"), "sequences")


def strands(spark, sf):
    """Strand assignment on the change columns alone; sequences are attached afterwards."""
    return assign_strands(changes_with_zygosity(spark, sf).drop(*SEQUENCES), GROUP, ORDER, segmented=True)


def shifted_strands(spark, sf):
    """Strands and index shifts in one scan of the change columns."""
    return scan_strands(changes_with_zygosity(spark, sf).drop(*SEQUENCES), GROUP, ORDER)


# ---------------------------------------------------------------- SQL pieces
_W = "PARTITION BY sample, annotationTranscript ORDER BY mutstart, POS, variantType, mutalt, protalt, GT"
STRANDS_SQL = with_ctes(CHANGES) + f""",
cz AS (SELECT *, CASE WHEN GT IN ('0/1', '1/2') THEN 'het' WHEN GT = '1/1' THEN 'hom' END AS loci FROM changes),
s0 AS (SELECT *, lag(protstart, 1, -1) OVER w AS pp, lag(mutstart, 1, -1) OVER w AS pm,
              lag(variantType, 1, '') OVER w AS pt, lag(variantClassification, 1, '') OVER w AS pc
       FROM cz WINDOW w AS ({_W})),
s1 AS (SELECT *, coalesce(protstart = pp, false) AS sp, coalesce(mutstart = pm, false) AS sc,
              coalesce(variantType = 'SNP' AND pt = 'SNP', false) AS bs,
              coalesce(contains(proteinChange, 'fs'), false) AS fs,
              coalesce(variantClassification = 'NONSENSE', false) AS ns,
              coalesce(pc IN ('FRAME_SHIFT_INS', 'FRAME_SHIFT_DEL'), false) AS pfs
       FROM s0),
s2 AS (SELECT *,
         CASE WHEN loci = 'hom' AND sp AND sc THEN 2 WHEN loci = 'hom' THEN 3
              WHEN loci = 'het' AND sp AND NOT sc AND bs THEN 1
              WHEN loci = 'het' AND sp AND sc AND bs THEN 2
              WHEN loci = 'het' AND fs AND sp AND pfs THEN 1
              WHEN loci = 'het' AND fs AND sp THEN 2
              WHEN loci = 'het' AND (fs OR ns) THEN 2
              WHEN loci = 'het' AND sp THEN 2
              WHEN loci = 'het' THEN 1 END AS whichdf,
         CASE WHEN loci = 'het' AND sp AND NOT sc AND bs THEN 1
              WHEN loci = 'hom' AND sp AND sc THEN 0 WHEN loci = 'hom' THEN 1
              WHEN loci = 'het' AND sp THEN 0 WHEN loci = 'het' THEN 1 ELSE 0 END AS inc,
         (loci = 'hom' AND sp AND sc) AS evicting
       FROM s1),
s3 AS (SELECT *, CAST(sum(inc) OVER ({_W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - 1 AS INT) AS mut_index,
              coalesce(whichdf IN (2, 3), false) AS on2
       FROM s2),
strands AS (SELECT *, coalesce(on2 AND lead(evicting, 1, false) OVER (PARTITION BY sample, annotationTranscript, on2 ORDER BY mutstart, POS, variantType, mutalt, protalt, GT), false) AS evicted
            FROM s3)"""

_STEP = ("CASE WHEN variantType = 'INS' THEN length(coalesce(protalt, '')) "
         "WHEN variantType = 'DEL' THEN -length(coalesce(protref, '')) ELSE 0 END")
_ON1 = "coalesce(whichdf IN (1, 3), false)"
_ON2 = "(coalesce(whichdf IN (2, 3), false) AND NOT coalesce(evicted, false))"

SHIFT_SQL = STRANDS_SQL + f""",
shifted AS (SELECT *,
  CAST(sum(CASE WHEN {_ON1} THEN {_STEP} ELSE 0 END) OVER ({_W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS INT) AS base_index_1,
  CAST(coalesce(sum(CASE WHEN {_ON1} THEN {_STEP} ELSE 0 END) OVER ({_W} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS INT) AS base_before_1,
  CAST(sum(CASE WHEN {_ON2} THEN {_STEP} ELSE 0 END) OVER ({_W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS INT) AS base_index_2,
  CAST(coalesce(sum(CASE WHEN {_ON2} THEN {_STEP} ELSE 0 END) OVER ({_W} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS INT) AS base_before_2
  FROM strands)"""

# The standard genetic code in T, C, A, G order of the three letters.
_CODE = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"


def _codon_sql(c: str) -> str:
    at = [f"instr('TCAG', substring({c}, {i}, 1))" for i in (1, 2, 3)]
    return f"CASE WHEN {at[0]} * {at[1]} * {at[2]} > 0 THEN substring('{_CODE}', 16 * {at[0]} + 4 * {at[1]} + {at[2]} - 20, 1) ELSE 'X' END"


def translate_sql(s: str) -> tuple[str, str]:
    """DuckDB (protein, mrna) expressions translating the string expression ``s``."""
    st = f"(CASE WHEN instr({s}, 'ATG') > 0 THEN instr({s}, 'ATG') ELSE instr({s}, 'GTG') END)"
    n = f"CAST(floor((length({s}) - ({st} + 2) + 2) / 3.0) AS INT)"
    codons = f"(CASE WHEN {n} > 0 THEN list_transform(range(0, {n}), lambda j: substring({s}, {st} + 3 + 3 * j, 3)) ELSE []::VARCHAR[] END)"
    aas = f"list_transform({codons}, lambda c: CASE WHEN length(c) < 3 THEN '*' ELSE {_codon_sql('c')} END)"
    stop = f"coalesce(list_position({aas}, '*'), 0)"
    prot = f"CASE WHEN {st} > 0 THEN 'M' || array_to_string(CASE WHEN {stop} > 0 THEN list_slice({aas}, 1, {stop}) ELSE {aas} END, '') ELSE '' END"
    full_stop = f"({stop} > 0 AND length({codons}[{stop}]) = 3)"
    mlen = f"(CASE WHEN {full_stop} THEN ({stop} + 1) * 3 ELSE length({s}) - {st} + 1 END)"
    mrna = f"CASE WHEN {st} > 0 THEN substring({s}, {st}, {mlen}) ELSE '' END"
    return prot, mrna


def slice0_sql(s: str, a: str, b: str) -> str:
    a0 = f"greatest({a}, 0)"
    return f"substring({s}, {a0} + 1, greatest(({b}) - {a0}, 0))"


def tail0_sql(s: str, a: str) -> str:
    a0 = f"greatest({a}, 0)"
    return f"substring({s}, {a0} + 1, greatest(length({s}) - {a0}, 0))"


# ------------------------------------------------------------------ queries
@register(
    "strand_assign",
    STRANDS_SQL + """
SELECT sample, annotationTranscript, POS, CAST(whichdf AS BIGINT) AS whichdf, CAST(mut_index AS BIGINT) AS mut_index, evicted
FROM strands""",
)
def q_strand_assign(spark, sf):
    """W1 + W2: strand code, mutation counter and eviction of every change,
    decided from the previous change of the same transcript — in the
    hot-transcript-safe form: crowded transcripts are cut into position
    slices, carries across slices through per-slice tables."""
    s = strands(spark, sf)
    return s.select(
        *GROUP, "POS", F.col("whichdf").cast("bigint").alias("whichdf"),
        F.col("mut_index").cast("bigint").alias("mut_index"), "evicted",
    )


@register(
    "index_shift",
    SHIFT_SQL + """
SELECT sample, annotationTranscript, POS, CAST(base_index_1 AS BIGINT) AS base_index_1, CAST(base_before_1 AS BIGINT) AS base_before_1,
       CAST(base_index_2 AS BIGINT) AS base_index_2, CAST(base_before_2 AS BIGINT) AS base_before_2
FROM shifted""",
)
def q_index_shift(spark, sf):
    """W3 + W4: running protein-index shift per strand, with and without the
    row itself — segmented over position slices (hot-transcript-safe)."""
    s = shifted_strands(spark, sf)
    return s.select(*GROUP, "POS", *[F.col(c).cast("bigint").alias(c) for c in
                                    ("base_index_1", "base_before_1", "base_index_2", "base_before_2")])


_P1, _M1 = translate_sql("spliced")
_SPLICE_SQL = SHIFT_SQL + f""",
members AS (SELECT *, 1 AS strand FROM strands WHERE {_ON1}
            UNION ALL SELECT *, 2 AS strand FROM strands WHERE {_ON2}),
m1 AS (SELECT *, CASE WHEN variantType = 'INS' THEN mutstart ELSE mutend END AS new_end,
              CASE WHEN variantType = 'INS' THEN mutstart ELSE mutstart - 1 END AS cut
       FROM members),
m2 AS (SELECT *, row_number() OVER v AS rn, lag(new_end, 1, 0) OVER v AS prev_end
       FROM m1 WINDOW v AS (PARTITION BY sample, annotationTranscript, strand ORDER BY mutstart, POS, variantType, mutalt, protalt, GT)),
m3 AS (SELECT *, {slice0_sql('mrna', 'prev_end', 'cut')} || coalesce(mutalt, '') AS piece FROM m2),
sp AS (SELECT sample, annotationTranscript, strand, any_value(mrna) AS mrna,
              string_agg(piece, '' ORDER BY rn) AS body, arg_max(new_end, rn) AS last_end
       FROM m3 GROUP BY sample, annotationTranscript, strand),
sp2 AS (SELECT sample, annotationTranscript, strand, body || {tail0_sql('mrna', 'last_end')} AS spliced FROM sp),
tr AS (SELECT sample, annotationTranscript, strand, {_P1} AS prot, {_M1} AS cdna FROM sp2),
per_tx AS (SELECT sample, annotationTranscript, any_value(mrna) AS mrna, any_value(refProtein) AS refProtein, max(protstart) AS max_prot
           FROM changes GROUP BY sample, annotationTranscript),
wide AS (SELECT sample, annotationTranscript,
                max(CASE WHEN strand = 1 THEN cdna END) AS c1, max(CASE WHEN strand = 2 THEN cdna END) AS c2,
                max(CASE WHEN strand = 1 THEN prot END) AS p1, max(CASE WHEN strand = 2 THEN prot END) AS p2,
                max(CASE WHEN strand = 1 THEN 1 END) AS has1, max(CASE WHEN strand = 2 THEN 1 END) AS has2
         FROM tr GROUP BY sample, annotationTranscript),
proteins AS (SELECT t.sample, t.annotationTranscript,
   CASE WHEN coalesce(length(refProtein) < max_prot, false) OR has1 IS NULL THEN mrna ELSE c1 END AS cdnamut1,
   CASE WHEN coalesce(length(refProtein) < max_prot, false) OR has2 IS NULL THEN mrna ELSE c2 END AS cdnamut2,
   CASE WHEN coalesce(length(refProtein) < max_prot, false) OR has1 IS NULL THEN refProtein ELSE p1 END AS protmut1,
   CASE WHEN coalesce(length(refProtein) < max_prot, false) OR has2 IS NULL THEN refProtein ELSE p2 END AS protmut2
   FROM per_tx t LEFT JOIN wide w ON t.annotationTranscript = w.annotationTranscript AND t.sample = w.sample)"""


def proteins(spark, sf):
    s = strands(spark, sf)
    return mutated_proteins(s, strand_members(s), GROUP, ORDER, sequences=reference_sequences(spark, sf))


@register("splice_edits", _SPLICE_SQL + "\nSELECT * FROM proteins")
def q_splice_edits(spark, sf):
    """W5 + C7 + C8 + C13: splice each strand's edits into the transcript
    mRNA, translate both strands, fall back to the reference when a strand
    has no change or the reference protein is too short (segmented strand
    assignment and splicing over position slices)."""
    return proteins(spark, sf)


_TP, _TM = translate_sql("mrna")


@register(
    "translate_codons",
    with_ctes(TRANSCRIPTS) + f"""
SELECT ensembl_transcript, {_TP} AS protein, {_TM} AS cds FROM transcripts WHERE mrna IS NOT NULL""",
)
def q_translate_codons(spark, sf):
    """Translate every reference mRNA from its first start codon to the first stop."""
    t = TRANSCRIPTS.df(spark, sf).filter(F.col("mrna").isNotNull())
    tr = translate("mrna")
    return t.select("ensembl_transcript", tr["protein"].alias("protein"), tr["mrna"].alias("cds"))


# -- context windows: both proteins of the sample on the row (C9) -------------
def _va_ins_sql():
    return "(CASE WHEN mutstart % 3 <> 0 THEN CAST(floor(length(mutalt) / 3.0) AS INT) ELSE 0 END)"


def _va_del_sql():
    return "(CASE WHEN (mutstart - 1) % 3 <> 0 THEN CAST(floor(length(mutref) / 3.0) AS INT) - 1 ELSE 0 END)"


def _strand_window_sql(prot: str, base: str, on: str, pad: int = 10) -> str:
    mi_s = f"({base} + protstart - 1)"
    snp = f"CASE WHEN {mi_s} > length({prot}) THEN '*' ELSE {slice0_sql(prot, f'{mi_s} - {pad}', f'{base} + protend + {pad}')} END"
    mi_i = f"({base} + protstart)"
    st_i = f"greatest({mi_i} - {pad}, 0)"
    ins = (f"CASE WHEN variantClassification = 'FRAME_SHIFT_INS' THEN {slice0_sql(prot, f'{st_i} - 1', f'length({prot})')} "
           f"WHEN {on} THEN {slice0_sql(prot, st_i, f'{mi_i} + length(protalt) + {pad} + {_va_ins_sql()}')} "
           f"ELSE {slice0_sql(prot, st_i, f'{base} + protend + {pad} - 1')} END")
    mi_d = f"({base} + protstart - 1)"
    end_on = f"({mi_d} + {pad} + {_va_del_sql()})"
    dele = (f"CASE WHEN variantClassification = 'FRAME_SHIFT_DEL' THEN {slice0_sql(prot, f'{mi_d} - {pad}', f'length({prot})')} "
            f"WHEN {on} THEN {slice0_sql(prot, f'{mi_d} - {pad}', end_on)} "
            f"ELSE {slice0_sql(prot, f'{mi_d} - {pad}', f'{end_on} + length(protref)')} END")
    return (f"CASE WHEN variantType IN ('SNP', 'DNP', 'TNP') THEN {snp} WHEN variantType = 'INS' THEN {ins} "
            f"WHEN variantType = 'DEL' THEN {dele} END")


def _ref_window_sql(pad: int = 10) -> str:
    va = f"(CASE WHEN variantType = 'INS' THEN {_va_ins_sql()} WHEN variantType = 'DEL' THEN {_va_del_sql()} ELSE 0 END)"
    return (f"CASE WHEN variantType IN ('SNP', 'DNP', 'TNP', 'INS', 'DEL') THEN "
            f"{slice0_sql('refProtein', f'protstart - {pad}', f'protend + {pad} + {va}')} END")


_CTX_SQL = SHIFT_SQL + f""",
w0 AS (SELECT *, coalesce(whichdf, 0) AS code, coalesce(protstart > length(refProtein), false) AS beyond FROM shifted),
w1 AS (SELECT *,
   CASE WHEN beyond THEN '*' ELSE {_strand_window_sql('protmut1', 'base_before_1', 'code IN (1, 3)')} END AS sw1,
   CASE WHEN beyond THEN '*' ELSE {_strand_window_sql('protmut2', 'base_before_2', 'code IN (2, 3)')} END AS sw2,
   CASE WHEN beyond THEN NULL ELSE {_ref_window_sql()} END AS ref_peptide
   FROM w0)
SELECT sample, annotationTranscript, POS,
       CASE WHEN coalesce(hetsite, false) AND code IN (2, 3) THEN '*' ELSE sw1 END AS seqpad1,
       CASE WHEN coalesce(hetsite, false) AND code IN (1, 3) THEN '*' ELSE sw2 END AS seqpad2,
       ref_peptide
FROM w1"""


@register("context_window", _CTX_SQL)
def q_context_window(spark, sf):
    """Windows of +-10 residues around each change in both mutated
    proteins of the sample, using the carried index shift of each strand
    (segmented strand assignment and shifts), with multi-allelic-site
    masking; plus the reference window."""
    s = shifted_strands(spark, sf)
    out = context_window(s.join(sequences(spark, sf), "annotationTranscript", "left"), het_site="hetsite")
    return out.select(*GROUP, "POS", "seqpad1", "seqpad2", "ref_peptide")


# Patterns of the oracles, written apart from those under test.
_CDNA = {
    "SUB": "^c[.]([0-9]+)([A-Z]*)>([A-Z]*)$",
    "INS_RANGE": "^c[.]([0-9]+)_([0-9]+)ins([A-Z]*)$",
    "INS_POINT": "^c[.]([0-9]+)ins([A-Z]*)$",
    "DEL_RANGE": "^c[.]([0-9]+)_([0-9]+)del([A-Z]*)$",
    "DEL_POINT": "^c[.]([0-9]+)del([A-Z]*)$",
}


# -- HGVS round trips (C5, C6) -------------------------------------------------
def _cdna_text():
    return (
        "CASE WHEN variantType = 'SNP' THEN concat('c.', cast(mutstart as string), mutref, '>', mutalt) "
        "WHEN variantType = 'INS' AND POS % 2 = 0 THEN concat('c.', cast(mutstart as string), '_', cast(mutend as string), 'ins', mutalt) "
        "WHEN variantType = 'INS' THEN concat('c.', cast(mutstart as string), 'ins', mutalt) "
        "WHEN mutend > mutstart THEN concat('c.', cast(mutstart as string), '_', cast(mutend as string), 'del', mutref) "
        "ELSE concat('c.', cast(mutstart as string), 'del', mutref) END"
    )


@register(
    "hgvs_cdna",
    with_ctes(CHANGES) + f""",
t AS (SELECT POS, variantType, {_cdna_text()} AS cDnaChange FROM changes)
SELECT POS, cDnaChange,
  CAST(CASE WHEN variantType IN ('SNP','DNP','TNP','ONP') AND regexp_matches(cDnaChange, '{_CDNA["SUB"]}')
         THEN CAST(regexp_extract(cDnaChange, '{_CDNA["SUB"]}', 1) AS INT)
       WHEN variantType = 'INS' AND regexp_matches(cDnaChange, '{_CDNA["INS_RANGE"]}') THEN CAST(regexp_extract(cDnaChange, '{_CDNA["INS_RANGE"]}', 1) AS INT)
       WHEN variantType = 'INS' AND regexp_matches(cDnaChange, '{_CDNA["INS_POINT"]}') THEN CAST(regexp_extract(cDnaChange, '{_CDNA["INS_POINT"]}', 1) AS INT)
       WHEN variantType = 'DEL' AND regexp_matches(cDnaChange, '{_CDNA["DEL_RANGE"]}') THEN CAST(regexp_extract(cDnaChange, '{_CDNA["DEL_RANGE"]}', 1) AS INT)
       WHEN variantType = 'DEL' AND regexp_matches(cDnaChange, '{_CDNA["DEL_POINT"]}') THEN CAST(regexp_extract(cDnaChange, '{_CDNA["DEL_POINT"]}', 1) AS INT)
  END AS BIGINT) AS mutstart,
  CAST(CASE WHEN variantType IN ('SNP','DNP','TNP','ONP') AND regexp_matches(cDnaChange, '{_CDNA["SUB"]}')
         THEN CAST(regexp_extract(cDnaChange, '{_CDNA["SUB"]}', 1) AS INT) + length(regexp_extract(cDnaChange, '{_CDNA["SUB"]}', 2)) - 1
       WHEN variantType = 'INS' AND regexp_matches(cDnaChange, '{_CDNA["INS_RANGE"]}') THEN CAST(regexp_extract(cDnaChange, '{_CDNA["INS_RANGE"]}', 2) AS INT)
       WHEN variantType = 'INS' AND regexp_matches(cDnaChange, '{_CDNA["INS_POINT"]}') THEN CAST(regexp_extract(cDnaChange, '{_CDNA["INS_POINT"]}', 1) AS INT)
       WHEN variantType = 'DEL' AND regexp_matches(cDnaChange, '{_CDNA["DEL_RANGE"]}') THEN CAST(regexp_extract(cDnaChange, '{_CDNA["DEL_RANGE"]}', 2) AS INT)
       WHEN variantType = 'DEL' AND regexp_matches(cDnaChange, '{_CDNA["DEL_POINT"]}') THEN CAST(regexp_extract(cDnaChange, '{_CDNA["DEL_POINT"]}', 1) AS INT)
  END AS BIGINT) AS mutend,
  CASE WHEN variantType IN ('SNP','DNP','TNP','ONP') AND regexp_matches(cDnaChange, '{_CDNA["SUB"]}') THEN regexp_extract(cDnaChange, '{_CDNA["SUB"]}', 2)
       WHEN variantType = 'INS' AND (regexp_matches(cDnaChange, '{_CDNA["INS_RANGE"]}') OR regexp_matches(cDnaChange, '{_CDNA["INS_POINT"]}')) THEN ''
       WHEN variantType = 'DEL' AND regexp_matches(cDnaChange, '{_CDNA["DEL_RANGE"]}') THEN regexp_extract(cDnaChange, '{_CDNA["DEL_RANGE"]}', 3)
       WHEN variantType = 'DEL' AND regexp_matches(cDnaChange, '{_CDNA["DEL_POINT"]}') THEN regexp_extract(cDnaChange, '{_CDNA["DEL_POINT"]}', 2) END AS mutref,
  CASE WHEN variantType IN ('SNP','DNP','TNP','ONP') AND regexp_matches(cDnaChange, '{_CDNA["SUB"]}') THEN regexp_extract(cDnaChange, '{_CDNA["SUB"]}', 3)
       WHEN variantType = 'INS' AND regexp_matches(cDnaChange, '{_CDNA["INS_RANGE"]}') THEN regexp_extract(cDnaChange, '{_CDNA["INS_RANGE"]}', 3)
       WHEN variantType = 'INS' AND regexp_matches(cDnaChange, '{_CDNA["INS_POINT"]}') THEN regexp_extract(cDnaChange, '{_CDNA["INS_POINT"]}', 2)
       WHEN variantType = 'DEL' AND (regexp_matches(cDnaChange, '{_CDNA["DEL_RANGE"]}') OR regexp_matches(cDnaChange, '{_CDNA["DEL_POINT"]}')) THEN '' END AS mutalt
FROM t""",
)
def q_hgvs_cdna(spark, sf):
    """Parse cDNA change text (built from each change's own fields) back
    into start, end, reference and alternate by variant type."""
    t = CHANGES.df(spark, sf).selectExpr("POS", "variantType", f"{_cdna_text()} AS cDnaChange")
    p = hgvs.parse_cdna("cDnaChange", "variantType")
    return t.select(
        "POS", "cDnaChange",
        p["mutstart"].cast("bigint").alias("mutstart"), p["mutend"].cast("bigint").alias("mutend"),
        p["mutref"].alias("mutref"), p["mutalt"].alias("mutalt"),
    )


def _prot_text():
    return (
        "CASE WHEN variantType = 'SNP' AND variantClassification = 'NONSENSE' THEN concat('p.', protref, cast(protstart as string), '*') "
        "WHEN variantType = 'SNP' THEN concat('p.', protref, cast(protstart as string), protalt) "
        "WHEN variantType = 'DEL' AND POS % 5 = 0 THEN concat('p.', protref, '*Q', cast(protstart as string)) "
        "WHEN variantType = 'DEL' AND POS % 5 = 1 THEN concat('p.', protref, '*', cast(protstart as string), 'fs') "
        "WHEN variantType = 'INS' AND variantClassification = 'FRAME_SHIFT_INS' THEN concat('p.', substr(refProtein, protstart, 1), cast(protstart as string), 'fs') "
        "WHEN variantType = 'INS' AND POS % 3 = 0 THEN concat('p.', cast(protstart as string), '_', cast(protend + 1 as string), 'ins', protalt) "
        "WHEN variantType = 'INS' THEN concat('p.', substr(refProtein, protstart, 1), cast(protstart as string), protalt) "
        "WHEN variantType = 'DEL' AND POS % 3 = 1 THEN concat('p.', cast(protstart as string), '_', cast(protstart + 1 as string), protref, 'Q>', protref) "
        "WHEN variantClassification = 'FRAME_SHIFT_DEL' THEN concat('p.', protref, cast(protstart as string), 'fs') "
        "ELSE concat('p.', protref, cast(protstart as string), 'del') END"
    )


def _prot_sql() -> str:
    S, L = "^p[.]([A-Z]+)([0-9]+)([A-Z]*)$", "^p[.]([A-Z]+)([0-9]+)"
    SS, SD = "^p[.]([A-Z*]+)([0-9]+)([A-Z*]*)$", "^p[.]([A-Z]+)[*]([A-Z]+)([0-9]+)$"
    IR, DS = "^p[.][A-Z]*([0-9]+)_[A-Z]*([0-9]+)ins([A-Z]*)$", "^p[.][A-Z]*([0-9]+)(?:_[A-Z]*[0-9]+)?([A-Z]+)>([A-Z]+)$"
    m = lambda p: f"regexp_matches(pc, '{p}')"
    x = lambda p, g: f"regexp_extract(pc, '{p}', {g})"
    sub = f"variantType IN ('SNP','DNP','TNP','ONP') AND {m(SS)}"
    ifs = f"variantType = 'INS' AND contains(pc, 'fs') AND {m(L)}"
    isvp = f"variantType = 'INS' AND contains(pc, 'SVP') AND {m(L)}"
    ir = f"variantType = 'INS' AND contains(pc, '_') AND {m(IR)}"
    isub = f"variantType = 'INS' AND NOT contains(pc, '_') AND {m(S)}"
    ds = f"variantType = 'DEL' AND contains(pc, '>') AND {m(DS)}"
    dsf = f"variantType = 'DEL' AND contains(pc, '*') AND contains(pc, 'fs') AND regexp_matches(pc, '\\*(\\d+)fs')"
    sd = f"variantType = 'DEL' AND contains(pc, '*') AND NOT contains(pc, 'fs') AND NOT contains(pc, '>') AND {m(SD)}"
    dp = f"variantType = 'DEL' AND NOT contains(pc, '*') AND {m(L)}"
    star_n = "CAST(regexp_extract(pc, '\\*(\\d+)fs', 1) AS INT)"
    start = (f"CASE WHEN {sub} THEN CAST({x(SS, 2)} AS INT) WHEN {ifs} OR {isvp} THEN CAST({x(L, 2)} AS INT) "
             f"WHEN {ir} THEN CAST({x(IR, 1)} AS INT) WHEN {isub} THEN CAST({x(S, 2)} AS INT) "
             f"WHEN {ds} THEN CAST({x(DS, 1)} AS INT) WHEN {dsf} THEN {star_n} WHEN {sd} THEN CAST({x(SD, 3)} AS INT) WHEN {dp} THEN CAST({x(L, 2)} AS INT) END")
    end = (f"CASE WHEN {ir} AND NOT ({sub}) AND NOT ({ifs}) AND NOT ({isvp}) THEN CAST({x(IR, 2)} AS INT) ELSE {start} END")
    ref = (f"CASE WHEN {sub} THEN {x(SS, 1)} WHEN {ifs} THEN {x(L, 1)} WHEN {isvp} THEN '' WHEN {ir} THEN '' "
           f"WHEN {isub} THEN {x(S, 1)} WHEN {ds} THEN {x(DS, 2)} WHEN {dsf} THEN '*' WHEN {sd} THEN {x(SD, 1)} WHEN {dp} THEN {x(L, 1)} END")
    alt = (f"CASE WHEN {sub} THEN {x(SS, 3)} WHEN {ifs} THEN '' WHEN {isvp} THEN {x(L, 1)} WHEN {ir} THEN {x(IR, 3)} "
           f"WHEN {isub} THEN {x(S, 3)} WHEN {ds} THEN {x(DS, 3)} WHEN {dsf} THEN '*' WHEN {sd} THEN {x(SD, 2)} WHEN {dp} THEN '' END")
    fs = (f"CASE WHEN {sub} THEN false WHEN {ifs} THEN true WHEN {isvp} THEN false WHEN {ir} THEN false "
          f"WHEN {isub} THEN false WHEN {ds} THEN false WHEN {dsf} THEN true WHEN {sd} THEN false WHEN {dp} THEN contains(pc, 'fs') END")
    return (f"CAST({start} AS BIGINT) AS protstart, CAST({end} AS BIGINT) AS protend, {ref} AS protref, "
            f"{alt} AS protalt, {fs} AS frameshift")


@register(
    "hgvs_protein",
    with_ctes(CHANGES) + f""",
t AS (SELECT POS, variantType, {_prot_text()} AS pc FROM changes)
SELECT POS, pc AS proteinChange, {_prot_sql()} FROM t""",
)
def q_hgvs_protein(spark, sf):
    """Parse protein change text of every grammar branch (substitution,
    frameshift insertion, ranged insertion, ranged substitution-deletion,
    frameshift deletion, plain deletion) into start, end, ref, alt, fs."""
    t = CHANGES.df(spark, sf).selectExpr("POS", "variantType", f"{_prot_text()} AS proteinChange")
    p = hgvs.parse_protein("proteinChange", "variantType")
    return t.select(
        "POS", "proteinChange",
        p["protstart"].cast("bigint").alias("protstart"), p["protend"].cast("bigint").alias("protend"),
        p["protref"].alias("protref"), p["protalt"].alias("protalt"), p["frameshift"].alias("frameshift"),
    )


@register(
    "cds_slice",
    with_ctes(TRANSCRIPTS) + """,
t AS (SELECT ensembl_transcript, mrna, length(mrna) % 7 + 3 AS cds_from, length(mrna) - length(mrna) % 5 AS cds_to FROM transcripts)
SELECT ensembl_transcript, CAST(cds_from AS BIGINT) AS cds_from, CAST(cds_to AS BIGINT) AS cds_to,
       substring(mrna, greatest(cds_from - 1, 0) + 1, greatest(cds_to - greatest(cds_from - 1, 0), 0)) AS cds,
       CAST(length(substring(mrna, greatest(cds_from - 1, 0) + 1, greatest(cds_to - greatest(cds_from - 1, 0), 0))) AS BIGINT) AS cds_len
FROM t""",
)
def q_cds_slice(spark, sf):
    """P14 + C14: coding slice of each mRNA by a 1-based inclusive range, and its length."""
    t = TRANSCRIPTS.df(spark, sf).selectExpr(
        "ensembl_transcript", "mrna", "length(mrna) % 7 + 3 AS cds_from", "length(mrna) - length(mrna) % 5 AS cds_to"
    )
    cds = cds_slice("mrna", "cds_from", "cds_to")
    return t.select(
        "ensembl_transcript", F.col("cds_from").cast("bigint").alias("cds_from"),
        F.col("cds_to").cast("bigint").alias("cds_to"), cds.alias("cds"), F.length(cds).cast("bigint").alias("cds_len"),
    )
