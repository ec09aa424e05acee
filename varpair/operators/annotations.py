"""Annotation explode and the NULL-keeping filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import genotype as G

# Variant classes dropped before the reference join.
DROPPED_CLASSES = [
    "IGR", "INTRON", "FIVE_PRIME_FLANK", "THREE_PRIME_UTR", "FIVE_PRIME_UTR", "SPLICE_SITE",
    "COULD_NOT_DETERMINE", "RNA", "LINCRNA", "NONSTOP", "SILENT",
]
DROPPED_TYPES = ["ONP"]
# Annotation field names kept after the explode.
KEPT_FIELDS = [
    "hugoSymbol", "ncbiBuild", "chromosome", "start", "end", "variantClassification",
    "secondaryVariantClassification", "variantType", "refAllele", "tumorSeqAllele1", "tumorSeqAllele2",
    "genomeChange", "annotationTranscript", "transcriptStrand", "transcriptExon", "transcriptPos",
    "cDnaChange", "codonChange", "proteinChange", "gcContent", "referenceContext", "otherTranscripts",
]
INFO_PREFIX = "FUNCOTATION="
FIELD_PREFIX = "Gencode_19_"


def not_in(c: str | Column, values: Sequence[str]) -> Column:
    """``~isin`` that keeps NULL rows (pandas semantics, SURVEY §1.4.3)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(~col.isin(*values), F.lit(True))


def not_equal(c: str | Column, value: str) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(col != value, F.lit(True))


def explode_annotations(df: DataFrame, info: str = "INFO", out: str = "annotation") -> DataFrame:
    """C1 + C3: strip the ``FUNCOTATION=`` tag, one row per transcript (``#``)
    and allele (``,``), brackets removed.  A generator on the row: no shuffle."""
    raw = F.regexp_replace(F.col(info), INFO_PREFIX, "")
    nested = F.flatten(F.transform(F.split(raw, "#"), lambda t: F.split(t, ",")))
    return df.withColumn(out, F.explode(nested)).withColumn(out, F.regexp_replace(F.col(out), r"\[|\]", ""))


def annotation_fields(df: DataFrame, names: Sequence[str], keep: Sequence[str] | None = None,
                      src: str = "annotation") -> DataFrame:
    """F2 + P4: drop ``Unknown…`` annotations (NULL kept out of the match), split
    on ``|`` and name the parts by the header's field list."""
    df = df.filter(~F.coalesce(F.col(src).startswith("Unknown"), F.lit(False)))
    parts = F.split(F.col(src), r"\|")
    wanted = set(keep) if keep is not None else None
    cols = [F.try_element_at(parts, F.lit(i + 1)).alias(n) for i, n in enumerate(names) if wanted is None or n in wanted]
    return df.select("*", *cols)


def field_names(header_line: str) -> list[str]:
    """Field names from the ``##INFO=<ID=FUNCOTATION ...: a|b|c">`` line."""
    text = header_line.replace('"', "").replace(">", "")
    body = text.split(": ", 1)[1] if ": " in text else text
    return [f.replace(FIELD_PREFIX, "") for f in body.split("|")]


def annotation_filters(df: DataFrame) -> DataFrame:
    """F3 + F4: NULL-keeping removal of empty protein changes, unwanted
    classes and ONP variants."""
    return df.filter(
        not_equal("proteinChange", "") & not_in("variantClassification", DROPPED_CLASSES)
        & not_in("variantType", DROPPED_TYPES)
    )


def genotypes(df: DataFrame, sample: str, gt_out: str | None = None) -> DataFrame:
    """P5 + F5 + P6: genotype field, kept genotypes only, zygosity."""
    gt = gt_out or f"{sample}_GT"
    out = df.withColumn(gt, G.gt_field(sample)).filter(F.col(gt).isin(*G.KEPT_GENOTYPES))
    return out.withColumn(f"{sample}_loci", G.zygosity(gt))


def pass_filter(df: DataFrame, filter_col: str = "FILTER", gt_col: str | None = None) -> DataFrame:
    """``FILTER = PASS`` and (optionally) a called genotype (no ``.``)."""
    cond = F.col(filter_col) == "PASS"
    if gt_col is not None:
        cond = cond & ~F.coalesce(F.col(gt_col).contains("."), F.lit(True))
    return df.filter(cond)


def reference_filters(df: DataFrame, keep_nonsense: bool = False) -> DataFrame:
    """F7 + F8: no ``*`` in the protein change (unless ``keep_nonsense``), no
    in-frame deletions, cDNA and protein change present (NULL-safe as in pandas)."""
    stop = F.lit(False) if keep_nonsense else F.coalesce(F.col("proteinChange").contains("*"), F.lit(False))
    return df.filter(
        ~stop & not_equal("variantClassification", "IN_FRAME_DEL")
        & F.col("cDnaChange").isNotNull() & F.col("proteinChange").isNotNull()
    )


# Names of the Y chromosome.
Y_CHROMOSOMES = ["chrY", "Y"]


def called(df: DataFrame, gt: str) -> DataFrame:
    """genotype present and not ``0/0``."""
    return df.filter(F.coalesce(F.col(gt) != "0/0", F.lit(False)))


def on_chromosomes(df: DataFrame, chrom: str = "CHROM", names: Sequence[str] = Y_CHROMOSOMES) -> DataFrame:
    """rows on the given chromosomes (Y by default)."""
    return df.filter(F.col(chrom).isin(*names))
