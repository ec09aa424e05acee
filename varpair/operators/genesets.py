"""Gene sets: selection by tissue × sex, set algebra, membership flags and
the tissue-class branch (S4, U1–U6, F13, P10, J8–J10, A4–A6)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Sets to one mask (the bits of a long without its sign).
MAX_SETS = 63

# Expression thresholds (TPM) of the patient-specific set.
LOW_TPM = 2.0
HIGH_TPM = 32.0
# Summary label -> exact class string, and the class-count bins.
TISSUE_CLASS_KEYS = {
    "Pan expressed genes": "pan expressed gene",
    "Genes expressed in non-hemato tissues": "lung,liver,skin,colon,lacrimal,oral",
    "Genes expressed in lung": "lung",
    "Genes expressed in liver": "liver",
    "Genes expressed in skin": "skin",
    "Genes expressed in colon": "colon",
    "Genes expressed in lacrimal": "lacrimal",
    "Genes expressed in oral": "oral",
    "Genes expressed in hematopoietic": "hematopoietic",
}
TISSUE_BINS = [2, 3, 4, 5]


def gene_set(sets: DataFrame, tissue: str, sex: str, symbol: str = "symbol") -> DataFrame:
    """S4 + U1: symbols of the set for ``tissue`` and ``sex`` (``unknown`` sex =
    union of both sexes), distinct."""
    cond = F.col("tissue") == tissue
    if sex.lower() != "unknown":
        cond = cond & (F.col("sex") == sex)
    return sets.filter(cond).select(symbol).distinct()


def set_masks(sets: dict[str, DataFrame]) -> DataFrame:
    """``(gene, mask)``: every gene of any set once, with bit ``i`` set if the
    ``i``-th set holds it; NULL is a gene like others.  One grouped bitwise or
    over all sets; set algebra on the result is bit arithmetic."""
    if len(sets) > MAX_SETS:
        raise ValueError(f"at most {MAX_SETS} sets to a mask")
    tagged = [s.select(F.col(f"`{s.columns[0]}`").alias("gene"), F.lit(1 << i).cast("long").alias("mask")) for i, s in enumerate(sets.values())]
    return reduce(DataFrame.unionByName, tagged).groupBy("gene").agg(F.bit_or("mask").alias("mask"))


def has_all(*bits: int) -> Column:
    """Does ``mask`` have all of these bits?"""
    want = sum(1 << b for b in bits)
    return F.col("mask").bitwiseAND(F.lit(want)) == want


def expressed_genes(
    tpm: DataFrame, rna_low: DataFrame, prot_low: DataFrame,
    gene: str = "Description", value: str = "TPM", lo: float = LOW_TPM, hi: float = HIGH_TPM,
) -> DataFrame:
    """F13 + U2 + U6: (expressed above ``lo`` ∩ low protein ∩ low RNA) ∪
    (expressed above ``hi`` ∩ low RNA), one column ``gene``."""
    above = [tpm.filter(F.col(value) > level).select(gene) for level in (lo, hi)]
    masks = set_masks({"lo": above[0], "hi": above[1], "rna": rna_low, "prot": prot_low})
    return masks.filter(has_all(0, 2, 3) | has_all(1, 2)).select("gene")


def flag_gene_sets(
    df: DataFrame, sets: dict[str, DataFrame], gene: str = "hugoSymbol",
) -> DataFrame:
    """P10: one yes/no column per named set, from one left join to the sets'
    masks for every ``MAX_SETS`` sets (a NULL gene is in none).  A column of a
    set's name is replaced."""
    out, names = df, list(sets)
    for at in range(0, len(names), MAX_SETS):
        some = names[at : at + MAX_SETS]
        masks = set_masks({n: sets[n] for n in some}).where("gene IS NOT NULL").select(F.col("gene").alias("_gene"), "mask")
        out = out.join(masks, F.col(gene) == F.col("_gene"), "left")
        flags = {n: F.when(has_all(i), F.lit("yes")).otherwise(F.lit("no")) for i, n in enumerate(some)}
        out = out.withColumns(flags).drop("_gene", "mask")
    return out


def keep_in_set(df: DataFrame, s: DataFrame, gene: str = "hugoSymbol") -> DataFrame:
    """Rows whose gene is in the set (semi join)."""
    keys = s.select(F.col(s.columns[0]).alias("_g")).distinct()
    return df.join(keys, F.col(gene) == F.col("_g"), "left_semi")


def tissue_classes(
    df: DataFrame, classes: DataFrame, gene: str = "hugoSymbol",
    class_gene: str = "gvhd_genes", class_col: str = "gvhd_classfication",
) -> DataFrame:
    """J8 + J9: keep rows of genes with a tissue class and attach the class."""
    cl = classes.select(F.col(class_gene).alias("_cg"), F.col(class_col).alias(class_col))
    out = df.join(cl, F.col(gene) == F.col("_cg"), "inner")
    return out.drop("_cg")


def gene_classes(df: DataFrame, gene: str = "hugoSymbol", class_col: str = "gvhd_classfication") -> DataFrame:
    """A1: distinct (gene, class) pairs, the unit every class count uses."""
    return df.select(gene, class_col).distinct()


def class_value_counts(df: DataFrame, class_col: str = "gvhd_classfication") -> DataFrame:
    """A3: rows per class string, most frequent first."""
    return df.groupBy(class_col).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), class_col)


def class_size_histogram(df: DataFrame, class_col: str = "gvhd_classfication") -> DataFrame:
    """A5: rows per number of comma-separated classes."""
    k = F.size(F.split(F.col(class_col), ",")).alias("n_classes")
    return df.groupBy(k).agg(F.count(F.lit(1)).alias("n"))


def fixed_class_counts(df: DataFrame, class_col: str = "gvhd_classfication") -> DataFrame:
    """One row with a count per fixed class string and per class-count
    bin; a key that never occurs counts 0 (one pass, ``count_if``)."""
    c = F.col(class_col)
    size = F.size(F.split(c, ","))
    aggs = [F.count_if(F.coalesce(c == v, F.lit(False))).alias(k) for k, v in TISSUE_CLASS_KEYS.items()]
    aggs += [F.count_if(F.coalesce(size == b, F.lit(False))).alias(f"Genes expressed by {b} gvhd tissues")
             for b in TISSUE_BINS]
    return df.agg(*aggs)
