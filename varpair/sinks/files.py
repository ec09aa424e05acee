"""File sinks (K1–K5).  Writes are distributed (one part file per task) and
``overwrite`` (never append)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.kmers import MAX_PEP_LEN, MIN_PEP_LEN


def write_tsv(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """K1: tab-separated with header; booleans rendered yes/no."""
    out = df.select(*[
        F.when(F.col(f.name), F.lit("yes")).otherwise(F.lit("no")).alias(f.name)
        if isinstance(f.dataType, T.BooleanType) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])
    w = out.write.mode("overwrite").option("sep", "\t").option("header", True)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)


def fasta_records(df: DataFrame, id_col: str, seq_col: str) -> DataFrame:
    """K2: one FASTA record (``>id\\nseq``) per row, as a text column."""
    return df.select(F.concat(F.lit(">"), F.col(id_col), F.lit("\n"), F.col(seq_col)).alias("value"))


def proteome_records(df: DataFrame, gene: str = "gene", ensembl_gene: str = "ensembl_gene",
                     transcript: str = "annotationTranscript", p1: str = "protmut1", p2: str = "protmut2") -> DataFrame:
    """K2: two records per transcript (``gene|ensembl_gene|transcript|transcript_k``)."""
    base = F.concat_ws("|", F.col(gene), F.col(ensembl_gene), F.col(transcript))
    long = df.select(
        base.alias("_id"),
        F.explode(F.array(
            F.struct(F.lit("transcript_1").alias("k"), F.col(p1).alias("s")),
            F.struct(F.lit("transcript_2").alias("k"), F.col(p2).alias("s")),
        )).alias("_r"),
    )
    return long.select(F.concat(F.col("_id"), F.lit("|"), F.col("_r.k")).alias("id"), F.col("_r.s").alias("seq"))


def write_fasta(df: DataFrame, id_col: str, seq_col: str, path: str) -> None:
    fasta_records(df, id_col, seq_col).write.mode("overwrite").text(path)


def write_proteome_fasta(df: DataFrame, path: str, exclude_genes: DataFrame | None = None, gene: str = "gene") -> None:
    """K2 + K3: the two-strand proteome, optionally without a gene list (anti join)."""
    if exclude_genes is not None:
        ex = exclude_genes.select(F.col(exclude_genes.columns[0]).alias("_x")).distinct()
        df = df.join(ex, F.col(gene) == F.col("_x"), "left_anti")
    write_fasta(proteome_records(df), "id", "seq", path)


def write_peptide_fasta(df: DataFrame, path: str, id_col: str = "transid", pep: str = "pep") -> None:
    """K4: peptide FASTA with the real 8..11 length gate."""
    gated = df.filter(F.length(pep).between(MIN_PEP_LEN, MAX_PEP_LEN))
    write_fasta(gated, id_col, pep, path)


def write_summary(df: DataFrame, path: str) -> None:
    """K5: one-row summary CSV; map cells are written as JSON text."""
    cols = [F.to_json(F.col(f.name)).alias(f.name) if isinstance(f.dataType, (T.MapType, T.ArrayType, T.StructType))
            else F.col(f.name) for f in df.schema.fields]
    df.select(*cols).coalesce(1).write.mode("overwrite").option("header", True).csv(path)
