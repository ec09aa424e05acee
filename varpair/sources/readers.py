"""File sources (S1–S11, S14): VCF, tab tables, GCT expression, alignment
hits, interval lists and allele lists.  Every reader returns DataFrames with
explicit schemas; only header lines (a handful of short strings) are read on
the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.annotations import field_names
from ..operators.intervals import interval_list_to_bed
from .bgzip import SPLIT_BYTES, is_block_gzip, read_block_gzip

VCF_FIXED = ["CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT"]
INFO_HEADER = "##INFO=<ID=FUNCOTATION"

# The 15 columns of the headerless alignment-hit CSV.
HIT_SCHEMA = T.StructType([
    T.StructField("protein_id", T.StringType()), T.StructField("peptide_id", T.StringType()),
    T.StructField("protein_len", T.IntegerType()), T.StructField("peptide_len", T.IntegerType()),
    T.StructField("protein_start", T.IntegerType()), T.StructField("protein_end", T.IntegerType()),
    T.StructField("peptide_start", T.IntegerType()), T.StructField("peptide_end", T.IntegerType()),
    T.StructField("protein_seq", T.StringType()), T.StructField("peptide_seq", T.StringType()),
    T.StructField("evalue", T.DoubleType()), T.StructField("score", T.DoubleType()),
    T.StructField("alignment_length", T.IntegerType()), T.StructField("p_ident", T.DoubleType()),
    T.StructField("n_ident", T.IntegerType()),
])

REFERENCE_SCHEMA = T.StructType([
    T.StructField("gene", T.StringType()), T.StructField("ensembl_gene", T.StringType()),
    T.StructField("ensembl_transcript", T.StringType()), T.StructField("mrna", T.StringType()),
    T.StructField("refProtein", T.StringType()),
])


def read_lines(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Lines of a text file as ``value``.  Block gzip is read by one task for every
    ``split_bytes``; any other gzip file is one split and is dealt out after the scan."""
    if is_block_gzip(path):
        return read_block_gzip(spark, path, split_bytes)
    lines = spark.read.text(path)
    return lines.repartition(spark.sparkContext.defaultParallelism) if path.endswith((".gz", ".bgz")) else lines


def read_vcf(spark: SparkSession, path: str, sample: str, split_bytes: int = SPLIT_BYTES) -> tuple[DataFrame, DataFrame]:
    """``(header_lines, body)`` of a block-gzip, gzip or plain VCF.

    ``#CHROM`` becomes ``CHROM`` and the last column is named ``sample``.  The
    name line is searched in the lines that begin with ``#``; the body is parsed
    in the tasks that read it.
    """
    lines = read_lines(spark, path, split_bytes)
    header = lines.filter(F.col("value").startswith("##"))
    names_line = lines.filter(F.col("value").startswith("#CHROM")).select("value").first()
    cols = names_line[0].lstrip("#").split("\t") if names_line else VCF_FIXED + [sample]
    cols = cols[:-1] + [sample]
    body = lines.filter(~F.col("value").startswith("#"))
    parts = F.split(F.col("value"), "\t")
    body = body.select(*[F.try_element_at(parts, F.lit(i + 1)).alias(c) for i, c in enumerate(cols)])
    return header, body


def annotation_field_names(header: DataFrame) -> list[str]:
    """Annotation field names from the ``##INFO=<ID=FUNCOTATION`` line."""
    row = header.filter(F.col("value").startswith(INFO_HEADER)).select("value").first()
    return field_names(row[0]) if row else []


def read_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
               sep: str = "\t", header: bool = True) -> DataFrame:
    """Delimited table with a header (explicit schema
    when given; otherwise all columns as strings, never inferred)."""
    r = spark.read.option("sep", sep).option("header", header)
    if schema is not None:
        r = r.schema(schema)
    return r.csv(path)


def read_reference(spark: SparkSession, path: str) -> DataFrame:
    """S3: transcript reference table; rows without mRNA removed."""
    return read_table(spark, path, REFERENCE_SCHEMA).filter(F.col("mrna").isNotNull())


def read_gct(spark: SparkSession, path: str) -> DataFrame:
    """GCT expression table (``#1.2``, a dimension line, a name line,
    then ``Name, Description, TPM``) with TPM as double."""
    lines = spark.read.text(path)
    v = F.col("value")
    body = lines.filter(~v.startswith("#1.") & ~v.rlike(r"^\d+\t\d+\s*$") & ~v.startswith("Name\t"))
    parts = F.split(v, "\t")
    return body.select(
        parts[0].alias("Name"),
        F.try_element_at(parts, F.lit(2)).alias("Description"),
        F.try_element_at(parts, F.lit(3)).try_cast("double").alias("TPM"),
    )


def read_hits(spark: SparkSession, path: str) -> DataFrame:
    """Headerless alignment-hit CSV with its 15 named columns."""
    return spark.read.schema(HIT_SCHEMA).option("header", False).csv(path)


def read_interval_list(spark: SparkSession, path: str) -> DataFrame:
    """Interval list to 0-based half-open ``(chrom, start, end)``."""
    return interval_list_to_bed(spark.read.text(path))


def read_alleles(spark: SparkSession, path: str) -> DataFrame:
    """One allele per line, trimmed, distinct, blanks dropped."""
    a = spark.read.text(path).select(F.trim("value").alias("allele"))
    return a.filter(F.col("allele") != "").distinct()
