"""Round trips of the file sources and sinks through a temporary folder."""

import gzip
import os

from pyspark.sql import functions as F

from varpair.operators.annotations import annotation_fields, explode_annotations, genotypes
from varpair.sinks.files import proteome_records, write_peptide_fasta, write_tsv
from varpair.sources.params import RunParams
from varpair.sources.readers import (
    annotation_field_names,
    read_alleles,
    read_gct,
    read_hits,
    read_interval_list,
    read_vcf,
)

VCF_HEADER = [
    "##fileformat=VCFv4.2",
    '##INFO=<ID=FUNCOTATION,Number=A,Type=String,Description="Functional annotation: Gencode_19_hugoSymbol|Gencode_19_variantClassification|Gencode_19_annotationTranscript|Gencode_19_proteinChange">',
    "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tSAMPLE1",
]
VCF_ROWS = [
    "chr1\t100\t.\tA\tG\t50\tPASS\tFUNCOTATION=[GENE1|MISSENSE|T1|p.A12V]#[GENE2|SILENT|T2|p.A3A]\tGT:DP\t0/1:10",
    "chr1\t200\t.\tC\tT,G\t50\tPASS\tFUNCOTATION=[Unknown|IGR|T9|],[GENE3|NONSENSE|T3|p.Q5*]\tGT:DP\t1/2:8",
    "chr2\t300\t.\tG\tGA\t50\tPASS\tFUNCOTATION=[GENE4|FRAME_SHIFT_INS|T4|p.K4fs]\tGT:DP\t0|1:7",
]


def _write_bgzip_like(path, lines):
    # several gzip members, as bgzip writes them
    with open(path, "wb") as f:
        for chunk in (lines[:2], lines[2:4], lines[4:]):
            f.write(gzip.compress(("\n".join(chunk) + "\n").encode()))


def test_vcf_round_trip(spark, tmp_path):
    p = os.path.join(tmp_path, "host.vcf.gz")
    _write_bgzip_like(p, VCF_HEADER + VCF_ROWS)
    header, body = read_vcf(spark, p, "host")
    assert body.columns[-1] == "host" and body.columns[0] == "CHROM"
    assert body.count() == 3
    names = annotation_field_names(header)
    assert names == ["hugoSymbol", "variantClassification", "annotationTranscript", "proteinChange"]
    ann = annotation_fields(explode_annotations(body, "INFO"), names)
    assert ann.count() == 4  # 5 annotations, one Unknown
    gts = genotypes(ann, "host")
    assert sorted(r.host_GT for r in gts.collect()) == ["0/1", "0/1", "1/2"]  # phased 0|1 dropped


def test_gct_hits_intervals_alleles(spark, tmp_path):
    gct = os.path.join(tmp_path, "tpm.gct")
    with open(gct, "w") as f:
        f.write("#1.2\n2\t1\nName\tDescription\tTPM\nENSG1\tGENE1\t3.5\nENSG2\tGENE2\tNA\n")
    t = read_gct(spark, gct).orderBy("Name").collect()
    assert [(r.Description, r.TPM) for r in t] == [("GENE1", 3.5), ("GENE2", None)]

    hits = os.path.join(tmp_path, "hits.csv")
    with open(hits, "w") as f:
        f.write("G1|T1,Y1:T:1_9,300,9,1,9,1,9,AAA,BBB,0.1,20,9,100.0,9\n")
    h = read_hits(spark, hits).collect()[0]
    assert h.peptide_len == 9 and h.p_ident == 100.0

    il = os.path.join(tmp_path, "t.interval_list")
    with open(il, "w") as f:
        f.write("@HD\tVN:1.6\n@SQ\tSN:chr1\nchr1\t101\t200\t+\tx\n")
    assert [(r.chrom, r.start, r.end) for r in read_interval_list(spark, il).collect()] == [("chr1", 100, 200)]

    al = os.path.join(tmp_path, "alleles.txt")
    with open(al, "w") as f:
        f.write(" HLA-A0101\nHLA-A0101\n\nHLA-B0702 \n")
    assert sorted(r.allele for r in read_alleles(spark, al).collect()) == ["HLA-A0101", "HLA-B0702"]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("G", "EG", "T1", "MAA*", "MAB*", True)],
                               "gene string, ensembl_gene string, annotationTranscript string, protmut1 string,"
                               " protmut2 string, flag boolean")
    recs = sorted(r.id for r in proteome_records(df).collect())
    assert recs == ["G|EG|T1|transcript_1", "G|EG|T1|transcript_2"]
    out = os.path.join(tmp_path, "t.tsv")
    write_tsv(df, out)
    back = spark.read.option("sep", "\t").option("header", True).csv(out).collect()[0]
    assert back.flag == "yes"
    peps = spark.createDataFrame([("a", "ABCDEFGH"), ("b", "ABC"), ("c", "ABCDEFGHIJKL")], "transid string, pep string")
    fa = os.path.join(tmp_path, "p.fa")
    write_peptide_fasta(peps, fa)
    text = "\n".join(r.value for r in spark.read.text(fa).collect())
    assert ">a" in text and ">b" not in text and ">c" not in text


def test_params():
    p = RunParams("BLOOD", host_sex="Male", donor_sex="f")
    assert (p.host_sex, p.donor_sex, p.female_to_male) == ("M", "F", True)
    assert RunParams("X", host_sex="?").host_sex == "unknown"


def test_small_operators(spark, tmp_path):
    from varpair.operators.annotations import pass_filter
    from varpair.operators.genesets import gene_set, keep_in_set
    from varpair.operators.summary import counts_map, observed
    from varpair.sinks.files import write_summary

    sets = spark.createDataFrame([("AML", "M", "A"), ("AML", "F", "B"), ("AML", "M", "C"), ("CML", "M", "D")],
                                 "tissue string, sex string, symbol string")
    assert sorted(r.symbol for r in gene_set(sets, "AML", "M").collect()) == ["A", "C"]
    assert sorted(r.symbol for r in gene_set(sets, "AML", "unknown").collect()) == ["A", "B", "C"]
    rows = spark.createDataFrame([("PASS", "0/1", "A"), ("LowQual", "0/1", "B"), ("PASS", "./.", None)],
                                 "FILTER string, GT string, g string")
    assert [r.g for r in pass_filter(rows, gt_col="GT").collect()] == ["A"]
    assert [r.g for r in keep_in_set(rows, sets.select("symbol"), gene="g").collect()] == ["A", "B"]
    df, obs = observed(rows, "stage", null_cols=["g"])
    df.write.format("noop").mode("overwrite").save()
    assert obs.get == {"rows": 3, "null_g": 1}
    m = counts_map(rows, "FILTER").collect()[0][0]
    assert m == {"PASS": 2, "LowQual": 1}
    out = os.path.join(tmp_path, "summary")
    write_summary(counts_map(rows, "FILTER"), out)
    assert "PASS" in spark.read.option("header", True).csv(out).collect()[0][0]


def test_y_branch(spark):
    from varpair.plans.pair_job import y_branch

    peps = spark.createDataFrame(
        [("G1", "KLMNOPQR", "p1"), ("G2", "ZZZZZZZZ", "p2"), ("G3", "ABCDEFGH", "p3"), ("G4", "SHORT", "p4")],
        "gene string, pep string, pep_id string")
    host = spark.createDataFrame([("G9", "xxKLMNOPQRyy"), ("UTY", "ABCDEFGHxx")], "gene string, seq string")
    donor = spark.createDataFrame([("D1", "qqZZZZZZZZ")], "gene string, seq string")
    nine = spark.createDataFrame([("UTY",)], "gene string")
    scores = spark.createDataFrame([("ABCDEFGH", "HLA-A", 0.1), ("ABCDEFGH", "HLA-B", 0.9)], "pep string, allele string, rank double")
    out = y_branch(peps, host, donor, nine, scores).collect()
    assert [(r.pep, r.allele) for r in out] == [("ABCDEFGH", "HLA-A")]


def test_y_rows_filters(spark):
    from varpair.operators.annotations import called, on_chromosomes

    df = spark.createDataFrame([("chrY", "0/1"), ("Y", "0/0"), ("chr1", "1/1"), ("chrY", None)], "CHROM string, GT string")
    assert [tuple(r) for r in called(on_chromosomes(df), "GT").collect()] == [("chrY", "0/1")]


def test_rowwise_on_stream(spark, tmp_path):
    from varpair.functions import genotype as G
    from varpair.operators.annotations import annotation_filters

    src = os.path.join(tmp_path, "calls")
    spark.createDataFrame(
        [("0/1", "0/0", "MISSENSE", "SNP", "p.A2V"), ("1/1", "1/1", "MISSENSE", "SNP", "p.A3V"),
         ("0/0", "1/1", None, "DEL", "p.K4del"), ("0/1", "0/0", "SILENT", "SNP", "p.A5A")],
        "h string, d string, variantClassification string, variantType string, proteinChange string",
    ).write.parquet(src)
    schema = spark.read.parquet(src).schema
    stream = spark.readStream.schema(schema).parquet(src)
    out = annotation_filters(stream).filter(G.is_discordant("h", "d")).select(
        "proteinChange", G.foreign_allele("h", "d").alias("allele"))
    q = out.writeStream.format("memory").queryName("rowwise_stream").outputMode("append").start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    got = sorted(tuple(r) for r in spark.sql("SELECT * FROM rowwise_stream").collect())
    assert got == [("p.A2V", "1"), ("p.K4del", "0")]


def test_scorer_split_by_length(spark, tmp_path):
    from varpair.operators.scores import scorer_list, with_length

    df = spark.createDataFrame([("ABCDEFGH", "ABCDEFGX", "t1"), ("ABCDEFGHI", "ABCDEFGHX", "t2")],
                               "pep string, ref_pep string, transid string")
    out = os.path.join(tmp_path, "scorer")
    write_tsv(with_length(scorer_list(df, "transid")), out, partition_by=["len"])
    assert sorted(d for d in os.listdir(out) if d.startswith("len=")) == ["len=8", "len=9"]
    back = spark.read.option("sep", "\t").option("header", True).csv(out)
    assert back.count() == 4
