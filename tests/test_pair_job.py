"""End-to-end two-sample job on generated VCF and reference files."""

import gzip
import os

from varpair.operators.annotations import KEPT_FIELDS
from varpair.plans import pair_job
from varpair.sources.readers import annotation_field_names, read_reference, read_vcf

MRNA = "ATGGCTAAACCCGGGTTTGAACTGCATAAAGATTGGTAA"  # M A K P G F E L H K D W *
PROT = "MAKPGFELHKDW*"


def _ann(**kw):
    return "|".join(kw.get(f, "") for f in KEPT_FIELDS)


def _vcf(path, sample_rows):
    header = [
        "##fileformat=VCFv4.2",
        '##INFO=<ID=FUNCOTATION,Number=A,Type=String,Description="Functional annotation: '
        + "|".join("Gencode_19_" + f for f in KEPT_FIELDS) + '">',
        "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tS",
    ]
    body = [f"{(chrom or ['chr1'])[0]}\t{pos}\t.\t{ref}\t{alt}\t50\tPASS\tFUNCOTATION=[{ann}]\tGT\t{gt}" for pos, ref, alt, ann, gt, *chrom in sample_rows]
    with open(path, "wb") as f:
        f.write(gzip.compress(("\n".join(header + body) + "\n").encode()))


def test_pair_job(spark, tmp_path):
    a1 = _ann(hugoSymbol="GENE1", variantClassification="MISSENSE", variantType="SNP", tumorSeqAllele2="A",
              annotationTranscript="T1", cDnaChange="c.5C>A", proteinChange="p.A2D")
    a2 = _ann(hugoSymbol="GENE1", variantClassification="MISSENSE", variantType="SNP", tumorSeqAllele2="T",
              annotationTranscript="T1", cDnaChange="c.10C>T", proteinChange="p.P4S")
    host_p, donor_p = os.path.join(tmp_path, "host.vcf.gz"), os.path.join(tmp_path, "donor.vcf.gz")
    _vcf(host_p, [(105, "C", "A", a1, "0/1")])
    _vcf(donor_p, [(110, "C", "T", a2, "1/1")])
    ref_p = os.path.join(tmp_path, "ref.tsv")
    with open(ref_p, "w") as f:
        f.write("gene\tensembl_gene\tensembl_transcript\tmrna\trefProtein\n")
        f.write(f"GENE1\tG1\tT1\t{MRNA}\t{PROT}\nGENE2\tG2\tT2\t\tMK\n")
    ref = read_reference(spark, ref_p)
    tables = {}
    for s, p in (("host", host_p), ("donor", donor_p)):
        header, body = read_vcf(spark, p, s)
        ch = pair_job.sample_changes(body, annotation_field_names(header), ref, s)
        tables[s] = pair_job.sample_tables(ch, materialize=s if s == "host" else None)
    prot = {r.annotationTranscript: r for r in tables["host"].proteins.collect()}
    assert prot["T1"].protmut1 == "MDKPGFELHKDW*" and prot["T1"].protmut2 == PROT
    win = pair_job.pair_and_window(tables["host"], tables["donor"]).collect()
    by_change = {r.proteinChange: r for r in win}
    assert set(by_change) == {"p.A2D", "p.P4S"}
    assert by_change["p.A2D"].ALLELE == "1" and by_change["p.A2D"].host_sequence.startswith("MD")
    assert by_change["p.P4S"].ALLELE == "0"
    peps = pair_job.peptides(pair_job.pair_and_window(tables["host"], tables["donor"])).collect()
    assert peps and all(8 <= len(r.pep) <= 11 for r in peps)


def _pair_inputs(spark, tmp_path):
    """T1 changed by both samples, T2 by the host only, T3 by the donor only; one change that does not parse."""
    change = lambda t, c, p, alt, gene="GENE1", cls="MISSENSE": _ann(
        hugoSymbol=gene, variantClassification=cls, variantType="SNP", tumorSeqAllele2=alt, annotationTranscript=t, cDnaChange=c, proteinChange=p)
    host_p, donor_p = os.path.join(tmp_path, "h.vcf.gz"), os.path.join(tmp_path, "d.vcf.gz")
    _vcf(host_p, [(105, "C", "A", change("T1", "c.5C>A", "p.A2D", "A"), "0/1"), (205, "C", "A", change("T2", "c.5C>A", "p.A2D", "A", "GENE2"), "1/1"),
                  (305, "C", "A", change("T2", "c.5C>A", "strange", "A", "GENE2"), "1/1"), (405, "G", "A", change("T2", "c.8A>G", "p.K3*", "G", "GENE2", "NONSENSE"), "0/1")])
    _vcf(donor_p, [(110, "C", "T", change("T1", "c.10C>T", "p.P4S", "T"), "1/1"), (210, "C", "T", change("T3", "c.10C>T", "p.P4S", "T", "GENE3"), "1/1")])
    ref_p = os.path.join(tmp_path, "r.tsv")
    with open(ref_p, "w") as f:
        f.write("gene\tensembl_gene\tensembl_transcript\tmrna\trefProtein\n")
        for i, (gene, mrna) in enumerate([("GENE1", MRNA), ("GENE2", MRNA), ("GENE3", MRNA), ("USP9Y", MRNA), ("GENE5", "")], 1):
            f.write(f"{gene}\tG{i}\tT{i}\t{mrna}\t{PROT}\n")
    ref = read_reference(spark, ref_p)
    out = {"reference": ref}
    for s, p in (("host", host_p), ("donor", donor_p)):
        header, out[f"{s}_body"] = read_vcf(spark, p, s)
        out[f"{s}_fields"] = annotation_field_names(header)
    return out


def test_one_sample_transcripts_have_the_reference_protein(spark, tmp_path):
    t = _pair_inputs(spark, tmp_path)
    tables = {s: pair_job.sample_tables(pair_job.sample_changes(t[f"{s}_body"], t[f"{s}_fields"], t["reference"], s)) for s in ("host", "donor")}
    rows = {(r.annotationTranscript, r.proteinChange): r for r in pair_job.pair_and_window(tables["host"], tables["donor"]).collect()}
    assert set(rows) == {("T1", "p.A2D"), ("T1", "p.P4S"), ("T2", "p.A2D"), ("T3", "p.P4S")}
    only_host, only_donor = rows["T2", "p.A2D"], rows["T3", "p.P4S"]
    assert only_host.host_sequence.startswith("MDKP") and only_host.donor_sequence.startswith("MAKP")
    assert only_donor.host_sequence.startswith("MAKP") and only_donor.donor_sequence.startswith("MAKS") and only_donor.ALLELE == "0"
    peps = pair_job.peptides(pair_job.pair_and_window(tables["host"], tables["donor"])).collect()
    assert peps and all(r.pep is not None for r in peps)
    # self peptides of a transcript changed by one sample are not reported
    assert not any(r.annotationTranscript == "T2" and "D" not in r.pep for r in peps)


def test_run_pair_branches_and_summary(spark, tmp_path):
    from varpair.sources.params import RunParams

    t = _pair_inputs(spark, tmp_path)
    frame = lambda rows, schema: spark.createDataFrame(rows, schema)
    t |= {
        "classes": frame([("GENE2", "lung"), ("GENE9", "skin")], "gvhd_genes string, gvhd_classfication string"),
        "gene_sets": frame([("liver", "M", "GENE1"), ("liver", "F", "GENE2"), ("BLOOD", "M", "GENE3")], "tissue string, sex string, symbol string"),
        "tpm": frame([("GENE3", 40.0), ("GENE2", 5.0), ("GENE1", 1.0)], "Description string, TPM double"),
        "rna_low_M": frame([("GENE3",)], "Description string"), "rna_low_F": frame([("GENE2",)], "Description string"),
        "prot_low_M": frame([("GENE9",)], "hgnc_symbol string"), "prot_low_F": frame([("GENE2",)], "hgnc_symbol string"),
        "y_peptides": frame([("USP9Y", "MAKPGFEL", "Y1"), ("USP9Y", "WWWWWWWW", "Y2"), ("USP9Y", "SHORT", "Y3")], "gene string, pep string, pep_id string"),
    }
    out = pair_job.run_pair(RunParams("liver", "male", "female"), t)
    assert {r.hugoSymbol for r in out["gvhd_peptides"].collect()} == {"GENE2"}
    assert {r.hugoSymbol for r in out["tissue_peptides"].collect()} == {"GENE1", "GENE3"}  # liver set of men, and expressed > 32 with low RNA
    flags = {(r.hugoSymbol, r.liver, r.BLOOD, r.patient_exp) for r in out["tissue_peptides"].collect()}
    assert flags == {("GENE1", "yes", "no", "no"), ("GENE3", "no", "yes", "yes")}
    assert out["host_y"].count() == 0
    assert [r.pep_id for r in out["y_peptides"].collect()] == ["Y2"]  # the other is in both proteomes
    host = {r.annotationTranscript: (r.protmut1, r.protmut2) for r in out["host_proteome"].collect()}
    assert set(host) == {"T1", "T2", "T3", "T4"} and host["T3"] == (PROT, PROT) and host["T2"][0].startswith("MDKP")
    summary = {(r.stage, r.metric): r.value for r in out["summary"].collect()}
    assert summary["host", "variants"] == 3 and summary["host", "unparsed"] == 1 and summary["discordances", "variants"] == 4
    # both sexes' tables where the sex is unknown; nonsense changes on request
    t = {k: v for k, v in t.items() if k not in ("classes", "y_peptides")}
    out = pair_job.run_pair(RunParams("liver", None, None, keep_nonsense=True), t)
    assert "host_y" not in out and "gvhd_peptides" not in out
    summary = {(r.stage, r.metric): r.value for r in out["summary"].collect()}
    assert summary["tissue", "distinct_hugoSymbol"] == 3 and summary["host", "variants"] == 4


def test_score_branches_y_rows_repeated_names_and_files(spark, tmp_path):
    from varpair.sources.params import RunParams

    paths = {}
    change = lambda t, c, p, alt, gene: _ann(
        hugoSymbol=gene, variantClassification="MISSENSE", variantType="SNP", tumorSeqAllele2=alt, annotationTranscript=t, cDnaChange=c, proteinChange=p)
    for s, rows in (
        ("host", [(105, "C", "A", change("T1", "c.5C>A", "p.A2D", "A", "GENE1"), "0/1"), (205, "C", "A", change("T2", "c.5C>A", "p.A2D", "A", "GENE2"), "1/1"),
                  (905, "C", "A", change("T4", "c.5C>A", "p.A2D", "A", "USP9Y"), "1/1", "chrY"), (910, "C", "T", change("T4", "c.10C>T", "p.P4S", "T", "USP9Y"), "./.", "chrY")]),
        ("donor", [(110, "C", "T", change("T1", "c.10C>T", "p.P4S", "T", "GENE1"), "1/1")]),
    ):
        paths[f"{s}_vcf"] = os.path.join(tmp_path, f"{s}.vcf.gz")
        _vcf(paths[f"{s}_vcf"], rows)

    def table(name, *lines):
        paths[name] = os.path.join(tmp_path, f"{name}.tsv")
        with open(paths[name], "w") as f:
            f.write("\n".join("\t".join(x) for x in lines) + "\n")

    table("reference", ("gene", "ensembl_gene", "ensembl_transcript", "mrna", "refProtein"),
          *[(g, f"G{i}", f"T{i}", MRNA, PROT) for i, g in enumerate(("GENE1", "GENE2", "GENE3", "USP9Y"), 1)])
    table("classes", ("gvhd_genes", "gvhd_classfication"), ("GENE2", "lung"), ("GENE1", "lung,liver"))
    table("gene_sets", ("tissue", "sex", "symbol"), ("liver", "M", "GENE1"), ("liver", "M", "GENE2"), ("BLOOD", "M", "GENE2"))
    table("rna_low_M", ("gene",), ("GENE2",))
    table("prot_low_M", ("gene",), ("GENE2",))
    table("y_peptides", ("gene", "pep", "pep_id"), ("USP9Y", "MAKPGFEL", "Y1"), ("USP9Y", "WWWWWWWW", "Y2"), ("USP9Y", "VVVVVVVVV", "Y3"))
    # MDKPGFEL is a mutated peptide of GENE1 and GENE2: the host has it in another gene, so T4 removes it
    table("scores", ("pep", "allele", "rank"), ("WWWWWWWW", "A1", "0.2"), ("WWWWWWWW", "A2", "0.1"), ("VVVVVVVVV", "A1", "0.7"), ("MDKPGFEL", "A1", "0.1"), ("MDKPGFELH", "B1", "bad"))
    tpm = os.path.join(tmp_path, "tpm.gct")
    with open(tpm, "w") as f:
        f.write("#1.2\n3\t1\nName\tDescription\tTPM\nE2\tGENE2\t5\nE2b\tGENE2\t7\nE1\tGENE1\t1\n")

    params = RunParams("liver", "male", "female", tpm_path=tpm)
    tables = pair_job.load_tables(spark, params, paths)
    out = pair_job.run_pair(params, tables)
    y = {(r.hugoSymbol, r.proteinChange, r.CHROM) for r in out["host_y"].collect()}
    assert y == {("USP9Y", "p.A2D", "chrY")}
    assert {r.protmut1 for r in out["host_y"].collect()} == {"MDKPGFELHKDW*"}
    assert [(r.pep, r.gene, r.transid, r.best_rank, r.best_allele) for r in out["y_binders"].collect()] == [("WWWWWWWW", "USP9Y", "Y2", 0.1, "A2")]
    # the scores lie by peptide: no branch exchanges them again
    assert "Bucketed: true" in out["y_binders"]._jdf.queryExecution().executedPlan().toString()
    chunks = out["y_peptide_chunks"].collect()
    assert {(r.pep, r.transid, r.n) for r in chunks} == {("WWWWWWWW", "Y2", 1), ("VVVVVVVVV", "Y3", 1)}
    assert {(r.pep, r.transid, r.n_ids) for r in out["y_peptide_groups"].collect()} == {("WWWWWWWW", "Y2", 1), ("VVVVVVVVV", "Y3", 1)}
    row = out["y_binder_summary"].first()
    assert (row.peptides, row.gene_count, row.allele) == (1, {"USP9Y": 1}, {"A2": 1})
    assert {(r.pep, r.source, r.len) for r in out["y_scorer_list"].collect()} == {("WWWWWWWW", "host", 8), ("VVVVVVVVV", "host", 9)}
    # USP9Y, GENE1 and GENE2 share the changed protein: recognised in another gene
    assert out["tissue_binders"].count() == 0 and out["tissue_peptide_groups"].filter("pep = 'MDKPGFEL'").count() == 0
    assert out["tissue_binder_summary"].first().peptides == 0
    assert out["gvhd_classes"].first()["Genes expressed in lung"] == 1 and out["gvhd_classes"].first()["Genes expressed by 2 gvhd tissues"] == 1
    assert {(r.n_classes, r.n) for r in out["gvhd_class_sizes"].collect()} == {(1, 1), (2, 1)}
    summary = {(r.stage, r.metric): r.value for r in out["summary"].collect()}
    # GENE2 is twice in the expression table and still one variant
    assert summary["tissue", "variants"] == 3 and summary["host", "variants"] == 3 and summary["host", "unparsed"] == 0
    assert summary["tissue_peptides", "rows"] == out["tissue_peptides"].count() and summary["y_binders", "distinct_pep"] == 1
    wide = out["summary_row"].first()
    assert wide["tissue_variants"] == 3 and wide["y_binders_rows"] == 1
    lazy = pair_job.run_pair(params, tables, materialize=None)
    assert {(r.stage, r.metric): r.value for r in lazy["summary"].collect()} == summary
    assert "Bucketed: true" not in lazy["y_binders"]._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(str, lazy["gvhd_peptide_groups"].collect())) == sorted(map(str, out["gvhd_peptide_groups"].collect()))

    files = pair_job.write_run(out, params, os.path.join(tmp_path, "run"))
    assert len(files) == len(out) + 2 and all(os.path.isdir(f) for f in files)
    text = lambda name: [x for f in sorted(os.listdir(os.path.join(tmp_path, "run", name))) if f.startswith("part-") for x in open(os.path.join(tmp_path, "run", name, f)).read().splitlines()]
    assert text("y_peptides.fasta") == [">Y2", "WWWWWWWW", ">Y3", "VVVVVVVVV"] or sorted(text("y_peptides.fasta")) == sorted([">Y2", "WWWWWWWW", ">Y3", "VVVVVVVVV"])
    assert any(x.startswith(">USP9Y|") for x in text("host_proteome.fasta")) and not any("USP9Y" in x for x in text("host_proteome_without_y.fasta"))
    assert text("y_binders.tsv")[0].split("\t")[0] == "pep"


def test_cohort_of_three_with_a_hot_site(spark):
    from varpair.operators.pairing import pair_cohort, pair_samples

    rows = {"a": [("c", 1, "0/1", 5), (None, 2, "1/1", 6)], "b": [("c", 1, "1/2", 7), ("c", 3, "0/1", 8)], "c": [("c", 1, "0/0", 1)] * 2000 + [(None, 2, None, 2)]}
    frames = {s: spark.createDataFrame(r, "chrom string, pos int, GT string, depth int") for s, r in rows.items()}
    found = pair_cohort(frames, ["chrom", "pos"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    got = {(r.chrom, r.pos): (r.a_GT, r.a_depth, r.b_GT, r.b_depth, r.c_GT, r.c_depth) for r in found.collect()}
    assert got == {("c", 1): ("0/1", 5, "1/2", 7, "0/0", 1), (None, 2): ("1/1", 6, "0/0", None, "0/0", 2), ("c", 3): ("0/0", None, "0/1", 8, "0/0", None)}
    two = pair_samples(frames["a"], frames["b"], ["chrom", "pos"], "a_", "b_")
    pair = pair_cohort({s: frames[s] for s in "ab"}, ["chrom", "pos"])
    assert sorted(map(str, pair.select(*two.columns).collect())) == sorted(map(str, two.collect()))


def test_masks_of_many_sets(spark):
    from varpair.operators import genesets

    df = spark.createDataFrame([("g1",), ("g70",), (None,)], "hugoSymbol string")
    sets = {f"s{i}": spark.createDataFrame([(f"g{i}",), (f"g{i}",), (None,)], "gene string") for i in (0, 1, 2)}
    flags = {r.hugoSymbol: (r.s0, r.s1, r.s2) for r in genesets.flag_gene_sets(df, sets).collect()}
    assert flags == {"g1": ("no", "yes", "no"), "g70": ("no",) * 3, None: ("no",) * 3}
    plan = genesets.flag_gene_sets(df, sets)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1
    masks = {r.gene: r["mask"] for r in genesets.set_masks(sets).collect()}
    assert masks == {"g0": 1, "g1": 2, "g2": 4, None: 7}
