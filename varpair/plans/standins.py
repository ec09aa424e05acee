"""Stand-in inputs built from the driver's test tables.

The test tables are not biological.  Each stand-in only reshapes one test
table into the schema an operator expects (sites, genotypes, transcripts,
sequences, scores, ...); it does none of the operator's work.  Every stand-in
is one projection (plus at most a row predicate) written as SQL expression
text that Spark and DuckDB evaluate identically (``md5``/``translate`` give
the same strings in both), so the oracle SQL can rebuild the very same input
as a CTE.  Sizes grow with the tables: no row caps, no id subsets.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


def nuc(key: str, salt: str) -> str:
    """32 nucleotides derived from a key (identical in Spark and DuckDB)."""
    return f"translate(md5(concat(cast({key} as string), '{salt}')), '0123456789abcdef', 'ACGTACGTACGTACGT')"


def amino(key: str, salt: str) -> str:
    """32 amino-acid letters derived from a key."""
    return f"translate(md5(concat(cast({key} as string), '{salt}')), '0123456789abcdef', 'ACDEFGHIKLMNPQRS')"


def pick(expr: str, values: list[str | None]) -> str:
    """CASE mapping ``expr`` (0..n-1) onto ``values`` (NULL allowed)."""
    parts = " ".join(
        f"WHEN {i} THEN {'NULL' if v is None else repr(v)}" for i, v in enumerate(values)
    )
    return f"CASE {expr} {parts} END"


GTS = ["0/1", "1/1", "0/1", "1/2", "0/0"]


@dataclass(frozen=True)
class StandIn:
    name: str
    table: str
    columns: dict[str, str]
    where: str | None = None
    pre: dict[str, str] = field(default_factory=dict, compare=False)

    def select_list(self) -> str:
        return ", ".join(f"{expr} AS {col}" for col, expr in self.columns.items())

    def sql(self) -> str:
        w = f" WHERE {self.where}" if self.where else ""
        src = self.table
        if self.pre:
            inner = ", ".join(f"{expr} AS {col}" for col, expr in self.pre.items())
            src = f"(SELECT *, {inner} FROM {self.table}{w}) AS src"
            w = ""
        return f"SELECT {self.select_list()} FROM {src}{w}"

    def cte(self) -> str:
        return f"{self.name} AS ({self.sql()})"

    def df(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        base = scan(spark, f"{sf_dir.rstrip('/')}/{self.table}.parquet")
        if self.where:
            base = base.filter(self.where)
        if self.pre:
            base = base.selectExpr("*", *[f"{expr} AS {col}" for col, expr in self.pre.items()])
        return base.selectExpr(*[f"{expr} AS {col}" for col, expr in self.columns.items()])


def scan(spark: SparkSession, path: str) -> DataFrame:
    """Parquet scan spread over at least the cluster's parallelism.

    The test tables are single files with one row group each, which Spark
    reads in one task; the per-row stand-in expressions (md5 chains) would
    then run single-threaded.  Only when the scan has fewer splits than the
    cluster has cores is it spread round-robin (a cheap, deterministic
    shuffle); a real multi-file input is left as it is.
    """
    df = spark.read.parquet(path)
    want = spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < want:
        df = df.repartition(want)
    return df


def with_ctes(*items: StandIn) -> str:
    return "WITH " + ",\n".join(s.cte() for s in items)


# --- variant sites of two samples (from lineitem) --------------------------
_SITE = {
    "CHROM": "concat('chr', cast(l_partkey % 22 + 1 as string))",
    "POS": "l_orderkey * 8 + l_linenumber",
    "REF": f"CASE WHEN l_suppkey % 11 = 0 THEN NULL ELSE substr({nuc('l_orderkey * 8 + l_linenumber', 'r')}, 1, 1) END",
    "ALT": f"substr({nuc('l_orderkey * 8 + l_linenumber', 'a')}, 1, 2)",
    "variantClassification": pick(
        "l_linenumber % 7",
        ["MISSENSE", "SILENT", "NONSENSE", "MISSENSE", "FRAME_SHIFT_DEL", None, "FRAME_SHIFT_INS"],
    ),
}

HOST_CALLS = StandIn(
    "host_calls",
    "lineitem",
    {**_SITE, "host": f"concat({pick('(l_orderkey + l_linenumber) % 5', GTS)}, ':', cast(l_linenumber as string))"},
    where="l_orderkey % 3 <> 0",
)
DONOR_CALLS = StandIn(
    "donor_calls",
    "lineitem",
    {**_SITE, "donor": f"concat({pick('(l_partkey + l_suppkey) % 5', GTS)}, ':', cast(l_linenumber as string))"},
    where="l_orderkey % 3 <> 1",
)
SITE_KEYS = list(_SITE)


# --- transcripts (from part) -----------------------------------------------
def mrna_of(key: str) -> str:
    return f"concat({nuc(key, 'a')}, {nuc(key, 'b')}, {nuc(key, 'c')})"


TRANSCRIPTS = StandIn(
    "transcripts",
    "part",
    {
        "gene": "p_brand",
        "ensembl_gene": "concat('G', cast(p_size as string))",
        "ensembl_transcript": "concat('T', cast(p_partkey as string))",
        "mrna": f"CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE {mrna_of('p_partkey')} END",
        "refProtein": amino("p_partkey", "p"),
    },
)

# --- changes of one sample on transcripts (from lineitem) -------------------
_VT = pick("l_linenumber % 4", ["SNP", "SNP", "INS", "DEL"])
CHANGES = StandIn(
    "changes",
    "lineitem",
    pre={
        "vt": _VT,
        "ms": "l_suppkey % 60 + 1",
        "rp": amino("l_partkey", "p"),
        "mr": mrna_of("l_partkey"),
    },
    columns={
        "annotationTranscript": "concat('T', cast(l_partkey as string))",
        "POS": "l_orderkey * 8 + l_linenumber",
        # the table holds the changes of 29 samples S0..S28
        "sample": "concat('S', cast((l_orderkey * 8 + l_linenumber) % 29 as string))",
        "variantType": "vt",
        "variantClassification": "CASE WHEN vt = 'SNP' THEN "
        + pick("l_orderkey % 5", ["MISSENSE", "MISSENSE", "NONSENSE", "MISSENSE", "SILENT"])
        + " WHEN vt = 'INS' AND l_orderkey % 4 = 0 THEN 'FRAME_SHIFT_INS' WHEN vt = 'INS' THEN 'IN_FRAME_INS'"
        " WHEN l_orderkey % 4 = 0 THEN 'FRAME_SHIFT_DEL' ELSE 'IN_FRAME_DEL' END",
        "GT": pick("(l_orderkey + l_linenumber) % 3", ["0/1", "1/1", "1/2"]),
        "mutstart": "ms",
        "mutend": "CASE WHEN vt = 'SNP' THEN ms WHEN vt = 'INS' THEN ms + 1 ELSE ms + l_linenumber % 3 END",
        "mutref": "CASE WHEN vt = 'SNP' THEN substr(mr, ms, 1) WHEN vt = 'DEL' THEN substr(mr, ms, l_linenumber % 3 + 1) ELSE '' END",
        "mutalt": f"CASE WHEN vt = 'SNP' THEN substr({nuc('l_orderkey', 's')}, 1, 1)"
        f" WHEN vt = 'INS' THEN substr({nuc('l_orderkey', 'i')}, 1, l_linenumber % 3 + 1) ELSE '' END",
        "protstart": "CAST(floor((ms + 2) / 3.0) AS INT)",
        "protend": "CAST(floor((ms + 2) / 3.0) AS INT) + CASE WHEN vt = 'INS' AND l_linenumber % 2 = 0 THEN 1 ELSE 0 END",
        "protref": "CASE WHEN vt = 'INS' THEN '' ELSE substr(rp, CAST(floor((ms + 2) / 3.0) AS INT), 1) END",
        "protalt": f"CASE WHEN vt = 'DEL' THEN '' WHEN vt = 'INS' THEN substr({amino('l_orderkey', 'x')}, 1, l_linenumber % 2 + 1)"
        f" ELSE substr({amino('l_orderkey', 'x')}, 1, 1) END",
        "proteinChange": "concat('p.', CASE WHEN vt = 'INS' THEN '' ELSE substr(rp, CAST(floor((ms + 2) / 3.0) AS INT), 1) END,"
        " cast(CAST(floor((ms + 2) / 3.0) AS INT) as string), CASE WHEN l_orderkey % 4 = 0 AND vt <> 'SNP' THEN 'fs' ELSE '' END)",
        "mrna": "mr",
        "refProtein": "rp",
        "protmut1": f"concat({amino('l_partkey', 'p1')}, {amino('l_partkey', 'q1')})",
        "protmut2": f"concat({amino('l_partkey', 'p2')}, {amino('l_partkey', 'q2')})",
        "hetsite": "(l_orderkey + l_linenumber) % 3 = 2",
    },
)

# --- sequences / proteomes / peptides from text tables -----------------------
DOC_SEQS = StandIn(
    "doc_seqs",
    "documents",
    {"doc_id": "doc_id", "mut": "text", "ref": "translate(text, 'aeiou', 'eioua')"},
)
BENCH_ITEMS = StandIn(
    "bench_items",
    "benchmark",
    {"item_id": "item_id", "gene": "concat('src', cast(item_id % 20 as string))", "text": "text"},
)
DONOR_PROTEOME = StandIn(
    "donor_proteome", "documents", {"doc_id": "doc_id", "gene": "source", "seq": "text"}, where="lang = 'en'"
)
HOST_PROTEOME = StandIn(
    "host_proteome", "documents", {"doc_id": "doc_id", "gene": "source", "seq": "text"}, where="coalesce(lang <> 'en', true)"
)

# --- alignment hits (15-column search output) from lineitem ------------------
HITS = StandIn(
    "hits",
    "lineitem",
    pre={"pl": "8 + l_linenumber % 4"},
    columns={
        "protein_id": "concat('G', cast(l_suppkey % 50 as string), '|T', cast(l_suppkey as string))",
        "peptide_id": "concat('Y', cast(l_partkey % 9 as string), ':T', cast(l_partkey as string), ':',"
        " cast(l_linenumber as string), '_', cast(l_linenumber + 7 + l_linenumber % 4 as string))",
        "protein_len": "CAST(300 + l_suppkey % 100 AS INT)",
        "peptide_len": "CAST(pl AS INT)",
        "protein_start": "CAST(l_suppkey % 250 + 1 AS INT)",
        "protein_end": "CAST(l_suppkey % 250 + pl AS INT)",
        "peptide_start": "CAST(1 AS INT)",
        "peptide_end": "CAST(pl AS INT)",
        "protein_seq": f"substr({amino('l_suppkey', 'z')}, 1, pl)",
        "peptide_seq": f"substr({amino('l_partkey', 'y')}, l_linenumber, pl)",
        "evalue": "l_discount",
        "score": "l_quantity",
        "alignment_length": "CAST(pl - CASE WHEN l_orderkey % 3 = 0 THEN 1 ELSE 0 END AS INT)",
        "p_ident": "CASE WHEN l_orderkey % 5 = 0 THEN 88.9 ELSE 100.0 END",
        "n_ident": "CAST(pl - CASE WHEN l_orderkey % 5 = 0 THEN 1 ELSE 0 END AS INT)",
    },
)

# --- peptide table with host/donor peptides and ids (from lineitem) ----------
PEPTIDE_ROWS = StandIn(
    "peptide_rows",
    "lineitem",
    pre={"pl": "8 + l_suppkey % 4"},
    columns={
        "pep": f"substr({amino('l_partkey', 'h')}, l_linenumber, pl)",
        "ref_pep": f"substr({amino('l_partkey', 'd')}, l_linenumber, pl)",
        "transid": "concat('B', cast(l_partkey % 40 as string), ':T', cast(l_partkey as string), ':',"
        " cast(l_linenumber as string), '_', cast(l_linenumber + pl - 1 as string))",
        "CHROM": "concat('chr', cast(l_partkey % 24 + 1 as string))",
    },
)

# --- binding scores (peptide x allele) from lineitem -------------------------
ALLELES = ["HLA-A0101", "HLA-A0201", "HLA-B0702", "HLA-B0801", "HLA-C0401", "HLA-C0701"]
SCORES = StandIn(
    "scores",
    "lineitem",
    pre={"pl": "8 + l_suppkey % 4"},
    columns={
        "pep": f"substr({amino('l_partkey', 'h')}, l_linenumber, pl)",
        "transid": "concat('B', cast(l_partkey % 40 as string), ':T', cast(l_partkey as string), ':',"
        " cast(l_linenumber as string), '_', cast(l_linenumber + pl - 1 as string))",
        "len": "CAST(pl AS INT)",
        "allele": pick("(l_orderkey + l_suppkey) % 6", ALLELES),
        "rank": "CAST(l_orderkey % 997 AS DOUBLE) / 400.0",
    },
)
