"""Stored score layout, chunked peptide ids and mergeable distinct counts."""

import pytest
from pyspark.sql import functions as F

from varpair.operators.score_store import groups_of_chunks, id_chunks, store_scores
from varpair.operators.scores import attach_binders, best_allele, peptide_groups, wide_scores
from varpair.operators.summary import distinct_counts, distinct_sketches, merge_sketches
from varpair.sinks.bucketed import drop_bucketed, write_bucketed


def rows(df, *cols):
    return sorted(map(str, df.select(*(cols or df.columns)).collect()))


@pytest.fixture(scope="module")
def scores(spark):
    made = [(f"P{i % 7}", f"A{i % 3}", (i % 5) / 5 if i % 11 else None) for i in range(90)]
    made += [("HOT", f"A{i % 3}", 0.1) for i in range(60)] + [(None, "A0", 0.2), ("P0", None, 0.3), ("NONE", "A1", None)]
    return spark.createDataFrame(made, "pep string, allele string, rank double")


def exchanges(df):
    """Exchange nodes of the physical plan."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if line.lstrip(" :+-|").startswith("Exchange")]


def test_stored_scores(spark, scores):
    stored = store_scores(scores)
    assert rows(best_allele(stored)) == rows(best_allele(scores))
    alleles = ["A0", "A1", "A2"]
    assert rows(wide_scores(stored, alleles)) == rows(wide_scores(scores, alleles))
    peps = spark.createDataFrame([("P1", 1), ("P1", 2), ("HOT", 3), (None, 4), ("absent", 5)], "pep string, id int")
    assert rows(attach_binders(peps, stored)) == rows(attach_binders(peps, scores.distinct()))
    assert not exchanges(best_allele(stored)) and not exchanges(wide_scores(stored, alleles))
    assert len(exchanges(attach_binders(peps, stored).hint("merge"))) == 1  # the peptides only
    empty = store_scores(scores.limit(0))
    assert best_allele(empty).count() == 0


def test_failed_write_leaves_no_table(spark, scores):
    bad = scores.withColumn("rank", F.raise_error(F.lit("no")).cast("double"))
    with pytest.raises(Exception, match="no"):
        write_bucketed(bad, "bad_scores", ["pep"])
    assert not spark.catalog.tableExists("bad_scores")
    assert write_bucketed(scores, "bad_scores", ["pep"]).count() == scores.count()
    drop_bucketed(spark, "bad_scores")
    assert not spark.catalog.tableExists("bad_scores")


def test_id_chunks(spark):
    hot = spark.range(30_000).selectExpr("'HOT' AS pep", "concat('T', id) AS transid")
    rest = spark.createDataFrame([("A", "T1"), ("A", "T1"), ("A", None), ("B", None), (None, "T2"), (None, "T3"), ("Z", "")], "pep string, transid string")
    df = hot.unionByName(rest).unionByName(rest)
    chunks = id_chunks(df, size=999)
    sizes = chunks.agg(F.max(F.size("transid")), F.sum("n"), F.count_if(F.col("n") != F.size("transid"))).first()
    assert tuple(sizes) == (999, 30_004, 0)
    assert chunks.filter("pep = 'HOT'").count() >= 31
    assert rows(groups_of_chunks(chunks)) == rows(peptide_groups(df))
    assert id_chunks(df.limit(0)).count() == 0


def test_sketches_merge(spark):
    df = spark.range(60_000).selectExpr("id % 20000 AS a", "CASE WHEN id % 3 > 0 THEN cast(id % 700 AS string) END AS b")
    halves = [df.filter(F.col("a") % 2 == i) for i in (0, 1)]
    sketches = [distinct_sketches(h, ["a", "b"], [("a", "b")]) for h in halves]
    exact = distinct_counts(df, ["a", "b"], [("a", "b")]).first()
    merged = merge_sketches(sketches[0].unionByName(sketches[1]))
    got = {r["metric"]: r["value"] for r in merged.collect()}
    assert set(got) == {"n_a", "n_b", "n_a_b"}
    assert all(abs(v - exact[m]) <= 3 * 1.04 / 64 * exact[m] for m, v in got.items())
    again = merge_sketches(merged.select("metric", "sketch").unionByName(sketches[0]))
    assert {r["metric"]: r["value"] for r in again.collect()} == got
    assert {r["value"] for r in merge_sketches(distinct_sketches(df.limit(0), ["a"])).collect()} == {0}
