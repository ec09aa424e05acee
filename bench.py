"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is run to completion with the ``noop`` sink (full computation, no
collect to the driver).  One untimed warm-up of the JVM, then ``BENCH_RUNS``
timed runs per query (median reported).  Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "discordance",
    "pair_full_outer",
    "strand_assign",
    "splice_edits",
    "context_window",
    "annotation_explode",
    "kmer_recognised",
    "kmer_absent",
    "interval_merge",
    "interval_semi",
    "best_allele",
    "peptide_groups",
    "index_shift",
    "mark_duplicates",
    "ordered_records",
    "binder_join",
    "pair_windows",
    "custom_proteome",
    "y_removal",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]

    from varpair.plans.registry import QUERIES, load_all
    from varpair.session import local_session

    load_all()
    spark = local_session(cpus=cpus, app="varpair-bench", shuffle_partitions=max(8, int(cpus) * 4))
    # warm the JVM once (codegen, class loading) on a small query
    QUERIES["distinct_counts"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    timings: dict[str, float] = {}
    for name in names:
        samples = []
        for _ in range(runs):
            # each query pays for its own persisted intermediates
            spark.catalog.clearCache()
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            samples.append(time.perf_counter() - t0)
        timings[name] = round(statistics.median(samples), 3)
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": int(cpus),
        "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
