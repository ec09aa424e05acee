"""K-mer containment and the filtered anti join against brute force, also with several filter maps and long texts."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from varpair.operators import kmers, membership
from varpair.operators.intervals import points_in_regions
from varpair.operators.records import ordered_records


def texts(n, seed, alphabet="abcé漢🎉"):
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) for _ in range(rng.choice((0, 3, 8, 11, 40, 150)))) for _ in range(n)]


def test_window_hashes_follow_the_letters_alone():
    rows = ["abcdefghijkl", "xabcdefgh", "abcdefgh", ""]
    by = {size: h for size, h in membership.window_hashes(membership.letters(rows), [3, 8], 12)}
    assert by[8][0, 0] == by[8][1, 1] == by[8][2, 0] and by[8][0, 1] != by[8][0, 0]
    assert by[3][2, 5] == by[8][2, 5]  # both windows hold "fgh"
    assert membership.minimizers(membership.letters(["zzabcdeq", "abcdeqqq"]), 5, 4)[0, 2] == membership.minimizers(membership.letters(["abcdeqqq"]), 5, 1)[0, 0]


def test_layout_grows_with_the_count_and_splits():
    assert membership.layout(0) == (membership.MIN_BITS, 1)
    bits, ranges = membership.layout(10**6)
    assert bits >= 12 * 10**6 and ranges == 1
    bits, ranges = membership.layout(10**9)
    assert bits == membership.MAX_BITS and bits * ranges >= 12 * 10**9


@pytest.fixture(params=[None, 1 << 16])
def bound(request, monkeypatch):
    """Filters of one map, and filters split into hash ranges."""
    if request.param:
        monkeypatch.setattr(membership, "MAX_BITS", request.param)
        monkeypatch.setattr(membership, "BITS_PER_KEY", 3000)
    return request.param


def test_occurring_equals_brute_force(spark, bound):
    corpus = [(f"g{i % 3}" if i % 7 else None, t) for i, t in enumerate(texts(60, 1))] + [("g0", None), ("g9", texts(1, 3)[0] * 3), ("hot", "a" * 3000)] * 2
    peps = [t[a : a + n] for _, t in corpus if t for a in (0, 2, 30) for n in (8, 9, 11, 12)] + texts(200, 2) + [None, "", "aaaaaaaa", "abc"]
    p = spark.createDataFrame([(x, 1) for x in peps], "pep string, _text int")
    c = spark.createDataFrame(corpus, "gene string, seq string").repartition(3)
    lengths = [8, 9, 11]
    if bound:
        assert membership.layout(len({x for x in peps if x and len(x) in lengths}))[1] > 1
    want = {(g, x) for g, t in corpus for x in peps if t and x and len(x) in lengths and x in t}
    got = [tuple(r) for r in kmers.occurring(p, c, keep=["gene"], lengths=lengths).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    left = kmers.absent_in(p, c, lengths=lengths)
    assert sorted(str(r["pep"]) for r in left.collect()) == sorted(str(x) for x in peps if x is None or not any(x == y for _, y in want))
    assert kmers.occurring(p.limit(0), c, keep=["gene"]).count() == 0 and kmers.occurring(p, c.limit(0)).count() == 0


def test_long_texts_are_cut_with_overlap():
    import pyarrow as pa

    text = texts(1, 5, "ab")[0] + "".join(random.Random(1).choice("abcd") for _ in range(1000))
    column = pa.array([text, None, "", "abcdefgh"])
    seen = [(rows[i], piece[s : s + 8]) for rows, firsts, pieces in kmers._pieces(column, 8, size=64) for i, piece in enumerate(pieces) for s in range(firsts[i]) if len(piece[s : s + 8]) == 8]
    assert seen == [(0, text[s : s + 8]) for s in range(len(text) - 7)] + [(3, "abcdefgh")]


def chopped(rows, lo=8, hi=11):
    out = set()
    for k, m, r in rows:
        if m is None or r is None:
            continue
        m, r = m.replace("*", ""), r.replace("*", "")
        pos = 10
        if len(m) < 21:
            pos = next((i for i, (x, y) in enumerate(zip(m, r)) if x != y), 10)
        for size in range(lo, hi + 1):
            for at in range(max(pos - size + 1, 0), max(len(m), len(r)) - size + 1):
                out.add((k, m[at : at + size], r[at : at + size], at, pos - size, size, pos + 1))
    refs = {x[2] for x in out}
    return {x for x in out if x[1] not in refs}


def test_chop_without_reference_windows_equals_brute_force(spark, bound):
    rng = random.Random(4)
    refs = texts(40, 6, "abc*")
    rows = [(i, "".join(rng.choice("abcd") if rng.random() < 0.1 else c for c in t)[: rng.choice((5, 30, 200))], t) for i, t in enumerate(refs)]
    rows += [(50, "ab" * 60, "ba" * 55), (51, "shorter", "a longer reference text"), (52, None, "x"), (53, "x" * 20, None), (54, "", "abcdefghij"), (0, *rows[0][1:])]
    df = spark.createDataFrame(rows, "k int, host_sequence string, donor_sequence string").repartition(3)
    got = [tuple(r) for r in kmers.chop(df, keep=["k"]).collect()]
    assert set(got) == chopped(rows) and len(got) == len(set(got))
    assert kmers.chop(df.limit(0), keep=["k"]).count() == 0


def test_cleared_windows_cross_no_exchange(spark):
    rows = [(i, t, t[::-1]) for i, t in enumerate(texts(30, 8, "abcdefghijklmnop"))]
    out = kmers.chop(spark.createDataFrame(rows, "k int, host_sequence string, donor_sequence string"), keep=["k"])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftAnti") <= 1 and plan.count("Generate explode") >= 1
    if "Union" in plan:
        cleared = plan[plan.index("Union") :].split("Join LeftAnti")[0]
        assert "Repartition" not in cleared


def test_sweep_over_wide_and_crowded_regions(spark):
    rng = random.Random(7)
    regions = [("a", 0, 10**10), ("b", 5, 6), ("b", 9, 9), ("b", 12, 3), (None, 0, 9), ("c", None, 9)] + [("d", 1000 + i, 1500 + rng.randrange(3000)) for i in range(3000)]
    points = [("a", -1), ("a", 0), ("a", 10**10 - 1), ("a", 10**10), (None, 3), ("b", None), ("z", 1), ("c", 3)] + [("b", x) for x in range(14)] * 2 + [("d", rng.randrange(500, 6000)) for _ in range(2000)] + [("d", 1200)] * 500
    p = spark.createDataFrame([(c, x, i, "x") for i, (c, x) in enumerate(points)], "chrom string, pos long, i int, _reach string").repartition(4)
    r = spark.createDataFrame(regions, "chrom string, start long, end long").repartition(3)
    want = [i for i, (c, x) in enumerate(points) if c and x is not None and any(q == c and s is not None and s <= x < e for q, s, e in regions)]
    found = points_in_regions(p, r)
    assert found.columns == p.columns and sorted(row["i"] for row in found.collect()) == want
    assert points_in_regions(p, r.limit(0)).count() == 0 and points_in_regions(p.limit(0), r).count() == 0


def test_positions_come_from_one_shuffle(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("k"), F.lit("payload").alias("_pid2")).repartition(4)
    out = ordered_records(df, ["k"])
    assert [r["position"] for r in out.orderBy("k").collect()] == list(range(1, 5001))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "Window" in plan
    assert ordered_records(df.limit(0), ["k"]).count() == 0


def test_probe_has_no_false_negative():
    class Shipped:
        value = np.zeros(membership.MIN_BITS // 8, dtype=np.uint8)

    hashes = np.random.default_rng(1).integers(0, 2**63, 2000, dtype=np.uint64)
    slot = membership._slots(hashes, membership.MIN_BITS)
    np.bitwise_or.at(Shipped.value, slot >> 3, np.left_shift(1, slot & 7).astype(np.uint8))
    assert membership.RangeMap(membership.MIN_BITS, 1, 0, Shipped).probe(hashes).all()
    parts = [membership.RangeMap(membership.MIN_BITS, 3, r, Shipped).probe(hashes) for r in range(3)]
    assert (sum(p.astype(int) for p in parts) == 1).all()
