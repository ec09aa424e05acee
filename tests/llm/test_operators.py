"""Every corpus operator on small tables with nulls, empty and long texts, ties, repeated rows and odd columns."""

import collections
import hashlib
import random
import re
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from varpair.llm import arrays, exact, jaccard, langid, lines, packing, phrases, pieces, quality, recurring, suffixes, toxicity
from varpair.llm.components import components
from varpair.llm.queries import tokenizer_path
from varpair.sinks.bucketed import sorted_scans

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def _vocabulary(seed, n=400):
    rng = random.Random(seed)
    return ["".join(rng.choice("abcdefghijklmnoprstuvwé") for _ in range(rng.randint(2, 9))) for _ in range(n)]


def _texts():
    rng, words = random.Random(4), _vocabulary(1)
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage, line = prose(90), "A line That many Documents share"
    base = prose(260).split(" ")
    near = [" ".join(w if i != at else "changed" for i, w in enumerate(base)) for at in (20, 100, 200)]
    out = [None, "", "   \n\t ", "one", "two words", "ÀÉ straße İx", "x" * 3000, "spam " * 600]
    out += [prose(60) for _ in range(12)]
    out += [prose(30) + " " + passage + " " + prose(30), passage, prose(10) + "\n" + passage + "\n" + prose(200)]
    out += [f"{prose(20)}\n  {line}  \n{prose(20)}", f"{line.lower()}\n{prose(15)}\n{line.upper()}\n\n", line, f"{line}\r\n{line}"]
    out += [" ".join(base), " ".join(base).upper(), *near, prose(4000), "tab\tand\x0bfeed \x0c end\x1c\x85 　!", "<|endoftext|> <s> it's 12,5 ... \n\n  ok"]
    return out + out[8:11] + out[20:22]


TEXTS = _texts()


@pytest.fixture(scope="module")
def docs(spark):
    """Document ids in no order, a null id, a repeated row, and columns whose names the operators use inside."""
    ids = [(37 * i) % 1000 for i in range(len(TEXTS))]
    rows = [(ids[i], t, ["en", "fr", None][i % 3], ["a", None][i % 2], len(t or "")) for i, t in enumerate(TEXTS)]
    rows += [(None, TEXTS[9], "en", "a", 1), rows[12], rows[0]]
    df = spark.createDataFrame(rows, SCHEMA)
    return df.select("*", F.lit(1).alias("row"), F.lit("x").alias("text_key"), F.lit(2).alias("bucket"), F.lit(3).alias("_id"), F.lit(4).alias("_lang"), F.lit(5).alias("n_words")).repartition(5)


@pytest.fixture(scope="module")
def table(docs):
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words_of(text):
    return (text or "").encode().split()


def rows_of(df, *columns):
    return collections.Counter(tuple(r) for r in df.select(*columns).collect())


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def test_picks_match_brute_force():
    rng = np.random.default_rng(0)
    for _ in range(200):
        n, w = int(rng.integers(1, 60)), int(rng.integers(1, 12))
        v = rng.integers(0, 5, size=n).astype(np.uint64) * np.uint64(3 << 60) + np.uint64(1)
        want = {s: max(range(s, s + w), key=lambda p: (-int(v[p]), p)) for s in range(n - w + 1)}
        for share in (1.0, 0.25):
            p, a, b = arrays.picks(v, w, share)
            assert {s: int(q) for q, x, y in zip(p, a, b) for s in range(x, y + 1)} == want


def base_counts(text):
    words = words_of(text)
    wins = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    count = collections.Counter(wins)
    covered = {i + d for i, w in enumerate(wins) if count[w] > 1 for d in range(3)}
    seen, dup = set(), 0
    for x in (text or "").split("\n"):
        if words_of(x):
            dup += x in seen
            seen.add(x)
    return len(words), sum(len(w.decode()) for w in words), sum((text or "").count(c) for c in "#*$%&|<>"), dup, len(covered)


def test_quality(docs, table, empty):
    found = quality.quality_rules(docs, min_docs=5)
    want = collections.Counter((d, *base_counts(t)) for d, t in table)
    assert rows_of(found, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words") == want
    rows = found.collect()
    assert all(r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]) for r in rows)
    assert not any(r["kept"] and r["base_failed"] for r in rows)
    assert quality.quality_rules(empty).count() == 0


def test_quality_thresholds_follow_groups_and_merge(spark):
    words = _vocabulary(2)
    rng = random.Random(1)
    clean = [" ".join(rng.choice(words) for _ in range(80)) for _ in range(300)]
    odd = [" ".join(w + "###" for w in t.split()) for t in clean[:6]]
    df = spark.createDataFrame([(i, t, "en", "s") for i, t in enumerate(clean + odd)], "doc_id long, text string, lang string, source string")
    kept = {r["doc_id"]: r["kept"] for r in quality.quality_rules(df).collect()}
    assert all(kept[i] for i in range(300)) and not any(kept[i] for i in range(300, 306))
    rows = spark.createDataFrame([("en", "s", float(v)) for v in range(1, 1001)], "lang string, source string, symbol_share double").selectExpr("*", "0D dup_line_share", "0D repeat_share", "5D word_length")
    sketch = quality.sketches(rows)
    halves = quality.sketches(rows.filter("symbol_share <= 400")).union(quality.sketches(rows.filter("symbol_share > 400")))
    assert rows_of(quality.merged(halves, "lang", "source"), "rule", "bucket", "n") == rows_of(sketch, "rule", "bucket", "n")
    q = quality.quantiles(sketch, ["lang", "source"], {"q": 0.75}).filter("rule = 'symbol_share'").first()
    assert abs(q["q"] - 750) <= 0.02 * 750 and q["n_docs"] == 1000


def test_quality_rules_reject_outliers_below_the_base_limits(spark):
    """Every rule by itself, in a group where its values are rare; what is usual in a group is kept there."""
    rng, words = random.Random(7), [w for w in _vocabulary(8, 900) if len(w.encode()) == len(w)]
    some = lambda n, at=words: rng.sample(at, n)
    long, short = [w for w in words if len(w) >= 8], [w for w in words if len(w) <= 3]
    one_line = lambda w, dup: "\n".join(w[:60] + [x for i in range(dup) for x in (w[60 + i], w[7 * i])])
    signed = lambda w, every: " ".join(x + "##" * (i % every == 0) for i, x in enumerate(w))
    twice = some(12)
    odd = {
        "symbol_share": signed(some(80), 5),
        "dup_line_share": one_line(some(80), 4),
        "repeat_share": " ".join(some(30) + twice + some(26) + twice),
        "long": " ".join(rng.choice(long) for _ in range(90)),
        "short": " ".join(rng.choice(short) for _ in range(90)),
    }
    prose = [" ".join(some(80)) for _ in range(300)]
    fine = [one_line(some(80), 1), " ".join(some(70)) + " #"]
    code = [signed(some(80), rng.choice((4, 5, 6))) for _ in range(300)]
    texts = [*((t, "prose") for t in [*prose, *fine, *odd.values()]), *((t, "code") for t in code)]
    df = spark.createDataFrame([(i, t, "en", s) for i, (t, s) in enumerate(texts)], "doc_id long, text string, lang string, source string")
    rows = {r["doc_id"]: r for r in quality.quality_rules(df).collect()}
    assert not any(r["base_failed"] for r in rows.values())
    assert {k: rows[302 + i]["kept"] for i, k in enumerate(odd)} == dict.fromkeys(odd, False)
    assert rows[303]["dup_line_share"] == 4 / 68 and rows[303]["repeat_share"] == 0 == rows[302]["repeat_share"]
    assert all(r["kept"] for i, r in rows.items() if not 302 <= i < 307)


def brute_lines(table):
    holders = collections.defaultdict(set)
    key = lambda x: lower(x.strip(" \t\n\x0b\x0c\r"))
    number = lambda d: 2**63 - 1 if d is None else d
    for d, t in table:
        for x in (t or "").split("\n"):
            holders[key(x)].add(number(d))
    out = collections.Counter()
    for d, t in table:
        parts = (t or "").split("\n")
        kept = [x for x in parts if len(key(x)) < 10 or min(holders[key(x)]) == number(d)]
        out[(d, len(parts), len(parts) - len(kept), sha("\n".join(kept)))] += 1
    return out


@pytest.mark.parametrize("batches", [1, 4, 7])
def test_lines(docs, table, batches):
    found = lines.line_dedup(docs, batches=batches).select(F.when(F.col("doc_id") != 2**63 - 1, F.col("doc_id")).alias("doc_id"), "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("s"))
    assert rows_of(found, "doc_id", "n_lines", "n_dropped", "s") == brute_lines(table)


def test_line_runs_levels(spark, empty):
    runs = lines.LineRuns(spark, fan_out=2, buckets=3)
    for i in range(5):
        batch = spark.createDataFrame([(i * 10 + j, 0, 0, (i + j) % 6, 1) for j in range(4)], "doc_id long, text_key long, position int, h1 long, h2 long")
        runs.add(batch)
    assert [len(runs.levels.get(x, [])) for x in range(3)] == [1, 0, 1]
    held = [tuple(r) for t in runs.tables() for r in spark.table(t).collect()]
    assert sorted(h[:2] for h in held) == [(k, 1) for k in range(6)]
    assert {h[0]: h[2] for h in held} == {0: 0, 1: 1, 2: 2, 3: 3, 4: 13, 5: 23}
    assert set(lines.LineRuns(spark, runs.name, buckets=3).tables()) == set(runs.tables())
    runs.drop()
    assert not runs.tables() and lines.line_dedup(empty).count() == 0


def test_line_runs_are_merged_where_they_lie(spark):
    runs = lines.LineRuns(spark, fan_out=5)
    keys = lambda i: spark.range(400).selectExpr("id AS doc_id", "0L AS text_key", "0 AS position", f"id % {50 + i} AS h1", "id AS h2")
    for i in range(3):
        runs.add(keys(i))
    with sorted_scans(spark):
        plan = runs.merged(keys(9).groupBy("h1", "h2").agg(F.min("doc_id").alias("first")))._jdf.queryExecution().executedPlan().toString()
    shape = [line.lstrip(" :+-|").split(" ")[0] for line in plan.splitlines()]
    assert shape.count("Exchange") == 1 and shape.count("Sort") == 1 and shape.count("SortMergeJoin") == 3
    assert plan.count("Bucketed: true") == 3
    runs.drop()


def test_failed_batch_leaves_no_run(spark, docs, monkeypatch):
    before = {t.name for t in spark.catalog.listTables()}
    monkeypatch.setattr(lines.LineRuns, "compact", lambda self: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        lines.line_dedup(docs)
    assert {t.name for t in spark.catalog.listTables()} == before


def test_exact(docs, table, empty):
    groups = collections.defaultdict(list)
    for d, t in table:
        groups[lower(t)].append(2**63 - 1 if d is None else d)
    shown = lambda d: None if d == 2**63 - 1 else d
    for hot, salts in ((10**6, 4), (1, 3)):
        found = exact.exact_duplicates(docs, hot_copies=hot, salts=salts)
        want = collections.Counter((d, shown(max(groups[lower(t)])), len(groups[lower(t)]), sha(lower(t))) for d, t in table)
        assert rows_of(found, "doc_id", "keep_id", "group_size", "text_sha256") == want
        kept = found.filter("kept").collect()
        assert collections.Counter((r["doc_id"], r["text_sha256"]) for r in kept) == collections.Counter((shown(max(v)), sha(k)) for k, v in groups.items())
    assert exact.exact_duplicates(empty).count() == 0


def brute_groups(table, k, num, den):
    number = lambda d: 2**63 - 1 if d is None else d
    sets = []
    for _, t in table:
        w = words_of(lower(t))
        sets.append(frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else []))
    group = list(range(len(table)))
    for i in range(len(table)):
        for j in range(i):
            a, b = sets[i], sets[j]
            same_id = a and b and number(table[i][0]) == number(table[j][0])
            if (a and b and den * len(a & b) >= num * len(a | b)) or (same_id and a == b):
                x, y = group[i], group[j]
                group = [min(x, y) if g in (x, y) else g for g in group]
    least = collections.defaultdict(lambda: 2**63 - 1)
    for (d, _), g in zip(table, group):
        least[g] = min(least[g], number(d))
    return collections.Counter((number(d), len(s), least[g]) for (d, _), s, g in zip(table, sets, group))


@pytest.mark.parametrize("k,num", [(3, 90), (5, 80)])
def test_jaccard(docs, table, k, num):
    found = jaccard.jaccard_groups(docs, k, num, 100)
    assert rows_of(found, "doc_id", "n_shingles", "component_id") == brute_groups(table, k, num, 100)


def test_jaccard_of_different_texts_under_null_and_repeated_ids(spark):
    """Null-id texts and texts of one id link, stay apart and are kept by their sets alone."""
    rng, words = random.Random(9), _vocabulary(10)
    prose = lambda n: [rng.choice(words) for _ in range(n)]
    near = lambda w, at: " ".join(w[:at] + ["changed"] + w[at + 1 :])
    a, b, c, d, e = (prose(200) for _ in range(5))
    table = [(None, near(a, 5)), (None, near(a, 190)), (None, " ".join(b)), (8, near(b, 100)), (None, " ".join(c)), (None, "")]
    table += [(5, " ".join(d)), (5, " ".join(e)), (2, near(d, 50)), (9, near(e, 60)), (5, near(e, 150)), (5, near(a, 120)), (None, " ".join(prose(80)))]
    df = spark.createDataFrame(table, "doc_id long, text string").repartition(4)
    texts = dict(enumerate(t for _, t in table))
    assert rows_of(jaccard.jaccard_groups(df, 3, 90, 100), "doc_id", "n_shingles", "component_id") == brute_groups(table, 3, 90, 100)
    kept = [(r["doc_id"], r["text"]) for r in jaccard.keep_one(df, 3, 90, 100).collect()]
    assert {(5, texts[11]), (8, texts[3]), (None, texts[4]), (None, ""), (2, texts[8]), table[12]} <= set(kept)
    assert len(kept) == 7 and sum(k in (table[7], table[10]) for k in kept) == 1


def test_jaccard_prefixes_lengthen_over_common_shingles(spark, empty, monkeypatch):
    """Documents of common shingles only: every link is found whatever the extension."""
    rng, words = random.Random(6), _vocabulary(5, 60)
    shared = [rng.choice(words) for _ in range(120)]
    texts = []
    for _ in range(60):
        w = list(shared)
        for _ in range(rng.randint(0, 5)):
            w[rng.randrange(len(w))] = rng.choice(words)
        texts.append(" ".join(w))
    monkeypatch.setattr(jaccard, "COMMON_FROM", 3)
    table = list(enumerate(texts))
    df = spark.createDataFrame(table, "doc_id long, text string")
    assert rows_of(jaccard.jaccard_groups(df, 3, 90, 100), "doc_id", "n_shingles", "component_id") == brute_groups(table, 3, 90, 100)
    assert jaccard.extension(np.full(60, 500.0), 12, 120) > 1 == jaccard.extension(np.ones(13), 12, 13)
    assert jaccard.jaccard_groups(empty).count() == 0 and jaccard.keep_one(empty).count() == 0


def crowd_table():
    """Members of three groups of edited copies (a word replaced up to 12 times), short texts of common words, a passage that many hold."""
    rng, words = random.Random(12), _vocabulary(13, 3000)
    prose = lambda n: [rng.choice(words) for _ in range(n)]
    texts = []
    for size, members in ((150, 50), (60, 30), (300, 20)):
        base = prose(size)
        for _ in range(members):
            w = list(base)
            for at in rng.sample(range(size), rng.randint(0, 12)):
                w[at] = rng.choice(words)
            texts.append(w[: size - rng.choice((0, 0, 0, 9))] + prose(rng.choice((0, 0, 4))))
    passage, few = prose(20), words[:4]
    texts += [passage + prose(rng.randint(0, 30)) for _ in range(30)] + [[rng.choice(few) for _ in range(rng.randint(1, 40))] for _ in range(30)]
    return [(i, " ".join(w)) for i, w in enumerate(texts)]


@pytest.mark.parametrize("k,num,crowd", [(3, 90, 16), (5, 80, 2)])
def test_jaccard_of_crowded_shingles(spark, monkeypatch, k, num, crowd):
    """Groups that share shingles without being similar throughout: every link is found by the differences from the hub."""
    monkeypatch.setattr(jaccard, "CROWD", crowd)
    table = crowd_table()
    df = spark.createDataFrame(table, "doc_id long, text string").repartition(3)
    assert rows_of(jaccard.jaccard_groups(df, k, num, 100), "doc_id", "n_shingles", "component_id") == brute_groups(table, k, num, 100)


def test_jaccard_crowd_makes_no_pair_of_each_two_members(spark, monkeypatch):
    """120 copies of a text with 4 edits of their own each: none is similar to another, and nearly none is compared with another."""
    rng, words = random.Random(14), _vocabulary(15, 3000)
    base, compared, pairs = [rng.choice(words) for _ in range(150)], jaccard.compared, []
    texts = [" ".join(f"own{i}x{j}" if j in own else w for j, w in enumerate(base)) for i, own in enumerate(rng.sample(range(150), 4) for _ in range(120))]
    monkeypatch.setattr(jaccard, "compared", lambda found, *rest: pairs.append(found.count()) or compared(found, *rest))
    table = list(enumerate([" ".join(base), *texts]))
    df = spark.createDataFrame(table, "doc_id long, text string").repartition(3)
    assert rows_of(jaccard.jaccard_groups(df, 3, 90, 100), "doc_id", "n_shingles", "component_id") == brute_groups(table, 3, 90, 100)
    assert pairs[1] < 200


def test_jaccard_prefixes_are_shuffled_once(spark):
    """Rows, counts and hubs of the shingles read one exchange by shingle; copies of a node from several tasks count once."""
    rows = [(t, node, 10, place, need) for t, node, place, need in ((1, 5, 3, 2), (1, 5, 2, 2), (1, 4, 6, 1), (2, 5, 0, 2), (2, 5, 0, 2), (3, 7, 1, 1))] + [(9, i, 20 + i, i, 1) for i in range(17)]
    shared = jaccard.shared_prefixes(spark.createDataFrame(rows, "token long, node long, n int, place int, need int").repartition(4, "place"))
    found = {tuple(r[:5]) + (tuple(r["hub"]), r["crowd"]) for r in shared.select("token", "node", "n", "place", "need", "hub", "crowd").collect()}
    assert found == {(1, 5, 10, 2, 2, (10, 4, 6, 1), False), (1, 4, 10, 6, 1, (10, 4, 6, 1), False)} | {(9, i, 20 + i, i, 1, (20, 0, 0, 1), True) for i in range(17)}
    plan = jaccard.shared_prefixes(spark.range(9).selectExpr("id AS token", "id AS node", "1 AS n", "1 AS place", "1 AS need"))._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"\bExchange ", plan)) == 1


def test_components(spark):
    chain = [(i, i + 1) for i in range(30)] + [(100, 101), (101, 100), (7, 7), (205, 200), (203, 200)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(chain, "u long, v long")).collect()}
    assert found == {i: 0 for i in range(1, 31)} | {101: 100, 205: 200, 203: 200}


def brute_windows(sequences, width):
    count = collections.Counter(tuple(s[i : i + width]) for s in sequences for i in range(len(s) - width + 1))
    out = []
    for s in sequences:
        gone = [False] * len(s)
        for i in range(len(s) - width + 1):
            if count[tuple(s[i : i + width])] > 1:
                gone[i : i + width] = [True] * width
        out.append(gone)
    return out


@pytest.mark.parametrize("width,bucket_bytes", [(35, 1 << 24), (12, 2000)])
def test_phrases(docs, table, width, bucket_bytes):
    sequences = [words_of(t) for _, t in table]
    want = collections.Counter()
    for (d, _), s, gone in zip(table, sequences, brute_windows(sequences, width)):
        want[(2**63 - 1 if d is None else d, len(s), sum(gone), b" ".join(w for w, g in zip(s, gone) if not g).decode())] += 1
    assert rows_of(phrases.phrase_dedup(docs, width, bucket_bytes), "doc_id", "n_words", "n_removed", "kept_text") == want


def test_dealing_by_anchor(spark):
    """A hot anchor is dealt over many buckets; documents of another anchor stay together; no row is lost."""
    rows = [(i, i, 100, [-5, i]) for i in range(600)] + [(1000 + i, 7, 100, [10 + i % 3]) for i in range(12)]
    found = phrases.dealt(spark.createDataFrame(rows, "doc_id long, text_key long, size long, anchors array<long>"), 2000).collect()
    assert sorted(r.doc_id for r in found) == sorted(r[0] for r in rows)
    assert len({r.bucket for r in found if r.anchors[0] == -5}) > 15
    assert max(collections.Counter(r.bucket for r in found).values()) < 150
    for lead in (10, 11, 12):
        assert len({r.bucket for r in found if r.anchors[0] == lead}) == 1
    assert phrases.dealt(spark.createDataFrame([], "doc_id long, text_key long, size long, anchors array<long>"), 2000).count() == 0


def test_automaton_shards_agree():
    rng, words = random.Random(3), _vocabulary(7, 30)
    text = " ".join(rng.choice(words) for _ in range(500))
    parts = text.split(" ")
    some = pa.array([" ".join(parts[a : a + n]).encode() for a, n in ((10, 8), (12, 9), (100, 12), (104, 8), (300, 15))], pa.binary())
    u = recurring.word_units(pa.array([text, " ".join(parts[95:130]), ""]))
    assert (phrases.locate(u, some, 8) == phrases.locate(u, some, 8, shard=1)).all()
    assert phrases.locate(u, some, 8)[:500].sum() >= 9 + 12 + 15


@pytest.mark.parametrize("width,hot,stretch", [(400, 1000, 16), (40, 2, 8), (40, 1000, 16)])
def test_suffixes(docs, table, width, hot, stretch, monkeypatch):
    monkeypatch.setattr(suffixes.recurring_runs, "__defaults__", (4096, hot, stretch))
    sequences = [(t or "").encode() for _, t in table]
    want = collections.Counter()
    for (d, _), s, gone in zip(table, sequences, brute_windows(sequences, width)):
        spans = sum(g and not p for g, p in zip(gone, [False, *gone]))
        want[(2**63 - 1 if d is None else d, len(s), sum(gone), spans, bytes(c for c, g in zip(s, gone) if not g))] += 1
    found = collections.Counter((r[0], r[1], r[2], r[3], bytes(r[4])) for r in suffixes.suffix_dedup(docs, width).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept").collect())
    assert found == want


def test_crowded_windows_of_equal_core_and_other_bytes_do_not_recur(spark):
    rows = [(1, 10, 1, 0, 7, b"aaaa"), (1, 11, 1, 3, 7, b"bbbb"), (1, 12, 1, 5, 8, b"cccc"), (1, 13, 1, 2, 8, b"cccc"), (1, 14, 2, 1, 9, b"dddd"), (1, 15, 1, 4, 9, b"dddd")]
    single = spark.createDataFrame([(*r[:5], bytearray(r[5])) for r in rows], "anchor long, digest long, n long, place int, core long, content binary")
    assert rows_of(suffixes._counted_windows(single), "digest", "a", "b") == {(12, 5, 5): 1, (13, 2, 2): 1, (15, 4, 4): 1}


def test_two_stage_sort_orders_suffixes():
    rng = random.Random(1)
    for letters in (b"ab", b"ab\0\xff", b"abcdefg"):
        for _ in range(60):
            raw = bytes(rng.choice(letters.replace(b"\0", b"a")) for _ in range(rng.randrange(0, 40))) + b"\0"
            got = suffixes.two_stage_sort(np.frombuffer(raw, np.uint8), 100).tolist()
            assert got == sorted(range(len(raw)), key=lambda i: raw[i:])


def test_suffix_sort_holds_few_keys(monkeypatch):
    """Many suffixes of one first byte: same order and windows, with the bytes of few of them held as keys; the sums of a shard are not held at once."""
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9))) for _ in range(2000)]
    contents = [" ".join(rng.choice(words) for _ in range(150)).encode() for _ in range(1200)]
    contents += [b"ab" * 700, b"ab" * 600 + b"c", contents[0][50:700] + b"!"]
    want = collections.Counter(c[i : i + 400] for c in contents for i in range(len(c) - 399))
    begins = np.cumsum([0, *(len(c) + 1 for c in contents)])
    arrays._powers.cache_clear()
    tracemalloc.start()
    try:
        found = suffixes.recurring_starts(contents, 400).tolist()
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert found == [int(b) + i for b, c in zip(begins, contents) for i in range(len(c) - 399) if want[c[i : i + 400]] > 1]
    assert peak < 60 * begins[-1]
    monkeypatch.setattr(suffixes, "KEYS", 2)
    for letters in (b"a", b"ab", b"abc"):
        for _ in range(30):
            raw = bytes(rng.choice(letters) for _ in range(rng.randrange(0, 60))) + b"\0"
            assert suffixes.two_stage_sort(np.frombuffer(raw, np.uint8), 100).tolist() == sorted(range(len(raw)), key=lambda i: raw[i:])


def test_substring_operators_on_empty(empty):
    assert phrases.phrase_dedup(empty).count() == 0 and suffixes.suffix_dedup(empty).count() == 0


def test_packing(docs, table, empty):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    found = packing.packed_pieces(docs, tokenizer_path("byte_bpe_50k.json")).collect()
    want = collections.Counter()
    for d, t in table:
        ids = np.asarray([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], dtype="<u4")
        at = 0
        rest = len(ids) % 1024
        for n in [1024] * (len(ids) // 1024) + [1 << b for b in range(9, -1, -1) if rest >> b & 1]:
            want[(d, at, n, zlib.crc32(ids[at : at + n].tobytes()), len(ids))] += 1
            at += n
        assert at == len(ids)
    assert collections.Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in found) == want
    assert len({r["sequence_id"] for r in found}) == len(found) and all(r["offset"] == 0 and r["length"] in {1 << b for b in range(11)} for r in found)
    assert all(zlib.crc32(np.asarray(r["ids"], "<u4").tobytes()) == r["ids_crc32"] for r in found)
    assert packing.packed_pieces(empty, tokenizer_path("byte_bpe_50k.json")).count() == 0


def test_packing_of_texts_that_start_with_a_contraction():
    """Pieces learned in one batch after others get the ids they have alone."""
    from tokenizers import Tokenizer

    path = tokenizer_path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    heads = ["'s", "'t", "'re", "'ve", "'m", "'ll", "'d", "'tis", "'twas", "'s avonds", "''tis", "(it's)", "\"'t", "-'d"]
    texts = [f"zq{i}-first{i}! then" for i in range(20)] + heads + [f"{h}zx" for h in heads] + [f" {h}" for h in heads] + [f"\n{h}  {h}" for h in heads]
    ids, bounds = packing.byte_bpe_encoder(path)(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_pieces(docs, table, empty):
    import sentencepiece

    path = tokenizer_path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    found = pieces.piece_tokens(docs, path).collect()
    assert all(r["parity"] for r in found)
    want = collections.Counter((d, tuple(library.encode(t or ""))) for d, t in table)
    assert collections.Counter((r["doc_id"], tuple(r["ids"])) for r in found) == want
    assert collections.Counter(r["decoded"] for r in found) == collections.Counter((t or "") for _, t in table)
    assert pieces.piece_tokens(empty, path).count() == 0


def test_unigram_model_is_rebuilt_with_scores():
    """A hand-made unigram model file: parse, scores, byte fallback, parity with the library."""
    import struct

    import sentencepiece

    def varint(n):
        return bytes([n]) if n < 128 else bytes([n & 127 | 128]) + varint(n >> 7)

    def message(number, data):
        return varint(number << 3 | 2) + varint(len(data)) + data

    def piece(text, score, kind):
        return message(1, message(1, text.encode()) + varint(2 << 3 | 5) + struct.pack("<f", score) + varint(3 << 3) + varint(kind))

    vocabulary = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)] + [(f"<0x{i:02X}>", 0.0, 6) for i in range(256)]
    vocabulary += [(p, -1.0 - i / 7, 1) for i, p in enumerate(["▁", "a", "b", "ab", "▁ab", "▁a", "ba", "bab", "▁bab", "aab"])]
    raw = b"".join(piece(*p) for p in vocabulary) + message(2, varint(3 << 3) + varint(1) + varint(35 << 3) + varint(1)) + message(3, varint(3 << 3) + varint(1) + varint(4 << 3) + varint(0) + varint(5 << 3) + varint(1))
    model = pieces.parse_model(raw)
    assert model.model_type == pieces.UNIGRAM and model.byte_fallback and not model.remove_extra_whitespaces and len(model.pieces) == len(vocabulary)
    tokenizer, library = pieces.rebuild(model), sentencepiece.SentencePieceProcessor(model_proto=raw)
    for text in ("ab bab", "aabab baba", "abé☃b", "bbbb  aa"):
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        assert ids == library.encode(text) and tokenizer.decode(ids) == library.decode(ids)


def test_language(spark, docs, empty):
    a, b = _vocabulary(11, 60), [w[::-1].upper() + "o" for w in _vocabulary(12, 60)]
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice((a, b)[i % 2]) for _ in range(rng.randint(15, 60))), ("aa", "bb")[i % 2]) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit_language_model(df, ~langid.held_out(2, 4), epochs=4)
    found = {r["doc_id"]: r for r in langid.predict_language(df, model).collect()}
    assert sum(found[i]["_lang"] == lang for i, _, lang in rows) >= 297
    strange = langid.predict_language(docs, model)
    names = langid.predicted_columns(docs)
    assert strange.columns == docs.columns + names and names[0] == "__lang"
    for r in strange.collect():
        lettered = any(c.isalpha() for c in r["text"] or "")
        assert (r[names[0]] in ("aa", "bb")) == lettered and 0 <= r[names[1]] <= 1 and (lettered or not r[names[2]])
    assert langid.fit_language_model(empty, F.lit(True)) is None
    assert [r["_lang"] for r in langid.predict_language(df.limit(3), None).collect()] == ["und"] * 3
    assert langid.predict_language(empty, model).count() == 0


def test_language_learns_every_labelled_language(spark):
    """More languages than a full sample of each would allow, the rarest with one document, null ids among them."""
    rng = random.Random(5)
    names = [f"l{i:02d}" for i in range(70)]
    words = {x: ["".join(rng.choice(letters) for _ in range(5)) for _ in range(12)] for x in names for letters in [rng.sample("abcdefghijklmnopqrstuvwxyz", 5)]}
    rows = [(x, " ".join(rng.choice(words[x]) for _ in range(40))) for i, x in enumerate(names) for _ in range(1 if i == 69 else 12 - i // 10)]
    df = spark.createDataFrame([(None if i % 9 == 0 else i, t, x) for i, (x, t) in enumerate(rows)], "doc_id long, text string, lang string")
    assert {r["lang"] for r in langid.training_sample(df, F.lit(True), 500, 32_000).select("lang").distinct().collect()} == set(names)
    few = [r["lang"] for r in langid.training_sample(df, F.lit(True), 2, 100).collect()]
    assert set(few) == set(names) and len(few) < len(rows) // 2
    model = langid.fit_language_model(df, F.lit(True))
    assert model.langs == names
    found = langid.predict_language(df, model).collect()
    assert {r["lang"] for r in found if r["_lang"] == r["lang"]} >= set(names[:69])
    assert sum(r["_lang"] == r["lang"] for r in found) >= 0.95 * len(rows)


def brute_segments(values):
    """Maximal scoring segments by definition: the best segment first, then on both sides of it."""
    best = max(((sum(values[i:j]), -(j - i), i, j) for i in range(len(values)) for j in range(i + 1, len(values) + 1)), default=(0, 0, 0, 0))
    if best[0] <= 0:
        return []
    _, _, i, j = best
    return brute_segments(values[:i]) + [(i, j)] + [(a + j, b + j) for a, b in brute_segments(values[j:])]


def test_maximal_segments_match_definition():
    rng = random.Random(8)
    for _ in range(200):
        values = [rng.choice([-3.25, -1.5, -1.0, 0.75, 1.0, 2.125]) + rng.random() / 1000 for _ in range(rng.randint(0, 18))]
        assert [(a, b) for a, b, _ in toxicity.maximal_segments(np.array(values))] == brute_segments(values)


def test_toxicity(spark, docs, empty):
    words, bad = _vocabulary(21), ["vile", "scumbag", "idiotic", "trashy"]
    rng = random.Random(3)
    rows, marks = [], []
    for i in range(400):
        w = [rng.choice(words) for _ in range(rng.randint(30, 120))]
        if i % 5 == 0:
            at = rng.randrange(len(w))
            w[at:at] = [x for _ in range(4) for x in (rng.choice(bad), rng.choice(words))]
        rows.append((i, " ".join(w)))
        marks.append((i, int(i % 5 == 0)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([*marks, (None, 1), (7, None)], "doc_id long, toxic int")
    model = toxicity.fit_toxicity(df, labels, ~langid.held_out(0, 5))
    found = {r["doc_id"]: r for r in toxicity.toxicity(df, model).collect()}
    assert sum((found[i]["score"] >= 0.5) == bool(y) for i, y in marks) >= 390
    hit = found[next(i for i, y in marks if y)]
    tokens = dict(rows)[hit["doc_id"]].split()
    assert any(set(tokens[s["start"] : s["end"]]) & set(bad) for s in hit["spans"])
    strange = toxicity.toxicity(docs, model).collect()
    assert len(strange) == docs.count() and all(0 <= r["score"] <= 1 for r in strange)
    none = toxicity.fit_toxicity(df, labels.limit(0), F.lit(True))
    assert all(r["score"] < 0.5 for r in toxicity.toxicity(df, none).collect())
    assert toxicity.toxicity(empty, model).count() == 0


def test_pipeline_stages(spark, docs, empty):
    import corpus_pipeline

    now = docs
    for name, stage in corpus_pipeline.STAGES:
        before = {(r["doc_id"], r["text"]) for r in now.select("doc_id", "text").collect()}
        after = stage(spark, now, "")
        if name == "packing":
            assert {r["doc_id"] for r in after.select("doc_id").distinct().collect()} == {d for d, _ in before}
            break
        assert after.columns == docs.columns and after.dtypes == docs.dtypes
        rows = after.select("doc_id", "text").collect()
        if name == "language_id":
            assert {(r["doc_id"], r["text"]) for r in rows} <= before
        if name == "line_dedup":
            want = collections.Counter((d, h) for (d, _, _, h), n in brute_lines([(r["doc_id"], r["text"]) for r in now.collect()]).items() for _ in range(n))
            assert collections.Counter((r["doc_id"], sha(r["text"])) for r in rows) == want
        if name == "jaccard_join":
            number = lambda d: 2**63 - 1 if d is None else d
            groups = brute_groups(sorted(before, key=str), 5, 80, 100)
            assert {number(r["doc_id"]) for r in rows} == {g for _, _, g in groups}
        if name == "phrase_dedup":
            source = sorted((d, t or "") for d, t in before if d is not None)
            got = {r["doc_id"]: r["text"] for r in rows}
            sequences = [words_of(t) for _, t in before]
            for (d, _), s, gone in zip(before, sequences, brute_windows(sequences, corpus_pipeline.PASSAGE_WORDS)):
                assert got[d] == b" ".join(w for w, g in zip(s, gone) if not g).decode()
            assert source
        now = after
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, "").count() == 0
