"""Filter interaction audit, byte-level BPE and conversation repair against brute force and public libraries."""

import collections
import hashlib
import heapq
import itertools
import random
import zlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from varpair.llm import bytebpe, conversations, interactions
from varpair.llm.queries import ORACLE, tokenizer_path
from varpair.plans.oracle_check import canon

DOCS = "doc_id long, text string, lang string, source string"
SPACES = " \t\n\x0b\x0c\r"


def words_of(text):
    return text.encode().split()


# ---- filter interactions


def audit(docs, labels):
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    big = 2**63 - 1
    least = {}
    for d, t, s in docs:
        least[t or ""] = min(least.get(t or "", big), big if d is None else d)
    rows = []
    for d, t, s in docs:
        t = t or ""
        w = words_of(t)
        fails = [len(w) < 50, 100 * len(set(w)) < 65 * len(w), 100 * sum("A" <= c <= "Z" for c in t) > 5 * len(t), any(c in "#$%&*|" for c in t), (big if d is None else d) > least[t]]
        rows.append((s or "", {f for f, x in zip("ABCDE", fails) if x}, d in good, d in toxic))
    out = {}
    for part in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == part]
        for order in map("".join, itertools.permutations("ABCDE")):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[1]]
                late = sum(f in r[1] for r in mine) - len(gone)
                left = [r for r in left if f not in r[1]]
                out[part, order, step] = [len(left), len(gone), late, sum(r[1] == {f} for r in mine), sum(r[2] for r in gone), sum(r[3] for r in gone)]
        total = collections.Counter()
        for order in map("".join, itertools.permutations("ABCDE")):
            for step, f in enumerate(order, 1):
                total[f] += out[part, order, step][1]
        for (p, order, step), x in out.items():
            if p == part:
                x.append(total[order[step - 1]])
    return {(*k, *v) for k, v in out.items()}


def test_filter_interactions(spark):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(200)]
    prose = lambda n, at=words: " ".join(rng.choice(at) for _ in range(n))
    texts = [None, "", " \n\t ", "one", "A B C #", prose(49), prose(50), prose(120, words[:40]), prose(120).upper(), prose(90) + " 50% off", "É" * 95 + "A" * 5, "É" * 95 + "A" * 6, "x" * 200_000, prose(3000, words[:4]), "a\x1cb\x85c　d " * 20]
    texts += [prose(rng.choice((20, 60, 200)), rng.choice((words, words[:30]))) + rng.choice(("", " #", " ABCDEFGHIJKLMN", " | X")) for _ in range(60)]
    rows = [(i if i % 13 else None, t, "en", rng.choice(["a", "b", None, "", "hot", "hot", "hot"])) for i, t in enumerate(texts)]
    rows += [(500 + i, rng.choice(texts), "en", rng.choice(["a", "hot"])) for i in range(60)] + [(700, "same", "en", "a")] * 3 + [(700, "same", "en", "b"), (701, "same", "en", "b"), (3, "again", "fr", "c"), rows[20]]
    labels = [(d, rng.randint(0, 1), rng.choice((0, 1, None))) for d, *_ in rows if rng.random() < 0.5] + [(700, 0, 1), (700, 1, 0), (99999, 1, 1), (None, 1, 1)]
    docs = spark.createDataFrame(rows, DOCS).select("*", *[F.lit(1).alias(c) for c in ("mask", "part", "n", "good", "head", "id")]).repartition(4)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("mask", F.lit(1))
    found = interactions.filter_interactions(docs, marks)
    got = [tuple(r) for r in found.collect()]
    want = audit([(d, t, s) for d, t, _, s in rows], labels)
    assert len(got) == len(want) and set(got) == want
    assert interactions.filter_interactions(docs.limit(0), marks).count() == 0
    assert interactions.filter_interactions(docs, marks.limit(0)).agg(F.sum("good_lost") + F.sum("toxic_lost")).first()[0] == 0


def test_filter_interactions_sql_with_nulls_and_repeats(spark):
    import duckdb
    import pandas as pd

    rows = [(1, "a #", "s"), (2, "a #", "s"), (None, "a #", None), (None, None, "s"), (3, "", "t"), (3, "b", "t"), (3, "b", "t"), (4, "b", "t")]
    documents = pd.DataFrame(rows, columns=["doc_id", "text", "source"]).astype({"doc_id": "Int64"})
    labels = pd.DataFrame([(2, 1, 1), (4, 1, 0), (4, 0, 1)], columns=["doc_id", "quality", "toxic"])
    con = duckdb.connect()
    con.register("documents", documents)
    con.register("labels", labels)
    sql = con.sql(ORACLE["op11_filter_interactions"])
    df = interactions.filter_interactions(spark.createDataFrame(rows, "doc_id long, text string, source string"), spark.createDataFrame(labels))
    assert canon(df.columns, [tuple(r) for r in df.collect()]) == canon(sql.columns, sql.fetchall())


# ---- byte-level BPE


@pytest.fixture(scope="module")
def ranks():
    return tokenizer_path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library(ranks):
    import public_tokenizers
    import tiktoken

    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: i for i, t in enumerate(bytebpe.read_ranks(ranks))}, special_tokens={})


def odd_texts():
    rng = random.Random(5)
    signs = "ab =-_*.\n\t'sdtl01é漢🎉İß\x00\x1c\x85　 "
    out = [None, "", " ", "\n\n \n", "<|endoftext|> <s>", "'tis", "it's 'S ''ll", "x" * 5000, " " * 4000, "漢字🎉" * 3000, "é" * 300, "á‍🏳️‍🌈 ", "tab\tfeed\x0c\x0bend\r\n"]
    out += [c * n for c in " -=_*.#\n\t'ae0漢" for n in (2, 3, 5, 7, 17, 33, 64, 127)]
    return out + ["".join(rng.choice(signs) for _ in range(rng.randint(1, 80))) for _ in range(1500)]


def test_byte_bpe_equals_the_library(spark, ranks, library):
    texts = odd_texts()
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "null id"), (3, "again"), (3, "again")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").select("*", F.lit(1).alias("ids"), F.lit("x").alias("n_tokens")).repartition(4)
    found = bytebpe.encoded(docs, ranks)
    got = collections.Counter((r["doc_id"], tuple(r["ids"]), r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in found.collect())
    want = collections.Counter()
    for d, t in rows:
        ids = library.encode_ordinary(t or "")
        assert library.decode_bytes(ids) == (t or "").encode()
        want[d, tuple(ids), len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()] += 1
    assert got == want
    lean = bytebpe.encoded(docs, ranks, with_ids=False)
    assert lean.filter("ids IS NOT NULL OR starts IS NOT NULL").count() == 0
    assert collections.Counter(r[0] for r in lean.select("ids_sha256").collect()) == collections.Counter(r[0] for r in found.select("ids_sha256").collect())
    assert bytebpe.encoded(docs.limit(0), ranks).count() == 0


def test_byte_bpe_offsets_and_split_characters(spark, ranks, library):
    texts = {i: t or "" for i, t in enumerate(odd_texts())}
    found = bytebpe.encoded(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), ranks)
    whole = bytebpe.tokenizers_of(ranks)[0]
    n_split = 0
    for r in found.collect():
        assert list(zip(r["starts"], r["ends"])) == whole.encode(texts[r["doc_id"]], add_special_tokens=False).offsets
        cut = 0
        for i in r["ids"]:
            raw = library.decode_single_token_bytes(i)
            cut += not _whole(raw)
        assert r["n_split"] == cut
        n_split += cut
    assert n_split > 1000


def _whole(raw):
    try:
        raw.decode()
        return True
    except UnicodeDecodeError:
        return False


def test_decoding_of_any_slice(spark, ranks, library):
    text = "漢字🎉 naïve \x00 end"
    ids = library.encode_ordinary(text)
    rows = [(a, b, ids[a:b]) for a in range(len(ids)) for b in range(a, len(ids) + 1)] + [(0, 0, None)]
    df = spark.createDataFrame(rows, "a int, b int, ids array<int>").withColumn("decoded_text", F.lit("old"))
    for r in bytebpe.decoded(df, ranks).collect():
        raw = library.decode_bytes(r["ids"] or [])
        assert (bytes(r["decoded_bytes"]), r["decoded_text"]) == (raw, raw.decode(errors="replace"))
    assert bytebpe.decoded(df.limit(0), ranks).count() == 0
    with pytest.raises(Exception, match="ids outside"):
        bytebpe.decoded(spark.createDataFrame([([60000],)], "ids array<int>"), ranks).collect()


# ---- conversation repair


def cheapest(rows, limit=40):
    """Least cost and ASCII-least edits by search over (cost, edits), without the operator's states."""
    seen, repeats = set(), []
    for role, text in rows:
        repeats.append((role, text) in seen)
        seen.add((role, text))
    must = [not text.strip(SPACES) or again for (_, text), again in zip(rows, repeats)]
    open_end = [not m and text.strip(SPACES)[-1] not in ".!?" for (_, text), m in zip(rows, must)]

    def legal(initials):
        rest = initials[1:] if initials[:1] == "s" else initials
        return rest == ("ua" * len(rest))[: len(rest)]

    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, edits, at, initials, lines = heapq.heappop(heap)
        rest = initials[1:] if initials[:1] == "s" else initials
        if at == len(rows) and (not initials or (rest and len(rest) % 2 == 0)):
            return cost, edits, "\n".join(lines)
        key = (at, initials[:1] == "s", len(rest) % 2, bool(rest))
        if key in done or cost > limit:
            continue
        done.add(key)
        for role in ("user", "assistant"):
            if legal(initials + role[0]):
                heapq.heappush(heap, (cost + 2, edits + "I", at, initials + role[0], (*lines, f"{role}:")))
        if at < len(rows):
            (name, text), late = rows[at], int(open_end[at])
            heapq.heappush(heap, (cost + 3, edits + "D", at + 1, initials, lines))
            if not must[at]:
                if name[:1] and legal(initials + name[0]):
                    heapq.heappush(heap, (cost + late, edits + "K", at + 1, initials + name[0], (*lines, f"{name}:{text}")))
                for role in ("user", "assistant"):
                    if legal(initials + role[0]):
                        heapq.heappush(heap, (cost + 2 + late, edits + "R", at + 1, initials + role[0], (*lines, f"{role}:{text}")))
    raise AssertionError("no repair")


def expected(rows):
    by = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        by[conv]
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        if kind == 4:
            role = "user"
        by[conv] += [(turn, role, text)] * (2 if kind == 3 else 1)
    out = []
    for conv, turns in by.items():
        turns.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, count = set(), collections.Counter()
        for _, role, text in turns:
            words = text.strip(SPACES)
            count["blank" if not words else "duplicate" if (role, text) in seen else "truncated" if words[-1] not in ".!?" else "fine"] += 1
            seen.add((role, text))
        numbers = {t for t, *_ in turns if t is not None}
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
        cost, audit, text = cheapest([r[1:] for r in turns], limit=10**9)
        out.append((conv, gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()))
    return collections.Counter(out)


def conversation_rows(seed, n, longest):
    rng = random.Random(seed)
    rows = []
    for conv in range(n):
        roles = ["system"] * rng.choice((0, 0, 1)) + ["user", "assistant"] * rng.randint(0, longest // 2)
        for turn, role in enumerate(roles):
            role = role if rng.random() < 0.85 else rng.choice(["user", "assistant", "system", "tool", "", None, "agent"])
            text = rng.choice(["Fine.", "Yes!", "So?", "open end", "", "  ", "　", None, f"line {conv} {turn}.", f"two\nlines {turn}?", "a.b.c"])
            rows.append((conv, turn if rng.random() < 0.97 else None, role, text))
    return rows


def check(spark, rows, parts):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").select("*", *[F.lit(7).alias(c) for c in ("block", "state", "audit", "gone")]).repartition(parts)
    found = conversations.repaired_conversations(df)
    assert collections.Counter(tuple(r) for r in found.collect()) == expected(rows)


def test_repair_equals_search(spark):
    rows = conversation_rows(1, 400, 9)
    rows += [(None, t, "user", "No id.") for t in (0, 1, None)] + [(5000 + i, 1, "user", "Only.") for i in range(60)] + [(3, 1, "user", "Twice at one turn.")] * 3
    rows += [(7000, t, None, None) for t in range(5)] + [(7001, None, "user", "x" * 100_000 + ".")]
    check(spark, rows, 5)
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert conversations.repaired_conversations(empty).count() == 0


def test_repair_of_conversations_longer_than_a_task(spark):
    """Most rows in one conversation, spread over tasks and blocks, with turns that repeat blocks later."""
    rng = random.Random(9)
    rows = [(1, t, rng.choice(["user", "assistant", "assistant", "user", "system"]), rng.choice([f"n {t}.", f"n {t}", f"again {t % 700}.", ""])) for t in range(3000)]
    rows += [(2, t, ("user", "assistant")[t % 2], f"m {t}.") for t in range(600)] + [(3, 0, "user", "x" * 3_000_000 + "."), (3, 1, "assistant", "y" * 3_000_000), (3, 2, "user", "z.")]
    check(spark, rows + conversation_rows(4, 30, 6), 6)


def test_repair_program_is_least_for_every_short_sequence():
    texts = {0: lambda i: f"t {i}.", 1: lambda i: f"t {i}", 2: lambda i: ""}
    roles = ["system", "user", "assistant", "tool"]
    for n in range(4):
        for codes in itertools.product(range(12), repeat=n):
            cost, edits = conversations.cheapest_edits(bytes(codes))
            rows = [(roles[c // 3], texts[c % 3](i)) for i, c in enumerate(codes)]
            audit = "".join(e for _, e in edits)
            want = cheapest(rows)
            assert (cost, audit, "\n".join(conversations.repaired_lines(audit, [r for r, _ in rows], [t for _, t in rows])[0])) == want


def test_repair_keeps_vectors_at_square_root_steps_only():
    codes = bytes(random.Random(3).randrange(12) for _ in range(10_000))
    cost, edits = conversations.cheapest_edits(codes)
    next(edits)
    held = edits.gi_frame.f_locals
    assert len(held["vectors"]) <= 101 and len(held["marks"]) <= 102
    vectors = [conversations._END]
    for code in reversed(codes):
        vectors.append(conversations._before(code, vectors[-1]))
    assert vectors[-1][0] == cost


def test_repair_sql_with_nulls_and_repeats(spark):
    import duckdb
    import pandas as pd

    rows = conversation_rows(6, 120, 7) + [(None, 1, "user", "No id."), (None, None, "assistant", None)]
    con = duckdb.connect()
    con.register("conversations", pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"]).astype({"conv_id": "Int64", "turn": "Int64"}))
    sql = con.sql(ORACLE["op13_conversation_repair"])
    df = conversations.repaired_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert canon(df.columns, [tuple(r) for r in df.collect()]) == canon(sql.columns, sql.fetchall())
