"""Substring deduplication by suffix arrays built with two-stage sorting.

Distinct segments under anchors found more than once (``recurring``) are dealt
into shards by anchor, so equal windows meet.  A shard lays its segments end to
end and sorts their suffixes in two stages: only suffixes smaller than their
successors are sorted directly, the others are induced from them by one scan
over the buckets of first bytes.  Adjacent suffixes with a common prefix of the
full width are recurring windows.  An anchor with very many kinds of segment is
dealt by the bytes that all windows of a short stretch of starts share.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arrays as A
from .io import in_tasks, keyed, real_id, release_memory, saved, ship
from .recurring import Shape, bitmap_of, byte_units, distinct_segments, has, occurrences

GRAM = 64
#: Suffixes whose bytes are held as keys at a time.
KEYS = 1 << 14
#: Segment bytes of a shard; kinds of segment from which an anchor is dealt by content; starts of one stretch.
SHARD_BYTES, HOT_KINDS, STRETCH = 2 << 20, 1000, 16


def byte_shape(width: int) -> Shape:
    return Shape(byte_units, width, max(1, min(GRAM, width // 2)), 1 / 40)


def rising(symbols: np.ndarray) -> np.ndarray:
    """Is each suffix smaller than its successor (type S)?  The last one counts as greater."""
    n = len(symbols)
    out = np.zeros(n, dtype=bool)
    differs = np.flatnonzero(symbols[1:] != symbols[:-1])
    if len(differs):
        nxt = np.repeat(differs, np.diff(differs, prepend=-1))
        out[: differs[-1] + 1] = symbols[nxt] < symbols[nxt + 1]
    return out


def by_content(padded: np.ndarray, raw: bytes, at: np.ndarray, depth: int) -> np.ndarray:
    """``at`` in the order of the ``depth`` bytes behind each, equal ones as they came.

    Many positions are told apart by eight bytes at a time first, so the keys of
    ``KEYS`` of them are held at most, not those of all.  ``padded`` goes on with
    zeros for ``depth`` + 8 bytes.
    """
    out = at.copy()
    todo = [(0, len(out), 0)]  # parts of ``out`` whose first ``skip`` bytes are equal
    while todo:
        low, high, skip = todo.pop()
        here = out[low:high]
        if len(here) <= KEYS:
            keys = [raw[i + skip : i + depth] for i in here.tolist()]
            out[low:high] = here[sorted(range(len(keys)), key=keys.__getitem__)]
        elif skip < depth:
            word = np.zeros(len(here), dtype=np.uint64)
            for j in range(skip, skip + 8):
                word = (word << np.uint64(8)) | padded[here + j]
            order = np.argsort(word, kind="stable")
            out[low:high], word = here[order], word[order]
            ends, a = np.append(np.flatnonzero(word[1:] != word[:-1]) + 1, len(here)), 0
            while a < len(here):
                i = int(np.searchsorted(ends, a + KEYS, side="right")) - 1
                fits = i >= 0 and ends[i] > a  # whole groups of equal words, as many as fit; else one larger group
                b = int(ends[i if fits else i + 1])
                todo.append((low + a, low + b, skip if fits else skip + 8))
                a = b
    return out


def two_stage_sort(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Suffix array of ``symbols`` (uint8, its last one the smallest), in order of at least ``depth`` symbols."""
    n = len(symbols)
    small = rising(symbols)
    raw = symbols.tobytes()
    padded = np.concatenate([symbols, np.zeros(depth + 8, dtype=np.uint8)])
    direct = np.flatnonzero(small)
    direct = direct[np.argsort(symbols[direct], kind="stable")]
    limits = np.concatenate([[0], np.cumsum(np.bincount(symbols[direct], minlength=256))])
    induced: list[list[np.ndarray]] = [[] for _ in range(256)]
    induced[symbols[-1]].append(np.array([n - 1]))
    out = []

    def place(prev: np.ndarray) -> None:
        prev = prev[prev >= 0]
        prev = prev[~small[prev]]
        if not len(prev):
            return
        first = symbols[prev]
        order = np.argsort(first, kind="stable")
        prev, first = prev[order], first[order]
        cuts = np.flatnonzero(np.diff(first)) + 1
        for part in np.split(prev, cuts):
            induced[symbols[part[0]]].append(part)

    for c in range(256):
        done = 0
        while done < len(induced[c]):  # a run of one byte induces into its own bucket
            new = np.concatenate(induced[c][done:])
            done = len(induced[c])
            out.append(new)
            place(new - 1)
        here = direct[limits[c] : limits[c + 1]]
        if len(here):
            order = by_content(padded, raw, here, depth)
            out.append(order)
            place(order - 1)
    return np.concatenate(out)


def _window_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width`` bytes from every position that has as many, block by block: the sums of all bytes are never held at once."""
    table, step = A.byte_values(), A.CHUNK_BYTES // 2
    out = np.zeros(max(len(data) - width + 1, 0), dtype=np.uint64)
    for at in range(0, len(out), step):
        to = min(at + step, len(out))
        out[at:to] = A.rolling(A.prefix_sums(table[data[at : to + width - 1]]), width)
    return out


def recurring_starts(contents: list[bytes], width: int) -> np.ndarray:
    """Starts (over the contents laid end to end, a zero byte after each) of windows that start anywhere else too."""
    sizes = np.array([len(c) for c in contents])
    data = np.frombuffer(b"\0".join(contents) + b"\0", dtype=np.uint8)
    begins = np.cumsum(sizes + 1) - sizes - 1
    order = two_stage_sort(data, width)
    ends = np.repeat(begins + sizes, sizes + 1)
    order = order[order + width <= ends[order]]  # whole windows; the others share no full width
    prefix = _window_hashes(data, width)[order]  # equal: the common prefix reaches the width
    same = prefix[1:] == prefix[:-1]
    again = np.zeros(len(order), dtype=bool)
    again[1:] |= same
    again[:-1] |= same
    return np.sort(order[again])


def _stretches(segments: DataFrame, width: int, gram: int, stretch: int) -> DataFrame:
    """Segments cut into ``stretch`` window starts each, with a hash of the anchor, the stretch and the bytes that all its windows share."""
    span = width - gram + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in A.chunks(batches, column="content", limit=A.CHUNK_BYTES // 16):
            out: list[tuple] = []
            for anchor, digest, n, place, content in zip(*(part.column(c).to_pylist() for c in ("anchor", "digest", "n", "place", "content"))):
                sums = A.prefix_sums(A.byte_values()[np.frombuffer(content, dtype=np.uint8)])
                pick = int(np.flatnonzero(A.mix(A.rolling(sums, gram)[:span]).view(np.int64) == anchor)[-1])
                last = len(content) - width
                for q in range((pick - last) // stretch, pick // stretch + 1):
                    high = pick - q * stretch
                    low = high - stretch + 1
                    core = A.mix(A.summed_hashes(sums, np.array([high]), np.array([low + width])) ^ A.mix(np.array([anchor]).view(np.uint64) + np.uint64(q)))
                    a, b = max(low, 0), min(high, last)
                    out.append((anchor, digest, n, place + a, int(core.view(np.int64)[0]), content[a : b + width]))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
            columns = zip(*out) if out else [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["anchor", "digest", "n", "place", "core", "content"])

    return in_tasks(segments.select("anchor", "digest", "n", "place", "content"), run, "anchor long, digest long, n long, place int, core long, content binary")


def _sorted_runs(rows: DataFrame, width: int, shards: int) -> DataFrame:
    """anchor, digest, a, b: runs of recurring starts of the segments found once, from the suffix array of each shard."""

    def sort(table: pa.Table) -> pa.Table:
        contents = table["content"].to_pylist()
        anchor, digest, n, place = (table[c].to_numpy() for c in ("anchor", "digest", "n", "place"))
        begins = np.cumsum([0, *(len(c) + 1 for c in contents)])
        mask = np.zeros(int(begins[-1]), dtype=bool)
        mask[recurring_starts(contents, width)] = True
        a, b = A.runs(mask)
        row = np.searchsorted(begins, a, side="right") - 1
        keep = n[row] == 1
        a, b, row = a[keep], b[keep], row[keep]
        base = place[row] - begins[row]
        release_memory()
        return pa.table({"anchor": anchor[row], "digest": digest[row], "a": pa.array((a + base).astype(np.int32)), "b": pa.array((b - 1 + base).astype(np.int32))})

    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("deal"), F.lit(shards)).cast("int")).select("shard", "anchor", "digest", "n", "place", "content")
    return dealt.groupBy("shard").applyInArrow(sort, "anchor long, digest long, a int, b int")


def _counted_windows(single: DataFrame) -> DataFrame:
    """anchor, digest, a, b: the single windows of segments found once that recur, by two independent 64-bit hashes."""
    single = single.withColumn("check", F.xxhash64("content")).drop("content")
    pairs = single.groupBy("core", "check").agg(F.sum("n").alias("_n")).filter("_n > 1").drop("_n")
    return single.filter("n = 1").join(pairs, ["core", "check"]).select("anchor", "digest", F.col("place").alias("a"), F.col("place").alias("b"))


def recurring_runs(segments: DataFrame, width: int, gram: int, shard_bytes: int = SHARD_BYTES, hot_kinds: int = HOT_KINDS, stretch: int = STRETCH) -> DataFrame:
    """anchor, digest, runs: recurring window starts of every distinct segment that has any."""
    ship(segments.sparkSession)
    whole = segments.filter("n > 1").select("anchor", "digest", F.lit(0).alias("a"), (F.octet_length("content") - width).cast("int").alias("b"))
    mixed = segments.filter("kinds > 1").withColumn("place", F.lit(0))
    plain = mixed.filter(F.col("kinds") < hot_kinds).withColumn("deal", F.col("anchor")).select("anchor", "digest", "n", "place", "deal", "content")
    pieces = saved(_stretches(mixed.filter(F.col("kinds") >= hot_kinds), width, gram, stretch), "suffixes-stretches")
    # stretches that many kinds share are down to single windows: these are equal or not, and are counted
    crowded = pieces.groupBy("core").agg(F.count("*").alias("_n")).filter(F.col("_n") >= hot_kinds).drop("_n")
    single = _stretches(pieces.join(crowded, "core", "left_semi"), width, gram, 1)
    dealt = plain.unionByName(pieces.join(crowded, "core", "left_anti").select("anchor", "digest", "n", "place", F.col("core").alias("deal"), "content"))
    total = dealt.agg(F.sum(F.octet_length("content"))).first()[0] or 0
    found = whole.union(_sorted_runs(dealt, width, max(1, -(-total // shard_bytes)))).union(_counted_windows(single))
    return found.groupBy("anchor", "digest").agg(F.collect_list(F.struct("a", "b")).alias("runs"))


_RESULT = "doc_id long, text_key long, n_bytes long, n_removed long, n_spans long, kept binary"
_NAMES = ["doc_id", "text_key", "n_bytes", "n_removed", "n_spans", "kept"]


def _strip(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in A.chunks(batches):
            u = byte_units(part.column("text"))
            out: list[tuple[int, int, int, bytes]] = []
            for i, spans in enumerate(part.column("spans").to_pylist()):
                data = u.data[u.bounds[i] : u.bounds[i + 1]]
                if not spans:
                    out.append((len(data), 0, 0, data.tobytes()))
                    continue
                edge = np.zeros(len(data) + 1, dtype=np.int64)
                np.add.at(edge, [s["a"] for s in spans], 1)
                np.add.at(edge, [s["b"] + width for s in spans], -1)
                gone = np.cumsum(edge)[:-1] > 0
                out.append((len(data), int(gone.sum()), len(A.runs(gone)[0]), data[~gone].tobytes()))
            columns = list(zip(*out)) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("text_key"), *(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.binary())], names=_NAMES)

    return run


def suffix_dedup(docs: DataFrame, width: int = 400) -> DataFrame:
    """Remove every byte covered by a ``width``-byte string that also starts anywhere else.

    One row per document: doc_id, text_key, n_bytes, n_removed, n_spans (maximal
    removed runs), kept (the remaining bytes; a cut may fall inside a character).
    Null counts as empty; every row counts as a document, also rows that repeat
    a doc_id.
    """
    rows = keyed(docs)
    shape = byte_shape(width)
    segments = distinct_segments(rows, shape, "suffixes")
    runs = saved(recurring_runs(segments, width, shape.gram), "suffixes-runs")
    anchors = bitmap_of(runs, "anchor")
    place = lambda x: F.struct((F.col("first") + x["a"]).alias("a"), (F.col("first") + x["b"]).alias("b"))
    hits = occurrences(rows, shape, anchors).join(runs, ["anchor", "digest"]).select("doc_id", "text_key", F.transform("runs", place).alias("spans"))
    spans = saved(hits.groupBy("doc_id", "text_key").agg(F.flatten(F.collect_list("spans")).alias("spans")), "suffixes-spans")
    ids = bitmap_of(spans, "doc_id")

    def sift(keep: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                hit = has(ids.value, batch.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64))
                yield batch.filter(pa.array(hit == keep))

        return run

    kind = "doc_id long, text_key long, text string"
    clean = in_tasks(rows, sift(False), kind)
    clean = clean.select("doc_id", "text_key", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("kept"))
    dirty = in_tasks(rows, sift(True), kind).join(spans, ["doc_id", "text_key"], "left").select("doc_id", "text_key", "text", "spans")
    return clean.unionByName(in_tasks(dirty, _strip(width), _RESULT))


def suffix_digests(docs: DataFrame, width: int = 400) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of ``suffix_dedup``."""
    return suffix_dedup(docs, width).select(real_id(), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
