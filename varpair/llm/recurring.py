"""Recurring windows of words or bytes: anchors, distinct segments, and small membership bitmaps.

A window of ``width`` units picks an anchor inside itself by winnowing (the last
smallest hash of its ``gram``-unit substrings), so equal windows pick equal
anchors at the same place.  The windows of one text that share a pick form a
segment: ``first..last`` window starts and the units they cover.  Only segments
whose anchor is found more than once can hold a recurring window; equal segments
are counted together before anything is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arrays as A
from .io import in_tasks, saved

#: Bits of a membership bitmap: 16 MB whatever the data; a full bitmap only filters less.
BITMAP_BITS = 1 << 27
#: Bits of one row of Spark's bitmap functions (fixed by Spark).
_ROW_BITS = 32768


@dataclass
class Units:
    """Unit values of many texts end to end, their bounds by row, and the bytes span of each unit."""

    values: np.ndarray
    bounds: np.ndarray
    data: np.ndarray
    starts: np.ndarray | None = None
    ends: np.ndarray | None = None

    def text(self, a: int, b: int) -> bytes:
        """Units ``a..b`` as bytes; words are joined by one blank."""
        if self.starts is None:
            return self.data[a:b].tobytes()
        return b" ".join(self.data[s:e].tobytes() for s, e in zip(self.starts[a:b].tolist(), self.ends[a:b].tolist()))


def word_units(col: pa.Array) -> Units:
    data, offsets = A.text_bytes(col)
    words = A.Words(data, offsets)
    return Units(words.hashes(data), words.bounds, data, words.starts, words.ends)


def byte_units(col: pa.Array) -> Units:
    data, offsets = A.text_bytes(col)
    return Units(A.byte_values()[data], offsets, data)


@dataclass
class Shape:
    """What to look for: units, window width, anchor substring length, share of hashes that may be anchors."""

    units: Callable[[pa.Array], Units]
    width: int
    gram: int
    share: float

    def segments(self, u: Units) -> dict[str, np.ndarray]:
        """row, anchor, digest, first and last (window starts inside the row) of every segment."""
        sums = A.prefix_sums(u.values)
        grams = A.rolling(sums, self.gram)
        span = self.width - self.gram + 1
        pick, first, last = A.picks(grams, span, self.share)
        # windows that cross texts are cut off again
        row = np.searchsorted(u.bounds, pick, side="right") - 1
        first, last = np.maximum(first, u.bounds[row]), np.minimum(last, u.bounds[row + 1] - self.width)
        keep = first <= last
        pick, first, last, row = pick[keep], first[keep], last[keep], row[keep]
        digest = A.mix(A.summed_hashes(sums, first, last + self.width) ^ A.mix((pick - first).astype(np.uint64)))
        base = u.bounds[row]
        return {"row": row, "anchor": A.mix(grams[pick]).view(np.int64), "digest": digest.view(np.int64), "first": first - base, "last": last - base}


def _bit(values: np.ndarray) -> np.ndarray:
    return (A.mix(values.view(np.uint64)) & np.uint64(BITMAP_BITS - 1)).astype(np.int64)


def has(bitmap: np.ndarray | None, values: np.ndarray) -> np.ndarray:
    """May the bitmap hold these 64-bit values?"""
    if bitmap is None:
        return np.ones(len(values), dtype=bool)
    bit = _bit(values)
    return (bitmap[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1


def bitmap_of(df: DataFrame, column: str) -> Broadcast:
    """Broadcast bitmap of a long column: OR-merged in tasks, ``BITMAP_BITS / 8`` bytes at most."""

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(_bit(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64))))], names=["bit"])

    rows = in_tasks(df.select(F.col(column).cast("long")), bits, "bit long")
    parts = rows.groupBy(F.floor(F.col("bit") / _ROW_BITS).alias("part")).agg(F.bitmap_construct_agg((F.col("bit") % _ROW_BITS).cast("long")).alias("bits")).toArrow()
    out = np.zeros(BITMAP_BITS // 8, dtype=np.uint8)
    for part, raw in zip(parts["part"].to_pylist(), parts["bits"].to_pylist()):
        out[part * _ROW_BITS // 8 : (part + 1) * _ROW_BITS // 8] = np.frombuffer(raw, dtype=np.uint8)
    return df.sparkSession.sparkContext.broadcast(out)


def may_hold(rows: DataFrame, ids: Broadcast) -> DataFrame:
    """doc_id, text_key, text of the rows whose doc_id may be in the bitmap; leaves out most others before a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(has(ids.value, batch.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64))))

    return in_tasks(rows.select("doc_id", "text_key", "text"), run, "doc_id long, text_key long, text string")


def anchor_counts(rows: DataFrame, shape: Shape) -> DataFrame:
    """anchor, n of every anchor found more than once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in A.chunks(batches, limit=2 * A.CHUNK_BYTES):
            anchors, n = np.unique(shape.segments(shape.units(part.column("text")))["anchor"], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(anchors), pa.array(n)], names=["anchor", "n"])

    return in_tasks(rows.select("text"), run, "anchor long, n long").groupBy("anchor").agg(F.sum("n").alias("n")).filter("n > 1")


def occurrences(rows: DataFrame, shape: Shape, anchors: Broadcast) -> DataFrame:
    """anchor, digest, doc_id, text_key, first, last of the segments whose anchor may be in the bitmap."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in A.chunks(batches):
            s = shape.segments(shape.units(part.column("text")))
            keep = has(anchors.value, s["anchor"])
            row = pa.array(s["row"][keep])
            yield pa.RecordBatch.from_arrays(
                [pa.array(s["anchor"][keep]), pa.array(s["digest"][keep]), part.column("doc_id").take(row), part.column("text_key").take(row), pa.array(s["first"][keep].astype(np.int32)), pa.array(s["last"][keep].astype(np.int32))],
                names=["anchor", "digest", "doc_id", "text_key", "first", "last"],
            )

    return in_tasks(rows, run, "anchor long, digest long, doc_id long, text_key long, first int, last int")


def distinct_segments(rows: DataFrame, shape: Shape, name: str) -> DataFrame:
    """Distinct segments under anchors found more than once: anchor, digest, n (occurrences), kinds (distinct segments of the anchor), content.

    ``content`` comes from the smallest (doc_id, text_key, first) that holds the segment.
    """
    counted = saved(anchor_counts(rows, shape), f"{name}-anchors")
    rows = rows.select("doc_id", "text_key", "text")
    found = occurrences(rows, shape, bitmap_of(counted, "anchor"))
    kinds = found.groupBy("anchor", "digest").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "text_key", "first", "last")).alias("at"))
    kinds = saved(kinds, f"{name}-kinds")
    total = kinds.groupBy("anchor").agg(F.sum("n").alias("total"), F.count("*").alias("kinds")).filter("total > 1").drop("total")
    needed = saved(kinds.join(total, "anchor").select("anchor", "digest", "n", "kinds", "at.*"), f"{name}-needed")
    texts = may_hold(rows, bitmap_of(needed, "doc_id")).dropDuplicates(["doc_id", "text_key"])
    wanted = needed.groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("anchor", "digest", "n", "kinds", "first", "last")).alias("segments"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in A.chunks(batches):
            u = shape.units(part.column("text"))
            lists = part.column("segments")
            flat = lists.flatten()
            row = np.repeat(np.arange(part.num_rows), lists.value_lengths().to_numpy())
            base = u.bounds[row]
            first, last = (flat.field(c).to_numpy() for c in ("first", "last"))
            content = [u.text(int(a), int(b)) for a, b in zip(base + first, base + last + shape.width)]
            yield pa.RecordBatch.from_arrays([*(flat.field(c) for c in ("anchor", "digest", "n", "kinds")), pa.array(content, pa.binary())], names=["anchor", "digest", "n", "kinds", "content"])

    held = texts.join(wanted, ["doc_id", "text_key"]).select("text", "segments")
    return saved(in_tasks(held, cut, "anchor long, digest long, n long, kinds long, content binary"), f"{name}-segments")
