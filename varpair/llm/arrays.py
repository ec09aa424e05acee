"""Vectorised text primitives for Arrow tasks: words, rolling hashes, winnowing.

Everything works on the UTF-8 bytes of many texts laid end to end, so a task
never loops over characters.  Hashes are 64-bit polynomials over random byte
values; ``window_hashes`` reads any window off prefix sums.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at a time inside a task (a longer text is one piece of its own).
CHUNK_BYTES = 1 << 19
_MULT = 0x9E3779B97F4A7C15
_U = np.uint64

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


@lru_cache(maxsize=4)
def byte_values(seed: int = 1) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 2**63, size=256, dtype=np.uint64) | _U(1)


@lru_cache(maxsize=4)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    n = 1 << bits
    up = np.full(n, _U(_MULT), dtype=np.uint64)
    down = np.full(n, _U(pow(_MULT, -1, 2**64)), dtype=np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    h = h ^ (h >> _U(30))
    h = h * _U(0xBF58476D1CE4E5B9)
    h = h ^ (h >> _U(27))
    h = h * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """Sums from which the hash of any window of ``values`` is read."""
    up, _ = _powers(max(12, int(len(values)).bit_length()))
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * up[: len(values)], dtype=np.uint64, out=sums[1:])
    return sums


def summed_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Mixed hash of the windows ``starts..ends`` behind ``sums``."""
    _, down = _powers(max(12, int(len(sums) - 1).bit_length()))
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def rolling(sums: np.ndarray, k: int) -> np.ndarray:
    """Unmixed hash of every ``k`` consecutive values (good in its high bits)."""
    n = len(sums) - k
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    _, down = _powers(max(12, int(len(sums) - 1).bit_length()))
    return (sums[k:] - sums[:n]) * down[:n]


def window_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Mixed hash of ``values[starts:ends]`` for many windows at once."""
    return summed_hashes(prefix_sums(values), starts, ends)


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column (null counts as empty) and the offsets of its rows."""
    col = pc.fill_null(col.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(col.buffers()[1], dtype=np.int64)[col.offset : col.offset + len(col) + 1]
    data = np.frombuffer(col.buffers()[2], dtype=np.uint8) if col.buffers()[2] else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = CHUNK_BYTES, rows: int = 4096) -> Iterator[pa.RecordBatch]:
    """The batches cut into pieces of about ``limit`` text bytes and at most ``rows`` rows."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends, at = np.cumsum(sizes), 0
        while at < batch.num_rows:
            base = ends[at - 1] if at else 0
            to = min(max(int(np.searchsorted(ends, base + limit, side="right")), at + 1), at + rows)
            yield batch.slice(at, to - at)
            at = to


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 1) -> np.ndarray:
    """Hash of rising byte spans, block by block: the sums of a long text are never all held at once."""
    table, out, i = byte_values(seed), np.empty(len(starts), dtype=np.uint64), 0
    while i < len(out):
        base = starts[i]
        j = max(int(np.searchsorted(starts, base + CHUNK_BYTES)), i + 1)
        out[i:j] = window_hashes(table[data[base : ends[j - 1]]], starts[i:j] - base, ends[i:j] - base)
        i = j
    return out


class Words:
    """Words (maximal runs of non-separators) of many texts: byte spans and the row of each."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = SPACE):
        inside = ~separators[data]
        first = np.zeros(len(data) + 1, dtype=bool)
        first[offsets] = True
        first = first[:-1]
        begin = inside.copy()
        if len(data):
            begin[1:] &= ~inside[:-1] | first[1:]
        stop = inside.copy()
        if len(data):
            stop[:-1] &= ~inside[1:] | first[1:]
        self.starts = np.flatnonzero(begin)
        self.ends = np.flatnonzero(stop) + 1
        self.row = np.searchsorted(offsets, self.starts, side="right") - 1
        self.counts = np.bincount(self.row, minlength=len(offsets) - 1)
        self.bounds = np.concatenate([[0], np.cumsum(self.counts)])

    def hashes(self, data: np.ndarray, seed: int = 1) -> np.ndarray:
        return span_hashes(data, self.starts, self.ends, seed)

    def windows(self, k: int) -> np.ndarray:
        """Index of the first word of every window of ``k`` words inside one row."""
        n = len(self.starts) - k + 1
        if n <= 0:
            return np.zeros(0, dtype=np.int64)
        return np.flatnonzero(self.row[:n] == self.row[k - 1 :])


def sums_by_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of ``flags`` over each span ``offsets[i]:offsets[i + 1]``."""
    total = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def repeats(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key: does it occur more than once; is this a later occurrence."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    same = np.zeros(len(keys) + 1, dtype=bool)
    same[1:-1] = ordered[1:] == ordered[:-1]
    again, later = np.zeros(len(keys), dtype=bool), np.zeros(len(keys), dtype=bool)
    again[order], later[order] = same[:-1] | same[1:], same[:-1]
    return again, later


def covered(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Positions ``0..n-1`` inside any span ``[start, start + width)``."""
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.minimum(starts + width, n), -1)
    return np.cumsum(edge)[:-1] > 0


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of True."""
    edge = np.diff(np.concatenate([[0], mask.view(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _nearest(values: np.ndarray, at: np.ndarray, width: int, step: int) -> np.ndarray:
    """Position of the nearest smaller value to the left (``step`` -1) or smaller-or-equal to the right (+1), within ``width``."""
    n = len(at)
    found = np.where(step < 0, at - width, at + width)
    live, d = np.arange(n), 0
    while len(live):
        d += step
        live = live[(live + d >= 0) & (live + d < n)]
        live = live[np.abs(at[live + d] - at[live]) < width]
        hit = values[live + d] < values[live] if step < 0 else values[live + d] <= values[live]
        found[live[hit]] = at[live[hit] + d]
        live = live[~hit]
    return found


def _dense_picks(values: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``picks`` over all values, by prefix and suffix minima of blocks of ``width``."""
    n = len(values)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:n] = values
    grid = padded.reshape(blocks, width)
    place = np.arange(blocks * width).reshape(blocks, width)
    prefix = np.minimum.accumulate(grid, axis=1)
    prefix_at = np.maximum.accumulate(np.where(grid == prefix, place, -1), axis=1).ravel()
    back = grid[:, ::-1]
    suffix = np.minimum.accumulate(back, axis=1)
    lower = np.ones_like(back, dtype=bool)
    lower[:, 1:] = back[:, 1:] < suffix[:, :-1]
    suffix_at = np.maximum.accumulate(np.where(lower, np.arange(width)[None, :], -1), axis=1)
    suffix_at = (place[:, -1:] - suffix_at)[:, ::-1].ravel()
    starts = np.arange(n - width + 1)
    left, right = suffix_at[starts], prefix_at[starts + width - 1]
    at = np.where(padded[right] <= padded[left], right, left)
    first = np.flatnonzero(np.diff(at, prepend=-1))
    return at[first], first, np.append(first[1:], len(at)) - 1


def picks(values: np.ndarray, width: int, share: float = 1.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Winnowing: the last smallest value of every ``width`` consecutive ones.

    Returns each picked position with the first and last window start that
    picks it; the start ranges cover every window once.  With ``share`` under 1
    only values in the lowest share of the hash range compete, and windows that
    hold none of them fall back to all their values, so a pick still depends on
    the window's own values alone.
    """
    n = len(values)
    if n < width:
        return (np.zeros(0, dtype=np.int64),) * 3
    if share >= 1:
        return _dense_picks(values, width)
    at = np.flatnonzero(values < _U(int(share * (2**64 - 1))))
    least = values[at]
    first = np.maximum(np.maximum(at - width + 1, _nearest(least, at, width, -1) + 1), 0)
    last = np.minimum(np.minimum(at, _nearest(least, at, width, 1) - width), n - width)
    keep = first <= last
    at, first, last = at[keep], first[keep], last[keep]
    gap_from = np.concatenate([[0], last + 1])
    gap_to = np.concatenate([first - 1, [n - width]])
    parts = [(at, first, last)]
    for a, b in zip(gap_from[gap_from <= gap_to], gap_to[gap_from <= gap_to]):
        p, f, t = picks(values[a : b + width], width)
        parts.append((p + a, f + a, t + a))
    if len(parts) == 1:
        return parts[0]
    at, first, last = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(first, kind="stable")
    return at[order], first[order], last[order]
