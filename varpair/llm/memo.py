"""Ids of the distinct pieces of many texts, encoded in blocks and remembered for the life of a Python worker."""

from __future__ import annotations

from collections.abc import Callable
from itertools import islice

import numpy as np

from . import arrays as A

SEPARATOR = "\0"
#: Known pieces by tokenizer; tasks that run later in the same Python worker find them again.
_KNOWN: dict[str, dict[bytes, bytes]] = {}


def _apart(piece: str) -> bool:
    """Is this piece blank, or does it begin with neither a blank nor a letter or digit?"""
    return not piece.strip() or not (piece[0].isspace() or piece[0].isalnum())


class PieceMemo:
    """32-bit ids of texts whose ``separators + word`` pieces a tokenizer encodes independently of each other.

    New pieces are encoded many at a time, a NUL between them, if the vocabulary
    has exactly one token with NUL (so none reaches across).  A piece that begins
    with a sign is encoded alone: after a NUL the word split would join the sign
    to it (``'s`` is no contraction then).  Pieces without a byte
    that ``plain`` flags, but for one leading blank or line break, may go to a
    ``fast`` tokenizer that agrees on them.
    """

    def __init__(self, tokenizer, name: str, separators: np.ndarray = A.SPACE, fast=None, plain: Callable[[np.ndarray], np.ndarray] | None = None, limit: int = 500_000, block: int = 200):
        self.tokenizer, self.fast, self.plain = tokenizer, fast, plain
        self.separators, self.limit, self.block = separators, limit, block
        self.known: dict[bytes, bytes] = _KNOWN.setdefault(name, {})
        ids = tokenizer.encode(SEPARATOR, add_special_tokens=False).ids
        mark = tokenizer.id_to_token(ids[0]) if len(ids) == 1 else None
        self.mark = ids[0] if mark and sum(mark in t for t in tokenizer.get_vocab()) == 1 else None

    def _ids(self, tokenizer, texts: list[str]) -> list[np.ndarray]:
        return [np.asarray(e.ids, dtype="<u4") for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, new: list[bytes], plain: list[bool]) -> None:
        fast = [p for p, x in zip(new, plain) if x]
        rest = [p for p, x in zip(new, plain) if not x]
        alone = [p for p in rest if self.mark is None or b"\0" in p or _apart(p.decode())]
        if alone:
            self.known.update(zip(alone, (x.tobytes() for x in self._ids(self.tokenizer, [p.decode() for p in alone]))))
            rest = [p for p in rest if p not in self.known]
        for tokenizer, todo in ((self.fast, fast), (self.tokenizer, rest)):
            groups = [todo[i : i + self.block] for i in range(0, len(todo), self.block)]
            if not groups:
                continue
            for group, ids in zip(groups, self._ids(tokenizer, [(b"\0".join(g) + b"\0").decode() for g in groups])):
                ends = np.flatnonzero(ids == self.mark) * 4
                raw = ids.tobytes()
                self.known.update(zip(group, map(raw.__getitem__, map(slice, [0, *(ends[:-1] + 4).tolist()], ends.tolist()))))

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and the bounds of each text in them."""
        words = A.Words(data, offsets, self.separators)
        n = len(offsets) - 1
        first = np.zeros(len(words.starts), dtype=bool)
        first[words.bounds[:-1][words.counts > 0]] = True
        starts = np.where(first, offsets[words.row], np.concatenate([[0], words.ends[:-1]]) if len(words.ends) else 0)
        # blanks that end a text are a piece of their own
        last = np.where(words.counts > 0, words.ends[np.maximum(words.bounds[1:] - 1, 0)] if len(words.ends) else 0, offsets[:-1])
        tail = np.flatnonzero(last < offsets[1:])
        starts, ends, row = np.concatenate([starts, last[tail]]), np.concatenate([words.ends, offsets[1:][tail]]), np.concatenate([words.row, tail])
        order = np.argsort(starts, kind="stable") if len(tail) else slice(None)
        starts, ends, row = starts[order], ends[order], row[order]
        hashes = A.span_hashes(data, starts, ends)
        _, where, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        raw = data.tobytes()
        starts, ends = starts[where], ends[where]
        pieces = [raw[s:e] for s, e in zip(starts.tolist(), ends.tolist())]
        known = self.known
        new = [i for i, p in enumerate(pieces) if p not in known]
        if new:
            plain = np.zeros(len(new), dtype=bool)
            if self.fast is not None and self.mark is not None:
                odd = np.zeros(len(data) + 1, dtype=np.int64)
                np.cumsum(self.plain(data), out=odd[1:])
                lead = np.isin(data[starts[new]], (0x20, 0x0A))
                plain = (odd[ends[new]] == odd[starts[new] + lead]) & (ends[new] - starts[new] > lead)
            self._learn([pieces[i] for i in new], plain.tolist())
        coded = [known[p] for p in pieces]
        size = np.fromiter(map(len, coded), dtype=np.int64, count=len(coded)) // 4
        flat = np.frombuffer(b"".join(coded), dtype="<u4")
        begin = np.cumsum(size) - size
        length = size[inverse]
        at = np.cumsum(length) - length
        ids = flat[np.repeat(begin[inverse] - at, length) + np.arange(int(length.sum()))]
        per_row = np.bincount(row, weights=length, minlength=n).astype(np.int64)
        if len(known) > self.limit:
            kept = list(islice(known.items(), self.limit // 2, None))
            known.clear()
            known.update(kept)
        return ids, np.concatenate([[0], np.cumsum(per_row)])
