"""Byte-level texts: the byte-to-character table, and an encoder that sends each distinct piece to the tokenizers library once."""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from . import arrays as A
from .memo import PieceMemo

#: Spaces on which an ASCII split and the tokenizer's differ; texts with them go to the tokenizer whole.
_ODD_SPACE = "[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
#: Bytes of letters up to U+024F, digits and stops: the tail of a piece that needs no word split.
_TAIL = np.zeros(256, dtype=bool)
_TAIL[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789.,;:!?")] = True
_TAIL[0x80:0xC0] = _TAIL[0xC3:0xCA] = True


def _not_plain(data: np.ndarray) -> np.ndarray:
    """Bytes that a piece without word split must not have; the signs U+00D7 and U+00F7 are no letters."""
    out = ~_TAIL[data]
    sign = np.flatnonzero((data[:-1] == 0xC3) & ((data[1:] == 0x97) | (data[1:] == 0xB7)))
    out[sign] = out[sign + 1] = True
    return out


def byte_letters() -> dict[str, int]:
    """Byte of each character of byte-level vocabularies: printable ones stand for themselves, the rest follow from U+0100."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


def joins_kinds(vocabulary: list[str]) -> bool:
    """Does a token of plain bytes join a line break, letters, digits or stops with each other?"""
    letters = byte_letters()
    kind = {b: "d" if 48 <= b <= 57 else "s" if b in b".,;:!?" else "\n" if b == 10 else "l" for b in [*np.flatnonzero(_TAIL).tolist(), 10]}
    for token in vocabulary:
        raw = [letters.get(c, -1) for c in token]
        kinds = {kind.get(b) for b in (raw[1:] if raw[:1] == [32] else raw)}
        if None not in kinds and len(kinds) > 1:
            return True
    return False


def text_encoder(tokenizer, fast, name: str) -> Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]:
    """Encoder of a column of texts (null: empty) into the 32-bit ids of all of them end to end, and each text's bounds.

    The byte-level split never joins a non-space with a following space, so a
    text is the sequence of its ``spaces + word`` pieces, and each distinct piece
    is encoded once.  ``fast`` is the tokenizer without its word split, or None
    where a token joins what the split keeps apart in plain pieces.
    """
    special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    odd = "|".join([_ODD_SPACE, *map(re.escape, special)])
    memo = PieceMemo(tokenizer, name, fast=fast, plain=_not_plain)

    def encode(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        ids, bounds = memo.encode(*A.text_bytes(texts))
        found = np.flatnonzero(pc.fill_null(pc.match_substring_regex(texts, odd), False).to_numpy(zero_copy_only=False))
        if not len(found):
            return ids, bounds
        coded = tokenizer.encode_batch_fast(texts.take(pa.array(found)).to_pylist(), add_special_tokens=False)
        whole = dict(zip(found.tolist(), (np.asarray(e.ids, dtype="<u4") for e in coded)))
        parts = [whole.get(i, ids[bounds[i] : bounds[i + 1]]) for i in range(len(texts))]
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])

    return encode
