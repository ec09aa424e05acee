"""Byte-level BPE by a rank file: ids, character offsets and decoding, in Arrow batches with the tokenizers library.

A rank file lists the bytes of every token, the least rank merged first.  The
tokenizer is rebuilt from it: bytes become the printable characters of
byte-level vocabularies, and every way to join two tokens to a third is a merge
of the third's rank.  Decoding goes back through the byte table, so it is exact
for any ids; a character cut by the ids' ends becomes U+FFFD in text.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arrays as A
from .bytelevel import byte_letters, joins_kinds, text_encoder
from .io import in_tasks

_SCHEMA = "doc_id long, n_tokens long, n_split long, ids array<int>, starts array<int>, ends array<int>, ids_sha256 string, decoded_sha256 string"


def read_ranks(path: str) -> list[bytes]:
    """Bytes of every token, in the order of rank."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    ranks = {int(rank): base64.b64decode(token) for token, rank in pairs}
    if sorted(ranks) != list(range(len(ranks))):
        raise ValueError("ranks must be 0, 1, 2, ... without gaps")
    return [ranks[i] for i in range(len(ranks))]


def merges(tokens: list[bytes]) -> list[tuple[bytes, bytes]]:
    """Every pair of tokens that makes a token, in the order of the made token's rank."""
    rank = {t: i for i, t in enumerate(tokens)}
    return [(t[:at], t[at:]) for t in tokens for at in range(1, len(t)) if t[:at] in rank and t[at:] in rank]


@lru_cache(maxsize=2)
def tokenizers_of(path: str):
    """Tokenizer of a rank file, and the same without its word split where plain pieces do not need it (else None)."""
    from tokenizers import Tokenizer, models, pre_tokenizers

    letter = {b: c for c, b in byte_letters().items()}
    written = lambda token: "".join(map(letter.__getitem__, token))
    tokens = read_ranks(path)
    vocabulary = {written(t): i for i, t in enumerate(tokens)}
    pairs = [(written(a), written(b)) for a, b in merges(tokens)]
    out = []
    for split in (True, False):
        tokenizer = Tokenizer(models.BPE(vocabulary, pairs))
        tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=split)
        out.append(tokenizer)
    return out[0], None if joins_kinds(list(vocabulary)) else out[1]


class Table:
    """Rows of bytes, one for each id, that are laid end to end for many ids at once."""

    def __init__(self, rows: list[bytes]):
        self.sizes = np.fromiter(map(len, rows), dtype=np.int64, count=len(rows))
        self.data = np.frombuffer(b"".join(rows), dtype=np.uint8)
        self.begins = np.cumsum(self.sizes) - self.sizes

    def spell(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all ids, and the place where each id's begin (one more: the end)."""
        sizes = self.sizes[ids]
        at = np.zeros(len(ids) + 1, dtype=np.int64)
        np.cumsum(sizes, out=at[1:])
        return self.data[np.repeat(self.begins[ids] - at[:-1], sizes) + np.arange(at[-1])], at


@lru_cache(maxsize=2)
def tables_of(path: str) -> tuple[Table, Table]:
    """Token bytes by id, and decimal digits with one space by id."""
    tokens = read_ranks(path)
    return Table(tokens), Table([b"%d " % i for i in range(len(tokens))])


def character_offsets(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First character, end character and ``split`` of every token, the characters counted through all of ``data``.

    A token that holds a part of a character covers the whole of it.  ``split``:
    the token begins or ends inside a character.
    """
    inside = np.zeros(len(data) + 1, dtype=bool)
    inside[:-1] = (data & 0xC0) == 0x80
    before = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(~inside[:-1], out=before[1:])
    starts, ends = at[:-1], at[1:]
    return before[starts] - inside[starts], before[ends], inside[starts] | inside[ends]


def _digests(data: np.ndarray, bounds: np.ndarray, cut: int = 0) -> list[str]:
    raw = memoryview(np.ascontiguousarray(data))
    return [hashlib.sha256(raw[a : max(a, b - cut)]).hexdigest() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]


def encoded(docs: DataFrame, ranks_path: str, with_ids: bool = True) -> DataFrame:
    """One row per document: doc_id, n_tokens, n_split, ids, starts, ends, ids_sha256, decoded_sha256.

    ``starts`` and ``ends`` are character offsets of each id in the text, and
    ``n_split`` counts ids that begin or end inside a character.  The digests
    are of the decimal ids joined by one space, and of the bytes that the ids
    decode to.  Null text counts as empty; repeated rows are answered each; a
    null doc_id stays null; other columns are not read.  Without ``with_ids``
    the three arrays are null.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, fast = tokenizers_of(ranks_path)
        encode = text_encoder(tokenizer, fast, ranks_path)
        spelled, decimal = tables_of(ranks_path)
        for part in A.chunks(batches, limit=2 * A.CHUNK_BYTES):
            ids, bounds = encode(part.column("text"))
            data, at = spelled.spell(ids)
            starts, ends, split = character_offsets(data, at)
            digits, digit_at = decimal.spell(ids)
            counts = np.diff(bounds)
            n_split = np.diff(np.concatenate([[0], np.cumsum(split)])[bounds])
            lists = [pa.nulls(len(counts), pa.list_(pa.int32()))] * 3
            if with_ids:
                first = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[at[bounds[:-1]]]
                base = np.repeat(first, counts)
                offsets = pa.array(bounds, type=pa.int32())
                lists = [pa.ListArray.from_arrays(offsets, pa.array(x, type=pa.int32())) for x in (ids.view("<i4"), starts - base, ends - base)]
            columns = [part.column("doc_id"), pa.array(counts, type=pa.int64()), pa.array(n_split, type=pa.int64()), *lists, pa.array(_digests(digits, digit_at[bounds], cut=1), type=pa.string()), pa.array(_digests(data, at[bounds]), type=pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "n_split", "ids", "starts", "ends", "ids_sha256", "decoded_sha256"])

    return in_tasks(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run, _SCHEMA)


def decoded(rows: DataFrame, ranks_path: str, ids: str = "ids") -> DataFrame:
    """The rows with ``decoded_bytes`` and ``decoded_text`` of a column of ids; null ids count as none.

    Any slice of a document's ids can be given: bytes of a character whose rest
    is missing are kept in ``decoded_bytes`` and become U+FFFD in
    ``decoded_text``.  An id that the file does not have raises ValueError.
    Columns of these two names are replaced.
    """
    spare = [c for c in rows.columns if c not in ("decoded_bytes", "decoded_text")]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*[f"`{c}`" for c in spare]).schema), "decoded_bytes binary", "decoded_text string"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spelled = tables_of(ranks_path)[0]
        for batch in batches:
            for from_row in range(0, batch.num_rows, 256):
                part = batch.slice(from_row, 256)
                lists = part.column(ids)
                counts = np.array([len(x) if x.is_valid else 0 for x in lists], dtype=np.int64)
                flat = np.asarray(lists.flatten().to_numpy(zero_copy_only=False), dtype=np.int64)
                if len(flat) and not (0 <= flat.min() and flat.max() < len(spelled.sizes)):
                    raise ValueError(f"ids outside 0..{len(spelled.sizes) - 1}")
                data, at = spelled.spell(flat)
                ends = at[np.cumsum(counts)] if len(counts) else counts
                raw = data.tobytes()
                found = [raw[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in spare), pa.array(found, type=pa.binary()), pa.array([x.decode(errors="replace") for x in found], type=pa.string())], names=[*spare, "decoded_bytes", "decoded_text"])

    return in_tasks(rows.select(*[f"`{c}`" for c in spare]), run, schema)
