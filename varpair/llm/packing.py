"""Packing by power-of-two decomposition.

A document's ids are cut into pieces whose lengths are powers of two, longest
first; a sequence is one piece, so no sequence crosses documents, none is
padded, and sequences of equal length form the buckets that batches are drawn
from.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arrays as A
from .bytelevel import joins_kinds, text_encoder
from .io import in_tasks

MAX_LENGTH = 1024
_SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids array<int>"


@lru_cache(maxsize=1)
def _tokenizers(path: str):
    """The tokenizer, and one without its word split if no token joins what the split keeps apart in plain pieces."""
    from tokenizers import Tokenizer, pre_tokenizers

    tokenizer, fast = Tokenizer.from_file(path), Tokenizer.from_file(path)
    fast.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    return tokenizer, None if joins_kinds(list(tokenizer.get_vocab())) else fast


def byte_bpe_encoder(path: str) -> Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]:
    """Encoder of a column of texts with the tokenizers library: all ids end to end and each text's bounds."""
    tokenizer, fast = _tokenizers(path)
    return text_encoder(tokenizer, fast, path)


def piece_table(totals: np.ndarray, longest: int = MAX_LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Document (by place) and length of every piece of documents of these lengths, in order."""
    bits = np.arange(longest.bit_length() - 2, -1, -1)
    counts = np.concatenate([(totals // longest)[:, None], (totals % longest)[:, None] >> bits & 1], axis=1)
    lengths = np.broadcast_to(np.concatenate([[longest], 1 << bits]), counts.shape)
    return np.repeat(np.arange(len(totals)), counts.sum(axis=1)), np.repeat(lengths.ravel(), counts.ravel())


def packed_pieces(docs: DataFrame, tokenizer_path: str, end_id: int = 0, longest: int = MAX_LENGTH, with_ids: bool = True) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, ids, sequence_id, offset.

    Null text counts as empty: its only id is ``end_id``.  Repeated rows are
    documents of their own.  ``longest`` must be a power of two.  A piece is a
    sequence by itself (``offset`` 0); ``length`` is the bucket.
    """
    if longest & (longest - 1) or longest < 1:
        raise ValueError("longest must be a power of two")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = byte_bpe_encoder(tokenizer_path)
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"]
        for part in A.chunks(batches, limit=2 * A.CHUNK_BYTES):
            coded, bounds = encode(part.column("text"))
            ids = np.insert(coded, bounds[1:], end_id).astype("<u4", copy=False)
            bounds = bounds + np.arange(len(bounds))
            totals = np.diff(bounds)
            doc, lengths = piece_table(totals, longest)
            ends = np.cumsum(lengths)
            starts = ends - lengths
            raw = memoryview(ids).cast("B")
            crcs = [zlib.crc32(raw[a:b]) for a, b in zip((4 * starts).tolist(), (4 * ends).tolist())]
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, ends), type=pa.int32()), pa.array(ids.view("<i4"))) if with_ids else pa.nulls(len(doc), pa.list_(pa.int32()))
            numbers = [pa.array(x, type=pa.int64()) for x in (starts - bounds[doc], lengths, crcs, totals[doc])]
            yield pa.RecordBatch.from_arrays([part.column("doc_id").take(pa.array(doc)), *numbers, lists], names=names)

    rows = in_tasks(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), pack, _SCHEMA)
    return rows.select("*", F.monotonically_increasing_id().alias("sequence_id"), F.lit(0).cast("long").alias("offset"))


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Sequences as Parquet, one folder per length: a batch reads from a single one."""
    pieces.write.partitionBy("length").parquet(path)
