"""SentencePiece models on the tokenizers library: parse, rebuild, encode, decode, verify.

The model file is read by its protobuf wire format; normaliser, metaspace
marker, vocabulary with scores and byte fallback are rebuilt as a tokenizers
pipeline.  Unigram models carry their scores over; BPE models get the merges
that their scores imply (a better score is merged earlier).
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arrays as A
from .io import in_tasks
from .memo import PieceMemo

MARK = "▁"
#: Piece types and model types of the protobuf (fixed values of the format).
NORMAL, UNK, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of one protobuf message; fixed-width values stay bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(kind) or varint()
            yield tag >> 3, data[at : at + size]
            at += size


@dataclass
class PieceModel:
    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    model_type: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    add_dummy_prefix: bool = True
    remove_extra_whitespaces: bool = True
    escape_whitespaces: bool = True

    @property
    def unk_id(self) -> int:
        return next((i for i, p in enumerate(self.pieces) if p[2] == UNK), 0)


def parse_model(data: bytes) -> PieceModel:
    model = PieceModel()
    for number, value in _fields(data):
        if number == 1:
            text, score, kind = "", 0.0, NORMAL
            for n, v in _fields(value):
                if n == 1:
                    text = v.decode()
                elif n == 2:
                    score = float(np.frombuffer(v, "<f4")[0])
                elif n == 3:
                    kind = v
            model.pieces.append((text, score, kind))
        elif number == 2:
            for n, v in _fields(value):
                if n == 3:
                    model.model_type = v
                elif n == 35:
                    model.byte_fallback = bool(v)
        elif number == 3:
            for n, v in _fields(value):
                if n == 2:
                    model.charsmap = v
                elif n in (3, 4, 5):
                    setattr(model, {3: "add_dummy_prefix", 4: "remove_extra_whitespaces", 5: "escape_whitespaces"}[n], bool(v))
    return model


def _merges(model: PieceModel) -> list[tuple[str, str]]:
    """Every way to put a piece together from two others, best score first."""
    normal = {p: (score, i) for i, (p, score, kind) in enumerate(model.pieces) if kind in (NORMAL, USER)}
    found = []
    for piece, (score, i) in normal.items():
        for cut in range(1, len(piece)):
            a, b = piece[:cut], piece[cut:]
            if a in normal and b in normal:
                found.append((-score, i, a, b))
    return [(a, b) for _, _, a, b in sorted(found)]


def rebuild(model: PieceModel):
    """A tokenizers.Tokenizer that encodes and decodes like the model."""
    from tokenizers import AddedToken, Tokenizer, decoders, models, normalizers

    if model.model_type == UNIGRAM:
        core = models.Unigram([(p, score) for p, score, _ in model.pieces], unk_id=model.unk_id, byte_fallback=model.byte_fallback)
    elif model.model_type == BPE:
        vocab = {p: i for i, (p, _, _) in enumerate(model.pieces)}
        core = models.BPE(vocab, _merges(model), unk_token=model.pieces[model.unk_id][0], fuse_unk=True, byte_fallback=model.byte_fallback, cache_capacity=200_000)
    else:
        raise ValueError(f"model type {model.model_type} is neither unigram nor BPE")
    tokenizer = Tokenizer(core)
    steps = [normalizers.Precompiled(model.charsmap)] if model.charsmap else []
    if model.remove_extra_whitespaces:
        steps += [normalizers.Strip(), normalizers.Replace(_regex(" {2,}"), " ")]
    if model.add_dummy_prefix:
        steps.append(normalizers.Prepend(" "))
    if model.escape_whitespaces:
        steps.append(normalizers.Replace(" ", MARK))
    tokenizer.normalizer = normalizers.Sequence(steps)
    tokenizer.add_special_tokens([AddedToken(p, special=True, normalized=False) for p, _, kind in model.pieces if kind in (CONTROL, UNK)])
    tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
    back = [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
    tokenizer.decoder = decoders.Sequence(back + ([decoders.Strip(" ", 1, 0)] if model.add_dummy_prefix else []))
    return tokenizer


def _regex(pattern: str):
    from tokenizers import Regex

    return Regex(pattern)


class PieceCodec:
    """Encode and decode texts; text is cut before blanks that follow a non-blank, where no piece reaches across."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.model = parse_model(f.read())
        self.tokenizer = rebuild(self.model)
        inner = any(MARK in p[0].lstrip(MARK) for p in self.model.pieces if p[2] in (NORMAL, USER))
        self.cuttable = not (inner or self.model.charsmap or self.model.remove_extra_whitespaces) and self.model.escape_whitespaces
        if self.cuttable:
            from tokenizers import normalizers

            self.tokenizer.normalizer = normalizers.Replace(" ", MARK)
            blank = np.zeros(256, dtype=bool)
            blank[0x20] = True
            self.memo = PieceMemo(self.tokenizer, path, separators=blank)

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """32-bit ids of each text of a column."""
        if not self.cuttable:
            return [np.asarray(e.ids, dtype="<u4") for e in self.tokenizer.encode_batch_fast([t or "" for t in texts.to_pylist()], add_special_tokens=False)]
        if self.model.add_dummy_prefix:
            filled = pc.fill_null(texts, "")
            texts = pc.if_else(pc.equal(filled, ""), "", pc.binary_join_element_wise("", filled, " "))
        ids, bounds = self.memo.encode(*A.text_bytes(texts))
        return [ids[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]

    def decode(self, ids: list[np.ndarray]) -> list[str]:
        return self.tokenizer.decode_batch([x.tolist() for x in ids], skip_special_tokens=True)


@lru_cache(maxsize=1)
def _codec(path: str) -> PieceCodec:
    return PieceCodec(path)


def piece_tokens(docs: DataFrame, model_path: str, threads: int = 2, with_ids: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids, ids_sha256 (of little-endian 32-bit ids), decoded text, and parity with the sentencepiece library.

    Null text counts as empty (no ids, empty decoded text); repeated rows are
    answered each.  Every document is verified whole, ids and text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "true"
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        import sentencepiece

        codec, library = _codec(model_path), sentencepiece.SentencePieceProcessor(model_file=model_path)
        for part in A.chunks(batches, limit=4 * A.CHUNK_BYTES):
            texts = [t or "" for t in part.column("text").to_pylist()]
            ids = codec.encode(part.column("text"))
            back = codec.decode(ids)
            theirs = library.encode(texts, num_threads=threads)
            agree = [r == i.tolist() and x == b for r, x, i, b in zip(theirs, library.decode(theirs, num_threads=threads), ids, back)]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array([len(i) for i in ids], pa.int64()),
                    pa.array([i.view("<i4") for i in ids] if with_ids else [None] * len(ids), pa.list_(pa.int32())),
                    pa.array([hashlib.sha256(i.tobytes()).hexdigest() for i in ids], pa.string()),
                    pa.array(back, pa.string()),
                    pa.array(agree, pa.bool_()),
                ],
                names=["doc_id", "n_tokens", "ids", "ids_sha256", "decoded", "parity"],
            )

    return in_tasks(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run, "doc_id long, n_tokens long, ids array<int>, ids_sha256 string, decoded string, parity boolean")
