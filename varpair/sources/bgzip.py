"""Lines of a block-gzip file, read by many tasks.

Block gzip is a row of small gzip members that each name their own size, so a
reader can start at any of them.  A partition is a range of compressed bytes:
its task begins with the first block in the range and reads the lines that
begin in its blocks, but for the first one (the task before reads a line beyond
its last block, as with plain text).  Blocks of the next range are read only to
end that line.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..session import ship_package

#: Compressed bytes of one partition.
SPLIT_BYTES = 32 << 20
#: Fixed values of the format: the head of a block, and the most bytes of one.
_MAGIC = b"\x1f\x8b\x08\x04"
_MOST = 1 << 16
_BATCH_LINES = 8192


def open_input(path: str) -> pa.NativeFile:
    """Random access to a local path or to a URI that pyarrow knows."""
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    if "://" not in path:
        return fs.LocalFileSystem().open_input_file(path)
    store, place = fs.FileSystem.from_uri(path)
    return store.open_input_file(place)


def block_size(head: bytes) -> int | None:
    """Whole size of the block that begins here; None if none does."""
    if len(head) < 18 or not head.startswith(_MAGIC):
        return None
    at, end = 12, 12 + struct.unpack_from("<H", head, 10)[0]
    while at + 4 <= min(end, len(head)):
        kind, size = head[at : at + 2], struct.unpack_from("<H", head, at + 2)[0]
        if kind == b"BC" and size == 2 and at + 6 <= len(head):
            return struct.unpack_from("<H", head, at + 4)[0] + 1
        at += 4 + size
    return None


def _content(block: bytes) -> bytes:
    extra = struct.unpack_from("<H", block, 10)[0]
    return zlib.decompress(block[12 + extra : -8], wbits=-15)


def first_block(f: pa.NativeFile, begin: int, size: int) -> int | None:
    """Place of the first block at or after ``begin``: a head whose size leads to another head or to the file's end."""
    if begin == 0:
        return 0
    held = f.read_at(min(2 * _MOST, size - begin), begin)
    at = held.find(_MAGIC)
    while at >= 0:
        length = block_size(held[at : at + 256])
        if length is not None:
            after = begin + at + length
            if after == size or after < size and block_size(f.read_at(min(256, size - after), after)) is not None:
                return begin + at
        at = held.find(_MAGIC, at + 1)
    return None


def blocks(f: pa.NativeFile, at: int, size: int) -> Iterator[tuple[int, bytes]]:
    """Place and content of the blocks from ``at`` to the file's end."""
    while at < size:
        head = f.read_at(min(_MOST, size - at), at)
        length = block_size(head)
        if length is None or length > len(head):
            raise ValueError(f"no whole block at byte {at}")
        yield at, _content(head[:length])
        at += length


def lines_of(f: pa.NativeFile, begin: int, end: int) -> Iterator[list[bytes]]:
    """The lines of one range of compressed bytes."""
    size = f.size()
    at = first_block(f, begin, size)
    if at is None or at >= end:
        return
    skipping, rest = begin > 0, b""
    for place, data in blocks(f, at, size):
        if place >= end:
            if skipping:
                return
            stop = data.find(b"\n")
            rest += data if stop < 0 else data[:stop]
            if stop >= 0:
                yield [rest]
                return
            continue
        if skipping:
            stop = data.find(b"\n")
            if stop < 0:
                continue
            data, skipping = data[stop + 1 :], False
        *whole, rest = (rest + data).split(b"\n")
        if whole:
            yield whole
    if rest:
        yield [rest]


def is_block_gzip(path: str) -> bool:
    """Does this file begin with a block?  False for what pyarrow cannot open."""
    try:
        with open_input(path) as f:
            return block_size(f.read_at(min(256, f.size()), 0)) is not None
    except (OSError, pa.ArrowInvalid):
        return False


@dataclass
class BlockRange(InputPartition):
    begin: int
    end: int


class BlockGzipReader(DataSourceReader):
    def __init__(self, path: str, split_bytes: int):
        self.path, self.split_bytes = path, split_bytes

    def partitions(self) -> list[BlockRange]:
        with open_input(self.path) as f:
            size = f.size()
        return [BlockRange(a, min(a + self.split_bytes, size)) for a in range(0, size, self.split_bytes)]

    def read(self, partition: BlockRange) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([x.removesuffix(b"\r") for x in held], type=pa.binary()).cast(pa.string())], names=["value"])

        with open_input(self.path) as f:
            for lines in lines_of(f, partition.begin, partition.end):
                held += lines
                if len(held) >= _BATCH_LINES:
                    yield batch()
                    held.clear()
        if held:
            yield batch()


class BlockGzipText(DataSource):
    """``spark.read.format("block_gzip_text").load(path)``: one row ``value`` per line."""

    @classmethod
    def name(cls) -> str:
        return "block_gzip_text"

    def schema(self) -> str:
        return "value string"

    def reader(self, schema) -> BlockGzipReader:
        return BlockGzipReader(self.options["path"], int(self.options.get("splitbytes", SPLIT_BYTES)))


def read_block_gzip(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Lines of a block-gzip file; about one task for every ``split_bytes`` compressed bytes."""
    ship_package(spark)
    spark.dataSource.register(BlockGzipText)
    return spark.read.format("block_gzip_text").option("splitBytes", str(split_bytes)).load(path)
