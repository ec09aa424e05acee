"""Block-gzip files: every split gives the lines of a single read, once."""

import gzip
import random
import struct
import zlib

import pytest
from pyspark.sql import functions as F

from varpair.sources import bgzip
from varpair.sources.readers import read_vcf


def block(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = packer.compress(data) + packer.flush()
    head = b"\x1f\x8b\x08\x04" + bytes(4) + b"\x00\xff" + struct.pack("<H", 6) + b"BC" + struct.pack("<HH", 2, len(body) + 25)
    return head + body + struct.pack("<II", zlib.crc32(data), len(data))


def write(path, text: bytes, cuts, end=True):
    parts = [text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)])]
    path.write_bytes(b"".join(map(block, parts)) + (block(b"") if end else b""))
    assert gzip.open(path).read() == text
    return str(path)


def vcf(n, seed=1):
    rng = random.Random(seed)
    head = ["##fileformat=VCFv4.2", "##INFO=<ID=FUNCOTATION,Number=A,Type=String,Description=\"Fields are: a|b|c " + "x" * 3000 + "\">", "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tS1"]
    rows = [f"chr{rng.randint(1, 22)}\t{i}\t.\tA\tC\t9\tPASS\tFUNCOTATION=[{'é' * rng.randint(0, 200)}|{rng.random()}]\tGT\t0/1" for i in range(n)]
    return "\n".join(head + rows).encode()


@pytest.mark.parametrize("tail", [b"\n", b"", b"\n\n"])
def test_every_split_reads_every_line_once(tmp_path, tail):
    text = vcf(400) + tail
    rng = random.Random(3)
    newlines = [i + 1 for i, c in enumerate(text) if c == 10]
    # blocks that end at a line's end, inside lines, inside a character, and inside the long header
    cuts = sorted({*rng.sample(newlines, 20), *rng.sample(range(1, len(text)), 60), 1500, 1501})
    path = write(tmp_path / "a.vcf.gz", text, [c for c in cuts if c < len(text)])
    want = text.split(b"\n")
    want = want[:-1] if not want[-1] else want
    with bgzip.open_input(path) as f:
        size = f.size()
        for split in (1, 37, 500, 4096, 20_000, size, 10 * size):
            ends = range(0, size, split) if split > 1 else sorted(rng.sample(range(size), 300)) + [size]
            bounds = [0, *[e for e in ends if e], size] if split == 1 else [*ends, size]
            found = [line for a, b in zip(bounds, bounds[1:]) for part in bgzip.lines_of(f, a, b) for line in part]
            assert found == want, split


def test_one_line_longer_than_many_blocks(tmp_path):
    text = b"first\n" + b"x" * 300_000 + b"\nlast"
    path = write(tmp_path / "long.gz", text, range(50_000, 300_000, 50_000), end=False)
    with bgzip.open_input(path) as f:
        bounds = [*range(0, f.size(), 100), f.size()]
        assert [x for a, b in zip(bounds, bounds[1:]) for part in bgzip.lines_of(f, a, b) for x in part] == text.split(b"\n")


def test_vcf_is_read_by_many_tasks(spark, tmp_path):
    text = vcf(3000)
    path = write(tmp_path / "s.vcf.gz", text, range(3000, len(text), 3000))
    lines = bgzip.read_block_gzip(spark, path, split_bytes=8 << 10)
    tasks = lines.select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks >= 4
    assert sorted(r["value"] for r in lines.collect()) == sorted(text.decode().split("\n"))
    header, body = read_vcf(spark, path, "host", split_bytes=8 << 10)
    assert header.count() == 2 and body.columns[-1] == "host" and body.columns[0] == "CHROM"
    one = tmp_path / "one.vcf.gz"
    one.write_bytes(gzip.compress(text))
    assert not bgzip.is_block_gzip(str(one)) and not bgzip.is_block_gzip(str(tmp_path / "none"))
    same = read_vcf(spark, str(one), "host")[1]
    assert sorted(map(tuple, body.collect())) == sorted(map(tuple, same.collect()))


def test_damaged_file_is_an_error(tmp_path):
    path = tmp_path / "cut.gz"
    path.write_bytes(block(b"whole\n") + block(b"cut\n")[:-9])
    with bgzip.open_input(str(path)) as f, pytest.raises(ValueError, match="no whole block"):
        list(bgzip.lines_of(f, 0, f.size()))
    (tmp_path / "empty.gz").write_bytes(b"")
    assert not bgzip.is_block_gzip(str(tmp_path / "empty.gz"))
