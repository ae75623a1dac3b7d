"""BAM read in parts and by region, and sorted files with their indexes."""

import functools
import gzip
import random
import struct

import pytest
from pyspark.sql import functions as F

from readloom.operators import names as N
from readloom.sources import bam as B

REFS = [("chr2", 200_000), ("chr10", 5_000_000), ("chr1", 90_000)]


def made(r, n, longest=150):
    rows = []
    for i in range(n):
        size = r.randint(1, longest) if r.random() < 0.95 else r.randint(1, 40 * longest)
        ref, length = r.choice(REFS)
        placed = r.random() < 0.95
        cigar = f"{size}M" if r.random() < 0.6 or size < 9 else f"3S{size - 7}M2D2M{r.randint(1, 3000)}N2M"
        inside = B.record_bytes(("x" * 5, 0, "chr1", 7, 9, "*", None, -1, 0, "ACGT" * 9, "*", False, {}, {}), {"chr1": 2})  # a record in a tag
        tags = {"CB": "".join(r.choice("ACGT") for _ in range(8)), "NH": str(r.randint(1, 9))} | ({"XX": inside.hex(), "XB": "1,-2,30000"} if i % 7 == 0 else {})
        kinds = {"CB": "Z", "NH": "i"} | ({"XX": "H", "XB": "Bs"} if i % 7 == 0 else {})
        rows.append((f"read{r.randint(0, 10**6)}:{i}", 64 if placed else 4, ref if placed else None, r.randrange(length) if placed else -1, 60, cigar if placed else "*", None, -1, 0, "".join(r.choice("ACGTN") for _ in range(size)), "".join(chr(33 + r.randint(0, 40)) for _ in range(size)), placed, tags, kinds))
    return rows


def write(path, rows, level=None):
    """Blocks of any size, so that records lie over their borders."""
    raw = B.header_bytes(B.bam_header(REFS), REFS) + b"".join(B.record_bytes(x, {n: i for i, (n, _) in enumerate(REFS)}) for x in rows)
    r, out, at = random.Random(3), [], 0
    while at < len(raw):
        n = r.choice([1, 40, 500, 9000, 60_000])
        out += B.deflated(raw[at : at + n])
        if r.random() < 0.05:
            out.append(B.END)  # an empty block inside
        at += n
    path.write_bytes(b"".join(out) + B.END)


@pytest.mark.parametrize("longest", [3, 150, 3000])
def test_any_split_gives_the_same_records(tmp_path, longest):
    rows = made(random.Random(longest), 400, longest)
    write(tmp_path / "a.bam", rows)
    size = (tmp_path / "a.bam").stat().st_size
    with B.open_seekable(str(tmp_path / "a.bam")) as f:
        whole = list(B.located_records(f, size, 0, size))
        assert [x for _, x in whole] == rows and len({v for v, _ in whole}) == len(rows)
        for split in (97, 1000, 4096, 30_001, size):
            assert [x for lo in range(0, size, split) for x in B.located_records(f, size, lo, lo + split)] == whole


def test_split_files_in_spark(spark, tmp_path):
    rows = made(random.Random(1), 3000)
    write(tmp_path / "a.bam", rows)
    write(tmp_path / "b.bam", rows[:5])
    write(tmp_path / "none.bam", [])
    d = B.read_bam(spark, str(tmp_path), split=20_000)
    assert d.rdd.getNumPartitions() > 10
    assert sorted(r.qname for r in d.collect()) == sorted(x[0] for x in rows + rows[:5])
    raw = (tmp_path / "a.bam").read_bytes()
    (tmp_path / "cut").mkdir()
    (tmp_path / "cut" / "c.bam").write_bytes(raw[: len(raw) // 2])
    with pytest.raises(Exception, match="cut short|BGZF"):
        B.read_bam(spark, str(tmp_path / "cut"), split=20_000).count()
    bad = bytearray(raw)
    bad[len(raw) // 2] ^= 1
    (tmp_path / "cut" / "c.bam").write_bytes(bytes(bad))
    with pytest.raises(Exception):
        B.read_bam(spark, str(tmp_path / "cut"), split=1 << 30).count()


def test_sorted_files_and_regions(spark, tmp_path, monkeypatch):
    rows = made(random.Random(2), 6000)
    names = B._NAMES
    d = spark.createDataFrame(rows, B.SCHEMA).repartition(5)
    done = B.write_bam(d, str(tmp_path / "all"), REFS, coordinate=True)
    back = [tuple(r) for f in sorted(done.collect()) for r in B.read_bam(spark, str(tmp_path / "all" / f"{f.file}.bam")).collect()]
    number = {n: i for i, (n, _) in enumerate(REFS)}
    assert back == sorted(rows, key=lambda x: (number.get(x[2], 99), x[3], x[0], x[1]))
    one = B.write_bam(d.withColumn("b", F.lit("one")), f"file://{tmp_path}/one", REFS, by="b", coordinate=True)
    assert one.count() == 1
    assert gzip.decompress((tmp_path / "one" / "one.bam").read_bytes())[4:].split(b"\n")[0].endswith(b"SO:coordinate")
    raw = (tmp_path / "one" / "one.bam.bai").read_bytes()
    assert raw[:8] == b"BAI\1" + struct.pack("<i", 3) and struct.unpack("<Q", raw[-8:])[0] == sum(x[2] is None for x in rows)
    r = random.Random(9)
    for folder in ("all", "one"):
        for split in (500, 1 << 26):
            ref, length = r.choice(REFS)
            a = r.randrange(length)
            b = a + r.choice([1, 100, 20_000, length])
            want = sorted(x[0] for x in rows if x[2] == ref and x[3] < b and B.covered_end(x[3], x[5]) > a)
            assert sorted(x.qname for x in B.read_region(spark, ref, a, b, str(tmp_path / folder), split=split).collect()) == want
    assert B.read_region(spark, "chrX", 0, 9, str(tmp_path / "one")).count() == 0
    read = []
    monkeypatch.setattr(B, "contents", lambda x, f=B.contents: read.append(1) or f(x))
    path = str(tmp_path / "one" / "one.bam")
    with B.open_seekable(path) as f:
        total = sum(1 for _ in B.blocks(f))
        for ref, length in REFS:
            for _ in range(60):
                a = r.randrange(length)
                b = a + r.choice([1, 300, 5000])
                del read[:]
                got = [x for piece in B.pieces_of(path, ref, a, b, 1 << 20) for x in B.region_records(f, piece, ref, a, b)]
                assert sorted(x[0] for x in got) == sorted(x[0] for x in rows if x[2] == ref and x[3] < b and B.covered_end(x[3], x[5]) > a)
                assert len(read) <= 12 < total / 2


def test_natural_order_of_names(spark):
    """Digit runs as numbers, other characters by code, as a plain comparator has it."""

    def compare(a, b):
        i = j = 0
        while i < len(a) and j < len(b):
            if a[i].isdigit() and b[j].isdigit():
                x, y = i, j
                while i < len(a) and a[i].isdigit():
                    i += 1
                while j < len(b) and b[j].isdigit():
                    j += 1
                if int(a[x:i]) != int(b[y:j]):
                    return -1 if int(a[x:i]) < int(b[y:j]) else 1
            elif a[i] != b[j]:
                return -1 if a[i] < b[j] else 1
            else:
                i, j = i + 1, j + 1
        return (len(a) - i > 0) - (len(b) - j > 0)

    r = random.Random(6)
    names = sorted({"".join(r.choice("a1!0:2 9z") for _ in range(r.randint(1, 9))) for _ in range(600)} | {"r2", "r10", "r1", "r" + "9" * 40, "r" + "9" * 39, "r", "chr10_s2"})
    got = [x.n for x in spark.createDataFrame([(n,) for n in names], "n string").repartition(3).orderBy(N.natural_key("n")).collect()]
    assert all(compare(a, b) <= 0 for a, b in zip(got, got[1:])) and sorted(got) == names
    assert [compare(a, b) for a, b in zip(got, got[1:])] == [compare(a, b) for a, b in zip(*(lambda s: (s, s[1:]))(sorted(names, key=functools.cmp_to_key(compare))))]
