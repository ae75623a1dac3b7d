"""Depth and calls from alignments, against a plain walk over every base."""

import collections
import random
import re

import pytest
from pyspark.sql import functions as F

from readloom.operators import intervals as I
from readloom.operators import pileup as P
from readloom.sources import bam as B
from readloom.sources import files as S

REFS = {"chr1": 3000, "chr2": 700, "chrM": 40}


def genome(r):
    return {n: "".join(r.choice("ACGTacgtNC") for _ in range(size)) for n, size in REFS.items()}


def made(r, fasta, n=400):
    rows = []
    for i in range(n):
        ref = r.choice([*REFS, None]) if i else None
        ops, bases = [], 0
        for _ in range(r.randint(1, 6)):
            op, k = r.choice("MMMM=XIDNSHP"), r.randint(1, 40)
            ops.append(f"{k}{op}")
            bases += k if op in "M=XIS" else 0
        pos = r.randrange(REFS[ref]) if ref else -1
        seq = "".join(r.choice("ACGTN") for _ in range(bases))
        qual = "*" if r.random() < 0.1 else "".join(chr(33 + r.randint(5, 40)) for _ in range(bases))
        tags = {"CB": r.choice(["AA", "CC"])} | ({"XG": r.choice(["CT", "GA"])} if r.random() < 0.5 else {})
        rows.append((f"r{i}", r.choice([0, 16, 99, 147, 83, 163]), ref, pos, r.choice([3, 10, 60]), "".join(ops) if ref else "*", None, -1, 0, seq, qual, False, tags, {k: "Z" for k in tags}))
    return rows


def walk(row):
    """(reference position, index of the base or None, operation) of each covered position."""
    ref, read = row[3], 0
    for n, op in re.findall(r"(\d+)([MIDNSHP=X])", row[5]):
        for _ in range(int(n)):
            if op in "M=X":
                yield ref, read, op
            elif op in "DN":
                yield ref, None, op
            ref += op in "M=XDN"
            read += op in "M=XIS"


@pytest.fixture(scope="module")
def data(spark, tmp_path_factory):
    """Records and reference, by way of their files."""
    r, folder = random.Random(4), tmp_path_factory.mktemp("pileup")
    fasta = genome(r)
    rows = made(r, fasta)
    (folder / "g.fa").write_text("".join(f">{n} some text\n" + "".join(s[i : i + 61] + "\n" for i in range(0, len(s), 61)) for n, s in fasta.items()))
    B.write_bam(spark.createDataFrame(rows, B.SCHEMA).repartition(3), str(folder / "bam"), [(n, k) for n, k in REFS.items()], coordinate=True)
    return rows, fasta, B.read_bam(spark, str(folder / "bam"), split=5000), S.read_fasta(spark, str(folder / "g.fa"))


@pytest.mark.parametrize("gaps", [False, True])
def test_depth_of_positions_and_regions(spark, data, gaps):
    rows, _, records, _ = data
    depth = collections.Counter((x[2], p) for x in rows if x[2] for p, base, _ in walk(x) if gaps or base is not None)
    iv = P.covered(records, gaps)
    got = collections.Counter()
    for s in I.depth_segments(iv, 64).collect():
        for p in range(s.start, s.end):
            got[s.chrom, p] += s.depth
    assert +got == depth
    regions = [("chr1", 10, 400), ("chr1", 10, 400), ("chr1", 300, 310), ("chr1", 2990, 5000), ("chr2", 0, 700), ("chr2", 650, 651), ("chrX", 1, 2)]
    found = P.region_depth(iv, spark.createDataFrame(regions, "chrom string, start long, end long"), 64)
    want = collections.Counter((c, a, b, depth[c, p]) for c, a, b in set(regions) for p in range(a, b) if depth[c, p])
    assert {tuple(x)[:4]: x.bases for x in found.collect()} == want
    flat = [depth[c, p] for c, a, b in set(regions) for p in range(a, b) if depth[c, p]]
    mean = sum(flat) / len(flat)
    one = P.region_tail_share(found, []).first()
    assert abs(one.mean - mean) < 1e-8 and abs(one.share - sum(x > 0.2 * mean for x in flat) / len(flat)) < 1e-8
    assert P.region_tail_share(found, ["chrom"]).count() == 2


@pytest.mark.parametrize("width, stretch", [(512, 1 << 20), (50, 64), (64, 64)])
def test_calls_from_bam_and_fasta(spark, data, monkeypatch, width, stretch):
    monkeypatch.setattr(P, "STRETCH", stretch)
    rows, fasta, records, frame = data
    turn = dict(zip("ACGTN", "TGCAN"))
    base = lambda n, p: fasta[n][p].upper() if 0 <= p < len(fasta[n]) else "N"
    want = collections.Counter()
    for x in rows:
        if x[2] is None or x[4] < 10:
            continue
        back, second = bool(x[1] & 16), bool(x[1] & 1 and x[1] & 128)
        strand = {"CT": "+", "GA": "-"}.get(x[12].get("XG"), "+" if back == second else "-")
        for p, i, _ in walk(x):
            if i is None or base(x[2], p) != {"+": "C", "-": "G"}[strand] or x[10] != "*" and ord(x[10][i]) - 33 < 20 or x[9][i] not in {"+": "CT", "-": "GA"}[strand]:
                continue
            context = "".join(base(x[2], p + k) for k in range(3)) if strand == "+" else "".join(turn[base(x[2], p - k)] for k in range(3))
            key = x[12]["CB"], x[2], p + 1, strand, context
            want[key, "cov"] += 1
            want[key, "mc"] += x[9][i] in "CG"
    d = records.withColumns({"cell": F.col("tags")["CB"], "strand": P.bisulfite_strand()})
    got = P.methylation_calls(d, P.cytosines(frame, width), ["cell"], width).collect()
    assert len(got) > 200 and {tuple(x)[:5]: (x.mc, x.cov) for x in got} == {k: (want[k, "mc"], n) for (k, of), n in want.items() if of == "cov"}


def test_records_without_places(spark):
    d = spark.createDataFrame([("a", None, -1, "*"), ("b", "chr1", 5, "*"), ("c", "chr1", 5, None), ("d", "chr1", 5, "4S"), ("e", "chr1", 5, "2M0D1M")], "qname string, ref string, pos long, cigar string")
    assert sorted(map(tuple, P.covered(d).collect())) == [("chr1", 5, 7), ("chr1", 7, 8)]
    assert P.covered(d.where("qname = 'x'")).count() == 0
