"""FASTQ in parts: any split gives the records of one reader."""

import gzip
import random

import pytest

from readloom.sources import bam as B
from readloom.sources import fastq as Q
from readloom.sources import files as S


def text(r, n, longest=120, end="\n", tag=""):
    """Records whose qualities begin with @ and + as often as not."""
    out = []
    for i in range(n):
        size = r.choice([1, 2, r.randint(1, longest), 30 * longest if r.random() < 0.01 else 5])
        qual = r.choice("@+I") + "".join(chr(33 + r.randint(0, 93)) for _ in range(size - 1))
        out.append(f"@{tag}n{i} @x +{r.random()}{end}{''.join(r.choice('ACGTN') for _ in range(size))}{end}{r.choice(['+', '+ n', '+@'])}{end}{qual}{end}")
    return "".join(out)


def put(path, raw, kind):
    if kind == "plain":
        path.write_bytes(raw)
    elif kind == "gzip":
        path.write_bytes(gzip.compress(raw))
    else:
        r, out, at = random.Random(1), [], 0
        while at < len(raw):
            n = r.choice([1, 7, 300, 5000])
            out += B.deflated(raw[at : at + n]) + ([B.END] if r.random() < 0.1 else [])
            at += n
        path.write_bytes(b"".join(out) + B.END)
    return str(path)


def parsed(raw, size=100):
    lines = raw.decode("ascii", "replace").split("\n")
    lines = [x.rstrip("\r") for x in (lines[:-1] if lines[-1] == "" else lines)]
    return [(lines[i][1:], lines[i + 1], lines[i + 3]) for i in range(0, len(lines), 4)]


@pytest.mark.parametrize("kind", ["plain", "blocks"])
@pytest.mark.parametrize("end, last", [("\n", True), ("\r\n", True), ("\n", False)])
def test_parts_follow_each_other(tmp_path, monkeypatch, kind, end, last):
    monkeypatch.setattr(Q, "MARK", 17)
    raw = text(random.Random(len(end)), 500, end=end).encode()
    raw = raw if last else raw[:-1]
    source = Q.source_of(put(tmp_path / "a.fq", raw, kind))
    assert source.kind == kind
    want = parsed(raw)
    for split in (50, 333, 1024, 20_000, source.size):
        parts = [Q.part_of(source, lo, lo + split) for lo in range(0, source.size, split)]
        places, n = Q.whole(parts, source)
        assert n == len(want) and sorted({0, *[o for o, _ in places]}) == [o for o, _ in places]
        for o, place in places[:: max(len(places) // 40, 1)]:
            assert [x for c in Q.records(Q.Range(source, place, 2, 21), 4) for x in zip(*c)] == want[o + 2 : o + 23] if o + 23 <= n else True
    assert [x for c in Q.records(Q.Range(source, Q.BEGIN, 0, None), 7) for x in zip(*c)] == want


@pytest.mark.parametrize("kinds", [("plain", "plain"), ("blocks", "blocks"), ("plain", "blocks"), ("plain", "gzip")])
def test_pairs_at_any_split(spark, tmp_path, kinds):
    r = random.Random(5)
    one, two = text(r, 600, tag="a").encode(), text(r, 600, 300, tag="b").encode()
    files = [put(tmp_path / f"{i}.fq{'.gz' if k != 'plain' else ''}", raw, k) for i, (raw, k) in enumerate(zip((one, two), kinds))]
    want = [(x[0].split(" ")[0], x[1], x[2], y[1], y[2], i) for i, (x, y) in enumerate(zip(parsed(one), parsed(two)))]
    for split in (2048, 30_000, 1 << 30):
        d = Q.read_fastq_pairs(spark, files[:1], files[1:], split=split)
        assert (d.rdd.getNumPartitions() > 5) == (split == 2048 and "gzip" not in kinds)
        assert [tuple(x)[:6] for x in d.collect()] == want
    zipped = S.read_zipped(spark, [files], split=2000).collect()
    assert [(x.name, *x.seqs, x.ordinal) for x in zipped] == [(x[0], x[1], x[3], x[5]) for x in want]
    assert [(x.name, x.qual) for x in Q.fastq_frame(spark, files[0], split=5000).collect()] == [(x[0], x[2]) for x in want]


@pytest.mark.parametrize("kind", ["plain", "blocks"])
def test_what_is_no_fastq_is_an_error(spark, tmp_path, kind):
    raw = text(random.Random(8), 400).encode()
    lines = raw.split(b"\n")
    good = put(tmp_path / "good.fq", raw, kind)
    whole = {"cut": raw[: len(raw) // 2], "line gone": b"\n".join(lines[:801] + lines[802:]), "line more": b"\n".join([*lines[:804], b"", *lines[804:]]), "short quality": b"\n".join([*lines[:803], lines[803] + b"I", *lines[804:]]), "blank at the end": raw + b"\n"}
    for name, bad in whole.items():
        path = put(tmp_path / f"{name}.fq", bad, kind)
        for split in (600, 1 << 30):
            with pytest.raises(Exception, match="cut short|different numbers"):
                Q.read_fastq_pairs(spark, [path], [good], split=split).collect()
    short = put(tmp_path / "short.fq", b"\n".join(lines[:-5]) + b"\n", kind)
    for split in (600, 1 << 30):
        with pytest.raises(Exception, match="different numbers"):
            Q.read_fastq_pairs(spark, [good], [short], split=split).collect()
    none = put(tmp_path / "none.fq", b"", kind)
    assert Q.read_fastq_pairs(spark, [none], [none], split=600).count() == 0


def test_a_worker_over_pairs(spark, tmp_path):
    """A worker of the user's, with a pandas function in it, over files read in parts; mates stay in step."""
    from pyspark.sql import functions as F

    from readloom import sinks

    r = random.Random(9)
    one, two = text(r, 120, tag="a").encode(), text(r, 120, tag="a").encode()
    files = [put(tmp_path / f"{i}.fq", raw, "plain") for i, raw in enumerate((one, two))]

    def worker(d):
        @F.pandas_udf("string")
        def status(s):
            return s.str.len().map(lambda n: ["valid", "multi", "no_barcode"][n % 3])

        return d.withColumn("status", status("r1_seq")).withColumn("r1_seq", F.reverse("r1_seq"))

    got = dict(map(tuple, sinks.process_pairs(spark, files[:1], files[1:], worker, str(tmp_path / "out"), split=3000).collect()))
    a, b = parsed(one), parsed(two)
    kind = [["valid", "multi", "no_barcode"][len(x[1]) % 3] for x in a]
    assert got == {k: kind.count(k) for k in set(kind)}
    for k, folder in (("valid", "out"), ("multi", "out-multi")):
        lines = [[x for f in sorted((tmp_path / folder / m).glob("*.gz")) for x in gzip.open(f, "rt").read().splitlines()] for m in "12"]
        assert lines[0][1::4] == [x[1][::-1] for x, s in zip(a, kind) if s == k] and lines[1][1::4] == [x[1] for x, s in zip(b, kind) if s == k]
        assert lines[0][0::4] == lines[1][0::4]
