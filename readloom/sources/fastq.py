"""FASTQ: files that belong together by position (mates, barcodes, UMIs), read in parts.

Plain and BGZF files are cut at every `split` bytes. A first pass finds the first record of each part, counts its records and notes
where every MARK-th of them begins; parts must follow each other without a gap, so what is no FASTQ does not pass. Then each task
reads a range of ordinals of all files of a group. Other compressed files cannot be read from their middle: their group is one task.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from contextlib import closing
from itertools import zip_longest
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shipping import ship
from .bam import block_size, blocks, first_block
from .paths import listed, open_input, open_seekable, size_of

PAIR = "name string, r1_seq string, r1_qual string, r2_seq string, r2_qual string, ordinal bigint, file int"
RECORDS = 10_000  # records of an Arrow batch
SPLIT = 64 << 20  # bytes of a file to a part
MARK = 10_000  # records between two places that a reader can start from
CHUNK = 1 << 20

#: Where a record begins: the newline before it, as the place of a block (or byte) and the bytes into it.
Place = tuple[int, int]
BEGIN: Place = (0, -1)


class Source(NamedTuple):
    path: str
    size: int
    kind: str  # plain, blocks (BGZF) or stream


def source_of(path: str) -> Source:
    with open_seekable(path) as f:
        head = f.read(1 << 12)
    stream = head[:2] == b"\x1f\x8b" or head[:3] == b"BZh" or head[:4] == b"\x28\xb5\x2f\xfd"
    return Source(path, size_of(path), "blocks" if block_size(head) else "stream" if stream else "plain")


class Part(NamedTuple):
    """What the first pass knows of a part: its first record, how many there are, where each MARK-th begins, and what follows the last (None: nothing)."""

    first: Place
    count: int
    marks: list[Place]
    after: Place | None


class Range(NamedTuple):
    """Records of one file: start at a place, skip some, read `count` (None: all that follow)."""

    source: Source
    place: Place
    skip: int
    count: int | None


def chunks(source: Source, at: int) -> Iterator[tuple[int, bytes]]:
    """(offset, bytes) from a block or byte of the file on."""
    if source.kind == "stream":
        with open_input(source.path) as f:
            yield from ((0, data) for data in iter(lambda: f.read(CHUNK), b""))
        return
    with open_seekable(source.path) as f:
        if source.kind == "blocks":
            yield from blocks(f, at)
            return
        f.seek(at)
        while data := f.read(CHUNK):
            yield at, data
            at += len(data)


def bad(source: Source) -> ValueError:
    return ValueError(f"{source.path} is not FASTQ, or cut short")


def place_in(source: Source, offset: int, index: int) -> Place:
    return (offset, index) if source.kind == "blocks" else (offset + index, 0)


def first_record(source: Source, start: int) -> Place | None:
    """The first record behind the first newline from a byte of the file on.

    A name begins with @ and two lines on there is +: a quality may begin with @, but two lines on from it there are bases.
    """
    if not start:
        return BEGIN if source.size else None
    at = start
    if source.kind == "blocks":
        with open_seekable(source.path) as f:
            found = first_block(f, start, source.size)
        if found is None:
            return None
        at = found
    held, begins = b"", []
    with closing(chunks(source, at)) as data:
        for offset, more in data:
            begins.append((len(held), offset))
            held += more
            if held.count(b"\n") >= 9:
                break
    lines, ends = held.split(b"\n"), [i for i, c in enumerate(held) if c == 10][:4]
    for k, end in enumerate(ends):  # line k + 1 begins behind newline k
        if k + 3 < len(lines) and lines[k + 1][:1] == b"@" and lines[k + 3][:1] == b"+":
            begin, offset = max(b for b in begins if b[0] <= end)
            return place_in(source, offset, end - begin)
    return None


def part_of(source: Source, start: int, end: int) -> Part:
    """The records whose newline before lies in bytes (or blocks at) [start, end) of the file."""
    first = first_record(source, start)
    if first is None or first[0] >= end:
        return Part(BEGIN, 0, [], None)
    lines, count, marks, last = 0, 1, [], 10
    with closing(chunks(source, first[0])) as data:
        for offset, raw in data:
            skip = first[1] + 1 if offset == first[0] else 0
            feeds = np.flatnonzero(np.frombuffer(raw, np.uint8)[skip:] == 10) + skip
            number = lines + 1 + np.arange(len(feeds))
            for i in np.flatnonzero(number % 4 == 0) if len(feeds) else ():
                place = place_in(source, offset, int(feeds[i]))
                if place[0] >= end:
                    more = feeds[i] + 1 < len(raw) or any(x for _, x in data)
                    return Part(first, count, marks, place if more else None)
                if count % MARK == 0:
                    marks.append(place)
                count += 1
            lines += len(feeds)
            last = raw[-1] if raw else last
    lines += last != 10
    if lines % 4:
        raise bad(source)
    if count * 4 > lines:  # the newline at the end of the file begins nothing
        count -= 1
        marks = marks[: max(count - 1, 0) // MARK]
    return Part(first, count, marks, None)


def records(found: Range, size: int = RECORDS) -> Iterator[tuple[list[str], list[str], list[str]]]:
    """Names, sequences and qualities, so many records at a time; ValueError for one that is cut short or not FASTQ."""
    held, skip, left = "", 4 * found.skip, found.count
    lines: list[str] = []

    def out(n: int) -> tuple[list[str], list[str], list[str]]:
        some = [x.rstrip("\r") for x in lines[: 4 * n]]
        del lines[: 4 * n]
        names, seqs, quals = some[0::4], some[1::4], some[3::4]
        if not all(x.startswith("@") for x in names) or any(len(s) != len(q) for s, q in zip(seqs, quals)):
            raise bad(found.source)
        return [x[1:] for x in names], seqs, quals

    with closing(chunks(found.source, found.place[0])) as data:
        begin = found.place[1] + 1
        for _, raw in data:
            held += raw[begin:].decode("ascii", "replace")
            begin = 0
            more = held.split("\n")
            held = more.pop()
            if skip:
                n = min(skip, len(more))
                skip -= n
                more = more[n:]
            lines += more
            while len(lines) >= 4 * size if left is None or left > size else left and len(lines) >= 4 * left:
                n = size if left is None else min(size, left)
                yield out(n)
                left = None if left is None else left - n
            if left == 0:
                return
    if held:
        lines.append(held)
    if len(lines) % 4 or left is not None and len(lines) != 4 * left:
        raise bad(found.source)
    if lines:
        yield out(len(lines) // 4)


def whole(parts: list[Part], source: Source) -> tuple[list[tuple[int, Place]], int]:
    """(ordinal, place) of all records that a reader can start from, and how many records there are; an error where parts do not follow each other."""
    places, at, expected = [], 0, BEGIN if source.size else None
    for p in parts:
        if not p.count:
            continue
        if p.first != expected:
            raise bad(source)
        places += [(at, p.first), *((at + MARK * (i + 1), m) for i, m in enumerate(p.marks))]
        at, expected = at + p.count, p.after
    if expected is not None:
        raise bad(source)
    return places, at


def plan(spark: SparkSession, groups: list[list[str]], split: int) -> list[tuple[int, int, list[Range]]]:
    """(group, first ordinal, ranges) of each task. Groups of files that can be cut, the first into several parts, are counted by a job."""
    found = {p: source_of(p) for g in groups for p in g}
    cut = [i for i, g in enumerate(groups) if found[g[0]].size > split and all(found[p].kind != "stream" for p in g)]
    asked = [(found[p], lo) for p in dict.fromkeys(p for i in cut for p in groups[i]) for lo in range(0, max(found[p].size, 1), split)]

    def count(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in frames:
            for i in batch.column(0).to_pylist():
                source, lo = asked[i]
                p = part_of(source, lo, lo + split)
                row = [p.first, p.after]
                yield pa.RecordBatch.from_arrays([pa.array([i]), pa.array([list(x) if x else None for x in row[:1]], pa.list_(pa.int64())), pa.array([p.count]), pa.array([[y for m in p.marks for y in m]], pa.list_(pa.int64())), pa.array([list(row[1]) if row[1] else None], pa.list_(pa.int64()))], ["i", "first", "n", "marks", "after"])

    parts: dict[str, list[Part]] = {}
    if asked:
        counted = spark.range(0, len(asked), 1, len(asked)).mapInArrow(count, "i long, first array<long>, n long, marks array<long>, after array<long>")
        for r in sorted(counted.collect()):  # a row for each part
            parts.setdefault(asked[r.i][0].path, []).append(Part(tuple(r.first), r.n, list(zip(r.marks[::2], r.marks[1::2])), tuple(r.after) if r.after is not None else None))
    tasks = []
    for i, g in enumerate(groups):
        if i not in cut:
            tasks.append((i, 0, [Range(found[p], BEGIN, 0, None) for p in g]))
            continue
        starts = [whole(parts[p], found[p]) for p in g]
        if len({n for _, n in starts}) > 1:
            raise ValueError(f"{g} hold different numbers of records")
        at = 0
        for p in parts[g[0]]:
            if p.count:
                near = [places[np.searchsorted([o for o, _ in places], at, "right") - 1] for places, _ in starts]
                tasks.append((i, at, [Range(found[x], place, at - o, p.count) for x, (o, place) in zip(g, near)]))
                at += p.count
    return tasks


def zipped(spark: SparkSession, groups: list[list[str]], split: int = SPLIT) -> DataFrame:
    """(file, ordinal, name, seq_0, qual_0, seq_1, ...): the records at one place of all files of a group, which all have as many members.

    name is that of the first file up to its first space, file the number of the group. ValueError, at the latest when the rows are
    read, for files that are not FASTQ or cut short and for groups with different numbers of records.
    """
    ship(spark)
    tasks, width = plan(spark, groups, split), len(groups[0])
    names = ["file", "ordinal", "name", *[f"{k}_{i}" for i in range(width) for k in ("seq", "qual")]]
    schema = ", ".join(["file int", "ordinal long", *[f"{n} string" for n in names[2:]]])

    def read(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in frames:
            for i in batch.column(0).to_pylist():
                group, at, ranges = tasks[i]
                for together in zip_longest(*map(records, ranges), fillvalue=([], [], [])):
                    n = len(together[0][0])
                    if any(len(x[0]) != n for x in together):
                        raise ValueError(f"{[r.source.path for r in ranges]} hold different numbers of records")
                    cols = [pa.array([group] * n, pa.int32()), pa.array(range(at, at + n), pa.int64()), pa.array([x.split(" ")[0] for x in together[0][0]])]
                    at += n
                    yield pa.RecordBatch.from_arrays([*cols, *[pa.array(c, pa.string()) for x in together for c in x[1:]]], names)

    return spark.range(0, len(tasks), 1, max(len(tasks), 1)).mapInArrow(read, schema)


def read_fastq_pairs(spark: SparkSession, r1: list[str], r2: list[str], split: int = SPLIT) -> DataFrame:
    """Read pairs (PAIR) of files r1 and r2, plain or compressed, at paths or URIs; file is the number of the pair, ordinal the place of the record in it."""
    if len(r1) != len(r2):
        raise ValueError("r1 and r2 name different numbers of files")
    d = zipped(spark, [[a, b] for a, b in zip(r1, r2)], split)
    return d.select("name", *[F.col(f"{k}_{i}").alias(f"r{i + 1}_{k}") for i in (0, 1) for k in ("seq", "qual")], "ordinal", "file")


def fastq_frame(spark: SparkSession, *paths: str, split: int = SPLIT) -> DataFrame:
    """(name, seq, qual, ordinal, file) of single FASTQ files; a folder or pattern stands for its files."""
    d = zipped(spark, [[x] for p in paths for x in listed(p)], split)
    return d.select("name", F.col("seq_0").alias("seq"), F.col("qual_0").alias("qual"), "ordinal", "file")


def fastq_text(path: str) -> io.TextIOWrapper:
    """A file's text, for formats without positions."""
    return io.TextIOWrapper(open_input(path), encoding="ascii", errors="replace", newline="\n")
