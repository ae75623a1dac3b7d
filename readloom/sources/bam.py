"""BAM: records read block by block from any file system, and files written from records."""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..shipping import ship
from .paths import listed, open_input, open_output, open_seekable, size_of

#: Fixed values of the format: letters of bases and of CIGAR operations, the empty block that ends a file.
BASES, OPS = "=ACMGRSVTWYHKDBN", "MIDNSHP=X"
END = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")
MAGIC = b"\x1f\x8b\x08\x04"
LARGEST = 1 << 16  # bytes of a block
SCHEMA = "qname string, flag int, ref string, pos long, mapq int, cigar string, mate_ref string, mate_pos long, template long, seq string, qual string, is_read1 boolean, tags map<string,string>, tag_types map<string,string>"
BLOCK = 0xFF00  # bytes of records to a block
SPLIT = 64 << 20  # bytes of a file to a partition
CHAIN = 6  # records in a row that confirm where one begins


def block_size(raw: bytes, at: int = 0) -> int:
    """The size of the BGZF block that begins there; 0 if none does, or its header is cut short."""
    if raw[at : at + 4] != MAGIC or len(raw) < at + 12:
        return 0
    p = at + 12
    end = p + struct.unpack_from("<H", raw, at + 10)[0]
    while p + 6 <= min(end, len(raw)):
        n = struct.unpack_from("<H", raw, p + 2)[0]
        if raw[p : p + 2] == b"BC" and n == 2:
            size = struct.unpack_from("<H", raw, p + 4)[0] + 1
            return size if size >= end - at + 8 else 0
        p += 4 + n
    return 0


def contents(block: bytes) -> bytes:
    """What a whole block holds; an error if its check sum or size differ."""
    body = zlib.decompress(block[12 + struct.unpack_from("<H", block, 10)[0] : -8], -15)
    if struct.unpack("<II", block[-8:]) != (zlib.crc32(body), len(body)):
        raise zlib.error("damaged BGZF block")
    return body


def blocks(file: BinaryIO, at: int = 0) -> Iterator[tuple[int, bytes]]:
    """(offset, contents) of the BGZF blocks from offset `at` on, one at a time: neither the file nor what it holds is ever in memory as a whole."""
    while file.seek(at) == at and (head := file.read(18)):
        need = 12 + struct.unpack_from("<H", head, 10)[0] - len(head) if len(head) >= 12 else 0
        head += file.read(max(need, 0))
        size = block_size(head)
        if not size:
            raise ValueError("not a BGZF block")
        block = head + file.read(size - len(head))
        if len(block) < size:
            raise EOFError("file cut short")
        yield at, contents(block)
        at += size


def first_block(file: BinaryIO, start: int, size: int) -> int | None:
    """The offset of the first block that begins at `start` or behind, in a file of so many bytes: one that can be inflated and that others follow."""
    if start <= 0:
        return 0
    while start < size:
        file.seek(start)
        raw = file.read(4 * LARGEST)
        at = raw.find(MAGIC)
        while 0 <= at < LARGEST:
            p, n = at, block_size(raw, at)
            while n and p + n < min(len(raw), size - start) - 18:  # as far as the bytes go, block follows block
                p += n
                n = block_size(raw, p)
            if n and start + p + n <= size:
                try:
                    contents(raw[at : at + block_size(raw, at)])
                    return start + at
                except zlib.error:
                    pass
            at = raw.find(MAGIC, at + 1)
        start += LARGEST
    return None


def check_end(file: BinaryIO, size: int) -> None:
    """An error if a file of so many bytes does not end with a whole block: each part of it may be whole all the same."""
    at = first_block(file, size - 2 * LARGEST, size)
    while at is not None and at < size:
        file.seek(at)
        n = block_size(file.read(LARGEST))
        at = at + n if n else None
    if at != size:
        raise EOFError("file cut short")


class _Stream:
    """Bytes on demand from (offset, contents) of blocks, and where the next one lies."""

    def __init__(self, pieces: Iterator[tuple[int, bytes]]):
        self.pieces, self.held, self.at = pieces, b"", 0
        self.marks: list[tuple[int, int]] = []  # where in `held` each block begins, and its offset

    def ahead(self, n: int) -> int:
        """Loads n bytes from here on, if there are so many; how many there are."""
        if len(self.held) - self.at < n:
            parts, have = [self.held[self.at :]], len(self.held) - self.at
            self.marks = [(p - self.at, o) for p, o in self.marks]
            for offset, p in self.pieces:
                self.marks.append((have, offset))
                parts.append(p)
                have += len(p)
                if have >= n:
                    break
            self.held, self.at = b"".join(parts), 0
        return len(self.held) - self.at

    def take(self, n: int) -> bytes:
        if self.ahead(n) < n:
            raise EOFError("file cut short")
        self.at += n
        return self.held[self.at - n : self.at]

    def done(self) -> bool:
        return self.ahead(1) == 0

    def where(self, further: int = 0) -> tuple[int, int]:
        """(offset of the block, bytes into it) of the next byte, or of one that far behind it. Bytes before it are gone for good if it is the next."""
        at = self.at + further
        i = max(k for k, (p, _) in enumerate(self.marks) if p <= at)
        if not further:
            del self.marks[:i]
            i = 0
        return self.marks[i][1], at - self.marks[i][0]


def header_of(stream: _Stream) -> tuple[str, list[tuple[str, int]]]:
    """(text, [(reference, length)])."""
    if stream.take(4) != b"BAM\1":
        raise ValueError("not a BAM file")
    text = stream.take(struct.unpack("<i", stream.take(4))[0]).rstrip(b"\0").decode()
    refs = []
    for _ in range(struct.unpack("<i", stream.take(4))[0]):
        name = stream.take(struct.unpack("<i", stream.take(4))[0])[:-1].decode()
        refs.append((name, struct.unpack("<i", stream.take(4))[0]))
    return text, refs


def read_tags(raw: bytes) -> tuple[dict[str, str], dict[str, str]]:
    """Values as text, and their types; arrays are comma-joined with a type such as Bi."""
    sizes, out, kinds, p = {"c": "<b", "C": "<B", "s": "<h", "S": "<H", "i": "<i", "I": "<I", "f": "<f"}, {}, {}, 0
    while p < len(raw):
        tag, kind = raw[p : p + 2].decode(), chr(raw[p + 2])
        p += 3
        kinds[tag] = kind
        if kind == "A":
            out[tag], p = chr(raw[p]), p + 1
        elif kind in "ZH":
            end = raw.index(b"\0", p)
            out[tag], p = raw[p:end].decode(), end + 1
        elif kind == "B":
            sub, k = chr(raw[p]), struct.unpack_from("<i", raw, p + 1)[0]
            kinds[tag] += sub
            w = struct.calcsize(sizes[sub])
            out[tag] = ",".join(str(struct.unpack_from(sizes[sub], raw, p + 5 + i * w)[0]) for i in range(k))
            p += 5 + k * w
        else:
            out[tag] = str(struct.unpack_from(sizes[kind], raw, p)[0])
            p += struct.calcsize(sizes[kind])
    return out, kinds


def record_of(raw: bytes, refs: list[tuple[str, int]]) -> tuple:
    """One record, without its size, as a row of SCHEMA; no base or quality is *."""
    ref, pos, l_name, mapq, _, n_cigar, flag, l_seq, mate, mate_pos, template = struct.unpack_from("<iiBBHHHiiii", raw)
    p = 32
    name = raw[p : p + l_name - 1].decode()
    p += l_name
    ops = struct.unpack_from(f"<{n_cigar}I", raw, p)
    cigar = "".join(f"{o >> 4}{OPS[o & 15]}" for o in ops) or "*"
    p += 4 * n_cigar
    half = raw[p : p + (l_seq + 1) // 2]
    seq = "".join(BASES[b >> 4] + BASES[b & 15] for b in half)[:l_seq] or "*"
    p += (l_seq + 1) // 2
    qual = raw[p : p + l_seq]
    qual = "*" if not qual or qual[0] == 255 else bytes(q + 33 for q in qual).decode()
    tags, kinds = read_tags(raw[p + l_seq :])
    at = lambda i: refs[i][0] if i >= 0 else None
    return name, flag, at(ref), pos, mapq, cigar, at(mate), mate_pos, template, seq, qual, bool(flag & 64), tags, kinds


def record_end(stream: _Stream, at: int, refs: list[tuple[str, int]]) -> int:
    """Where the record ends that begins `at` bytes further on; 0 if none can begin there."""
    if stream.ahead(at + 36) < at + 36:
        return 0
    size, ref, pos, l_name, _, _, n_cigar, _, l_seq, mate, mate_pos, _ = struct.unpack_from("<iiiBBHHHiiii", stream.held, stream.at + at)
    fixed = 32 + l_name + 4 * n_cigar + (max(l_seq, 0) + 1) // 2 + max(l_seq, 0)
    if not l_name or l_seq < 0 or size < fixed or size > fixed + (1 << 24) or not all(-1 <= r < len(refs) for r in (ref, mate)) or min(pos, mate_pos) < -1:
        return 0
    end = at + 4 + size
    if stream.ahead(end) < end:
        return 0
    raw = stream.held[stream.at + at + 4 : stream.at + end]
    name = raw[32 : 32 + l_name]
    if name[-1:] != b"\0" or not all(33 <= c <= 126 for c in name[:-1]):
        return 0
    try:
        if any(o & 15 > 8 for o in struct.unpack_from(f"<{n_cigar}I", raw, 32 + l_name)):
            return 0
        read_tags(raw[fixed:])
    except (ValueError, KeyError, IndexError, struct.error):
        return 0
    return end


def find_record(stream: _Stream, refs: list[tuple[str, int]], end: int) -> bool:
    """Moves to the first record that begins in a block before offset `end`, if there is one: where CHAIN of them follow each other, or fewer up to the end of the file."""
    at = 0
    while stream.ahead(at + 1) > at and stream.where(at)[0] < end if at else not stream.done() and stream.where()[0] < end:
        p, n = at, 0
        while n < CHAIN and (more := record_end(stream, p, refs)):
            p, n = more, n + 1
        if n == CHAIN or n and stream.ahead(p + 1) == p:
            stream.take(at)
            return True
        at += 1
    return False


def located_records(file: BinaryIO, size: int, start: int, end: int) -> Iterator[tuple[int, tuple]]:
    """(virtual offset, row) of the records that begin in blocks at offsets [start, end) of a file of so many bytes; a record may go on behind them."""
    stream = _Stream(blocks(file))
    _, refs = header_of(stream)
    none = stream.done()
    if end >= size:
        check_end(file, size)
    if none or stream.where()[0] >= end:
        return
    if start > stream.where()[0]:
        at = first_block(file, start, size)
        if at is None or at >= end:
            return
        stream = _Stream(blocks(file, at))
        if not find_record(stream, refs, end):
            return
    while not stream.done():
        block, within = stream.where()
        if block >= end:
            return
        yield block << 16 | within, record_of(stream.take(struct.unpack("<i", stream.take(4))[0]), refs)


_KINDS = [pa.string(), pa.int32(), pa.string(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.bool_(), pa.map_(pa.string(), pa.string()), pa.map_(pa.string(), pa.string())]
_NAMES = [c.split()[0] for c in SCHEMA.split(", ")]


def _batches(rows: Iterator[tuple], size: int = 5000) -> Iterator[pa.RecordBatch]:
    out: list[tuple] = []

    def batch() -> pa.RecordBatch:
        cols = [list(c) for c in zip(*out)]
        for i in (12, 13):
            cols[i] = [list(m.items()) for m in cols[i]]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, _KINDS)], _NAMES)

    for r in rows:
        out.append(r)
        if len(out) >= size:
            yield batch()
            out = []
    if out:
        yield batch()


class BamFiles(DataSource):
    """Records (SCHEMA) of the BAM files given as a comma-separated list `paths`, or those of `ref`, `start`, `end` by the files' indexes.

    Files are cut at every `split` bytes. A partition finds the first block behind its cut, and in it the first place where whole records
    follow each other; it reads the records that begin in its blocks, and the last of them to its end.
    """

    @classmethod
    def name(cls) -> str:
        return "bam_files"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema):
        return _BamReader(self.options)


class _BamReader(DataSourceReader):
    def __init__(self, options):
        self.paths, self.split = options["paths"].split(","), int(options.get("split", SPLIT))
        self.region = (options["ref"], int(options["start"]), int(options["end"])) if "ref" in options else None

    def partitions(self):
        if self.region:
            found = [InputPartition((p, piece)) for p in self.paths for piece in pieces_of(p, *self.region, self.split)]
            return found or [InputPartition((self.paths[0], []))]  # Spark asks for one at least
        return [InputPartition((p, at)) for p in self.paths for at in range(0, max(size_of(p), 1), self.split)]

    def read(self, part):
        path, at = part.value
        with open_seekable(path) as f:
            if self.region:
                yield from _batches(region_records(f, at, *self.region))
            else:
                yield from _batches(row for _, row in located_records(f, size_of(path), at, at + self.split))


def _frame(spark: SparkSession, paths: tuple[str, ...], **options) -> DataFrame:
    ship(spark)
    spark.dataSource.register(BamFiles)
    return spark.read.format("bam_files").options(paths=",".join(x for p in paths for x in listed(p) if not x.endswith(".bai")), **options).load()


def read_bam(spark: SparkSession, *paths: str, split: int = SPLIT) -> DataFrame:
    """Records (SCHEMA) of BAM files of any size, a partition for each `split` bytes; pos counts from 0. Paths may be URIs; a folder or pattern stands for its files."""
    return _frame(spark, paths, split=split)


def read_region(spark: SparkSession, ref: str, start: int, end: int, *paths: str, split: int = SPLIT) -> DataFrame:
    """Records (SCHEMA) that touch [start, end) of a reference, of coordinate-sorted files with an index (.bai) beside them; only blocks that may hold such records are read."""
    return _frame(spark, paths, split=split, ref=ref, start=start, end=end)


def references(path: str) -> list[tuple[str, int]]:
    """(reference, length) of a file's header."""
    with open_seekable(listed(path)[0]) as f:
        return header_of(_Stream(blocks(f)))[1]


def parsed_cigar(cigar: str = "cigar") -> Column:
    """array<struct<n,op>>."""
    n, op = (F.regexp_extract_all(cigar, F.lit(r"(\d+)([MIDNSHP=X])"), F.lit(g)) for g in (1, 2))
    return F.zip_with(n, op, lambda a, b: F.struct(a.cast("int").alias("n"), b.alias("op")))


def reference_end(pos: str = "pos", cigar: str = "cigar") -> Column:
    """The position behind the last reference base that a record covers."""
    used = F.filter(parsed_cigar(cigar), lambda x: x["op"].isin("M", "D", "N", "=", "X"))
    return F.col(pos) + F.aggregate(used, F.lit(0), lambda s, x: s + x["n"])


def deflated(data: bytes) -> list[bytes]:
    """BGZF blocks of the data, without the one that ends a file."""
    out = []
    for lo in range(0, len(data), BLOCK):
        part = data[lo : lo + BLOCK]
        c = zlib.compressobj(6, zlib.DEFLATED, -15)
        body = c.compress(part) + c.flush()
        out.append(b"\x1f\x8b\x08\x04\0\0\0\0\0\xff\x06\0BC\x02\0" + struct.pack("<H", len(body) + 25) + body + struct.pack("<II", zlib.crc32(part), len(part)))
    return out


def write_tags(tags: dict[str, str], kinds: dict[str, str]) -> bytes:
    """Tags whose type is not known are text."""
    sizes, out = {"c": "<b", "C": "<B", "s": "<h", "S": "<H", "i": "<i", "I": "<I", "f": "<f"}, []
    for tag, value in tags.items():
        kind = kinds.get(tag, "Z")
        out.append(tag.encode() + kind[:1].encode())
        if kind == "A":
            out.append(value[:1].encode())
        elif kind in "ZH":
            out.append(value.encode() + b"\0")
        elif kind[0] == "B":
            items = value.split(",") if value else []
            cast = float if kind[1] == "f" else int
            out.append(kind[1].encode() + struct.pack("<i", len(items)) + b"".join(struct.pack(sizes[kind[1]], cast(x)) for x in items))
        else:
            out.append(struct.pack(sizes[kind], float(value) if kind == "f" else int(value)))
    return b"".join(out)


def _bin(beg: int, end: int) -> int:
    """The number of the smallest bin of the index scheme that holds [beg, end)."""
    end -= 1
    for shift, first in ((14, 4681), (17, 585), (20, 73), (23, 9), (26, 1)):
        if beg >> shift == end >> shift:
            return first + (beg >> shift)
    return 0


def record_bytes(row: tuple, number: dict[str, int]) -> bytes:
    name, flag, ref, pos, mapq, cigar, mate, mate_pos, template, seq, qual, _, tags, kinds = row
    ops, n = [], ""
    for c in "" if cigar in (None, "*") else cigar:
        if c.isdigit():
            n += c
        else:
            ops.append(int(n) << 4 | OPS.index(c))
            n = ""
    seq = "" if seq in (None, "*") else seq
    codes = [BASES.index(c) if c in BASES else 15 for c in seq] + [0] * (len(seq) % 2)
    packed = bytes(a << 4 | b for a, b in zip(codes[::2], codes[1::2]))
    quals = bytes(ord(c) - 33 for c in qual) if qual not in (None, "*") and len(qual) == len(seq) else b"\xff" * len(seq)
    covered = sum(o >> 4 for o in ops if OPS[o & 15] in "MDN=X") or 1
    title = name.encode() + b"\0"
    head = struct.pack("<iiBBHHHiiii", number.get(ref, -1), pos, len(title), mapq, _bin(max(pos, 0), max(pos, 0) + covered), len(ops), flag, len(seq), number.get(mate, -1), mate_pos, template)
    body = head + title + struct.pack(f"<{len(ops)}I", *ops) + packed + quals + write_tags(dict(tags or {}), dict(kinds or {}))
    return struct.pack("<i", len(body)) + body


def header_bytes(text: str, refs: list[tuple[str, int]]) -> bytes:
    names = b"".join(struct.pack("<i", len(n.encode()) + 1) + n.encode() + b"\0" + struct.pack("<i", size) for n, size in refs)
    return b"BAM\1" + struct.pack("<i", len(text.encode())) + text.encode() + struct.pack("<i", len(refs)) + names


def bam_header(refs: list[tuple[str, int]], order: str = "unsorted") -> str:
    return f"@HD\tVN:1.6\tSO:{order}\n" + "".join(f"@SQ\tSN:{n}\tLN:{size}\n" for n, size in refs)


def covered_end(pos: int, cigar: str | None) -> int:
    """The position behind the last reference base of a record; one that covers none counts as one base."""
    used = sum(int(n) for n, op in re.findall(r"(\d+)([MIDNSHP=X])", cigar or "") if op in "MDN=X")
    return pos + max(used, 1)


class _Index:
    """The binning and linear index of one coordinate-sorted file, kept by places in its uncompressed bytes."""

    def __init__(self, refs: int):
        self.bins: list[dict[int, list[list[int]]]] = [{} for _ in range(refs)]
        self.lines: list[dict[int, int]] = [{} for _ in range(refs)]
        self.unplaced = 0

    def add(self, ref: int, beg: int, end: int, place: int, after: int) -> None:
        if ref < 0 or beg < 0:
            self.unplaced += 1
            return
        chunks = self.bins[ref].setdefault(_bin(beg, end), [])
        if chunks and chunks[-1][1] == place:
            chunks[-1][1] = after
        else:
            chunks.append([place, after])
        for w in range(beg >> 14, (end - 1 >> 14) + 1):
            self.lines[ref].setdefault(w, place)

    def raw(self, offsets: list[int]) -> bytes:
        at = lambda place: offsets[place // BLOCK] << 16 | place % BLOCK
        out = [b"BAI\1", struct.pack("<i", len(self.bins))]
        for bins, lines in zip(self.bins, self.lines):
            out.append(struct.pack("<i", len(bins)))
            for number, chunks in sorted(bins.items()):
                out.append(struct.pack("<Ii", number, len(chunks)) + b"".join(struct.pack("<QQ", at(a), at(b)) for a, b in chunks))
            n = max(lines, default=-1) + 1
            known = [at(lines[w]) if w in lines else 0 for w in range(n)]
            for w in range(1, n):  # a window without records begins where the one before it does
                known[w] = known[w] or known[w - 1]
            out.append(struct.pack(f"<i{n}Q", n, *known))
        return b"".join(out) + struct.pack("<Q", self.unplaced)


def read_index(raw: bytes, ref: int) -> tuple[dict[int, list[tuple[int, int]]], list[int]]:
    """(chunks of each bin, linear index) of one reference, as virtual offsets."""
    if raw[:4] != b"BAI\1":
        raise ValueError("not an index of a BAM file")
    n_refs, p = struct.unpack_from("<i", raw, 4)[0], 8
    for r in range(n_refs):
        bins = {}
        n, p = struct.unpack_from("<i", raw, p)[0], p + 4
        for _ in range(n):
            number, k = struct.unpack_from("<Ii", raw, p)
            p += 8
            if number < 37450:  # what lies above is statistics
                bins[number] = [struct.unpack_from("<QQ", raw, p + 16 * i) for i in range(k)]
            p += 16 * k
        n, p = struct.unpack_from("<i", raw, p)[0], p + 4
        if r == ref:
            return bins, list(struct.unpack_from(f"<{n}Q", raw, p))
        p += 8 * n
    return {}, []


def bins_over(beg: int, end: int) -> list[int]:
    """The numbers of all bins that touch [beg, end)."""
    return [0] + [first + k for shift, first in ((26, 1), (23, 9), (20, 73), (17, 585), (14, 4681)) for k in range(beg >> shift, (end - 1 >> shift) + 1)]


def chunks_of(index: bytes, ref: int, beg: int, end: int, split: int = SPLIT) -> list[tuple[int, int]]:
    """Ranges of virtual offsets, each of about `split` bytes of the file or fewer, that hold all records over [beg, end) of a reference."""
    bins, lines = read_index(index, ref)
    least = lines[min(beg >> 14, len(lines) - 1)] if lines else 0
    found = sorted((max(a, least), b) for n in bins_over(beg, end) for a, b in bins.get(n, []) if b > least)
    joined: list[list[int]] = []
    for a, b in found:
        if joined and a >> 16 <= joined[-1][1] >> 16:  # in one block, or the next chunk
            joined[-1][1] = max(joined[-1][1], b)
        else:
            joined.append([a, b])
    out = []
    for a, b in joined:
        for cut in sorted({v for v in lines if a < v < b}):  # records begin there
            if (cut >> 16) - (a >> 16) >= split:
                out.append((a, cut))
                a = cut
        out.append((a, b))
    return out


def pieces_of(path: str, ref: str, beg: int, end: int, split: int) -> list[list[tuple[int, int]]]:
    """The chunks of a region in groups of about `split` bytes of the file."""
    number = [n for n, _ in references(path)].index(ref) if any(n == ref for n, _ in references(path)) else -1
    with open_input(path + ".bai", plain=True) as f:
        chunks = chunks_of(f.read(), number, beg, end, split) if number >= 0 and beg < end else []
    out, size = [], split
    for a, b in chunks:
        if size >= split:
            out.append([])
            size = 0
        out[-1].append((a, b))
        size += (b >> 16) - (a >> 16)
    return out


def region_records(file: BinaryIO, chunks: list[tuple[int, int]], ref: str, beg: int, end: int) -> Iterator[tuple]:
    """Rows of the records in ranges of virtual offsets that touch [beg, end) of the reference."""
    _, refs = header_of(_Stream(blocks(file)))
    for a, b in chunks:
        stream = _Stream(blocks(file, a >> 16))
        stream.take(a & 0xFFFF)
        while not stream.done():
            block, within = stream.where()
            if block << 16 | within >= b:
                break
            row = record_of(stream.take(struct.unpack("<i", stream.take(4))[0]), refs)
            if row[2] != ref or row[3] >= end:
                break  # sorted: nothing behind it touches the region
            if covered_end(row[3], row[5]) > beg:
                yield row


class _Writer:
    """One BAM file, written record by record, and its index."""

    def __init__(self, path: str, head: bytes, refs: int, index: bool):
        self.path, self.out, self.held, self.flushed, self.n = path, open_output(path), bytearray(head), 0, 0
        self.offsets, self.index = [0], _Index(refs) if index else None

    def add(self, record: bytes, ref: int, beg: int, end: int) -> None:
        place = self.flushed + len(self.held)
        self.held += record
        self.n += 1
        if self.index:
            self.index.add(ref, beg, end, place, place + len(record))
        if len(self.held) >= 16 * BLOCK:
            self._flush(16 * BLOCK)

    def _flush(self, n: int) -> None:
        for block in deflated(bytes(self.held[:n])):
            self.out.write(block)
            self.offsets.append(self.offsets[-1] + len(block))
        self.flushed += n
        del self.held[:n]

    def close(self) -> None:
        self._flush(len(self.held))
        self.out.write(END)
        self.out.close()
        if self.index:
            with open_output(self.path + ".bai") as f:
                f.write(self.index.raw(self.offsets))


def coordinate_order(refs: list[tuple[str, int]], ref: str = "ref", pos: str = "pos") -> list[Column]:
    """Sorts by the place of the reference in `refs`, then by position; records without a reference come last."""
    number = F.create_map(*[F.lit(x) for i, (n, _) in enumerate(refs) for x in (n, i)])[F.col(ref)] if refs else F.lit(None).cast("int")
    return [number.asc_nulls_last(), F.col(pos).asc()]


def _with_defaults(df: DataFrame, key: Column) -> DataFrame:
    """__by and the columns of SCHEMA, those that are absent as an unmapped record has them."""
    kinds = dict(zip(_NAMES, [c.split(" ", 1)[1] for c in SCHEMA.split(", ")]))
    plain = {"flag": 4, "pos": -1, "mapq": 0, "cigar": "*", "mate_pos": -1, "template": 0, "seq": "*", "qual": "*", "is_read1": False}
    return df.select(key.alias("__by"), *[(F.col(c) if c in df.columns else F.lit(plain.get(c))).cast(k).alias(c) for c, k in kinds.items()])


def write_bam(df: DataFrame, path: str, refs: list[tuple[str, int]], by: str | None = None, order: list[str] | None = None, coordinate: bool = False) -> DataFrame:
    """Writes BAM files below `path`, which may be a URI, and returns (file, records): one for each value of `by`, named after it, else one for each partition.

    refs: (reference, length). Rows of one value of `by` are brought together, in `order` (by default by read name); without it each
    partition keeps its rows as they are. With `coordinate` rows are sorted by place, over all files if there is no `by`, and every file
    gets an index (.bai) beside it. A task writes its files record by record, so their size is not limited; a
    task that is run again writes the same file once more. Nulls in `by` go to the file null.bam.
    """
    ship(df.sparkSession)
    key = F.coalesce(F.col(by).cast("string"), F.lit("null")) if by else F.lit("")
    d = _with_defaults(df, key)
    rows_by = [*coordinate_order(refs), F.col("qname"), F.col("flag")] if coordinate else [F.col(c) for c in order or (["qname"] if by else [])]
    if by:
        d = d.repartition("__by").sortWithinPartitions("__by", *rows_by)
    elif coordinate:
        d = d.repartitionByRange(*rows_by).sortWithinPartitions(*rows_by)
    elif rows_by:
        d = d.sortWithinPartitions(*rows_by)
    head, number = header_bytes(bam_header(refs, "coordinate" if coordinate else "unsorted"), refs), {n: i for i, (n, _) in enumerate(refs)}
    part = F.spark_partition_id()
    d = d.withColumn("__part", part)

    def run(batches):
        name, out = None, None

        def close():
            out.close()
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([out.n], pa.int64())], ["file", "records"])

        for b in batches:
            for row in b.to_pylist():
                key = row["__by"] or f"part-{row['__part']:05d}"
                if key != name:
                    if out is not None:
                        yield close()
                    name, out = key, _Writer(f"{path}/{key}.bam", head, len(refs), coordinate)
                out.add(record_bytes(tuple(row[c] for c in _NAMES), number), number.get(row["ref"], -1), row["pos"], covered_end(row["pos"], row["cigar"]))
        if out is not None:
            yield close()

    # the files are written by this action; the list of them is small
    rows = d.mapInArrow(run, "file string, records long").collect()
    return df.sparkSession.createDataFrame([tuple(r) for r in rows], "file string, records long")
