"""Baseline JPEG media columns: payload bytes as DC coefficients, and a decoder that reads DC-only thumbnails.

A baseline JPEG whose luminance quantiser has 8 at DC gives an 8x8 block with DC level v and no AC levels
the mean 128 + v. A payload byte b is stored as the block of level b - 128, so the DC-only thumbnail of the
image is the payload itself, losslessly. A frame is WIDTH blocks wide, at most ROWS block rows high, and restarts its
predictor after each row (a restart marker), so rows can be decoded side by side.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import pieces, table

UNIT = 192
WIDTH = 192  # blocks
ROWS = 8191  # block rows that the 16-bit height of a frame can count
LANES = 16_384  # rows coded or decoded side by side
#: The zigzag order of the 64 coefficients is not needed: only coefficient 0 is read, the others are skipped.
SOI, EOI, SOF0, DHT, DQT, DRI, SOS, RST0 = 0xD8, 0xD9, 0xC0, 0xC4, 0xDB, 0xDD, 0xDA, 0xD0
DC_CODE = 4  # bits of each DC category's code
AC_CODE = 1  # bits of the end-of-block code


def segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


def header(width: int, rows: int) -> bytes:
    """Everything before the scan of a one-component frame of width x rows blocks."""
    quantiser = bytes([0, 8] + [1] * 63)
    frame = struct.pack(">BHHBBBB", 8, rows * 8, width * 8, 1, 1, 0x11, 0)
    dc = bytes([0x00] + [0] * (DC_CODE - 1) + [12] + [0] * (16 - DC_CODE)) + bytes(range(12))
    ac = bytes([0x10] + [1] + [0] * 15) + bytes([0])
    scan = bytes([1, 1, 0x00, 0, 63, 0])
    return b"\xff\xd8" + segment(DQT, quantiser) + segment(SOF0, frame) + segment(DHT, dc) + segment(DHT, ac) + segment(DRI, struct.pack(">H", width)) + segment(SOS, scan)


#: Per difference from -255 to 255: its code with amplitude and end of block, and the bits of that.
_DIFF = np.arange(-255, 256)
_CAT = np.array([int(abs(d)).bit_length() for d in _DIFF])
_AMP = np.where(_DIFF >= 0, _DIFF, _DIFF + (1 << _CAT) - 1)
CODE = ((((_CAT << _CAT) | _AMP) << AC_CODE)).astype(np.uint16)
BITS = (DC_CODE + _CAT + AC_CODE).astype(np.int64)


def encode_scan(levels: np.ndarray) -> list[bytes]:
    """Entropy-coded bytes of each row of levels (rows x width, 0..255), predictor 128 at each row's start."""
    rows, width = levels.shape
    diff = np.diff(levels.astype(np.int16), axis=1, prepend=np.int16(128)) + 255
    code, bits = CODE[diff], BITS[diff]
    used = bits.sum(1)
    size = (used + 7) >> 3
    first = np.concatenate([[0], np.cumsum(size)])
    at = (np.cumsum(bits, axis=1) - bits + (first[:-1] * 8)[:, None]).ravel()
    code, bits = code.ravel(), bits.ravel()
    stream = np.ones(first[-1] * 8, np.uint8)  # the last byte of a row is filled with ones
    for j in range(int(bits.max())):
        on = np.flatnonzero(bits > j)
        stream[at[on] + j] = (code[on] >> (bits[on] - 1 - j)) & 1
    packed = np.packbits(stream)
    full = packed == 0xFF
    grown = np.concatenate([[0], np.cumsum(full)])[first] + first
    out = np.zeros(len(packed) + int(full.sum()), np.uint8)
    out[np.arange(len(packed)) + np.cumsum(full) - full] = packed
    raw = out.tobytes()
    return [raw[a:b] for a, b in zip(grown[:-1], grown[1:])]


def encode(payloads: list[bytes]) -> list[bytes]:
    """One media value per payload (a positive multiple of UNIT bytes): one frame after another."""
    levels = np.frombuffer(b"".join(payloads), np.uint8).reshape(-1, WIDTH)
    scans = [s for lo in range(0, len(levels), LANES // 2) for s in encode_scan(levels[lo : lo + LANES // 2])]
    out, at = [], 0
    for p in payloads:
        rows, parts = len(p) // WIDTH, []
        for lo in range(0, rows, ROWS):
            n = min(ROWS, rows - lo)
            parts.append(header(WIDTH, n))
            for i in range(n):
                parts.append(scans[at + lo + i])
                if i < n - 1:
                    parts.append(bytes([0xFF, RST0 + i % 8]))
            parts.append(b"\xff\xd9")
        at += rows
        out.append(b"".join(parts))
    return out


@dataclass
class Frame:
    """A parsed frame: size in blocks of its luminance, the DC quantiser, and its scan.

    units is the order of the blocks in a coding unit, as numbers of components; tables of (bits, symbol) by the next 16 bits,
    DC and AC, of each component; across and down are the units in the frame, h and v the luminance blocks in a unit; interval is
    in units. scans are the parts between restart markers.
    """

    width: int
    rows: int
    quantiser: int
    units: tuple[int, ...]
    dc: tuple[np.ndarray, ...]
    ac: tuple[np.ndarray, ...]
    across: int
    down: int
    h: int
    v: int
    interval: int
    scans: list[bytes]


def lookup(counts: bytes, symbols: bytes) -> np.ndarray:
    """bits * 256 + symbol for each 16-bit word that starts with a code; 0 where none does."""
    out, code, k = np.zeros(1 << 16, np.int32), 0, 0
    for length in range(1, 17):
        for _ in range(counts[length - 1]):
            low = code << (16 - length)
            out[low : low + (1 << (16 - length))] = length * 256 + symbols[k]
            code, k = code + 1, k + 1
        code <<= 1
    return out


_TABLES: dict[bytes, np.ndarray] = {}


def split_scan(scan: bytes) -> list[bytes]:
    """The parts of a scan between restart markers, stuffed zeros removed."""
    cuts, i = [], scan.find(b"\xff")
    while 0 <= i < len(scan) - 1:
        if RST0 <= scan[i + 1] < RST0 + 8:
            cuts.append(i)
        i = scan.find(b"\xff", i + 2)
    return [scan[a:b].replace(b"\xff\x00", b"\xff") for a, b in zip([0, *[c + 2 for c in cuts]], [*cuts, len(scan)])]


def parse(media: bytes) -> list[Frame]:
    """The frames of a media value; ValueError for anything but 8-bit baseline frames with all components in one scan.

    The first component is the luminance. Its blocks lie in units with those of the others as their sampling factors say; a frame
    of one component has units of one block.
    """
    frames, at, n = [], 0, len(media)
    while at < n:
        if media[at : at + 2] != b"\xff\xd8":
            raise ValueError("no start of image")
        at += 2
        tables: dict[int, np.ndarray] = {}
        quantisers: dict[int, int] = {}
        parts: list[tuple[int, int, int, int]] = []  # id, horizontal and vertical sampling, quantiser
        pixels, interval = None, 0
        while True:
            if at + 4 > n or media[at] != 0xFF:
                raise ValueError("no marker")
            kind, length = media[at + 1], struct.unpack(">H", media[at + 2 : at + 4])[0]
            body = media[at + 4 : at + 2 + length]
            at += 2 + length
            if len(body) != length - 2:
                raise ValueError("segment cut short")
            if kind == DQT:
                i = 0
                while i < len(body):
                    wide = body[i] >> 4
                    quantisers[body[i] & 15] = struct.unpack(">H", body[i + 1 : i + 3])[0] if wide else body[i + 1]
                    i += 129 if wide else 65
            elif kind == DHT:
                i = 0
                while i < len(body):
                    k = sum(body[i + 1 : i + 17])
                    key = body[i + 1 : i + 17 + k]
                    if key not in _TABLES:
                        if len(_TABLES) > 64:
                            _TABLES.clear()
                        _TABLES[key] = lookup(key[:16], key[16:])
                    tables[body[i]] = _TABLES[key]
                    i += 17 + k
            elif kind == SOF0:
                bits, height, width, count = struct.unpack(">BHHB", body[:6])
                parts = [(body[6 + 3 * i], body[7 + 3 * i] >> 4, body[7 + 3 * i] & 15, body[8 + 3 * i]) for i in range(count)]
                if bits != 8 or not width or not height or not parts or not all(1 <= h <= 4 and 1 <= v <= 4 for _, h, v, _ in parts):
                    raise ValueError("not an 8-bit frame")
                pixels = width, height
            elif 0xC1 <= kind <= 0xCF and kind != DHT:
                raise ValueError("not baseline")
            elif kind == DRI:
                interval = struct.unpack(">H", body[:2])[0]
            elif kind == SOS:
                if body[0] != len(parts) or [body[1 + 2 * i] for i in range(body[0])] != [p[0] for p in parts]:
                    raise ValueError("not all components in one scan")
                try:
                    used = [(tables[body[2 + 2 * i] >> 4], tables[0x10 | (body[2 + 2 * i] & 15)]) for i in range(len(parts))]
                    quantiser = quantisers[parts[0][3]]
                except KeyError:
                    raise ValueError("table missing") from None
                break
        end = media.find(b"\xff\xd9", at)  # 0xFF in a scan is followed by 0 or a restart marker
        if end < 0 or pixels is None:
            raise ValueError("no end of image")
        high, wide = max(p[1] for p in parts), max(p[2] for p in parts)
        size = -(-pixels[0] * parts[0][1] // (8 * high)), -(-pixels[1] * parts[0][2] // (8 * wide))
        if len(parts) == 1:
            h, v, across, down = 1, 1, *size
        else:
            h, v, across, down = parts[0][1], parts[0][2], -(-pixels[0] // (8 * high)), -(-pixels[1] // (8 * wide))
        units = (0,) if len(parts) == 1 else tuple(c for c, p in enumerate(parts) for _ in range(p[1] * p[2]))
        scans = split_scan(media[at:end]) if interval else [media[at:end].replace(b"\xff\x00", b"\xff")]
        step = interval or across * down
        if len(scans) != -(-across * down // step):
            raise ValueError("restart markers missing")
        frames.append(Frame(*size, quantiser, units, tuple(d for d, _ in used), tuple(a for _, a in used), across, down, h, v, step, scans))
        at = end + 2
    if not frames:
        raise ValueError("no image")
    return frames


def decode_lanes(scans: list[bytes], count: int, units: tuple[int, ...], dc: tuple[np.ndarray, ...], ac: tuple[np.ndarray, ...]) -> np.ndarray:
    """DC levels of component 0 (scans x its blocks) of scans of `count` units that share their tables, one step of all scans at a time."""
    start = np.concatenate([[0], np.cumsum([len(s) + 4 for s in scans])])[:-1]
    data = np.frombuffer(b"".join(s + b"\0\0\0\0" for s in scans), np.uint8)
    wide = (data[:-3].astype(np.uint32) << 24) | (data[1:-2].astype(np.uint32) << 16) | (data[2:-1].astype(np.uint32) << 8) | data[3:]
    limit = np.int64(len(wide) - 1)
    pos = start * 8
    level = np.zeros((len(dc), len(scans)), np.int32)
    out = np.zeros((count * units.count(0), len(scans)), np.int32)

    def peek(p):
        at = np.minimum(p >> 3, limit)
        return (wide[at] << (p & 7).astype(np.uint32)) >> np.uint32(8)  # 24 bits, of which at least the first 16 hold data

    k = 0
    for _ in range(count):
        for c in units:
            found = dc[c][peek(pos) >> np.uint32(8)]
            pos += found >> 8
            size = found & 255
            raw = (peek(pos) >> (24 - size).astype(np.uint32)).astype(np.int32)
            level[c] += np.where(raw >= (1 << size >> 1), raw, raw - (1 << size) + 1)
            if c == 0:
                out[k] = level[0]
                k += 1
            pos += size
            live, seen = np.arange(len(scans)), np.ones(len(scans), np.int64)
            while len(live):  # coefficients 1 to 63: their amplitudes are skipped
                p = pos[live]
                found = ac[c][peek(p) >> np.uint32(8)]
                run, size = (found >> 4) & 15, found & 15
                pos[live] = p + (found >> 8) + size
                if not size.any() and not run.any():
                    break
                seen[live] += run + 1
                go = ((size > 0) | (run == 15)) & (seen[live] < 64)
                live = live[go]
    return out.T


def in_rows(levels: np.ndarray, f: Frame) -> np.ndarray:
    """Luminance levels in coding order as rows x width: a unit holds v rows of h blocks, and units at the edges may jut out."""
    grid = levels[: f.across * f.down * f.h * f.v].reshape(f.down, f.across, f.v, f.h)
    return grid.transpose(0, 2, 1, 3).reshape(f.down * f.v, f.across * f.h)[: f.rows, : f.width]


def frames_of(media: bytes | None) -> list[Frame] | None:
    try:
        return parse(media) if media else None
    except (ValueError, IndexError, struct.error):
        return None


def thumbnails(media: list[bytes | None]) -> list[tuple[int, int, bytes] | None]:
    """Per media value: width and height in samples of its whole blocks (heights of frames added up) and the DC-only luminance thumbnail.

    None for a value that parse does not read, or whose frames differ in width.
    """
    parsed = [frames_of(m) for m in media]
    parsed = [f if f and len({x.width for x in f}) == 1 else None for f in parsed]
    groups: dict[tuple, list[tuple[int, int, int]]] = {}
    for i, frames in enumerate(parsed):
        for j, f in enumerate(frames or []):
            key = tuple(map(id, f.dc)), tuple(map(id, f.ac)), f.units, f.interval
            groups.setdefault(key, []).extend((i, j, k) for k in range(len(f.scans)))
    rows: dict[tuple[int, int, int], np.ndarray] = {}
    for (_, _, units, count), members in groups.items():
        for lo in range(0, len(members), LANES):
            part = members[lo : lo + LANES]
            one = parsed[part[0][0]][part[0][1]]
            got = decode_lanes([parsed[i][j].scans[k] for i, j, k in part], count, units, one.dc, one.ac)
            rows.update(zip(part, got))
    out: list[tuple[int, int, bytes] | None] = []
    for i, frames in enumerate(parsed):
        if frames is None:
            out.append(None)
            continue
        thumb = []
        for j, f in enumerate(frames):
            level = in_rows(np.concatenate([rows[i, j, k] for k in range(len(f.scans))]), f)
            thumb.append(np.clip((level * f.quantiser + 4 >> 3) + 128, 0, 255).astype(np.uint8).tobytes())
        out.append((frames[0].width * 8, sum(f.rows for f in frames) * 8, b"".join(thumb)))
    return out


def difference_hash(width: int, thumb: bytes) -> str:
    """16 hex digits: whether each of 8 x 9 cell means of the thumbnail is below its right neighbour."""
    a = np.frombuffer(thumb, np.uint8).reshape(-1, width // 8)
    r, c = np.linspace(0, a.shape[0], 9).astype(int), np.linspace(0, a.shape[1], 10).astype(int)
    total = np.zeros((a.shape[0] + 1, a.shape[1] + 1), np.int64)
    total[1:, 1:] = a.cumsum(0, dtype=np.int64).cumsum(1)
    box = total[np.maximum(r[1:], r[:-1] + 1)][:, c] - total[r[:-1]][:, c] if a.shape[0] >= 8 else np.repeat(total[-1:][:, c] - total[:1][:, c], 8, 0)
    cells = np.diff(box, axis=1)
    return f"{int.from_bytes(np.packbits(cells[:, :-1] < cells[:, 1:]).tobytes(), 'big'):016x}"


def payload_of(text: str | None) -> tuple[int, bytes]:
    raw = (text or "").encode("utf-8", "surrogatepass")
    return len(raw), raw.ljust(max(1, -(-len(raw) // UNIT)) * UNIT, b" ")


def encode_column(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, media): each whole text as a media value. Null and empty texts give one row of spaces."""

    def run(batches):
        for b in (p for whole in batches for p in pieces(whole, 1)):
            pairs = [payload_of(t.as_py()) for t in b.column(1)]
            media = encode([p for _, p in pairs]) if pairs else []
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([n for n, _ in pairs], pa.int64()), pa.array(media, pa.binary())], ["id", "n_bytes", "media"])

    id_type = docs.schema[id_col].dataType.simpleString()
    return docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).mapInArrow(run, f"id {id_type}, n_bytes long, media binary").withColumnRenamed("id", id_col)


READ = "n_bytes long, width long, height long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def read_column(media: DataFrame, id_col: str = "doc_id", media_col: str = "media", n_col: str = "n_bytes") -> DataFrame:
    """What the stored media say: dimensions, and digests and the difference hash of their thumbnails.

    A value that is null, empty or no media of the kind that parse reads has its id and n_bytes and is null in all other columns.
    """

    def run(batches):
        for b in (p for whole in batches for p in pieces(whole, 2)):
            values = [m.as_py() for m in b.column(2)]
            rows = []
            for m, found in zip(values, thumbnails(values) if values else []):
                if found is None:
                    rows.append((None,) * 8)
                    continue
                w, h, thumb = found
                rows.append((w, h, len(thumb), hashlib.sha256(thumb).hexdigest(), zlib.crc32(thumb[-16:]), len(m), hashlib.sha256(m).hexdigest(), f"{w}x{h}:{difference_hash(w, thumb)}"))
            cols = list(zip(*rows)) if rows else [[]] * 8
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *[pa.array(c, k) for c, k in zip(cols, kinds)]], ["id", *[x.split()[0] for x in READ.split(", ")]])

    id_type = media.schema[id_col].dataType.simpleString()
    return media.select(media[id_col].alias("id"), media[n_col].alias("n"), media[media_col].alias("media")).mapInArrow(run, f"id {id_type}, {READ}").withColumnRenamed("id", id_col)


def op7_media(spark, sf_dir: str) -> DataFrame:
    """Per document: the digests that read_column takes from the media of encode_column."""
    return read_column(encode_column(table(spark, sf_dir, "documents"))).select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "width", "height")


def media_payloads(spark, sf_dir: str) -> DataFrame:
    """What op7_media reads back of the payloads alone, which SQL can say without a decoder."""
    return op7_media(spark, sf_dir).select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32")


PAYLOAD_SQL = """
with b as (select doc_id, encode(coalesce(text, '')) as raw from documents),
n as (select *, octet_length(raw) as n, greatest(1, (octet_length(raw) + 191) // 192) * 192 as size from b),
p as (select doc_id, n, size, hex(raw) || repeat('20', cast(size - n as integer)) as h from n),
t as (select *, list_transform(range(0, 16), lambda i: cast('0x' || substr(h, 2 * (size - 16 + i) + 1, 2) as bigint)) as tail from p)
select doc_id, cast(n as bigint) as n_bytes, cast(size as bigint) as payload_bytes, sha256(unhex(h)) as payload_sha256,
  xor(list_reduce(list_prepend(cast(4294967295 as bigint), tail), lambda c, b: list_reduce(list_prepend(xor(c, b), [cast(0 as bigint) for x in range(8)]), lambda a, z: xor(a >> 1, case when a & 1 = 1 then cast(3988292384 as bigint) else cast(0 as bigint) end))), cast(4294967295 as bigint)) as tail_crc32
from t
"""
