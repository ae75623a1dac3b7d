"""What the corpus operators share: scratch tables, word counts, exact ranks, Arrow text buffers.

Conventions for every operator of this subpackage: a null text counts as an empty one; an operator
reads only the columns it is told to and returns only those it names (or, where it says so, all the
columns it was given), so further columns of any name do no harm; an empty table gives an empty result;
repeated rows are rows of their own unless an operator says otherwise.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators.spread import join_spread  # noqa: F401
from ..scratch import delete, exists, hold, put, settle, shared_dir, sweep, tidy  # noqa: F401
from ..shipping import ship

WORD = r"[^\x20\x09-\x0D]+"
DEEP = 4  # digits of ranges whose sums one task adds up for a group
BATCH_ROWS = 1000  # rows of an Arrow batch: texts are long
SLICE_BYTES = 1 << 19  # text handled at once by the numpy code


def find_package(spark: SparkSession) -> None:
    """Ships this package to the executors once a session, and keeps Arrow batches of texts small."""
    ship(spark)
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(rows)) > BATCH_ROWS:
        spark.conf.set(rows, BATCH_ROWS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    find_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def column(name: str, of: str = "") -> Column:
    """A column, or a field of the struct `of`, whatever signs its name has."""
    quoted = "`" + name.replace("`", "``") + "`"
    return F.col(f"{of}.{quoted}" if of else quoted)


def packed(docs: DataFrame, without: str = "") -> Column:
    """All columns of docs as one struct, but for one that has the name `without` in any case of letters."""
    return F.struct(*[column(c).alias(c) for c in docs.columns if c.lower() != without.lower()])


def free_name(df: DataFrame, name: str) -> str:
    """The name, with signs behind it while df has a column so called in any case of letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_of(col: str | Column) -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def word_count(col: str | Column) -> Column:
    return F.regexp_count(text_of(col), F.lit(WORD)).cast("long")


def crc_mod(id_col: str | Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as the empty text."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.pmod(F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")), F.lit(n).cast("long"))


def order_key(id_col: str) -> Column:
    """A fixed pseudo-random order of ids, as 32 hex digits."""
    return F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")))


def digits_for(rows: int, per_bucket: int = 2000) -> int:
    """Hex digits of an order key that leave about per_bucket rows to a prefix."""
    d = 0
    while rows > per_bucket * 16**d and d < 8:
        d += 1
    return d


def with_prefix(df: DataFrame, group: str, key: str, tie: list[str], value: str, out: str, digits: int, slim: DataFrame | None = None) -> DataFrame:
    """Adds `out`: the exact sum of `value` over the rows of the group that come before in (key, *tie) order.

    A group may hold any share of the rows: each is cut into 16**digits ranges of the key. Sums by (group,
    range) are added up first, rows only within their range, so no task holds a whole group. `group` and
    `key` must not be null. Rows equal in all of key and tie come in any order among themselves. `slim` may hold
    group, key and value of the same rows, cheaper to read than df.
    """
    cut, lead, part = f"__{out}_cut", f"__{out}_lead", f"__{out}_part"
    range_ = F.substring(F.col(key), 1, digits) if digits else F.lit("")
    sums = (df if slim is None else slim).withColumn(cut, range_)
    df = df.withColumn(cut, range_)
    leads = sums.groupBy(group, cut).agg(F.sum(value).alias(part))
    if digits > DEEP:  # too many ranges for one task: their sums are added up in the same way
        leads = with_prefix(leads, group, cut, [], part, lead, digits - DEEP).select(group, cut, lead)
    else:
        before = Window.partitionBy(group).orderBy(cut).rowsBetween(Window.unboundedPreceding, -1)
        leads = leads.select(group, cut, F.coalesce(F.sum(part).over(before), F.lit(0)).cast("long").alias(lead))
    inside = Window.partitionBy(group, cut).orderBy(key, *tie).rowsBetween(Window.unboundedPreceding, -1)
    df = df.withColumn(out, F.coalesce(F.sum(value).over(inside), F.lit(0)).cast("long"))
    return df.join(leads, [group, cut]).withColumn(out, F.col(out) + F.col(lead)).drop(cut, lead)


def slices(texts: pa.Array, size: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole texts of about `size` bytes: first row, row past the last, bytes, offsets of the run's rows."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.fill_null("").cast(pa.large_binary())
    n = len(texts)
    if not n:
        return
    bufs = texts.buffers()
    off = np.frombuffer(bufs[1], np.int64)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None and bufs[2].size else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + size, "right")) - 1)
        hi = min(hi, n)
        yield lo, hi, data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo]
        lo = hi


def pieces(batch: pa.RecordBatch, column: int, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows that hold about `size` bytes of the column, one row at least."""
    length = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), np.int64)
    ends, lo = np.cumsum(length), 0
    while lo < batch.num_rows:
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + size, "right")))
        yield batch.slice(lo, hi - lo)
        lo = hi


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit words (the splitmix64 finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
BYTE_CODE = mix64(np.arange(1, 257, dtype=np.uint64))
_POWERS: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i for i in 0..n, modulo 2**64."""
    if "up" not in _POWERS or len(_POWERS["up"]) <= n:
        size = max(n + 1, SLICE_BYTES + (SLICE_BYTES >> 2))
        for name, base in (("up", BASE), ("down", BASE_INV)):
            x = np.full(size, base, np.uint64)
            x[0] = 1
            _POWERS[name] = np.multiply.accumulate(x)
    return _POWERS["up"], _POWERS["down"]


def rolling(codes: np.ndarray) -> np.ndarray:
    """Prefix sums of codes[i] * BASE**i; span_hash reads the hash of any span off them."""
    up, _ = powers(len(codes))
    out = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(codes * up[: len(codes)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the spans [start, end)."""
    _, down = powers(len(prefix))
    return mix64((prefix[end] - prefix[start]) * down[start] + (end - start).astype(np.uint64))


def spaces(data: np.ndarray) -> np.ndarray:
    return (data == 32) | ((data >= 9) & (data <= 13))


def word_spans(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words; a word never crosses from one text to the next."""
    n = len(data)
    solid = np.zeros(n + 2, bool)
    solid[1:-1] = ~spaces(data)
    edge = np.zeros(n + 1, bool)
    edge[off] = True
    starts = np.flatnonzero(solid[1:-1] & (~solid[:-2] | edge[:-1]))
    ends = np.flatnonzero(solid[1:-1] & (~solid[2:] | edge[1:])) + 1
    return starts, ends


def doc_sums(values: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Sums of values over [off[i], off[i+1])."""
    total = np.zeros(len(values) + 1, np.float64 if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=total[1:])
    return total[off[1:]] - total[off[:-1]]
