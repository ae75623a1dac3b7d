"""Importance resampling of documents towards a target text, by hashed runs of words.

Features are counted by an automaton over the bytes of whole Arrow buffers: a lookup table folds case and tells word
bytes from others, differences of that mask are the word boundaries, and one table-driven step moves the CRC of every
feature on by a byte, for all starts at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ranking import ordinals
from .common import find_package, settle, slices, table, text_of, tidy

BUCKETS = 10_000
RUN = 1  # words in the longest feature
LEAST_WORDS = 20  # of a document that may be drawn
SHARE = 10  # of a hundred documents that are drawn
SEED = "2024"
LANE = 64  # bytes that a long feature's lanes advance at once

_BYTES = np.arange(256)
#: What the automaton writes for a byte: itself, A-Z in lower case, 0 for bytes that no word holds.
FOLD = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
FOLD[~(((FOLD >= 0x30) & (FOLD <= 0x39)) | ((FOLD >= 0x61) & (FOLD <= 0x7A)) | (FOLD >= 0x80))] = 0


def crc_table() -> np.ndarray:
    """The byte table of the reflected CRC-32 polynomial."""
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> np.uint32(1)) ^ np.uint32(0xEDB88320), c >> np.uint32(1))
    return c


CRC = crc_table()


def zeros_table(n: int) -> np.ndarray:
    """[4, 256]: what a state byte at each place becomes after n zero bytes; a state's advance is the xor of its four."""
    state = (np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]).ravel()
    for _ in range(n):
        state = CRC[state & np.uint32(255)] ^ (state >> np.uint32(8))
    return state.reshape(4, 256)


LANE_ZEROS = zeros_table(LANE)


def advance(data: np.ndarray, start: np.ndarray, size: np.ndarray, state: np.ndarray) -> np.ndarray:
    """The states after the bytes [start, start + size) of data, every lane moved on by a byte at a time; lanes have LANE bytes at most."""
    order = np.argsort(-size, kind="stable")
    at, out = start[order], state[order]
    left = np.searchsorted(-size[order], -np.arange(1, int(size.max(initial=0)) + 1), "right")  # lanes that have a k-th byte
    for k, n in enumerate(left):
        s = out[:n]
        out[:n] = CRC[(s ^ data[at[:n] + k]) & np.uint32(255)] ^ (s >> np.uint32(8))
    back = np.empty_like(out)
    back[order] = out
    return back


def crc32(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """CRC-32 of the spans [start, end) of data.

    A span beyond LANE bytes is several lanes: its first holds what is over, each other one LANE bytes from state 0; a lane's end
    state is then moved on over the LANE zero bytes that stand for the next one, whose own is added (CRCs are linear).
    """
    size = end - start
    lanes = np.maximum(-(-size // LANE), 1)
    first = np.cumsum(lanes) - lanes
    nth = np.arange(int(lanes.sum())) - np.repeat(first, lanes)
    head = size - (lanes - 1) * LANE
    at = np.repeat(start, lanes) + np.where(nth == 0, 0, np.repeat(head, lanes) + (nth - 1) * LANE)
    ends = advance(data, at, np.where(nth == 0, np.repeat(head, lanes), LANE), np.where(nth == 0, np.uint32(0xFFFFFFFF), np.uint32(0)).astype(np.uint32))
    out = ends[first]
    order = np.argsort(-lanes, kind="stable")
    left = np.searchsorted(-lanes[order], -np.arange(2, int(lanes.max(initial=1)) + 1), "right")  # spans that have a further lane
    for k, n in enumerate(left, 1):
        who = order[:n]
        s = out[who]
        moved = LANE_ZEROS[0][s & np.uint32(255)] ^ LANE_ZEROS[1][(s >> np.uint32(8)) & np.uint32(255)] ^ LANE_ZEROS[2][(s >> np.uint32(16)) & np.uint32(255)] ^ LANE_ZEROS[3][s >> np.uint32(24)]
        out[who] = moved ^ ends[first[who] + k]
    return out ^ np.uint32(0xFFFFFFFF)


def features(data: np.ndarray, off: np.ndarray, run: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, bucket) of every feature of the texts data[off[i] : off[i + 1]], and how many words each text has."""
    low = FOLD[data]
    solid = np.zeros(len(low) + 2, bool)
    solid[1:-1] = low != 0
    edge = np.zeros(len(low) + 1, bool)
    edge[off] = True
    starts = np.flatnonzero(solid[1:-1] & (~solid[:-2] | edge[:-1]))
    ends = np.flatnonzero(solid[1:-1] & (~solid[2:] | edge[1:])) + 1
    doc = np.searchsorted(off, starts, "right") - 1
    if run > 1:  # words side by side with one space between, so that a run of words is one span
        size = ends - starts
        to = np.cumsum(size + 1) - size - 1
        line = np.full(int((size + 1).sum()), 32, np.uint8)
        spread = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        line[np.repeat(to, size) + spread] = low[np.repeat(starts, size) + spread]
        low, starts, ends = line, to, to + size
    who, hashed = [], []
    for k in range(1, run + 1):
        i = np.flatnonzero(doc[: len(doc) - k + 1] == doc[k - 1 :]) if len(doc) >= k else np.zeros(0, np.int64)
        who.append(doc[i])
        hashed.append(crc32(low, starts[i], ends[i + k - 1]) % np.uint32(buckets))
    return np.concatenate(who), np.concatenate(hashed).astype(np.int64), np.bincount(doc, minlength=len(off) - 1)


def bucket_counts(texts: DataFrame, text_col: str = "text", run: int = RUN, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): features of all texts in each bucket that has any. A task adds its texts up before it sends a row a bucket."""
    find_package(texts.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, data, off in slices(batch.column(0)):
                total += np.bincount(features(data, off, run, buckets)[1], minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "n"])

    return texts.select(text_of(text_col)).mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


@tidy
def gains(raw: DataFrame, target: DataFrame, text_col: str = "text", run: int = RUN, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, gain) for each of the buckets: floor(1000 ln) of how much likelier a feature of the target lies there than one of raw, one added to each count."""
    counted = [settle(bucket_counts(t, text_col, run, buckets)) for t in (raw, target)]
    s, t = [F.coalesce(F.col(c), F.lit(0)).cast("double") for c in ("s", "t")]
    total = lambda df: F.lit(df.agg(F.sum("n")).first()[0] or 0).cast("double")
    every = raw.sparkSession.range(buckets).select(F.col("id").alias("bucket"))
    every = every.join(counted[0].withColumnRenamed("n", "s"), "bucket", "left").join(counted[1].withColumnRenamed("n", "t"), "bucket", "left")
    odds = (t + 1) * (total(counted[0]) + buckets) / ((s + 1) * (total(counted[1]) + buckets))
    return settle(every.select("bucket", F.floor(1000 * F.log(odds)).alias("gain")), keep=True)


def weigh(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text", run: int = RUN) -> DataFrame:
    """(id, n_words, n_features, weight): weight is the floored mean gain of a text's features, 0 without any."""
    find_package(docs.sparkSession)
    buckets = len(gain)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, off in slices(batch.column(1)):
                doc, bucket, words = features(data, off, run, buckets)
                n = np.bincount(doc, minlength=hi - lo)
                total = np.zeros(hi - lo, np.int64)
                np.add.at(total, doc, gain[bucket])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), *map(pa.array, (words.astype(np.int64), n.astype(np.int64), total // np.maximum(n, 1)))], ["id", "n_words", "n_features", "weight"])

    return docs.select(F.col(id_col).alias("id"), text_of(text_col)).mapInArrow(score, f"id {docs.schema[id_col].dataType.simpleString()}, n_words long, n_features long, weight long")


def gumbel(id_col: str | Column, seed: str = SEED) -> Column:
    """floor(1000 g) of a Gumbel variate that the sha256 of `seed:id` draws; a null id counts as the empty text."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(c.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


@tidy
def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", run: int = RUN, buckets: int = BUCKETS, share: int = SHARE, least_words: int = LEAST_WORDS, seed: str = SEED) -> DataFrame:
    """(id, n_words, n_features, weight, score, rank), a row for each row of docs; rank 1, 2, ... is null for rows that are not drawn.

    Of the N documents with least_words words or more, floor(share * N / 100) are drawn without replacement, by the largest weight plus
    Gumbel noise; that is a draw by importance weights. Ties go to the smaller id, null first; repeated rows are rows of
    their own and take ranks of their own. Null and empty texts have no words, weight 0, and are never drawn. Without a target text every
    gain comes from the documents alone.

    The driver holds one number a bucket. Ranks come from ranges of (score, id) sorted over all tasks.
    """
    found = gains(docs, target, text_col, run, buckets)
    gain = np.zeros(buckets, np.int64)
    rows = found.toArrow()  # a row for each of `buckets`
    gain[rows.column("bucket").to_numpy()] = rows.column("gain").to_numpy()
    scored = settle(weigh(docs, gain, id_col, text_col, run).withColumn("score", F.col("weight") + gumbel("id", seed)))
    wide = scored.where(F.col("n_words") >= least_words)
    drawn = share * wide.count() // 100
    placed = ordinals(wide, [F.desc("score"), F.col("id").asc_nulls_first()], "rank")
    out = placed.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    return settle(out.unionByName(scored.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))), keep=True)


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: n_features, weight, score, rank; the benchmark texts are the target."""
    out = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")


#: The byte table comes from its rule; each different word is hashed once.
ORACLE = r"""
with crc as (select list(list_reduce(range(8), lambda c, k: case when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end, n) order by n) as c from range(256) r(n)),
d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
b as (select regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
dw as (select doc_id, unnest(w) as w from d),
bw as (select unnest(w) as w from b),
v as (select w, hex(encode(w)) as h from (select w from dw union select w from bw)),
k as (select w, xor(list_reduce(range(length(h) // 2), lambda s, i: xor(s // 256, c[xor(s % 256, cast('0x' || substr(h, 2 * i + 1, 2) as bigint)) + 1]), 4294967295), 4294967295) % 10000 as bucket from v, crc),
s as (select bucket, count(*) as s from dw join k using (w) group by bucket),
t as (select bucket, count(*) as t from bw join k using (w) group by bucket),
st as (select cast((select count(*) from dw) as double) as ns, cast((select count(*) from bw) as double) as nt),
g as (select bucket, cast(floor(1000 * ln((coalesce(t, 0) + 1) * (ns + 10000) / ((s + 1) * (nt + 10000)))) as bigint) as gain from s left join t using (bucket), st),
m as (select doc_id, count(*) as n, sum(gain) as total from dw join k using (w) join g using (bucket) group by doc_id),
x as (select d.doc_id, coalesce(n, 0) as n_features, cast(case when n > 0 then floor(total / n) else 0 end as bigint) as weight, cast('0x' || substr(sha256('2024:' || d.doc_id), 1, 8) as bigint) as h from d left join m using (doc_id)),
y as (select doc_id, n_features, weight, weight + cast(floor(-1000 * ln(-ln((h + 0.5) / 4294967296))) as bigint) as score from x),
z as (select *, case when n_features >= 20 then row_number() over (partition by n_features >= 20 order by score desc, doc_id) end as r from y)
select doc_id, n_features, weight, score, case when r <= 10 * (select count(*) from y where n_features >= 20) // 100 then r end as rank from z
"""
