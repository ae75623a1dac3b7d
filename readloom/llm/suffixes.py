"""Removal of repeated byte strings by a stored, logarithmic family of suffix arrays.

A match is a string of SPAN bytes that starts at two places or more. Each window of SPAN bytes is filed under
its anchor, the ANCHOR-byte string in it with the least hash (the leftmost of equals): equal windows have equal
anchors. Windows at neighbouring starts mostly share their anchor's place; such a run of windows is a
segment, so a text has about one segment to each hundred bytes.

A suffix array here is sparse: it holds the suffixes at the starts of segments, ordered by their anchor and then
by the segment, both as 64-bit fingerprints. Matches need no more of an order than that equal beginnings lie
together, and fingerprints spread evenly over the ranges of a table. An Index keeps such arrays as levels, tables
of Parquet in ranges. A new batch of texts is sorted into an array of its own and merge-scanned against every
level: where an anchor occurs again, the windows of its segments are sorted by a fingerprint, equal neighbours are
compared byte by byte and marked, in the batch and in the levels. Then levels of equal size are merged, so n batches
leave log2(n) + 1 levels at most and each suffix is rewritten log2(n) times at most.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BYTE_CODE, delete, exists, hold, join_spread, mix64, pieces, put, rolling, settle, shared_dir, slices, span_hash, table, text_of, tidy

SPAN = 400
ANCHOR = 200
BATCHES = 2  # in which dedup adds the documents to its index
NEW = 1 << 20  # the level number of the batch that is being added
WINDOWS = 16_000  # windows, of SPAN bytes each, that a task sorts at once
ROWS = 2_000  # entries to a task of the scan, about
CROWD = 128  # entries to one shard beyond which they are cut finer
BLOCK = 16  # windows in an aligned block of a crowded anchor
PLACES = np.uint64((1 << 24) - 1)  # bits of a packed minimum that hold the place
PAIRS = 4096  # windows compared byte by byte at once
PIECE = 8 << 20  # window starts handled at once in one very long text
BROADCAST_KEYS = 200_000


def least_places(h: np.ndarray, width: int) -> np.ndarray:
    """For each i the place of the least h (on its upper 40 bits; the leftmost of equals) in h[i : i + width]."""
    m = (h & ~PLACES) | np.arange(len(h), dtype=np.uint64)
    size = 1
    while size * 2 <= width:
        m = np.minimum(m[:-size], m[size:])
        size *= 2
    rest = width - size
    if rest:
        m = np.minimum(m[:-rest], m[rest:])
    return (m & PLACES).astype(np.int64)


def segments(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, start, windows, anchor hash, segment hash) of every segment; start is within the text."""
    out = []
    for a in range(0, max(len(data) - SPAN + 1, 0), PIECE):
        part = data[a : a + PIECE + SPAN - 1]
        prefix = rolling(BYTE_CODE[part])
        at = np.arange(len(part) - ANCHOR + 1)
        h = span_hash(prefix, at, at + ANCHOR)
        place = least_places(h, SPAN - ANCHOR + 1)
        start = np.arange(len(place))
        doc = np.searchsorted(off, start + a, "right") - 1
        start = np.flatnonzero(start + a + SPAN <= off[doc + 1])
        if not len(start):
            continue
        new = np.ones(len(start), bool)
        new[1:] = (np.diff(start) != 1) | (place[start[1:]] != place[start[:-1]])
        first = np.flatnonzero(new)
        n = np.diff(np.concatenate([first, [len(start)]]))
        lo = start[first]
        out.append((doc[lo], lo + a - off[doc[lo]], n, h[place[lo]], span_hash(prefix, lo, lo + n - 1 + SPAN)))
    if not out:
        none = np.zeros(0, np.int64)
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    return tuple(np.concatenate(x) for x in zip(*out))


def merged(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Two sorted arrays of (keys, numbers) as one."""
    keys = np.concatenate([a[0], b[0]])
    order = np.argsort(keys, kind="stable")  # two sorted runs: a merge
    return keys[order], np.concatenate([a[1], b[1]])[order]


def equal_neighbours(keys: np.ndarray, number: np.ndarray) -> np.ndarray:
    """Numbers of the windows, in sorted order, whose longest common prefix with a neighbour reaches SPAN."""
    same = keys[1:] == keys[:-1]
    return np.concatenate([number[1:][same], number[:-1][same]])


def runs_of(marked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the runs of True."""
    edge = np.diff(np.concatenate([[0], marked.astype(np.int8), [0]]))
    start = np.flatnonzero(edge == 1)
    return start, np.flatnonzero(edge == -1) - start


def window_keys(text: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Keys that are equal where the windows at these places are: 64-bit fingerprints, once the bytes of all that share one were found equal; else the bytes themselves."""
    keys = span_hash(rolling(BYTE_CODE[text]), at, at + SPAN)
    windows = np.lib.stride_tricks.sliding_window_view(text, SPAN)
    order = np.argsort(keys, kind="stable")
    pairs = np.flatnonzero(keys[order][1:] == keys[order][:-1])
    for lo in range(0, len(pairs), PAIRS):
        i = pairs[lo : lo + PAIRS]
        if not np.array_equal(windows[at[order[i]]], windows[at[order[i + 1]]]):
            return np.ascontiguousarray(windows[at]).view(f"S{SPAN}").ravel()
    return keys


def repeated(text: np.ndarray, start: np.ndarray, n: np.ndarray, held: np.ndarray, level: np.ndarray) -> np.ndarray:
    """Which windows of a shard occur twice or more with a place in the new batch.

    The batch's windows are sorted by their keys, compared among themselves, and merge-scanned against the windows of each
    level in turn. An entry stands for `held` places of the same bytes.
    """
    who = np.repeat(np.arange(len(n)), n)
    at = start[who] + np.arange(len(who)) - np.repeat(np.cumsum(n) - n, n)
    keys = window_keys(text, at)
    of = level[who]
    mark = (of == NEW) & (held[who] > 1)

    def array(l: int) -> tuple[np.ndarray, np.ndarray]:
        mine = np.flatnonzero(of == l)
        order = np.argsort(keys[mine], kind="stable")
        return keys[mine][order], mine[order]

    batch = array(NEW)
    if len(batch[0]):
        mark[equal_neighbours(*batch)] = True
        for l in np.unique(level[level != NEW]):
            mark[equal_neighbours(*merged(array(l), batch))] = True
    return mark


def index_shards(entries: DataFrame) -> DataFrame:
    """(anchor, segment, held, n, level, body), sharded and sorted by anchor -> (anchor, segment, start, n): runs of repeated windows."""

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
        todo, windows = [], 0
        for b in batches:
            for row in zip(*[c.to_pylist() for c in b.columns]):
                if windows >= WINDOWS and row[0] != todo[-1][0]:
                    yield todo
                    todo, windows = [], 0
                todo.append(row)
                windows += row[3]
        if todo:
            yield todo

    def run(batches):
        for rows in groups(batches):
            anchor, segment, held, n, level, body = zip(*rows)
            n = np.array(n)
            start = np.concatenate([[0], np.cumsum([len(x) for x in body])])[:-1]
            mark = repeated(np.frombuffer(b"".join(body), np.uint8), start, n, np.array(held), np.array(level))
            out: list[list] = [[], [], [], []]
            for i, (hi, k) in enumerate(zip(np.cumsum(n), n)):
                s, length = runs_of(mark[hi - k : hi])
                out[0] += [anchor[i]] * len(s)
                out[1] += [segment[i]] * len(s)
                out[2] += s.tolist()
                out[3] += length.tolist()
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], ["anchor", "segment", "start", "n"])

    return entries.mapInArrow(run, "anchor long, segment long, start long, n long")


def sharded(entries: DataFrame, count: int) -> DataFrame:
    """Runs of repeated windows of entries of which each shard key has CROWD at most."""
    # a given number of partitions: sorting 400 bytes a window takes long for the size of the rows
    tasks = max(int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions")), count // ROWS)
    return index_shards(entries.repartition(tasks, "anchor").sortWithinPartitions("anchor"))


def align_blocks(entries: DataFrame) -> DataFrame:
    """Entries of crowded anchors -> (anchor, segment, held, level, first, lead, shard, piece, n, body): aligned blocks of at most BLOCK windows.

    A window's block is its distance to the anchor, in steps of BLOCK. All windows of a block hold the same
    SPAN - BLOCK + 1 bytes, the core; equal windows have equal cores. `shard` is a fingerprint of anchor, block
    and core, `piece` one of the block's whole body, `first` the block's first window in the segment, `lead` how far
    before the core that window starts.
    """

    def run(batches):
        for b in (p for whole in batches for p in pieces(whole, 5, 1 << 18)):
            out: list[list] = [[] for _ in range(10)]
            for anchor, segment, held, n, level, body in zip(*[c.to_pylist() for c in b.columns]):
                data = np.frombuffer(body, np.uint8)
                prefix = rolling(BYTE_CODE[data])
                at = np.arange(SPAN - ANCHOR + 1)
                place = int(np.flatnonzero(span_hash(prefix, at, at + ANCHOR).view(np.int64) == anchor)[0])
                lo = 0
                while lo < n:  # windows lo.. that share (place - window) // BLOCK
                    block = (place - lo) // BLOCK if place >= lo else -((lo - place + BLOCK - 1) // BLOCK)
                    core = place - block * BLOCK
                    hi = min(n, core + 1)
                    mark = span_hash(prefix, np.array([core, lo]), np.array([core + SPAN - BLOCK + 1, hi - 1 + SPAN]))
                    shard = mix64(mark[:1] + mix64(np.array([anchor, block], np.int64).view(np.uint64)).sum(keepdims=True)).view(np.int64)[0]
                    for c, x in zip(out, (anchor, segment, held, level, lo, core - lo, int(shard), int(mark[1:].view(np.int64)[0]), hi - lo, body[lo : hi - 1 + SPAN])):
                        c.append(x)
                    lo = hi
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], ["anchor", "segment", "held", "level", "first", "lead", "shard", "piece", "n", "body"])

    return entries.mapInArrow(run, "anchor long, segment long, held long, level int, first int, lead int, shard long, piece long, n int, body binary")


def sort_windows(blocks: DataFrame) -> DataFrame:
    """As index_shards, for blocks (anchor, segment, held, n, level, body, lead) of cores that very many different blocks share.

    Windows of one core at one distance before it differ in the BLOCK - 1 bytes around it alone. These, behind core and distance, are
    the key by which Spark sorts them over all tasks; windows of one key are one place of the array.
    """

    def run(batches):
        for b in (p for whole in batches for p in pieces(whole, 5, 1 << 18)):
            out: list[list] = [[] for _ in range(7)]
            for anchor, segment, held, n, level, body, lead in zip(*[c.to_pylist() for c in b.columns]):
                core = lead + SPAN - BLOCK + 1
                for i in range(n):
                    for c, x in zip(out, (anchor, segment, held, level, i, lead - i, body[i:lead] + body[core : i + SPAN])):
                        c.append(x)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], ["anchor", "segment", "held", "level", "start", "before", "edge"])

    windows = blocks.select("anchor", "segment", "held", "n", "level", "body", "lead").mapInArrow(run, "anchor long, segment long, held long, level int, start long, before int, edge binary")
    windows = windows.select("segment", "held", "level", "start", F.struct("anchor", "before", "edge").alias("key"))
    twice = windows.groupBy("key").agg(F.count("*").alias("rows"), F.sum("held").alias("places"), F.max("level").alias("newest")).where((F.col("places") > 1) & (F.col("newest") == NEW))
    total = blocks.agg(F.sum("n")).first()[0] or 0
    # a window that very many segments hold is no hot key: such windows are few, and broadcast
    found = join_spread(windows, settle(twice.select("key", "rows")), "key", "rows", total)
    return found.select("key.anchor", "segment", "start", F.lit(1).cast("long").alias("n"))


def index_crowds(entries: DataFrame) -> DataFrame:
    """As index_shards, for anchors with more than CROWD segments, which one task should not sort.

    Their segments are cut into aligned blocks and sharded by core; equal blocks become one entry with a
    count. What is then alone in its shard holds no match; the rest is sorted shard by shard, or window by
    window over all tasks where more than CROWD different blocks share a core.
    """
    blocks = settle(align_blocks(entries))
    kinds = settle(blocks.groupBy("shard", "piece").agg(F.sum("held").alias("held"), F.max("level").alias("level"), F.first("n").alias("n"), F.first("lead").alias("lead"), F.first("body").alias("body")))
    size = kinds.groupBy("shard").agg(F.count("*").alias("kinds"), F.sum("held").alias("places"), F.max("level").alias("newest")).where((F.col("places") > 1) & (F.col("newest") == NEW)).drop("newest")
    kept = settle(kinds.join(size, "shard").select(F.col("shard").alias("anchor"), F.col("piece").alias("segment"), "held", "n", "level", "body", "lead", "kinds"))
    calm = kept.where(F.col("kinds") <= CROWD).drop("kinds", "lead")
    found = sharded(calm, calm.count()).unionByName(sort_windows(kept.where(F.col("kinds") > CROWD)))
    found = found.select(F.col("anchor").alias("shard"), F.col("segment").alias("piece"), "start", F.col("n").alias("length"))
    return blocks.select("anchor", "segment", "shard", "piece", "first").join(found, ["shard", "piece"]).select("anchor", "segment", (F.col("first") + F.col("start")).alias("start"), F.col("length").alias("n"))


def cut(texts: DataFrame) -> DataFrame:
    """(key, text) -> (key, held, anchor, segment, start, n): the segments of each different text, as arrays; held counts the rows of a text."""

    def run(batches):
        for b in (p for whole in batches for p in pieces(whole, 1)):
            cols: list[list] = [[], [], [], []]
            for lo, hi, data, off in slices(b.column(1)):
                doc, start, n, anchor, segment = segments(data, off)
                edge = np.searchsorted(doc, np.arange(hi - lo + 1))
                for c, x in zip(cols, (anchor.view(np.int64), segment.view(np.int64), start, n)):
                    c += [x[i:j] for i, j in zip(edge[:-1], edge[1:])]
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c, pa.list_(k)) for c, k in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.int32()))]], ["key", "anchor", "segment", "start", "n"])

    parts = texts.mapInArrow(run, "key binary, anchor array<long>, segment array<long>, start array<long>, n array<int>")
    return parts.groupBy("key").agg(F.count("*").alias("held"), *[F.first(c).alias(c) for c in ("anchor", "segment", "start", "n")])


def bodies(kinds: DataFrame, texts: DataFrame) -> DataFrame:
    """Kinds (anchor, segment, held, n, level, crowded, at<key,start>) with the bytes of their windows, read from the texts (key, text)."""
    wanted = settle(kinds.groupBy("at.key").agg(F.collect_list(F.struct("anchor", "segment", "held", "n", "level", "crowded", F.col("at.start").alias("start"))).alias("want")))
    keys = wanted.select("key")
    few = keys.count() <= BROADCAST_KEYS
    sources = texts.join(F.broadcast(keys) if few else keys, "key", "left_semi").groupBy("key").agg(F.first("text").alias("text"))

    def fetch(batches):
        for b in (p for whole in batches for p in pieces(whole, 1, 1 << 20)):
            rows = []
            for _, text, want in zip(*[c.to_pylist() for c in b.columns]):
                raw = (text or "").encode("utf-8", "surrogatepass")
                rows += [(w["anchor"], w["segment"], w["held"], w["n"], w["level"], raw[w["start"] : w["start"] + w["n"] - 1 + SPAN], w["crowded"]) for w in want]
            types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.bool_()]
            cols = list(zip(*rows)) if rows else [[]] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, types)], ["anchor", "segment", "held", "n", "level", "body", "crowded"])

    return settle(sources.join(wanted, "key").mapInArrow(fetch, "anchor long, segment long, held long, n int, level int, body binary, crowded boolean"))


class Index:
    """A family of sparse suffix arrays over all texts added so far, stored below `path`; a path that holds one is opened.

    levels: (batches in it, folder) from the oldest, each at least twice the next. The marks that each batch found, in
    itself and in older texts, are stored as well. `texts` is a stored table (key, text) of all texts that are ever added;
    without it the index keeps a copy of what is added.
    """

    SCHEMA = "anchor long, segment long, key binary, start long, n int, held long"

    def __init__(self, spark: SparkSession, path: str | None = None, texts: DataFrame | None = None):
        self.spark, self.texts = spark, texts
        self.path = path or hold(spark, f"{shared_dir(spark)}/index-{uuid.uuid4().hex}")
        self.levels: list[tuple[int, str]] = []
        self.marks: list[str] = []
        self.copies: list[str] = []
        if exists(spark, f"{self.path}/state"):
            found = [json.loads(r.value) for r in spark.read.text(f"{self.path}/state").collect()]  # a line for each batch
            state = max(found, key=lambda x: len(x["marks"]))
            self.levels, self.marks, self.copies = [tuple(x) for x in state["levels"]], state["marks"], state["copies"]

    def _write(self, df: DataFrame, kind: str) -> str:
        name = f"{kind}-{uuid.uuid4().hex}"
        df.write.parquet(f"{self.path}/{name}")
        return name

    def _write_level(self, rows: DataFrame) -> str:
        """The rows in order of (anchor, segment, key), in ranges: an anchor that many texts share lies in several."""
        order = ["anchor", "segment", "key", "start"]
        return self._write(rows.repartitionByRange(*order).sortWithinPartitions(*order), "level")

    def _level(self, name: str) -> DataFrame:
        return self.spark.read.schema(self.SCHEMA).parquet(f"{self.path}/{name}")

    def _all_texts(self) -> DataFrame:
        if self.texts is not None:
            return self.texts
        return reduce(DataFrame.unionByName, [self.spark.read.schema("key binary, text string").parquet(f"{self.path}/{c}") for c in self.copies])

    @tidy
    def add(self, batch: DataFrame) -> None:
        """Adds the texts (key, text), key a digest of the text; several rows of one key are several places. Empty and short texts hold no windows."""
        if self.texts is None:
            self.copies.append(self._write(batch.select("key", "text"), "texts"))
        own = settle(cut(batch)).select("key", F.inline(F.arrays_zip("anchor", "segment", "start", "n")), "held").select("anchor", "segment", "key", "start", "n", "held")
        level = self._write_level(own)
        arrays = [self._level(level).withColumn("level", F.lit(NEW)), *[self._level(name).withColumn("level", F.lit(i)) for i, (_, name) in enumerate(self.levels)]]
        self.marks.append(self._write(self._scan(reduce(DataFrame.unionByName, arrays)), "marks"))
        self.levels.append((1, level))
        gone = []
        while len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
            (m, a), (n, b) = self.levels[-2:]
            self.levels[-2:] = [(m + n, self._write_level(self._level(a).unionByName(self._level(b))))]
            gone += [a, b]
        state = json.dumps({"levels": self.levels, "marks": self.marks, "copies": self.copies})
        put(self.spark, f"{self.path}/state/{len(self.marks):09d}", state)
        for name in gone:
            delete(self.spark, f"{self.path}/{name}")

    def _scan(self, rows: DataFrame) -> DataFrame:
        """(key, runs) for the texts of the batch and of the levels that hold a window with another place in the batch."""
        fresh = F.max("level") == NEW
        again = rows.groupBy("anchor").agg(F.sum("held").alias("places"), fresh.alias("fresh")).where("places > 1 and fresh").select("anchor")
        # both sides of the join are shuffled for it alone, so that Spark can split an anchor with very many rows
        placed = settle(rows.join(settle(again), "anchor", "left_semi"))
        kinds = placed.groupBy("anchor", "segment").agg(F.sum("held").alias("held"), F.first("n").alias("n"), F.max("level").alias("level"), F.min(F.struct("key", "start")).alias("at"))
        kinds = settle(kinds)
        crowds = kinds.groupBy("anchor").agg(F.count("*").alias("kinds")).where(F.col("kinds") > CROWD).select("anchor", F.lit(True).alias("crowded"))
        entries = bodies(kinds.join(crowds, "anchor", "left").withColumn("crowded", F.coalesce("crowded", F.lit(False))), self._all_texts())
        count = dict(entries.groupBy("crowded").count().collect())
        found = sharded(entries.where("not crowded").drop("crowded"), count.get(False, 0))
        if count.get(True):
            found = found.unionByName(index_crowds(entries.where("crowded").drop("crowded")))
        found = settle(found.groupBy("anchor", "segment").agg(F.collect_list(F.struct("start", "n")).alias("runs")))  # 201 runs at most
        moved = F.transform("runs", lambda r: F.struct((r["start"] + F.col("start")).alias("start"), r["n"].alias("n")))
        some = placed.select("anchor", "segment", "key", "start").join(found, ["anchor", "segment"]).select("key", moved.alias("runs"))
        return some.groupBy("key").agg(F.flatten(F.collect_list("runs")).alias("runs"))

    def repeats(self) -> DataFrame:
        """(key, runs): for each text with matches, array<start,n> of window starts that lie in one; of all batches so far."""
        each = [self.spark.read.schema("key binary, runs array<struct<start:long,n:long>>").parquet(f"{self.path}/{m}") for m in self.marks]
        return reduce(DataFrame.unionByName, each).groupBy("key").agg(F.flatten(F.collect_list("runs")).alias("runs"))


def spans_of(runs: list[dict]) -> list[tuple[int, int]]:
    """Maximal byte spans [a, b) covered by the windows of the runs."""
    out: list[tuple[int, int]] = []
    for a, b in sorted((r["start"], r["start"] + r["n"] - 1 + SPAN) for r in runs):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def digest(text: Column) -> Column:
    """16 bytes that stand for a text: two hashes of it, of different seeds."""
    half = lambda *of: F.lpad(F.hex(F.xxhash64(*of)), 16, "0")
    return F.unhex(F.concat(half(text), half(F.lit("other seed"), text)))


def keyed(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(key, text) as an Index takes them."""
    return docs.select(digest(text_of(text_col)).alias("key"), text_of(text_col).alias("text"))


@tidy
def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", batches: int = BATCHES) -> DataFrame:
    """(id, n_bytes, spans, kept): per document its length in UTF-8 bytes, the spans [start, end) to remove, and what remains as binary.

    Removed is every byte covered by a string of SPAN bytes that also starts anywhere else in the documents,
    overlaps and the same document included. Matches do not cross documents; a null text is an empty one;
    documents shorter than SPAN bytes keep everything. Rows with equal texts are places of their own, so a
    text of SPAN bytes or more that occurs twice is removed from both rows. The documents are dealt by their id into
    `batches`, which are added to an Index one after the other; the result does not depend on their number.
    """
    deal = F.pmod(F.xxhash64(id_col), F.lit(batches).cast("long"))
    index = Index(docs.sparkSession, texts=docs.limit(0))
    for i in range(batches):
        index.texts = keyed(docs.where(deal <= i), text_col)  # those added so far are stored in the documents
        index.add(keyed(docs.where(deal == i), text_col))
    found = settle(index.repeats(), keep=True)
    texts = docs.select(F.col(id_col).alias("id"), digest(text_of(text_col)).alias("key"), text_of(text_col).alias("text"))
    # a hash join on the small side: the texts are shuffled but not sorted
    joined = texts.join(found.hint("shuffle_hash"), "key", "left").select("id", "text", "runs")

    def run(batches):
        for b in (p for whole in batches for p in pieces(whole, 1)):
            size, spans, kept = [], [], []
            for text, runs in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                raw = (text or "").encode("utf-8", "surrogatepass")
                gone = spans_of(runs or [])
                left = [0, *[e for _, e in gone]]
                right = [*[s for s, _ in gone], len(raw)]
                size.append(len(raw))
                spans.append([{"start": s, "end": e} for s, e in gone])
                kept.append(b"".join(raw[i:j] for i, j in zip(left, right)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(size, pa.int64()), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.binary())], ["id", "n_bytes", "spans", "kept"])

    return joined.mapInArrow(run, f"id {docs.schema[id_col].dataType.simpleString()}, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")


def op4_suffixes(spark, sf_dir: str) -> DataFrame:
    """Per document: n_bytes, n_removed, n_spans, kept_sha256."""
    out = dedup(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return out.select(F.col("id").alias("doc_id"), "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


ORACLE = """
with d as (select doc_id, hex(encode(coalesce(text, ''))) as h from documents),
n as (select doc_id, h, length(h) // 2 as n from d),
w as (select doc_id, i, md5(substr(h, 2 * i - 1, 800)) as k from (select doc_id, h, unnest(range(1, n - 398)) as i from n)),
u as (select k from w group by k having count(*) > 1),
a as (select doc_id, i, lag(i) over (partition by doc_id order by i) as p from w where k in (select k from u)),
g as (select doc_id, i, sum(case when p is null or i > p + 400 then 1 else 0 end) over (partition by doc_id order by i) as g from a),
s as (select doc_id, g, min(i) - 1 as a, max(i) + 399 as b from g group by all),
c as (select doc_id, a, b, coalesce(lag(b) over (partition by doc_id order by a), 0) as p from s),
k as (select doc_id, sum(b - a) as n_removed, count(*) as n_spans, max(b) as last, string_agg(substr(h, 2 * p + 1, 2 * (a - p)), '' order by a) as kept from c join d using (doc_id) group by doc_id)
select n.doc_id, n as n_bytes, cast(coalesce(n_removed, 0) as bigint) as n_removed, coalesce(n_spans, 0) as n_spans,
       sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(last, 0) + 1))) as kept_sha256
from n left join k using (doc_id)
"""
