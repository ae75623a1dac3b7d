"""Near-duplicate classes by weighted MinHash (BagMinHash) over multisets of five-word shingles."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BYTE_CODE, column, free_name, join_spread, mix64, pieces, rolling, settle, slices, span_hash, table, text_of, tidy, word_spans

SHINGLE = 5
SIMILAR = 0.8
REGISTERS = 128
ROWS = 4  # registers to a band; a pair at 0.8 shares no band of 32 once in 20 million
LIKELY = 82  # registers that must agree before a pair of the second round is verified: 4.5 deviations below 0.8
TILE_A, TILE_B = 512, 8192  # documents on either side of a tile of the second round
BROADCAST_KEYS = 200_000  # 16-byte keys that may be broadcast; beyond that the join is shuffled


def shingles(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle hash, multiplicity), sorted by text and hash. A text of fewer than five words has one shingle of all its words."""
    starts, ends = word_spans(data, off)
    doc = np.searchsorted(off, starts, "right") - 1
    word = span_hash(rolling(BYTE_CODE[data]), starts, ends)
    n = len(off) - 1
    count = np.bincount(doc, minlength=n)
    first = np.cumsum(count) - count
    size = np.minimum(count, SHINGLE)
    place = np.arange(len(word)) - first[doc]
    begin = np.flatnonzero(place <= count[doc] - size[doc])
    h = np.zeros(len(begin), np.uint64)
    for k in range(SHINGLE):
        has = size[doc[begin]] > k
        at = begin[has] + k
        h[has] = mix64(h[has] * np.uint64(3) + word[at] + np.uint64(k))
    d = doc[begin]
    order = np.argsort(h, kind="stable")
    order = order[np.argsort(d[order], kind="stable")]
    d, h = d[order], h[order]
    new = np.flatnonzero(np.concatenate([[True], (d[1:] != d[:-1]) | (h[1:] != h[:-1])])) if len(d) else np.zeros(0, np.int64)
    return d[new], h[new], np.diff(np.concatenate([new, [len(d)]]))


def signatures(doc: np.ndarray, element: np.ndarray, weight: np.ndarray, n: int, m: int = REGISTERS) -> np.ndarray:
    """n x m registers: two texts agree in a register with the probability of their weighted Jaccard similarity.

    Each element has, over its weight axis, Poisson processes on the blocks [0,1), [1,2), [2,4), [4,8), ...
    (discretised weights, each block twice as wide as the one before), of rate m for a unit of weight. A point has
    a time, a register and a place y in its block; it counts for a text whose weight is above y. A register
    keeps its first time. Points come in order of time, so an element stops once it is past the time by
    which the text's registers are full: with total weight W, (log m + 3) / W fills them all 19 times in 20, and
    the rest go on to twice that.
    """
    out = np.full(n * m, np.inf)
    total = np.bincount(doc, weights=weight, minlength=n)
    level = np.zeros(len(weight), np.int64)
    top = np.ceil(np.log2(np.maximum(weight, 1))).astype(np.int64)  # blocks above the first that weight reaches into
    who = np.repeat(np.arange(len(weight)), top + 1)
    level = np.arange(len(who)) - np.repeat(np.cumsum(top + 1) - top - 1, top + 1)
    seed = mix64(element[who] + mix64(level.astype(np.uint64)))
    low = np.where(level > 0, 2.0 ** (level - 1), 0.0)
    wide = np.where(level > 0, low, 1.0)
    d, w = doc[who], weight[who].astype(np.float64)
    time = np.zeros(len(who))
    step = np.zeros(len(who), np.uint64)
    limit = np.where(total > 0, (math.log(m) + 3) / np.maximum(total, 1), 0.0)
    live = np.arange(len(who))
    waiting = live
    while len(waiting):
        live = waiting
        late: list[np.ndarray] = []
        while len(live):
            r = mix64(seed[live] + step[live] * np.uint64(0xD1342543DE82EF95))
            step[live] += np.uint64(1)
            u = ((r >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53
            t = time[live] - np.log(u) / (m * wide[live])
            time[live] = t
            # the point lies in the text's time whether or not it was the last before the limit: a first time is a first time
            y = low[live]
            deep = np.flatnonzero(level[live] > 0)
            if len(deep):
                y[deep] += wide[live[deep]] * (mix64(r[deep]) >> np.uint64(11)).astype(np.float64) * 2.0**-53
            ok = y < w[live]
            np.minimum.at(out, d[live[ok]] * m + (r[ok] & np.uint64(m - 1)).astype(np.int64), t[ok])
            on = t < limit[d[live]]
            late.append(live[~on])
            live = live[on]
        done = np.concatenate(late) if late else np.zeros(0, np.int64)
        worst = out.reshape(n, m).max(1)
        unfull = (worst > limit) & (total > 0)
        limit[unfull] *= 2
        waiting = done[unfull[d[done]]]
    return out.reshape(n, m)


def similarity(a: tuple, b: tuple, n: int) -> np.ndarray:
    """Weighted Jaccard of the i-th texts of a and b, from their shingles."""
    doc, h, w = (np.concatenate([x, y]) for x, y in zip(a, b))
    order = np.argsort(h, kind="stable")
    order = order[np.argsort(doc[order], kind="stable")]
    doc, h, w = doc[order], h[order], w[order]
    both = np.flatnonzero((doc[1:] == doc[:-1]) & (h[1:] == h[:-1]))
    shared = np.bincount(doc[both], weights=np.minimum(w[both], w[both + 1]), minlength=n)
    total = np.bincount(doc, weights=w, minlength=n)
    return shared / np.maximum(total - shared, 1)


SIGNED = "key binary, sig binary, bands array<bigint>"


def sign(docs: DataFrame) -> DataFrame:
    """(id, key, text) -> (id, key, sig, bands): a byte of each register, and a hash of each band. Texts without words have no bands."""

    def run(batches):
        for b in (p for whole in batches for p in pieces(whole, 2)):
            sigs, bands = [], []
            for lo, hi, data, off in slices(b.column(2)):
                n = hi - lo
                d, h, w = shingles(data, off)
                reg = mix64(signatures(d, h, w, n).view(np.uint64))
                short = (reg & np.uint64(255)).astype(np.uint8)
                band = reg.reshape(n, REGISTERS // ROWS, ROWS)
                acc = np.arange(REGISTERS // ROWS, dtype=np.uint64)[None, :].repeat(n, 0)
                for k in range(ROWS):
                    acc = mix64(acc * np.uint64(5) + band[:, :, k])
                has = np.bincount(d, minlength=n) > 0
                acc = acc.view(np.int64)
                sigs += [s.tobytes() for s in short]
                bands += [x if ok else x[:0] for x, ok in zip(acc, has)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(sigs, pa.binary()), pa.array(bands, pa.list_(pa.int64()))], ["id", "key", "sig", "bands"])

    return docs.mapInArrow(run, f"id {docs.schema['id'].dataType.simpleString()}, {SIGNED}")


def verify(pairs: DataFrame, docs: DataFrame, similar: float) -> DataFrame:
    """The pairs (a, b) of keys whose texts have at least the similarity. `docs` has (key, text), equal texts any number of times."""
    keys = settle(pairs.select(F.col("a").alias("key")).union(pairs.select("b")).distinct())
    few = keys.count() <= BROADCAST_KEYS
    texts = docs.join(F.broadcast(keys) if few else keys, "key", "left_semi").groupBy("key").agg(F.first("text").alias("text"))
    texts = settle(texts)
    both = pairs.join(texts.select(F.col("key").alias("a"), F.col("text").alias("ta")), "a").join(texts.select(F.col("key").alias("b"), F.col("text").alias("tb")), "b").select("a", "b", "ta", "tb")

    def run(batches):
        for b in (p for whole in batches for p in pieces(whole, 2, 1 << 20)):
            sides = []
            for c in (2, 3):
                parts = [(d + lo, h, w) for lo, hi, data, off in slices(b.column(c)) for d, h, w in [shingles(data, off)]]
                sides.append(tuple(np.concatenate(x) for x in zip(*parts)))
            ok = pa.array(similarity(*sides, b.num_rows) >= similar)
            yield pa.RecordBatch.from_arrays([b.column(0).filter(ok), b.column(1).filter(ok)], ["a", "b"])

    return settle(both.mapInArrow(run, "a binary, b binary"))


@tidy
def components(edges: DataFrame) -> DataFrame:
    """(key, comp) for each end of an edge (a, b): comp is the least key that can be reached. Labels spread along edges and are then followed once more, until none changes.

    Labels are broadcast while there are BROADCAST_KEYS at most. Beyond that neither a node with very many edges nor a
    label that very many nodes have is a hot key of a join.
    """
    edges = settle(edges.union(edges.select("b", "a")).distinct())
    labels = settle(edges.groupBy(F.col("a").alias("key")).agg(F.least(F.min("b"), F.first("a")).alias("comp")))
    nodes = labels.count()
    few = nodes <= BROADCAST_KEYS
    if not few:
        count, degree = edges.count(), settle(edges.groupBy(F.col("a").alias("b")).agg(F.count("*").alias("n")))
    while True:
        ends, follow = labels.select(F.col("key").alias("b"), "comp"), labels.select(F.col("key").alias("comp"), F.col("comp").alias("next"))
        seen = edges.join(F.broadcast(ends), "b") if few else join_spread(edges, ends.join(degree, "b"), "b", "n", count)
        near = seen.groupBy(F.col("a").alias("key")).agg(F.min("comp").alias("seen"))
        moved = labels.join(near, "key").select("key", F.col("comp").alias("old"), F.least("comp", "seen").alias("comp"))
        if few:
            jumped = moved.join(F.broadcast(follow), "comp")
        else:
            moved = settle(moved)
            jumped = join_spread(moved, moved.groupBy("comp").agg(F.count("*").alias("n")).join(follow, "comp"), "comp", "n", nodes)
        new = settle(jumped.select("key", "old", F.least("comp", "next").alias("comp")), keep=True)
        labels = new.select("key", "comp")
        if new.where(F.col("old") != F.col("comp")).isEmpty():
            return labels


def multisets(texts: DataFrame) -> DataFrame:
    """(key, text) -> (key, items): the sorted 64-bit items of each multiset; the n-th copy of a shingle is an item of its own."""

    def run(batches):
        for b in (p for whole in batches for p in pieces(whole, 1)):
            items = []
            for lo, hi, data, off in slices(b.column(1)):
                d, h, w = shingles(data, off)
                copy = np.arange(int(w.sum())) - np.repeat(np.cumsum(w) - w, w)
                d, h = np.repeat(d, w), mix64(np.repeat(h, w) + copy.astype(np.uint64) * np.uint64(0xA24BAED4963EE407))
                order = np.argsort(h, kind="stable")
                order = order[np.argsort(d[order], kind="stable")]
                items += [x.tobytes() for x in np.split(h[order], np.searchsorted(d[order], np.arange(1, hi - lo)))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(items, pa.binary())], ["key", "items"])

    return texts.mapInArrow(run, "key binary, items binary")


def likely(t: pa.Table) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """The left rows of a tile; to each, the right rows of other components that agree in LIKELY registers and share no earlier band; components."""
    sig = np.frombuffer(b"".join(t["sig"].to_pylist()), np.uint8).reshape(-1, REGISTERS)
    left = t["left"].to_numpy()
    comp = np.unique(np.array([c.hex() for c in t["comp"].to_pylist()]), return_inverse=True)[1]
    earlier = t["earlier"].combine_chunks().flatten().to_numpy().reshape(len(left), t["band"][0].as_py())
    right = np.flatnonzero(~left)
    out = []
    for i in np.flatnonzero(left):
        other = right[comp[right] != comp[i]]
        other = other[(sig[other] == sig[i]).sum(1) >= LIKELY]
        out.append(other[(earlier[other] == earlier[i]).sum(1) == 0])
    return np.flatnonzero(left), out, comp


def remaining(inside: DataFrame, nodes: DataFrame, comps: DataFrame, sources: DataFrame, similar: float) -> DataFrame:
    """Links (a, b) that the first round missed: pairs that share a band, lie in different components, agree in LIKELY registers and are similar enough.

    In each bucket the documents outside the component of its centre meet all others that are not of their own
    component, in tiles of TILE_A by TILE_B, each of which one task compares: first by signature alone, to find
    the documents that have a likely partner at all, then these again with their multisets. A pair belongs to
    the first band that it shares. Of a tile's links only those are returned that join what its earlier ones
    have not, so there are fewer links than documents, whatever the number of pairs.
    """
    placed = inside.join(comps, "key", "left").withColumn("comp", F.coalesce("comp", "key"))
    centres = placed.where(F.col("key") == F.col("centre")).select("bucket", F.col("comp").alias("major"))
    placed = placed.join(centres, "bucket").withColumn("minor", F.col("comp") != F.col("major"))
    mixed = placed.groupBy("bucket").agg(F.sum(F.col("minor").cast("long")).alias("minors")).where("minors > 0")
    # a bucket of two was verified in the first round
    placed = settle(placed.where("n > 2").join(mixed, "bucket").join(nodes.select("key", "sig", "bands"), "key").withColumn("earlier", F.slice("bands", F.lit(1), F.col("band"))).drop("bands"))

    def tiles(rows: DataFrame, extra: list[str]) -> DataFrame:
        cols = ["bucket", "band", "key", "comp", "sig", "earlier", *extra]
        a_tiles, b_tiles = F.ceil(F.col("minors") / TILE_A).cast("int"), F.ceil(F.col("n") / TILE_B).cast("int")
        mine = lambda n: F.pmod(F.xxhash64("key"), n.cast("long")).cast("int")
        span = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
        a = rows.where("minor").select(*cols, F.lit(True).alias("left"), mine(a_tiles).alias("i"), span(b_tiles).alias("j"))
        b = rows.select(*cols, F.lit(False).alias("left"), span(a_tiles).alias("i"), mine(b_tiles).alias("j"))
        return a.unionByName(b).groupBy("bucket", "i", "j")

    def partners(t: pa.Table) -> pa.Table:
        left, others, _ = likely(t)
        has = np.unique(np.concatenate([*[o for o in others], left[[len(o) > 0 for o in others]]]).astype(np.int64))
        keys = t["key"].take(pa.array(has)).unique()
        return pa.table({"bucket": pa.array([t["bucket"][0].as_py()] * len(keys), pa.int64()), "key": keys})

    def link(t: pa.Table) -> pa.Table:
        left, others, comp = likely(t)
        items = [np.frombuffer(x, np.uint64) for x in t["items"].to_pylist()]
        size = np.array([len(x) for x in items])
        keys, top = t["key"].to_pylist(), list(range(int(comp.max()) + 1))

        def root(c: int) -> int:
            while top[c] != c:
                top[c] = top[top[c]]
                c = top[c]
            return c

        out = []
        for i, other in zip(left, others):
            mine = items[i]
            for lo in range(0, len(other), 256):
                part = np.array([j for j in other[lo : lo + 256] if root(comp[j]) != root(comp[i])], np.int64)
                if not len(part):
                    continue
                all_ = np.concatenate([items[j] for j in part])
                at = np.minimum(np.searchsorted(mine, all_), len(mine) - 1)
                shared = np.add.reduceat((mine[at] == all_).astype(np.int64), np.concatenate([[0], np.cumsum(size[part])[:-1]]))
                for j in part[shared / (size[part] + len(mine) - shared) >= similar]:
                    a, b = root(comp[i]), root(comp[j])
                    if a != b:
                        top[b] = a
                        out.append((keys[i], keys[j]))
        return pa.table({"a": pa.array([x for x, _ in out], pa.binary()), "b": pa.array([y for _, y in out], pa.binary())})

    able = settle(tiles(placed, []).applyInArrow(partners, "bucket long, key binary").distinct())
    keys = settle(able.select("key").distinct())
    few = keys.count() <= BROADCAST_KEYS
    texts = sources.join(F.broadcast(keys) if few else keys, "key", "left_semi").groupBy("key").agg(F.first("text").alias("text"))
    full = placed.join(able, ["bucket", "key"], "left_semi").join(multisets(texts), "key")
    return settle(tiles(full, ["items"]).applyInArrow(link, "a binary, b binary").distinct())


@tidy
def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similar: float = SIMILAR) -> DataFrame:
    """(id, key, comp, class_id, class_size): one row per document with its near-duplicate class.

    Two texts are linked if the weighted Jaccard similarity of their multisets of five-word shingles (words are
    runs without ASCII white space) is at least `similar`; a class is all that links connect. Equal texts, null and empty
    ones included, share a class; a text without words is linked to no other. `key` is the digest of the text,
    `comp` the least digest of the class, which names it even where ids repeat or are null; class_id is its smallest
    id that is not null (null if all are).

    Equal texts are one node. Nodes that share a band form a bucket. First each is verified against the
    bucket's centre, the node that shares most bands with others, on the exact multisets; what a bucket then
    still holds apart is compared by signature and verified (see remaining). Links therefore miss only pairs that share
    no band or fall under LIKELY. Buckets are joined by key, which Spark can split, and no list of a bucket is ever built.
    """
    texts = docs.select(F.col(id_col).alias("id"), F.unhex(F.md5(text_of(text_col).cast("binary"))).alias("key"), text_of(text_col).alias("text"))
    signed = settle(sign(texts))
    nodes = settle(signed.groupBy("key").agg(F.first("sig").alias("sig"), F.first("bands").alias("bands"), F.count("*").alias("copies"), F.min("id").alias("least")))
    banded = nodes.select("key", F.posexplode("bands").alias("band", "bucket"))
    full = banded.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    inside = settle(banded.join(full, "bucket"))
    shared = inside.groupBy("key").agg(F.sum("n").alias("shared"))
    inside = settle(inside.join(shared, "key"))
    centres = inside.groupBy("bucket").agg(F.max(F.struct("shared", "key"))["key"].alias("centre"))
    inside = settle(inside.drop("shared").join(centres, "bucket"))
    sources = texts.select("key", "text")
    links = verify(settle(inside.where(F.col("key") != F.col("centre")).select(F.col("key").alias("a"), F.col("centre").alias("b")).distinct()), sources, similar)
    comps = components(links)
    found = remaining(inside, nodes, comps, sources, similar)
    if not found.isEmpty():
        comps = components(links.union(found))
    # first each text is named, then each document: neither by a key that a large class or many copies make hot
    named = nodes.select("key", "copies", "least").join(comps, "key", "left").withColumn("comp", F.coalesce("comp", "key"))
    named = settle(named)
    per = named.groupBy("comp").agg(F.min("least").alias("class_id"), F.sum("copies").alias("class_size"), F.count("*").alias("n"))
    named = settle(join_spread(named.drop("least"), per, "comp", "n", named.count()), keep=True)
    slim = settle(signed.select("id", "key"), keep=True)
    return join_spread(slim, named, "key", "copies", slim.count()).select("id", "key", "comp", "class_id", "class_size")


@tidy
def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similar: float = SIMILAR) -> DataFrame:
    """The rows of `docs`, with all their columns, of which each class keeps one: that with the smallest id (null first), then key.

    Rows that repeat both id and text of the kept one are told apart by the hash of their other columns; rows
    equal in everything become one. Ids may repeat or be null: classes are told apart by their texts.
    """
    key_col, row_col = free_name(docs, "__key"), free_name(docs, "__row")
    row = F.xxhash64(*[column(c) for c in docs.columns if docs.schema[c].dataType.typeName() != "map"])
    tagged = docs.withColumn(key_col, F.unhex(F.md5(text_of(text_col).cast("binary")))).withColumn(row_col, row)
    rows = tagged.select(F.col(id_col).alias("id"), F.col(key_col).alias("key"), F.col(row_col).alias("row"))
    found = classes(docs, id_col, text_col, similar).where("class_size > 1").groupBy("key", "comp").agg(F.count("*").alias("n"))
    found = settle(found)
    total = found.agg(F.sum("n")).first()[0] or 0
    rows = settle(join_spread(rows, found, "key", "n", total))
    first = rows.groupBy("comp").agg(F.min(F.struct("id", "key", "row")).alias("f")).select("f.*")
    lost = rows.select("id", "key", "row").distinct().join(first, (rows.key == first.key) & (rows.row == first.row) & rows.id.eqNullSafe(first.id), "left_anti")
    lost = settle(lost, keep=True)
    few = lost.count() <= BROADCAST_KEYS
    i, k, r = (free_name(docs, n) for n in ("__i", "__k", "__r"))
    lost = lost.select(F.col("id").alias(i), F.col("key").alias(k), F.col("row").alias(r))
    same = (F.col(key_col) == F.col(k)) & (F.col(row_col) == F.col(r)) & F.col(id_col).eqNullSafe(F.col(i))
    kept = tagged.join(F.broadcast(lost) if few else lost, same, "left_anti")
    again = rows.groupBy("id", "key", "row").count().where("count > 1").isEmpty()
    kept = kept if again else kept.dropDuplicates([id_col, key_col, row_col])
    return kept.drop(key_col, row_col)


def op6_neardup(spark, sf_dir: str) -> DataFrame:
    """Per document: class_id, class_size."""
    return classes(table(spark, sf_dir, "documents")).select(F.col("id").alias("doc_id"), "class_id", "class_size")


ORACLE = r"""
with recursive w as (select doc_id, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents),
d as (select t, min(doc_id) as id, count(*) as n, any_value(ws) as ws from w group by t),
s as (select id, unnest(case when len(ws) = 0 then [] when len(ws) < 5 then [array_to_string(ws, ' ')]
                             else list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) end) as g from d),
c as (select id, g, count(*) as n from s group by all),
z as (select id, sum(n) as total from c group by id),
p as (select a.id as x, b.id as y, sum(least(a.n, b.n)) as shared from c a join c b on a.g = b.g and a.id < b.id group by all),
e as (select x, y from p join z a on a.id = x join z b on b.id = y where cast(shared as double) / cast(a.total + b.total - shared as double) >= 0.8),
l as (select x, y from e union all select y, x from e),
r as (select id, id as node from d union select r.id, l.y from r join l on l.x = r.node),
m as (select id, min(node) as class_id from r group by id),
k as (select class_id, sum(n) as class_size from m join d using (id) group by class_id)
select w.doc_id, m.class_id, cast(k.class_size as bigint) as class_size from w join d using (t) join m on m.id = d.id join k using (class_id)
"""
