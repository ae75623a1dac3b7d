"""UMI clustering per (cell, gene). A UMI is a text of any letters: an N differs from each base like another base."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from itertools import combinations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import seq as S
from ..scratch import release, scope, settle, tidy
from ..shipping import ship
from .spread import join_spread

Log = list[tuple[str, int, str, int]]


def edges(umis: DataFrame, keys: list[str], threshold: int = 1) -> DataFrame:
    """(keys, a, b), a < b: UMIs of a group, of equal length, at a Hamming distance of 1 up to the threshold.

    At distance 1 two UMIs are equal but for one place, so an equality join on (place, rest) finds each pair once. Further
    ones share one of threshold + 1 pieces.
    """
    if threshold == 1:
        u = umis.select(*keys, "umi", F.explode(S.wildcards(F.col("umi"))).alias("k"))
        return u.withColumnRenamed("umi", "a").join(u.withColumnRenamed("umi", "b"), [*keys, "k"]).where("a < b").select(*keys, "a", "b")
    return blocked_edges(umis, keys, threshold + 1)


def blocked_edges(umis: DataFrame, keys: list[str], blocks: int) -> DataFrame:
    """The same edges for a threshold of `blocks` - 1: candidates share one of `blocks` pieces."""
    u = umis.select(*keys, "umi", F.explode(S.blocks(F.col("umi"), blocks)).alias("k"))
    pairs = u.withColumnRenamed("umi", "a").join(u.withColumnRenamed("umi", "b"), [*keys, "k"]).where("a < b").select(*keys, "a", "b").distinct()
    return pairs.where(S.hamming(F.col("a"), F.col("b")) < blocks)


def star(edges: DataFrame, total: int, large: bool) -> DataFrame:
    """Edges (a, b), b < a: each node's neighbours hung on the least of them and itself, those above the node (large) or below it and the node (small).

    Neither step parts what was connected; a node of very many edges is no hot key.
    """
    near = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        near = near.unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = near.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
    if large:
        least = least.withColumn("m", F.least("m", "u"))
    least = settle(least)
    hung = join_spread(near, least, "u", "n", 2 * total if large else total)
    hung = hung.where("v > u") if large else hung.where("v != m")
    out = hung.select(F.col("v").alias("a"), F.col("m").alias("b"))
    if not large:
        out = out.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.distinct()


@tidy
def components(edge: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, comp): the least node that edges lead to.

    Large and small stars in turn (Kiveris et al., 2014) until nothing changes: then every node hangs on the least of its component. A chain of n nodes takes
    about log2(n) rounds, each one pass over the edges.
    """
    now = edge.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now, before = settle(now), None
    mark = lambda d: tuple(d.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
    state = mark(now)
    while state != before:
        before, old = state, now
        with scope():
            large = settle(star(now, state[0], True))
            now = settle(star(large, state[0], False), keep=True)
        release(old)
        state = mark(now)
    return settle(nodes.join(now.select(F.col("a").alias("node"), "b"), "node", "left").select("node", F.coalesce("b", "node").alias("comp")), keep=True)


def neighbours(umis: list[str], threshold: int = 1) -> dict[str, list[str]]:
    """To each UMI those of equal length at a distance of 1 up to the threshold, in text order."""
    near: dict[str, list[str]] = {u: [] for u in umis}
    if threshold == 1:
        same: dict[tuple[int, str], list[str]] = {}
        for u in umis:
            for i in range(len(u)):
                same.setdefault((i, u[:i] + u[i + 1 :]), []).append(u)
        pairs = (p for group in same.values() if len(group) > 1 for p in combinations(group, 2))
    else:
        pieces: dict[tuple, list[str]] = {}
        for u in umis:
            size, more = divmod(len(u), threshold + 1)
            at = 0
            for i in range(threshold + 1):
                n = size + (i < more)
                pieces.setdefault((len(u), i, u[at : at + n]), []).append(u)
                at += n
        found = {p for group in pieces.values() if len(group) > 1 for p in combinations(sorted(group), 2)}
        pairs = (p for p in found if sum(x != y for x, y in zip(*p)) <= threshold)
    for a, b in pairs:
        near[a].append(b)
        near[b].append(a)
    for u in near:
        near[u].sort()
    return near


def cluster_group(counts: dict[str, int], method: str, threshold: int = 1) -> tuple[dict[str, int], Log]:
    """UMI counts after clustering, and the log of merges (from, its count, to, its count).

    cluster joins connected UMIs; directional links a to b only if count(a) >= 2 * count(b) - 1; adjacency takes
    in each component the shortest prefix of its UMIs, by count, whose neighbours cover it, and each of these
    leads claims the neighbours that no earlier one has. Order is (-count, umi) throughout.
    """
    near = neighbours(list(counts), threshold)
    if not any(near.values()):
        return counts, []
    order = sorted(counts, key=lambda u: (-counts[u], u))
    if method == "directional":
        near = {u: [v for v in vs if counts[u] >= 2 * counts[v] - 1] for u, vs in near.items()}
    seen: set[str] = set()
    out, log = {}, []
    for start in order:
        if start in seen:
            continue
        part, todo = [], deque([start])
        seen.add(start)
        while todo:
            u = todo.popleft()
            part.append(u)
            for v in near[u]:
                if v not in seen:
                    seen.add(v)
                    todo.append(v)
        part.sort(key=lambda u: (-counts[u], u))
        leads = [part[0]]
        if method == "adjacency":
            covered: set[str] = set()
            for n, u in enumerate(part, 1):
                covered.add(u)
                covered.update(near[u])
                if len(covered) == len(part):
                    leads = part[:n]
                    break
        claimed = set(leads)
        for lead in leads:
            mine = [v for v in (near[lead] if method == "adjacency" else part) if v not in claimed]
            claimed.update(mine)
            out[lead] = counts[lead] + sum(counts[v] for v in mine)
            log += [(v, counts[v], lead, counts[lead]) for v in mine]
    return out, log


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[str, str, dict[str, int]]]]:
    """Whole groups of rows sorted by (cell, gene), those that a batch completes at a time."""
    at, group = None, {}
    for b in batches:
        done = []
        for cell, gene, umi, n in zip(*[c.to_pylist() for c in b.columns]):
            if (cell, gene) != at:
                if at is not None:
                    done.append((*at, group))
                at, group = (cell, gene), {}
            group[umi] = group.get(umi, 0) + n
        yield done
    if at is not None:
        yield [(*at, group)]


def _walk(umis: DataFrame, schema: str, rows) -> DataFrame:
    """Rows made from each group, many groups to a batch: a group alone is a few rows, too few for a call of its own."""
    ship(umis.sparkSession)
    kinds = [pa.string(), pa.string(), *([pa.string(), pa.int64()] if "num" in schema else [pa.string(), pa.string()])]
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches):
        for groups in _groups(batches):
            out = [r for g in groups for r in rows(*g)]
            cols = list(zip(*out)) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)

    d = umis.select(F.col("cell").cast("string"), F.col("gene").cast("string"), "umi", F.col("num").cast("long"))
    return d.repartition("cell", "gene").sortWithinPartitions("cell", "gene").mapInArrow(run, schema)


def cluster(umis: DataFrame, method: str, threshold: int = 1) -> DataFrame:
    """(cell, gene, umi, num) -> the same after clustering; groups are the UMIs of one gene in one cell. Repeated rows add up."""

    def rows(cell: str, gene: str, group: dict[str, int]) -> list[tuple]:
        return [(cell, gene, u, n) for u, n in cluster_group(group, method, threshold)[0].items()]

    return _walk(umis, "cell string, gene string, umi string, num long", rows)


def merge_log(umis: DataFrame, method: str, threshold: int = 1) -> DataFrame:
    """(cell, gene, from, to): which UMI was merged into which, as umi:count."""

    def rows(cell: str, gene: str, group: dict[str, int]) -> list[tuple]:
        return [(cell, gene, f"{a}:{n}", f"{b}:{m}") for a, n, b, m in cluster_group(group, method, threshold)[1]]

    return _walk(umis, "cell string, gene string, from string, to string", rows)


@tidy
def follow_merges(umis: DataFrame, log: DataFrame, recursive: bool = False) -> DataFrame:
    """(cell, gene, umi, ...) with corrected: what the log (see merge_log) says the UMI was merged into, itself if nothing.

    recursive follows the log on from there to its end: each round doubles how far every entry of the log leads, so a chain of n
    merges takes log2(n) rounds. A log that leads in a circle is an error. Of several entries for one UMI the least `to` counts.
    """
    place = ["cell", "gene"]
    into = log.select(*place, F.split_part("from", F.lit(":"), F.lit(1)).alias("__a"), F.split_part("to", F.lit(":"), F.lit(1)).alias("__b"))
    into = settle(into.where("__a != __b").groupBy(*place, "__a").agg(F.min("__b").alias("__b")), keep=True)
    rounds = into.count().bit_length() + 1 if recursive else 0
    for _ in range(rounds):
        further = into.select(*place, F.col("__a").alias("__b"), F.col("__b").alias("__c"))
        ahead = settle(into.join(further, [*place, "__b"], "left"), keep=True)
        if ahead.where("__c is not null").isEmpty():
            break
        into = ahead.select(*place, "__a", F.coalesce("__c", "__b").alias("__b"))
    else:
        if recursive and rounds > 1:
            raise ValueError("the log of merges leads in a circle")
    ends = into.withColumnRenamed("__a", "umi")
    return umis.join(ends, [*place, "umi"], "left").withColumn("corrected", F.coalesce("__b", "umi")).select(*umis.columns, "corrected")


def receptor_filter(umis: DataFrame, share: float = 0.1, threshold: int = 1) -> DataFrame:
    """Per cell: UMIs with more than share of the N50 of counts, clustered by adjacency; reads of merged UMIs are dropped with them."""
    from .counts import n50

    cut = n50(umis, "num", ["cell"])
    kept = umis.join(cut, "cell").where(F.col("num") > share * F.col("n50"))
    return umis.join(cluster(kept, "adjacency", threshold).select("cell", "gene", "umi"), ["cell", "gene", "umi"], "left_semi")
