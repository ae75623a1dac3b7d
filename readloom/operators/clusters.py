"""From counts to clusters: variable genes, regressed scaling, the graph of shared neighbours, communities, marker filters."""

from __future__ import annotations

from collections import deque

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..scratch import release, scope, settle, tidy
from ..shipping import ship
from .spread import join_spread
from .umi import components

#: Fixed values of the workflow: share of points in a local fit, places it is made at, least overlap of neighbours, largest scaled value.
SPAN, PLACES, OVERLAP, LARGEST = 0.3, 200, 1 / 15, 10.0
#: The resolutions that are tried, and that which names the clusters.
RESOLUTIONS, RESOLUTION = (0.2, 0.5, 0.8, 1.1, 1.4), 0.8
#: Edges (each counted from both ends) to a block of nodes that moves in one task.
BLOCK = 100_000


def local_fit(x: np.ndarray, y: np.ndarray, span: float = SPAN, places: int = PLACES) -> np.ndarray:
    """Local quadratic regression of y on x with tricube weights over the nearest `span` of the points, made at so many quantiles and joined by lines."""
    order = np.argsort(x, kind="stable")
    xs, ys = x[order], y[order]
    n, k = len(xs), max(3, int(np.ceil(span * len(xs))))
    at = np.unique(np.quantile(xs, np.linspace(0, 1, min(places, n))))
    fit = np.empty(len(at))
    for i, c in enumerate(at):
        lo = max(0, min(np.searchsorted(xs, c) - k // 2, n - k))
        while lo > 0 and c - xs[lo - 1] < xs[min(lo + k, n) - 1] - c:
            lo -= 1
        while lo + k < n and xs[lo + k] - c < c - xs[lo]:
            lo += 1
        part, values = xs[lo : lo + k] - c, ys[lo : lo + k]
        far = np.abs(part).max(initial=0.0) * 1.0000001
        w = np.sqrt(np.maximum(1 - (np.abs(part) / far) ** 3, 0) ** 3) if far > 0 else np.ones(len(part))
        terms = np.stack([np.ones(len(part)), part, part**2], 1)
        fit[i] = np.linalg.lstsq(terms * w[:, None], values * w, rcond=None)[0][0]
    return np.interp(x, at, fit)


def standardised_variance(counts: DataFrame, n: int = 2000) -> DataFrame:
    """(gene, mean, variance, standardised): the n genes whose counts (cell, gene, umis) vary most for their mean.

    The expected deviation comes from a local fit of log variance on log mean; counts over it are clipped at the root of the number of cells.
    Cells without the gene count as 0. A row for each gene goes to the driver for the fit, none for a cell.
    """
    cells = counts.select("cell").distinct().count()
    x = F.col("umis").cast("double")
    per = counts.groupBy("gene").agg(F.sum(x).alias("s"), F.sum(x * x).alias("q"), F.count("*").alias("k"))
    rows = sorted(tuple(r) for r in per.collect())
    if not rows or cells < 2:
        return counts.sparkSession.createDataFrame([], "gene string, mean double, variance double, standardised double")
    s, q, k = np.array([r[1:] for r in rows], float).T
    mean = s / cells
    var = (q - s * mean) / (cells - 1)
    ok = var > 0
    sd = np.ones(len(rows))
    sd[ok] = np.sqrt(10 ** local_fit(np.log10(mean[ok]), np.log10(var[ok])))
    table = counts.sparkSession.createDataFrame([(r[0], float(m), float(v), float(d), int(c)) for r, m, v, d, c in zip(rows, mean, var, sd, k)], "gene string, mean double, variance double, sd double, k long")
    z = F.least((x - F.col("mean")) / F.col("sd"), F.lit(float(np.sqrt(cells))))
    seen = counts.join(F.broadcast(table.select("gene", "mean", "sd")), "gene").groupBy("gene").agg(F.sum(z * z).alias("z"))
    rest = (cells - F.col("k")) * F.pow(F.col("mean") / F.col("sd"), F.lit(2.0))
    out = table.join(seen, "gene").select("gene", "mean", "variance", F.when(F.col("variance") > 0, (F.col("z") + rest) / (cells - 1)).otherwise(0.0).alias("standardised"))
    return out.orderBy(F.desc("standardised"), "gene").limit(n)


def scaled(values: DataFrame, genes: DataFrame, covariate: DataFrame) -> DataFrame:
    """(cell, features): per cell the residuals of its values (cell, gene, x) in the genes (gene) on the covariate (cell, c), over
    their deviation, LARGEST at most, in gene order. A gene that a cell lacks has the value 0; every cell of the covariate has a row.

    The regression of a gene needs sums over its cells alone. What goes to the driver is a row for each of the genes, a few thousand.
    """
    ship(values.sparkSession)
    total = covariate.agg(F.count("*"), F.sum("c"), F.sum(F.col("c") * F.col("c"))).first()
    n, sx, sxx = total[0], float(total[1] or 0), float(total[2] or 0)
    d = values.join(genes.select("gene"), "gene", "left_semi").join(covariate, "cell")
    sums = d.groupBy("gene").agg(F.sum("x"), F.sum(F.col("x") * F.col("c")), F.sum(F.col("x") * F.col("x")))
    rows = {r[0]: r[1:] for r in genes.select("gene").join(sums, "gene", "left").collect()}
    names = sorted(rows)
    y, yx, yy = np.array([[v or 0.0 for v in rows[g]] for g in names], float).reshape(len(names), 3).T
    vx = sxx - sx * sx / max(n, 1)
    slope = (yx - sx * y / max(n, 1)) / vx if vx > 1e-12 else np.zeros(len(names))
    start = y / max(n, 1) - slope * sx / max(n, 1)
    left = (yy - y * y / max(n, 1)) - slope * slope * vx
    sd = np.sqrt(np.maximum(left, 0) / max(n - 1, 1))
    sd[sd < 1e-9] = 1.0
    at = values.sparkSession.createDataFrame([(g, i) for i, g in enumerate(names)], "gene string, i int")
    per = d.join(F.broadcast(at), "gene").groupBy("cell").agg(F.collect_list("i").alias("i"), F.collect_list("x").alias("v"))

    @F.pandas_udf("array<double>")
    def dense(i: pd.Series, v: pd.Series, c: pd.Series) -> pd.Series:
        out = []
        for where, what, x in zip(i, v, c):
            full = np.zeros(len(names))
            if where is not None:
                full[where] = what
            out.append(np.clip((full - start - slope * x) / sd, -LARGEST, LARGEST).tolist())
        return pd.Series(out)

    return covariate.join(per, "cell", "left").select("cell", dense("i", "v", "c").alias("features"))


@tidy
def shared_neighbours(knn: DataFrame, key: str, least: float = OVERLAP) -> DataFrame:
    """(a, b, w), a < b: rows of a nearest-neighbour table (key, neighbour) whose neighbourhoods, themselves included, overlap; w is their
    Jaccard similarity, at least `least`.

    Sets of n that are alike share ceil(least * n) members at least, so one of those that remain when each set leaves out one less of its most frequent:
    rows meet by these alone, and what very many have as their neighbour makes no pairs. Pairs are then compared set by set.
    """
    own = knn.select(F.col(key).alias("a"), F.col("neighbour").alias("n"))
    whole = settle(own.unionByName(own.select("a", F.col("a").alias("n"))).distinct(), keep=True)  # read several times; neighbours are searched once
    often = whole.groupBy("n").agg(F.count("*").alias("f"))
    often = often.select("n", F.col("f").alias("held"), F.col("f").alias("f"))
    placed = join_spread(whole, often, "n", "held", max(whole.count(), 1))
    sets = placed.groupBy("a").agg(F.transform(F.sort_array(F.collect_list(F.struct("f", "n"))), lambda x: x["n"]).alias("set"))
    sets = settle(sets, keep=True)
    size = F.size("set")
    rare = sets.select("a", F.explode(F.slice("set", F.lit(1), (size - F.ceil(least * size - 1e-9) + 1).cast("int"))).alias("n"))
    pairs = rare.join(rare.withColumnRenamed("a", "b"), "n").where("a < b").select("a", "b").distinct()
    both = pairs.join(sets, "a").join(sets.select(F.col("a").alias("b"), F.col("set").alias("other")), "b")
    shared = F.size(F.array_intersect("set", "other"))
    return both.select("a", "b", (shared / (size + F.size("other") - shared)).alias("w")).where(F.col("w") >= least)


def improving_moves(graph: DataFrame, label: DataFrame, resolution: float, m2: float) -> DataFrame:
    """(node, mine, to, gain): for each node (node, k, c) the community that gains most modularity over staying, if any does.

    Joins on a community are of one row a community with many; where one is hot, adaptive execution splits its rows.
    """
    total = label.groupBy("c").agg(F.sum("k").alias("t"))
    near = graph.where("a != b").join(label.select(F.col("node").alias("b"), "c"), "b").groupBy(F.col("a").alias("node"), "c").agg(F.sum("w").alias("w"))
    both = near.join(total, "c").join(label.select("node", "k", F.col("c").alias("mine")), "node")
    own = F.col("c") == F.col("mine")
    value = F.col("w") - resolution * F.col("k") * (F.col("t") - F.when(own, F.col("k")).otherwise(0.0)) / m2
    # a node without an edge into its own community has no row of it: staying then costs only its share of the total
    best = both.withColumn("v", value).groupBy("node", "mine", "k").agg(F.max(F.when(~own, F.struct("v", "c"))).alias("o"), F.max(F.when(own, F.col("v"))).alias("stay"))
    alone = -resolution * F.col("k") * (F.col("t") - F.col("k")) / m2
    best = best.join(total.withColumnRenamed("c", "mine"), "mine").withColumn("gain", F.col("o.v") - F.coalesce("stay", alone))
    return best.where(F.col("gain") > 1e-9).select("node", "mine", F.col("o.c").alias("to"), "gain")


def move_in_turn(df: pd.DataFrame, resolution: float, m2: float) -> pd.DataFrame:
    """(node, to): the nodes of a block that end in another community when they move one after the other until no move of one of them gains modularity.

    A row is an edge of the block (node, k, c, t, inner, b, d, u, w): t and u are the totals of the communities c and d. Where `inner`, b is a node of the
    block and d where it starts; else w is the weight to all other nodes of d, which stay where they are meanwhile.
    """
    node, at = np.unique(df["node"].to_numpy(), return_inverse=True)
    names, of = np.unique(np.concatenate([df["c"].to_numpy(), df["d"].to_numpy()]), return_inverse=True)
    mine, other = of[: len(df)], of[len(df) :]
    total = np.zeros(len(names))
    total[mine], total[other] = df["t"], df["u"]
    k, label = np.zeros(len(node)), np.zeros(len(node), int)
    k[at], label[at] = df["k"], mine
    k, label, total, began = k.tolist(), label.tolist(), total.tolist(), label.copy()
    inner = df["inner"].to_numpy()
    where = np.full(len(df), -1)
    where[inner] = np.searchsorted(node, df["b"].to_numpy()[inner])
    near: list[list] = [[] for _ in node]
    for a, b, d, w in zip(at.tolist(), where.tolist(), other.tolist(), df["w"].tolist()):
        near[a].append((b, d, w))
    order = np.random.default_rng(len(node)).permutation(len(node)).tolist()
    todo, waits = deque(order), [True] * len(node)
    while todo:
        a = todo.popleft()
        waits[a] = False
        own, sums = label[a], {}
        for b, d, w in near[a]:
            c = label[b] if b >= 0 else d
            sums[c] = sums.get(c, 0.0) + w
        stay = sums.pop(own, 0.0) - resolution * k[a] * (total[own] - k[a]) / m2
        value, to = max(((w - resolution * k[a] * total[c] / m2, c) for c, w in sums.items()), default=(stay, own))
        if value - stay > 1e-9:
            label[a] = to
            total[own] -= k[a]
            total[to] += k[a]
            for b, _, _ in near[a]:
                if b >= 0 and not waits[b] and label[b] != to:
                    waits[b] = True
                    todo.append(b)
    moved = np.flatnonzero(np.array(label) != began)
    return pd.DataFrame({"node": node[moved], "to": names[np.array(label)[moved]]})


def block_moves(graph: DataFrame, label: DataFrame, resolution: float, m2: float, blocks: int, turn: int, hubs: DataFrame | None = None) -> DataFrame:
    """(node, to): the moves that so many blocks of nodes, dealt by a hash, make each for itself. Nodes of hubs (node) do not move.

    A task holds the edges of its own nodes, those to other blocks added up by community.
    """
    block = F.pmod(F.xxhash64("node", F.lit(turn)), F.lit(blocks))
    at = label.join(label.groupBy("c").agg(F.sum("k").alias("t")), "c").withColumn("block", block)
    if hubs is not None:
        at = at.join(F.broadcast(hubs.withColumn("hub", F.lit(True))), "node", "left").withColumn("block", F.when(F.col("hub"), F.lit(-1)).otherwise(F.col("block"))).drop("hub")
    ends = graph.where("a != b").join(at.where("block >= 0").withColumnRenamed("node", "a"), "a")
    ends = ends.join(at.select(F.col("node").alias("b"), F.col("c").alias("d"), F.col("t").alias("u"), F.col("block").alias("there")), "b")
    inner = F.col("block") == F.col("there")
    rows = ends.groupBy("block", F.col("a").alias("node"), "k", "c", "t", inner.alias("inner"), F.when(inner, F.col("b")).otherwise(F.col("a")).alias("b"), "d", "u").agg(F.sum("w").alias("w"))
    kind = graph.schema["a"].dataType.simpleString()
    return rows.groupBy("block").applyInPandas(lambda df: move_in_turn(df, resolution, m2), f"node {kind}, to {kind}")


def gained(graph: DataFrame, label: DataFrame, resolution: float, m2: float) -> float:
    """Modularity of labels (node, k, c), but for what edges from a node to itself add to it."""
    both = graph.where("a != b").join(label.select(F.col("node").alias("a"), F.col("c").alias("x")), "a").join(label.select(F.col("node").alias("b"), F.col("c").alias("y")), "b")
    inside = both.where("x = y").agg(F.sum("w")).first()[0] or 0.0
    return inside / m2 - resolution * label.groupBy("c").agg(F.sum("k").alias("t")).agg(F.sum(F.pow(F.col("t") / m2, F.lit(2.0)))).first()[0]


def local_moving(graph: DataFrame, label: DataFrame, resolution: float, m2: float) -> DataFrame:
    """Moves nodes (node, k, c) to neighbouring communities until no move of a single node gains modularity.

    In a turn the nodes of each block move one after the other, as if those of the other blocks stayed; other turns have other blocks. Where that does not raise
    modularity, it is undone, and only moves are made that are the best for both communities they touch: these do not disturb each other, so
    modularity rises with each turn and the end is reached. Nodes with more than BLOCK edges make such moves only.
    """
    ship(graph.sparkSession)
    degree = graph.where("a != b").groupBy(F.col("a").alias("node")).agg(F.count("*").alias("n"))
    edges, most = degree.agg(F.sum("n"), F.max("n")).first()
    blocks = -(-(edges or 0) // BLOCK)
    hubs = degree.where(F.col("n") > BLOCK).select("node") if (most or 0) > BLOCK else None
    worth = lambda d: gained(graph, d, resolution, m2) if blocks > 1 else 0.0
    value, turn = worth(label), 0
    while blocks:
        moves = block_moves(graph, label, resolution, m2, blocks, turn, hubs)
        new = settle(label.join(moves, "node", "left").select("node", "k", F.coalesce("to", "c").alias("c")))
        after = worth(new)
        turn += 1
        if blocks == 1 or after > value + 1e-12:  # moves of a single block cannot disturb each other
            release(label)
            label, value = new, after
            if blocks > 1:
                continue
        else:
            release(new)
        state = settle(label.join(improving_moves(graph, label, resolution, m2).select("node", "to", "gain"), "node", "left"))
        if state.where("to is not null").isEmpty():
            break
        touched = state.where("to is not null").select(F.explode(F.array("c", "to")).alias("x"), F.struct("gain", "node").alias("m"))
        top = touched.groupBy("x").agg(F.max("m").alias("m")).groupBy("m").agg(F.count("*").alias("sides")).where("sides = 2")
        new = state.join(top.select(F.col("m.node").alias("node"), F.lit(True).alias("go")), "node", "left").select("node", "k", F.when(F.col("go"), F.col("to")).otherwise(F.col("c")).alias("c"))
        new = settle(new)
        release(state)
        release(label)
        label, value = new, worth(new)
    return label


def join_in_turn(df: pd.DataFrame, resolution: float, m2: float) -> pd.DataFrame:
    """(s, to): parts that join others, of edges (a, b, w) of whole communities and the totals ta and tb of their ends, until no two parts gain by joining."""
    name, of = np.unique(np.concatenate([df["a"].to_numpy(), df["b"].to_numpy()]), return_inverse=True)
    total = np.zeros(len(name))
    total[of[: len(df)]], total[of[len(df) :]] = df["ta"], df["tb"]
    total, into = total.tolist(), list(range(len(name)))
    near: list[dict] = [{} for _ in name]
    for a, b, w in zip(of[: len(df)].tolist(), of[len(df) :].tolist(), df["w"].tolist()):
        near[a][b] = w
    todo = deque(np.random.default_rng(len(name)).permutation(len(name)).tolist())
    while todo:
        a = todo.popleft()
        if into[a] != a:
            continue
        gain, b = max(((w - resolution * total[a] * total[b] / m2, b) for b, w in near[a].items()), default=(0.0, a))
        if gain > 1e-9:
            if len(near[a]) > len(near[b]):
                a, b = b, a
            into[a] = b
            total[b] += total[a]
            for c, w in near[a].items():
                del near[c][a]
                if c != b:
                    near[b][c] = near[c][b] = near[b].get(c, 0.0) + w
            near[a] = {}
            todo.append(b)  # a part beside it gains by joining it only if it gains by joining that part
    for a in range(len(into)):
        while into[into[a]] != into[a]:
            into[a] = into[into[a]]
    gone = np.flatnonzero(np.array(into) != np.arange(len(into)))
    return pd.DataFrame({"s": name[gone], "to": name[np.array(into, int)[gone]]})


def refined(graph: DataFrame, label: DataFrame, resolution: float, m2: float) -> DataFrame:
    """(node, s): parts of the communities, each held together by its own edges.

    Every node is a part at first; parts of a community join until no two gain modularity by it. Communities of up to BLOCK edges do so one by one in a task
    that holds some of them. In larger ones parts are centres, by the toss of a hash, or join the centre beside them that gains most, until few enough edges are left.
    """
    ship(graph.sparkSession)
    mine = label.select("node", "c")
    inside = graph.where("a != b").join(mine.select(F.col("node").alias("a"), "c"), "a").join(mine.select(F.col("node").alias("b"), F.col("c").alias("d")), "b").where("c = d").select("c", "a", "b", "w")
    inside, total = settle(inside, keep=True), label.select(F.col("node").alias("s"), F.col("k").alias("t"))
    part, turn, kind = label.select("node", F.col("node").alias("s")), 0, graph.schema["a"].dataType.simpleString()
    while True:
        with scope():
            size = inside.groupBy("c").agg(F.count("*").alias("n"))
            edges, most = size.agg(F.sum("n"), F.max("n")).first()
            if not edges:
                return part
            ends = inside.join(total.select(F.col("s").alias("a"), F.col("t").alias("ta")), "a").join(total.select(F.col("s").alias("b"), F.col("t").alias("tb")), "b").join(size, "c")
            small = ends.where(F.col("n") <= BLOCK).withColumn("block", F.pmod(F.xxhash64("c"), F.lit(-(-edges // BLOCK))))
            join = small.groupBy("block").applyInPandas(lambda df: join_in_turn(df, resolution, m2), f"s {kind}, to {kind}")
            if most > BLOCK:
                gain = F.col("w") - resolution * F.col("ta") * F.col("tb") / m2
                good = settle(ends.where(F.col("n") > BLOCK).withColumn("gain", gain).where("gain > 1e-9").select("a", "b", "gain"))
                centre = lambda c: F.pmod(F.xxhash64(c, F.lit(turn)), F.lit(2)) == 0
                toss = good.where(~centre("a") & centre("b")).groupBy("a").agg(F.max(F.struct("gain", "b")).alias("o")).select(F.col("a").alias("s"), F.col("o.b").alias("to"))
                join = join.unionByName(toss)
            last = most <= BLOCK or good.isEmpty()
            join = settle(join)
            moved = lambda d, c: d.join(join.withColumnRenamed("s", c), c, "left").withColumn(c, F.coalesce("to", c)).drop("to")
            part = settle(moved(part, "s").select("node", "s"), keep=True)
            if last:
                return part
            total = settle(moved(total, "s").groupBy("s").agg(F.sum("t").alias("t")), keep=True)
            left = inside.join(size.where(F.col("n") > BLOCK).select("c"), "c", "left_semi")  # the others are done
            inside = settle(moved(moved(left, "a"), "b").where("a != b").groupBy("c", "a", "b").agg(F.sum("w").alias("w")), keep=True)
        turn += 1


@tidy
def communities(edges: DataFrame, resolution: float = RESOLUTION) -> DataFrame:
    """(node, cluster) of the nodes of weighted edges (a, b, w): communities of high modularity at the resolution, numbered from 0 by size, then least node.

    Leiden (Traag et al., 2019) in blocks of nodes: nodes move until no move gains, communities are refined into connected parts, and the same begins again over the
    graph of the parts, which start in their communities; until each community is one part. A community that its last moves have
    parted falls into its pieces, which modularity does not lose by: every cluster is connected. Nodes without edges to others are not in the result.
    """
    whole = settle(edges.select("a", "b", "w").union(edges.select("b", "a", "w")).groupBy("a", "b").agg(F.sum("w").alias("w")))
    m2 = whole.agg(F.sum("w")).first()[0]
    of = settle(whole.select(F.col("a").alias("node")).distinct().withColumn("group", F.col("node")))  # of the nodes given
    if not m2:
        return edges.select(F.col("a").alias("node"), F.lit(0).alias("cluster")).where("false")
    graph = whole
    label = settle(graph.groupBy(F.col("a").alias("node")).agg(F.sum("w").alias("k")).select("node", "k", F.col("node").alias("c")))
    loose = False
    while True:
        label = local_moving(graph, label, resolution, m2)
        nodes, groups = label.agg(F.count("*"), F.count_distinct("c")).first()
        if nodes == groups:
            break
        part = refined(graph, label, resolution, m2)
        if part.select("s").distinct().count() == nodes:  # nothing joins: the communities are the parts
            part, loose = label.select("node", F.col("c").alias("s")), True
        part = settle(part)
        of = settle(of.join(part.select(F.col("node").alias("group"), "s"), "group").select("node", F.col("s").alias("group")))
        ends, other = (part.select(F.col("node").alias(x), F.col("s").alias(y)) for x, y in (("a", "x"), ("b", "y")))
        graph = settle(graph.join(ends, "a").join(other, "b").groupBy(F.col("x").alias("a"), F.col("y").alias("b")).agg(F.sum("w").alias("w")))
        joined = part.join(label, "node").groupBy("s").agg(F.sum("k").alias("k"), F.first("c").alias("c"))
        first = joined.groupBy("c").agg(F.min("s").alias("first"))  # a community is named after one of its parts
        label = settle(joined.join(first, "c").select(F.col("s").alias("node"), "k", F.col("first").alias("c")))
    of = settle(of.join(label.select(F.col("node").alias("group"), "c"), "group").select("node", "c"))
    if loose:  # parts hang together, whole communities may not
        x, y = (of.select(F.col("node").alias(n), F.col("c").alias(c)) for n, c in (("a", "c1"), ("b", "c2")))
        inner = whole.where("a < b").join(x, "a").join(y, "b").where("c1 = c2").select("a", "b")
        of = components(inner, of.select("node")).withColumnRenamed("comp", "c")
    of = of.withColumnRenamed("c", "group")
    sizes = of.groupBy("group").agg(F.count("*").alias("n"), F.min("node").alias("first"))
    numbered = sizes.select("group", (F.row_number().over(Window.orderBy(F.desc("n"), "first")) - 1).alias("cluster"))  # a row for each community
    return settle(of.join(numbered, "group").select("node", "cluster"), keep=True)


def modularity(edges: DataFrame, clusters: DataFrame, resolution: float = RESOLUTION) -> float:
    """Of a clustering (node, cluster) of weighted edges (a, b, w)."""
    both = edges.join(clusters.select(F.col("node").alias("a"), F.col("cluster").alias("x")), "a").join(clusters.select(F.col("node").alias("b"), F.col("cluster").alias("y")), "b")
    m = both.agg(F.sum("w"), F.sum(F.when(F.col("x") == F.col("y"), F.col("w")).otherwise(0.0))).first()
    ends = both.select(F.col("x").alias("c"), "w").union(both.select(F.col("y").alias("c"), "w")).groupBy("c").agg(F.sum("w").alias("k"))
    squares = ends.agg(F.sum(F.pow(F.col("k") / (2 * m[0]), F.lit(2.0)))).first()[0]
    return m[1] / m[0] - resolution * squares


def resolutions(edges: DataFrame, tried: tuple[float, ...] = RESOLUTIONS) -> DataFrame:
    """(resolution, clusters): how many communities each resolution finds."""
    rows = [(float(r), communities(edges, r).select("cluster").distinct().count()) for r in tried]
    return edges.sparkSession.createDataFrame(rows, "resolution double, clusters long")


def neighbours_for(cells: int) -> int:
    """Neighbours to a cell in a graph of so many."""
    return max(15, int(np.log2(max(cells, 1)) * 2))


def filtered_markers(markers: DataFrame, least_share: float = 0.1, least_change: float = 0.25) -> DataFrame:
    """Markers (gene, cluster, pct_1, pct_2, log2_fc, ...) that one of both sides has in enough cells and that rise enough in the cluster."""
    return markers.where((F.greatest("pct_1", F.coalesce("pct_2", F.lit(0.0))) >= least_share) & (F.col("log2_fc") >= least_change))
