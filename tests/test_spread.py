"""What no single task may hold: components, clones, quantiles, marker tests; each against plain code."""

import collections
import decimal
import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from readloom.operators import counts as C
from readloom.operators import markers as K
from readloom.operators import receptors as V
from readloom.operators import spread as P
from readloom.operators import umi as U


def test_a_long_chain_takes_few_rounds(spark, monkeypatch):
    n = 100_000
    rounds = []
    monkeypatch.setattr(U, "star", lambda *a, f=U.star: rounds.append(1) or f(*a))
    shuffled = F.pmod(F.col("id") * 51_749 + 7, F.lit(n))  # a chain whose nodes come in no order
    edges = spark.range(n - 1).select(shuffled.alias("a"), F.pmod((F.col("id") + 1) * 51_749 + 7, F.lit(n)).alias("b"))
    got = U.components(edges, spark.range(n + 1).select(F.col("id").alias("node")))
    assert got.groupBy("comp").count().collect() == [(0, n), (n, 1)] or sorted(map(tuple, got.groupBy("comp").count().collect())) == [(0, n), (n, 1)]
    assert len(rounds) / 2 < 25


def test_components_of_random_graphs_and_hubs(spark):
    r = random.Random(2)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(220)] + [(1000, 1000 + i) for i in range(1, 900)] + [(1500, 2000), (5, 5)]
    top = {x: x for x in itertools.chain(*edges)}

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        top[max(a, b)] = min(a, b)
    d = spark.createDataFrame(edges, "a long, b long")
    nodes = spark.createDataFrame([(x,) for x in [*top, 5000]], "node long")
    assert dict(map(tuple, U.components(d, nodes).collect())) == {x: root(x) for x in top} | {5000: 5000}
    assert U.components(d.where("a < 0"), nodes.limit(1)).count() == 1


@pytest.mark.parametrize("identity, candidates", [(0.8, 50), (0.6, 1), (1.0, 50), (0.85, 0)])
def test_clones_against_single_linkage(spark, monkeypatch, identity, candidates):
    monkeypatch.setattr(V, "CANDIDATES", candidates)
    r = random.Random(3)
    base = ["".join(r.choice("ACGT") for _ in range(n)) for n in (5, 12, 12, 30, 0, 1)]
    rows = []
    for i in range(260):
        s = list(r.choice(base))
        for _ in range(r.randint(0, 4)):
            if s:
                s[r.randrange(len(s))] = r.choice("ACGT")
        rows.append((i, r.choice(["V1", "V2"]), r.choice(["J1", None]) if i % 9 == 0 else "J1", None if i % 31 == 0 else "".join(s)))
    groups = collections.defaultdict(set)
    for _, v, j, s in rows:
        if None not in (v, j, s):
            groups[v, j, len(s)].add(s)
    clone = {}
    for (v, j, n), seqs in groups.items():
        left = sorted(seqs)
        while left:
            whole, todo = [left[0]], [left.pop(0)]
            while todo:
                x = todo.pop()
                near = [y for y in left if sum(p != q for p, q in zip(x, y)) <= math.floor(n * (1 - identity) + 1e-9)]
                left = [y for y in left if y not in near]
                whole, todo = whole + near, todo + near
            clone |= {(v, j, s): f"{v}|{j}|{n}|{min(whole)}" for s in whole}
    got = V.clone_groups(spark.createDataFrame(rows, "contig long, v string, j string, junction string"), identity)
    assert dict(map(tuple, got.collect())) == {i: clone.get((v, j, s)) for i, v, j, s in rows}


def test_quantiles_of_groups(spark):
    r = np.random.default_rng(1)
    rows = [(g, float(x)) for g, n in (("a", 1), ("b", 2), ("c", 777), ("d", 50)) for x in (r.normal(size=n) if g != "d" else r.integers(0, 3, n))] + [("c", None), ("e", None)]
    at = [0, 0.1, 0.25, 0.5, 0.9, 1]
    got = {(x.g, x.i): x.value for x in P.quantiles(spark.createDataFrame(rows, "g string, x double").repartition(5), "g", "x", at).collect()}
    want = {(g, i): np.quantile([x for h, x in rows if h == g and x is not None], q) for g in "abcd" for i, q in enumerate(at)}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)


def test_quantiles_of_ten_million_distinct_values(spark):
    n = 10_000_000
    d = spark.range(n).select(F.lit("one").alias("g"), (F.pmod(F.col("id") * 7_654_321, F.lit(n)) / 4).alias("x"))
    got = [r.value for r in P.quantiles(d, "g", "x", [0, 0.5, 1]).orderBy("i").collect()]
    assert got == [0.0, (n - 1) / 8, (n - 1) / 4]


def test_downsampling_parts_differ_by_one_read(spark):
    """Against a plain order by hash, with parts that are cut inside a range of hashes and between two."""
    import hashlib

    r = random.Random(4)
    rows = [(f"c{i % 7}", f"g{i % 5}", f"u{i}", r.choice([1, 1, 2, 40])) for i in range(60)]
    reads = sorted((hashlib.md5(f"s|{c}|{g}|{u}|{i}".encode()).hexdigest(), c, g, u) for c, g, u, n in rows for i in range(1, n + 1))
    d = spark.createDataFrame(rows, "cell string, gene string, umi string, num long")
    for steps in (1, 3, 10):
        want = []
        for k in range(1, steps + 1):
            part = reads[: -(-len(reads) * k // steps)]
            genes = collections.Counter(c for c, _ in {(c, g) for _, c, g, _ in part})
            want.append((k, len(part), round((len(part) - len({x[1:] for x in part})) / len(part) * 100, 6), math.floor(np.median(list(genes.values())))))
        assert sorted(map(tuple, C.downsample(d, steps).collect())) == want


def exact_log_tail(z):
    """By the continued fraction of the tail, with 60 digits."""
    decimal.getcontext().prec = 60
    z = decimal.Decimal(z)
    f = z
    for k in range(4000, 0, -1):
        f = z + k / f
    pi = decimal.Decimal("3.14159265358979323846264338327950288419716939937510582097494")
    return float(-z * z / 2 - (2 * pi).ln() / 2 - f.ln())


def test_tails_without_underflow():
    for z in (1, 2.5, 7, 19.999, 20, 20.5, 37, 40, 200):
        assert abs(K.log_tail(np.array([z]))[0] - exact_log_tail(z)) < 1e-9 * max(1, abs(exact_log_tail(z)))
    assert abs(K.log_tail(np.array([0.0]))[0] - math.log(0.5)) < 1e-12


def test_marker_table_against_plain_tests(spark):
    r = np.random.default_rng(8)
    cells = {f"c{i}": "abc"[i % 3] for i in range(90)}
    umis = {(c, f"g{j}"): int(r.poisson(3 if cells[c] == "abc"[j % 3] and j < 6 else 0.7)) for c in cells for j in range(12)}
    rows = [(c, g, n) for (c, g), n in umis.items() if n]
    counts = spark.createDataFrame(rows, "cell string, gene string, umis long")
    groups = spark.createDataFrame(list(cells.items()), "cell string, cluster string")
    total = collections.Counter()
    for (c, _), n in umis.items():
        total[c] += n
    got = {(x.cluster, x.gene): x for x in K.find_markers(counts, groups, keep=2.0, least_change=-9.0, least_share=0.0).collect()}
    assert len(got) == 36
    for (cluster, gene), x in got.items():
        values = {c: math.log1p(1e4 * umis[c, gene] / total[c]) for c in cells}
        flat = sorted(values.values())
        rank = {v: flat.index(v) + (flat.count(v) + 1) / 2 for v in set(flat)}
        n, n1 = len(cells), sum(k == cluster for k in cells.values())
        above = sum(rank[values[c]] for c in cells if cells[c] == cluster) - n1 * (n + 1) / 2
        ties = sum(k**3 - k for k in collections.Counter(flat).values())
        sd = math.sqrt(n1 * (n - n1) / 12 * (n + 1 - ties / (n * (n - 1))))
        z = math.copysign(max(abs(above) - 0.5, 0), above) / sd
        assert abs(x.z - z) < 1e-9 and abs(x.p_val - min(1, math.erfc(abs(z) / math.sqrt(2)))) < 1e-12
        assert abs(x.p_val_adj - min(1, 12 * x.p_val)) < 1e-12
    kept = K.find_markers(counts, groups).collect()
    assert {x.gene for x in kept} >= {"g0", "g1", "g2"} and all(x.p_val < 0.01 and x.log2_fc >= 0.25 for x in kept)
    assert [x.cluster for x in kept] == sorted(x.cluster for x in kept)


def test_components_whose_scores_differ(spark):
    """Distances between neighbouring components against numpy, ties included, and how many are kept."""
    from readloom.operators import methyl as M

    r = np.random.default_rng(2)
    x = np.stack([r.normal(0, 5, 300), r.normal(1, 2, 300), np.round(r.normal(0, 0.9, 300), 1), np.round(r.normal(0, 0.9, 300), 1), r.normal(4, 1, 300)], 1)
    d = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(x)], "id long, components array<double>").repartition(3)
    got = {g.i: g for g in M.component_gaps(d, "id").collect()}
    for i in range(4):
        at = np.sort(np.concatenate([x[:, i], x[:, i + 1]]))
        want = np.abs(np.searchsorted(np.sort(x[:, i]), at, "right") - np.searchsorted(np.sort(x[:, i + 1]), at, "right")).max() / 300
        t = want * math.sqrt(150)
        p = min(max(2 * sum((-1) ** (k + 1) * math.exp(-2 * k * k * t * t) for k in range(1, 200)), 0), 1) if t > 0.2 else 1
        assert abs(got[i].d - want) < 1e-12 and abs(got[i].p - p) < 1e-12
    n, kept = M.significant_components(d, "id")
    assert n == 3 and got[2].p > 0.1
    rows = {k.id: k.components for k in kept.collect()}
    assert np.allclose([rows[i] for i in range(300)], x[:, :3] / x[:, :3].std())
