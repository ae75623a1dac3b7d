"""Clustering steps against plain numpy, and remapped files."""

import collections
import random

import numpy as np
from pyspark.sql import functions as F

from readloom import sinks
from readloom.operators import clusters as U
from readloom.operators import markers as K
from readloom.operators import names as N
from readloom.sources import bam as B
from readloom.sources import files as S


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_communities_find_the_blocks(spark):
    """Four dense groups with few edges between them; modularity is that of the groups or more."""
    r = random.Random(2)
    edges = []
    for a in range(80):
        for b in range(a):
            if r.random() < (0.6 if a // 20 == b // 20 else 0.02):
                edges.append((b, a, 1.0))
    e = spark.createDataFrame(edges, "a long, b long, w double")
    found = U.communities(e, 1.0)
    got = {x.node: x.cluster for x in found.collect()}
    assert set(got) == {x for a, b, _ in edges for x in (a, b)}
    assert len({(n // 20, c) for n, c in got.items()}) == 4 == len(set(got.values()))
    best = spark.createDataFrame([(n, n // 20) for n in got], "node long, cluster int")
    assert U.modularity(e, found, 1.0) >= U.modularity(e, best, 1.0) - 1e-9
    assert U.communities(e.where("a < 0")).count() == 0
    assert U.resolutions(e, (1.0,)).first().clusters == 4


def test_clusters_are_connected(spark):
    """A sparse random graph, a ring of cliques, a chain and a star: every cluster hangs together, and no whole is worse than its parts."""
    r = random.Random(7)
    edges = {(min(a, b), max(a, b)) for a, b in ((r.randrange(60), r.randrange(60)) for _ in range(80)) if a != b}
    for k in range(6):
        edges |= {(1000 + 5 * k + i, 1000 + 5 * k + j) for i in range(5) for j in range(i + 1, 5)}
        edges.add(tuple(sorted((1000 + 5 * k, 1000 + (5 * k + 5) % 30))))
    edges |= {(2000 + i, 2001 + i) for i in range(12)} | {(3000, 3001 + i) for i in range(9)}
    e = spark.createDataFrame([(f"n{a:04d}", f"n{b:04d}", 1.0) for a, b in sorted(edges)], "a string, b string, w double")
    found = U.communities(e, 1.0)
    of = {int(x.node[1:]): x.cluster for x in found.collect()}
    assert set(of) == {x for ab in edges for x in ab}
    for c in set(of.values()):
        left = {n for n, d in of.items() if d == c}
        todo = [left.pop()]
        while todo:
            x = todo.pop()
            near = {b if a == x else a for a, b in edges if x in (a, b)} & left
            left -= near
            todo += near
        assert not left
    assert all(len({of[1000 + 5 * k + i] for i in range(5)}) == 1 for k in range(6)) and len({of[3000 + i] for i in range(10)}) == 1
    sizes = collections.Counter(of.values())
    assert [sizes[c] for c in range(len(sizes))] == sorted(sizes.values(), reverse=True)
    pieces = spark.createDataFrame([(f"n{n:04d}", n) for n in of], "node string, cluster int")
    assert U.modularity(e, found, 1.0) > U.modularity(e, pieces, 1.0) and U.modularity(e, found, 1.0) > 0.7


def test_moves_that_only_one_at_a_time_can_make(spark, monkeypatch):
    """With the halves switched off, single best moves alone reach a place from which no move gains."""
    r = random.Random(3)
    edges = [(a, b, 1.0) for a in range(30) for b in range(a) if r.random() < (0.5 if a // 10 == b // 10 else 0.05)]
    e = spark.createDataFrame(edges, "a long, b long, w double")
    g = e.union(e.select("b", "a", "w")).toDF("a", "b", "w").cache()
    label = g.groupBy(F.col("a").alias("node")).agg(F.sum("w").alias("k")).withColumn("c", F.col("node"))
    done = U.local_moving(g, label, 1.0, 2.0 * len(edges))
    assert U.improving_moves(g, done, 1.0, 2.0 * len(edges)).count() == 0


def knots(seed, n, size, near, far):
    r = random.Random(seed)
    return [(b, a, 1.0) for a in range(n) for b in range(a) if r.random() < (near if a // size == b // size else far)]


def test_few_tables_for_many_moves(spark, monkeypatch):
    """The moves of a block are made in one task: a graph in which nodes move hundreds of times settles a few tables a level, not some a turn."""
    made, settle = [], U.settle
    monkeypatch.setattr(U, "settle", lambda *a, **k: made.append(1) or settle(*a, **k))
    e = spark.createDataFrame(knots(5, 160, 20, 0.4, 0.06), "a long, b long, w double")
    found = U.communities(e, 1.0)
    assert found.count() == 160 and len(made) < 60


def test_blocks_hubs_and_large_communities(spark, monkeypatch):
    """With blocks of a few edges, a hub beyond them and communities beyond them: no move gains at the end, and parts hang together as in one block."""
    edges = knots(6, 90, 30, 0.5, 0.02) + [(a, 90, 0.01) for a in range(90)] + [(a, 91 + a, 1.0) for a in range(9)]
    e = spark.createDataFrame(edges, "a long, b long, w double")
    g = e.union(e.select("b", "a", "w")).toDF("a", "b", "w").cache()
    m2 = 2 * sum(w for *_, w in edges)
    whole = U.modularity(e, U.communities(e, 1.0), 1.0)
    monkeypatch.setattr(U, "BLOCK", 100)
    label = g.groupBy(F.col("a").alias("node")).agg(F.sum("w").alias("k")).withColumn("c", F.col("node"))
    done = U.local_moving(g, label, 1.0, m2)
    assert U.improving_moves(g, done, 1.0, m2).count() == 0 and done.count() == 100
    assert abs(U.gained(g, done, 1.0, m2) - U.modularity(e, done.select("node", F.col("c").alias("cluster")), 1.0)) < 1e-9
    of = {r.node: r.c for r in done.collect()}
    part = {r.node: r.s for r in U.refined(g, done, 1.0, m2).collect()}
    assert set(part) == set(of) and all(of[s] == of[n] for n, s in part.items())
    total, between = collections.Counter(), collections.Counter()
    for a, b, w in edges:
        for x, y in ((a, b), (b, a)):
            total[part[x]] += w
            between[part[x], part[y]] += w
    assert all(of[s] != of[p] or w - total[s] * total[p] / m2 <= 1e-9 for (s, p), w in between.items() if s != p)
    found = U.communities(e, 1.0)
    assert found.count() == 100 and U.modularity(e, found, 1.0) > whole - 0.02


def test_shared_neighbours(spark):
    r = np.random.default_rng(1)
    x = r.normal(size=(40, 3))
    d = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "id long, v array<double>")
    near = {}
    for i in range(40):
        far = np.round(np.sqrt(((x - x[i]) ** 2).sum(1)), 6)
        near[i] = {i} | set([j for j in np.argsort(far, kind="stable") if j != i][:5])
    want = {(a, b): len(near[a] & near[b]) / len(near[a] | near[b]) for a in range(40) for b in range(40) if a < b}
    got = {(e.a, e.b): e.w for e in U.shared_neighbours(K.knn(d, d, "id", "v", 5), "id", 0.2).collect()}
    assert got == {k: w for k, w in want.items() if w >= 0.2}


def test_scaled_residuals(spark):
    r = np.random.default_rng(3)
    x = np.where(r.random((30, 6)) < 0.5, r.random((30, 6)), 0.0)
    c = r.random(30)
    values = spark.createDataFrame([(f"c{i:02d}", f"g{j}", float(x[i, j])) for i in range(30) for j in range(6) if x[i, j]], "cell string, gene string, x double")
    covariate = spark.createDataFrame([(f"c{i:02d}", float(c[i])) for i in range(30)], "cell string, c double")
    genes = spark.createDataFrame([(f"g{j}",) for j in range(6)] + [("absent",)], "gene string")
    got = {q.cell: np.array(q.features) for q in U.scaled(values, genes, covariate).collect()}
    terms = np.stack([np.ones(30), c], 1)
    left = x - terms @ np.linalg.lstsq(terms, x, rcond=None)[0]
    want = np.concatenate([np.zeros((30, 1)), left / left.std(0, ddof=1)], 1)
    assert all(np.allclose(got[f"c{i:02d}"], np.clip(want[i], -10, 10)) for i in range(30))


def test_standardised_variance(spark):
    r = np.random.default_rng(5)
    n, genes = 60, 80
    x = r.poisson(r.uniform(0.2, 6, genes), (n, genes))
    x[:, 7] = r.poisson(3, n) * r.integers(0, 4, n)
    d = spark.createDataFrame([(f"c{i}", f"g{j:02d}", int(x[i, j])) for i in range(n) for j in range(genes) if x[i, j]], "cell string, gene string, umis long")
    got = {q.gene: q for q in U.standardised_variance(d).collect()}
    mean, var = x.mean(0), x.var(0, ddof=1)
    sd = np.sqrt(10 ** U.local_fit(np.log10(mean), np.log10(var)))
    z = np.minimum((x - mean) / sd, np.sqrt(n))
    want = (z**2).sum(0) / (n - 1)
    assert all(abs(got[f"g{j:02d}"].standardised - want[j]) < 1e-9 for j in range(genes))
    assert max(got.values(), key=lambda q: q.standardised).gene == "g07"
    line = np.linspace(0, 1, 50)
    assert np.allclose(U.local_fit(line, 2 + 3 * line - line**2), 2 + 3 * line - line**2, atol=1e-3)


def test_marker_filter(spark):
    d = spark.createDataFrame([("g", 0.05, 0.3, 1.0), ("h", 0.05, 0.06, 1.0), ("i", 0.5, None, 0.2), ("j", 0.5, None, 0.25)], "gene string, pct_1 double, pct_2 double, log2_fc double")
    assert rows(U.filtered_markers(d).select("gene")) == [("g",), ("j",)] and U.neighbours_for(10) == 15 and U.neighbours_for(4096) == 24


def test_tags_beside_others(spark):
    d = spark.createDataFrame([("ACGT_UM_1N_r", {"XT": "g", "CB": "old"}), ("AC_U_q", None)], "qname string, tags map<string,string>")
    got = [tuple(r) for r in N.tagged(d).collect()]
    assert got == [("r", {"XT": "g", "CB": "ACGT", "CR": "ANGT", "UB": "UM", "UR": "UM"}), ("q", {"CB": "AC", "CR": "AC", "UB": "U", "UR": "U"})]


def test_remapped_files(spark, tmp_path):
    new = spark.createDataFrame([("NEW1",), ("NEW2",)], "barcode string")
    text = {"a.csv": "bc,n\nAA,1\nCC,2\nGG,3\n", "a.tsv": "n\tbc\n1\tAA\n2\tCC\n", "a.bed": "chr1\t1\t2\tAA\nchr1\t3\t4\tCC\n", "a.json": '{"bc":"AA","umi":"ACGT"}\n', "a.fastq": "@AA_U_r1\nACGT\n+\nIIII\n@CC_U_r2\nAC\n+\nII\n", "a.fa": ">AA_contig_1\nACGT\n>CC_contig_1\nGG\n"}
    for name, body in text.items():
        (tmp_path / name).write_text(body)
    read = lambda p: sorted(r[0] for r in spark.read.text(str(tmp_path / p)).collect())
    go = lambda name, **k: sinks.remap_file(spark, str(tmp_path / name), str(tmp_path / f"out-{name}"), new, **k)
    go("a.csv", column="bc")
    assert rows(spark.read.option("header", True).csv(str(tmp_path / "out-a.csv"))) == [("AA", "3"), ("NEW1", "1"), ("NEW2", "2")]
    go("a.tsv", column="bc")
    assert rows(spark.read.option("header", True).option("sep", "\t").csv(str(tmp_path / "out-a.tsv"))) == [("1", "NEW1"), ("2", "NEW2")]
    go("a.bed", column=3)
    assert read("out-a.bed") == ["chr1\t1\t2\tNEW1", "chr1\t3\t4\tNEW2"]
    go("a.json", column="bc", umi="umi", umi_length=2)
    assert read("out-a.json") == ['{"bc":"NEW1","umi":"AC"}']
    go("a.fastq")
    assert "@NEW1_U_r1" in read("out-a.fastq") and "@NEW2_U_r2" in read("out-a.fastq")
    go("a.fa")
    assert {">NEW1_contig_1", ">NEW2_contig_1"} <= set(read("out-a.fa"))
    B.write_bam(spark.createDataFrame([("AA_U_r",), ("CC_U_r",)], "qname string").withColumn("ref", F.lit("c")).withColumn("flag", F.lit(0)).coalesce(1), str(tmp_path / "bam"), [("c", 50)])
    (tmp_path / "bam" / "part-00000.bam").rename(tmp_path / "a.bam")
    go("a.bam")
    assert rows(B.read_bam(spark, str(tmp_path / "out-a.bam")).select("qname", "ref")) == [("NEW1_U_r", "c"), ("NEW2_U_r", "c")]
    assert rows(S.fastq_frame(spark, str(tmp_path / "a.fastq")).select("name", "ordinal")) == [("AA_U_r1", 0), ("CC_U_r2", 1)]
