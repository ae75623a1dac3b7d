"""Whole jobs: results that an earlier version cut."""

import numpy as np
from pyspark.sql import functions as F

from readloom.operators import cells as L
from readloom.operators import methyl as Y
from readloom.operators import umi as U


def test_methyl_matrix_has_every_bin(spark):
    rng = np.random.default_rng(3)
    bins = [("chrA", 0), ("chrA", 14), ("chrN", 14), ("chrN", 300)]
    rows = [(c, *b, int(rng.integers(0, 6)), int(rng.integers(6, 20))) for c in range(8) for b in bins if (c, b) != (0, bins[2])]
    d = spark.createDataFrame(rows, "cell long, chrom string, bin long, mc long, cov long")
    got = {r[0]: np.array(r[1]) for r in Y.methyl_matrix(d, spark.range(9).withColumnRenamed("id", "cell")).collect()}
    x = np.zeros((9, 4))
    for c in range(8):
        mine = [r for r in rows if r[0] == c]
        raw = np.array([r[3] / r[4] for r in mine])
        size = max(1.0, raw.mean() * (1 - raw.mean()) / raw.var() - 1)
        for r in mine:
            x[c, bins.index(r[1:3])] = np.log(min(10, (r[3] + raw.mean() * size) / (r[4] + size) / raw.mean()))
    x = np.clip(x / x.std(0), -10, 10)
    assert set(got) == set(range(9)) and all(np.allclose(got[c], x[c]) for c in got)
    assert all(len(r[1]) == 2 for r in Y.methyl_matrix(d, d.select("cell").distinct(), 2).collect())


def test_components_of_a_long_chain(spark):
    names = [f"n{i:02d}" for i in range(12)]
    order = [0, 5, 11, 3, 8, 1, 10, 4, 7, 2, 9, 6]
    e = spark.createDataFrame([(names[a], names[b]) for a, b in zip(order, order[1:])] + [("x", "y")], "a string, b string")
    nodes = spark.createDataFrame([(n,) for n in [*names, "x", "y", "z"]], "node string")
    assert dict(map(tuple, U.components(e, nodes).collect())) == {n: "n00" for n in names} | {"x": "x", "y": "x", "z": "z"}


def test_cell_call_of_the_reference(spark):
    p = L.good_turing(np.array([0, 0, 1, 1, 1, 2, 2, 3, 5, 9]))
    assert abs(p.sum() - 1) < 1e-9 and abs(p[:2].sum() - 3 / 24) < 1e-9 and (np.diff(p[[2, 5, 7, 8, 9]]) > 0).all()
    counts = spark.createDataFrame([("c", "g0", 60), ("d", "g1", 30), ("d", "g0", 30)], "cell string, gene string, umis long")
    profile = spark.createDataFrame([("g0", 0.001), ("g1", 0.999)], "gene string, p double")
    tested = L.benjamini_hochberg(L.ambient_test(counts, counts.groupBy("cell").agg(F.sum("umis").alias("umis")), profile), "p", ["cell"])
    assert abs({r.cell: r.p for r in tested.collect()}["c"] - 1 / 10_001) < 1e-12
    first = spark.createDataFrame([("a",), ("c",)], "cell string")
    assert {r[0] for r in L.called_cells(first, tested).collect()} == {"a", "c", "d"}
    sums = spark.createDataFrame([(i, 1000 if i < 50 else 1) for i in range(500)], "cell long, umis long")
    got = {r.cell for r in L.ordmag_resampled(sums, 300).collect()}
    assert got == set(range(len(got))) and 45 <= len(got) <= 55


def test_variable_bins_lie_above_the_trend(spark):
    """The bins chosen and their scales against numpy's least squares."""
    r = np.random.default_rng(6)
    cells, bins = 40, 60
    rows = [(f"c{i}", "chr1", b, float(r.gamma(2 if b % 9 else 0.5, 0.5) + 0.05), int(r.integers(1, 4 + b))) for i in range(cells) for b in range(bins) if r.random() < 0.8]
    got = Y.variable_features(spark.createDataFrame(rows, "cell string, chrom string, bin long, f double, cov long"), cells, 10)
    f, cov = np.ones((cells, bins)), np.zeros(bins)
    for c, _, b, x, n in rows:
        f[int(c[1:]), b] = x
        cov[b] += n
    mean, sd, scale = f.mean(0), f.std(0), np.log(f).std(0)
    x, y, spread = np.log2(mean), np.log2(cov / cells), np.log2(sd / mean)
    design = np.stack([np.ones(bins), x, y, x * x, x * y, y * y], 1)
    above = spread - design @ np.linalg.lstsq(design, spread, rcond=None)[0]
    pick = sorted(np.argsort(-above)[:10])
    assert [(c, b) for c, b, _ in got] == [("chr1", b) for b in pick] and np.allclose([s for *_, s in got], scale[pick])
