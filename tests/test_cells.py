"""Cell calling against exact distributions."""

import itertools
import math
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from readloom.operators import cells as L


def loglik(x, p):
    return math.lgamma(sum(x) + 1) + sum(k * math.log(q) - math.lgamma(k + 1) for k, q in zip(x, p))


def test_trajectories_are_multinomial_likelihoods():
    p = np.array([0.5, 0.3, 0.15, 0.05])
    path = L.trajectory(np.random.default_rng(3), np.cumsum(p), np.log(p), np.log(np.arange(1, 41)))
    u = np.random.default_rng(3).random(40)
    gene = np.searchsorted(np.cumsum(p), u, "right")
    assert np.allclose(path, [loglik(np.bincount(gene[:n], minlength=4), p) for n in range(1, 41)])


def ambient(spark, cells, p, **more):
    counts = spark.createDataFrame([(c, f"g{i}", k) for c, x in cells.items() for i, k in enumerate(x) if k], "cell string, gene string, umis long")
    profile = spark.createDataFrame([(f"g{i}", q) for i, q in enumerate(p)], "gene string, p double")
    return L.ambient_test(counts, counts.groupBy("cell").agg(F.sum("umis").alias("umis")), profile, **more)


def test_p_values_against_the_whole_distribution(spark):
    """Each candidate's p is the chance of a strictly lower likelihood: counted over all outcomes of its total, equal ones not."""
    p = [0.5, 0.3, 0.2]
    cells = {f"c{a}{b}{c}": (a, b, c) for a, b, c in itertools.product(range(4), repeat=3) if a + b + c}
    got = {r.cell: r for r in ambient(spark, cells, p).collect()}
    assert set(got) == set(cells)
    for name, x in cells.items():
        n = sum(x)
        outcomes = [(a, b, n - a - b) for a in range(n + 1) for b in range(n + 1 - a)]
        below = sum(math.exp(loglik(y, p)) for y in outcomes if loglik(y, p) < loglik(x, p) - 1e-9)
        assert got[name].umis == n and abs(got[name].loglik - loglik(x, p)) < 1e-9
        assert abs(got[name].p - below) < 5 * math.sqrt(max(below * (1 - below), 1e-4) / 10_000) + 2e-4


def test_simulations_do_not_depend_on_partitions(spark):
    r = np.random.default_rng(5)
    p = r.dirichlet(np.ones(30))
    cells = {f"c{i}": r.multinomial(int(n), p).tolist() for i, n in enumerate(r.integers(1, 60, 20))}
    one = sorted(map(tuple, ambient(spark, cells, p.tolist(), simulations=500).collect()))
    spark.conf.set("spark.sql.shuffle.partitions", 3)
    try:
        two = sorted(map(tuple, ambient(spark, dict(reversed(cells.items())), p.tolist(), simulations=500).repartition(2).collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
    assert [(c, n, q) for c, n, _, q in one] == [(c, n, q) for c, n, _, q in two]
    assert ambient(spark, {"c": [0] * 3}, [0.2, 0.3, 0.5]).collect() == []


@pytest.mark.parametrize("seed", [1])
def test_many_totals_cost_as_much_as_few(spark, seed):
    p = np.full(2000, 1 / 2000).tolist()
    took = {}
    for n in (10, 10, 1000):
        cells = {f"c{i}": [1] * (2000 - i * (1000 // n)) for i in range(n)}
        began = time.time()
        assert ambient(spark, cells, p, simulations=2000, seed=seed).count() == n
        took[n] = time.time() - began
    assert took[1000] < 4 * took[10] + 8
