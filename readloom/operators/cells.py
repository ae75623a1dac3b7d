"""Cell calling."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shipping import ship
from .ranking import benjamini_hochberg, ranked  # noqa: F401


def ordmag(sums: DataFrame, expected: int, quantile: float = 0.99) -> DataFrame:
    """Barcodes with at least a tenth of the UMIs of the barcode at rank expected * (1 - quantile), without resampling."""
    rank = max(1, round(expected * (1 - quantile)))
    top = sums.where("umis > 0").orderBy(F.desc("umis"), "cell").limit(rank).agg(F.min("umis").alias("base"))
    cut = top.select(F.greatest(F.lit(1), F.round(F.col("base") * 0.1)).alias("cutoff"), F.lit(1).alias("k"))
    return sums.withColumn("k", F.lit(1)).join(F.broadcast(cut), "k").where("umis >= cutoff").drop("k", "cutoff")


def ordmag_resampled(sums: DataFrame, expected: int, quantile: float = 0.99, samples: int = 100, seed: int = 1) -> DataFrame:
    """The n largest barcodes, n being the mean over `samples` bootstraps of those with a tenth of the UMIs of the barcode at rank expected * (1 - quantile).

    A bootstrap is drawn as the counts of the distinct UMI numbers, which alone go to the driver.
    """
    some = sums.where("umis > 0")
    rows = sorted(tuple(r) for r in some.groupBy("umis").count().collect())
    if not rows:
        return some
    value, count = np.array(rows).T
    n = int(count.sum())
    rank = max(1, min(round(expected * (1 - quantile)), n - 1))
    found = []
    for draw in np.random.default_rng(seed).multinomial(n, count / n, samples):
        above = np.cumsum(draw[::-1])[::-1]  # barcodes with at least each value
        base = value[np.flatnonzero(above >= rank)[-1]]
        found.append(int(draw[value >= max(1, round(0.1 * float(base)))].sum()))
    return force(some, round(float(np.mean(found))))


def candidates(sums: DataFrame, called: DataFrame, least: int = 500, share: float = 0.01, limit: int | None = 20_000) -> DataFrame:
    """Barcodes not called with at least max(least, ceil(share * median UMIs of the called)), the `limit` largest; all of them where that is None."""
    med = sums.join(called.select("cell"), "cell", "left_semi").agg(F.median("umis").alias("m"))
    floor_ = med.select(F.greatest(F.lit(least), F.ceil(F.coalesce("m", F.lit(0)) * share)).alias("floor"), F.lit(1).alias("k"))
    rest = sums.join(called.select("cell"), "cell", "left_anti").withColumn("k", F.lit(1)).join(F.broadcast(floor_), "k").where("umis >= floor")
    rest = rest.select("cell", "umis")
    return rest if limit is None else rest.orderBy(F.desc("umis"), "cell").limit(limit)


def force(sums: DataFrame, n: int) -> DataFrame:
    return sums.orderBy(F.desc("umis"), "cell").limit(n)


def good_turing(counts: np.ndarray) -> np.ndarray:
    """Shares by simple Good-Turing smoothing (Gale and Sampson); genes with count 0 divide the share of the unseen equally.

    Where no gene was seen just once, the unseen have the share of half a count, so that no gene is impossible.
    """
    x = np.asarray(counts, np.int64)
    r, n = np.unique(x[x > 0], return_counts=True)
    if not len(r):
        return np.full(len(x), 1 / max(len(x), 1))
    total, zero = float((r * n).sum()), int((x == 0).sum())
    unseen = (n[0] if r[0] == 1 else 0.5) / total if zero else 0.0
    if unseen >= 1:  # nothing but single counts
        unseen = 0.5
    before, after = np.concatenate([[0], r[:-1]]), np.concatenate([r[1:], [2 * r[-1] - (r[-2] if len(r) > 1 else 0)]])
    slope = np.polyfit(np.log(r), np.log(2 * n / (after - before)), 1)[0] if len(r) > 1 else -1.0
    star, smooth = np.empty(len(r)), False
    for i, k in enumerate(r):
        fit = k * (1 + 1 / k) ** (slope + 1)
        if not smooth and i + 1 < len(r) and r[i + 1] == k + 1:
            more = n[i + 1] / n[i]
            star[i] = (k + 1) * more
            smooth = abs(star[i] - fit) <= 1.96 * (k + 1) * math.sqrt(more / n[i] * (1 + more))
        else:
            smooth = True
        if smooth:
            star[i] = fit
    share = (1 - unseen) * star / (star * n).sum()
    return np.where(x > 0, share[np.searchsorted(r, np.maximum(x, r[0]))], unseen / max(zero, 1))


def ambient_profile(counts: DataFrame, sums: DataFrame, low: int, high: int) -> DataFrame:
    """(gene, p): Good-Turing shares in barcodes of UMI rank low < rank <= high. A row for each gene goes to the driver."""
    ambient = ranked(sums, "umis", ["cell"], "r").where((F.col("r") > low) & (F.col("r") <= high)).select("cell")
    seen = counts.join(ambient, "cell", "left_semi").groupBy("gene").agg(F.sum("umis").alias("u"))
    rows = counts.select("gene").distinct().join(seen, "gene", "left").select("gene", F.coalesce("u", F.lit(0))).orderBy("gene").collect()
    share = good_turing(np.array([r[1] for r in rows], np.int64))
    return counts.sparkSession.createDataFrame([(r[0], float(p)) for r, p in zip(rows, share)], "gene string, p double")


def called_cells(first: DataFrame, tested: DataFrame, limit: float = 0.01) -> DataFrame:
    """(cell): those of the first call and the tested ones with q below the limit."""
    return first.select("cell").union(tested.where(F.col("q") < limit).select("cell")).distinct()


def log_factorial(n: np.ndarray) -> np.ndarray:
    return np.fromiter((math.lgamma(x + 1.0) for x in n), float, len(n))


def log_likelihoods(counts: DataFrame, cands: DataFrame, profile: DataFrame) -> DataFrame:
    """(cell, umis, loglik): of each candidate (cell, umis) the multinomial log-likelihood of its counts (cell, gene, umis) under the shares (gene, p), all of which are above 0."""
    ship(counts.sparkSession)

    @F.pandas_udf("double")
    def factorial(n: pd.Series) -> pd.Series:
        return pd.Series(log_factorial(n.to_numpy()))

    own = counts.join(cands.select("cell", F.col("umis").alias("total")), "cell").join(profile.select("gene", "p"), "gene")
    found = own.groupBy("cell", F.col("total").cast("long").alias("umis")).agg(F.sum(F.col("umis") * F.log("p") - factorial("umis")).alias("part"))
    return found.select("cell", "umis", (F.col("part") + factorial("umis")).alias("loglik"))


def trajectory(rng: np.random.Generator, edges: np.ndarray, logp: np.ndarray, logs: np.ndarray) -> np.ndarray:
    """Multinomial log-likelihoods of one simulated barcode as it grows molecule by molecule, after 1, 2, ... of them.

    The n-th molecule, the k-th of its gene, adds log p + log(n / k). edges: cumulative shares; logs: logarithms of 1, 2, ...
    """
    n = len(logs)
    gene = np.minimum(np.searchsorted(edges, rng.random(n) * edges[-1], "right"), len(edges) - 1)
    order = np.argsort(gene.astype(np.uint16) if len(edges) <= 1 << 16 else gene, kind="stable")
    run = gene[order]
    first = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]]))
    nth = np.empty(n, np.int64)  # how many of its gene came before
    nth[order] = np.arange(n) - np.repeat(first, np.diff(np.concatenate([first, [n]])))
    return np.cumsum(logp[gene] + logs - logs[nth])


def ambient_test(counts: DataFrame, cands: DataFrame, profile: DataFrame, simulations: int = 10_000, seed: int = 1) -> DataFrame:
    """(cell, umis, loglik, p): multinomial log-likelihood against the profile, and (1 + simulations strictly below) / (1 + simulations).

    Each simulation is one barcode that grows through all totals, so the work is simulations x the largest total however many totals
    there are; tasks own blocks of simulations, and send on how many lie below each candidate. A simulation is drawn from a
    seed of its own, so reruns and other partitionings agree. Log-likelihoods that differ by a part in 10**9 are equal.

    The profile has a row for each gene, and `cands` one for each tested barcode (20,000 of `candidates`): both go to the workers. A gene
    of a candidate must be in the profile.
    """
    spark = counts.sparkSession
    ship(spark)
    share = np.array([r.p for r in profile.select("p").orderBy("gene").collect()])

    found = log_likelihoods(counts, cands, profile)
    cells = found.orderBy("umis", "cell").toPandas()
    if not len(cells):
        return spark.createDataFrame([], found.schema.add("p", "double"))
    total, bar = cells["umis"].to_numpy(), cells["loglik"].to_numpy()
    bar = bar - 1e-9 * np.abs(bar)
    largest = int(total.max())

    def grow(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        edges, logp, logs, lower = np.cumsum(share), np.log(share), np.log(np.arange(1, largest + 1)), np.zeros(len(total), np.int64)
        for frame in frames:
            for number in frame["id"]:
                lower += trajectory(np.random.default_rng([seed, int(number)]), edges, logp, logs)[total - 1] < bar
        yield pd.DataFrame({"at": np.flatnonzero(lower), "n": lower[lower > 0]})

    blocks = spark.range(0, simulations, 1, min(simulations, 4 * spark.sparkContext.defaultParallelism))
    lower = {r["at"]: r.n for r in blocks.mapInPandas(grow, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect()}
    cells["p"] = [(1 + lower.get(i, 0)) / (1 + simulations) for i in range(len(cells))]
    return spark.createDataFrame(cells, found.schema.add("p", "double"))
