"""Marker tables and neighbours."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..shipping import ship


def top_markers(df: DataFrame, by: str, order: list, n: int) -> DataFrame:
    return df.withColumn("r", F.row_number().over(Window.partitionBy(by).orderBy(*order))).where(F.col("r") <= n).drop("r")


def marker_table(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """(gene, cluster): shares of cells with the gene inside and outside of the cluster, and the log2 ratio of mean norm values.

    Sums per gene and in all give the outside by subtraction, so no cell is joined to the clusters it is not in.
    """
    norm = counts.withColumn("x", 10000 * F.col("umis") / F.sum("umis").over(Window.partitionBy("cell"))).join(groups, "cell")
    size = groups.groupBy("cluster").agg(F.count("*").alias("cells"))
    per = norm.groupBy("gene", "cluster").agg(F.count("*").alias("with"), F.sum("x").alias("sum"))
    w = Window.partitionBy("gene")
    all_cells = size.agg(F.sum("cells").alias("all")).withColumn("k", F.lit(1))
    d = per.withColumn("w_all", F.sum("with").over(w)).withColumn("s_all", F.sum("sum").over(w)).join(F.broadcast(size), "cluster").withColumn("k", F.lit(1)).join(F.broadcast(all_cells), "k")
    out = F.col("all") - F.col("cells")
    ratio = F.log2((F.col("sum") / F.col("cells") + 1) / (F.try_divide(F.col("s_all") - F.col("sum"), out) + 1))
    return d.select("gene", "cluster", F.round(F.col("with") / F.col("cells"), 6).alias("pct_1"), F.round(F.try_divide(F.col("w_all") - F.col("with"), out), 6).alias("pct_2"), F.round(ratio, 6).alias("log2_fc"))


def knn(queries: DataFrame, rows: DataFrame, key: str, vec: str, k: int, block: int = 2000) -> DataFrame:
    """The k rows nearest (Euclidean) to each query, itself left out; ties by key.

    Queries and rows meet in blocks: a task holds one block of each and keeps k rows per query, whose best k
    over all blocks are the answer.
    """
    ship(rows.sparkSession)
    nq = max(1, -(-queries.count() // block))
    nr = max(1, -(-rows.count() // (10 * block)))
    q = queries.select(F.col(key).alias("id"), F.col(vec).alias("v"), F.lit(True).alias("ask"), F.pmod(F.xxhash64(key), F.lit(nq).cast("long")).alias("i"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(nr - 1).cast("long"))).alias("j"))
    r = rows.select(F.col(key).alias("id"), F.col(vec).alias("v"), F.lit(False).alias("ask"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(nq - 1).cast("long"))).alias("i"), F.pmod(F.xxhash64(key), F.lit(nr).cast("long")).alias("j"))

    def near(df: pd.DataFrame) -> pd.DataFrame:
        a, b = df[df["ask"]], df[~df["ask"]].sort_values("id")
        if not len(a) or not len(b):
            return pd.DataFrame({key: [], "neighbour": [], "distance": []})
        x, y, ids = np.array(a["v"].tolist(), float), np.array(b["v"].tolist(), float), b["id"].to_numpy()
        out = []
        for one, v in zip(a["id"], x):
            d = np.round(np.sqrt(((y - v) ** 2).sum(1)), 6)
            at = np.argsort(d, kind="stable")[: k + 1]
            at = at[ids[at] != one][:k]
            out.append((np.full(len(at), one), ids[at], d[at]))
        return pd.DataFrame(dict(zip((key, "neighbour", "distance"), map(np.concatenate, zip(*out)))))

    found = q.unionByName(r).groupBy("i", "j").applyInPandas(near, f"{key} long, neighbour long, distance double")
    w = Window.partitionBy(key).orderBy("distance", "neighbour")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def variable_genes(counts: DataFrame, n: int) -> DataFrame:
    """The n genes of the largest dispersion (variance over mean) of log-normalised values, cells without the gene counted as 0."""
    norm = counts.withColumn("x", F.log1p(10000 * F.col("umis") / F.sum("umis").over(Window.partitionBy("cell"))))
    cells = counts.select("cell").distinct().agg(F.count("*").alias("cells")).withColumn("k", F.lit(1))
    per = norm.groupBy("gene").agg(F.sum("x").alias("s"), F.sum(F.col("x") * F.col("x")).alias("q")).withColumn("k", F.lit(1)).join(F.broadcast(cells), "k")
    mean = F.col("s") / F.col("cells")
    var = (F.col("q") - F.col("s") * mean) / F.greatest(F.col("cells") - 1, F.lit(1))
    return per.select("gene", F.round(var / mean, 6).alias("dispersion")).orderBy(F.desc("dispersion"), "gene").limit(n)


def rank_sums(counts: DataFrame, groups: DataFrame, value: str = "umis") -> DataFrame:
    """(gene, cluster, above, sd): the rank sum of a cluster's cells against all others, less its mean, and its deviation with tie correction.

    A cell without the gene has 0, which lies below all values: these ties are counted, not listed. Ranks come from counts per distinct value.
    """
    size = groups.groupBy("cluster").agg(F.count("*").cast("double").alias("n1"))
    total = size.agg(F.sum("n1").alias("n")).withColumn("k", F.lit(1))
    per = counts.join(groups, "cell").groupBy("gene", F.col(value).alias("x"), "cluster").agg(F.count("*").alias("c"))
    ranked = per.groupBy("gene", "x").agg(F.sum("c").alias("m")).withColumn("k", F.lit(1)).join(F.broadcast(total), "k")
    w = Window.partitionBy("gene")
    ranked = ranked.withColumn("zero", F.col("n") - F.sum("m").over(w))
    below = F.col("zero") + F.coalesce(F.sum("m").over(w.orderBy("x").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = ranked.withColumn("rank", below + (F.col("m") + 1) / 2).withColumn("ties", F.sum(F.pow("m", F.lit(3)) - F.col("m")).over(w) + F.pow("zero", F.lit(3)) - F.col("zero"))
    got = per.join(ranked.select("gene", "x", "rank", "ties", "zero", "n"), ["gene", "x"]).groupBy("gene", "cluster").agg(F.sum(F.col("c") * F.col("rank")).alias("r"), F.sum("c").alias("seen"), F.max("ties").alias("ties"), F.max("zero").alias("zero"), F.max("n").alias("n"))
    got = got.join(F.broadcast(size), "cluster")
    r = F.col("r") + (F.col("n1") - F.col("seen")) * (F.col("zero") + 1) / 2
    n, n1 = F.col("n"), F.col("n1")
    n2 = n - n1
    sd = F.sqrt(n1 * n2 / 12 * (n + 1 - F.col("ties") / (n * (n - 1))))
    return got.select("gene", "cluster", (r - n1 * (n + 1) / 2).alias("above"), sd.alias("sd"))


def rank_test(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """(gene, cluster, z): rank-sum test of the UMIs of a cluster's cells against all others (see rank_sums), without continuity correction."""
    return rank_sums(counts, groups).select("gene", "cluster", F.round(F.try_divide("above", "sd"), 6).alias("z"))


def log_tail(z: np.ndarray) -> np.ndarray:
    """log of the chance that a normal variate exceeds z >= 0: without underflow, to some parts in 10**13."""
    z = np.asarray(z, float)
    out = np.empty_like(z)
    near = z < 20
    out[near] = [math.log(math.erfc(x / math.sqrt(2)) / 2) for x in z[near]]
    far = z[~near]
    term, series = np.ones_like(far), np.ones_like(far)
    for k in range(1, 12):  # the terms still fall at z = 20
        term = term * -(2 * k - 1) / far**2
        series += term
    out[~near] = -far * far / 2 - 0.5 * math.log(2 * math.pi) - np.log(far) + np.log(series)
    return out


def p_values(df: DataFrame, genes: int, z: str = "z") -> DataFrame:
    """Adds log_p, p_val, log_p_adj and p_val_adj: two-sided normal p of z, and that times the number of genes, 1 at most. The logarithms are exact where p underflows."""
    ship(df.sparkSession)

    @F.pandas_udf("double")
    def log_p(x: pd.Series) -> pd.Series:
        known = x.notna()
        out = pd.Series(np.full(len(x), np.nan))
        out[known.to_numpy()] = np.minimum(math.log(2) + log_tail(np.abs(x[known].to_numpy())), 0.0)
        return out.astype(object).where(known.to_numpy(), None)

    d = df.withColumn("log_p", log_p(z))
    d = d.withColumn("log_p_adj", F.least(F.col("log_p") + F.log(F.lit(float(max(genes, 1)))), F.lit(0.0)))
    return d.withColumn("p_val", F.exp("log_p")).withColumn("p_val_adj", F.exp("log_p_adj"))


def find_markers(counts: DataFrame, groups: DataFrame, least_share: float = 0.1, least_change: float = 0.25, positive: bool = True, keep: float = 0.01, genes: int | None = None) -> DataFrame:
    """(cluster, gene, pct_1, pct_2, log2_fc, z, log_p, p_val, log_p_adj, p_val_adj): the markers of each cluster against all other cells.

    Tested are genes that a share of the cells of one side has and whose mean changes enough (rises, if positive); z is the rank-sum test of log-normalised
    values with tie and continuity correction, p is two-sided, adjusted over all `genes` (default: those in counts). Rows with p below `keep`
    stay, best first within a cluster; sorted by cluster, p, then change.
    """
    norm = counts.withColumn("x", F.log1p(10000 * F.col("umis") / F.sum("umis").over(Window.partitionBy("cell"))))
    sums = rank_sums(norm, groups, "x")
    above = F.col("above")
    z = F.try_divide(above - F.signum(above) * 0.5, F.col("sd"))
    z = F.when(F.abs(above) <= 0.5, F.lit(0.0)).otherwise(z)
    change = F.col("log2_fc") if positive else F.abs("log2_fc")
    table = marker_table(counts, groups).where((F.greatest("pct_1", F.coalesce("pct_2", F.lit(0.0))) >= least_share) & (change >= least_change))
    n = counts.select("gene").distinct().count() if genes is None else genes
    d = p_values(table.join(sums.select("gene", "cluster", z.alias("z")), ["gene", "cluster"]), n)
    order = ["cluster", F.asc("log_p"), F.desc("log2_fc"), F.desc("pct_1"), "gene"]
    return d.where(F.col("p_val") < keep).select("cluster", "gene", "pct_1", "pct_2", "log2_fc", "z", "log_p", "p_val", "log_p_adj", "p_val_adj").orderBy(*order)
