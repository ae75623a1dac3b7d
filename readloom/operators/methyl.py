"""Methylation matrices."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..shipping import ship
from .intervals import stab
from .ranking import PART, PLACE, in_ranges


def position_key(ref: str, pos: str) -> Column:
    """The stand-in UMI of a read without one: its chromosome and hundred-base bin."""
    return F.concat_ws("_", F.col(ref), F.floor((F.col(pos) + 1) / 100).cast("string"))


def pileup(allc: DataFrame) -> DataFrame:
    """Calls (cell, chrom, pos, strand, context, mc, cov) added up per site."""
    return allc.groupBy("cell", "chrom", "pos", "strand", "context").agg(F.sum("mc").alias("mc"), F.sum("cov").alias("cov"))


def is_cpg(context: str = "context") -> Column:
    return F.col(context).startswith("CG")


def bins(allc: DataFrame, width: int, cpg: bool = True) -> DataFrame:
    """(cell, chrom, bin, mc, cov) over bins of `width` positions from 1."""
    d = allc.where(is_cpg()) if cpg else allc
    return d.groupBy("cell", "chrom", F.floor((F.col("pos") - 1) / width).alias("bin")).agg(F.sum("mc").alias("mc"), F.sum("cov").alias("cov"))


def region_counts(allc: DataFrame, regions: DataFrame, width: int = 1 << 14, cpg: bool = True) -> DataFrame:
    """(cell, region, mc, cov) over named regions (chrom, start, end, name), from 0 and half-open; a site in several regions counts in each.

    Positions, once for all cells, meet equal regions, once for all of them, by an equality join on (chrom, bin): that counts how many regions of a name
    hold a position. Sites are added up over cells' repeated rows and meet a row for each name of their position.
    """
    d = allc.where(is_cpg()) if cpg else allc
    d = d.select("cell", "chrom", (F.col("pos") - 1).alias("pos"), "mc", "cov")
    named = regions.select("chrom", "start", "end", F.col("name").alias("region")).where("start < end").groupBy("chrom", "start", "end", "region").agg(F.count("*").alias("n"))
    held = stab(d.select("chrom", "pos").distinct(), named, width).groupBy("chrom", "pos", "region").agg(F.sum("n").alias("n"))
    sites = d.groupBy("cell", "chrom", "pos").agg(F.sum("mc").alias("mc"), F.sum("cov").alias("cov"))
    hit = sites.join(held, ["chrom", "pos"])
    return hit.groupBy("cell", "region").agg(F.sum(F.col("mc") * F.col("n")).alias("mc"), F.sum(F.col("cov") * F.col("n")).alias("cov"))


def cpg_counts(allc: DataFrame) -> DataFrame:
    """(cell, cpg, lines): sites in CpG context, and all."""
    return allc.groupBy("cell").agg(F.count_if(is_cpg()).alias("cpg"), F.count("*").alias("lines"))


def cpg_bed(allc: DataFrame) -> DataFrame:
    """(chrom, start, end), from 0 and half-open, of each CpG site."""
    return allc.where(is_cpg()).select("chrom", (F.col("pos") - 1).alias("start"), F.col("pos").alias("end")).distinct()


def mean_rate(allc: DataFrame, by: str) -> DataFrame:
    """(by, mean_mc): mean over sites of mc / cov; sites without reads are left out."""
    return allc.groupBy(by).agg(F.round(F.avg(F.try_divide("mc", "cov")), 9).alias("mean_mc"))


def position_counts(aln: DataFrame, order: list[str] = ("nth",), ref: str = "ref", pos: str = "pos", gene: str = "gene") -> DataFrame:
    """(cell, gene, umis, reads) of reads without UMI: the first alignment of each (cell, qname), its position bin as UMI. A gene of several names is
    skipped, none counts as its own position bin."""
    first = aln.groupBy("qname").agg(F.min_by(F.struct("cell", gene, ref, pos), F.struct(*order)).alias("f")).select("f.*")
    key = position_key(ref, pos)
    d = first.where(F.col(gene).isNull() | ~F.col(gene).contains(",")).select("cell", F.coalesce(gene, key).alias("gene"), key.alias("umi"))
    return d.groupBy("cell", "gene", "umi").agg(F.count("*").alias("num")).groupBy("cell", "gene").agg(F.count("*").alias("umis"), F.sum("num").alias("reads"))


def covered_features(df: DataFrame, cells: DataFrame, least: float = 0.0) -> DataFrame:
    """Rows (cell, chrom, bin, mc, cov) of bins whose mean coverage over all cells, those without reads included, is above `least`."""
    n = cells.agg(F.count("*").alias("n"))  # one row
    good = df.groupBy("chrom", "bin").agg(F.sum("cov").alias("c")).crossJoin(F.broadcast(n)).where(F.col("c") / F.col("n") > least).select("chrom", "bin")
    return df.join(good, ["chrom", "bin"], "left_semi")


def hypo_score(df: DataFrame, cell: list[str], cutoff: float = 0.9) -> DataFrame:
    """Adds score: the chance of more than mc methylated reads of cov at the cell's mean rate; below the cutoff 0."""
    ship(df.sparkSession)
    w = Window.partitionBy(*cell)
    df = df.withColumn("rate", F.sum("mc").over(w) / F.sum("cov").over(w))

    @F.pandas_udf("double")
    def tail(mc: pd.Series, cov: pd.Series, rate: pd.Series) -> pd.Series:
        lg = np.vectorize(math.lgamma)
        out = np.zeros(len(mc))
        for (c, p), at in pd.DataFrame({"c": cov, "p": rate}).groupby(["c", "p"]).indices.items():
            k = np.arange(int(c) + 1)
            logs = lg(c + 1.0) - lg(k + 1.0) - lg(c - k + 1.0) + k * math.log(max(p, 1e-300)) + (c - k) * math.log(max(1 - p, 1e-300))
            above = np.concatenate([np.cumsum(np.exp(logs)[::-1])[::-1][1:], [0.0]])
            out[at] = above[np.minimum(mc.to_numpy()[at].astype(int), int(c))]
        return pd.Series(out)

    return df.withColumn("score", tail("mc", "cov", "rate")).withColumn("score", F.when(F.col("score") >= cutoff, F.col("score")).otherwise(0.0)).drop("rate")


def methyl_fractions(df: DataFrame) -> DataFrame:
    """(cell, chrom, bin, mc, cov) -> the same with f: the bin's methylated fraction over the cell's mean, at most 10.

    The fraction is the posterior mean under a beta prior with mean and variance of the cell's own bins, so it is
    never 0 where the cell has any methylation and its logarithm is finite. The prior weighs one read at least; a
    cell whose bins do not differ has 1 everywhere.
    """
    raw = F.col("mc") / F.col("cov")
    df = df.where("cov > 0")
    prior = df.groupBy("cell").agg(F.avg(raw).alias("m"), F.var_pop(raw).alias("v"))
    size = F.greatest(F.col("m") * (1 - F.col("m")) / F.col("v") - 1, F.lit(1.0))
    f = F.least(F.lit(10.0), (F.col("mc") + F.col("m") * size) / (F.col("cov") + size) / F.col("m"))
    return df.join(prior, "cell").withColumn("f", F.when((F.col("v") > 1e-12) & (F.col("m") > 0), f).otherwise(1.0)).drop("m", "v")


def variable_features(frac: DataFrame, cells: int, top: int) -> list[tuple]:
    """(chrom, bin, scale) of the `top` bins whose dispersion over all cells lies highest above its trend, sorted.

    Dispersion is deviation over mean, its trend a quadratic in the logarithms of mean and coverage. scale is the
    deviation of log f. A bin without reads in a cell counts as 1. The trend is solved from sums over all bins; the driver gets
    these sums and the `top` rows.
    """
    log, n = F.log("f"), F.lit(float(cells))
    sums = frac.groupBy("chrom", "bin").agg(F.sum("f").alias("f"), F.sum(F.col("f") * F.col("f")).alias("ff"), F.count("*").alias("n"), F.sum("cov").alias("cov"), F.sum(log).alias("g"), F.sum(log * log).alias("gg"))
    mean = (F.col("f") + n - F.col("n")) / n
    scale = F.sqrt(F.greatest(F.col("gg") / n - F.pow(F.col("g") / n, F.lit(2.0)), F.lit(0.0)))
    sd = F.sqrt(F.greatest((F.col("ff") + n - F.col("n")) / n - mean * mean, F.lit(0.0)))
    rows = sums.select("chrom", "bin", F.when(scale < 1e-9, 1.0).otherwise(scale).alias("scale"), F.log2(mean).alias("x"), F.log2(F.col("cov") / n).alias("y"), F.log2(F.greatest(sd / mean, F.lit(1e-9))).alias("spread"))
    if rows.count() > top:
        x, y, spread = F.col("x"), F.col("y"), F.col("spread")
        terms = [F.lit(1.0), x, y, x * x, x * y, y * y]
        k = len(terms)
        # all sums of products of two terms, and of a term with the dispersion
        moments = rows.agg(*[F.sum(terms[i] * terms[j]) for i in range(k) for j in range(k)], *[F.sum(t * spread) for t in terms]).first()
        fit = np.linalg.lstsq(np.array(moments[: k * k], float).reshape(k, k), np.array(moments[k * k :], float), rcond=None)[0]
        above = spread - sum((F.lit(float(c)) * t for c, t in zip(fit, terms)), F.lit(0.0))
        rows = rows.orderBy(F.desc(above), "chrom", "bin").limit(top)
    return sorted((r.chrom, r.bin, r.scale) for r in rows.select("chrom", "bin", "scale").collect())


def methyl_matrix(df: DataFrame, cells: DataFrame, top: int = 2500) -> DataFrame:
    """(cell, features) for each of `cells`: log of the normalised fraction of each variable bin over its deviation, within 10.

    `df` has (cell, chrom, bin, mc, cov); the bins are those that occur in it. A bin without reads is at the mean: 0.
    """
    ship(df.sparkSession)
    frac = methyl_fractions(df)
    bins = variable_features(frac, cells.count(), top)
    spark = df.sparkSession
    at = spark.createDataFrame([(c, b, i, s) for i, (c, b, s) in enumerate(bins)], "chrom string, bin long, i int, scale double")
    x = F.greatest(F.lit(-10.0), F.least(F.lit(10.0), F.log("f") / F.col("scale")))
    per = frac.join(F.broadcast(at), ["chrom", "bin"]).groupBy("cell").agg(F.collect_list(F.struct("i", x.alias("x"))).alias("m"))
    wide = len(bins)

    @F.pandas_udf("array<double>")
    def dense(i: pd.Series, x: pd.Series) -> pd.Series:
        out = []
        for where, what in zip(i, x):
            row = np.zeros(wide)
            if where is not None:
                row[where] = what
            out.append(row)
        return pd.Series(out)

    field = lambda name: F.transform("m", lambda y: y[name])
    return cells.join(per, "cell", "left").select("cell", dense(field("i"), field("x")).alias("features"))


def principal_components(df: DataFrame, key: str, features: str, k: int) -> DataFrame:
    vec = df.select(key, array_to_vector(F.transform(features, lambda x: x.cast("double"))).alias("v"))
    model = PCA(k=k, inputCol="v", outputCol="p").fit(vec)
    return model.transform(vec).select(key, vector_to_array("p").alias("components"))


def component_gaps(scores: DataFrame, key: str, components: str = "components") -> DataFrame:
    """(i, d, p): for each component but the last the largest distance d between the distributions of its scores and of the next one's, and the p of
    two equal ones (two-sample Kolmogorov-Smirnov, asymptotic).

    Scores of neighbours are merged in one order, each pair's in ranges over all tasks: running differences need no task that holds a component.
    """
    long = scores.select(F.posexplode(components).alias("i", "x"))
    n = scores.count()
    last = F.size(components) - 1
    wide = scores.select(last.alias("k")).agg(F.max("k")).first()[0] or 0
    up = long.where(F.col("i") < wide).select("i", "x", F.lit(1).alias("d"))
    down = long.where(F.col("i") > 0).select((F.col("i") - 1).alias("i"), "x", F.lit(-1).alias("d"))
    steps = up.unionByName(down).groupBy("i", "x").agg(F.sum("d").alias("d"))
    placed = in_ranges(steps, ["i", "x"])
    per = placed.groupBy("i", PART).agg(F.sum("d").alias("s"))
    before = Window.partitionBy("i").orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)  # a row for each range that a pair touches
    per = per.select("i", PART, F.coalesce(F.sum("s").over(before), F.lit(0)).alias("lead"))
    inside = Window.partitionBy("i", PART).orderBy(PLACE).rowsBetween(Window.unboundedPreceding, 0)
    run = placed.withColumn("run", F.sum("d").over(inside)).join(F.broadcast(per), ["i", PART])
    gap = run.groupBy("i").agg((F.max(F.abs(F.col("run") + F.col("lead"))) / n).alias("d"))
    # Kolmogorov's series, which settles within a few terms; below 0.2 it is 1 to all digits
    t = F.col("d") * float(np.sqrt(n / 2))
    tail = sum((F.lit(2.0 * (-1) ** (k + 1)) * F.exp(-2.0 * k * k * t * t) for k in range(1, 101)), F.lit(0.0))
    return gap.select("i", "d", F.when(t < 0.2, 1.0).otherwise(F.greatest(F.least(tail, F.lit(1.0)), F.lit(0.0))).alias("p"))


def significant_components(scores: DataFrame, key: str, cutoff: float = 0.1, components: str = "components") -> tuple[int, DataFrame]:
    """How many components there are up to the first whose scores are distributed as the next one's (p above the cutoff; without one all but the last), and
    (key, components) of these over the deviation that all their scores have together."""
    gaps = sorted(tuple(r) for r in component_gaps(scores, key, components).select("i", "p").collect())  # a row for each component
    n = max(next((i + 1 for i, p in gaps if p > cutoff), len(gaps)), 1)
    some = scores.select(key, F.slice(components, 1, n).alias(components))
    sd = some.select(F.explode(components).alias("x")).agg(F.stddev_pop("x")).first()[0] or 1.0
    return n, some.select(key, F.transform(components, lambda x: x / sd).alias(components))
