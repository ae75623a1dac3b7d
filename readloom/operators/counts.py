"""Counting: details, counts, saturation, thresholds, ranks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..scratch import settle, tidy
from .ranking import PART, PLACE, in_ranges, ranked
from .spread import quantiles


def accept_reads(aln: DataFrame, unique_mapq: int = 255) -> DataFrame:
    """Alignments (qname, gene, mapq, exonic) -> (qname, gene): reads of exactly one gene that are unique or have several
    alignments; of several genes the single one with an exon hit, if there is just one."""
    genes = aln.groupBy("qname").agg(F.collect_set("gene").alias("genes"), F.collect_set(F.when(F.col("exonic"), F.col("gene"))).alias("exon"), F.count("*").alias("n"), F.max("mapq").alias("mapq"))
    one = (F.size("genes") == 1) & ((F.col("mapq") == unique_mapq) | (F.col("n") > 1))
    pick = F.when(one, F.element_at("genes", 1)).when((F.size("genes") > 1) & (F.size("exon") == 1), F.element_at("exon", 1))
    return genes.select("qname", pick.alias("gene")).where("gene is not null")


def detail(reads: DataFrame) -> DataFrame:
    """(cell, gene, umi) -> number of reads; UMIs of one repeated letter are dropped."""
    umi = F.col("umi")
    return reads.where(umi != F.repeat(F.substring(umi, 1, 1), F.length(umi))).groupBy("cell", "gene", "umi").agg(F.count("*").alias("num"))


def counts(det: DataFrame) -> DataFrame:
    """(cell, gene): UMIs and reads; the detail has one row per UMI, so no distinct count is needed."""
    return det.groupBy("cell", "gene").agg(F.count("*").alias("umis"), F.sum("num").alias("reads"))


def barcode_sums(c: DataFrame) -> DataFrame:
    return c.groupBy("cell").agg(F.sum("umis").alias("umis"), F.sum("reads").alias("reads"))


def saturation(c: DataFrame) -> DataFrame:
    """Over all barcodes, before any cell filter."""
    return c.agg(F.round(1 - F.try_divide(F.sum("umis"), F.sum("reads")), 9).alias("saturation"))


def median_int(col: str) -> Column:
    return F.coalesce(F.floor(F.median(col)), F.lit(0)).cast("long")


def cell_medians(c: DataFrame) -> DataFrame:
    per = c.groupBy("cell").agg(F.count("*").alias("genes"), F.sum("umis").alias("umis"))
    return per.agg(median_int("genes").alias("median_genes"), median_int("umis").alias("median_umis"), F.count("*").alias("cells"))


def n50(df: DataFrame, value: str, by: list[str] | None = None) -> DataFrame:
    """The first value, descending, at which the running sum reaches half of all; values are summed up per distinct value first."""
    keys = by or []
    per = df.groupBy(*keys, value).agg(F.count("*").alias("k"))
    down = Window.partitionBy(*keys).orderBy(F.desc(value))
    run = per.withColumn("run", F.sum(F.col(value) * F.col("k")).over(down)).withColumn("total", F.sum(F.col(value) * F.col("k")).over(Window.partitionBy(*keys)))
    return run.where(F.col("run") * 2 >= F.col("total")).groupBy(*keys).agg(F.max(value).alias("n50"))


@tidy
def downsample(det: DataFrame, steps: int = 10, seed: str = "s", cells: DataFrame | None = None) -> DataFrame:
    """(step, reads, saturation, median_genes): the first 1, 2, ... of `steps` equal parts of the reads, in a fixed pseudo-random order.

    Saturation is the percentage of reads that add no new (cell, gene, UMI), median_genes the median over cells with reads in
    the part. Only `cells` (cell) count, if given. The parts differ by one read at most: a read's place in the order is its hash. The hashes are
    counted in 65,536 ranges; of the few ranges that a boundary cuts all hashes are looked at, and the one at the boundary is its end. All prefixes come from
    one pass: the first part of each (cell, gene, UMI) and of each (cell, gene) tells where it counts.
    """
    d = det if cells is None else det.join(cells.select("cell").distinct(), "cell", "left_semi")
    d = settle(d.select("cell", "gene", "umi", "num"))  # reads are made of it three times, never written
    each = d.select("cell", "gene", "umi", F.explode(F.sequence(F.lit(1).cast("long"), "num")).alias("i"))
    each = each.select("cell", "gene", "umi", F.md5(F.concat_ws("|", F.lit(seed), "cell", "gene", "umi", F.col("i").cast("string"))).alias("key"))
    range_ = F.substring("key", 1, 4).alias("range")
    sizes = dict(each.groupBy(range_).agg(F.count("*").alias("k")).collect())  # 65,536 rows at most
    total, seen, first = sum(sizes.values()), 0, {}
    ends = [-(-total * k // steps) for k in range(1, steps)]  # reads before the end of part k
    for name in sorted(sizes):
        if any(seen < e < seen + sizes[name] for e in ends):
            first[name] = seen
        seen += sizes[name]
    cut = each.select("key", range_).where(F.col("range").isin(list(first))) if first else each.select("key", range_).where("false")
    place = F.row_number().over(Window.partitionBy("range").orderBy("key"))
    inner = {}
    if first:
        lead = F.create_map(*[F.lit(x) for kv in first.items() for x in kv])[F.col("range")]
        inner = {r.place: r.key for r in cut.withColumn("place", (lead + place).cast("long")).where(F.col("place").isin(ends)).select("place", "key").collect()}
    last, seen = {}, 0  # the largest key of the parts 1 to k: of a boundary between ranges the end of the range before
    for name in sorted(sizes):
        seen += sizes[name]
        last[seen] = name + "g"  # behind every key that begins so
    bounds = [inner.get(e, last.get(e, "")) for e in ends]
    step = F.lit(1).cast("long")
    for b in bounds:
        step = step + (F.col("key") > b).cast("long")
    placed = each.withColumn("step", step)
    tally = F.array(*[F.count_if(F.col("step") == k) for k in range(1, steps + 1)])
    umis = settle(placed.groupBy("cell", "gene", "umi").agg(F.min("step").alias("step"), tally.alias("n")))
    reads = umis.select(F.posexplode("n").alias("step", "n")).groupBy((F.col("step") + 1).cast("long").alias("step")).agg(F.sum("n").alias("n")).where("n > 0")
    new = umis.groupBy("step").agg(F.count("*").alias("d"))
    genes = umis.groupBy("cell", "gene").agg(F.min("step").alias("step")).groupBy("cell", "step").agg(F.count("*").alias("g"))
    grown = genes.groupBy("cell").agg(F.collect_list(F.struct("step", "g")).alias("s"))  # `steps` entries at most
    upto = lambda k: F.aggregate(F.filter("s", lambda x: x["step"] <= k), F.lit(0).cast("long"), lambda a, x: a + x["g"])
    medians = grown.select(F.explode(F.transform(F.sequence(F.lit(1), F.lit(steps)), lambda k: F.struct(k.cast("long").alias("step"), upto(k).alias("g")))).alias("x")).select("x.*").where("g > 0")
    medians = medians.groupBy("step").agg(F.floor(F.median("g")).cast("long").alias("median_genes"))
    run = Window.orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    both = reads.join(new, "step", "left").join(medians, "step", "left").withColumn("n", F.sum("n").over(run)).withColumn("d", F.sum(F.coalesce("d", F.lit(0))).over(run))
    return settle(both.select("step", F.col("n").alias("reads"), F.round((F.col("n") - F.col("d")) / F.col("n") * 100, 6).alias("saturation"), "median_genes"), keep=True)  # a row for each part


@tidy
def running(df: DataFrame, order: str, value: str, name: str) -> DataFrame:
    """Adds the sum of `value` over all rows before, in the order of a column without repeats: ranges of rows are summed first."""
    d = in_ranges(df, [order])
    per = d.groupBy(PART).agg(F.sum(value).alias("__s"))  # a row for each range
    per = per.select(PART, F.coalesce(F.sum("__s").over(Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__lead"))
    inside = F.coalesce(F.sum(value).over(Window.partitionBy(PART).orderBy(PLACE).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # the settled ranges must outlive this call: in_ranges keeps them one level up
    return d.withColumn(name, inside).join(F.broadcast(per), PART).withColumn(name, F.col(name) + F.col("__lead")).drop("__lead", PART, PLACE)


def barcode_reads(reads: DataFrame) -> DataFrame:
    """(cell, n): reads of each barcode, as many as its file of write_bam(by="cell") has records."""
    return reads.groupBy("cell").agg(F.count("*").alias("n"))


def top_barcodes(reads: DataFrame, limit: int = 12_000, skip: Column | None = None) -> DataFrame:
    """(cell, n): the barcodes with most reads, those of `skip` (first mates) not counted."""
    return barcode_reads(reads if skip is None else reads.where(~skip)).orderBy(F.desc("n"), "cell").limit(limit)


def with_barcode(reads: DataFrame, missing: str = "missing_barcode", cell: str = "cell") -> DataFrame:
    """The reads that have a barcode."""
    return reads.where(F.col(cell) != missing)


def barcode_distinct(reads: DataFrame, missing: str = "missing_barcode") -> DataFrame:
    """(cell, umis, reads): distinct UMIs and reads of each barcode, most reads first; reads without a barcode are left out."""
    per = with_barcode(reads, missing).groupBy("cell", "umi").agg(F.count("*").alias("n")).groupBy("cell")
    return per.agg(F.count("umi").alias("umis"), F.sum("n").alias("reads")).orderBy(F.desc("reads"), "cell")


def quantile_steps(df: DataFrame, by: str, value: str, steps: int = 20) -> DataFrame:
    """(by, pct, value): quantiles in equal steps from the least to the largest value, linear between rows."""
    d = quantiles(df, by, value, [i / steps for i in range(steps + 1)])
    return d.select(by, (F.col("i") * (100 // steps)).alias("pct"), F.round("value", 6).alias("value"))


def barcode_rank(sums: DataFrame, cells: DataFrame) -> DataFrame:
    """rank from 0 by UMIs, cells first among equals, then by name."""
    flagged = sums.join(cells.withColumn("is_cell", F.lit(True)), "cell", "left").withColumn("is_cell", F.coalesce("is_cell", F.lit(False)))
    return ranked(flagged, "umis", [F.desc("is_cell"), "cell"], "idx").withColumn("idx", F.col("idx") - 1)


def rank_segments(ranked: DataFrame, first: int = 1000, factor: int = 4, last: int | None = None) -> DataFrame:
    """Blocks of the rank curve: the leading one up to the first background barcode after the first cell, mixed blocks
    of first * factor**n ranks, and the background behind the last cell; each with its cells and barcodes. Mixed block number `last`
    takes all ranks from its first one on; without it blocks grow as long as there are cells."""
    c, i = F.col("is_cell"), F.col("idx")
    lead_cell = ranked.agg(F.min(F.when(c, i)).alias("c0"), F.max(F.when(c, i)).alias("last")).withColumn("k", F.lit(1))
    with_c = ranked.withColumn("k", F.lit(1)).join(F.broadcast(lead_cell), "k")
    start = with_c.where(~c & (i > F.col("c0"))).groupBy("k").agg(F.min("idx").alias("start"))
    d = with_c.join(F.broadcast(start), "k", "left").withColumn("start", F.coalesce("start", F.col("last") + 1))
    off = (i - F.col("start")).cast("double")
    block = F.floor(F.log(float(factor), off * (factor - 1) / first + 1) + 1e-9)
    block = block if last is None else F.least(block, F.lit(last))
    name = F.when(F.col("c0").isNull(), "background").when(i < F.col("start"), "leading").when(i > F.col("last"), "background").otherwise(F.concat(F.lit("mixed"), block.cast("string")))
    return d.withColumn("segment", name).groupBy("segment").agg(F.min("idx").cast("long").alias("first_rank"), F.count("*").alias("barcodes"), F.count_if("is_cell").alias("cells"))
