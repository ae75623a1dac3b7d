"""Interval joins and depth by bins and sweep lines; intervals are half-open, zero length counts as one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.bam import coordinate_order
from .ranking import ordinals


def binned(iv: DataFrame, width: int, start: str = "start", end: str = "end") -> DataFrame:
    """A row for each bin that an interval touches."""
    last = F.greatest(F.col(end), F.col(start) + 1) - 1
    return iv.withColumn("bin", F.explode(F.sequence(F.floor(F.col(start) / width), F.floor(last / width))))


def stab(points: DataFrame, iv: DataFrame, width: int) -> DataFrame:
    """Points (chrom, pos, ...) joined to the intervals (chrom, start, end, ...) that hold them: an equality join on (chrom, bin)."""
    p = points.withColumn("bin", F.floor(F.col("pos") / width))
    return p.join(binned(iv, width), ["chrom", "bin"]).where((F.col("pos") >= F.col("start")) & (F.col("pos") < F.greatest(F.col("end"), F.col("start") + 1))).drop("bin")


def overlap(a: DataFrame, b: DataFrame, width: int, share: float) -> DataFrame:
    """Pairs of a (chrom, a_start, a_end, ...) and b (chrom, start, end, ...) that share at least `share` of a; all of several."""
    cut = F.least("a_end", "end") - F.greatest("a_start", "start")
    pairs = binned(a, width, "a_start", "a_end").join(binned(b, width), ["chrom", "bin"])
    # a pair that meets in several bins counts in the first of them
    first = F.col("bin") == F.floor(F.greatest("a_start", "start") / width)
    return pairs.where(first & (cut > 0) & (cut >= share * (F.col("a_end") - F.col("a_start")))).withColumn("shared", cut).drop("bin")


def depth_segments(iv: DataFrame, stretch: int = 1 << 20) -> DataFrame:
    """(chrom, start, end, depth): a sweep over +1/-1 events, summed per position before the running sum.

    A chromosome is swept in stretches of so many positions, each by a task of its own: sums per stretch give the depth at
    its start, and where it ends is where the next one that has events begins.
    """
    events = iv.select("chrom", F.explode(F.array(F.struct(F.col("start").alias("pos"), F.lit(1).alias("d")), F.struct(F.col("end").alias("pos"), F.lit(-1).alias("d")))).alias("e"))
    net = events.groupBy("chrom", F.col("e.pos").alias("pos")).agg(F.sum("e.d").alias("d")).withColumn("part", F.floor(F.col("pos") / stretch))
    along = Window.partitionBy("chrom").orderBy("part")
    parts = net.groupBy("chrom", "part").agg(F.sum("d").alias("s"), F.min("pos").alias("first"))
    parts = parts.select("chrom", "part", F.coalesce(F.sum("s").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("lead"), F.lead("first").over(along).alias("next"))
    w = Window.partitionBy("chrom", "part").orderBy("pos")
    inside = net.withColumn("run", F.sum("d").over(w.rowsBetween(Window.unboundedPreceding, 0))).withColumn("stop", F.lead("pos").over(w))
    swept = inside.join(parts, ["chrom", "part"])
    swept = swept.select("chrom", F.col("pos").alias("start"), F.coalesce("stop", "next").alias("end"), (F.col("run") + F.col("lead")).alias("depth"))
    return swept.where("end is not null")


def depth_histogram(iv: DataFrame, sizes: DataFrame) -> DataFrame:
    """(chrom, depth, bases, size); depth 0 is what the chromosome has beyond the covered bases."""
    seen = depth_segments(iv).where("depth > 0").groupBy("chrom", "depth").agg(F.sum(F.col("end") - F.col("start")).alias("bases"))
    rest = sizes.join(seen.groupBy("chrom").agg(F.sum("bases").alias("b")), "chrom", "left").select("chrom", F.lit(0).cast("long").alias("depth"), (F.col("size") - F.coalesce("b", F.lit(0))).alias("bases"))
    return seen.select("chrom", "depth", "bases").unionByName(rest).join(sizes, "chrom")


def coverage(hist: DataFrame) -> DataFrame:
    """Shares of the genome at 1, 2, 4 and 10 fold; `genome` summary rows are left out."""
    per = hist.where("chrom != 'genome'").groupBy("chrom").agg(F.max("size").alias("size"), *[F.sum(F.when(F.col("depth") >= k, F.col("bases")).otherwise(0)).alias(f"b{k}") for k in (1, 2, 4, 10)])
    return per.agg(*[F.round(F.sum(f"b{k}") / F.sum("size"), 9).alias(f"coverage_{k}x") for k in (1, 2, 4, 10)])


def tail_share(depth: DataFrame, share: float = 0.2) -> DataFrame:
    """(ref, share): how many of a reference's positions (ref, pos, depth) are deeper than `share` of its mean depth."""
    mean = depth.groupBy("ref").agg(F.avg("depth").alias("mean"))  # a row for each reference
    return depth.join(F.broadcast(mean), "ref").groupBy("ref").agg(F.round(F.avg((F.col("depth") > share * F.col("mean")).cast("double")), 9).alias("share"))


def middle_share(curve: DataFrame, first: int = 24, last: int = 75) -> DataFrame:
    """(i, v) along a gene body -> (i, curve, middle): v over its sum, and the share of positions first to last, both included."""
    w = Window.partitionBy()  # a row for each percentile
    share = F.sum(F.when(F.col("i").between(first, last), F.col("v")).otherwise(0.0)).over(w) / F.sum("v").over(w)
    return curve.select("i", F.round(F.col("v") / F.sum("v").over(w), 9).alias("curve"), F.round(share, 9).alias("middle"))


def deduplicated(aln: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """Of alignments equal in `by` (cell, reference, position, strand) the first in `order`."""
    first = F.min(F.struct(*order)).alias("__first")
    keep = aln.groupBy(*by).agg(first).select(*by, "__first.*")
    return aln.join(keep, [*by, *order], "left_semi")


def region_kinds(aln: DataFrame, features: DataFrame, width: int = 1 << 14, order: tuple[str, ...] = ("exon", "intron")) -> DataFrame:
    """Alignments (qname, chrom, pos, ...) with kind: the first of `order` among the features (chrom, start, end, feature) at the position, else intergenic."""
    rank = F.coalesce(*[F.when(F.col("feature") == k, F.lit(i)) for i, k in enumerate(order)], F.lit(len(order)))
    hit = stab(aln.select("chrom", "pos").distinct(), features.select("chrom", "start", "end", "feature"), width)
    best = hit.groupBy("chrom", "pos").agg(F.min(rank).alias("__r"))
    name = F.when(F.col("__r").isNull() | (F.col("__r") == len(order)), "intergenic").otherwise(F.element_at(F.array(*[F.lit(k) for k in order]), F.least(F.col("__r"), F.lit(len(order) - 1)) + 1))
    return aln.join(best, ["chrom", "pos"], "left").withColumn("kind", name).drop("__r")


def kind_shares(df: DataFrame, kinds: list[str], kind: str = "kind") -> DataFrame:
    """One row with the share of each kind."""
    return df.agg(*[F.round(F.count_if(F.col(kind) == k) / F.count("*"), 9).alias(k) for k in kinds])


def split_plan(lengths: DataFrame, iv: DataFrame, chunk: int = 1 << 29, step: int = 1000, tries: int = 10_000, partial: bool = False) -> DataFrame:
    """(chrom, pos): where chromosomes (chrom, length) longer than `chunk` are cut so that no interval (chrom, start, end) is.

    From the last cut (or 0) a chunk further on, and from there back in steps until no interval holds the point; again while more than a
    chunk is left behind the cut. A cut lies behind the one before. Raises an error where `tries` steps find none, or with `partial`
    leaves the rest of that chromosome whole. Chromosomes that long are few: the loop is over cuts, and each round asks of all chromosomes at once.
    """
    spark = lengths.sparkSession
    todo = {r.chrom: (0, r.length) for r in lengths.where(F.col("length") > chunk).select("chrom", "length").collect()}  # a handful
    if not todo:
        return spark.createDataFrame([], "chrom string, pos long")
    iv = iv.where(F.col("chrom").isin(list(todo)))
    cuts: list[tuple[str, int]] = []
    while todo:
        asked = [(c, start, 0) for c, (start, _) in todo.items()]
        points = spark.createDataFrame(asked, "chrom string, from long, none int").select("chrom", "from")
        # all candidates of a search at once: chunk, chunk - step, ...; the first free one counts
        tried = points.select("chrom", "from", F.posexplode(F.sequence(F.lit(0), F.lit(min(tries, (chunk - 1) // step)))).alias("nth", "x"))
        tried = tried.select("chrom", "nth", (F.col("from") + chunk - F.col("nth") * step).cast("long").alias("pos"))
        free = split_points(tried, iv, max(step * 16, 1)).groupBy("chrom").agg(F.min_by("pos", "nth").alias("pos"))
        found = {r.chrom: r.pos for r in free.collect()}
        if set(found) != set(todo) and not partial:
            raise ValueError(f"no split point within {tries} steps: {sorted(set(todo) - set(found))}")
        cuts += sorted(found.items())
        todo = {c: (found[c], n) for c, (_, n) in todo.items() if c in found and n - found[c] > chunk}
    return spark.createDataFrame(cuts, "chrom string, pos long")


def split_shift(records: DataFrame, cuts: DataFrame, chrom: str = "chrom", start: str = "start", end: str = "end") -> DataFrame:
    """Records on the parts that split_plan makes of their chromosomes: <chrom>_s<cuts at or before the end>, positions counted from the last of these."""
    at = cuts.groupBy(F.col("chrom").alias("__c")).agg(F.sort_array(F.collect_list("pos")).alias("__cuts"))
    d = records.join(F.broadcast(at), F.col(chrom) == F.col("__c"), "left")
    before = F.filter("__cuts", lambda p: p <= F.col(end))
    shift = F.coalesce(F.try_element_at(before, F.lit(-1)), F.lit(0))
    d = d.withColumns({"__n": F.size(before), "__shift": F.when(F.col("__c").isNotNull(), shift).otherwise(0)})
    d = d.withColumn(chrom, F.when(F.col("__c").isNotNull(), F.concat_ws("_s", chrom, F.col("__n").cast("string"))).otherwise(F.col(chrom)))
    moved = {start: F.col(start) - F.col("__shift"), end: F.col(end) - F.col("__shift")} if start != end else {start: F.col(start) - F.col("__shift")}
    return d.withColumns(moved).drop("__c", "__cuts", "__n", "__shift")


def long_sequences(fasta: DataFrame, longest: int = 1 << 29) -> DataFrame:
    """(name, length) of sequences (name, seq) longer than that."""
    return fasta.select("name", F.length("seq").cast("long").alias("length")).where(F.col("length") > longest)


def split_points(points: DataFrame, iv: DataFrame, width: int) -> DataFrame:
    """Points that no interval holds."""
    return points.join(stab(points, iv, width).select(*points.columns).distinct(), points.columns, "left_anti")


def split_sequences(fasta: DataFrame, cuts: DataFrame) -> DataFrame:
    """(name, seq) cut at the positions of cuts (name, pos): <name>_s0, <name>_s1, ... as split_shift names them; names without cuts stay as they are."""
    at = cuts.groupBy("name").agg(F.sort_array(F.collect_set("pos")).alias("at"))
    d = fasta.join(at, "name", "left").withColumn("ends", F.concat(F.coalesce("at", F.array().cast("array<bigint>")), F.array(F.length("seq").cast("long"))))
    d = d.select("name", "seq", "ends", F.posexplode("ends").alias("i", "end"))
    start = F.when(F.col("i") > 0, F.try_element_at("ends", F.col("i"))).otherwise(F.lit(0).cast("long"))
    name = F.when(F.size("ends") > 1, F.concat("name", F.lit("_s"), F.col("i").cast("string"))).otherwise(F.col("name"))
    return d.select(name.alias("name"), F.substring(F.col("seq"), (start + 1).cast("int"), (F.col("end") - start).cast("int")).alias("seq"))


def coordinate_rank(records: DataFrame, refs: list[tuple[str, int]], ties: list[str], name: str, ref: str = "ref", pos: str = "pos") -> DataFrame:
    """Adds the place of each record, from 1, among those of its reference in coordinate order; a reference is sorted by all tasks together.

    References come as in `refs` (name, length), records without one last; records at one position come in the order of `ties`.
    """
    d = ordinals(records, [*coordinate_order(refs, ref, pos), *ties], "__all")
    least = d.groupBy(ref).agg(F.min("__all").alias("__first"))  # a row for each reference
    least = least.withColumnRenamed(ref, "__ref")
    return d.join(F.broadcast(least), F.col(ref).eqNullSafe(F.col("__ref"))).withColumn(name, F.col("__all") - F.col("__first") + 1).drop("__all", "__first", "__ref")
