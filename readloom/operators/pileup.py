"""From alignment records to reference positions: depth, depth of regions, and methylation calls."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..shipping import ship
from ..sources.bam import parsed_cigar
from .intervals import binned, depth_segments

WIDTH = 512  # reference positions to a bin: what a read is joined with
STRETCH = 1 << 20  # reference bases searched at once


def stretches(pos: str = "pos", cigar: str = "cigar", gaps: bool = False) -> Column:
    """array<struct<start,end,at>>: the stretches of the reference that a record covers, and where in its bases each begins.

    Insertions and clips use up bases, deletions and skips positions: they end a stretch. With `gaps` these count as covered too, by no base of
    the read: `at` is then null. A record without a CIGAR covers nothing.
    """
    kind = "array<struct<start:bigint,end:bigint,at:int>>"
    start = F.struct(F.col(pos).cast("long").alias("ref"), F.lit(0).alias("read"), F.array().cast(kind).alias("out"))

    def step(s: Column, x: Column) -> Column:
        on, gap = x["op"].isin("M", "=", "X"), x["op"].isin("D", "N")
        n = x["n"].cast("long")
        found = F.struct(s["ref"].alias("start"), (s["ref"] + n).alias("end"), F.when(on, s["read"]).alias("at"))
        out = F.when((on | (gap & F.lit(gaps))) & (n > 0), F.concat(s["out"], F.array(found).cast(kind))).otherwise(s["out"])
        return F.struct(F.when(on | gap, s["ref"] + n).otherwise(s["ref"]).alias("ref"), F.when(on | x["op"].isin("I", "S"), s["read"] + x["n"]).otherwise(s["read"]).alias("read"), out.alias("out"))

    return F.coalesce(F.aggregate(parsed_cigar(cigar), start, step, lambda s: s["out"]), F.array().cast(kind))


def covered(records: DataFrame, gaps: bool = False, ref: str = "ref", pos: str = "pos", cigar: str = "cigar") -> DataFrame:
    """(chrom, start, end): a row for each stretch of the reference under a placed record (see stretches)."""
    placed = records.where(F.col(ref).isNotNull() & (F.col(pos) >= 0))
    return placed.select(F.col(ref).alias("chrom"), F.explode(stretches(pos, cigar, gaps)).alias("s")).select("chrom", "s.start", "s.end")


def region_depth(iv: DataFrame, regions: DataFrame, width: int = 1 << 14) -> DataFrame:
    """(chrom, start, end, depth, bases): for each region (chrom, start, end) how many of its positions have each depth above 0.

    Positions are never rows: stretches of one depth are cut at the regions. Regions that overlap count a position each; repeated regions
    are one. Depth comes from the intervals (chrom, start, end) that touch a region.
    """
    regions = regions.select("chrom", F.col("start").alias("r_start"), F.col("end").alias("r_end")).distinct()
    near = binned(regions, width, "r_start", "r_end")
    touched = binned(iv, width).join(near.select("chrom", "bin").distinct(), ["chrom", "bin"], "left_semi")
    # an interval in several touched bins is one interval: it counts in the first that it shares with a region
    first = touched.withColumn("start", F.greatest("start", F.col("bin") * width)).withColumn("end", F.least("end", (F.col("bin") + 1) * width))
    seen = depth_segments(first.select("chrom", "start", "end")).where("depth > 0")
    pairs = binned(seen, width).join(near, ["chrom", "bin"])
    cut = F.least("end", "r_end", (F.col("bin") + 1) * width) - F.greatest("start", "r_start", F.col("bin") * width)
    return pairs.where(cut > 0).groupBy("chrom", F.col("r_start").alias("start"), F.col("r_end").alias("end"), "depth").agg(F.sum(cut).alias("bases"))


def region_tail_share(depth: DataFrame, by: list[str], share: float = 0.2) -> DataFrame:
    """(by, mean, share): of the positions in region_depth rows (depth, bases) their mean depth, and how many are deeper than `share` of it."""
    mean = depth.groupBy(*by).agg((F.sum(F.col("depth") * F.col("bases")) / F.sum("bases")).alias("mean"))
    joined = depth.join(mean, by) if by else depth.crossJoin(F.broadcast(mean))  # one row
    deep = F.sum(F.when(F.col("depth") > share * F.col("mean"), F.col("bases")).otherwise(0))
    return joined.groupBy(*by, "mean").agg(F.round(deep / F.sum("bases"), 9).alias("share")).withColumn("mean", F.round("mean", 9))


def bisulfite_strand(flag: str = "flag", tags: str | None = "tags") -> Column:
    """The strand whose cytosines a read shows: by the tag XG (CT or GA) where there is one, else a first or single mate's own strand, a second mate's other one."""
    f = F.col(flag)
    back, second = (f.bitwiseAND(F.lit(16)) != 0), (f.bitwiseAND(F.lit(1)) != 0) & (f.bitwiseAND(F.lit(128)) != 0)
    plain = F.when(back == second, "+").otherwise("-")
    if tags is None:
        return plain
    genome = F.element_at(F.col(tags), "XG")
    return F.when(genome == "CT", "+").when(genome == "GA", "-").otherwise(plain)


_TURN = np.full(256, ord("N"), np.uint8)
for _a, _b in zip(b"ACGTacgt", b"TGCATGCA"):
    _TURN[_a] = _b
_UPPER = np.full(256, ord("N"), np.uint8)
for _a in b"ACGTacgt":
    _UPPER[_a] = _a & 0xDF


def cytosines(fasta: DataFrame, width: int = WIDTH, behind: int = 2) -> DataFrame:
    """(chrom, bin, strand, sites): the cytosines of both strands of sequences (name, seq), as array<struct<pos,context>> for each bin of `width` positions.

    pos counts from 0; the context is the cytosine and so many bases behind it on its strand, N where there is none or it is no base.
    """
    ship(fasta.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, seq in zip(batch.column(0).to_pylist(), batch.column(1)):
                raw = seq.cast(pa.binary()).as_buffer() if seq.is_valid else b""
                whole = np.frombuffer(raw, np.uint8)
                for lo in range(0, len(whole), STRETCH):
                    hi = min(lo + STRETCH, len(whole))
                    pad = np.full(hi - lo + 2 * behind, ord("N"), np.uint8)
                    a, b = max(lo - behind, 0), min(hi + behind, len(whole))
                    pad[a - lo + behind : b - lo + behind] = _UPPER[whole[a:b]]
                    for strand, base, step in (("+", ord("C"), 1), ("-", ord("G"), -1)):
                        at = np.flatnonzero(pad[behind : len(pad) - behind] == base)
                        letters = np.stack([pad[at + behind + step * k] for k in range(behind + 1)], 1) if len(at) else np.zeros((0, behind + 1), np.uint8)
                        letters = letters if step > 0 else _TURN[letters]
                        bins, first = np.unique((at + lo) // width, return_index=True)
                        context = pa.array(letters.copy().view(f"S{behind + 1}").ravel(), pa.binary()).cast(pa.string()) if len(at) else pa.array([], pa.string())
                        sites = pa.StructArray.from_arrays([pa.array(at + lo, pa.int64()), context], ["pos", "context"])
                        lists = pa.ListArray.from_arrays(pa.array([*first.tolist(), len(at)], pa.int32()), sites)
                        yield pa.RecordBatch.from_arrays([pa.array([name] * len(bins), pa.string()), pa.array(bins, pa.int64()), pa.array([strand] * len(bins)), lists], ["chrom", "bin", "strand", "sites"])

    found = fasta.select("name", "seq").mapInArrow(run, "chrom string, bin long, strand string, sites array<struct<pos:bigint,context:string>>")
    if STRETCH % width:  # a bin that lies in two stretches is one row
        found = found.groupBy("chrom", "bin", "strand").agg(F.flatten(F.collect_list("sites")).alias("sites"))
    return found


def methylation_calls(records: DataFrame, sites: DataFrame, cell: list[str], width: int = WIDTH, least_mapq: int = 10, least_quality: int = 20) -> DataFrame:
    """(cell, chrom, pos, strand, context, mc, cov) from placed records (cell, ref, pos, mapq, cigar, seq, qual, strand) and the cytosines of their reference.

    pos counts from 1, as call tables do. On the + strand a C is methylated and a T is not, on the - strand G and A; other bases, gaps, clips and bases
    below `least_quality` say nothing. `strand` is that of the cytosines (see bisulfite_strand); a qual of * passes. Reads meet the sites of the bins
    they touch by an equality join on (chrom, bin, strand); `width` is that of the sites.
    """
    d = records.where(F.col("ref").isNotNull() & (F.col("pos") >= 0) & (F.col("mapq") >= least_mapq))
    d = d.select(*cell, F.col("ref").alias("chrom"), "strand", "seq", "qual", F.explode(stretches()).alias("s")).select(*cell, "chrom", "strand", "seq", "qual", "s.*")
    d = binned(d, width)
    here = d.join(sites, ["chrom", "bin", "strand"])
    here = here.withColumn("site", F.explode(F.filter("sites", lambda x: (x["pos"] >= F.col("start")) & (x["pos"] < F.col("end")))))
    nth = (F.col("site.pos") - F.col("start") + F.col("at") + 1).cast("int")
    base, quality = F.upper(F.substr("seq", nth, F.lit(1))), F.ascii(F.substr("qual", nth, F.lit(1))) - 33
    plus = F.col("strand") == "+"
    called = here.select(*cell, "chrom", (F.col("site.pos") + 1).alias("pos"), "strand", "site.context", base.alias("base"), quality.alias("quality"), "qual", plus.alias("plus"))
    called = called.where((F.col("qual") == "*") | (F.col("quality") >= least_quality))
    called = called.where(F.when(F.col("plus"), F.col("base").isin("C", "T")).otherwise(F.col("base").isin("G", "A")))
    mc = F.sum(F.when(F.col("base").isin("C", "G"), 1).otherwise(0))
    return called.groupBy(*cell, "chrom", "pos", "strand", "context").agg(mc.alias("mc"), F.count("*").alias("cov"))
