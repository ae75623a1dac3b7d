"""Reads: layout, whitelist correction, filters, profiles."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import seq as S
from ..scratch import settle, tidy


def anchor_shift(df: DataFrame, seq: str, pattern: str) -> DataFrame:
    """Adds start (0-based, behind the anchor's first base) and status; the anchor must lie in the first 7 bases."""
    at = F.locate(pattern, F.substring(seq, 1, 7))
    return df.withColumn("start", F.when(at > 0, at)).withColumn("status", F.when(at > 0, "valid").otherwise("no_anchor"))


def extract_segments(df: DataFrame, seq: str, structure: list[tuple[str, int]], start: str | None = None) -> DataFrame:
    """Adds barcode, linker, umi (all segments of a kind joined) and rest, what follows the last segment.

    The layout begins at the 0-based position in the column `start` (see anchor_shift), or at the first base; null where it is null.
    """
    parts: dict[str, list[Column]] = {"B": [], "L": [], "U": []}
    first, at = F.lit(0) if start is None else F.col(start), 0
    take = lambda n: F.substring(F.col(seq), first + at + 1, F.lit(n))
    for code, n in structure:
        if code in parts:
            parts[code].append(take(n))
        at += n
    join = lambda p: F.concat(*p) if p else F.lit("")
    return df.withColumns({"barcode": join(parts["B"]), "linker": join(parts["L"]), "umi": join(parts["U"]), "rest": take(1 << 30)})


def match_whitelist(raw: DataFrame, whitelist: DataFrame) -> DataFrame:
    """(raw) distinct barcodes -> (raw, candidate, distance): whitelist entries at distance 0, else all at distance 1.

    Neighbours are listed and joined by equality, so the cost is that of one hash join whatever the whitelist.
    """
    raw, white = raw.select("raw").distinct(), whitelist.select(F.col("barcode").alias("candidate")).distinct()
    exact = raw.join(white, raw.raw == white.candidate).select("raw", "candidate", F.lit(0).alias("distance"))
    near = raw.join(exact.select("raw"), "raw", "left_anti").select("raw", F.explode(S.neighbours(F.col("raw"))).alias("candidate"))
    return exact.unionByName(near.join(white, "candidate", "left_semi").select("raw", "candidate", F.lit(1).alias("distance")))


def correct(reads: DataFrame, whitelist: DataFrame) -> DataFrame:
    """Reads with `raw` -> adds status (exact, one, multi, none), n_candidates and corrected (null if multi or none)."""
    return _corrected(reads, match_whitelist(reads.select("raw"), whitelist)).drop("candidates")


def _corrected(reads: DataFrame, found: DataFrame) -> DataFrame:
    per = found.groupBy("raw").agg(F.min("distance").alias("d"), F.sort_array(F.collect_list("candidate")).alias("candidates"))
    out = reads.join(per, "raw", "left").withColumn("n_candidates", F.coalesce(F.size("candidates").cast("long"), F.lit(0).cast("long")))
    status = F.when(F.col("d") == 0, "exact").when(F.col("n_candidates") == 1, "one").when(F.col("n_candidates") > 1, "multi").otherwise("none")
    return out.withColumn("status", status).withColumn("corrected", F.when(F.col("status").isin("exact", "one"), F.col("candidates")[0])).drop("d")


def rescue(reads: DataFrame, whitelist: DataFrame, strict: bool = False) -> DataFrame:
    """Reads with several candidates -> the chosen one (null: not corrected).

    By raw count: the candidate most often read as it is, the first in text order of equals, none without reads.
    Strict: by count after correction, which must be above that of the second. Reads are joined once: counts come from the distinct
    raw sequences, so all else is as large as these.
    """
    raws = reads.groupBy("raw").agg(F.count("*").alias("n"))
    found = match_whitelist(raws, whitelist)
    fixed = _corrected(raws, found)
    counts = fixed.where("status in ('exact', 'one')" if strict else "status = 'exact'").groupBy(F.col("corrected").alias("candidate")).agg(F.sum("n").alias("n"))
    options = fixed.where("status = 'multi'").select("raw", "status", "n_candidates", F.explode("candidates").alias("candidate")).join(counts, "candidate", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    # at most a few dozen candidates a sequence: their best two without a window
    per = options.groupBy("raw", "status", "n_candidates").agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("less"), "candidate"))).alias("o"))
    first, second = -F.col("o")[0]["less"], F.coalesce(-F.get("o", F.lit(1))["less"], F.lit(0))
    ok = (first > second) if strict else (first > 0)
    best = per.select("raw", "status", "n_candidates", F.when(ok, F.col("o")[0]["candidate"]).alias("chosen"))
    return reads.join(best, "raw")


def _by_pieces(queries: DataFrame, whitelist: DataFrame, block: int, blocks: int, length: int | None) -> DataFrame:
    """nearest by an equality join on pieces: within `blocks` - 1 mismatches one of them is equal."""
    size = lambda i: block if i < blocks - 1 or length is None else length - block * (blocks - 1)
    piece = lambda c: F.explode(F.array(*[F.struct(F.lit(i).alias("i"), S.cut(F.col(c), i * block, size(i)).alias("p")) for i in range(blocks)]))
    pairs = queries.select("raw", piece("raw").alias("k")).join(whitelist.select("barcode", piece("barcode").alias("k")), "k")
    pairs = pairs.select("raw", "barcode").distinct().withColumn("distance", S.hamming(F.col("raw"), F.col("barcode")))
    best = Window.partitionBy("raw")
    return pairs.where(F.col("distance") < blocks).withColumn("least", F.min("distance").over(best)).where("distance = least").drop("least")


def _substituted(queries: DataFrame, distance: int, letters: list[str], length: int) -> DataFrame:
    """(raw, barcode): all sequences of the letters' substitutions at exactly that distance from sequences (raw) of one length."""
    d = queries.select("raw", F.col("raw").alias("barcode"), F.lit(0).alias("at"))
    for rest in reversed(range(distance)):  # places go up, and leave room for the rest
        d = d.select("raw", "barcode", F.explode(F.sequence(F.col("at") + 1, F.lit(length - rest))).alias("at"))
        d = d.select("raw", "barcode", "at", F.explode(F.array(*[F.lit(b) for b in letters])).alias("b")).where(F.col("b") != F.col("barcode").substr(F.col("at"), F.lit(1)))
        d = d.select("raw", F.overlay("barcode", "b", "at", F.lit(1)).alias("barcode"), "at")
    return d.select("raw", "barcode")


@tidy
def nearest(queries: DataFrame, whitelist: DataFrame, block: int, blocks: int, length: int | None = None) -> DataFrame:
    """(raw) x (barcode): all entries at the least Hamming distance, if that is below `blocks`.

    Distances are tried from 0 up: all sequences at that distance, of the letters that the whitelist has, are looked up by an equality join, and
    what found an entry is done. Once these are more than the entries that pieces would compare, the rest is cut into `blocks` pieces of `block` bases,
    the last of which takes the rest of `length`, and meets the whitelist by these. So are sequences of several lengths.
    """
    left, white = settle(queries.select("raw").where("raw is not null").distinct()), settle(whitelist.select("barcode").where("barcode is not null").distinct())
    sizes = lambda d, c: d.agg(F.count("*"), F.min(F.length(c)), F.max(F.length(c))).first()
    (asked, low, high), (entries, least, most) = sizes(left, "raw"), sizes(white, "barcode")
    letters = sorted(r[0] for r in white.select(F.explode(S.letters(F.col("barcode"))).alias("b")).distinct().collect())  # a handful
    compared = blocks * entries / max(len(letters), 1) ** block
    found = []
    for d in range(blocks):
        if not (asked and entries) or d > most:
            break
        if not low == high == least == most or math.comb(most, d) * max(len(letters) - 1, 0) ** d > max(compared, 1):
            found.append(settle(_by_pieces(left, white, block, blocks, length), keep=True))
            break
        near = settle(_substituted(left, d, letters, most).join(white, "barcode").select("raw", "barcode", F.lit(d).alias("distance")), keep=True)
        found.append(near)
        left = settle(left.join(near.select("raw").distinct(), "raw", "left_anti"))
        asked = left.count()
    if not found:
        return queries.sparkSession.createDataFrame([], "raw string, barcode string, distance int")
    return reduce(DataFrame.unionByName, found)


def base_profile(df: DataFrame, seq: str) -> DataFrame:
    """(pos, base, n), pos from 0."""
    return df.select(F.posexplode(S.letters(F.col(seq))).alias("pos", "base")).groupBy("pos", "base").agg(F.count("*").alias("n"))


def quality_profile(df: DataFrame, qual: str) -> DataFrame:
    """(pos, quality, n), pos from 0."""
    return df.select(F.posexplode(S.phred(F.col(qual))).alias("pos", "quality")).groupBy("pos", "quality").agg(F.count("*").alias("n"))


def wide_profile(profile: DataFrame, key: str, values: list, name: str = "n_") -> DataFrame:
    """One row a position, a zero-filled column for each value."""
    return profile.groupBy("pos").agg(*[F.coalesce(F.sum(F.when(F.col(key) == v, F.col("n"))), F.lit(0)).cast("long").alias(f"{name}{v}") for v in values])


def q30_share(profile: DataFrame) -> DataFrame:
    return profile.agg(F.round(F.sum(F.when(F.col("quality") >= 30, F.col("n")).otherwise(0)) / F.sum("n"), 9).alias("q30"))


def conversion(df: DataFrame, seq: str, qual: str, motif: tuple[int, str], counted: list[int], insert: tuple[int, int], least: int) -> DataFrame:
    """Adds line: A for reads whose insert reads TT, B for CC, null for others or reads that are too short, of mean
    quality below 30 over the motif, without the motif or with a counted base that is neither C nor T; and `hits`,
    how many counted bases read T (A) or C (B)."""
    s = F.col(seq)
    base = lambda i: S.cut(s, i, 1)
    at, word = motif
    ok = (F.length(s) >= least) & (S.cut(s, at, len(word)) == word) & (S.mean_phred(S.cut(F.col(qual), at, len(word))) >= 30)
    for i in counted:
        ok = ok & base(i).isin("C", "T")
    pair = F.concat(base(insert[0]), base(insert[1]))
    line = F.when(ok & (pair == "TT"), "A").when(ok & (pair == "CC"), "B")
    hits = lambda b: sum(((base(i) == b).cast("int") for i in counted), F.lit(0))
    return df.withColumn("line", line).withColumn("hits", F.when(F.col("line") == "A", hits("T")).when(F.col("line") == "B", hits("C")))


def conversion_rates(df: DataFrame, counted: int) -> DataFrame:
    lines = lambda k: F.sum((F.col("line") == k).cast("int"))
    rate = lambda k: F.round(F.try_divide(F.sum(F.when(F.col("line") == k, F.col("hits"))), counted * lines(k)), 9)
    return df.agg(F.coalesce(lines("A"), F.lit(0)).cast("long").alias("line_a"), F.coalesce(lines("B"), F.lit(0)).cast("long").alias("line_b"), rate("A").alias("ct_mean"), rate("B").alias("cc_mean"))


def first_reads(df: DataFrame, ordinal: str | list[str], n: int) -> DataFrame:
    """The first n reads in file order (see cap_reads): each task keeps n at most, then they are merged."""
    return df.orderBy(*([ordinal] if isinstance(ordinal, str) else ordinal)).limit(n)


def cap_reads(df: DataFrame, barcode: str, ordinal: str | list[str], limit: int) -> DataFrame:
    """The first `limit` reads of each barcode, in file order: by ordinal, or by (file, ordinal) where ordinals restart in every file."""
    order = [ordinal] if isinstance(ordinal, str) else list(ordinal)
    return df.withColumn("__n", F.row_number().over(Window.partitionBy(barcode).orderBy(*order))).where(F.col("__n") <= limit).drop("__n")
