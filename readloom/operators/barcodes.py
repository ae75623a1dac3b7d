"""From reads and a chemistry to barcode, UMI and status: the pass over raw reads."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..chemistry import LEAST_1, LEAST_2, Chemistry
from ..functions import seq as S
from ..scratch import settle, tidy
from .matching import trim
from .reads import nearest

BROADCAST_ROWS = 1_000_000  # rows (raw, candidates) of a whitelist's table that may be broadcast: some 60 MB


def match_table(whitelist: DataFrame, distance: int = 1, raw: DataFrame | None = None, length: int | None = None) -> DataFrame:
    """(raw, exact, candidates): for every raw sequence that a whitelist (barcode) accepts, the sorted entries it may stand for.

    Distance 1 lists the neighbours of the whitelist: an entry itself is exact; else all entries at one substitution, or those that
    fill the first N. No read is looked at, so the table is as large as the whitelist. Further distances need the distinct `raw`
    sequences and their length: the entries at the least distance up to it.
    """
    white = whitelist.select("barcode").where(F.length("barcode") > 0).distinct()
    exact = white.select(F.col("barcode").alias("raw"), F.lit(True).alias("exact"), F.array("barcode").alias("candidates"))
    if distance == 1:
        near = white.select("barcode", F.explode(F.concat(S.neighbours_all(F.col("barcode")), S.with_n(F.col("barcode")))).alias("raw"))
    else:
        size = max(1, length // (distance + 1))
        near = nearest(raw, white, size, distance + 1, length)
    near = near.groupBy("raw").agg(F.sort_array(F.collect_set("barcode")).alias("candidates"))
    near = near.join(exact.select("raw"), "raw", "left_anti").select("raw", F.lit(False).alias("exact"), "candidates")
    return exact.unionByName(near)


def product(parts: list[Column]) -> Column:
    """All joined sequences that take one of each array."""
    return reduce(lambda a, b: F.flatten(F.transform(a, lambda x: F.transform(b, lambda y: F.concat(x, y)))), parts)


def assign(reads: DataFrame, chemistry: Chemistry, whitelists: list[DataFrame] = (), linkers: list[DataFrame] = (), correct_barcodes: bool = True, correct_linkers: bool = True, seq: str = "r1_seq", qual: str = "r1_qual") -> DataFrame:
    """Reads -> the same with status, raw, barcode, candidates, corrected, umi, alt, rest and rest_qual.

    status: no_anchor; no_barcode or no_linker for the first segment in the layout's order that no whitelist entry explains;
    rejected where that segment is not exact and correction is off; multi if a barcode segment has several candidates (then barcode and
    alt are null and candidates lists every combination); else valid. The n-th barcode or linker segment has the n-th whitelist, the first
    where there are fewer; without whitelists every segment is taken as it is. alt is M unless a segment was corrected.
    rest is what follows the layout.
    """
    cols = reads.columns
    d, own = reads, "__"
    while any(c.startswith(own) for c in cols):  # the names of columns on the way are those of no column that is there
        own += "_"
    at_col = f"{own}at"
    if chemistry.shift:
        at = F.locate(chemistry.pattern, F.substring(seq, 1, 7))
        d = d.withColumn(at_col, at)
    else:
        d = d.withColumn(at_col, F.lit(0))
    start, steps, umis, raws, parts, fixed = 0, [], [], [], [], []
    none = F.array().cast("array<string>")
    here = lambda column, at, n: F.substring(F.col(column), F.col(at_col) + at + 1, F.lit(n))
    nth = {"B": 0, "L": 0}
    for code, n in chemistry.segments:
        if code == "U":
            umis.append(here(seq, start, n))
        elif code in nth:
            i, lists = nth[code], (whitelists if code == "B" else linkers)
            nth[code] += 1
            name = f"{own}{code}{i}"
            d = d.withColumn(name, here(seq, start, n))
            if code == "B":
                raws.append(F.col(name))
            if lists:
                white = lists[min(i, len(lists) - 1)]
                distance = chemistry.match(i) if code == "B" else 1
                raw = d.select(F.col(name).alias("raw")).where(F.length("raw") == n) if distance != 1 else None
                found = match_table(white, distance, raw, n)
                found = found.select(F.col("raw").alias(name), F.col("exact").alias(f"{name}x"), F.col("candidates").alias(f"{name}c"))
                small = distance == 1 and white.count() * (4 * n + 1) <= BROADCAST_ROWS
                d = d.join(F.broadcast(found) if small else found, name, "left")
                exact, options = F.coalesce(F.col(f"{name}x"), F.lit(False)), F.col(f"{name}c")
                may = correct_barcodes if code == "B" else correct_linkers
                bad = F.when(exact, F.lit(None)).when(F.lit(not may), "rejected").when(options.isNull(), "no_barcode" if code == "B" else "no_linker")
                steps.append(bad)
                if code == "B":
                    parts.append(F.coalesce(options, none))
                    fixed.append(~exact & (F.size(F.coalesce(options, none)) == 1))
            elif code == "B":
                parts.append(F.array(name))
        start += n
    bad = F.coalesce(*steps, F.lit(None).cast("string")) if steps else F.lit(None).cast("string")
    several = reduce(lambda a, b: a | b, [F.size(p) > 1 for p in parts], F.lit(False))
    status = F.when(F.col(at_col) < 0, "no_anchor") if not chemistry.shift else F.when(F.coalesce(F.col(at_col), F.lit(0)) == 0, "no_anchor")
    join = lambda p: F.concat(*p) if p else F.lit("")
    d = d.withColumn("status", status.when(bad.isNotNull(), bad).when(several, "multi").otherwise("valid"))
    one = F.col("status") == "valid"
    live = F.col("status").isin("valid", "multi")
    d = d.withColumn("raw", F.when(live, join(raws)))
    d = d.withColumn("candidates", F.when(live, product(parts) if parts else F.array(F.lit(""))))
    d = d.withColumn("barcode", F.when(one, F.get("candidates", F.lit(0))))
    d = d.withColumn("corrected", F.coalesce(live & reduce(lambda a, b: a | b, fixed, F.lit(False)), F.lit(False)))
    d = d.withColumn("umi", F.when(live, join(umis)))
    d = d.withColumn("alt", F.when(one, F.when(F.col("corrected"), S.alteration(F.col("raw"), F.col("barcode"))).otherwise(F.lit("M"))))
    rest = lambda c: F.when(live, F.substring(F.col(c), F.col(at_col) + start + 1, F.lit(1 << 30)))
    d = d.withColumn("rest", rest(seq))
    if qual in cols:
        d = d.withColumn("rest_qual", rest(qual))
    return d.drop(*[c for c in d.columns if c.startswith(own)])


def rescue_multi(assigned: DataFrame) -> DataFrame:
    """The reads of assign, those of status multi decided: the candidate that most reads have as their raw barcode, the first in text order
    of equals. Without any such read the status becomes no_rescue. alt may be empty.

    Reads per raw barcode are counted over valid and multi reads.
    """
    counts = assigned.where(F.col("status").isin("valid", "multi")).groupBy("raw").agg(F.count("*").alias("__n"))
    multi = assigned.where("status = 'multi'")
    options = multi.select("raw", "candidates").distinct().select("raw", F.explode("candidates").alias("c"))
    rank = F.struct((-F.col("__n")).alias("n"), "c")
    best = options.join(counts.withColumnRenamed("raw", "c"), "c").groupBy("raw").agg(F.min(rank)["c"].alias("__best"))
    done = multi.drop("barcode", "alt").join(best, "raw", "left").withColumn("barcode", F.col("__best"))
    done = done.withColumn("alt", F.when(F.col("__best").isNotNull(), S.alteration(F.col("raw"), F.col("__best"), same="")))
    done = done.withColumn("status", F.when(F.col("__best").isNull(), "no_rescue").otherwise("rescued")).drop("__best")
    return assigned.where("status != 'multi'").unionByName(done.select(*assigned.columns))


def finish(assigned: DataFrame, chemistry: Chemistry, short_reads: bool = False, seq_2: str = "r2_seq", adapters: bool = True, least: tuple[int, int] = (LEAST_1, LEAST_2)) -> DataFrame:
    """Trims and measures reads with a barcode: adds rest_kept, r2_kept and outcome (kept, too_short, trimmed, null for others).

    Mates are too short under the two least lengths. With short_reads only those with an empty side are measured; the rest counts as trimmed.
    """
    has = F.col("barcode").isNotNull()
    d = assigned
    if adapters:
        d = trim(d, "rest", list(chemistry.adapters_1)).withColumnRenamed("kept", "rest_kept").drop("trimmed")
        d = trim(d, seq_2, list(chemistry.adapters_2)).withColumnRenamed("kept", "r2_kept").drop("trimmed")
    else:
        d = d.withColumn("rest_kept", F.col("rest")).withColumn("r2_kept", F.col(seq_2))
    one, two = F.length(F.coalesce("rest_kept", F.lit(""))), F.length(F.coalesce("r2_kept", F.lit("")))
    short = length_status(one, two, least) == "too_short"
    measured = F.lit(not short_reads) | (one == 0) | (two == 0)
    return d.withColumn("outcome", F.when(has & measured, F.when(short, "too_short").otherwise("kept")).when(has, "trimmed"))


#: The counters of a pass, as reports name them.
COUNTERS = ["total", "valid", "no_anchor", "too_short", "trimmed", "B_corrected", "B_no_correction", "L_no_correction"]


def counters(finished: DataFrame) -> DataFrame:
    """One row of COUNTERS over reads with status, corrected and outcome. A corrected read that is too short does not count as corrected."""
    s, o = F.col("status"), F.col("outcome")
    n = lambda c: F.count_if(c)
    made = F.col("corrected") & (s.isin("rescued", "no_rescue", "multi") | ((s == "valid") & (o != "too_short")))
    values = [F.count("*"), n(s.isin("valid", "rescued")), n(s == "no_anchor"), n(o == "too_short"), n(o == "trimmed"), n(made), n(s.isin("no_barcode", "no_rescue")), n(s == "no_linker")]
    return finished.agg(*[v.alias(c) for v, c in zip(values, COUNTERS)])


def headers(finished: DataFrame, name: str = "name") -> Column:
    """<barcode>_<umi>_<alt>_<name>, the name that later steps take apart."""
    return F.concat_ws("_", "barcode", "umi", "alt", name)


def length_status(one: Column, two: Column, least: tuple[int, int] = (LEAST_1, LEAST_2)) -> Column:
    """too_short or valid, from the lengths of two mates."""
    return F.when((one < least[0]) | (two < least[1]), "too_short").otherwise("valid")


def valid_share(reads: DataFrame, chemistry: Chemistry, whitelists: list[DataFrame], seq: str = "r1_seq") -> float:
    """The share of reads with a barcode, those of several candidates counted if rescue_multi decides them."""
    done = rescue_multi(assign(reads, chemistry, whitelists, seq=seq))
    return done.agg(F.try_divide(F.count_if(F.col("status").isin("valid", "rescued")), F.count("*")).alias("r")).first().r or 0.0


@tidy
def autodetect(reads: DataFrame, options: dict[str, tuple[Chemistry, list[DataFrame]]], first: int = 100_000, order: list[str] = ("file", "ordinal"), seq: str = "r1_seq") -> tuple[str, dict[str, float]]:
    """The option whose barcodes explain the most of the first reads, the earlier of equals, and the share of valid reads of each.

    `first` is how many reads are tried, which is a feature: a trial must not take as long as the run.
    """
    head = settle(reads.orderBy(*order).limit(first))
    rates = {name: valid_share(head, chemistry, whitelists, seq) for name, (chemistry, whitelists) in options.items()}
    return max(rates, key=lambda k: rates[k]), rates
