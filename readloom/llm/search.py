"""Exact top-k search of binary codes by incremental multi-index hashing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import settle, table, tidy

BITS = 64
WIDTH = 13  # bits of a segment: five segments, of which each bucket holds one in 8,192 of the distinct codes
CODES = 1 << 20  # distinct codes beyond which segments get a bit more for each doubling


def sign_code(vector: str | Column, bits: int = BITS) -> Column:
    """Bit i of the code is 1 if element i is above 0; missing, null and NaN elements give 0."""
    at = lambda i: F.try_element_at(vector, F.lit(i + 1))
    out = F.lit(0).cast("long")
    for i in range(bits):
        out = out.bitwiseOR(F.when((at(i) > 0) & ~F.isnan(at(i)), F.lit(1 << i if i < 63 else -(1 << 63)).cast("long")).otherwise(F.lit(0).cast("long")))
    return out


def segments_of(width: int) -> list[tuple[int, int]]:
    """(first bit, bits) of segments of about `width` bits."""
    n = -(-BITS // width)
    cuts = [round(i * BITS / n) for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def width_for(codes: int) -> int:
    """Bits of a segment for so many distinct codes."""
    return min(WIDTH + max((codes - 1) // CODES, 0).bit_length(), BITS // 2)


def segment(code: Column, first: int, width: int) -> Column:
    return F.shiftrightunsigned(code, first).bitwiseAND(F.lit((1 << width) - 1)).cast("int")


@tidy
def search(rows: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", width: int | None = None) -> DataFrame:
    """(query, rank, neighbour, distance): for each query row the k rows of `rows` at the least Hamming distance.

    Distances are between sign codes; ties go to the smaller id; a query does not find its own id. Rows with a null id or
    vector are left out; ids are taken as unique: of rows that repeat an id the one with the smallest code counts.

    Equal codes share one index entry that keeps their k + 1 smallest ids, which is all that any answer can need
    of them. The index lists each distinct code under its value in each segment. Round r looks up, for each
    query still open and each segment, the codes whose segment differs in exactly r bits, so all codes
    within s * (r + 1) - 1 bits have been seen after it (s segments). A query is closed when k verified
    neighbours lie within that distance. Equal query codes are searched once. A bucket of the index holds about
    2**-width of the distinct codes. The width, if none is given, is 13 up to 2**20 of them and grows by a bit for each doubling above, so that buckets
    stay at 128 codes or so; below, each bit more would multiply the probes of a query for buckets that are short already.
    """
    code = sign_code(vector_col)
    keep = lambda df: df.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), code.alias("code")).groupBy("id").agg(F.min("code").alias("code"))
    codes = keep(rows)
    near = Window.partitionBy("code", "part").orderBy("id")
    few = codes.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(64))).withColumn("n", F.row_number().over(near)).where(F.col("n") <= k + 1)
    entries = settle(few.groupBy("code").agg(F.slice(F.array_sort(F.collect_list("id")), 1, k + 1).alias("ids")), keep=True)
    asked = settle(keep(queries), keep=True)
    parts = segments_of(width or width_for(entries.count()))
    listed = F.explode(F.array(*[F.struct(F.lit(i).alias("seg"), segment(F.col("code"), a, w).alias("value")) for i, (a, w) in enumerate(parts)]))
    index = settle(entries.select("code", F.size("ids").alias("held"), listed.alias("at")).select("code", "held", "at.seg", "at.value"))
    widest = max(w for _, w in parts)
    open_ = asked.select(F.col("code").alias("q")).distinct()
    found = None
    for r in range(widest + 1):
        probes = open_.select("q", F.explode(F.array(*[F.struct(F.lit(i).alias("seg"), F.lit(w).alias("width"), segment(F.col("q"), a, w).alias("value")) for i, (a, w) in enumerate(parts)])).alias("at"))
        probes = probes.select("q", "at.*", F.lit(0).alias("next"))
        for _ in range(r):  # every set of r bits once: each further bit lies above the last
            bit = F.explode(F.when(F.col("next") < F.col("width"), F.sequence("next", F.col("width") - 1)))
            probes = probes.select("q", "seg", "width", "value", bit.alias("bit"))
            probes = probes.select("q", "seg", "width", F.expr("value ^ shiftleft(1, bit)").alias("value"), (F.col("bit") + 1).alias("next"))
        # a merge join: the planner's size of the probes is that of the queries, far below what they expand to
        hits = probes.select("q", "seg", "value").join(index.hint("merge"), ["seg", "value"]).select("q", "code", "held")
        hits = hits.withColumn("distance", F.bit_count(F.col("q").bitwiseXOR(F.col("code"))).cast("int"))
        if found is not None:
            hits = hits.unionByName(found.join(open_, "q", "left_semi"))
        # of each distance, the codes that can still matter: the nearest with k + 1 ids between them
        hits = hits.groupBy("q", "code").agg(F.min("distance").alias("distance"), F.min("held").alias("held"))
        order = Window.partitionBy("q").orderBy("distance")
        ahead = F.coalesce(F.sum("held").over(order.rangeBetween(Window.unboundedPreceding, -1)), F.lit(0))
        hits = settle(hits.withColumn("ahead", ahead).where(F.col("ahead") <= k).drop("ahead"), keep=found is None)
        covered = len(parts) * (r + 1) - 1
        reached = hits.where(F.col("distance") <= covered).groupBy("q").agg(F.sum("held").alias("held")).where(F.col("held") > k)
        done = found.join(open_, "q", "left_anti") if found is not None else None
        found = settle(done.unionByName(hits), keep=True) if done is not None else hits
        open_ = settle(open_.join(reached, "q", "left_anti"))
        if r == widest or open_.isEmpty():
            break
    ids = found.join(entries, "code").select("q", "distance", F.explode("ids").alias("neighbour"))
    pairs = asked.select(F.col("id").alias("query"), F.col("code").alias("q")).join(ids, "q").where(F.col("query") != F.col("neighbour"))
    best = Window.partitionBy("query").orderBy("distance", "neighbour")
    return pairs.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query", "rank", "neighbour", "distance")


def op10_search(spark, sf_dir: str) -> DataFrame:
    """The ten nearest sign codes of each vector whose id is divisible by 100, among all vectors."""
    rows = table(spark, sf_dir, "embeddings")
    return search(rows, rows.where(F.col("vec_id") % 100 == 0)).withColumnRenamed("query", "vec_id")


ORACLE = """
with c as (select vec_id, list_transform(embedding, lambda x: case when x > 0 then 1 else 0 end) as code from embeddings where embedding is not null),
p as (select q.vec_id, r.vec_id as neighbour,
             cast(list_sum(list_transform(list_zip(q.code, r.code), lambda z: case when z[1] <> z[2] then 1 else 0 end)) as integer) as distance
      from c q join c r on q.vec_id % 100 = 0 and q.vec_id <> r.vec_id),
n as (select *, cast(row_number() over (partition by vec_id order by distance, neighbour) as integer) as rank from p)
select vec_id, rank, neighbour, distance from n where rank <= 10
"""
