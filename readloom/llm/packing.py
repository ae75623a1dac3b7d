"""Packing documents into token-budget batches inside optimal length buckets."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column, digits_for, order_key, settle, table, tidy, with_prefix, word_count

EXACT = 1024  # words up to which the grid has a cell for every length
GRID = 9  # log2 of half the cells to each doubling above that
BUCKETS, BUDGET = 16, 65_536


def cell_of(length: Column) -> Column:
    """The length, rounded up to a grid: exact up to EXACT, then EXACT/2 steps to each doubling.

    The grid has under 17,000 cells below 2**42 and is the same for any input.
    """
    step = F.when(length <= EXACT, F.lit(1).cast("long")).otherwise(F.pow(F.lit(2.0), F.floor(F.log2(F.greatest(length, F.lit(1)).cast("double"))) - GRID).cast("long"))
    return (F.ceil(length / step) * step).cast("long")


def best_bounds(cells: np.ndarray, counts: np.ndarray, k: int, sums: np.ndarray | None = None) -> list[int]:
    """At most k upper bounds, chosen from `cells` (ascending), with the least total padding; of equal choices that with the lowest last cuts.

    A cell stands for `counts` lengths that are at most its value and add up to `sums` (by default counts times the value). cost[j][i] is the least padding of the first i cells in j buckets. A bucket over cells a..b costs
    cells[b] * n(a..b) - sum(a..b), which satisfies the quadrangle inequality, so the best split never moves
    left and each layer is filled by divide and conquer.
    """
    n = len(cells)
    if not n:
        return []
    num, tot = np.concatenate([[0], np.cumsum(counts)]).astype(np.float64), np.concatenate([[0], np.cumsum(cells * counts if sums is None else sums)]).astype(np.float64)
    cost, back = np.full(n + 1, np.inf), []
    cost[0] = 0
    for _ in range(min(k, n)):
        new, arg = np.full(n + 1, np.inf), np.zeros(n + 1, np.int64)
        new[0] = 0
        todo = [(1, n, 0, n - 1)]
        while todo:
            lo, hi, left, right = todo.pop()
            if lo > hi:
                continue
            mid = (lo + hi) // 2
            a = np.arange(left, min(mid - 1, right) + 1)
            c = cost[a] + cells[mid - 1] * (num[mid] - num[a]) - (tot[mid] - tot[a])
            at = int(np.argmin(c))
            new[mid], arg[mid] = c[at], a[at]
            todo += [(lo, mid - 1, left, int(a[at])), (mid + 1, hi, int(a[at]), right)]
        cost = new
        back.append(arg)
    out, i = [], n
    for arg in reversed(back):
        if i == 0:
            break
        out.append(int(cells[i - 1]))
        i = int(arg[i])
    return sorted(set(out))


@tidy
def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int = BUCKETS, budget: int = BUDGET, carry: list[str] | None = None) -> DataFrame:
    """One row per document: where it lies in the batches.

    Columns: carry (struct `row`), id, length (words), bucket (0 from the shortest), bound (padded length),
    batch (in the bucket), slot (in the batch) and padding. The bounds minimise all padding over the
    histogram of lengths, of which those in one cell of the grid (see cell_of) share a bucket, bounded by the longest of them: up to EXACT
    words the optimum over all lengths, above it that over the grid. The histogram, not the rows, goes to the driver. A batch holds
    max(1, budget // bound) documents, so bound * documents stays within the budget unless one document alone
    is over it. Inside a bucket documents lie in a fixed pseudo-random order. Empty texts have length 0 and
    lie in the lowest bucket, padded to its bound, which is 1 at least. Every row is placed exactly once.
    """
    slim = docs.select(F.struct(*[column(c).alias(c) for c in (carry or [])], F.col(id_col).alias("__id")).alias("row"), word_count(text_col).alias("length"), order_key(id_col).alias("key"))
    slim = settle(slim.withColumn("cell", F.greatest(cell_of(F.col("length")), F.lit(1).cast("long"))).withColumn("one", F.lit(1).cast("long")), keep=True)
    length = F.greatest("length", F.lit(1).cast("long"))
    hist = sorted(tuple(r) for r in slim.groupBy("cell").agg(F.count("*"), F.max(length), F.sum(length)).collect())
    counts = np.array([r[1] for r in hist], np.int64)
    bounds = best_bounds(np.array([r[2] for r in hist], np.int64), counts, buckets, np.array([r[3] for r in hist], np.int64))
    if not bounds:
        bounds = [1]
    edges = F.array(*[F.lit(b).cast("long") for b in bounds])
    slim = slim.withColumn("bucket", F.size(F.filter(edges, lambda b: b < F.col("length"))).cast("long"))
    slim = slim.withColumn("group", F.col("bucket").cast("string"))
    placed = with_prefix(slim, "group", "key", ["length"], "one", "nth", digits_for(int(counts.sum())))
    bound = F.element_at(edges, (F.col("bucket") + 1).cast("int"))
    room = F.greatest(F.lit(1).cast("long"), F.floor(F.lit(budget) / bound).cast("long"))
    return placed.select("row", F.col("row.__id").alias(id_col), "length", "bucket", bound.alias("bound"), F.floor(F.col("nth") / room).cast("long").alias("batch"), (F.col("nth") % room).cast("long").alias("slot"), (bound - F.col("length")).alias("padding"))


def op5_packing(spark, sf_dir: str) -> DataFrame:
    """Per document: length, bucket, bound, batch, slot, padding."""
    return pack(table(spark, sf_dir, "documents")).drop("row")


#: The histogram, the programme over it layer by layer, the way back, and the places in each bucket.
ORACLE = rf"""
with recursive d as (select doc_id, cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as length, md5(coalesce(cast(doc_id as varchar), '')) as key from documents),
m as (select *, greatest(length, 1) as m from d),
s as (select *, case when m <= {EXACT} then 1 else cast(pow(2, floor(log2(m)) - {GRID}) as bigint) end as step from m),
g as (select *, (m + step - 1) // step as units, step from s),
h as (select units * step as cell, count(*) as n, max(m) as bound, sum(m) as total from g group by 1),
r as (select 0 as i, 0 as bound, 0 as n, 0 as total union all
      select row_number() over w, bound, cast(sum(n) over w as bigint), cast(sum(total) over w as bigint) from h window w as (order by cell)),
k as (select least({BUCKETS}, max(i)) as k, max(i) as cells from r),
dp as (select 0 as j, 0 as i, cast(0 as bigint) as cost, 0 as cut
       union all
       select j + 1, i, cost, cut from (
         select j, i, cast(packed // 16777216 as bigint) as cost, cast(packed % 16777216 as bigint) as cut from (
           select dp.j, b.i, min(cast(dp.cost + b.bound * (b.n - a.n) - (b.total - a.total) as hugeint) * 16777216 + a.i) as packed
           from dp join r a on a.i = dp.i join r b on b.i > a.i, k where dp.j < k.k group by dp.j, b.i)
         union all select dp.j, 0, 0, 0 from dp, k where dp.i = 0 and dp.j < k.k)),
way as (select k.k as j, cells as i from k union all select way.j - 1, dp.cut from way join dp on dp.j = way.j and dp.i = way.i where dp.cut > 0),
bounds as (select bound, row_number() over (order by bound) - 1 as bucket from (select distinct r.bound from way join r using (i) where i > 0)),
p as (select doc_id, length, key, (select count(*) from bounds where bounds.bound < length) as bucket from d),
q as (select p.*, bound, row_number() over (partition by p.bucket order by key, length) - 1 as nth, greatest(1, {BUDGET} // bound) as room from p join bounds using (bucket))
select doc_id, length, bucket, cast(bound as bigint) as bound, cast(nth // room as bigint) as batch, cast(nth % room as bigint) as slot, cast(bound - length as bigint) as padding from q
"""
