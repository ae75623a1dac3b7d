"""Mixing sources to target weights along a training curriculum."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import column, digits_for, order_key, settle, table, tidy, with_prefix, word_count

LIMIT = 3  # times that a source may be passed over


def targets(sizes: DataFrame) -> DataFrame:
    """(src, source_size, target, rank) from (src, source_size): one row a source.

    Sources weigh 1, 2, 3, repeating, in code-point order with null last. The sum of all sizes is shared by
    weight; a source's target stops at LIMIT times its size and what is over is shared again by weight. That
    is water-filling: in order of LIMIT * size / weight the first sources are full, the rest get one common
    amount per weight. The table has a row for each source, so the single ordered pass is small.
    """
    named = Window.orderBy(F.col("src").asc_nulls_last())
    everything = Window.partitionBy()
    room = F.lit(LIMIT) * F.col("source_size")
    t = sizes.withColumn("rank", F.row_number().over(named) - 1).withColumn("weight", F.col("rank") % 3 + 1)
    t = t.withColumn("total", F.sum("source_size").over(everything))
    filling = Window.orderBy((room / F.col("weight")).asc(), F.col("rank").asc())
    t = t.withColumn("nth", F.row_number().over(filling))
    t = t.withColumn("full", F.coalesce(F.sum(room).over(filling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    t = t.withColumn("open", F.sum("weight").over(filling.rowsBetween(0, Window.unboundedFollowing)))
    t = t.withColumn("level", (F.col("total") - F.col("full")).cast("double") / F.col("open"))
    fits = F.when(F.col("level") * F.col("weight") <= room.cast("double"), F.col("nth"))
    t = t.withColumn("first", F.min(fits).over(everything))
    t = t.withColumn("level", F.max(F.when(F.col("nth") == F.col("first"), F.col("level"))).over(everything))
    target = F.when(F.col("nth") < F.col("first"), room.cast("double")).otherwise(F.col("level") * F.col("weight"))
    return t.select("src", "source_size", target.alias("target"), "rank")


def when_reached(share: Column, slope: Column) -> Column:
    """The time t in [0, 1] at which a source has served `share` of its demand.

    Its weight at time t is 1 + slope * (2t - 1), whose integral is t + slope * (t*t - t).
    """
    b = 1 - slope
    root = F.sqrt(F.greatest(b * b + 4 * slope * share, F.lit(0.0)))
    return F.when(F.abs(slope) < 1e-9, share).otherwise(2 * share / F.greatest(b + root, F.lit(1e-12)))


@tidy
def curriculum(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", carry: list[str] | None = None, slope: float = 0.5) -> DataFrame:
    """One row per document of `docs`: where and how often the mix takes it.

    Columns: those of `carry` (struct `row`), id, size (words), source_size, target (its source's), taken (words
    the mix takes, repeats counted) and passes: array of (pass, words, position), position in [0, 1) of the
    training run. A source's documents lie in a fixed pseudo-random order; its demand runs through that order,
    from the top again after each pass, up to floor(target) words. The cumulative demand is inverted to the
    time it falls due. Sources of rank 0, 1, 2 (modulo 3) fall, hold and rise over the run by `slope`.

    A null source is a source of its own, the last. Documents without words are taken with 0 words and have no
    passes. Repeated rows are documents of their own. No document is taken more than LIMIT times.
    """
    named = F.coalesce(F.concat(F.lit("s"), F.col(source_col).cast("string")), F.lit("null"))
    rows_ = docs.select(F.struct(*[column(c).alias(c) for c in (carry or [])], F.col(id_col).alias("__id")).alias("row"), F.col(source_col).cast("string").alias("src"), named.alias("group"), word_count(text_col).alias("size"), order_key(id_col).alias("key"))
    # columns to carry, maybe texts, are not written once more: the sums come from the slim columns, the rows are read again
    slim = settle(rows_ if not carry else rows_.drop("row"), keep=True)
    rows_ = rows_ if carry else slim
    sums = slim.groupBy("group").agg(F.first("src").alias("src"), F.sum("size").cast("long").alias("source_size"), F.count("*").alias("n"))
    sums = settle(sums, keep=True)
    rows = sums.agg(F.sum("n")).first()[0] or 0
    plan = targets(sums).withColumn("group", F.coalesce(F.concat(F.lit("s"), F.col("src")), F.lit("null"))).drop("src")
    placed = with_prefix(rows_.drop("src"), "group", "key", ["size"], "size", "before", digits_for(rows), slim).join(F.broadcast(plan) if sums.count() <= 10_000 else plan, "group")

    size, whole, start = F.col("size"), F.col("source_size"), F.col("before")
    asked = F.floor(F.col("target")).cast("long")
    cut = lambda p: F.greatest(F.lit(0).cast("long"), F.least(size, asked - (p.cast("long") * whole + start)))
    slopes = F.element_at(F.array(F.lit(-slope), F.lit(0.0), F.lit(slope)), F.col("rank") % 3 + 1)
    due = lambda p: when_reached((p.cast("long") * whole + start) / F.greatest(F.col("target"), F.lit(1e-12)), slopes)
    passes = F.transform(F.sequence(F.lit(0), F.lit(LIMIT - 1)), lambda p: F.struct(p.alias("pass"), cut(p).alias("words"), due(p).alias("position")))
    placed = placed.withColumn("passes", F.filter(passes, lambda p: p["words"] > 0))
    taken = F.aggregate("passes", F.lit(0).cast("long"), lambda a, p: a + p["words"])
    return placed.select("row", F.col("row.__id").alias(id_col), "size", "source_size", "target", taken.alias("taken"), "passes")


def schedule(docs: DataFrame, columns: list[str], id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The training order: a row of `columns` for each time that a document is due, range-sorted by position.

    Rows are whole: of a pass that `taken` cuts short the row has the full text, so a source's rows hold more words than its target by
    less than the words of one document. Documents without words are never due. Null sources are one source, repeated rows are
    documents of their own, ties in position come in any order.
    """
    mixed = curriculum(docs, id_col, text_col, source_col, carry=columns)
    due = mixed.select("row", F.explode("passes").alias("due"))
    return due.repartitionByRange(F.col("due.position")).sortWithinPartitions("due.position").select(*[column(c, "row").alias(c) for c in columns])


def op3_mixing(spark, sf_dir: str) -> DataFrame:
    """Per document: size, source_size, target, taken, and the position at which it is first due (null: never)."""
    mixed = curriculum(table(spark, sf_dir, "documents"))
    out = mixed.select("doc_id", "size", "source_size", "target", "taken", F.round(F.try_element_at("passes", F.lit(1))["position"], 9).alias("position"))
    return out.repartitionByRange("position", order_key("doc_id")).sortWithinPartitions("position")


ORACLE = r"""
with d as (
  select doc_id, source, md5(cast(doc_id as varchar)) k,
         cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) size from documents),
s as (select source, cast(sum(size) as bigint) source_size from d group by source),
w as (select *, row_number() over (order by source asc nulls last) - 1 as rnk from s),
x as (select *, rnk % 3 + 1 as weight, cast(sum(source_size) over () as bigint) total from w),
f as (select *, row_number() over o as nth,
             coalesce(sum(3 * source_size) over (o rows between unbounded preceding and 1 preceding), 0) as filled,
             sum(weight) over (o rows between current row and unbounded following) as opened
      from x window o as (order by cast(3 * source_size as double) / weight, rnk)),
g as (select *, cast(total - filled as double) / cast(opened as double) as level from f),
h as (select *, min(case when level * weight <= cast(3 * source_size as double) then nth end) over () as first from g),
i as (select *, max(case when nth = first then level end) over () as lvl from h),
t as (select source, source_size, rnk,
             case when nth < first then cast(3 * source_size as double) else lvl * weight end as target from i),
b as (select d.*, coalesce(cast(sum(size) over (partition by source order by k, size rows between unbounded preceding and 1 preceding) as bigint), 0) as before from d),
p as (select b.doc_id, b.size, t.source_size, t.target, t.rnk, b.before,
             list_transform([0, 1, 2], lambda q: greatest(0, least(b.size, cast(floor(t.target) as bigint) - (q * t.source_size + b.before)))) as cuts
      from b join t on b.source is not distinct from t.source)
select doc_id, size, source_size, target, cast(list_sum(cuts) as bigint) as taken,
       round(case when cuts[1] <= 0 then null
             when rnk % 3 = 1 then before / greatest(target, 1e-12)
             else (with_slope.v) end, 9) as position
from p, lateral (select case when rnk % 3 = 0
    then 2 * (before / greatest(target, 1e-12)) / greatest(1.5 + sqrt(greatest(2.25 - 2 * before / greatest(target, 1e-12), 0)), 1e-12)
    else 2 * (before / greatest(target, 1e-12)) / greatest(0.5 + sqrt(greatest(0.25 + 2 * before / greatest(target, 1e-12), 0)), 1e-12) end as v) as with_slope
"""
