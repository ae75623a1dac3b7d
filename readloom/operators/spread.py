"""Joins and quantiles whose hot keys and large groups no single task holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..scratch import settle, tidy
from .ranking import PART, PLACE, in_ranges


def join_spread(left: DataFrame, right: DataFrame, on: str, weight: str, total: int, how: str = "inner") -> DataFrame:
    """left joined with right, which has one row a key and in `weight` how many rows of left hold it, of `total` rows.

    Keys that hold more than a thousandth of all rows are fewer than a thousand, so their rows are broadcast; what is
    left to be shuffled has no hot key. `weight` is dropped.
    """
    hot = F.col(weight) * 1000 > total
    few = F.broadcast(right.where(hot).drop(weight))
    rest = left.join(few.select(on), on, "left_anti")
    return left.join(few, on).unionByName(rest.join(right.where(~hot).drop(weight), on, how), allowMissingColumns=True)


@tidy
def quantiles(df: DataFrame, by: str, value: str, at: list[float]) -> DataFrame:
    """(by, i, value): for each group the quantiles at[0], at[1], ... of its values that are not null, linear between neighbours.

    All rows are sorted once over all tasks by group and value, in ranges that may cut a group; counts per (group, range) tell in which range
    and at which place the rows of a quantile lie, and an equality join fetches them. No task holds a group or its distinct values.
    """
    d = in_ranges(df.select(F.col(by).alias("g"), F.col(value).cast("double").alias("v")).where("v is not null"), ["g", "v"])
    per = d.groupBy("g", PART).agg(F.count("*").alias("n"), F.min(PLACE).alias("first"))
    along = Window.partitionBy("g").orderBy(PART)  # a row for each range that a group touches
    per = settle(per.withColumn("before", F.sum("n").over(along) - F.col("n")))
    size = per.groupBy("g").agg(F.sum("n").alias("size"))
    spots = F.posexplode(F.transform(F.array(*[F.lit(float(q)) for q in at]), lambda q: q * (F.col("size") - 1))).alias("i", "spot")
    asked = size.select("g", spots).withColumn("low", F.floor("spot")).withColumn("share", F.col("spot") - F.col("low"))
    asked = asked.withColumn("rank", F.explode(F.array_distinct(F.array("low", F.ceil("spot")))))
    found = asked.join(per, "g").where((F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("before") + F.col("n")))
    found = found.select("g", "i", "share", "low", "rank", PART, (F.col("first") + F.col("rank") - F.col("before")).alias(PLACE))
    got = found.join(d.select(PART, PLACE, "v"), [PART, PLACE])
    weight = F.when(F.col("rank") == F.col("low"), 1 - F.col("share")).otherwise(F.col("share"))
    out = got.groupBy("g", "i").agg(F.sum(F.col("v") * weight).alias("value"))
    return settle(out.select(F.col("g").alias(by), "i", "value"), keep=True)
