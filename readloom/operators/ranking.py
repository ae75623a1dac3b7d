"""Global ranks and running sums without a global window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..scratch import settle, tidy

PART, PLACE = "__part", "__place"


def in_ranges(df: DataFrame, order: list) -> DataFrame:
    """Adds PART and PLACE: rows are sorted over all tasks, each holding a range of the order; PART numbers the ranges, PLACE rows within one.

    The table is settled, so that both stay as they are. Rows equal in all of `order` lie in one range.
    """
    d = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return settle(d.withColumn(PART, F.spark_partition_id()).withColumn(PLACE, F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))), keep=True)


@tidy
def _counted(df: DataFrame, order: list, name: str, kind: str) -> DataFrame:
    d = in_ranges(df, order)
    per = d.groupBy(PART).agg(F.count("*").alias("__n"))  # a row for each range
    lead = F.coalesce(F.sum("__n").over(Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    per = F.broadcast(per.select(PART, lead.alias("__lead")))
    return d.join(per, PART).withColumn(name, (F.col("__lead") + F.col(PLACE) + 1).cast(kind)).drop("__lead", PART, PLACE)


def ordinals(df: DataFrame, order: str | list, name: str, kind: str = "long") -> DataFrame:
    """Adds 1, 2, ... in the order of the columns."""
    return _counted(df, [order] if isinstance(order, str) else list(order), name, kind)


def ranked(df: DataFrame, value: str, ties: list, name: str) -> DataFrame:
    """Adds a rank from 1 by descending value, then by ties.

    Rows are sorted in ranges of value and ties together, so a value that most rows have (one UMI, say) is spread over several
    tasks; what is left to add up is a row for each range.
    """
    return ordinals(df, [F.desc(value), *ties], name, "int")


@tidy
def benjamini_hochberg(df: DataFrame, p: str, order: list[str]) -> DataFrame:
    """Adds q: p * n / rank, made monotone from the largest p down, 1 at most. A null p has no q and does not count.

    Ranks come from counts per distinct p, in ranges: each range knows how many lie before it and the least q behind it.
    """
    d = in_ranges(df.where(F.col(p).isNotNull()).groupBy(p).agg(F.count("*").alias("__k")), [p])
    up, ranges = Window.partitionBy(PART).orderBy(PLACE), Window.orderBy(PART)
    per = d.groupBy(PART).agg(F.sum("__k").alias("__s"))
    per = per.select(PART, F.coalesce(F.sum("__s").over(ranges.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__lead"), F.sum("__s").over(Window.partitionBy()).alias("__total"))
    d = d.join(F.broadcast(per), PART)
    rank = F.col("__lead") + F.sum("__k").over(up.rowsBetween(Window.unboundedPreceding, 0))
    d = settle(d.withColumn("__raw", F.col(p) * F.col("__total") / rank).drop("__lead", "__total", "__k"), keep=True)
    behind = d.groupBy(PART).agg(F.min("__raw").alias("__m")).select(PART, F.min("__m").over(ranges.rowsBetween(1, Window.unboundedFollowing)).alias("__behind"))
    least = F.least(F.min("__raw").over(up.rowsBetween(0, Window.unboundedFollowing)), F.col("__behind"), F.lit(1.0))
    q = d.join(F.broadcast(behind), PART).select(p, least.alias("q"))
    return df.join(q, p, "left")
