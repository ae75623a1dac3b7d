"""Stand-ins: the shapes of sequencing data, read from the general tables; in DataFrames and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.seq import dna

QUERIES: dict = {}
ORACLE: dict = {}


def query(name: str, sql: str | None = None):
    """Registers a query and its SQL, once for each name."""
    if name in QUERIES:
        raise ValueError(f"there is a query {name} already")

    def put(f):
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f

    return put


def t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def reads(spark: SparkSession, sf: str) -> DataFrame:
    e = t(spark, sf, "events")
    return e.select("event_id", F.col("user_id").cast("string").alias("cell"), F.col("event_type").alias("gene"), F.get_json_object("props", "$.k").alias("umi"), dna(F.col("event_id")).alias("seq"), "value", F.to_date("ts").alias("day"))


def D(x: str) -> str:
    return f"translate(md5(cast({x} as varchar)), '0123456789abcdef', 'ACGTACGTACGTACGT')"


READS = f"reads as (select event_id, cast(user_id as varchar) as cell, event_type as gene, json_extract_string(props, '$.k') as umi, {D('event_id')} as seq, value, cast(ts as date) as day from events)"


def whitelist(spark: SparkSession, sf: str, n: int = 8) -> DataFrame:
    return t(spark, sf, "part").select(F.substring(dna(F.col("p_partkey")), 1, n).alias("barcode")).distinct()


WHITE = f"white as (select distinct substr({D('p_partkey')}, 1, 8) as barcode from part)"


def alignments(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as alignment records: qname, ref, pos, length, mapq."""
    li = t(spark, sf, "lineitem")
    return li.select(F.col("l_orderkey").alias("qname"), F.concat(F.lit("chr"), F.col("l_returnflag")).alias("ref"), F.datediff(F.to_date("l_shipdate"), F.lit("1992-01-01").cast("date")).cast("long").alias("pos"), F.col("l_quantity").cast("long").alias("len"), F.col("l_linenumber").alias("nth"), F.col("l_suppkey").alias("supp"), F.col("l_partkey").alias("part"), F.col("l_linestatus").alias("strand"), F.round(F.col("l_discount") * 100).cast("long").alias("mc"), F.col("l_quantity").cast("long").alias("cov"))


ALN = "aln as (select l_orderkey as qname, 'chr' || l_returnflag as ref, cast(date_diff('day', date '1992-01-01', cast(l_shipdate as date)) as bigint) as pos, cast(floor(l_quantity) as bigint) as len, l_linenumber as nth, l_suppkey as supp, l_partkey as part, l_linestatus as strand, cast(round(l_discount * 100) as bigint) as mc, cast(floor(l_quantity) as bigint) as cov from lineitem)"
