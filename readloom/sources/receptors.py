"""Receptor annotation text: contig headers and pileups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def parse_hit(hit: Column) -> Column:
    """gene(len):(s-e):(..):sim -> struct(gene without allele, start, end)."""
    gene = F.regexp_extract(hit, r"^([^(*]*)", 1)
    at = lambda g: F.regexp_extract(hit, r":\((\d+)-(\d+)\)", g)
    num = lambda c: F.when(c != "", c.cast("int"))
    return F.struct(gene.alias("gene"), num(at(1)).alias("start"), num(at(2)).alias("end"))


def annotation_headers(lines: DataFrame) -> DataFrame:
    """`>id len cov V D J C` header lines (value) -> id, length, coverage and arrays of hits; `*` gives an empty array."""
    f = F.split(F.substring("value", 2, 1 << 30), " ")
    hits = lambda i: F.transform(F.filter(F.split(f[i], ","), lambda x: (x != "*") & (x != "")), parse_hit)
    return lines.where(F.col("value").startswith(">")).select(f[0].alias("id"), f[1].cast("int").alias("length"), f[2].cast("double").alias("coverage"), hits(3).alias("v"), hits(4).alias("d"), hits(5).alias("j"), hits(6).alias("c"))


def read_pileups(spark: SparkSession, path: str) -> DataFrame:
    """pileups of a file of six-line records, each of which begins with a line that starts with >; records never cross tasks."""
    rec = spark.read.option("lineSep", "\n>").text(path).where(F.trim("value") != "")
    return pileups(rec.select(F.regexp_replace("value", "^>", "").alias("value")))


def pileups(records: DataFrame) -> DataFrame:
    """Six-line contig records (value: the lines joined by newlines) -> contig and four count vectors."""
    line = F.split("value", "\n")
    vec = lambda i: F.transform(F.split(F.trim(line[i]), r"\s+"), lambda x: x.cast("int"))
    return records.select(F.regexp_extract(line[0], r"^>?(\S+)", 1).alias("contig"), vec(2).alias("a"), vec(3).alias("c"), vec(4).alias("g"), vec(5).alias("t"))


def contig_totals(p: DataFrame) -> DataFrame:
    """Reads of a contig: its first column sum plus every increase of the column sums along it."""
    add = lambda x, y: F.zip_with(x, y, lambda a, b: a + b)
    total = add(add(F.col("a"), F.col("c")), add(F.col("g"), F.col("t")))
    step = F.aggregate(total, F.struct(F.lit(0).alias("last"), F.lit(0).alias("sum")), lambda s, x: F.struct(x.alias("last"), (s["sum"] + F.greatest(x - s["last"], F.lit(0))).alias("sum")), lambda s: s["sum"])
    return p.select("contig", step.alias("reads"))
