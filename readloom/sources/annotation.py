"""Gene annotation text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

FIELDS = ["chrom", "source", "feature", "start", "end", "score", "strand", "frame", "attributes"]
#: Mitochondrial chromosome names, prefixes that mark such genes, long non-coding biotypes.
MITO, MITO_PREFIX = ["chrM", "MT", "mt"], "^(MT|mt|Mt)-"
LONG_NONCODING = ["lincRNA", "antisense", "lncRNA"]


def read_gtf(spark: SparkSession, path: str) -> DataFrame:
    """The nine fields and `line`, the order of lines inside the files; comments are skipped."""
    raw = spark.read.text(path).withColumn("line", F.monotonically_increasing_id()).where(~F.col("value").startswith("#"))
    f = F.split("value", "\t")
    d = raw.select("line", *[f[i].alias(c) for i, c in enumerate(FIELDS)])
    return d.withColumn("start", F.col("start").cast("long")).withColumn("end", F.col("end").cast("long"))


def attribute(name: str, col: str = "attributes") -> Column:
    """The value of an attribute, null if it is absent."""
    v = F.regexp_extract(col, rf'(?:^|[;\s]){name} "?([^";]*)"?', 1)
    return F.when(v != "", v)


def attributes(col: str = "attributes") -> Column:
    """All attributes as a map, quotes removed; of a repeated one the first."""
    key = F.regexp_extract_all(col, F.lit(r'(\w+) "?([^";]*)"?'), F.lit(1))
    value = F.regexp_extract_all(col, F.lit(r'(\w+) "?([^";]*)"?'), F.lit(2))
    first = F.filter(F.arrays_zip(key.alias("k"), value.alias("v"), F.sequence(F.lit(1), F.size(key)).alias("i")), lambda x: F.array_position(key, x["k"]) == x["i"])
    return F.when(F.size(key) > 0, F.map_from_entries(F.transform(first, lambda x: F.struct(x["k"], x["v"])))).otherwise(F.create_map().cast("map<string,string>"))


def gene_symbols(gtf: DataFrame) -> DataFrame:
    """(gene_id, symbol, ordinal) in the order of first sight; MT- is put before symbols on the mitochondrion without it."""
    g = gtf.where(F.col("feature").isin("gene", "transcript", "exon")).select("line", "chrom", attribute("gene_id").alias("gene_id"), attribute("gene_name").alias("name")).where("gene_id is not null")
    g = g.groupBy("gene_id").agg(F.min("line").alias("first"), F.min_by("chrom", "line").alias("chrom"), F.min_by(F.coalesce("name", "gene_id"), "line").alias("name"))
    symbol = F.when(F.col("chrom").isin(*MITO) & ~F.col("name").rlike(MITO_PREFIX), F.concat(F.lit("MT-"), "name")).otherwise(F.col("name"))
    return g.select("gene_id", symbol.alias("symbol"), F.row_number().over(Window.orderBy("first")).alias("ordinal"))


def biotypes(gtf: DataFrame) -> DataFrame:
    """(gene_id, kind) of gene rows with a biotype: lnc or coding."""
    b = F.coalesce(attribute("gene_type"), attribute("gene_biotype"))
    return gtf.where((F.col("feature") == "gene")).select(attribute("gene_id").alias("gene_id"), b.alias("b")).where("gene_id is not null and b is not null").select("gene_id", F.when(F.col("b").isin(*LONG_NONCODING), "lnc").otherwise("coding").alias("kind"))


def gene_blocks(gtf: DataFrame, order: str = "line", within: str = "chrom") -> DataFrame:
    """Adds block: how many gene rows have come up to this row on its chromosome."""
    w = Window.partitionBy(within).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return gtf.withColumn("block", F.sum((F.col("feature") == "gene").cast("int")).over(w))


def intervals(gtf: DataFrame, features: list[str]) -> DataFrame:
    """(chrom, start, end, gene_id, transcript_id, exon_id, type), 0-based and half-open, zero length widened by one."""
    d = gtf.where(F.col("feature").isin(*features))
    return d.select("chrom", (F.col("start") - 1).alias("start"), F.greatest("end", F.col("start")).alias("end"), attribute("gene_id").alias("gene_id"), attribute("transcript_id").alias("transcript_id"), attribute("exon_id").alias("exon_id"), F.col("feature").alias("type"))


def exons_from_cds(blocks: DataFrame, keys: list[str]) -> DataFrame:
    """All rows, and for each CDS row of a block without exons a copy that says exon."""
    has = F.max((F.col("feature") == "exon").cast("int")).over(Window.partitionBy(*keys))
    copies = F.when((has == 0) & (F.col("feature") == "CDS"), F.array(F.lit("CDS"), F.lit("exon"))).otherwise(F.array("feature"))
    return blocks.withColumn("__c", copies).withColumn("feature", F.explode("__c")).drop("__c")


def bed12(rows: DataFrame) -> DataFrame:
    """(tx, chrom, strand, feature, start, end, line: a number or whatever sorts in line order) 1-based closed -> one BED12 row a transcript that has exon or miRNA rows, these being its blocks.

    The thick part goes from the start codon to the stop codon, on the - strand from the stop codon to the start codon; where one of them is
    missing it reaches to that end of the transcript, so that it is the whole one without either. Of several codon rows the last line counts,
    chromosome and strand are those of the first block in line order, and the transcript ends with the block that begins last.
    """
    block = F.col("feature").isin("exon", "miRNA")
    first = lambda c: F.min_by(c, F.when(block, F.col("line")))
    last = lambda c, feature: F.max_by(c, F.when(F.col("feature") == feature, F.col("line")))
    ex = F.sort_array(F.collect_list(F.when(block, F.struct("start", "line", "end"))))
    d = rows.groupBy("tx").agg(first("chrom").alias("chrom"), first("strand").alias("strand"), ex.alias("ex"), last("start", "start_codon").alias("up"), last("end", "stop_codon").alias("down")).where(F.size("ex") > 0)
    d = d.withColumn("start", F.col("ex")[0]["start"] - 1).withColumn("end", F.element_at("ex", -1)["end"])
    back = F.col("strand") == "-"
    thick_start = F.coalesce(F.when(back, F.col("down") - 2).otherwise(F.col("up")) - 1, F.col("start"))
    thick_end = F.coalesce(F.when(back, F.col("up") + 2).otherwise(F.col("down")), F.col("end"))
    text = lambda f: F.array_join(F.transform("ex", lambda e: f(e).cast("string")), ",")
    return d.select("chrom", "start", "end", F.col("tx"), "strand", thick_start.alias("thick_start"), thick_end.alias("thick_end"), F.size("ex").alias("blocks"), text(lambda e: e["end"] - e["start"] + 1).alias("sizes"), text(lambda e: e["start"] - 1 - F.col("start")).alias("starts"))


def unquoted_ids(col: str = "attributes") -> Column:
    """The attributes with the quotes around gene_id removed."""
    return F.regexp_replace(col, 'gene_id "([^"]*)"', "gene_id $1")


def with_gene_ids(gtf: DataFrame, other: str = "gene") -> DataFrame:
    """Attributes without a gene_id get one in front, from another attribute if they have that."""
    mine, spare = attribute("gene_id"), attribute(other)
    return gtf.withColumn("attributes", F.when(mine.isNull() & spare.isNotNull(), F.concat(F.lit('gene_id "'), spare, F.lit('"; '), "attributes")).otherwise(F.col("attributes")))


def counted_feature(gtf: DataFrame, wanted: str = "transcript", fallback: str = "gene") -> DataFrame:
    """One row: the feature that reads are counted on, the fallback if the wanted one is absent, and whether there are exons at all."""
    has = lambda f: F.coalesce(F.max((F.col("feature") == f).cast("int")), F.lit(0)) > 0
    return gtf.agg(F.when(has(wanted), wanted).otherwise(fallback).alias("feature"), has("exon").alias("has_exon"))


def feature_stats(gtf: DataFrame, by: list[str] = ("feature", "chrom")) -> DataFrame:
    """(by, n): rows of each kind, fewest first."""
    return gtf.groupBy(*by).agg(F.count("*").alias("n")).orderBy("n")


def blocks_of_biotypes(blocks: DataFrame, biotypes_: list[str], keys: list[str] = ("chrom", "block")) -> DataFrame:
    """The rows of blocks (see gene_blocks) whose gene row has one of the biotypes."""
    b = F.coalesce(attribute("gene_type"), attribute("gene_biotype"))
    good = blocks.where((F.col("feature") == "gene") & b.isin(*biotypes_)).select(*keys).distinct()
    return blocks.join(good, list(keys), "left_semi")


def problems(gtf: DataFrame) -> DataFrame:
    """(gene_id, problem): ids of several gene rows, and gene rows without one."""
    g = gtf.where("feature = 'gene'").select(attribute("gene_id").alias("gene_id"))
    return g.groupBy("gene_id").agg(F.count("*").alias("n")).where("gene_id is null or n > 1").select("gene_id", F.when(F.col("gene_id").isNull(), "missing").otherwise("duplicate").alias("problem"))
