"""File sources: FASTQ groups, SAM records, FASTA, 10x folders, cell stores, tables, logs, settings. BAM is in bam.py."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..shipping import ship
from .bam import read_bam  # noqa: F401
from .fastq import BEGIN, RECORDS, SPLIT, Range, fastq_frame, fastq_text, read_fastq_pairs, records, source_of, zipped  # noqa: F401
from .paths import open_input
from .text import ascii_only

class _Group(InputPartition):
    def __init__(self, paths: list[str], number: int):
        self.paths, self.number = paths, number


class FastaGroups(DataSource):
    """Records of several FASTA files that belong together by position. Option `files`: groups separated by ;, files of a group by commas."""

    @classmethod
    def name(cls) -> str:
        return "fasta_groups"

    def schema(self) -> str:
        return "name string, seqs array<string>, ordinal bigint, file int"

    def reader(self, schema):
        return _GroupReader(self.options)


class _GroupReader(DataSourceReader):
    def __init__(self, options):
        self.groups = [g.split(",") for g in options["files"].split(";")]

    def partitions(self):
        return [_Group(g, i) for i, g in enumerate(self.groups)]

    def read(self, part):
        rows = enumerate(zip(*map(_sequences, part.paths), strict=True))
        while together := list(islice(rows, RECORDS)):
            cols = [[x[0][0] for _, x in together], [[s for _, s in x] for _, x in together], [i for i, _ in together], [part.number] * len(together)]
            kinds = [pa.string(), pa.list_(pa.string()), pa.int64(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["name", "seqs", "ordinal", "file"])


def _sequences(path: str) -> Iterator[tuple[str, str]]:
    """(name, sequence) of FASTA or FASTQ."""
    with fastq_text(path) as f:
        first = f.read(1)
    if first == "@":
        for names, seqs, _ in records(Range(source_of(path), BEGIN, 0, None)):
            yield from zip((n.split(" ")[0] for n in names), seqs)
        return
    with fastq_text(path) as f:
        name, parts = None, []
        for line in f:
            if line.startswith(">"):
                if name is not None:
                    yield name, "".join(parts)
                name, parts = line[1:].split()[0], []
            else:
                parts.append(line.strip())
        if name is not None:
            yield name, "".join(parts)


def _is_fastq(path: str) -> bool:
    with open_input(path) as f:
        return f.read(1) == b"@"


def read_zipped(spark: SparkSession, groups: list[list[str]], split: int = SPLIT) -> DataFrame:
    """(name, seqs, ordinal, file): records of several FASTA or FASTQ files that belong together by position (barcode, UMI, mates), one row of all of
    them, never a join on made-up ids. Groups of FASTQ files alone, equally many in each, are read in parts; others are a task each."""
    if len({len(g) for g in groups}) == 1 and all(_is_fastq(p) for g in groups for p in g):
        d = zipped(spark, groups, split)
        return d.select("name", F.array(*[f"seq_{i}" for i in range(len(groups[0]))]).alias("seqs"), "ordinal", "file")
    ship(spark)
    spark.dataSource.register(FastaGroups)
    return spark.read.format("fasta_groups").option("files", ";".join(",".join(g) for g in groups)).load()


def read_sam(spark: SparkSession, path: str) -> DataFrame:
    """Alignment records of SAM text, with the columns of bam.SCHEMA; pos counts from 0."""
    f = F.split("value", "\t")
    rows = spark.read.text(path).where(~F.col("value").startswith("@"))
    tags = F.slice(f, 12, F.greatest(F.size(f) - 11, F.lit(0)))
    pairs = lambda at, n: F.map_from_entries(F.transform(tags, lambda t: F.struct(F.substring(t, 1, 2), F.substring(t, at, n))))
    name = lambda i: F.when(f[i] != "*", f[i])
    flag = f[1].cast("int")
    mate = F.when(f[6] == "=", name(2)).otherwise(name(6))
    return rows.select(
        f[0].alias("qname"), flag.alias("flag"), name(2).alias("ref"), (f[3].cast("long") - 1).alias("pos"), f[4].cast("int").alias("mapq"), f[5].alias("cigar"),
        mate.alias("mate_ref"), (f[7].cast("long") - 1).alias("mate_pos"), f[8].cast("long").alias("template"), f[9].alias("seq"), f[10].alias("qual"),
        (flag.bitwiseAND(F.lit(64)) != 0).alias("is_read1"), pairs(6, 1 << 30).alias("tags"), pairs(4, 1).alias("tag_types"),
    )


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """(name, seq); sequences may run over several lines."""
    rec = spark.read.option("lineSep", "\n>").text(path).where(F.trim("value") != "")
    head = F.split(F.regexp_replace("value", "^>", ""), "\n", 2)
    return rec.select(F.split(head[0], r"\s")[0].alias("name"), F.regexp_replace(F.coalesce(F.try_element_at(head, F.lit(2)), F.lit("")), r"\s", "").alias("seq"))


def read_tsv(spark: SparkSession, path: str, schema: str | None = None, clean: bool = False) -> DataFrame:
    """Tab-separated text with a header; clean: other bytes than ASCII become N."""
    r = spark.read.option("sep", "\t").option("header", True)
    r = r.option("encoding", "ISO-8859-1") if clean else r
    d = (r.schema(schema) if schema else r).csv(path)
    return d.select(*[ascii_only(c).alias(c) if k == "string" and clean else F.col(c) for c, k in d.dtypes])


def read_allc(spark: SparkSession, path: str) -> DataFrame:
    """Per-cytosine calls, which have no header."""
    return spark.read.option("sep", "\t").schema("chrom string, pos long, strand string, context string, mc int, cov int, sig int").csv(path)


def read_genomecov(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("sep", "\t").schema("chrom string, depth int, bases long, size long, fraction double").csv(path)


def read_tenx(spark: SparkSession, folder: str) -> DataFrame:
    """(gene, cell, value) of a matrix folder with matrix.mtx, barcodes.tsv and features.tsv, plain or gzip."""
    m = spark.read.text(f"{folder}/matrix.mtx*").where(~F.col("value").startswith("%")).select(F.transform(F.split("value", " "), lambda x: x.cast("long")).alias("v"))
    # the size line is the first that is no comment: with the comments before it, it lies at the head of the file
    m = m.withColumn("line", F.monotonically_increasing_id())
    size = m.agg(F.min("line").alias("first")).first().first
    m = m.where(F.col("line") != F.lit(size)).select(F.col("v")[0].alias("i"), F.col("v")[1].alias("j"), F.col("v")[2].alias("value"))
    names = lambda f, k: spark.read.text(f"{folder}/{f}*").coalesce(1).select(F.split("value", "\t")[0].alias(k), (F.monotonically_increasing_id() + 1).alias("n"))
    return m.join(names("features.tsv", "gene"), F.col("i") == F.col("n")).drop("n").join(names("barcodes.tsv", "cell"), F.col("j") == F.col("n")).select("gene", "cell", "value")


def read_cells(spark: SparkSession, path: str, cells: DataFrame | None = None) -> DataFrame:
    """A cell store (cell, region, mc, cov, ...) of write_cells, of all or of the given cells (cell) only."""
    d = spark.read.parquet(path)
    return d if cells is None else d.join(cells.select("cell").distinct(), "cell", "left_semi")


def read_summary(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("multiLine", True).json(path)


def log_metrics(lines: DataFrame, patterns: dict[str, str]) -> DataFrame:
    """One row: of each named pattern the number that its group caught last in text order; thousands commas and percent signs removed."""
    value = lambda p: F.regexp_replace(F.regexp_extract("value", p, 1), "[,%]", "")
    return lines.agg(*[F.max(F.when(F.col("value").rlike(p), value(p).cast("double"))).alias(k) for k, p in patterns.items()])


#: The labels that aligner logs put before their figures.
STAR_LOG = {"input_reads": r"Number of input reads \|\s+(\d+)", "unique": r"Uniquely mapped reads number \|\s+(\d+)", "multi": r"Number of reads mapped to multiple loci \|\s+(\d+)", "too_many": r"Number of reads mapped to too many loci \|\s+(\d+)"}
QUALIMAP_LOG = {"exonic": r"exonic =\s+([\d,]+)", "intronic": r"intronic =\s+([\d,]+)", "intergenic": r"intergenic =\s+([\d,]+)"}
BISMARK_LOG = {"analysed": r"Sequence pairs analysed in total:\s+(\d+)", "unique": r"unique best hit:\s+(\d+)", "efficiency": r"Mapping efficiency:\s+([\d.]+)%"}


def read_settings(text: str) -> dict[str, str]:
    """key:value lines; blank lines and comments are skipped."""
    rows = (x.split(":", 1) for x in text.splitlines() if ":" in x and not x.lstrip().startswith("#"))
    return {k.strip(): v.strip() for k, v in rows}
