"""Writers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators.ranking import ordinals
from .scratch import _file_system, settle, tidy
from .sources.fastq import SPLIT, read_fastq_pairs


def indexed(df: DataFrame, col: str, name: str) -> DataFrame:
    """(col, name): the distinct values, numbered from 1 in order."""
    return ordinals(df.select(col).distinct(), col, name)


def long_matrix(df: DataFrame, row: str, col: str, value: str) -> DataFrame:
    """(gene_idx, cell_idx, value) with 1-based indices in name order."""
    return df.join(indexed(df, row, "gene_idx"), row).join(indexed(df, col, "cell_idx"), col).select("gene_idx", "cell_idx", F.col(value).alias("value"))


def write_matrix_market(df: DataFrame, row: str, col: str, value: str, path: str, parts: int | None = None) -> None:
    """matrix (MatrixMarket lines in column order), features and barcodes below `path`, as gzip text.

    The matrix is written in `parts` files, by default as many as shuffle partitions, whose lines follow each other in name order:
    gzip files joined end to end are one gzip file. The first holds the two header lines. The name lists are one file each.
    """
    m = long_matrix(df, row, col, value)
    n = m.agg(F.max("gene_idx"), F.max("cell_idx"), F.count("*")).first()
    head = df.sparkSession.createDataFrame([(0, 0, "%%MatrixMarket matrix coordinate integer general"), (0, 1, f"{n[0] or 0} {n[1] or 0} {n[2]}")], "c long, r long, line string")
    body = m.select(F.col("cell_idx").alias("c"), F.col("gene_idx").alias("r"), F.concat_ws(" ", "gene_idx", "cell_idx", "value").alias("line"))
    both = head.unionByName(body)
    ranged = both.repartitionByRange(parts, "c", "r") if parts else both.repartitionByRange("c", "r")
    ranged.sortWithinPartitions("c", "r").select("line").write.option("compression", "gzip").text(f"{path}/matrix")
    for c, name in ((row, "features"), (col, "barcodes")):
        df.select(F.col(c).cast("string")).distinct().coalesce(1).sortWithinPartitions(c).write.option("compression", "gzip").text(f"{path}/{name}")


def write_fastq(reads: DataFrame, path: str, name: str = "name", seq: str = "seq", qual: str = "qual", order: list[str] | None = None) -> None:
    """FASTQ text in the order of the reads, by default that of their files: (file, ordinal), or ordinal where there is no file column. Files follow each other in name order.

    The order is total, so that two mates written from the same rows keep in step.
    """
    order = order or [c for c in ("file", "ordinal") if c in reads.columns]
    rec = F.concat(F.lit("@"), F.col(name), F.lit("\n"), F.col(seq), F.lit("\n+\n"), F.col(qual))
    reads.orderBy(*order).select(rec).write.option("compression", "gzip").text(path)


def write_pairs(reads: DataFrame, path: str, one: tuple[str, str, str], two: tuple[str, str, str], order: list[str] | None = None) -> None:
    """Both mates, given as (name, sequence, quality) columns, below `path`/1 and `path`/2, record by record in step and file by file of equal cuts."""
    order = order or [c for c in ("file", "ordinal") if c in reads.columns]
    ranged = reads.repartitionByRange(*order).sortWithinPartitions(*order)
    for i, (name, seq, qual) in enumerate((one, two), 1):
        rec = F.concat(F.lit("@"), F.col(name), F.lit("\n"), F.col(seq), F.lit("\n+\n"), F.col(qual))
        ranged.select(rec).write.option("compression", "gzip").text(f"{path}/{i}")


@tidy
def process_pairs(spark: SparkSession, r1: list[str], r2: list[str], worker: Callable[[DataFrame], DataFrame], path: str, split: int = SPLIT) -> DataFrame:
    """Runs a worker over the read pairs of files and returns (status, reads), how many reads got each status.

    worker: a function from the pairs (see sources.fastq.PAIR) to rows that keep these columns and add `status`, such as operators.barcodes.assign; its rows of
    status valid are written below `path` and those of status multi below `path`-multi, both mates in step and in file order. It may be any
    composition of Spark operations, Arrow or pandas functions included; it runs once over each part of the files.
    """
    done = settle(worker(read_fastq_pairs(spark, r1, r2, split)))
    for status, where in (("valid", path), ("multi", f"{path}-multi")):
        write_pairs(done.where(F.col("status") == status), where, ("name", "r1_seq", "r1_qual"), ("name", "r2_seq", "r2_qual"))
    return settle(done.groupBy("status").agg(F.count("*").alias("reads")), keep=True)


def multi_candidates(assigned: DataFrame, name: str = "name") -> DataFrame:
    """Reads of status multi (see operators.barcodes.assign) with the header that the later rescue takes apart: raw barcode, candidates joined by :, UMI and name."""
    header = F.concat_ws("_", "raw", F.array_join("candidates", ":"), "umi", name)
    return assigned.where("status = 'multi'").withColumn("header", header)


def write_fasta(df: DataFrame, path: str, name: str = "name", seq: str = "seq") -> None:
    df.select(F.concat(F.lit(">"), F.col(name), F.lit("\n"), F.col(seq))).write.text(path)


def write_tsv(df: DataFrame, path: str) -> None:
    df.write.option("sep", "\t").option("header", True).csv(path)


def write_by_barcode(df: DataFrame, path: str, barcode: str = "barcode") -> None:
    """One folder per barcode; rows are first brought together by barcode so that each folder has few files."""
    df.repartition(barcode).write.partitionBy(barcode).parquet(path)


def write_cells(df: DataFrame, path: str, regions: str = "region") -> None:
    """A cell store, (cell, region, mc, cov, ...), sorted by cell in ranges, so that reading some cells skips most of it."""
    df.repartitionByRange("cell", regions).sortWithinPartitions("cell", regions).write.parquet(path)


def write_embedding(df: DataFrame, path: str, cell: str = "cell") -> None:
    """Coordinates and clusters of cells as Parquet, in cell order."""
    df.repartitionByRange(cell).sortWithinPartitions(cell).write.parquet(path)


def sparse_columns(df: DataFrame, row: str, col: str, value: str) -> DataFrame:
    """(cell_idx, ptr, index, values): a column of a compressed sparse matrix to a row: where it begins, its row numbers and values, all from 0."""
    m = long_matrix(df, row, col, value)
    entries = F.sort_array(F.collect_list(F.struct((F.col("gene_idx") - 1).alias("i"), F.col("value").alias("v"))))  # the genes of one cell
    per = m.groupBy((F.col("cell_idx") - 1).alias("cell_idx")).agg(entries.alias("e"), F.count("*").alias("n"))
    from .operators.counts import running

    d = running(per, "cell_idx", "n", "ptr")
    return d.select("cell_idx", "ptr", F.transform("e", lambda x: x["i"]).alias("index"), F.transform("e", lambda x: x["v"]).alias("values"))


def quoted(col: str | Column) -> Column:
    """A CSV cell: text with a comma, a quote or a line end in quotes; null is empty."""
    v = F.coalesce((F.col(col) if isinstance(col, str) else col).cast("string"), F.lit(""))
    return F.when(v.rlike('[,"\n]'), F.concat(F.lit('"'), F.replace(v, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(v)


def metrics_row(df: DataFrame) -> DataFrame:
    """One-row metrics as a CSV line; values with commas are quoted."""
    return df.select(F.concat_ws(",", *[quoted(c) for c in df.columns]).alias("line"))


def metrics_table(df: DataFrame) -> DataFrame:
    """Two lines: names and values."""
    head = ",".join(f'"{c}"' if "," in c else c for c in df.columns)
    return df.select(F.explode(F.array(F.lit(head), F.concat_ws(",", *[quoted(c) for c in df.columns]))).alias("line"))


def json_section(df: DataFrame, name: str) -> DataFrame:
    """All rows as one JSON object {name: [...]}, ordered by the first column; for tables that a page shows."""
    return df.agg(F.to_json(F.struct(F.sort_array(F.collect_list(F.struct(*df.columns))).alias(name))).alias("payload"))


def columns_of(df: DataFrame, key: str, prefixes: list[str]) -> DataFrame:
    """One row of lists, a list for each column with one of the prefixes, in the order of the key; for tables that a page shows."""
    rows = df.agg(F.sort_array(F.collect_list(F.struct(key, *[c for c in df.columns if c != key]))).alias("r"))
    return rows.select(F.col(f"r.{key}").alias(key), *[F.col(f"r.{c}").alias(c) for c in df.columns if any(c.startswith(p) for p in prefixes)])


def cell_ids(df: DataFrame, cell: str) -> DataFrame:
    """All cell ids as one JSON list, sorted: the called cells of a run."""
    return df.agg(F.to_json(F.sort_array(F.collect_set(F.col(cell).cast("string")))).alias("cells"))


#: The columns of the clone tables, which are written with all of them even if no clone was found.
CLONE_COLUMNS = "cell_id string, clone_id string, clone_id_by_size int, locus_VDJ string, locus_VJ string, productive_VDJ string, productive_VJ string, junction_VDJ string, junction_VJ string, junction_aa_VDJ string, junction_aa_VJ string"


def with_header(df: DataFrame, schema: str) -> DataFrame:
    """The columns of the schema, in its order; those that the table lacks are null, so that an empty result has its full header."""
    kinds = [c.strip().split(" ") for c in schema.split(",")]
    return df.select(*[(F.col(n) if n in df.columns else F.lit(None)).cast(k).alias(n) for n, k in kinds])


def remap_file(spark: SparkSession, source: str, target: str, barcodes: DataFrame, column: str | int = 0, umi: str | None = None, umi_length: int | None = None) -> None:
    """A file with its barcodes replaced by entries of another list (see operators.names.remap), in its own format, told by its name.

    csv and tsv have a header and the barcode in the named column; bed has none and a number for it; json holds objects, a line each; fastq, fasta
    and bam have it in front of the first underscore of their names.
    """
    from .operators.names import remap
    from .sources.bam import read_bam
    from .sources.files import fastq_frame, read_fasta

    kind = next((k for k in ("csv", "tsv", "bed", "json", "fastq", "fq", "fasta", "fa", "bam") if f".{k}" in source.rsplit("/", 1)[-1]), None)
    if kind in ("csv", "tsv", "bed"):
        sep, head = {"csv": ",", "tsv": "\t", "bed": "\t"}[kind], kind != "bed"
        d = spark.read.option("sep", sep).option("header", head).csv(source)
        name = d.columns[column] if isinstance(column, int) else column
        remap(d, name, barcodes, umi, umi_length).select(*d.columns).write.option("sep", sep).option("header", head).csv(target)
    elif kind == "json":
        d = spark.read.json(source)
        remap(d, d.columns[column] if isinstance(column, int) else column, barcodes, umi, umi_length).select(*d.columns).write.json(target)
    elif kind in ("fastq", "fq", "fasta", "fa", "bam"):
        d, name = (read_bam(spark, source), "qname") if kind == "bam" else (fastq_frame(spark, source), "name") if kind in ("fastq", "fq") else (read_fasta(spark, source), "name")
        d = d.withColumns({"__bc": F.split_part(name, F.lit("_"), F.lit(1)), "__rest": F.regexp_extract(name, "^[^_]*(.*)$", 1)})
        d = remap(d, "__bc", barcodes).withColumn(name, F.concat("__bc", "__rest")).drop("__bc", "__rest")
        if kind == "bam":
            from .sources.bam import references, write_bam

            write_bam(d, target, references(source))
        elif kind in ("fastq", "fq"):
            write_fastq(d, target)
        else:
            write_fasta(d, target)
    else:
        raise ValueError(f"{source}: no format known by that name")


def move(spark: SparkSession, source: str, target: str) -> None:
    """Renames a file or folder; the target must not exist."""
    at, fs = _file_system(spark, source)
    if not fs.rename(at, _file_system(spark, target)[0]):
        raise OSError(f"could not move {source} to {target}")


def copy(spark: SparkSession, source: str, target: str) -> None:
    """Copies a file or folder between any file systems."""
    (a, one), (b, two) = _file_system(spark, source), _file_system(spark, target)
    spark._jvm.org.apache.hadoop.fs.FileUtil.copy(one, a, two, b, False, spark._jsc.hadoopConfiguration())
