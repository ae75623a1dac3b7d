import gzip
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from readloom import sinks
from readloom.sources import annotation as G
from readloom.sources import bam as B
from readloom.sources import files as S
from readloom.sources import receptors as V


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_fastq_round_trip(spark, tmp_path):
    for name, seqs in (("r1.fq.gz", ["ACGT", "GGGG"]), ("r2.fq.gz", ["TTTT", "CCCC"])):
        with gzip.open(tmp_path / name, "wt") as f:
            for i, s in enumerate(seqs):
                f.write(f"@n{i} x\n{s}\n+\n@III\n")
    d = S.read_fastq_pairs(spark, [str(tmp_path / "r1.fq.gz")], [str(tmp_path / "r2.fq.gz")])
    assert rows(d.select("name", "r1_seq", "r2_seq", "r2_qual")) == [("n0", "ACGT", "TTTT", "@III"), ("n1", "GGGG", "CCCC", "@III")]
    sinks.write_fastq(d, str(tmp_path / "out"), seq="r1_seq", qual="r1_qual")
    assert [r[0] for r in spark.read.text(str(tmp_path / "out")).collect()][:2] == ["@n0", "ACGT"]


def test_sam_and_bam(spark, tmp_path):
    """The same records as text and as BAM, here and back."""
    lines = ["q1\t64\tchr1\t11\t255\t2M1I1M\t=\t31\t25\tACGT\tIIH#\tXT:Z:g1\tNH:i:1", "q2\t4\t*\t0\t0\t*\t*\t0\t0\tNACGT\t*\tCB:Z:AC\tXF:f:1.5\tXA:A:k\tXB:B:s,1,-2"]
    (tmp_path / "a.sam").write_text("@HD\tVN:1\n" + "\n".join(lines) + "\n")
    sam = S.read_sam(spark, str(tmp_path / "a.sam"))
    want = [("q1", 64, "chr1", 10, 255, "2M1I1M", "chr1", 30, 25, "ACGT", "IIH#", True, {"XT": "g1", "NH": "1"}), ("q2", 4, None, -1, 0, "*", None, -1, 0, "NACGT", "*", False, {"CB": "AC", "XF": "1.5", "XA": "k", "XB": "s,1,-2"})]
    assert [tuple(r)[:13] for r in sam.collect()] == want
    assert [r[0] for r in sam.select(B.reference_end()).collect()] == [13, -1]
    # SAM writes an array as <type>,<values>; BAM holds the type beside them
    d = sam.withColumn("tag_types", F.map_zip_with("tag_types", "tags", lambda k, a, b: F.when(a == "B", F.concat(a, F.substring(b, 1, 1))).otherwise(a)))
    d = d.withColumn("tags", F.map_zip_with("tags", "tag_types", lambda k, a, b: F.when(b.startswith("B"), F.substring(a, 3, 100)).otherwise(a)))
    done = B.write_bam(d.coalesce(1), f"file://{tmp_path}/out", [("chr1", 1000)])
    assert rows(done) == [("part-00000", 2)]
    back = B.read_bam(spark, f"file://{tmp_path}/out/part-00000.bam")
    assert [tuple(r) for r in back.collect()] == [tuple(r) for r in d.collect()]
    raw = (tmp_path / "out" / "part-00000.bam").read_bytes()
    assert gzip.decompress(raw)[:4] == b"BAM\1" and raw.endswith(B.END)


def test_bam_per_barcode(spark, tmp_path):
    d = spark.range(30_000).select(F.concat(F.lit("r"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("qname"), F.element_at(F.array(F.lit("AA"), F.lit("CC"), F.lit(None).cast("string")), (F.col("id") % 3 + 1).cast("int")).alias("cb"), F.repeat(F.lit("ACGT"), 30).alias("seq"), F.repeat(F.lit("I"), 120).alias("qual"), F.lit("chr1").alias("ref"), F.col("id").alias("pos"), F.lit("120M").alias("cigar"), F.lit(0).alias("flag"))
    done = B.write_bam(d, str(tmp_path / "cells"), [("chr1", 10**6)], by="cb")
    assert rows(done) == [("AA", 10_000), ("CC", 10_000), ("null", 10_000)]
    got = B.read_bam(spark, str(tmp_path / "cells"))
    assert got.count() == 30_000 and got.select("qname").distinct().count() == 30_000
    one = B.read_bam(spark, str(tmp_path / "cells" / "CC.bam"))
    assert one.agg(F.min("qname"), F.max("qname")).first() == ("r000001", "r029998")
    names = [r.qname for r in one.coalesce(1).collect()]
    assert names == sorted(names)


def test_bad_files_are_errors(spark, tmp_path):
    (tmp_path / "cut.fq").write_text("@a\nACGT\n+\n")
    (tmp_path / "ok.fq").write_text("@a\nACGT\n+\nIIII\n@b\nAC\n+\nII\n")
    (tmp_path / "one.fq").write_text("@a\nACGT\n+\nIIII\n")
    for one, two in (("cut.fq", "ok.fq"), ("ok.fq", "one.fq")):
        with pytest.raises(Exception, match="cut short|different numbers"):
            S.read_fastq_pairs(spark, [str(tmp_path / one)], [str(tmp_path / two)]).count()
    (tmp_path / "x.bam").write_bytes(b"no bam")
    with pytest.raises(Exception, match="BGZF"):
        B.read_bam(spark, str(tmp_path / "x.bam")).count()


def test_two_pairs_stay_in_step(spark, tmp_path):
    """Ordinals restart in every file: order is by (file, ordinal), for both mates alike."""
    for f in "ab":
        for m in "12":
            with gzip.open(tmp_path / f"{f}{m}.fq.gz", "wt") as out:
                out.write("".join(f"@{f}{i} x\n{'ACGT'[: i % 4 + 1]}\n+\n{'IIII'[: i % 4 + 1]}\n" for i in range(2500)))
    at = lambda f, m: f"file://{tmp_path}/{f}{m}.fq.gz"
    d = S.read_fastq_pairs(spark, [at("a", 1), at("b", 1)], [at("a", 2), at("b", 2)])
    assert d.count() == 5000 and rows(d.groupBy("file").agg(F.max("ordinal"))) == [(0, 2499), (1, 2499)]
    want = [f"@{f}{i}" for f in "ab" for i in range(2500)]
    lines = lambda p: [x for f in sorted(Path(p).glob("*.gz")) for x in gzip.open(f, "rt").read().splitlines()]
    sinks.write_fastq(d.repartition(7), str(tmp_path / "out"), seq="r1_seq", qual="r1_qual")
    assert lines(tmp_path / "out")[0::4] == want
    sinks.write_pairs(d.repartition(7), str(tmp_path / "both"), ("name", "r1_seq", "r1_qual"), ("name", "r2_seq", "r2_qual"))
    assert lines(tmp_path / "both" / "1")[0::4] == want == lines(tmp_path / "both" / "2")[0::4]
    from readloom.operators.reads import cap_reads

    capped = cap_reads(d.withColumn("bc", F.lit("x")), "bc", ["file", "ordinal"], 3)
    assert rows(capped.select("name")) == [("a0",), ("a1",), ("a2",)]


def test_cell_store_and_files(spark, tmp_path):
    d = spark.createDataFrame([(f"c{i % 5}", f"r{i}", i, i + 1) for i in range(40)], "cell string, region string, mc int, cov int")
    sinks.write_cells(d, str(tmp_path / "store"))
    some = S.read_cells(spark, str(tmp_path / "store"), spark.createDataFrame([("c1",), ("c9",)], "cell string"))
    assert rows(some) == sorted(tuple(r) for r in d.where("cell = 'c1'").collect())
    sinks.write_embedding(d.select("cell", "mc").distinct(), str(tmp_path / "e"))
    sinks.copy(spark, str(tmp_path / "e"), str(tmp_path / "f"))
    sinks.move(spark, str(tmp_path / "f"), str(tmp_path / "g"))
    assert spark.read.parquet(str(tmp_path / "g")).count() == 40 and not (tmp_path / "f").exists()
    (tmp_path / "p.out").write_text(">c1 x\nACG\n3 1 0\n0 2 0\n0 1 2\n0 1 4\n>c2\nA\n7\n0\n0\n0\n")
    from readloom.sources.receptors import contig_totals, read_pileups

    assert rows(contig_totals(read_pileups(spark, str(tmp_path / "p.out")))) == [("c1", 6), ("c2", 7)]


def test_fasta_tsv_logs(spark, tmp_path):
    (tmp_path / "a.fa").write_text(">x one\nACG\nT\n>y\nGG\n")
    assert rows(S.read_fasta(spark, str(tmp_path / "a.fa"))) == [("x", "ACGT"), ("y", "GG")]
    (tmp_path / "t.tsv").write_bytes("a\tb\nx\xe9\xe9y\t1\n".encode("latin1"))
    assert rows(S.read_tsv(spark, str(tmp_path / "t.tsv"), clean=True)) == [("xNy", "1")]
    lines = spark.createDataFrame([("   Number of input reads |\t1200",), ("exonic =  1,234 (5%)",), ("Mapping efficiency:\t61.5% ",)], "value string")
    assert S.log_metrics(lines, {"n": S.STAR_LOG["input_reads"], "e": S.QUALIMAP_LOG["exonic"], "m": S.BISMARK_LOG["efficiency"]}).first() == (1200.0, 1234.0, 61.5)
    assert S.read_settings("# c\na: 1\n\nb:x:y\n") == {"a": "1", "b": "x:y"}
    (tmp_path / "allc.tsv").write_text("chr1\t5\t+\tCGN\t1\t2\t1\n")
    assert S.read_allc(spark, str(tmp_path / "allc.tsv")).count() == 1
    (tmp_path / "s.json").write_text('{"a": {"b": 1}}')
    assert S.read_summary(spark, str(tmp_path / "s.json")).first().a.b == 1
    (tmp_path / "cov.tsv").write_text("chr1\t0\t60\t100\t0.6\n")
    assert S.read_genomecov(spark, str(tmp_path / "cov.tsv")).first().bases == 60


def test_matrix_round_trip(spark, tmp_path):
    d = spark.createDataFrame([("c1", "g1", 3), ("c2", "g1", 1), ("c2", "g2", 7)], "cell string, gene string, umis int")
    sinks.write_matrix_market(d, "gene", "cell", "umis", str(tmp_path / "m"))
    folder = tmp_path / "t"
    folder.mkdir()
    for sub, name in (("matrix", "matrix.mtx.gz"), ("features", "features.tsv.gz"), ("barcodes", "barcodes.tsv.gz")):
        (part,) = (tmp_path / "m" / sub).glob("part-*")
        (folder / name).write_bytes(part.read_bytes())
    assert rows(S.read_tenx(spark, str(folder))) == [("g1", "c1", 3), ("g1", "c2", 1), ("g2", "c2", 7)]


def test_other_sinks(spark, tmp_path):
    d = spark.createDataFrame([("b1", 1), ("b2", 2)], "barcode string, n int")
    sinks.write_by_barcode(d, str(tmp_path / "by"))
    assert (tmp_path / "by" / "barcode=b1").exists()
    sinks.write_tsv(d, str(tmp_path / "tsv"))
    assert rows(S.read_tsv(spark, str(tmp_path / "tsv"), "barcode string, n int")) == [("b1", 1), ("b2", 2)]
    sinks.write_fasta(d.select(F.col("barcode").alias("name"), F.lit("AC").alias("seq")), str(tmp_path / "fa"))
    assert rows(S.read_fasta(spark, str(tmp_path / "fa"))) == [("b1", "AC"), ("b2", "AC")]
    assert sinks.metrics_row(spark.createDataFrame([("1,000", 2)], "a string, b int")).first()[0] == '"1,000",2'
    assert sinks.json_section(d, "x").first()[0] == '{"x":[{"barcode":"b1","n":1},{"barcode":"b2","n":2}]}'
    e = spark.createDataFrame([("c2", 1.0, 5), ("c1", 2.0, 6)], "cell string, tSNE_1 double, nCount int")
    assert tuple(sinks.columns_of(e, "cell", ["tSNE"]).first()) == (["c1", "c2"], [2.0, 1.0])


def test_gtf(spark, tmp_path):
    text = '#c\nchrM\ts\texon\t5\t9\t.\t+\t.\tgene_id "g1"; gene_name "ND1";\nchrM\ts\tgene\t5\t9\t.\t+\t.\tgene_id "g1"; gene_name "ND1";\nchr1\ts\tgene\t3\t3\t.\t-\t.\tgene_id "g2"; gene_name "A"; gene_type "lncRNA";\nchr1\ts\tgene\t3\t3\t.\t-\t.\tgene_id "g2"; gene_name "A";\n'
    (tmp_path / "a.gtf").write_text(text)
    g = G.read_gtf(spark, str(tmp_path / "a.gtf"))
    assert rows(G.gene_symbols(g)) == [("g1", "MT-ND1", 1), ("g2", "A", 2)]
    assert rows(G.problems(g)) == [("g2", "duplicate")]
    assert rows(G.intervals(g, ["exon"]).select("start", "end", "gene_id")) == [(4, 9, "g1")]
    assert rows(G.biotypes(g)) == [("g2", "lnc")]


def test_receptor_text(spark):
    h = spark.createDataFrame([(">c1 300 5.5 IGHV1*01(290):(0-280):(1-281):98.5,IGHV2*02(9):(1-2):(3-4):1 * IGHJ4*02(40):(290-330):(1-40):100 *",), ("ACGT",)], "value string")
    r = V.annotation_headers(h).first()
    assert (r.id, r.length, [x.gene for x in r.v], r.d, r.j[0].start, r.c) == ("c1", 300, ["IGHV1", "IGHV2"], [], 290, [])
    p = spark.createDataFrame([(">k\nACGT\n1 2 1 3\n1 1 1 1\n1 1 1 1\n0 1 1 1",)], "value string")
    assert tuple(V.contig_totals(V.pileups(p)).first()) == ("k", 7)


def test_zipped_records(spark, tmp_path):
    (tmp_path / "bc.fa").write_text(">r1\nAC\nGT\n>r2\nTT\n")
    (tmp_path / "r.fq").write_text("@r1 x\nGGGG\n+\nIIII\n@r2 x\nCCCC\n+\nIIII\n")
    d = S.read_zipped(spark, [[str(tmp_path / "bc.fa"), str(tmp_path / "r.fq"), str(tmp_path / "r.fq")]])
    assert [tuple(r)[:3] for r in d.orderBy("ordinal").collect()] == [("r1", ["ACGT", "GGGG", "GGGG"], 0), ("r2", ["TT", "CCCC", "CCCC"], 1)]


def test_split_sequences(spark):
    from readloom.operators.intervals import split_sequences

    f = spark.createDataFrame([("c1", "AACCGGTT"), ("c2", "GG")], "name string, seq string")
    assert rows(split_sequences(f, spark.createDataFrame([("c1", 2), ("c1", 5)], "name string, pos long"))) == [("c1_s0", "AA"), ("c1_s1", "CCG"), ("c1_s2", "GTT"), ("c2", "GG")]


def test_bed12_codons(spark):
    """Codons on both strands, one or none of them, miRNA, a repeated codon, and a block that begins last but ends first."""
    row = lambda tx, strand, *parts: [(tx, "chr1", strand, f, s, e, i) for i, (f, s, e) in enumerate(parts)]
    exons = [("exon", 101, 200), ("exon", 301, 400)]
    data = [*row("plus", "+", *exons, ("start_codon", 151, 153), ("stop_codon", 348, 350)), *row("minus", "-", *exons[::-1], ("stop_codon", 151, 153), ("start_codon", 348, 350)), *row("start", "+", *exons, ("start_codon", 151, 153), ("CDS", 160, 170)), *row("back", "-", *exons, ("start_codon", 348, 350)), *row("none", "-", *exons, ("CDS", 151, 350)), *row("mi", "+", ("miRNA", 5, 9)), *row("two", "+", *exons, ("start_codon", 110, 112), ("start_codon", 120, 122)), *row("inside", "+", ("exon", 101, 500), ("exon", 301, 400)), *row("cds", "+", ("CDS", 1, 2))]
    got = {r.tx: r for r in G.bed12(spark.createDataFrame(data, "tx string, chrom string, strand string, feature string, start long, end long, line long")).collect()}
    thick = {k: (r.thick_start, r.thick_end) for k, r in got.items()}
    assert thick == {"plus": (150, 350), "minus": (150, 350), "start": (150, 400), "back": (100, 350), "none": (100, 400), "mi": (4, 9), "two": (119, 400), "inside": (100, 400)}
    assert (got["minus"].start, got["minus"].end, got["minus"].sizes, got["minus"].starts, got["mi"].blocks) == (100, 400, "100,100", "0,200", 1)
