"""Ranks, clones, splits, reports: operators against plain Python and worked values."""

import random

import pytest
from pyspark.sql import functions as F

from readloom.operators import clones as K
from readloom.operators import counts as C
from readloom.operators import intervals as I
from readloom.operators import methyl as Y
from readloom.operators import ranking as R
from readloom.operators import reports as P


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_ranks_with_one_hot_value(spark):
    r = random.Random(2)
    data = [(f"b{i:05d}", 1 if r.random() < 0.9 else r.randint(2, 40)) for i in range(4000)]
    got = {x.cell: x.r for x in R.ranked(spark.createDataFrame(data, "cell string, umis long"), "umis", ["cell"], "r").collect()}
    assert got == {c: i for i, (c, _) in enumerate(sorted(data, key=lambda x: (-x[1], x[0])), 1)}
    got = {x.cell: x.n for x in R.ordinals(spark.createDataFrame(data, "cell string, umis long"), "cell", "n").collect()}
    assert got == {c: i for i, (c, _) in enumerate(sorted(data), 1)}
    assert R.ranked(spark.createDataFrame([], "cell string, umis long"), "umis", ["cell"], "r").count() == 0


def test_adjusted_p_values(spark):
    r = random.Random(4)
    p = [r.choice([0.001, 0.5, r.random()]) for _ in range(800)]
    order = sorted(range(800), key=lambda i: p[i])
    q, least = {}, 1.0
    for rank in range(800, 0, -1):
        i = order[rank - 1]
        ties = max(k for k in range(rank, 801) if p[order[k - 1]] == p[i])
        least = min(least, p[i] * 800 / ties)
        q[i] = least
    d = spark.createDataFrame([(i, x) for i, x in enumerate(p)] + [(-1, None)], "id int, p double")
    got = {x.id: x.q for x in R.benjamini_hochberg(d, "p", ["id"]).collect()}
    assert got.pop(-1) is None and all(abs(got[i] - q[i]) < 1e-12 for i in q)


def test_running_sums(spark):
    d = spark.createDataFrame([(i, i % 5) for i in range(1000)], "k long, v long")
    got = {x.k: x.s for x in C.running(d, "k", "v", "s").collect()}
    assert got == {i: sum(j % 5 for j in range(i)) for i in range(1000)}


@pytest.mark.parametrize("stretch", [7, 1 << 20])
def test_depth_in_stretches(spark, stretch):
    r = random.Random(1)
    iv = [(r.choice("ab"), s, s + r.randint(1, 40)) for s in (r.randint(0, 200) for _ in range(80))]
    depth = {}
    for c, s, e in iv:
        for k in range(s, e):
            depth[c, k] = depth.get((c, k), 0) + 1
    got = {}
    for x in I.depth_segments(spark.createDataFrame(iv, "chrom string, start long, end long"), stretch).collect():
        for k in range(x.start, x.end):
            assert (x.chrom, k) not in got
            got[x.chrom, k] = x.depth
    assert {k: v for k, v in got.items() if v} == depth


def test_splits(spark):
    iv = spark.createDataFrame([("a", 95, 130), ("a", 180, 205), ("b", 0, 300)], "chrom string, start long, end long")
    lengths = spark.createDataFrame([("a", 320), ("b", 90), ("c", 150)], "chrom string, length long")
    cuts = I.split_plan(lengths, iv, 100, 10)
    assert sorted(map(tuple, cuts.collect())) == [("a", 90), ("a", 170), ("a", 270), ("c", 100)]
    with pytest.raises(ValueError):
        I.split_plan(spark.createDataFrame([("b", 400)], "chrom string, length long"), iv, 100, 10, tries=5)
    d = spark.createDataFrame([("a", 10, 80), ("a", 95, 130), ("a", 280, 300), ("z", 1, 2)], "chrom string, start long, end long")
    assert rows(I.split_shift(d, cuts)) == [("a_s0", 10, 80), ("a_s1", 5, 40), ("a_s3", 10, 30), ("z", 1, 2)]
    assert I.split_plan(lengths.where("chrom = 'b'"), iv, 100, 10).count() == 0


def test_a_cut_is_never_made_twice(spark):
    """Behind the first cut no place is free; only the cut itself is."""
    iv = spark.createDataFrame([("a", 101, 400), ("b", 51, 90), ("b", 91, 400)], "chrom string, start long, end long")
    lengths = spark.createDataFrame([("a", 320), ("b", 320)], "chrom string, length long")
    with pytest.raises(ValueError):
        I.split_plan(lengths, iv, 100, 10)
    assert rows(I.split_plan(lengths, iv, 100, 10, partial=True)) == [("a", 100), ("b", 90)]


def test_equal_regions_meet_a_position_once(spark, monkeypatch):
    """Regions that are equal but for their rows, and a position of many cells: the interval join has a row for each position and different region."""
    met, stab = [], Y.stab
    monkeypatch.setattr(Y, "stab", lambda *a: met.append(stab(*a)) or met[-1])
    calls = spark.range(50).selectExpr("id as cell", "'a' as chrom", "11L as pos", "'+' as strand", "'CGN' as context", "1L as mc", "3L as cov")
    regions = spark.createDataFrame([("a", 5, 20, "x")] * 40 + [("a", 8, 12, "x"), ("a", 10, 11, "y"), ("a", 11, 12, "z"), ("a", 10, 10, "z")], "chrom string, start long, end long, name string")
    assert sorted(rows(Y.region_counts(calls, regions))) == sorted([(c, "x", 41, 123) for c in range(50)] + [(c, "y", 1, 3) for c in range(50)])
    assert met[0].count() == 3


def test_region_kinds(spark):
    aln = spark.createDataFrame([("q1", "c", 5), ("q2", "c", 15), ("q3", "c", 99), ("q4", "d", 5)], "qname string, chrom string, pos long")
    f = spark.createDataFrame([("c", 0, 20, "intron"), ("c", 10, 20, "exon"), ("c", 90, 120, "gene")], "chrom string, start long, end long, feature string")
    got = I.region_kinds(aln, f, 8)
    assert rows(got.select("qname", "kind")) == [("q1", "intron"), ("q2", "exon"), ("q3", "intergenic"), ("q4", "intergenic")]
    assert tuple(I.kind_shares(got, ["exon", "intron", "intergenic"]).first()) == (0.25, 0.25, 0.5)


def test_single_chains(spark):
    cells = [(f"p{i}", "c_VDJ_1_VJ_2", 1) for i in range(20)] + [("q1", "c_VDJ_7_VJ_2", 2), ("q2", "c_VDJ_8_VJ_3", 3), ("s1", "c_VJ_2", 9), ("s2", "c_VJ_3", 8), ("s3", "c_VJ_9", 7), ("s4", "c_VDJ_8", 6), ("s5", "VJ_3", 5)]
    d = spark.createDataFrame(cells, "cell_id string, clone_id string, clone_id_by_size int")
    got = {x.cell_id: x.clone_id_by_size for x in K.attach_single_chains(d).collect()}
    assert {k: got[k] for k in ("s1", "s2", "s3", "s4", "s5", "q1")} == {"s1": 1, "s2": 3, "s3": 7, "s4": 3, "s5": 3, "q1": 2}
    close = spark.createDataFrame([(a, b, n) for a, b, n in cells if not a.startswith("p") or a < "p12"], d.schema)  # 4 cells against 1: too close
    assert {x.cell_id: x.clone_id_by_size for x in K.attach_single_chains(close).collect()}["s1"] == 9
    contigs = spark.createDataFrame([("a", "c_VDJ_1_VJ_2", 1000), ("b", "c_VJ_2", 9), ("c", "c_VJ_2", 10), ("d", "c_VDJ_1", 9), ("e", "c_VJ_5", 1), ("f", "VJ_2", 3)], "sequence_id string, clone_id string, umi_count long")
    assert rows(K.weak_single_chains(contigs)) == [("b",), ("d",), ("f",)]
    assert rows(K.drop_weak_single_chains(contigs).select("sequence_id")) == [("a",), ("c",), ("e",)]


def test_contig_filters_and_shares(spark):
    d = spark.createDataFrame([("x", "TRA", 100, 5), ("x", "TRB", 100, 7), ("y", "TRA", 100, 5), ("y", "IGH", 100, 1), ("z", "TRB", 0, 9), ("w", None, 100, 1)], "cell_id string, locus string, consensus_count long, duplicate_count long")
    assert rows(K.contig_filter(d, "TR").select("cell_id", "locus")) == [("x", "TRA"), ("y", "TRA")]  # 0.95 stays, 0.93 goes
    assert K.contig_filter(d, "TR", least_sum=6).count() == 0
    empty = K.clone_matrix(spark.createDataFrame([("x",)], "cell_id string"), "TR").first()
    assert empty.cells == 1 and empty.pairs == 0 and empty.tra_umis == 0
    with pytest.raises(ValueError):
        K.clone_matrix(d, "XX")
    m = spark.createDataFrame([("TRB", "TRA", "a", "b", "x", "y"), ("None", "TRA", "a", "b", "x", "y"), (None, None, "a", "b", "x", "y")], "locus_VDJ string, locus_VJ string, junction_VDJ string, junction_VJ string, junction_aa_VDJ string, junction_aa_VJ string")
    assert [tuple(r) for r in m.select(K.cdr3("junction"), K.cdr3("junction_aa")).collect()] == [("TRB:a;TRA:b", "TRB:x;TRA:y"), ("TRA:b", "TRA:y"), ("", "")]


def test_clone_groups_of_odd_rows(spark):
    from readloom.operators.receptors import clone_groups

    r = random.Random(3)
    seqs = ["".join(r.choice("ACG") for _ in range(9)) for _ in range(120)]
    d = spark.createDataFrame([(i, "V", "J", s) for i, s in enumerate(seqs)] + [(900, "V", "J", None), (901, None, "J", "ACGT"), (902, "V", "J", "")], "contig long, v string, j string, junction string")
    got = {x.contig: x.clone for x in clone_groups(d, 0.8).collect()}
    assert got[900] is None and got[901] is None and got[902] == "V|J|0|"
    top = {s: s for s in seqs}
    root = lambda s: s if top[s] == s else root(top[s])
    for a in sorted(top):
        for b in sorted(top):
            if sum(x == y for x, y in zip(a, b)) >= 0.8 * 9:
                x, y = sorted((root(a), root(b)))
                top[y] = x
    assert {i: got[i] for i in range(120)} == {i: f"V|J|9|{root(s)}" for i, s in enumerate(seqs)}


def test_downsampling_parts_are_equal(spark):
    d = spark.createDataFrame([(f"c{i % 7}", f"g{i % 11}", f"u{i}", 1 + i % 4) for i in range(400)], "cell string, gene string, umi string, num long")
    got = C.downsample(d).orderBy("step").collect()
    assert [x.reads for x in got] == [-(-100 * k) for k in range(1, 11)] and got[-1].median_genes == 11
    assert [x.saturation for x in got] == sorted(x.saturation for x in got) and got[-1].saturation == 60.0
    some = C.downsample(d, cells=spark.createDataFrame([("c1",), ("c2",)], "cell string")).orderBy("step").collect()
    assert some[-1].reads == sum(1 + i % 4 for i in range(400) if i % 7 in (1, 2))
    assert C.downsample(d.where("false")).count() == 0


def test_methylation_tables(spark):
    a = spark.createDataFrame([("x", "c", 1, "+", "CGN", 1, 2), ("x", "c", 1, "+", "CGN", 2, 2), ("x", "c", 101, "+", "CHG", 0, 0), ("y", "c", 100, "-", "CGT", 0, 8)], "cell string, chrom string, pos long, strand string, context string, mc long, cov long")
    assert rows(Y.pileup(a.where("cell = 'x'"))) == [("x", "c", 1, "+", "CGN", 3, 4), ("x", "c", 101, "+", "CHG", 0, 0)]
    b = Y.bins(a, 100)
    assert rows(b) == [("x", "c", 0, 3, 4), ("y", "c", 0, 0, 8)]
    assert rows(Y.cpg_counts(a)) == [("x", 2, 3), ("y", 1, 1)] and rows(Y.cpg_bed(a)) == [("c", 0, 1), ("c", 99, 100)]
    cells = spark.createDataFrame([("x",), ("y",), ("z",)], "cell string")
    assert Y.covered_features(b, cells, 4.0).count() == 0 and Y.covered_features(b, cells, 3.9).count() == 2
    assert rows(Y.mean_rate(a, "cell")) == [("x", 0.75), ("y", 0.0)]


def test_report_items(spark):
    import json

    none = spark.createDataFrame([], "id string, n double")
    one = P.payload(curve=P.curve(none, "t", "n", "n", "x", "y", 3), bars=P.bars(none, "b", "id", "n", "x", "y", 4, ["id"]), top=P.top_table(none, ["id"], ["id"])).first().payload
    got = json.loads(one)
    assert got["curve"]["data"]["x"] == [0.0] and got["bars"]["description"] == "No clonotype data available" and got["top"] == []
    pts = spark.createDataFrame([(2.0, 5.0), (1.0, 3.0)], "x double, y double")
    got = json.loads(P.payload(c=P.curve(pts, "Median", "x", "y", "a", "b", 1)).first().payload)["c"]
    assert got["data"]["x"] == [0, 1, 2] and got["data"]["y"] == [0, 3, 5] and got["data"]["xaxis"] == {"title": "a"}
    t = spark.createDataFrame([("c2", 1, 2.0, 3.0, 7, 0.456), ("c1", 0, 4.0, 5.0, 9, 0.5)], "cell string, k int, x double, y double, n int, mito double")
    got = json.loads(P.payload(e=P.embedding_payload(t, "cell", "k", "x", "y", ["n"], ["mito"])).first().payload)["e"]
    assert got["coordinate"]["x"] == [4.0, 2.0] and got["range"] == {"cluster": ["0", "1"], "n": [7, 9], "mito": [0.46, 0.5]} and got["n"] == [9, 7]
    assert P.render("<b>{{ data }}</b>", '{"a":"</script>"}') == '<b>{"a":"<\\/script>"}</b>'
    assert json.loads(P.placeholder("Rank", "BarcodeRank"))["data"] == []
    assert spark.range(1).select(P.shade(F.lit(0.35)), P.shade(F.lit(0.0)), P.shade(F.lit(1.0))).first() == (3, -1, 10)
