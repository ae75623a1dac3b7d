"""The pass over raw reads, branch by branch, and what works on its names."""

import random

import pytest
from pyspark.sql import functions as F

from readloom.chemistry import CHEMISTRIES, Chemistry, five_prime
from readloom.operators import barcodes as B
from readloom.operators import names as N
from readloom.operators import umi as U


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def listed(spark, *barcodes):
    return spark.createDataFrame([(b,) for b in barcodes], "barcode string")


def reads(spark, *seqs):
    return spark.createDataFrame([(f"r{i}", s, "I" * len(s), "A" * 80) for i, s in enumerate(seqs)], "name string, r1_seq string, r1_qual string, r2_seq string")


def state(df, *cols):
    return [tuple(r) for r in df.orderBy("name").select(*cols).collect()]


def test_exact_one_multi_none(spark):
    d = B.assign(reads(spark, "AAAACC", "AAACCC", "AATACC", "GGGGCC", "AANACC"), Chemistry("B4U2"), [listed(spark, "AAAA", "AATT", "AACC")])
    assert state(d, "status", "barcode", "alt", "umi", "corrected") == [("valid", "AAAA", "M", "CC", False), ("multi", None, None, "CC", False), ("multi", None, None, "CC", False), ("no_barcode", None, None, None, False), ("valid", "AAAA", "2N", "CC", True)]
    assert state(d, "candidates")[1] == (["AAAA", "AACC"],) and state(d, "candidates")[2] == (["AAAA", "AATT"],)


def test_anchor_moves_the_layout(spark):
    d = B.assign(reads(spark, "TTACGGGTT", "TTTTTTTTACGGGG", "ACCCCTTT"), Chemistry("B3U2", True, "AC"))
    assert state(d, "status", "barcode", "umi", "rest") == [("valid", "CGG", "GT", "T"), ("no_anchor", None, None, None), ("valid", "CCC", "CT", "TT")]


def test_segments_have_their_own_lists_and_linkers(spark):
    lists, linkers = [listed(spark, "AAA", "CCC"), listed(spark, "GGG")], [listed(spark, "TT")]
    chem = Chemistry("B3L2B3U2")
    d = B.assign(reads(spark, "AAATTGGGAC", "AAATAGGGAC", "AAACCGGGAC", "AAGTTGGAAC", "GTGTTGGGAC"), chem, lists, linkers)
    assert state(d, "status", "barcode", "alt") == [("valid", "AAAGGG", "M"), ("valid", "AAAGGG", "M"), ("no_linker", None, None), ("valid", "AAAGGG", "2G5A"), ("no_barcode", None, None)]
    strict = B.assign(reads(spark, "AAATTGGGAC", "AAGTTGGGAC", "AAATAGGGAC"), chem, lists, linkers, correct_barcodes=False, correct_linkers=False)
    assert state(strict, "status") == [("valid",), ("rejected",), ("rejected",)]
    one = B.assign(reads(spark, "AAATTCCCAC"), chem, lists[:1], linkers)  # fewer lists than segments: the first counts
    assert state(one, "status", "barcode") == [("valid", "AAACCC")]


def test_wider_matches_take_the_nearest(spark):
    far = [listed(spark, "AAAAAAAA"), listed(spark, "ACGTACGTAC", "ACGTACGTTT", "GGGGGGGGGG")]
    d = B.assign(reads(spark, "AAAAAAAACCACGTACGAAC", "AAAAAAAACCACGTACGTAT", "AAAAAAAACCTTTTTTTTTT"), Chemistry("B8U2B10", match_type=(1, 3)), far)
    assert state(d, "status", "candidates") == [("valid", ["AAAAAAAAACGTACGTAC"]), ("multi", ["AAAAAAAAACGTACGTAC", "AAAAAAAAACGTACGTTT"]), ("no_barcode", None)]


def test_rescue_takes_the_most_read(spark):
    white = listed(spark, "AAAA", "AATT")
    d = B.rescue_multi(B.assign(reads(spark, "AATA", "AAAA", "AATT", "AATT", "ATTA"), Chemistry("B4"), [white]))
    assert state(d, "status", "barcode", "alt") == [("rescued", "AATT", "3A"), ("valid", "AAAA", "M"), ("valid", "AATT", "M"), ("valid", "AATT", "M"), ("no_barcode", None, None)]
    tie = B.rescue_multi(B.assign(reads(spark, "AATA", "AAAA", "AATT"), Chemistry("B4"), [white]))
    assert state(tie, "barcode")[0] == ("AAAA",)
    none = B.rescue_multi(B.assign(reads(spark, "AATA"), Chemistry("B4"), [white]))
    assert state(none, "status", "barcode") == [("no_rescue", None)]


def test_counters_and_lengths(spark):
    """Corrected reads that are too short do not count as corrected; with short reads only empty sides are measured."""
    white = listed(spark, "AAAA", "AATT")
    long = "C" * 30
    d = B.rescue_multi(B.assign(reads(spark, "AAAA" + long, "AAAC" + long, "AAAC" + "C" * 5, "GGGG" + long, "AATA" + long, "AAAA"), Chemistry("B4"), [white]))
    done = B.finish(d, Chemistry("B4"), adapters=False)
    assert tuple(B.counters(done).first()) == (6, 5, 0, 2, 0, 1, 1, 0)
    short = B.finish(d, Chemistry("B4"), short_reads=True, adapters=False)
    assert tuple(B.counters(short).first()) == (6, 5, 0, 1, 4, 2, 1, 0)
    trimmed = B.finish(d, Chemistry("B4", adapters_1=(("GGGGG", "3"),), adapters_2=(("AAAAAAAAAAAA", "3"),)))
    assert {r.r2_kept for r in trimmed.collect()} == {""} and tuple(B.counters(trimmed).first())[3] == 5


def test_no_lists_no_reads(spark):
    d = B.assign(reads(spark, "ACGTACGT", "", "AC"), Chemistry("B4U2"))
    assert state(d, "status", "barcode", "umi") == [("valid", "ACGT", "AC"), ("valid", "", ""), ("valid", "AC", "")]
    assert B.rescue_multi(B.assign(reads(spark, "A").where("false"), Chemistry("B4"), [listed(spark, "AAAA")])).count() == 0
    assert tuple(B.counters(B.finish(B.assign(reads(spark, "A").where("false"), Chemistry("B4")), Chemistry("B4"), adapters=False)).first()) == (0,) * 8


def test_against_a_plain_pass(spark):
    """Random reads against the pass written as a loop."""
    r = random.Random(8)
    word = lambda n, a="ACGT": "".join(r.choice(a) for _ in range(n))
    lists, linkers = [{word(4) for _ in range(40)}, {word(3) for _ in range(9)}], [{"AC", "GT"}]
    chem = Chemistry("B4L2B3U3", True, "A")
    seqs = [word(r.randint(5, 25), "ACGTN" if r.random() < 0.3 else "ACGT") for _ in range(600)]

    def near(seq, white):
        i = seq.find("N")
        places = [i] if i >= 0 else range(len(seq))
        return {seq[:k] + b + seq[k + 1 :] for k in places for b in "ACGT" if b != seq[k]} & white

    def one(seq):
        at = seq[:7].find("A")
        if at < 0:
            return ("no_anchor", None)
        at, parts, nth = at + 1, [], {"B": 0, "L": 0}
        for code, n in chem.segments:
            s = seq[at : at + n]
            at += n
            if code not in nth:
                continue
            white = (lists if code == "B" else linkers)[nth[code]]
            nth[code] += 1
            found = {s} if s in white else near(s, white)
            if not found:
                return ("no_barcode" if code == "B" else "no_linker", None)
            if code == "B":
                parts.append(sorted(found))
        return ("multi" if any(len(p) > 1 for p in parts) else "valid", [a + b for a in parts[0] for b in parts[1]])

    d = spark.createDataFrame([(i, s) for i, s in enumerate(seqs)], "id int, r1_seq string")
    got = {x.id: (x.status, x.candidates) for x in B.assign(d, chem, [listed(spark, *w) for w in lists], [listed(spark, *linkers[0])]).collect()}
    assert got == {i: one(s) for i, s in enumerate(seqs)}


def test_autodetect(spark):
    r = random.Random(1)
    white = sorted({"".join(r.choice("ACGT") for _ in range(8)) for _ in range(20)})
    d = spark.createDataFrame([(i, 0, "TT" + r.choice(white) + "ACGT") for i in range(50)] + [(50 + i, 0, "G" * 14) for i in range(50)], "ordinal long, file int, r1_seq string")
    w = [listed(spark, *white)]
    best, rates = B.autodetect(d, {"first": (Chemistry("B8U4"), w), "second": (Chemistry("X2B8U4"), w)})
    assert best == "second" and rates["second"] == 0.5 and rates["first"] < 0.5
    assert B.autodetect(d, {"second": (Chemistry("X2B8U4"), w)}, first=50)[1] == {"second": 1.0}
    assert [five_prime(x) for x in (3.0, 0.2, 1.0, None)] == [True, False, None, None]
    assert all(c.segments for c in CHEMISTRIES.values()) and CHEMISTRIES["DDVS"].match(5) == 3


def test_names(spark):
    d = spark.createDataFrame([("ACGT_UMI_1N_read_7",), ("ACGT_UMI_read7",)], "qname string")
    got = [tuple(x) for x in N.tags(d).collect()]
    assert got == [("read_7", "ACGT", "ANGT", "UMI", "UMI"), ("read7", "ACGT", "ACGT", "UMI", "UMI")]
    assert d.select(N.barcode_behind("qname")).first()[0] == "read_7:ACGT"
    assert d.select(N.mate(F.lit("a 2:N"))).first()[0] == "a 1:N"
    assert d.select(N.chain(F.lit("TRAV1")), N.cell_of(F.lit("c1_contig_2"))).first() == ("TRA", "c1")
    refs = spark.createDataFrame([(1, "IGHV1 x"), (2, "other"), (3, "TRAV2|y")], "n int, name string")
    assert rows(N.numbered_references(refs, "name", "n")) == [(1, "IGHV1_1"), (3, "TRAV2_2")]
    old = spark.createDataFrame([("AA", "ACGTAC"), ("CC", "A"), ("AA", None), (None, "AC"), ("GG", "T")], "bc string, umi string")
    assert rows(N.remap(old, "bc", listed(spark, "x", "y"), "umi", 3)) == [("AA", "T"), ("x", "ACG"), ("x", None), ("y", "A"), (None, "AC")]
    assert N.sampled(spark.range(4000), "id", 0.25).count() in range(850, 1150)


@pytest.mark.parametrize("threshold", [1, 2])
def test_umi_edges_and_clusters_with_n(spark, threshold):
    from readloom.operators import umi as U

    r = random.Random(5)
    umis = sorted({"".join(r.choice("ACGTN") for _ in range(r.choice([5, 6]))) for _ in range(150)})
    d = spark.createDataFrame([("c", "g", u, 1 + i % 7) for i, u in enumerate(umis)], "cell string, gene string, umi string, num long")
    far = lambda a, b: len(a) == len(b) and sum(x != y for x, y in zip(a, b)) <= threshold
    want = sorted((a, b) for a in umis for b in umis if a < b and far(a, b))
    assert sorted((x.a, x.b) for x in U.edges(d, ["cell", "gene"], threshold).collect()) == want
    near = U.neighbours(umis, threshold)
    assert sorted((a, b) for a in near for b in near[a] if a < b) == want
    assert U.cluster_group({"ACGT": 10, "ACGN": 1}, "cluster")[0] == {"ACGT": 11}
    again = spark.createDataFrame([("c", "g", "ACGT", 4), ("c", "g", "ACGT", 6), ("c", "g", "ACGN", 1), ("c", "h", "ACGN", 1)], "cell string, gene string, umi string, num long")
    assert rows(U.cluster(again, "directional")) == [("c", "g", "ACGT", 11), ("c", "h", "ACGN", 1)]


def test_merges_are_followed(spark):
    from readloom.operators import umi as U

    log = spark.createDataFrame([("c", "g", "A:1", "B:2"), ("c", "g", "B:2", "C:9")], "cell string, gene string, `from` string, `to` string")
    d = spark.createDataFrame([("c", "g", "A"), ("c", "g", "C"), ("c", "h", "A")], "cell string, gene string, umi string")
    assert rows(U.follow_merges(d, log)) == [("c", "g", "A", "B"), ("c", "g", "C", "C"), ("c", "h", "A", "A")]
    assert rows(U.follow_merges(d, log, recursive=True)) == [("c", "g", "A", "C"), ("c", "g", "C", "C"), ("c", "h", "A", "A")]


def test_a_long_chain_of_merges_is_followed_to_its_end(spark):
    names = [f"u{i:02d}" for i in range(41)]
    d = spark.createDataFrame([("c", "g", n) for n in names], "cell string, gene string, umi string")
    log = spark.createDataFrame([("c", "g", f"{a}:1", f"{b}:2") for a, b in zip(names, names[1:])], "cell string, gene string, from string, to string")
    assert {r.corrected for r in U.follow_merges(d, log, recursive=True).collect()} == {"u40"}
    circle = log.union(spark.createDataFrame([("c", "g", "u40:1", "u00:2")], log.schema))
    with pytest.raises(ValueError, match="circle"):
        U.follow_merges(d, circle, recursive=True)


def test_columns_of_the_user_stay(spark):
    """Names that begin as those of columns on the way do."""
    white = spark.createDataFrame([("ACGT",)], "barcode string")
    d = spark.createDataFrame([("ACGTAAAATT", 1, 2, 3)], "r1_seq string, __at int, __B0 int, __x int")
    got = B.assign(d, Chemistry("B4U4"), [white]).first()
    assert (got["__at"], got["__B0"], got["__x"], got.barcode, got.umi) == (1, 2, 3, "ACGT", "AAAA")
