from pyspark.sql import functions as F

from readloom.chemistry import Chemistry, parse_structure, read_structure, region
from readloom.functions import seq as S
from readloom.operators import counts as C
from readloom.operators import intervals as I
from readloom.operators import matching as M
from readloom.operators import reads as R
from readloom.operators import umi as U


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_layouts():
    assert parse_structure("B8X8B8U6") == [("B", 8), ("X", 8), ("B", 8), ("U", 6)]
    assert read_structure("um:17:28,bc:0:16") == "17C12M+T"
    assert region(True) == "transcript" and region(False) == "exon"
    assert Chemistry("B17U12").segments == [("B", 17), ("U", 12)]


def test_segments_and_anchor(spark):
    d = spark.createDataFrame([("AACCGGTTAACC",)], "s string")
    assert R.extract_segments(d, "s", parse_structure("B2L2X2U2")).first()[1:] == ("AA", "CC", "TT", "AACC")
    d = spark.createDataFrame([("TTACGGG",), ("TTTTTTTTAC",)], "s string")
    assert [tuple(r) for r in R.anchor_shift(d, "s", "AC").select("start", "status").collect()] == [(3, "valid"), (None, "no_anchor")]


def test_neighbours(spark):
    d = spark.createDataFrame([("ACGT",), ("ANGN",), ("",)], "s string")
    a, n, e = [r[0] for r in d.select(S.neighbours(F.col("s"))).collect()]
    assert len(set(a)) == 12 and "ACGT" not in a
    assert sorted(n) == ["AAGN", "ACGN", "AGGN", "ATGN"] and e == []
    assert len(d.select(S.neighbours_all(F.col("s"))).first()[0]) == 12


def test_alterations_invert(spark):
    d = spark.createDataFrame([("ACGT", "ANGT"), ("ACGT", "TCGA"), ("ACGT", "ACGT")], "fixed string, raw string")
    d = d.withColumn("alt", S.alteration(F.col("raw"), F.col("fixed")))
    assert [r.alt for r in d.collect()] == ["1N", "0T3A", "M"]
    assert [r[0] for r in d.select(S.undo_alteration(F.col("fixed"), F.col("alt"))).collect()] == ["ANGT", "TCGA", "ACGT"]


def test_correct_and_rescue(spark):
    white = spark.createDataFrame([("AAAA",), ("AATT",), ("CCCC",)], "barcode string")
    reads = spark.createDataFrame([(1, "AAAA"), (2, "AAAA"), (3, "AAAT"), (4, "CCCG"), (5, "GGGG"), (6, "AATT")], "id int, raw string")
    got = {r.id: (r.status, r.corrected) for r in R.correct(reads, white).collect()}
    assert got == {1: ("exact", "AAAA"), 2: ("exact", "AAAA"), 3: ("multi", None), 4: ("one", "CCCC"), 5: ("none", None), 6: ("exact", "AATT")}
    assert rows(R.rescue(reads, white).select("id", "chosen")) == [(3, "AAAA")]
    tie = reads.where("id != 2")
    assert rows(R.rescue(tie, white).select("id", "chosen")) == [(3, "AAAA")]
    assert rows(R.rescue(tie, white, strict=True).select("id", "chosen")) == [(3, None)]


def test_nearest_is_brute_force(spark):
    q = spark.createDataFrame([("ACGTAC",), ("TTTTTT",)], "raw string")
    w = spark.createDataFrame([("ACGTAA",), ("ACGTTC",), ("GGGGGG",)], "barcode string")
    assert rows(R.nearest(q, w, 2, 3)) == [("ACGTAC", "ACGTAA", 1), ("ACGTAC", "ACGTTC", 1)]


def test_counters_sum(spark):
    d = spark.createDataFrame([("c", "g", "AC"), ("c", "g", "AC"), ("c", "g", "AA"), ("c", "h", "GT")], "cell string, gene string, umi string")
    det = C.detail(d)
    assert rows(det) == [("c", "g", "AC", 2), ("c", "h", "GT", 1)]
    assert rows(C.counts(det)) == [("c", "g", 1, 2), ("c", "h", 1, 1)]
    assert C.saturation(C.counts(det)).first()[0] == round(1 - 2 / 3, 9)


def test_n50(spark):
    for values, want in (([5, 3, 2], 5), ([4, 3, 2, 1], 3)):
        assert C.n50(spark.createDataFrame([(v,) for v in values], "n int"), "n").first()[0] == want


def test_accept_reads(spark):
    a = spark.createDataFrame([("a", "g", 255, False), ("b", "g", 3, False), ("c", "g", 3, False), ("c", "g", 3, False), ("d", "g", 3, True), ("d", "h", 3, False), ("e", "g", 3, False), ("e", "h", 3, False)], "qname string, gene string, mapq int, exonic boolean")
    assert rows(C.accept_reads(a)) == [("a", "g"), ("c", "g"), ("d", "g")]


def test_intervals_against_nested_loop(spark):
    import random

    r = random.Random(3)
    iv = [("c", s, s + r.randint(0, 30), i) for i, s in enumerate(r.randint(0, 200) for _ in range(60))]
    pts = [("c", p) for p in range(0, 240, 3)]
    got = rows(I.stab(spark.createDataFrame(pts, "chrom string, pos long"), spark.createDataFrame(iv, "chrom string, start long, end long, id int"), 7).select("pos", "id"))
    assert got == sorted((p, i) for _, p in pts for _, s, e, i in iv if s <= p < max(e, s + 1))
    a = spark.createDataFrame([("c", p, p + 10) for p in range(0, 200, 7)], "chrom string, a_start long, a_end long")
    got = rows(I.overlap(a, spark.createDataFrame(iv, "chrom string, start long, end long, id int"), 7, 0.5).select("a_start", "id"))
    assert got == sorted((p, i) for p in range(0, 200, 7) for _, s, e, i in iv if min(p + 10, e) - max(p, s) >= 5)


def test_coverage_worked_value(spark):
    h = spark.createDataFrame([("c", 0, 60, 100), ("c", 1, 20, 100), ("c", 2, 15, 100), ("c", 10, 5, 100), ("genome", 1, 9, 9)], "chrom string, depth int, bases long, size long")
    assert tuple(I.coverage(h).first()) == (0.40, 0.20, 0.05, 0.05)


def test_umi_clustering_goldens():
    counts = {"AAAA": 10, "AAAT": 5, "AATT": 2}
    assert U.cluster_group(counts, "cluster")[0] == {"AAAA": 17}
    assert U.cluster_group(counts, "directional")[0] == {"AAAA": 17}
    assert U.cluster_group(counts, "adjacency")[0] == {"AAAA": 10, "AAAT": 7}
    assert len(U.cluster_group(counts | {"AAAT": 6}, "directional")[0]) == 2


def test_umi_clustering_keeps_reads(spark):
    d = spark.createDataFrame([("c", "g", a + b + "A", 1 + ord(a) % 5) for a in "ACGT" for b in "ACGT"], "cell string, gene string, umi string, num long")
    for m in ("cluster", "directional", "adjacency"):
        out = U.cluster(d, m)
        assert out.agg(F.sum("num")).first()[0] == d.agg(F.sum("num")).first()[0] and out.count() <= d.count()


def test_matching():
    assert M.find_adapter("AAAACGTACGTTT", "ACGTACG", 0.1, 5) == (3, 10)
    assert M.find_adapter("AAAAAAACGTA", "ACGTACGTA", 0.1, 5) == (6, 11)
    assert M.find_adapter("TTTTTTTT", "ACGTACG", 0.1, 5) is None
    assert M.least_distance("TTTACGTTT", "ACGT")[0] == 0 and M.least_distance("TTTACTTT", "ACGT")[0] == 1


def test_nearest_in_a_dense_whitelist(spark, monkeypatch):
    """Entries at each distance, several at the least one, none near enough, a letter that no entry has; a dense whitelist is not compared piece by piece."""
    import random

    rng = random.Random(5)
    white = sorted({"ACG" + "".join(rng.choices("ACGT", k=5)) for _ in range(400)})
    asked = [*white[:3], "NCG" + white[3][3:], *{"".join(rng.choices("ACGT", k=8)) for _ in range(60)}]
    far = lambda a, b: sum(x != y for x, y in zip(a, b))
    least = {a: min(far(a, b) for b in white) for a in asked}
    want = sorted((a, b, least[a]) for a in asked for b in white if least[a] < 4 and far(a, b) == least[a])
    q, w = spark.createDataFrame([(a,) for a in asked], "raw string"), spark.createDataFrame([(b,) for b in white], "barcode string")
    assert {d for _, _, d in want} == {0, 1, 2, 3}
    assert rows(R.nearest(q, w, 2, 4)) == want
    monkeypatch.setattr(R, "_by_pieces", None)
    near = q.where(F.col("raw").isin([a for a in asked if least[a] < 2]))
    assert rows(R.nearest(near, w, 2, 2)) == [x for x in want if x[2] < 2]
