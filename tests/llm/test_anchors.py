"""Repeated runs of words against plain Python."""

import collections
import random

import pytest

from readloom.llm import anchors

SPACE = " \t\n\x0b\x0c\r"


def words_of(text):
    out = text or ""
    for s in SPACE:
        out = out.replace(s, " ")
    return [w for w in out.split(" ") if w]


def plain(docs, span):
    """(id, n, spans, kept) of each row; a window is late if the least (id, start) with its words is less than its own."""
    key = lambda i: (i is not None, 0 if i is None else i)
    first = {}
    split = [(i, words_of(t)) for i, t in docs]
    for i, w in split:
        for s in range(len(w) - span + 1):
            k = tuple(w[s : s + span])
            first[k] = min(first.get(k, (key(i), s)), (key(i), s))
    out = []
    for i, w in split:
        gone = {s + j for s in range(len(w) - span + 1) if first[tuple(w[s : s + span])] < (key(i), s) for j in range(span)}
        edges = [j for j in range(len(w) + 1) if ((j in gone) != (j - 1 in gone))]
        out.append((i, len(w), tuple(zip(edges[::2], edges[1::2])), " ".join(x for j, x in enumerate(w) if j not in gone)))
    return collections.Counter(out)


def check(docs, span=20):
    got = collections.Counter((r.id, r.n_words, tuple((s.start, s.end) for s in r.spans), r.kept) for r in anchors.dedup(docs, span=span).collect())
    assert got == plain([tuple(r) for r in docs.select("doc_id", "text").collect()], span)
    return got


@pytest.mark.parametrize("period", anchors.COVERS)
def test_covers_hold_every_difference_once(period):
    cover = anchors.COVERS[period]
    found = collections.Counter((a - b) % period for a in cover for b in cover if a != b)
    assert found == {d: 1 for d in range(1, period)}


def test_odd_inputs(spark, strange, nothing):
    got = check(strange)
    assert any(spans for _, _, spans, _ in got)
    check(strange.select("doc_id", "text", "kept").unionByName(strange.select("doc_id", "text", "kept")).repartition(5), 5)  # every row twice
    check(strange.selectExpr("cast(doc_id as string) doc_id", "text"))
    assert anchors.dedup(nothing).count() == 0


@pytest.mark.parametrize("span, letters", [(5, 2), (5, 3), (7, 2), (20, 1), (20, 2), (33, 2)])
def test_few_words_in_many_orders(spark, span, letters):
    """Texts of very few different words: hot anchors with very many contexts, matches inside a text, over every offset."""
    r = random.Random(span * letters)
    texts = ["".join(r.choice("abc"[:letters]) + r.choice([" ", "  ", "\n"]) for _ in range(r.randint(0, 4 * span))) for _ in range(120)]
    ids = list(range(120))
    r.shuffle(ids)
    check(spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string").repartition(3), span)


def test_passages_at_every_offset(spark):
    """A passage of one window less, exactly one, and more words, at every pair of offsets in otherwise different texts."""
    passage = [f"p{i}" for i in range(60)]
    rows = []
    for n in (19, 20, 21, 33, 60):
        for before in range(14):
            i = len(rows)
            rows.append((i * 7 % 101, " ".join([*[f"u{i}_{j}" for j in range(before)], *passage[:n], *[f"v{i}_{j}" for j in range(i % 9)]])))
    got = check(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sum(1 for _, n, spans, _ in got if not spans) >= 14


@pytest.mark.parametrize("rows", [2, 7])
def test_groups_over_many_batches(spark, rows):
    """Copies and near copies whose groups go over the ends of Arrow batches and of ranges."""
    r = random.Random(rows)
    base = [f"w{i}" for i in range(70)]
    texts = [" ".join(base) for _ in range(25)]
    for _ in range(25):
        near = base.copy()
        near[r.randrange(70)] = "changed"
        texts.append(" ".join(near))
    docs = spark.createDataFrame([(None if i < 2 else i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(6)
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, rows)
    try:
        check(docs)
    finally:
        spark.conf.set(setting, before)


def test_documents(spark):
    check(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
