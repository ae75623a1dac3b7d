"""The pipeline's stages against plain Python, on documents small enough for it."""

import collections
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parents[2]))
import corpus_pipeline  # noqa: E402
from readloom.llm import toxicity  # noqa: E402
from tests.llm.test_operators import WORD, brute_classes, brute_spans  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(corpus_pipeline.settle(stage(spark, out[-1], SF)))
    return out


def test_stages(spark, steps):
    docs, calm, single, clean, mixed, packed = steps
    assert all(d.columns == docs.columns for d in steps[:5])
    model = toxicity.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    scores = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    assert {r.doc_id for r in calm.collect()} == {i for i, s in scores.items() if s < 0.5}
    rows = sorted(calm.collect(), key=lambda r: r.doc_id)
    first = {}
    for r, c in zip(rows, brute_classes([r.text for r in rows])):
        first.setdefault(c, r.doc_id)
    assert sorted(r.doc_id for r in single.collect()) == sorted(first.values())
    was = {r.doc_id: r.text for r in single.collect()}
    now = {r.doc_id: r for r in clean.collect()}
    assert set(was) == set(now)
    for i, t in was.items():
        assert bool(brute_spans(t)) <= ("[SECRET]" in now[i].text) and not [s for s in brute_spans(now[i].text) if s[1]]
        assert now[i].n_chars == len(now[i].text)
    times = collections.Counter(r.doc_id for r in mixed.collect())
    assert set(times) <= set(now) and max(times.values()) <= 3
    got = packed.collect()
    assert collections.Counter(r.doc_id for r in got) == times
    assert all(r.length == len(WORD.findall(now[r.doc_id].text)) for r in got)
    assert len({(r.bucket, r.batch, r.slot) for r in got}) == len(got)


def test_run_gives_the_last_stage(spark, steps):
    assert sorted(map(str, corpus_pipeline.run(spark, SF).collect())) == sorted(map(str, steps[-1].collect()))


def test_every_query_of_the_subpackage(spark):
    from readloom.llm import registry

    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    for name, query in registry.QUERIES.items():
        got = query(spark, SF).count()
        assert got == n or name.startswith("op10_"), name


@pytest.mark.parametrize("name", ["op3_mixing", "op5_packing", "op6_neardup", "op8_secrets", "op10_search", "media_payloads"])
def test_queries_against_their_sql(spark, tmp_path, name):
    """On the smallest tables and on texts full of tokens, runs and nulls."""
    import random

    import duckdb

    from readloom.llm import registry

    r = random.Random(7)
    token = lambda a, lo, hi: "".join(r.choice(a) for _ in range(r.randint(lo, hi)))
    mixed, hex_ = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", "0123456789abcdef"
    bits = [lambda: token(mixed, 20, 90), lambda: token(hex_, 20, 60), lambda: "token=" + token(mixed, 3, 40), lambda: token(hex_, 24, 40) + "-" + token(mixed, 10, 50), lambda: "the-name-of-a-page-" + str(r.randint(1, 9999)), lambda: "é naïve words here", lambda: "w " * r.randint(1, 1500)]
    rows = [(i, " ".join(r.choice(bits)() for _ in range(r.randint(0, 12))) if i % 40 else None, "en", r.choice(["a", "a", "a", "b", None]), 1) for i in range(240)]
    odd = str(tmp_path)
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1).write.parquet(f"{odd}/documents.parquet")
    spark.read.parquet(f"{SF}/embeddings.parquet").coalesce(1).write.parquet(f"{odd}/embeddings.parquet")
    for folder, pattern in ((SF, ""), (odd, "/*.parquet")):
        con = duckdb.connect()
        for t in ("documents", "embeddings"):
            con.sql(f"create view {t} as select * from '{folder}/{t}.parquet{pattern}'")
        want = con.sql(registry.ORACLE[name])
        got = registry.QUERIES[name](spark, folder).select(*want.columns)
        assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want.fetchall())), folder


def test_odd_rows_pass_every_stage(spark):
    docs = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", "a", 0), (1, "", "en", "a", 0), (2, "calm words here", None, None, 3)], "doc_id long, text string, lang string, source string, n_chars long")
    for d in (docs, docs.where("false")):
        for _, stage in corpus_pipeline.STAGES:
            d = corpus_pipeline.settle(stage(spark, d, SF))
        assert d.count() <= 3
