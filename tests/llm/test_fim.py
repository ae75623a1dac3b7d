"""Fill-in-the-middle against plain Python."""

import collections
import hashlib
import re

from pyspark.sql import functions as F

from readloom.llm import fim


def plain(doc_id, text):
    text = text or ""
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    tokens = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    n = len(tokens)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    p, m, s = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    if h4 % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def check(docs):
    rows = docs.select("doc_id", "text").collect()
    want = collections.Counter((r.doc_id, *plain(r.doc_id, r.text), r.text or "") for r in rows)
    out = fim.transform(docs)
    got = out.withColumn("back", fim.restored(F.col("form"), F.col("output"))).collect()
    assert collections.Counter((r.id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.back) for r in got) == want
    assert all(r.output_sha256 == hashlib.sha256(r.output.encode()).hexdigest() for r in got)
    return got


def test_odd_inputs(strange, nothing):
    got = check(strange)
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    assert fim.transform(nothing).count() == 0 and fim.transform(nothing).columns == ["id", "n", "form", "prefix_chars", "middle_chars", "output", "output_sha256"]


def test_all_documents(spark):
    forms = collections.Counter(r.form for r in check(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")))
    assert forms["psm"] > forms["spm"] > 0 and forms["plain"] > 0


def test_marks_at_every_cut(spark):
    """Texts full of halves of marks: no cut makes a mark of its own."""
    halves = ["<", ">", "P", "S", "M", "<P", "S>", "<<", "P><"]
    texts = [x + y + z for x in halves for y in halves for z in halves]
    texts = [t for t in texts if not any(m in t for m in ("<P>", "<S>", "<M>"))]
    check(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))


def test_query(spark):
    got = fim.op12_fim(spark, "/root/testdata/sf0.001")
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    rows = got.collect()
    assert len(rows) == len(docs) and all(r.restored_sha256 == hashlib.sha256((docs[r.doc_id] or "").encode()).hexdigest() for r in rows)
