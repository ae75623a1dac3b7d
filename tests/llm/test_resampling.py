"""Importance resampling against plain Python."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from readloom.llm import resampling

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def buckets_of(text, run, buckets):
    words = WORD.findall((text or "").translate(LOW))
    spans = [" ".join(words[i : i + k]) for k in range(1, run + 1) for i in range(len(words) - k + 1)]
    return len(words), [zlib.crc32(s.encode()) % buckets for s in spans]


def plain(docs, target, run=1, buckets=10_000, share=10, least=20):
    raw = [(i, *buckets_of(t, run, buckets)) for i, t in docs]
    s = collections.Counter(b for _, _, f in raw for b in f)
    t = collections.Counter(b for x in target for b in buckets_of(x, run, buckets)[1])
    S, T = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets)))) for b in range(buckets)]
    rows = []
    for i, words, f in raw:
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, words, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    wide = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is not None, r[0] or 0))
    drawn = collections.Counter((*r, k) for k, r in enumerate(wide[: share * len(wide) // 100], 1))
    return drawn + collections.Counter((*r, None) for r in wide[share * len(wide) // 100 :]) + collections.Counter((*r, None) for r in rows if r[1] < least)


@pytest.mark.parametrize("sizes", [[0, 1, 2, 63, 64, 65, 127, 128, 129, 1000, 4], [100_000], [0], []])
def test_crc_of_spans(sizes):
    r = np.random.default_rng(3)
    data = r.integers(0, 256, sum(sizes) + 7).astype(np.uint8)
    end = np.cumsum(np.array(sizes, np.int64))
    start = end - np.array(sizes, np.int64)
    want = [zlib.crc32(data[a:b].tobytes()) for a, b in zip(start, end)]
    assert resampling.crc32(data, start, end).tolist() == want


@pytest.mark.parametrize("run", [1, 2, 3])
def test_features_against_plain_words(run):
    texts = ["", "A b\x00c", "don't  STOP 9", "éÀ x y", "\x7f`{", "z", "x" * 500 + " Y"]
    raw = [t.encode() for t in texts]
    off = np.concatenate([[0], np.cumsum([len(x) for x in raw])])
    doc, bucket, words = resampling.features(np.frombuffer(b"".join(raw), np.uint8), off, run, 97)
    for i, t in enumerate(texts):
        n, want = buckets_of(t, run, 97)
        assert words[i] == n and sorted(bucket[doc == i].tolist()) == sorted(want)


@pytest.mark.parametrize("run, buckets, share, least", [(1, 10_000, 10, 20), (2, 50, 50, 1), (1, 7, 100, 0)])
def test_odd_inputs(spark, strange, nothing, run, buckets, share, least):
    target = strange.where("doc_id in (0, 5)")
    got = resampling.resample(strange, target, run=run, buckets=buckets, share=share, least_words=least).collect()
    docs, aims = [[tuple(r) for r in x.select("doc_id", "text").collect()] for x in (strange, target)]
    assert collections.Counter(tuple(r) for r in got) == plain(docs, [t for _, t in aims], run, buckets, share, least)
    assert resampling.resample(nothing, target).count() == 0
    none = resampling.resample(strange, nothing, run=run, buckets=buckets, share=share, least_words=least).collect()
    assert collections.Counter(tuple(r) for r in none) == plain(docs, [], run, buckets, share, least)


def test_ties_go_to_the_smaller_id(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "same words " * 15) for i in range(40)], "doc_id long, text string").repartition(7)
    monkeypatch.setattr(resampling, "gumbel", lambda *_: F.lit(0).cast("long"))
    got = {r.id: r["rank"] for r in resampling.resample(docs, docs).collect()}
    assert got == {i: i + 1 if i < 4 else None for i in range(40)}
