"""Whole jobs: results that an earlier version cut."""

import random
import string

import numpy as np
import pyarrow as pa

from readloom.llm import common, neardup, search, secrets, suffixes, toxicity


def test_earlier_bands_are_whole_hashes():
    """Two nodes that agree in the bytes of an earlier band but not in its hash were skipped in the band they share."""
    sig = bytes(range(128))
    rows = [{"key": bytes([k]), "comp": bytes([k]), "sig": sig, "band": 2, "earlier": e, "left": k == 0} for k, e in enumerate([[5, 6], [7, 8], [9, 6]])]
    schema = pa.schema([("key", pa.binary()), ("comp", pa.binary()), ("sig", pa.binary()), ("band", pa.int32()), ("earlier", pa.list_(pa.int64())), ("left", pa.bool_())])
    left, others, _ = neardup.likely(pa.Table.from_pylist(rows, schema))
    assert left.tolist() == [0] and others[0].tolist() == [1]
    first = [r | {"band": 0, "earlier": []} for r in rows]
    assert neardup.likely(pa.Table.from_pylist(first, schema))[1][0].tolist() == [1, 2]


def test_secrets_without_digits_and_beside_base_spans(spark):
    common.find_package(spark)
    r = random.Random(4)
    token = lambda a, n: "".join(r.choice(a) for _ in range(n))
    letters, more = string.ascii_letters, string.ascii_letters + string.digits
    dense = "0a1b2c3d" * 4
    kept = ["internationalisation_of_the_whole_collection", "Donaudampfschifffahrtsgesellschaft", "-" * 40, "pneumonoultramicroscopicsilicovolcanoconiosis", "the/quick/brown/fox/jumps/over/it", "AllTheseWordsInOneLongCamelCaseName"]
    found = [token(letters, 48), token(letters, 40), dense + "-" + token(more, 48), token(string.ascii_lowercase, 120)]
    d = spark.createDataFrame(list(enumerate(f"see {x} here" for x in kept + found)), "doc_id long, text string")
    spans = {x.row.doc_id: [(s.kind, s.start, s.end) for s in x.spans] for x in secrets.scan(d, carry=["doc_id"]).collect()}
    assert not any(spans[i] for i in range(len(kept)))
    at = [spans[len(kept) + i] for i in range(len(found))]
    assert at == [[(3, 4, 52)], [(3, 4, 44)], [(2, 4, 36), (3, 36, 85)], [(3, 4, 124)]]


def test_columns_named_as_those_on_the_way_stay(spark):
    common.find_package(spark)
    text = "the same words of a text that is long enough to be compared with another one"
    rows = [(i, text if i < 3 else f"{i} quite other words {i} that nobody else has {i}", i, f"r{i}", 0.25, "I") for i in range(6)]
    d = spark.createDataFrame(rows, "doc_id long, text string, __key long, __ROW string, __toxicity double, __i string")
    kept = neardup.keep_one(d)
    assert kept.columns == d.columns and sorted(tuple(r) for r in kept.collect()) == sorted(r for r in rows if r[0] not in (1, 2))
    none = toxicity.fit(d, spark.createDataFrame([(1, 0)], "doc_id long, toxic int"))
    left = toxicity.reject(d, none)
    assert left.columns == d.columns and {r["__toxicity"] for r in left.collect()} <= {0.25}


def test_segments_widen_with_the_codes(spark, monkeypatch):
    assert [search.width_for(n) for n in (0, 1, 1 << 20, (1 << 20) + 1, 1 << 21, (1 << 21) + 1, 1 << 24)] == [13, 13, 13, 14, 14, 15, 17]
    r = random.Random(8)
    v = spark.createDataFrame([(i, [r.gauss(0, 1) for _ in range(64)]) for i in range(400)], "vec_id long, embedding array<double>")
    few = search.search(v, v.where("vec_id < 5"), k=3)
    monkeypatch.setattr(search, "CODES", 20)
    wide = search.search(v, v.where("vec_id < 5"), k=3)
    assert search.width_for(400) == 18 and sorted(map(tuple, few.collect())) == sorted(map(tuple, wide.collect()))


def test_windows_of_one_fingerprint_are_told_apart(monkeypatch):
    """Where different windows share a fingerprint their bytes are the keys."""
    r = np.random.default_rng(4)
    half = r.integers(97, 100, 700).astype(np.uint8)
    text = np.concatenate([half, half, r.integers(97, 100, 700).astype(np.uint8)])
    start, n = np.array([0, 700, 1400]), np.array([301, 301, 301])
    held, level = np.array([1, 1, 1]), np.array([suffixes.NEW, 0, suffixes.NEW])
    mark = suffixes.repeated(text, start, n, held, level)
    assert mark[:602].all() and not mark[602:].any()
    at = np.arange(300)
    assert suffixes.window_keys(text, at).dtype == np.uint64
    monkeypatch.setattr(suffixes, "rolling", lambda codes: np.zeros(len(codes) + 1, np.uint64))
    assert suffixes.window_keys(text, at).dtype == "S400"
    assert (suffixes.repeated(text, start, n, held, level) == mark).all()
