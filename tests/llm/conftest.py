"""Documents with nulls in every column, empty and long texts, repeated rows and ids, and columns whose names clash with results."""

import random

import pytest
from pyspark.sql import functions as F

from readloom.llm import common


@pytest.fixture(scope="module")
def strange(spark):
    common.find_package(spark)
    r = random.Random(15)
    long_text = " ".join(r.choice(["Lorem", "ipsum", "dolor", "sit", "amet", "ñandú", "x1", "éÀ", "\U0001F600"]) for _ in range(30_000))
    texts = ["One two  three\tfour five six", "One two  three\tfour five six", None, "", "   \n\t \x0b", "a\x00b\x1f" + "zero byte", "x" * 5000, "with <P> inside", "a <S>", "<M>", "< P>S>", "\U0001F600" * 50, "Ünïcödé wörds   and more", long_text, long_text, "the end <", "-", "'"]
    rows = [(None if i == 4 else i // 2 if i < 4 else i, t, "en", "s", 1, 0.5) for i, t in enumerate(texts)]
    clash = ["size", "n", "form", "key", "id", "rank", "weight", "bucket", "output", "place", "n_words", "spans", "kept", "a b", "c.d"]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score double").withColumns({c: F.lit(7) for c in clash})


@pytest.fixture(scope="module")
def nothing(strange):
    return strange.where("doc_id = -1")
