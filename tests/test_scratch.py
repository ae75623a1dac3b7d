"""Scratch tables: scopes of threads, of errors, and the release of results."""

import os
from multiprocessing.pool import ThreadPool

import pytest

from readloom import scratch


def folders(spark):
    return {x for x in os.listdir(scratch.shared_dir(spark).removeprefix("file://")) if x.startswith("settled")}


@scratch.tidy
def inner(df):
    scratch.settle(df.where("id % 2 = 0"))
    return scratch.settle(df.where("id % 2 = 1"), keep=True)


@scratch.tidy
def outer(df, rows):
    odd = [inner(df) for _ in range(rows)]
    kept = odd[0]
    for x in odd[1:]:
        kept = kept.intersect(x)
    return scratch.settle(kept, keep=True)


def test_operators_in_threads_keep_their_tables(spark):
    before = folders(spark)
    with ThreadPool(4) as pool:
        out = pool.map(lambda n: outer(spark.range(10 * n), 2), [1, 2, 3, 4, 5, 6])
    assert [x.count() for x in out] == [5, 10, 15, 20, 25, 30]
    assert len(folders(spark) - before) == 6
    for x in out:
        scratch.release(x)
    assert folders(spark) == before


def test_an_error_leaves_nothing(spark):
    before = folders(spark)

    @scratch.tidy
    def fails(df):
        scratch.settle(df, keep=True)
        inner(df)
        raise KeyError("no")

    with pytest.raises(KeyError):
        fails(spark.range(4))
    assert folders(spark) == before


def test_scopes_of_a_user(spark):
    before = folders(spark)
    with scratch.scope():
        assert outer(spark.range(6), 1).count() == 3 and len(folders(spark) - before) == 1
    assert folders(spark) == before
    top = inner(spark.range(6))
    assert len(folders(spark) - before) == 1
    scratch.sweep()
    assert folders(spark) == set() or folders(spark) <= before and top.columns == ["id"]
