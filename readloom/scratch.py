"""Tables that operators write on their way: in the folder that driver and executors share, deleted when they are no longer read."""

from __future__ import annotations

import atexit
import functools
import logging
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share. Where none is set, a local session gets one of our own; a cluster must name one."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        own = tempfile.mkdtemp(prefix="readloom-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        found = "file://" + own
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def _file_system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    at, fs = _file_system(spark, path)
    return fs.exists(at)


def put(spark: SparkSession, path: str, text: str) -> None:
    """Writes a small file of text."""
    at, fs = _file_system(spark, path)
    out = fs.create(at, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def delete(spark: SparkSession, path: str) -> None:
    """Deletes a folder on whatever file system it lies; one that is gone already is no error."""
    try:
        at, fs = _file_system(spark, path)
        fs.delete(at, True)
    except Exception as e:  # a scratch folder that cannot be deleted costs space, not results
        logging.getLogger(__name__).warning("could not delete %s: %s", path, e)


class Scope:
    """What a running operator has settled: `held` goes when it ends, `kept` is read by its result and goes with its caller's."""

    def __init__(self):
        self.held: list[tuple[SparkSession, str]] = []
        self.kept: list[tuple[SparkSession, str]] = []


#: Held at top level, by no operator: tables that results read, until they are released or the session ends.
_TOP = Scope()
#: The scope of the operator that runs in this thread (or task of asyncio); each thread has its own.
_SCOPE: ContextVar[Scope] = ContextVar("readloom_scope", default=_TOP)


def hold(spark: SparkSession, path: str, keep: bool = False) -> str:
    """Has the folder deleted when the running operator ends or, if kept, when its caller does; at top level with the session."""
    scope = _SCOPE.get()
    (scope.kept if keep and scope is not _TOP else scope.held).append((spark, path))
    return path


def sweep() -> None:
    """Deletes what is held at top level: tables that results of finished operators read. Those results can no longer be read.

    Operators that are running, in whatever thread, keep theirs.
    """
    while _TOP.held:
        delete(*_TOP.held.pop())


atexit.register(sweep)


@contextmanager
def scope() -> Iterator[Scope]:
    """Tables settled inside are deleted at the end, but for those settled with keep, which the scope around takes over; after an error all are."""
    own, around = Scope(), _SCOPE.get()
    token = _SCOPE.set(own)
    try:
        yield own
        around.held.extend(own.kept)
    except BaseException:
        own.held.extend(own.kept)
        raise
    finally:
        _SCOPE.reset(token)
        for spark, path in own.held:
            delete(spark, path)


def tidy(operator):
    """Deletes what an operator has settled once it returns, but for the tables that its result reads: those it settles with keep.

    Where the result is a DataFrame, release(result) deletes these before the session ends.
    """

    @functools.wraps(operator)
    def run(*args, **kwargs):
        with scope() as own:
            out = operator(*args, **kwargs)
        if isinstance(out, DataFrame):
            out.scratch_paths = [path for _, path in own.kept]
        return out

    return run


def settle(df: DataFrame, keep: bool = False) -> DataFrame:
    """The rows, written to the shared folder and read back: lineage ends here and a lost executor costs nothing."""
    spark = df.sparkSession
    path = hold(spark, f"{shared_dir(spark)}/settled-{uuid.uuid4().hex}", keep)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_paths = [path]
    return out


def release(df: DataFrame) -> None:
    """Deletes the tables behind a result of settle or of an operator that nothing reads any more; other DataFrames are left alone."""
    for path in df.__dict__.pop("scratch_paths", ()):
        delete(df.sparkSession, path)
        for held in (_TOP.held, _SCOPE.get().held):
            held[:] = [x for x in held if x[1] != path]
