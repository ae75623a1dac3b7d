"""The corpus pipeline: toxicity, near duplicates, secrets, mixing, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from readloom.llm import mixing, neardup, packing, secrets, toxicity
from readloom.llm.common import find_package, settle, table, tidy
from readloom.scratch import release


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below one half; the model learns outside its held-out fold of the labels. Null texts count as
    empty ones, repeated rows are scored alike, null ids do not matter."""
    find_package(spark)
    return toxicity.reject(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class, that with the smallest id, null first. Empty and null texts are one class."""
    find_package(spark)
    return neardup.keep_one(docs)


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced by a mark, n_chars, if there is such a column, counted anew where there is a text.

    Null texts stay null and keep their n_chars, empty ones are empty; long texts are whole; repeated rows and ids are rows of their own, changed alike.
    """
    clean = secrets.redact(docs)
    if "n_chars" not in docs.columns:
        return clean
    return clean.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in training order: as often as the mix takes them, so some several times and some never; those without words never.
    Null sources are one source. Rows have whole texts, also where the mix takes a part of the last one."""
    return mixing.schedule(docs, docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each document lies in the token-budget batches of its length bucket.

    Null and empty texts have length 0 and lie in the first bucket; a text longer than a batch has one of its own. Repeated rows have slots of their own,
    equal lengths are in the order of a hash of the id. Null sources and ids stay null.
    """
    return packing.pack(docs, carry=["source"]).select("doc_id", "row.source", "length", "bucket", "bound", "batch", "slot", "padding")


STAGES = [("toxicity", drop_toxic), ("neardup", drop_copies), ("secrets", hide_secrets), ("mixing", mix), ("packing", pack)]

#: Boosted trees, MinHash and the packing programme are beyond SQL; tests/llm holds brute-force versions.
ORACLE_SQL = None


@tidy
def settled(stage, spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The stage's rows, written; what its operator had to keep until then goes."""
    return settle(stage(spark, docs, sf_dir), keep=True)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir, each written as Parquet and read again by the next, which deletes it once it is written itself."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        # packing has written what it needs of its documents by the time it returns
        done = stage(spark, docs, sf_dir) if name == STAGES[-1][0] else settled(stage, spark, docs, sf_dir)
        release(docs)
        docs = done
    return docs
