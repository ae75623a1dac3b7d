"""Bounded training samples of labelled documents."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, text_of

MAX_ROWS = 6_000
MAX_BYTES = 256 << 20  # of texts on the driver


def sample(docs: DataFrame, labels: DataFrame, label: str, fold: tuple[int, int], id_col: str = "doc_id", text_col: str = "text", max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES) -> tuple[pa.Array, np.ndarray]:
    """Texts and labels of at most max_rows labelled documents, on the driver; max_rows is the bound on what is fitted.

    Texts are whole. Those longer than max_bytes / max_rows bytes may make the sum exceed max_bytes; then the documents that come first in
    the order below stay, as many as fit.

    fold = (n, r): documents whose crc32(id) mod n is r are held out and never returned. The labels are chosen
    by a hash of the id. Rows with a null id or label are left out; an id labelled twice takes its larger label.
    """
    known = labels.where(F.col(id_col).isNotNull() & F.col(label).isNotNull() & (crc_mod(id_col, fold[0]) != fold[1]))
    known = known.groupBy(F.col(id_col).alias("__id")).agg(F.max(label).cast("int").alias("__y"))
    known = known.orderBy(F.xxhash64("__id"), "__id").limit(max_rows)
    rows = docs.select(F.col(id_col).alias("__id"), text_of(text_col).alias("__text")).join(F.broadcast(known), "__id")
    order = [F.xxhash64("__id"), F.col("__id"), F.xxhash64("__text")]
    sizes = rows.select("__id", F.xxhash64("__text").alias("__hash"), F.octet_length("__text").alias("__size"))
    sizes = sizes.orderBy(F.xxhash64("__id"), "__id", "__hash").limit(max_rows).select("__size").toArrow().column(0).to_numpy()
    fits = int(np.searchsorted(np.cumsum(sizes), max_bytes, "right"))
    got = rows.orderBy(*order).limit(min(max_rows, fits)).select("__text", "__y").toArrow()
    return got.column(0).combine_chunks(), got.column(1).to_numpy().astype(np.int64)
