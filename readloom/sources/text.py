"""Line-based text sources."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def clean_list(lines: DataFrame) -> DataFrame:
    """Trimmed lines (value) without blanks, comments and repeats."""
    return lines.select(F.trim("value").alias("value")).where((F.col("value") != "") & ~F.col("value").startswith("#")).distinct()


def ascii_only(col: str):
    """Each run of other characters as one N."""
    return F.regexp_replace(col, r"[^\x00-\x7F]+", "N")
