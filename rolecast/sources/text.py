"""Plain text sources: request logs, batch output and instructions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rolecast.functions import text as X


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """`line`, `line_no` of every non-blank line, bad ones included.

    `line_no` (file, block_start, place) orders lines by file name and then along the file,
    however Spark packs files and blocks into tasks.
    """
    order = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("place"),
    )
    lines = spark.read.text(path).select(F.col("value").alias("line"), order.alias("line_no"))
    return lines.filter(X.has_text(F.col("line")))


def read_instructions(spark: SparkSession, frame_path: str, personas_path: str) -> str:
    """The two instruction files as one system message."""
    texts = [spark.read.text(path, wholetext=True).first() for path in (frame_path, personas_path)]
    return "".join(row["value"] if row else "" for row in texts)
