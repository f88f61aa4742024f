"""Key-list files: one key per line, order and repetitions kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexloom.functions.text import strip


def read_key_list(spark: SparkSession, path: str) -> DataFrame:
    """(pos, document_number) with blank lines dropped.

    Every file block numbers its own lines; block offsets come from one count per
    block, so no task reads more than its share of the list. Files follow each
    other by name.
    """
    block = ["_file", "_start"]
    raw = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_line"),
        strip(F.col("value")).alias("document_number"),
    )
    blocks = raw.groupBy(*block).agg(F.min("_line").alias("_first"), F.count("*").alias("_n"))
    before = Window.orderBy(*block).rowsBetween(Window.unboundedPreceding, -1)
    # One row per file block (128 MB of keys), not per key.
    offsets = blocks.select(
        *block, "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    )
    return (
        raw.filter(F.col("document_number") != "")
        .join(offsets, block)
        .select((F.col("_offset") + F.col("_line") - F.col("_first")).alias("pos"), "document_number")
    )


def key_list_from(df: DataFrame, number: str, pos: str) -> DataFrame:
    """Key list out of a table that carries its own order."""
    return df.select(F.col(pos).alias("pos"), strip(F.col(number)).alias("document_number")).filter(
        F.col("document_number") != ""
    )
