"""Captured pages arriving as files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from lexloom.operators.extraction import judgment_records, law_records
from lexloom.operators.structure import STATUTE, RuleTable, articles, paragraphs
from lexloom.schemas import CAPTURED_PAGES
from pyspark.sql import functions as F


def page_stream(
    spark: SparkSession, path: str, schema: str = CAPTURED_PAGES, files_per_batch: int = 1000,
    name_filter: str | None = None,
) -> DataFrame:
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    if name_filter:
        reader = reader.option("pathGlobFilter", name_filter)
    return reader.parquet(path)


def table_stream(spark: SparkSession, root: str, name: str, schema: str) -> DataFrame:
    """The files of table ``root/name.parquet``, which is one file or a folder of them."""
    # A pattern, as a path that is one file itself would have to be a folder.
    return page_stream(spark, f"{root}/{name}.[p]arquet", schema)


def law_stream(pages: DataFrame) -> DataFrame:
    """Typed records of statute pages; the batch operator as it is (no state, no shuffle)."""
    return law_records(pages.filter("doc_type = 'law'"), keep=("doc_type", "doc_key", "fetched_at"))


def judgment_stream(pages: DataFrame) -> DataFrame:
    return judgment_records(pages.filter("doc_type = 'judgment'"), keep=("doc_type", "doc_key", "fetched_at"))


def article_stream(docs: DataFrame, key: str, number: str, html: str, rules: RuleTable = STATUTE) -> DataFrame:
    """Articles of arriving documents; each document lies in one row."""
    return articles(docs.filter(F.col(html).isNotNull()), key, number, paragraphs(F.col(html)), rules)


def append_to(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append everything available, then stop. The sink's log makes a rerun exactly-once."""
    return (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
