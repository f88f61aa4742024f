"""Table scans, captured pages, appends and JSON columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexloom.schemas import CAPTURED_PAGES, TABLES


def read_table(spark: SparkSession, root: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """Parquet table ``root/name``; ``columns`` prunes the scan."""
    df = spark.read.parquet(f"{root}/{name}")
    return df.select(*columns) if columns else df


def read_jdbc(spark: SparkSession, url: str, table: str, key: str, lo: int, hi: int, parts: int, **options) -> DataFrame:
    """Relational table read in ``parts`` key ranges; filters and columns are pushed down."""
    return (
        spark.read.format("jdbc")
        .options(
            url=url, dbtable=table, partitionColumn=key, lowerBound=lo, upperBound=hi,
            numPartitions=parts, fetchsize=10000, **options,
        )
        .load()
    )


def empty_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame([], TABLES[name])


def captured_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CAPTURED_PAGES).parquet(path)


def failed_fetches(pages: DataFrame) -> DataFrame:
    """Attempt rows of pages whose request failed."""
    return pages.filter(F.col("http_status") >= 400).select(
        F.col("doc_key").alias("document_id"),
        F.col("doc_type").alias("document_type"),
        F.col("fetched_at").alias("attempted_at"),
        F.lit(False).alias("ok"),
        F.concat(F.lit("HTTP status "), F.col("http_status")).alias("error"),
    )


def conform(rows: DataFrame, table: str, natural_key: list[str] | None = None) -> DataFrame:
    """Rows with exactly the columns and types of a table; missing columns are NULL.

    A missing ``id`` is hashed from the natural key.
    """
    if natural_key and "id" not in rows.columns:
        rows = rows.withColumn("id", F.xxhash64(*natural_key))
    schema = empty_table(rows.sparkSession, table).schema
    return rows.select(
        *[
            (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )


def append(rows: DataFrame, path: str, natural_key: list[str] | None = None) -> None:
    """Append rows; a missing ``id`` becomes a hash of the natural key, a missing
    ``created_at`` the current time. A failed job leaves no rows behind."""
    if natural_key and "id" not in rows.columns:
        rows = rows.withColumn("id", F.xxhash64(*natural_key))
    if "created_at" not in rows.columns:
        rows = rows.withColumn("created_at", F.current_timestamp())
    rows.write.mode("append").parquet(path)


def write_snapshot(rows: DataFrame, root: str, version: int) -> str:
    """Write a new version next to the old ones; the version being read is never touched."""
    path = f"{root}/v={version}"
    rows.write.mode("errorifexists").parquet(path)
    return path


def write_bucketed(rows: DataFrame, name: str, path: str, keys: list[str], buckets: int) -> DataFrame:
    """Catalog table ``name`` under ``path``, in buckets of a hash of ``keys``, sorted by them.

    Tables bucketed alike by equal keys (the queue's type and id, the pages' type and key) are joined and
    grouped by those keys without a shuffle. ``buckets`` belongs to the layout: a bucket is read by one task.
    """
    dealt = rows.repartition(buckets, *keys)  # one file a bucket
    dealt.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(name)
    return rows.sparkSession.table(name)


# --- JSON columns -----------------------------------------------------------------------------


def parse_json(c: Column, ddl: str) -> Column:
    return F.from_json(c, ddl)


def text_list(c: Column) -> Column:
    """JSON list of texts; a bare JSON string counts as a one-element list, NULL as empty."""
    return F.coalesce(
        F.from_json(c, T.ArrayType(T.StringType())),
        F.when(c.rlike(r'^\s*"'), F.array(F.get_json_object(F.concat(F.lit('{"v":'), c, F.lit("}")), "$.v"))),
        F.array().cast("array<string>"),
    )


def parties_from_json(c: Column) -> Column:
    """Parties object; each role may be a list or a single text."""

    def role(name: str) -> Column:
        return text_list(F.get_json_object(c, f"$.{name}"))

    def single(name: str) -> Column:
        raw = F.get_json_object(c, f"$.{name}")
        is_text = raw.isNotNull() & ~raw.startswith("[")
        return F.when(is_text, F.array(raw)).otherwise(role(name)).alias(name)

    return F.struct(single("nguyen_don"), single("bi_don"), single("ben_lien_quan"))


def with_json(df: DataFrame, *columns: str) -> DataFrame:
    """Structured columns as JSON text, for text-only sinks."""
    return df.withColumns({c: F.to_json(c) for c in columns})
