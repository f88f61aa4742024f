"""Stored tables that records are merged into by key: the newest record of every key stays.

Rows lie in buckets of a hash of their key, under ``rows/v=…/bucket=…``. A merge reads and rewrites only the
buckets its new rows fall into, as a new version beside the old one, and then commits that version by a list
of its buckets under ``commits/v=…``. Readers take of every bucket the last committed version, so a failed
merge changes nothing and its rows are overwritten by the next one. One writer at a time: a second commit of
the same version fails.

* Rows whose key holds a NULL replace nothing and are never replaced.
* Ties in the order columns are decided by a hash of the row, whichever merge it came with.
* New rows must have the table's columns (checked); an empty merge commits nothing.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def _bucket(key: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


def _commits(spark: SparkSession, root: str) -> dict[int, int]:
    """Last committed version of each bucket: one row per bucket, whatever the table's size."""
    try:
        commits = spark.read.schema("bucket INT, buckets INT, v INT").parquet(f"{root}/commits")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}
    return {r.bucket: r.v for r in commits.groupBy("bucket").agg(F.max("v").alias("v")).collect()}


def _rows(spark: SparkSession, root: str, versions: dict[int, int]) -> DataFrame:
    """Rows of these buckets in these versions; the filter is on folders alone."""
    stored = spark.read.parquet(f"{root}/rows")
    if not versions:
        return stored.filter(F.lit(False)).drop("v")
    of = F.create_map(*[F.lit(x) for pair in versions.items() for x in pair])
    return stored.filter(F.col("bucket").isin(*versions) & (F.col("v") == F.try_element_at(of, F.col("bucket")))).drop("v")


def current(spark: SparkSession, root: str) -> DataFrame:
    """The table as of the last commit."""
    return _rows(spark, root, _commits(spark, root)).drop("bucket")


def newest_of(rows: DataFrame, key: list[str], newest: list[str]) -> DataFrame:
    """One row per key, the greatest by ``newest``; rows without a whole key all stay.

    The rank cut runs in every task before the shuffle, so a key with very many rows sends few.
    """
    values = [c for c in rows.columns if c != "bucket"]
    order = [*(F.col(c).desc_nulls_last() for c in newest), F.xxhash64(F.to_json(F.struct(*values))).desc()]
    whole = ~F.greatest(F.lit(False), *(F.col(c).isNull() for c in key))
    ranked = rows.filter(whole).withColumn("_rank", F.row_number().over(Window.partitionBy(*key).orderBy(*order)))
    return ranked.filter("_rank = 1").drop("_rank").union(rows.filter(~whole))


def touched(rows: DataFrame, key: list[str], buckets: int) -> list[int]:
    """Buckets that rows fall into."""
    return sorted(r[0] for r in rows.select(_bucket(key, buckets)).distinct().collect())


def stored_part(spark: SparkSession, root: str, numbers: list[int]) -> DataFrame:
    """Current rows of some buckets."""
    versions = _commits(spark, root)
    return _rows(spark, root, {b: versions[b] for b in numbers if b in versions})


def merge(rows: DataFrame, root: str, key: list[str], newest: list[str], buckets: int = 64) -> int | None:
    """Merge records into the table under ``root``; the version written, or None if there was nothing to do.

    ``buckets`` belongs to the table: choose it so that a bucket is a few files at its final size.
    """
    spark = rows.sparkSession
    numbers = touched(rows, key, buckets)
    if not numbers:
        return None
    versions = _commits(spark, root)
    merged = rows.withColumn("bucket", _bucket(key, buckets))
    version = max(versions.values(), default=-1) + 1
    if versions:
        known = spark.read.parquet(f"{root}/commits").select("buckets").first()[0]
        if known != buckets:
            raise ValueError(f"{root} has {known} buckets, not {buckets}")
        merged = stored_part(spark, root, numbers).unionByName(merged)
    # Few large files: rows are dealt by bucket, and adaptive execution splits a bucket that is too large for a task.
    dealt = newest_of(merged, key, newest).hint("rebalance", "bucket")
    dealt.write.mode("overwrite").partitionBy("bucket").parquet(f"{root}/rows/v={version}")
    listed = spark.createDataFrame([(b, buckets) for b in numbers], "bucket INT, buckets INT")
    listed.coalesce(1).write.mode("errorifexists").parquet(f"{root}/commits/v={version}")
    return version
