"""Attempt log on a stream to queue state with the retry cap.

Only the first ``max_retries`` attempts of a key in time order can matter (see
``operators.queue``). Each micro-batch is cut to those and appended to a log that
is laid out by key bucket; the state of the keys it touches is the batch fold over
their part of the log. Late or reordered attempts give the batch result, and all
of it runs on built-in expressions. ``compact_attempts`` merges the folders of past epochs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lexloom.operators.queue import earliest_attempts, fold_attempts
from lexloom.streaming.epochs import compact, epochs, stored_buckets, valid

_KEYS = ["document_id", "document_type"]
_LOG = (
    "document_id STRING, document_type STRING, attempt_id BIGINT, attempted_at TIMESTAMP_NTZ, "
    "ok BOOLEAN, error STRING"
)
_STATE = "document_id STRING, document_type STRING, status STRING, retry_count INT, last_attempt TIMESTAMP_NTZ, error_log STRING"


def key_bucket(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def attempt_log(spark: SparkSession, root: str, upto: int | None = None) -> DataFrame:
    """The attempts that can matter, with ``bucket`` and ``epoch``."""
    numbers = [n for n in valid(epochs(spark, f"{root}/log")) if upto is None or n <= upto]
    log = spark.read.schema(f"{_LOG}, epoch BIGINT, bucket INT").parquet(f"{root}/log")
    return log.filter(F.col("epoch").isin(numbers))


def compact_attempts(spark: SparkSession, root: str, max_retries: int = 3) -> int:
    """Fold the closed epochs of log and state; the number of epoch folders left in both. Between two runs only."""
    columns = [c.split()[0] for c in _LOG.split(", ")]
    left = compact(spark, f"{root}/log", f"{_LOG}, epoch BIGINT, bucket INT", lambda rows: earliest_attempts(rows, max_retries).select(*columns, "bucket"))
    newest = Window.partitionBy(*_KEYS).orderBy(F.desc("epoch"))

    def latest(rows: DataFrame) -> DataFrame:
        return rows.withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1").drop("_rank", "epoch")

    return left + compact(spark, f"{root}/state", f"{_STATE}, epoch BIGINT, bucket INT", latest)


def attempt_state(spark: SparkSession, root: str, max_retries: int = 3) -> DataFrame:
    """Queue state of every key after all that has arrived."""
    return fold_attempts(attempt_log(spark, root).select([c.split()[0] for c in _LOG.split(", ")]), max_retries)


def attempt_state_stream(
    attempts: DataFrame, root: str, checkpoint: str, max_retries: int = 3, buckets: int | None = None
) -> StreamingQuery:
    """Append arriving attempts to ``root/log``; write the state of touched keys to ``root/state``.

    A micro-batch owns the folders of its epoch and replaces only them, so one that is
    replayed after a failure writes the same rows again. It reads back only the buckets
    of its keys; the rank cut keeps a key with very many attempts small. ``buckets`` holds for
    a new ``root``; an old one keeps its own.
    """
    buckets = stored_buckets(attempts.sparkSession, root, buckets)

    def fold(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        first = earliest_attempts(batch, max_retries).select([c.split()[0] for c in _LOG.split(", ")])
        first.withColumn("bucket", key_bucket(_KEYS, buckets)).repartition("bucket").write.mode("overwrite").partitionBy(
            "bucket"
        ).parquet(f"{root}/log/epoch={epoch}")
        log = attempt_log(spark, root, epoch)
        own = log.filter(F.col("epoch") == epoch).select("bucket", *_KEYS).distinct()
        touched = [r["bucket"] for r in own.select("bucket").distinct().collect()]  # at most ``buckets``
        known = log.filter(F.col("bucket").isin(touched)).join(own, ["bucket", *_KEYS], "left_semi")
        state = fold_attempts(known.drop("bucket", "epoch"), max_retries).withColumn("bucket", key_bucket(_KEYS, buckets))
        state.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{root}/state/epoch={epoch}")

    return (
        attempts.writeStream.foreachBatch(fold)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
