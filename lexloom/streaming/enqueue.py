"""Ids arriving on a stream, queued exactly once."""

from __future__ import annotations

import hashlib

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lexloom.operators.discovery import new_ids
from lexloom.streaming.attempts import key_bucket
from lexloom.streaming.epochs import compact, stored_buckets

_KEYS = ["document_id", "document_type"]
_QUEUE = "document_id STRING, document_type STRING, stream STRING, epoch BIGINT, bucket INT"


def first_seen(found: DataFrame, time: str | None = None, horizon: str = "7 days") -> DataFrame:
    """Each key once. With ``time`` the state is dropped after ``horizon``; without it,
    every key is remembered for good."""
    if time is None:
        return found.dropDuplicates(_KEYS)
    return found.withWatermark(time, horizon).dropDuplicatesWithinWatermark(_KEYS)


def _stream(checkpoint: str) -> str:
    return hashlib.md5(checkpoint.encode()).hexdigest()


def compact_queue(spark: SparkSession, queue_root: str, checkpoint: str) -> int:
    """Merge the folders of a stream's past epochs, between two of its runs; the number of folders left."""
    path = f"{queue_root}/stream={_stream(checkpoint)}"
    return compact(spark, path, "document_id STRING, document_type STRING, epoch BIGINT, bucket INT", lambda rows: rows.drop("epoch").distinct())


def enqueue_stream(
    found: DataFrame, queue_root: str, checkpoint: str, buckets: int | None = None
) -> StreamingQuery:
    """Unbounded horizon without streaming state: every micro-batch is compared with the queue.

    The queue is laid out by key bucket, and a micro-batch reads only the buckets of its
    ids. Each micro-batch of each stream owns one folder and replaces only that, so a batch
    replayed after a failure writes the same rows again. Ids are queued once per stream; two
    streams that run at the same moment on one queue may both queue a new id.
    """
    stream = _stream(checkpoint)
    buckets = stored_buckets(found.sparkSession, queue_root, buckets)

    def add(batch: DataFrame, epoch: int) -> None:
        spark: SparkSession = batch.sparkSession
        ids = batch.select(*_KEYS).distinct().withColumn("bucket", key_bucket(_KEYS, buckets)).persist()
        touched = [r["bucket"] for r in ids.select("bucket").distinct().collect()]  # at most ``buckets``
        own = (F.col("stream") == stream) & (F.col("epoch") == epoch)
        try:
            earlier = spark.read.schema(_QUEUE).parquet(queue_root).filter(F.col("bucket").isin(touched) & ~own)
        except AnalysisException as error:  # first batch: nothing has been queued yet
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            earlier = spark.createDataFrame([], _QUEUE)
        new_ids(ids, earlier).withColumn("bucket", key_bucket(_KEYS, buckets)).repartition("bucket").write.mode(
            "overwrite"
        ).partitionBy("bucket").parquet(f"{queue_root}/stream={stream}/epoch={epoch}")
        ids.unpersist()

    return (
        found.writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
