"""Captured pages arriving on a stream, fetched against the queue as they come."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lexloom.operators import queue
from lexloom.plans.corpus_plans import fetch

_OUTCOMES = (
    "attempt_id BIGINT, document_id STRING, document_type STRING, attempted_at TIMESTAMP_NTZ, ok BOOLEAN, error STRING, "
    "_rank INT, _retries INT, epoch BIGINT"
)


def outcomes(spark: SparkSession, root: str) -> DataFrame:
    """Attempts counted so far, all epochs."""
    try:
        return spark.read.schema(_OUTCOMES).parquet(f"{root}/outcomes")
    except AnalysisException as missing:  # nothing has been fetched yet
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _OUTCOMES)


def tracker_after(tracker: DataFrame, root: str, max_retries: int = 3) -> DataFrame:
    """The queue after all epochs."""
    return queue.apply_attempts(tracker, outcomes(tracker.sparkSession, root), max_retries)


def fetch_stream(
    pages: DataFrame, tracker: DataFrame, root: str, checkpoint: str, doc_type: str, max_retries: int = 3
) -> StreamingQuery:
    """Every micro-batch is one round of ``fetch`` on the queue as the earlier epochs left it.

    An epoch owns a folder of records and one of outcomes. Its round reads only outcomes of earlier epochs, so
    an epoch replayed after a failure, between its two writes or after them, writes the same rows again.
    Captures of a key must arrive in time order, epoch by epoch: one older than the key's last attempt is
    not an attempt any more, as in ``fetch``.
    """

    def round_(batch: DataFrame, epoch: int) -> None:
        spark: SparkSession = batch.sparkSession
        state = queue.apply_attempts(tracker, outcomes(spark, root).filter(F.col("epoch") < epoch), max_retries)
        done = fetch(state, batch, doc_type, max_retries=max_retries)
        done.records.write.mode("overwrite").parquet(f"{root}/records/epoch={epoch}")
        columns = [c.split()[0] for c in _OUTCOMES.split(", ")][:-1]
        done.attempts.select(*columns).write.mode("overwrite").parquet(f"{root}/outcomes/epoch={epoch}")

    return pages.writeStream.foreachBatch(round_).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
