"""Work queue: batch selection, outcomes, folds of attempt logs, status counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Queue states, the length of stored errors, messages and labels below.
RETRYABLE = ("pending", "failed")
ERROR_LENGTH = 500
_KEYS = ["document_id", "document_type"]


def retryable(tracker: DataFrame, max_retries: int = 3) -> DataFrame:
    """Rows still worth an attempt, any type; NULL status or count never qualifies."""
    return tracker.filter(
        F.col("status").isin(*RETRYABLE) & (F.col("retry_count") < max_retries)
    )


def next_batch(
    tracker: DataFrame, doc_type: str, batch_size: int = 100, max_retries: int = 3
) -> DataFrame:
    """Oldest retryable rows of one type (top-k: no global sort)."""
    return (
        retryable(tracker, max_retries)
        .filter(F.col("document_type") == doc_type)
        .orderBy(F.col("created_at").asc_nulls_last(), "id")
        .limit(batch_size)
    )


def latest_outcomes(attempts: DataFrame) -> DataFrame:
    """Latest attempt per queue key; the rank cut runs in every task before the shuffle."""
    newest = Window.partitionBy(*_KEYS).orderBy(F.desc("attempted_at"), F.desc("attempt_id"))
    return (
        attempts.withColumn("_rank", F.row_number().over(newest))
        .filter("_rank = 1")
        .select(*_KEYS, F.struct("attempted_at", "ok", "error").alias("_last"))
    )


def first_rows(tracker: DataFrame) -> DataFrame:
    """Smallest id of every key, and the retries of that row: a key queued very often is one row a task."""
    return tracker.groupBy(*_KEYS).agg(
        F.min("id").alias("id"), F.coalesce(F.min_by("retry_count", "id"), F.lit(0)).alias("_retries")
    )


def apply_outcomes(tracker: DataFrame, attempts: DataFrame, max_retries: int = 3) -> DataFrame:
    """Tracker snapshot after one attempt per key; attempts with unknown keys are ignored.

    When a key is queued twice, the first row (smallest id) carries the outcome.
    """
    targets = first_rows(tracker).join(latest_outcomes(attempts), _KEYS).select("id", "_last")
    retry = F.coalesce("retry_count", F.lit(0)) + 1
    hit = F.col("_last").isNotNull()
    ok = hit & F.col("_last.ok")
    return tracker.join(targets, "id", "left").select(
        "id",
        *_KEYS,
        F.when(ok, F.lit("success"))
        .when(hit, F.when(retry >= max_retries, F.lit("failed")).otherwise("pending"))
        .otherwise(F.col("status"))
        .alias("status"),
        "created_at",
        F.when(hit, F.col("_last.attempted_at")).otherwise(F.col("last_attempt")).alias("last_attempt"),
        F.when(ok, F.lit(0)).when(hit, retry).otherwise(F.col("retry_count")).alias("retry_count"),
        F.when(ok, F.lit(None))
        .when(hit, F.substring("_last.error", 1, ERROR_LENGTH))
        .otherwise(F.col("error_log"))
        .alias("error_log"),
    )


def open_keys(tracker: DataFrame, max_retries: int = 3) -> DataFrame:
    """Keys with a row worth an attempt: the retries used and the last attempt of all the key's rows.

    A key queued several times is attempted once a round. Its partial states are summed up in every task.
    """
    retries = F.when(F.col("status").isin(*RETRYABLE) & (F.col("retry_count") < max_retries), F.col("retry_count"))
    states = tracker.groupBy(*_KEYS).agg(F.max(retries).alias("_retries"), F.max("last_attempt").alias("_since"))
    return states.filter("_retries IS NOT NULL")


def honoured(keys: DataFrame, attempts: DataFrame, max_retries: int = 3) -> DataFrame:
    """Attempts that count, with the retries their key (of ``open_keys``) has used, and ``_rank`` in time order.

    Of a key's attempts those count that fit into the retries it has left, up to its first success.
    """
    ranked = earliest_attempts(attempts, max_retries).join(keys.select(*_KEYS, "_retries"), _KEYS)
    ranked = ranked.filter(F.col("_rank") <= max_retries - F.col("_retries"))
    until = Window.partitionBy(*_KEYS).orderBy("_rank").rowsBetween(Window.unboundedPreceding, -1)
    return ranked.withColumn("_won", F.coalesce(F.bool_or("ok").over(until), F.lit(False))).filter("NOT _won").drop("_won")


def apply_attempts(tracker: DataFrame, counted: DataFrame, max_retries: int = 3) -> DataFrame:
    """Tracker snapshot after the attempts that ``honoured`` found, any number per key.

    A success settles every row of its key; a failure those that were worth an attempt.
    """
    # Later rounds count only later attempts, so time orders the attempts of several rounds as well.
    ends = Window.partitionBy(*_KEYS).orderBy(F.desc("attempted_at"), F.desc("_rank"))
    last = counted.withColumn("_back", F.row_number().over(ends)).filter("_back = 1").select(
        *_KEYS, F.struct("attempted_at", "ok", "error", (F.col("_retries") + F.col("_rank")).alias("retries")).alias("_last")
    )
    worth = F.coalesce(F.col("status").isin(*RETRYABLE) & (F.col("retry_count") < max_retries), F.lit(False))
    ok = F.coalesce(F.col("_last.ok"), F.lit(False))
    hit = F.col("_last").isNotNull() & (ok | worth)
    return tracker.join(last, _KEYS, "left").select(
        "id",
        *_KEYS,
        F.when(ok, F.lit("success"))
        .when(hit, F.when(F.col("_last.retries") >= max_retries, F.lit("failed")).otherwise("pending"))
        .otherwise(F.col("status"))
        .alias("status"),
        "created_at",
        F.when(hit, F.col("_last.attempted_at")).otherwise(F.col("last_attempt")).alias("last_attempt"),
        F.when(ok, F.lit(0)).when(hit, F.col("_last.retries")).otherwise(F.col("retry_count")).alias("retry_count"),
        F.when(ok, F.lit(None))
        .when(hit, F.substring("_last.error", 1, ERROR_LENGTH))
        .otherwise(F.col("error_log"))
        .alias("error_log"),
    )


def run_summary(outcomes: DataFrame) -> DataFrame:
    """Successes and attempts of one run."""
    return outcomes.agg(
        F.count_if("ok").alias("succeeded"), F.count("*").alias("attempted")
    )


def earliest_attempts(attempts: DataFrame, max_retries: int) -> DataFrame:
    """The first ``max_retries`` attempts of every key, with their rank.

    Every honoured attempt ends the key (success) or uses up a retry, so no later
    attempt can matter. Spark applies the rank cut in every task before the
    shuffle: a key with a huge log sends ``max_retries`` rows per task.
    """
    order = Window.partitionBy(*_KEYS).orderBy("attempted_at", "attempt_id")
    return attempts.withColumn("_rank", F.row_number().over(order)).filter(
        F.col("_rank") <= max_retries
    )


def fold_attempts(attempts: DataFrame, max_retries: int = 3) -> DataFrame:
    """Queue state after a whole attempt log.

    Attempts of a key count in time order up to its first success or its
    ``max_retries``-th failure. The fold reuses the partitioning and the order of
    the rank cut.
    """
    # One column per honoured attempt; all before the first success are failures.
    per_key = earliest_attempts(attempts, max_retries).groupBy(*_KEYS).agg(
        F.min(F.when(F.col("ok"), F.col("_rank"))).alias("_won"),
        F.count("*").alias("_n"),
        *[
            F.max(F.when(F.col("_rank") == n, F.struct("attempted_at", "error"))).alias(f"_a{n}")
            for n in range(1, max_retries + 1)
        ],
    )
    won = F.col("_won").isNotNull()
    at_end = F.coalesce("_won", "_n")
    last = F.coalesce(
        *[F.when(at_end == n, F.col(f"_a{n}")) for n in range(1, max_retries + 1)]
    )
    return per_key.withColumn("_last", last).select(
        *_KEYS,
        F.when(won, "success")
        .when(F.col("_n") >= max_retries, "failed")
        .otherwise("pending")
        .alias("status"),
        F.when(won, 0).otherwise(F.col("_n")).cast("int").alias("retry_count"),
        F.col("_last.attempted_at").alias("last_attempt"),
        F.when(~won, F.substring("_last.error", 1, ERROR_LENGTH)).alias("error_log"),
    )


def mark_processed(tracker: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Process rows with the status of their document's outcome; others unchanged.

    ``outcomes`` holds one row per document: document_id, status, finished_at.
    """
    new = outcomes.select(
        "document_id", F.col("status").alias("_status"), F.col("finished_at").alias("_finished_at")
    )
    first = tracker.groupBy("document_id").agg(F.min("id").alias("id"))
    targets = first.join(new, "document_id").select("id", "_status", "_finished_at")
    others = [c for c in tracker.columns if c not in ("status", "finished_at")]
    return tracker.join(targets, "id", "left").select(
        *others,
        F.coalesce("_status", "status").alias("status"),
        F.coalesce("_finished_at", "finished_at").alias("finished_at"),
    )


def failure_rows(failed: DataFrame, doc_type: str, at: Column | None = None) -> DataFrame:
    """Process-tracker rows for documents whose structuring failed (document_id, error)."""
    when = F.current_timestamp().cast("timestamp_ntz") if at is None else at
    return failed.select(
        F.xxhash64("document_id", F.lit(doc_type)).alias("id"),
        "document_id",
        F.lit(doc_type).alias("document_type"),
        F.lit("failed").alias("status"),
        F.concat(
            F.lit("["), when.cast("string"), F.lit("] Error processing "),
            F.col("document_id").cast("string"), F.lit(": "), F.col("error"),
        ).alias("error_log"),
        F.lit(1).alias("retry_count"),
    )


def table_status(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per table with a has-data label."""
    counts = [
        df.agg(F.count("*").alias("count")).select(F.lit(name).alias("table_name"), "count")
        for name, df in tables.items()
    ]
    out = counts[0]
    for other in counts[1:]:
        out = out.unionByName(other)
    return out.withColumn("status", F.when(F.col("count") > 0, "Có dữ liệu").otherwise("Trống"))


def stored_status(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """``table_status`` of Parquet tables, counted from the footers of their files: no column is read.

    Footers are asked through a session of its own, whose settings differ from the caller's.
    """
    session = spark.newSession()
    session.conf.set("spark.sql.sources.useV1SourceList", "")
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return table_status({name: session.read.parquet(path) for name, path in paths.items()})
