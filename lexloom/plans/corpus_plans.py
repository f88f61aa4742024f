"""End-to-end stages composed from the operators."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexloom.operators import discovery, extraction, queue, structure
from lexloom.session import materialize


def discover(
    pages: DataFrame, tracker: DataFrame, doc_type: str, max_empty: int = 3, page: str = "page"
) -> DataFrame:
    """Result pages (chunk, page, html, http_status) to queue rows for ids not queued yet.

    Pages are parsed once; the stop rule and the ids both read the parsed pages.
    """
    ids = {"law": discovery.law_ids, "judgment": discovery.judgment_ids}[doc_type]
    parsed = pages.withColumn("ids", ids(F.col("html"))).drop("html").withColumn(
        "outcome",
        F.when(F.col("http_status") >= 400, "error").when(F.size("ids") > 0, "found").otherwise("empty"),
    )
    parsed = materialize(parsed.drop("http_status"), "parsed-pages")
    visited = discovery.visited_pages(parsed, max_empty=max_empty, page=page)
    found = discovery.page_ids(visited.filter("outcome = 'found'"), F.col("ids"), doc_type, page)
    return discovery.enqueue_rows(found, tracker)


@dataclass(frozen=True)
class Fetched:
    records: DataFrame
    tracker: DataFrame
    summary: DataFrame
    attempts: DataFrame


def captures_to_try(keys: DataFrame, pages: DataFrame) -> DataFrame:
    """Captures of open keys newer than their last attempt.

    With pages and queue in tables bucketed by type and key (``tables.write_bucketed``) neither is shuffled.
    """
    wanted = keys.select(F.col("document_id").alias("doc_key"), F.col("document_type").alias("doc_type"), "_since")
    fresh = F.col("_since").isNull() | (F.col("fetched_at") > F.col("_since"))
    return pages.join(wanted, ["doc_type", "doc_key"]).filter(fresh).drop("_since")


def fetch(
    tracker: DataFrame, pages: DataFrame, doc_type: str, batch_size: int | None = None, max_retries: int = 3
) -> Fetched:
    """One round: pick the keys worth an attempt, extract their new captures, record every outcome.

    All keys with a retryable row, or those of the ``batch_size`` oldest rows. A capture is an attempt once:
    only those newer than the last attempt of any row of the key count, in time order, as far as the key has
    retries left and up to its first success; that success gives the record and settles all rows of the key.
    Pages are extracted once for all three results.
    """
    keys = queue.open_keys(tracker.filter(F.col("document_type") == doc_type), max_retries)
    if batch_size is not None:
        batch = queue.next_batch(tracker, doc_type, batch_size, max_retries)
        keys = keys.join(batch.select("document_id", "document_type"), ["document_id", "document_type"], "left_semi")
    picked = captures_to_try(keys, pages)
    extract = {"law": extraction.law_records, "judgment": extraction.judgment_records}[doc_type]
    records = materialize(extract(picked, keep=("doc_type", "doc_key", "fetched_at")), "fetched")
    attempt_id = F.xxhash64("doc_type", "doc_key", "fetched_at")
    attempts = records.select(
        attempt_id.alias("attempt_id"),
        F.col("doc_key").alias("document_id"),
        F.col("doc_type").alias("document_type"),
        F.col("fetched_at").alias("attempted_at"),
        F.col("error").isNull().alias("ok"),
        "error",
    ).dropDuplicates(["attempt_id"])
    counted = materialize(queue.honoured(keys, attempts, max_retries), "attempts")
    won = counted.filter("ok").select("attempt_id")
    return Fetched(
        records=records.filter("error IS NULL").withColumn("attempt_id", attempt_id).join(won, "attempt_id").drop("error", "attempt_id"),
        tracker=queue.apply_attempts(tracker, counted, max_retries),
        summary=queue.run_summary(counted),
        attempts=counted,
    )


@dataclass(frozen=True)
class Structured:
    articles: DataFrame
    outcomes: DataFrame
    new_tracker_rows: DataFrame
    tracker: DataFrame | None


def structure_corpus(
    docs: DataFrame,
    stored: DataFrame | None = None,
    rules: structure.RuleTable = structure.STATUTE,
    tracker: DataFrame | None = None,
    at: Column | None = None,
) -> Structured:
    """All documents with content to new articles, one outcome per document, and tracker rows.

    A document that cannot be structured gets status ``failed`` and an error; it does not stop the
    others. The tracker gets a success row per stored article and a failed row per failed document;
    with a ``tracker`` given, the first row of each document is marked with its outcome (``at``: when).
    Articles are computed once and written, as the rows to store and the tracker rows both read them.
    """
    when = F.current_timestamp().cast("timestamp_ntz") if at is None else at
    usable = docs.filter(F.col("content_html").isNotNull()).withColumn(
        "error", F.when(F.col("document_number").isNull(), F.lit("document number missing"))
    )
    rows = structure.articles(
        usable.filter("error IS NULL"),
        "id",
        "document_number",
        structure.paragraphs(F.col("content_html")),
        rules,
    )
    outcomes = usable.select(
        F.col("id").alias("document_id"),
        F.when(F.col("error").isNull(), "success").otherwise("failed").alias("status"),
        "error",
    )
    articles = materialize(structure.first_writer(rows, stored), "articles")
    done = articles.select(
        F.xxhash64("article_id").alias("id"),
        "document_id",
        "article_id",
        F.lit("success").alias("status"),
        F.lit(0).alias("retry_count"),
        F.lit(None).cast("string").alias("error_log"),
    )
    failed = queue.failure_rows(outcomes.filter("status = 'failed'"), "law", when)
    return Structured(
        articles=articles,
        outcomes=outcomes,
        new_tracker_rows=done.unionByName(failed.select("id", "document_id", F.lit(None).cast("string").alias("article_id"), "status", "retry_count", "error_log")),
        tracker=None if tracker is None else queue.mark_processed(tracker, outcomes.select("document_id", "status", when.alias("finished_at"))),
    )
