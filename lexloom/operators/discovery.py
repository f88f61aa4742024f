"""Search-result pages to new queue rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from lexloom.functions.arrays import let
from lexloom.functions.html import INVISIBLE
from lexloom.functions.text import decode_attribute, strip

# Markup that carries ids on the source's result pages.
_LAW_TAG = r"""(?i)<p(?=\s)(?=[^<>]*\sclass\s*=\s*(?:"(?:[^">]*\s)?nqTitle(?:\s[^">]*)?"|'(?:[^'>]*\s)?nqTitle(?:\s[^'>]*)?'|nqTitle[\s>]))[^<>]*>"""
_LAW_ID = r"""(?i)\slawid\s*=\s*("[^">]*"|'[^'>]*'|[^\s"'>]+)"""
_LINK_TAG = r"""(?i)<a(?=\s)(?=[^<>]*\sclass\s*=\s*["'](?:[^"'>]*\s)?h5[\s"'])(?=[^<>]*\sclass\s*=\s*["'](?:[^"'>]*\s)?font-weight-bold[\s"'])[^<>]*>"""
_HREF = r"""(?i)\shref\s*=\s*("[^">]*"|'[^'>]*'|[^\s"'>]+)"""
_JUDGMENT_PATH = "/ban-an/"
DEFAULT_SPAN = 100


def _attribute(tag: Column, pattern: str) -> Column:
    """Decoded value of the attribute, '' without one; the one group of ``pattern`` is the value with its quotes."""

    def plain(value: Column) -> Column:
        quoted = value.startswith('"') | value.startswith("'")
        return F.when(quoted, F.substring(value, F.lit(2), F.length(value) - 2)).otherwise(value)

    return let(let(F.regexp_extract(tag, pattern, 1), plain), decode_attribute)


def _tags(html: Column, pattern: str) -> Column:
    return F.regexp_extract_all(F.regexp_replace(html, INVISIBLE, ""), F.lit(pattern), F.lit(0))


def attribute_values(html: Column, tag_pattern: str, attr_pattern: str) -> Column:
    """Distinct non-empty stripped values of one attribute of matching tags."""
    values = F.transform(_tags(html, tag_pattern), lambda t: strip(_attribute(t, attr_pattern)))
    return F.array_distinct(F.filter(values, lambda v: v != ""))


def law_ids(html: Column) -> Column:
    return attribute_values(html, _LAW_TAG, _LAW_ID)


def link_id(href: Column) -> Column:
    """Text after the last ``-``, up to the next ``/``."""
    return F.substring_index(F.substring_index(href, "-", -1), "/", 1)


def judgment_ids(html: Column) -> Column:
    hrefs = F.filter(
        F.transform(_tags(html, _LINK_TAG), lambda t: _attribute(t, _HREF)),
        lambda h: F.contains(h, F.lit(_JUDGMENT_PATH)),
    )
    return F.array_distinct(F.transform(hrefs, link_id))


def link_hrefs(html: Column) -> Column:
    """Distinct non-empty link targets of a page."""
    return attribute_values(html, r"(?i)<a(?=\s)[^>]*>", _HREF)


def page_ids(pages: DataFrame, ids: Column, doc_type: str, page: str = "page") -> DataFrame:
    """One row per (page, id); ids are distinct within a page by construction."""
    return pages.select(
        F.col(page), F.explode(ids).alias("document_id"), F.lit(doc_type).alias("document_type")
    )


def new_ids(found: DataFrame, tracker: DataFrame) -> DataFrame:
    """Found (document_id, document_type) pairs not in the queue, each once.

    One aggregation over both tables: an id on very many pages, or queued very many
    times, costs one row per task, and there is a single shuffle.
    """
    keys = ["document_id", "document_type"]
    seen = found.select(*keys, F.lit(False).alias("_queued")).union(
        tracker.select(*keys, F.lit(True).alias("_queued"))
    )
    return seen.groupBy(*keys).agg(F.bool_or("_queued").alias("_queued")).filter("NOT _queued").select(*keys)


def enqueue_rows(found: DataFrame, tracker: DataFrame) -> DataFrame:
    """Queue rows to append for new ids; row ids are hashes of the natural key."""
    return new_ids(found, tracker).select(
        F.xxhash64("document_id", "document_type").alias("id"),
        "document_id",
        "document_type",
        F.lit("pending").alias("status"),
        F.current_timestamp().cast("timestamp_ntz").alias("created_at"),
        F.lit(None).cast("timestamp_ntz").alias("last_attempt"),
        F.lit(0).alias("retry_count"),
        F.lit(None).cast("string").alias("error_log"),
    )


def enqueue_process_rows(found: DataFrame, documents: DataFrame, tracker: DataFrame) -> DataFrame:
    """Process-queue rows for new ids that resolve to a stored document."""
    known = documents.select(F.col("id").alias("document_id")).distinct()
    typed = found.select(F.expr("try_cast(document_id AS BIGINT)").alias("document_id"), "document_type")
    return new_ids(typed.join(known, "document_id", "left_semi"), tracker).select(
        F.xxhash64("document_id", "document_type").alias("id"),
        "document_id",
        "document_type",
        F.lit("pending").alias("status"),
        F.lit(0).alias("retry_count"),
    )


def append_counted(rows: DataFrame, path: str) -> int:
    """Append queue rows and return their number, counted by the write itself: no second job."""
    counted = Observation()
    rows.observe(counted, F.count(F.lit(1)).alias("added")).write.mode("append").parquet(path)
    return counted.get["added"]


def existing_ids(ids: DataFrame, tracker: DataFrame, doc_type: str) -> DataFrame:
    """Queued ids among the given ones."""
    return (
        tracker.filter(F.col("document_type") == doc_type)
        .select("document_id")
        .join(ids.select("document_id").distinct(), "document_id", "left_semi")
        .distinct()
    )


def added_per_chunk(new_rows: DataFrame, chunk: str) -> DataFrame:
    return new_rows.groupBy(chunk).agg(F.count("*").alias("added"))


def total_added(per_chunk: DataFrame) -> DataFrame:
    return per_chunk.agg(F.coalesce(F.sum("added"), F.lit(0)).cast("bigint").alias("total_new"))


# --- page plan and stop rule ------------------------------------------------------------------


def chunk_size(n_pages: Column, workers: int) -> Column:
    return F.greatest(F.lit(1), F.floor(n_pages / workers)).cast("bigint")


def page_plan(spark, start: int = 1, end: int | None = None, workers: int = 4) -> DataFrame:
    """Pages ``start..end`` with their chunk; an open end means 101 pages."""
    last = start + DEFAULT_SPAN if end is None else end
    size = chunk_size(F.lit(last - start + 1), workers)
    return spark.range(start, last + 1).select(
        F.col("id").alias("page"), F.floor((F.col("id") - start) / size).cast("bigint").alias("chunk")
    )


def plan_pages(pages: DataFrame, page: str, workers: int) -> DataFrame:
    """Chunk numbers for a table of pages, its span taken from the table."""
    first = pages.agg(F.min(page)).scalar()
    last = pages.agg(F.max(page)).scalar()
    size = chunk_size(last - first + 1, workers)
    return pages.withColumn("chunk", F.floor((F.col(page) - first) / size).cast("bigint"))


def visited_pages(
    outcomes: DataFrame, max_empty: int = 3, block: int = 65536, chunk: str = "chunk", page: str = "page"
) -> DataFrame:
    """Pages a chunk's worker gets to before it stops.

    ``outcome`` is ``found``, ``empty`` or ``error``. The worker stops at the
    ``max_empty``-th consecutive empty page; errors neither count nor reset.

    A chunk may be arbitrarily long, so it is cut into blocks of page numbers.
    Blocks are scanned independently and reduced to a summary (empties at the
    start, empties at the end, first stop inside); only the summaries, one row per
    block, are chained per chunk.
    """
    keys = [chunk, "_block"]
    seen = outcomes.filter(F.col("outcome") != "error").select(
        F.col(chunk),
        F.expr(f"(`{page}` - pmod(`{page}`, {block})) div {block}").alias("_block"),
        F.col(page),
        (F.col("outcome") == "empty").alias("_empty"),
    )
    in_block = Window.partitionBy(*keys).orderBy(page).rowsBetween(Window.unboundedPreceding, 0)
    scanned = (
        seen.withColumn("_full", F.count_if(~F.col("_empty")).over(in_block))
        .withColumn("_empties", F.count_if("_empty").over(in_block))
        .withColumn(
            "_run",
            F.col("_empties")
            - F.coalesce(
                F.last(F.when(~F.col("_empty"), F.col("_empties")), ignorenulls=True).over(in_block),
                F.lit(0),
            ),
        )
    )
    leading = (F.col("_full") == 0) & (F.col("_run") <= max_empty)
    summary = scanned.groupBy(*keys).agg(
        F.max("_full").alias("_full"),
        F.max_by("_run", page).alias("_tail"),
        # At most max_empty entries: page of the 1st, 2nd, ... leading empty.
        *[
            F.min(F.when(leading & (F.col("_run") == n), F.col(page))).alias(f"_lead{n}")
            for n in range(1, max_empty + 1)
        ],
        F.min(
            F.when((F.col("_full") > 0) & (F.col("_run") == max_empty) & F.col("_empty"), F.col(page))
        ).alias("_stop"),
    )
    before = Window.partitionBy(chunk).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    island = Window.partitionBy(chunk, "_island").orderBy("_block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    # Blocks up to and including one that holds a found page start a new island
    # for the blocks after it; the empties carried into a block are the tails of
    # the earlier blocks of its island plus the tail of the block that opened it.
    chained = (
        summary.withColumn("_island", F.coalesce(F.count_if(F.col("_full") > 0).over(before), F.lit(0)))
        .withColumn(
            "_opened_by",
            F.last(F.when(F.col("_full") > 0, F.col("_tail")), ignorenulls=True).over(before),
        )
        .withColumn(
            "_carry",
            F.coalesce(F.sum(F.when(F.col("_full") == 0, F.col("_tail"))).over(island), F.lit(0))
            + F.coalesce("_opened_by", F.lit(0)),
        )
    )
    needed = F.lit(max_empty) - F.col("_carry")
    carried_stop = F.coalesce(
        *[F.when(needed == n, F.col(f"_lead{n}")) for n in range(1, max_empty + 1)]
    )
    stops = chained.groupBy(chunk).agg(F.min(F.least(carried_stop, F.col("_stop"))).alias("_stop_page"))
    return (
        outcomes.join(stops, chunk, "left")
        .filter(F.col("_stop_page").isNull() | (F.col(page) <= F.col("_stop_page")))
        .drop("_stop_page")
    )
