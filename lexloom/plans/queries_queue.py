"""Discovery and queue queries on the given tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexloom.operators import discovery as D
from lexloom.operators import queue as Q
from lexloom.plans.corpus_plans import discover, fetch
from lexloom.plans.inputs import ATTEMPTS_SQL, TRACKER_SQL, attempts, law_pages, tracker
from lexloom.plans.queries_corpus import _scratch
from lexloom.plans.registry import query, table
from lexloom.session import materialize
from lexloom.sources import tables
from lexloom.streaming import attempts as stream_attempts
from lexloom.streaming import enqueue as stream_enqueue
from lexloom.streaming import fetch as stream_fetch
from lexloom.streaming.pages import append_to, page_stream

# --- ids from result pages --------------------------------------------------------------------


def _search_pages(spark: SparkSession, d: str) -> DataFrame:
    """Result pages derived from lineitem: two ids worth taking, the rest decoys."""
    a, b = F.col("l_orderkey").cast("string"), F.col("l_partkey").cast("string")
    law = F.concat(
        F.lit('<script>"<p class=\\"nqTitle\\" lawid=\\"1x\\">"</script><p class="nqTitle" lawid=" '), a,
        F.lit(' ">t</p><P lawid=\''), b, F.lit("' class='big nqTitle'>u</P><p class=\"nqTitle\" lawid=\""), a,
        F.lit('"></p><p class="nqTitle" lawid="  "></p><p lawid="9">'),
    )
    judgment = F.concat(
        F.lit('<a class="h5 font-weight-bold" href="/banan/ban-an/so-1-'), a,
        F.lit('/x">t</a><a href=\'https://h/ban-an/y-'), b,
        F.lit("' class='font-weight-bold text h5'></a><a class=\"h5\" href=\"/ban-an/z-7\"></a>"),
        F.lit('<a class="h5 font-weight-bold" href="/tin/z-8"></a>'),
    )
    return table(spark, d, "lineitem", heavy=True).select(
        F.concat_ws("-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice").alias("page"),
        F.col("l_orderkey"), F.col("l_partkey"), law.alias("law_html"), judgment.alias("judgment_html"),
    )


_PAGE_IDS = """
WITH two AS (
  SELECT l_orderkey, l_partkey, CAST(unnest(list_distinct([l_orderkey, l_partkey])) AS VARCHAR) AS document_id
  FROM lineitem)
SELECT l_orderkey, l_partkey, document_id, '{0}' AS document_type FROM two"""


@query("d1_law_ids", _PAGE_IDS.format("law"))
def d1(spark: SparkSession, d: str) -> DataFrame:
    pages = _search_pages(spark, d)
    ids = pages.select("l_orderkey", "l_partkey", F.explode(D.law_ids(F.col("law_html"))).alias("document_id"))
    return ids.withColumn("document_type", F.lit("law"))


@query("d2_judgment_ids", _PAGE_IDS.format("judgment"))
def d2(spark: SparkSession, d: str) -> DataFrame:
    pages = _search_pages(spark, d)
    ids = pages.select(
        "l_orderkey", "l_partkey", F.explode(D.judgment_ids(F.col("judgment_html"))).alias("document_id")
    )
    return ids.withColumn("document_type", F.lit("judgment"))


@query("d1_d2_link_targets", """
SELECT DISTINCT page_id AS page, unnest(regexp_extract_all(html, '<a href="([^"]+)"', 1)) AS document_id,
  'page' AS document_type FROM pages""")
def d1_d2(spark: SparkSession, d: str) -> DataFrame:
    return D.page_ids(
        table(spark, d, "pages"), D.link_hrefs(F.col("html")), "page", page="page_id"
    ).withColumnRenamed("page_id", "page")


@query("d2_query_strings", """
SELECT l_orderkey, l_partkey, unnest(list_distinct([
  '/x?id=' || l_orderkey || '&lang=vi&part=' || l_partkey || '&num=1&sum=2&order=3&copy=4',
  '/y?a=' || l_orderkey || '&b=�&reg1&lt' || chr(38) || 'not',
  '/ban-an/' || l_partkey || '?q=©∂"'])) AS href FROM lineitem""")
def d2_query_strings(spark: SparkSession, d: str) -> DataFrame:
    """Parameters named like character references stay; closed references are decoded."""
    a, b = F.col("l_orderkey").cast("string"), F.col("l_partkey").cast("string")
    html = F.concat(
        F.lit('<a href="/x?id='), a, F.lit("&lang=vi&part="), b, F.lit('&num=1&sum=2&order=3&copy=4">t</a><a class=q href=\'/y?a='), a,
        F.lit("&amp;b=&#0;&reg1&amp;lt&amp;not'>u</a><A HREF=/ban-an/"), b, F.lit("?q=&copy;&part;&quot;>v</a>"),
    )
    return table(spark, d, "lineitem", heavy=True).select("l_orderkey", "l_partkey", F.explode(D.link_hrefs(html)).alias("href"))


# --- enqueue ----------------------------------------------------------------------------------


def _found(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select(
        F.md5("text").alias("document_id"), F.lit("law").alias("document_type")
    )


def _queued(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", F.md5("text").alias("document_id"))
    return table(spark, d, "labels").join(docs, "doc_id").select(
        "document_id", F.when(F.col("toxic") == 1, "judgment").otherwise("law").alias("document_type")
    )


_ENQUEUE = """
found AS (SELECT md5(text) AS document_id, 'law' AS document_type FROM documents),
queued AS (SELECT md5(text) AS document_id, CASE WHEN toxic = 1 THEN 'judgment' ELSE 'law' END AS document_type
  FROM labels JOIN documents USING (doc_id)),
fresh AS (SELECT DISTINCT * FROM found EXCEPT SELECT * FROM queued)"""


@query("d3_enqueue_new", f"""WITH {_ENQUEUE}
SELECT document_id, document_type, 'pending' AS status, 0 AS retry_count FROM fresh""")
def d3(spark: SparkSession, d: str) -> DataFrame:
    return D.enqueue_rows(_found(spark, d), _queued(spark, d)).select(
        "document_id", "document_type", "status", "retry_count"
    )


@query("d3_append_counted", f"""WITH {_ENQUEUE},
both_ AS (SELECT * FROM fresh UNION SELECT DISTINCT CAST(o_custkey AS VARCHAR), 'law' FROM orders)
SELECT (SELECT count(*) FROM fresh) AS first_added, (SELECT count(*) FROM both_) - (SELECT count(*) FROM fresh) AS second_added, 0 AS third_added, (SELECT count(*) FROM both_) AS stored""")
def d3_counted(spark: SparkSession, d: str) -> DataFrame:
    """Three appends to a queue; the last finds nothing new. Each count comes from its own write."""
    root = _scratch(spark, "queue")
    queued, added = _queued(spark, d), []
    customers = table(spark, d, "orders").select(F.col("o_custkey").cast("string").alias("document_id"), F.lit("law").alias("document_type"))
    for found in (_found(spark, d), customers, customers):
        added.append(D.append_counted(D.enqueue_rows(found, queued), root))
        queued = _queued(spark, d).union(spark.read.parquet(root).select("document_id", "document_type"))
    stored = spark.read.parquet(root).agg(F.count("*").alias("stored"))
    return stored.select(*(F.lit(n).cast("bigint").alias(f"{name}_added") for name, n in zip(("first", "second"), added)), F.lit(added[2]).cast("int").alias("third_added"), "stored")


@query("d4_enqueue_process", """
SELECT DISTINCT l_partkey AS document_id, 'law' AS document_type, 'pending' AS status, 0 AS retry_count
FROM lineitem JOIN part ON p_partkey = l_partkey AND p_size > 10
WHERE l_partkey NOT IN (SELECT s_suppkey FROM supplier)""")
def d4(spark: SparkSession, d: str) -> DataFrame:
    found = table(spark, d, "lineitem").select(
        F.col("l_partkey").cast("string").alias("document_id"), F.lit("law").alias("document_type")
    )
    stored = table(spark, d, "part").filter("p_size > 10").select(F.col("p_partkey").alias("id"))
    queued = table(spark, d, "supplier").select(
        F.col("s_suppkey").alias("document_id"), F.lit("law").alias("document_type")
    )
    return D.enqueue_process_rows(found, stored, queued).select(
        "document_id", "document_type", "status", "retry_count"
    )


@query("d5_page_plan", """
WITH s AS (SELECT min(page_id) AS lo, greatest(1, (max(page_id) - min(page_id) + 1) // 4) AS size FROM pages)
SELECT page_id, (page_id - lo) // size AS chunk FROM pages, s""")
def d5(spark: SparkSession, d: str) -> DataFrame:
    return D.plan_pages(table(spark, d, "pages").select("page_id"), "page_id", workers=4)


def _outcomes(spark: SparkSession, d: str) -> DataFrame:
    kind = F.col("event_type")
    return table(spark, d, "events").select(
        F.col("user_id").alias("chunk"),
        F.col("event_id").alias("page"),
        F.when(kind == "view", "found").when(kind == "purchase", "error").otherwise("empty").alias("outcome"),
    )


@query("d6_stop_rule", """
WITH o AS (SELECT user_id AS chunk, event_id AS page,
    CASE event_type WHEN 'view' THEN 'found' WHEN 'purchase' THEN 'error' ELSE 'empty' END AS outcome FROM events),
r AS (SELECT *, count(*) FILTER (WHERE outcome = 'found') OVER (PARTITION BY chunk ORDER BY page) AS island
  FROM o WHERE outcome <> 'error'),
e AS (SELECT *, count(*) FILTER (WHERE outcome = 'empty') OVER (PARTITION BY chunk, island ORDER BY page) AS run FROM r),
s AS (SELECT chunk, min(page) AS stop FROM e WHERE run = 3 AND outcome = 'empty' GROUP BY chunk)
SELECT o.* FROM o LEFT JOIN s USING (chunk) WHERE stop IS NULL OR page <= stop""")
def d6(spark: SparkSession, d: str) -> DataFrame:
    return D.visited_pages(_outcomes(spark, d), max_empty=3, block=1024)


@query("d7_existing_ids", """
SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS document_id FROM orders
WHERE o_totalprice < 250000 AND o_custkey IN (SELECT user_id FROM events)""")
def d7(spark: SparkSession, d: str) -> DataFrame:
    ids = table(spark, d, "events").select(F.col("user_id").cast("string").alias("document_id"))
    return D.existing_ids(ids, tracker(spark, d), "law")


@query("d8_total_added", f"WITH {_ENQUEUE} SELECT count(*) AS total_new FROM fresh")
def d8(spark: SparkSession, d: str) -> DataFrame:
    rows = D.new_ids(_found(spark, d), _queued(spark, d)).withColumn(
        "chunk", F.substring("document_id", 1, 1)
    )
    return D.total_added(D.added_per_chunk(rows, "chunk"))


@query("u1_set_operations", """
SELECT DISTINCT l_partkey AS id FROM lineitem EXCEPT SELECT user_id FROM events""")
def u1(spark: SparkSession, d: str) -> DataFrame:
    ids = table(spark, d, "lineitem").select(F.col("l_partkey").alias("id")).distinct()
    known = table(spark, d, "events").select(F.col("user_id").alias("id")).distinct()
    return ids.join(known, "id", "left_anti")


# --- queue ------------------------------------------------------------------------------------


@query("t1_next_batch", f"""WITH {TRACKER_SQL}
SELECT id, document_id, document_type, status, created_at, retry_count FROM tracker
WHERE document_type = 'law' AND status IN ('pending', 'failed') AND retry_count < 3
ORDER BY created_at NULLS LAST, id LIMIT 100""")
def t1(spark: SparkSession, d: str) -> DataFrame:
    return Q.next_batch(tracker(spark, d), "law").select(
        "id", "document_id", "document_type", "status", "created_at", "retry_count"
    )


@query("t2_retryable", f"""WITH {TRACKER_SQL}
SELECT id, document_id, document_type, status, retry_count FROM tracker
WHERE status IN ('pending', 'failed') AND retry_count < 3""")
def t2(spark: SparkSession, d: str) -> DataFrame:
    return Q.retryable(tracker(spark, d)).select("id", "document_id", "document_type", "status", "retry_count")


@query("t3_apply_outcomes", f"""WITH {TRACKER_SQL}, {ATTEMPTS_SQL},
last AS (SELECT * FROM attempts QUALIFY row_number() OVER (PARTITION BY document_id, document_type
  ORDER BY attempted_at DESC, attempt_id DESC) = 1),
hit AS (SELECT t.id, l.attempted_at, l.ok, l.error FROM last l JOIN (
    SELECT document_id, document_type, min(id) AS id FROM tracker GROUP BY 1, 2) t USING (document_id, document_type))
SELECT t.id, document_id, document_type, created_at,
  CASE WHEN h.id IS NULL THEN status WHEN ok THEN 'success' WHEN retry_count + 1 >= 3 THEN 'failed' ELSE 'pending' END AS status,
  CASE WHEN h.id IS NULL THEN last_attempt ELSE attempted_at END AS last_attempt,
  CASE WHEN h.id IS NULL THEN retry_count WHEN ok THEN 0 ELSE retry_count + 1 END AS retry_count,
  CASE WHEN NOT ok THEN substr(error, 1, 500) END AS error_log
FROM tracker t LEFT JOIN hit h USING (id)""")
def t3(spark: SparkSession, d: str) -> DataFrame:
    return Q.apply_outcomes(tracker(spark, d), attempts(spark, d))


@query("t4_run_summary", f"""WITH {ATTEMPTS_SQL}
SELECT count(*) FILTER (WHERE ok) AS succeeded, count(*) AS attempted FROM attempts""")
def t4(spark: SparkSession, d: str) -> DataFrame:
    return Q.run_summary(attempts(spark, d))


_FOLD = f"""WITH {ATTEMPTS_SQL},
runs AS (SELECT *, count(*) FILTER (WHERE NOT ok) OVER w AS failures,
    row_number() OVER w AS n FROM attempts
  WINDOW w AS (PARTITION BY document_id, document_type ORDER BY attempted_at, attempt_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
ends AS (SELECT document_id, document_type, min(n) AS stop FROM runs WHERE ok OR failures = 3 GROUP BY 1, 2),
honoured AS (SELECT r.* FROM runs r LEFT JOIN ends e USING (document_id, document_type) WHERE stop IS NULL OR n <= stop),
final AS (SELECT * FROM honoured QUALIFY row_number() OVER (PARTITION BY document_id, document_type ORDER BY n DESC) = 1)
SELECT document_id, document_type,
  CASE WHEN ok THEN 'success' WHEN failures >= 3 THEN 'failed' ELSE 'pending' END AS status,
  CAST(CASE WHEN ok THEN 0 ELSE failures END AS INTEGER) AS retry_count, attempted_at AS last_attempt,
  CASE WHEN NOT ok THEN error END AS error_log FROM final"""


@query("t5_fold_attempts", _FOLD)
def t5(spark: SparkSession, d: str) -> DataFrame:
    return Q.fold_attempts(attempts(spark, d))


@query("t6_mark_processed", """
SELECT d.doc_id AS id, d.doc_id AS document_id, lang AS document_type,
  CASE WHEN quality IS NULL THEN 'pending' WHEN quality = 1 THEN 'success' ELSE 'failed' END AS status,
  CASE WHEN quality IS NOT NULL THEN TIMESTAMP '2024-01-01 00:00:00' END AS finished_at
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""")
def t6(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").select(
        F.col("doc_id").alias("id"),
        F.col("doc_id").alias("document_id"),
        F.col("lang").alias("document_type"),
        F.lit("pending").alias("status"),
        F.lit(None).cast("timestamp_ntz").alias("finished_at"),
    )
    outcomes = table(spark, d, "labels").select(
        F.col("doc_id").alias("document_id"),
        F.when(F.col("quality") == 1, "success").otherwise("failed").alias("status"),
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("finished_at"),
    )
    return Q.mark_processed(rows, outcomes)


@query("t7_failure_rows", """
SELECT doc_id AS document_id, 'law' AS document_type, 'failed' AS status,
  '[2024-01-01 00:00:00] Error processing ' || doc_id || ': quality 0' AS error_log, 1 AS retry_count
FROM labels WHERE quality = 0""")
def t7(spark: SparkSession, d: str) -> DataFrame:
    failed = table(spark, d, "labels").filter("quality = 0").select(
        F.col("doc_id").alias("document_id"), F.lit("quality 0").alias("error")
    )
    at = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    return Q.failure_rows(failed, "law", at).drop("id")


_STATUS_TABLES = ("documents", "labels", "conversations", "pages")


@query("t8_table_status", " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, count(*) AS count, CASE WHEN count(*) > 0 THEN 'Có dữ liệu' ELSE 'Trống' END AS status FROM {n}"
    for n in _STATUS_TABLES))
def t8(spark: SparkSession, d: str) -> DataFrame:
    return Q.table_status({n: table(spark, d, n) for n in _STATUS_TABLES})


@query("r3_compacted_attempts", _FOLD)
def r3_compacted(spark: SparkSession, d: str) -> DataFrame:
    """Two runs of the attempt stream with a compaction after each: the log's state is that of the whole log."""
    root, source = _scratch(spark, "attempts"), _scratch(spark, "events-in")
    for part in range(2):
        for half in range(3):
            rows = table(spark, d, "events").filter(F.pmod(F.xxhash64("event_id"), F.lit(6)) == 3 * part + half)
            rows.coalesce(1).write.mode("append").parquet(source)
        log = _attempts_of(page_stream(spark, source, _EVENTS, files_per_batch=1))
        stream_attempts.attempt_state_stream(log, root, f"{root}-checkpoint").awaitTermination()
        stream_attempts.compact_attempts(spark, root)
    return stream_attempts.attempt_state(spark, root)


@query("t8_stored_status", " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, count(*) AS count, CASE WHEN count(*) > 0 THEN 'Có dữ liệu' ELSE 'Trống' END AS status FROM {n}"
    for n in _STATUS_TABLES))
def t8_stored(spark: SparkSession, d: str) -> DataFrame:
    """Counts from the footers of the files."""
    return Q.stored_status(spark, {n: f"{d}/{n}.parquet" for n in _STATUS_TABLES})


# --- streams ----------------------------------------------------------------------------------

_EVENTS = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"


def _in_files(df: DataFrame, key: str, name: str) -> tuple[str, int]:
    """Folder with the rows dealt by a hash of ``key`` over files, and how many of them make a quarter."""
    path, quarter = _scratch(df.sparkSession, name), -(-int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 4)
    df.repartition(4 * quarter, F.xxhash64(key)).write.parquet(path)
    return path, quarter


def _attempts_of(events: DataFrame) -> DataFrame:
    return events.filter(F.col("event_type").isin("purchase", "error")).select(
        F.col("event_id").alias("attempt_id"),
        F.col("user_id").cast("string").alias("document_id"),
        F.lit("law").alias("document_type"),
        F.col("ts").alias("attempted_at"),
        (F.col("event_type") == "purchase").alias("ok"),
        F.when(
            F.col("event_type") == "error", F.concat(F.lit("attempt "), F.col("event_id"), F.lit(" failed"))
        ).alias("error"),
    )


@query("r2_enqueue_stream", f"WITH {_ENQUEUE} SELECT DISTINCT document_id, document_type FROM found")
def r2(spark: SparkSession, d: str) -> DataFrame:
    root = _scratch(spark, "queue")
    docs, quarter = _in_files(table(spark, d, "documents").select("doc_id", "text"), "doc_id", "documents-in")
    found = page_stream(spark, docs, "doc_id BIGINT, text STRING", files_per_batch=quarter)
    found = found.select(F.md5("text").alias("document_id"), F.lit("law").alias("document_type"))
    stream_enqueue.enqueue_stream(found, root, f"{root}-checkpoint").awaitTermination()
    return spark.read.parquet(root).select("document_id", "document_type")


@query("r2_first_seen_horizon", """
SELECT document_id, document_type, CAST(unnest([0, 4]) AS INTEGER) AS arrival FROM (SELECT DISTINCT md5(text) AS document_id, 'law' AS document_type FROM documents)""")
def r2_horizon(spark: SparkSession, d: str) -> DataFrame:
    """Ids arrive, again two days later (inside the horizon of a week, dropped), and after forty days (new again).

    Between them other arrivals move the watermark past the horizon, so that the state of the first ones goes.
    """
    root = _scratch(spark, "arrivals")
    ids = table(spark, d, "documents").select(F.md5("text").alias("document_id"), F.lit("law").alias("document_type"), (F.col("doc_id") % 5).alias("day"))
    marks = spark.range(0, 1, 1, 1).select(F.lit("mark").alias("document_id"), F.lit("mark").alias("document_type"), F.lit(0).cast("bigint").alias("day"))
    out = _scratch(spark, "first-seen")
    # One run of the stream after each arrival: state and watermark carry over, whatever the number of its files.
    for n, (rows, after) in enumerate(((ids, 0), (ids, 2), (marks, 30), (marks, 31), (ids, 40))):
        at = F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(F.col("day").cast("int") + after)
        rows.select("document_id", "document_type", at.alias("seen_at"), F.lit(n).alias("arrival")).write.mode("append").parquet(root)
        stream = page_stream(spark, root, "document_id STRING, document_type STRING, seen_at TIMESTAMP, arrival INT")
        append_to(stream_enqueue.first_seen(stream, "seen_at", "7 days"), out, f"{out}-checkpoint").awaitTermination()
    return spark.read.parquet(out).filter("document_type = 'law'").select("document_id", "document_type", "arrival")


@query("r3_attempt_stream", _FOLD)
def r3(spark: SparkSession, d: str) -> DataFrame:
    """Events in four micro-batches, dealt by their id and so not in time order: the last
    state written for a key is that of the whole log."""
    root = _scratch(spark, "attempts")
    source, quarter = _in_files(table(spark, d, "events"), "event_id", "events-in")
    events = page_stream(spark, source, _EVENTS, files_per_batch=quarter)
    log = _attempts_of(events)
    stream_attempts.attempt_state_stream(log, root, f"{root}-checkpoint").awaitTermination()
    keys = ["document_id", "document_type"]
    values = ["status", "retry_count", "last_attempt", "error_log"]
    last = Window.partitionBy(*keys).orderBy(F.desc("epoch"))
    latest = spark.read.parquet(f"{root}/state").withColumn("_rank", F.row_number().over(last)).filter("_rank = 1")
    return latest.select(*keys, *values)


# --- whole rounds -----------------------------------------------------------------------------


_TWICE = 10**12  # ids of second rows of a key


_FETCH = f"""
WITH t AS (
  SELECT *, doc_id % 5 = 0 AS twice, CASE WHEN source = 'src3' THEN 'none' WHEN source = 'src7' OR lang = 'de' THEN 'failed' ELSE 'ok' END AS outcome,
    doc_id % 10 = 0 AS stored, CAST(doc_id % 3 AS INTEGER) AS own FROM documents),
r AS (
  SELECT *, CASE WHEN NOT twice THEN own WHEN stored THEN 1 ELSE greatest(own, 1) END AS used FROM t),
q AS (
  SELECT doc_id AS id, *, stored AS done, own AS retry FROM r
  UNION ALL SELECT doc_id + {_TWICE}, *, false, 1 FROM r WHERE twice)
SELECT id, CAST(doc_id AS VARCHAR) AS document_id,
  CASE WHEN outcome = 'ok' OR done THEN 'success' WHEN outcome = 'failed' AND used + 1 >= 3 THEN 'failed' ELSE 'pending' END AS status,
  CASE WHEN outcome = 'ok' THEN 0 WHEN outcome = 'none' OR done THEN retry ELSE used + 1 END AS retry_count,
  CASE WHEN outcome = 'failed' AND NOT done THEN CASE WHEN source = 'src7' THEN 'HTTP status 404' ELSE 'impossible effective date: 31/02/2020' END END AS error_log,
  CASE WHEN outcome = 'ok' THEN 1 ELSE 0 END AS first_records
FROM q"""


def _fetch_input(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Captures and a queue in which a fifth of the keys stands twice, some with a first row that has succeeded before."""
    at = F.lit("2024-01-01").cast("timestamp_ntz")
    pages = law_pages(spark, d).withColumns({"doc_type": F.lit("law"), "fetched_at": at})
    once = table(spark, d, "documents").select(
        F.col("doc_id").alias("id"),
        F.col("doc_id").cast("string").alias("document_id"),
        F.lit("law").alias("document_type"),
        F.when(F.col("doc_id") % 10 == 0, "success").otherwise("pending").alias("status"),
        at.alias("created_at"),
        F.when(F.col("source") == "src3", at).alias("last_attempt"),
        (F.col("doc_id") % 3).cast("int").alias("retry_count"),
        F.lit(None).cast("string").alias("error_log"),
    )
    changed = {"id": F.col("id") + _TWICE, "status": F.lit("pending"), "retry_count": F.lit(1), "last_attempt": F.lit(None).cast("timestamp_ntz")}
    rows = once.union(once.filter("id % 5 = 0").withColumns(changed))
    return rows, pages


def _with_records(state: DataFrame, **records: DataFrame) -> DataFrame:
    """Queue rows with the number of records of their key in each of ``records``."""
    for name, found in records.items():
        per_key = found.groupBy(F.col("doc_key").alias("document_id")).agg(F.count("*").cast("int").alias(name))
        state = state.join(per_key, "document_id", "left")
    return state.na.fill(0, list(records)).select("id", "document_id", "status", "retry_count", "error_log", *records)


@query("fetch_round", f"SELECT *, 0 AS second_records FROM ({_FETCH})")
def fetch_round(spark: SparkSession, d: str) -> DataFrame:
    """Two rounds over the same captures: the second finds nothing new and changes nothing."""
    rows, pages = _fetch_input(spark, d)
    first = fetch(rows, pages, "law")
    second = fetch(materialize(first.tracker, "tracker"), pages, "law")
    return _with_records(second.tracker, first_records=first.records, second_records=second.records)


@query("fetch_round_bucketed", _FETCH)
def fetch_bucketed(spark: SparkSession, d: str) -> DataFrame:
    """The first round on a queue and captures stored in buckets of type and key."""
    rows, pages = _fetch_input(spark, d)
    buckets, name = int(spark.conf.get("spark.sql.shuffle.partitions")), uuid.uuid4().hex
    rows = tables.write_bucketed(rows, f"queue_{name}", _scratch(spark, "queue"), ["document_type", "document_id"], buckets)
    pages = tables.write_bucketed(pages, f"pages_{name}", _scratch(spark, "pages"), ["doc_type", "doc_key"], buckets)
    done = fetch(rows, pages, "law")
    return _with_records(done.tracker, first_records=done.records)


@query("r1_fetch_stream", _FETCH)
def r1_fetch(spark: SparkSession, d: str) -> DataFrame:
    """The same round as a stream of captures dealt over micro-batches by their key."""
    rows, pages = _fetch_input(spark, d)
    root = _scratch(spark, "fetched")
    source, quarter = _in_files(pages, "doc_key", "captures-in")
    captures = page_stream(spark, source, ", ".join(f"{name} {kind}" for name, kind in pages.dtypes), files_per_batch=quarter)
    queued = materialize(rows, "queued")
    stream_fetch.fetch_stream(captures, queued, root, f"{root}-checkpoint", "law").awaitTermination()
    return _with_records(stream_fetch.tracker_after(queued, root), first_records=spark.read.parquet(f"{root}/records"))


@query("discover_round", """
WITH o AS (SELECT user_id AS chunk, event_id AS page,
    CASE event_type WHEN 'view' THEN 'found' WHEN 'purchase' THEN 'error' ELSE 'empty' END AS outcome FROM events),
r AS (SELECT *, count(*) FILTER (WHERE outcome = 'found') OVER (PARTITION BY chunk ORDER BY page) AS island
  FROM o WHERE outcome <> 'error'),
e AS (SELECT *, count(*) FILTER (WHERE outcome = 'empty') OVER (PARTITION BY chunk, island ORDER BY page) AS run FROM r),
s AS (SELECT chunk, min(page) AS stop FROM e WHERE run = 3 AND outcome = 'empty' GROUP BY chunk),
v AS (SELECT chunk, page FROM o LEFT JOIN s USING (chunk) WHERE outcome = 'found' AND (stop IS NULL OR page <= stop)),
f AS (SELECT CAST(unnest([page // 2, chunk + 1000000]) AS VARCHAR) AS document_id FROM v)
SELECT DISTINCT document_id, 'law' AS document_type, 'pending' AS status, 0 AS retry_count FROM f
WHERE document_id NOT IN (SELECT CAST(o_custkey AS VARCHAR) FROM orders WHERE o_totalprice < 250000)""")
def discover_round(spark: SparkSession, d: str) -> DataFrame:
    """Result pages, one chunk a user: views list two ids, purchases are failed requests, others are empty."""
    tag = '<p class="nqTitle" lawid="'
    html = F.when(
        F.col("event_type") == "view",
        F.concat(F.lit(tag), F.expr("cast(event_id div 2 as string)"), F.lit('">t</p>' + tag), (F.col("user_id") + 1000000).cast("string"), F.lit('">u</p>')),
    ).otherwise(F.lit("<p>no result</p>"))
    pages = table(spark, d, "events").select(
        F.col("user_id").alias("chunk"), F.col("event_id").alias("page"), html.alias("html"),
        F.when(F.col("event_type") == "purchase", 500).otherwise(200).alias("http_status"),
    )
    return discover(pages, tracker(spark, d), "law").select("document_id", "document_type", "status", "retry_count")
