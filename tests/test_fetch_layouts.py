"""Fetching on bucketed tables and on a stream; what reads and keeps little."""

import uuid
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from lexloom.operators import queue as Q
from lexloom.plans.corpus_plans import captures_to_try, fetch
from lexloom.session import scratch_path
from lexloom.sources import tables
from lexloom.streaming import enqueue, pages
from lexloom.streaming import fetch as stream_fetch

T0 = datetime(2024, 1, 1)
QUEUE = "id BIGINT, document_id STRING, document_type STRING, status STRING, created_at TIMESTAMP_NTZ, last_attempt TIMESTAMP_NTZ, retry_count INT, error_log STRING"
PAGES = "doc_type STRING, doc_key STRING, html STRING, fetched_at TIMESTAMP_NTZ, http_status INT"
PAGE = '<div id="divThuocTinh"><table><tr><td><b>Số hiệu:</b></td><td>{}</td></tr></table></div>'


def queued(spark, keys="abcd"):
    return spark.createDataFrame([(i, k, "law", "pending", T0, None, 0, None) for i, k in enumerate(keys + keys[0])], QUEUE)


def captures(spark, rows):
    return spark.createDataFrame([("law", k, PAGE.format(f"{k}{m}"), T0 + timedelta(minutes=m), s) for k, s, m in rows], PAGES)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bucketed_tables_join_without_a_shuffle(spark):
    n = uuid.uuid4().hex
    state = tables.write_bucketed(queued(spark), f"q_{n}", scratch_path(spark, "q"), ["document_type", "document_id"], 4)
    found = tables.write_bucketed(captures(spark, [("a", 200, 1), ("b", 500, 1)]), f"p_{n}", scratch_path(spark, "p"), ["doc_type", "doc_key"], 4)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        picked = captures_to_try(Q.open_keys(state.filter("document_type = 'law'")), found)
        assert "SortMergeJoin" in plan(picked) and "Exchange" not in plan(picked)
        plain = captures_to_try(Q.open_keys(queued(spark)), captures(spark, [("a", 200, 1)]))
        assert "Exchange" in plan(plain)
        assert {r.doc_key for r in picked.collect()} == {"a", "b"}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


ROUNDS = [[("a", 500, 1), ("b", 200, 1)], [("a", 200, 2), ("b", 200, 2), ("c", 404, 2)], [("c", 404, 3), ("c", 404, 4), ("c", 200, 5), ("x", 200, 1)]]


def state_of(df):
    return sorted((r.id, r.status, r.retry_count, r.last_attempt, r.error_log) for r in df.collect())


def test_stream_of_captures_equals_one_round(spark):
    root, source = scratch_path(spark, "fetched"), scratch_path(spark, "captures")
    state = queued(spark)
    for part in ROUNDS:
        captures(spark, part).coalesce(1).write.mode("append").parquet(source)
    stream = pages.page_stream(spark, source, PAGES, files_per_batch=1)
    stream_fetch.fetch_stream(stream, state, root, f"{root}-checkpoint", "law").awaitTermination()
    whole = fetch(state, captures(spark, sum(ROUNDS, [])), "law")
    got = stream_fetch.tracker_after(state, root)
    assert state_of(got) == state_of(whole.tracker)
    records = lambda df: sorted((r.doc_key, r.document_number, r.fetched_at) for r in df.collect())
    assert records(spark.read.parquet(f"{root}/records").drop("epoch")) == records(whole.records) == [("a", "a2", T0 + timedelta(minutes=2)), ("b", "b1", T0 + timedelta(minutes=1))]


def test_replayed_epoch_changes_nothing(spark):
    """The second epoch again, under a new checkpoint that has seen only the first: same folders, same rows."""
    root, state = scratch_path(spark, "fetched"), queued(spark)
    source = scratch_path(spark, "captures")
    for part in ROUNDS:
        captures(spark, part).coalesce(1).write.mode("append").parquet(source)
    run = lambda c: stream_fetch.fetch_stream(pages.page_stream(spark, source, PAGES, files_per_batch=1), state, root, f"{root}-{c}", "law").awaitTermination()
    run("first")
    before = state_of(stream_fetch.tracker_after(state, root)), sorted(map(str, spark.read.parquet(f"{root}/records").collect()))
    run("again")  # every epoch is replayed
    assert (state_of(stream_fetch.tracker_after(state, root)), sorted(map(str, spark.read.parquet(f"{root}/records").collect()))) == before


def test_first_seen_forgets_after_the_horizon(spark):
    source, out = scratch_path(spark, "arrivals"), scratch_path(spark, "seen")
    for ids, day in ((range(50), 0), (range(50), 3), (["m"], 30), (["m"], 31), (range(5), 40)):
        rows = [(str(i), "law", T0 + timedelta(days=day)) for i in ids]
        spark.createDataFrame(rows, "document_id STRING, document_type STRING, seen_at TIMESTAMP").coalesce(1).write.mode("append").parquet(source)
    stream = pages.page_stream(spark, source, "document_id STRING, document_type STRING, seen_at TIMESTAMP", files_per_batch=1)
    query = pages.append_to(enqueue.first_seen(stream, "seen_at", "7 days"), out, f"{out}-checkpoint")
    query.awaitTermination()
    held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert max(held) >= 50 and held[-1] < 10
    seen = spark.read.parquet(out).groupBy("document_id").count().collect()
    assert {r.document_id: r["count"] for r in seen if r.document_id != "m"} == {str(i): 1 + (i < 5) for i in range(50)}


def test_counts_from_footers(spark):
    path = scratch_path(spark, "counted")
    spark.range(1000).select("id", F.lit("x" * 100).alias("text")).write.parquet(path)
    counts = Q.stored_status(spark, {"t": path})
    assert "PushedAggregation: [COUNT(*)]" in plan(counts) and "text" not in plan(counts)
    assert counts.first()["count"] == 1000
    assert spark.conf.get("spark.sql.sources.useV1SourceList") != ""
