import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from lexloom.operators import discovery as D
from lexloom.operators import queue as Q
from lexloom.plans.corpus_plans import discover, fetch

T0 = datetime(2024, 1, 1)
TRACKER = (
    "id BIGINT, document_id STRING, document_type STRING, status STRING, created_at TIMESTAMP_NTZ, "
    "last_attempt TIMESTAMP_NTZ, retry_count INT, error_log STRING"
)
ATTEMPTS = (
    "attempt_id BIGINT, document_id STRING, document_type STRING, attempted_at TIMESTAMP_NTZ, ok BOOLEAN, error STRING"
)


def attempts(spark, logs):
    rows = []
    for key, log in logs.items():
        for i, a in enumerate(log):
            rows.append((len(rows), key, "law", T0 + timedelta(minutes=i), a == "S", None if a == "S" else f"e{i}"))
    return spark.createDataFrame(rows, ATTEMPTS)


def step_by_step(log, max_retries=3):
    status, retry, last, error = "pending", 0, None, None
    for i, a in enumerate(log):
        if status == "success" or retry >= max_retries:
            break
        last = i
        if a == "S":
            status, retry, error = "success", 0, None
        else:
            retry += 1
            error = f"e{i}"
            status = "failed" if retry >= max_retries else "pending"
    return status, retry, None if last is None else T0 + timedelta(minutes=last), error


def test_next_batch(spark):
    rows = [
        (1, "a", "law", "pending", T0, None, 0, None),
        (2, "b", "law", "failed", T0 - timedelta(days=1), None, 2, None),
        (3, "c", "law", "failed", T0, None, 3, None),
        (4, "d", "law", None, T0, None, 0, None),
        (5, "e", "law", "pending", T0, None, None, None),
        (6, "f", "law", "pending", None, None, 0, None),
        (7, "g", "judgment", "pending", T0, None, 0, None),
        (8, "h", "law", "success", T0, None, 0, None),
    ]
    tracker = spark.createDataFrame(rows, TRACKER)
    assert [r.id for r in Q.next_batch(tracker, "law").collect()] == [2, 1, 6]
    assert [r.id for r in Q.next_batch(tracker, "law", batch_size=1).collect()] == [2]
    assert sorted(r.id for r in Q.retryable(tracker).collect()) == [1, 2, 6, 7]


@pytest.mark.parametrize("log", ["FFS", "FFFS", "F", "S", "SFF", "FSF", "FFF", "FFFFFF"])
def test_fold_cases(spark, log):
    r = Q.fold_attempts(attempts(spark, {"k": log})).first()
    assert (r.status, r.retry_count, r.last_attempt, r.error_log) == step_by_step(log)


@pytest.mark.parametrize("max_retries", [1, 3, 5])
def test_fold_matches_step_by_step(spark, max_retries):
    rng = random.Random(3)
    logs = {f"k{i}": "".join(rng.choices("SF", [1, 4], k=rng.randrange(1, 12))) for i in range(500)}
    got = {
        r.document_id: (r.status, r.retry_count, r.last_attempt, r.error_log)
        for r in Q.fold_attempts(attempts(spark, logs), max_retries).collect()
    }
    assert got == {k: step_by_step(log, max_retries) for k, log in logs.items()}


def test_fold_cuts_ranks_before_the_shuffle(spark):
    plan = Q.fold_attempts(attempts(spark, {"k": "FS"}))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # in each task, then after the exchange


def test_apply_outcomes(spark):
    rows = [
        (1, "a", "law", "pending", T0, None, 0, "old"),
        (2, "a", "law", "pending", T0, None, 0, None),
        (3, "b", "law", "pending", T0, None, 2, None),
        (4, "c", "law", "failed", T0, None, 1, None),
        (5, "d", "judgment", "pending", T0, None, 0, None),
    ]
    log = [
        (1, "a", "law", T0, True, None),
        (2, "b", "law", T0, False, "x" * 600),
        (3, "c", "law", T0, False, "y"),
        (4, "d", "law", T0, True, None),
        (5, "zzz", "law", T0, True, None),
    ]
    got = {
        r.id: (r.status, r.retry_count, r.last_attempt, r.error_log)
        for r in Q.apply_outcomes(spark.createDataFrame(rows, TRACKER), spark.createDataFrame(log, ATTEMPTS)).collect()
    }
    assert got == {
        1: ("success", 0, T0, None),
        2: ("pending", 0, None, None),
        3: ("failed", 3, T0, "x" * 500),
        4: ("pending", 2, T0, "y"),
        5: ("pending", 0, None, None),
    }


def visit(outcomes, max_empty):
    """Plain loop over one chunk: pages the worker gets to."""
    empty, seen = 0, []
    for page, o in outcomes:
        seen.append(page)
        if o == "empty":
            empty += 1
            if empty >= max_empty:
                break
        elif o == "found":
            empty = 0
    return seen


def test_stop_rule_golden(spark):
    letters = {"n": "found", "e": "empty", "x": "error"}
    rows = [(0, i, letters[c]) for i, c in enumerate("neenexeen", 1)]
    df = spark.createDataFrame(rows, "chunk INT, page BIGINT, outcome STRING")
    assert sorted(r.page for r in D.visited_pages(df).collect()) == list(range(1, 9))


@pytest.mark.parametrize("block", [1, 3, 1000])
def test_stop_rule_matches_loop(spark, block):
    rng = random.Random(block)
    chunks = {
        c: [(p, rng.choices(["found", "empty", "error"], [2, 4, 3])[0]) for p in sorted(rng.sample(range(60), rng.randrange(1, 40)))]
        for c in range(300)
    }
    df = spark.createDataFrame(
        [(c, p, o) for c, pages in chunks.items() for p, o in pages], "chunk INT, page BIGINT, outcome STRING"
    )
    got = {}
    for r in D.visited_pages(df, max_empty=3, block=block).collect():
        got.setdefault(r.chunk, []).append(r.page)
    assert {c: sorted(p) for c, p in got.items()} == {c: visit(p, 3) for c, p in chunks.items()}


def test_page_plan(spark):
    rows = D.page_plan(spark, 1, 10, workers=4).collect()
    assert [(r.page, r.chunk) for r in rows] == [(p, (p - 1) // 2) for p in range(1, 11)]
    assert D.page_plan(spark, 5).count() == 101
    assert {r.chunk for r in D.page_plan(spark, 1, 2, workers=8).collect()} == {0, 1}


def test_enqueue(spark):
    found = spark.createDataFrame([("1", "law"), ("1", "law"), ("2", "law"), ("3", "law")], "document_id STRING, document_type STRING")
    queued = spark.createDataFrame([("2", "law"), ("3", "judgment"), ("2", "law")], "document_id STRING, document_type STRING")
    rows = {r.document_id: r for r in D.enqueue_rows(found, queued).collect()}
    assert set(rows) == {"1", "3"}
    assert (rows["1"].status, rows["1"].retry_count, rows["1"].last_attempt) == ("pending", 0, None)
    docs = spark.createDataFrame([(1,), (2,)], "id BIGINT")
    none = spark.createDataFrame([], "document_id BIGINT, document_type STRING")
    assert sorted(r.document_id for r in D.enqueue_process_rows(found, docs, none).collect()) == [1, 2]
    assert sorted(r.document_id for r in D.existing_ids(found, queued, "law").collect()) == ["2"]


def test_discover_stage(spark):
    hit = '<p class="nqTitle" lawid="{}"></p>'
    pages = [(0, 1, hit.format(1), 200), (0, 2, "", 200), (0, 3, "", 500), (0, 4, "", 200), (0, 5, hit.format(5), 200), (1, 6, hit.format(6), 200)]
    df = spark.createDataFrame(pages, "chunk INT, page BIGINT, html STRING, http_status INT")
    queued = spark.createDataFrame([("1", "law")], "document_id STRING, document_type STRING")
    assert [r.document_id for r in discover(df, queued, "law", max_empty=2).collect()] == ["6"]


def test_fetch_stage(spark):
    rows = [(i, k, "law", "pending", T0, None, 0, None) for i, k in enumerate("abc")]
    page = '<div id="divThuocTinh"><table><tr><td><b>Số hiệu:</b></td><td>N</td></tr></table></div>'
    pages = [("law", "a", page, T0, 200), ("law", "b", page, T0, 500)]
    df = spark.createDataFrame(pages, "doc_type STRING, doc_key STRING, html STRING, fetched_at TIMESTAMP_NTZ, http_status INT")
    done = fetch(spark.createDataFrame(rows, TRACKER), df, "law")
    assert [(r.doc_key, r.document_number) for r in done.records.collect()] == [("a", "N")]
    assert {(r.document_id, r.status, r.retry_count) for r in done.tracker.collect()} == {
        ("a", "success", 0), ("b", "pending", 1), ("c", "pending", 0),
    }
    assert done.summary.first().asDict() == {"succeeded": 1, "attempted": 2}


def test_fetch_counts_captures_once(spark):
    """Several new captures fold in time order; old ones, and those past the first success, do not count."""
    page = '<div id="divThuocTinh"><table><tr><td><b>Số hiệu:</b></td><td>{}</td></tr></table></div>'
    rows = [(1, "a", "law", "pending", T0, None, 0, None), (2, "b", "law", "failed", T0, T0, 2, "e"), (3, "c", "law", "pending", T0, None, 0, None)]
    caps = [
        ("a", 500, 0), ("a", 200, 1), ("a", 200, 2), ("b", 200, 0), ("b", 500, 1), ("b", 200, 2), ("c", 404, 0), ("c", 404, 1), ("c", 404, 1),
    ]
    data = [("law", k, page.format(f"{k}{m}"), T0 + timedelta(minutes=m), s) for k, s, m in caps]
    df = spark.createDataFrame(data, "doc_type STRING, doc_key STRING, html STRING, fetched_at TIMESTAMP_NTZ, http_status INT")
    done = fetch(spark.createDataFrame(rows, TRACKER), df, "law")
    assert [(r.doc_key, r.document_number) for r in done.records.collect()] == [("a", "a1")]
    state = {(r.document_id, r.status, r.retry_count, (r.last_attempt - T0).seconds // 60) for r in done.tracker.collect()}
    assert state == {("a", "success", 0, 1), ("b", "failed", 3, 1), ("c", "pending", 2, 1)}
    again = fetch(done.tracker, df, "law")
    assert again.records.count() == 0 and again.tracker.exceptAll(done.tracker).count() == 0


def test_new_ids_take_one_shuffle(spark):
    found = spark.createDataFrame([("1",), ("2",), ("2",)], "document_id STRING").withColumn("document_type", F.lit("law"))
    queued = spark.createDataFrame([("1", "law"), ("2", "judgment")], "document_id STRING, document_type STRING")
    new = D.new_ids(found, queued)
    assert [tuple(r) for r in new.collect()] == [("2", "law")]
    assert new._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") <= 2  # initial and final plan


def test_process_tracker(spark):
    tracker = spark.createDataFrame(
        [(1, 10, "law", "pending", None), (2, 10, "law", "pending", None), (3, 11, "law", "pending", None)],
        "id BIGINT, document_id BIGINT, document_type STRING, status STRING, finished_at TIMESTAMP_NTZ",
    )
    outcomes = spark.createDataFrame([(10, "success", T0), (99, "success", T0)], "document_id BIGINT, status STRING, finished_at TIMESTAMP_NTZ")
    got = {r.id: (r.status, r.finished_at) for r in Q.mark_processed(tracker, outcomes).collect()}
    assert got == {1: ("success", T0), 2: ("pending", None), 3: ("pending", None)}
    failed = spark.createDataFrame([(5, "boom")], "document_id BIGINT, error STRING")
    r = Q.failure_rows(failed, "law", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")).first()
    assert r.error_log == "[2024-01-01 00:00:00] Error processing 5: boom"
    assert (r.status, r.retry_count, r.document_type) == ("failed", 1, "law")


def test_table_status(spark):
    got = {r.table_name: (r["count"], r.status) for r in Q.table_status({"a": spark.range(3), "b": spark.range(0)}).collect()}
    assert got == {"a": (3, "Có dữ liệu"), "b": (0, "Trống")}


def test_fetch_of_a_key_queued_twice(spark):
    """A record once, and every row of the key settled; a later capture is fetched once more for a new row."""
    page = '<div id="divThuocTinh"><table><tr><td><b>Số hiệu:</b></td><td>{}</td></tr></table></div>'
    rows = [(1, "a", "law", "success", T0, T0, 0, None), (2, "a", "law", "pending", T0, None, 1, None), (3, "b", "law", "pending", T0, None, 0, None), (4, "b", "law", "failed", T0, None, 2, "e"), (5, "c", "law", "success", T0, None, 0, None), (6, "c", "law", "failed", T0, None, 3, "e")]
    caps = [("a", 200, 0), ("a", 200, 5), ("b", 500, 1), ("b", 200, 2), ("c", 200, 3)]
    df = spark.createDataFrame([("law", k, page.format(f"{k}{m}"), T0 + timedelta(minutes=m), s) for k, s, m in caps], "doc_type STRING, doc_key STRING, html STRING, fetched_at TIMESTAMP_NTZ, http_status INT")
    state, seen = spark.createDataFrame(rows, TRACKER), []
    for _ in range(3):
        done = fetch(state, df, "law")
        seen += [r.document_number for r in done.records.collect()]
        state = spark.createDataFrame(done.tracker.collect(), TRACKER)
    assert seen == ["a5"]
    assert {(r.id, r.status, r.retry_count) for r in state.collect()} == {
        (1, "success", 0), (2, "success", 0), (3, "failed", 3), (4, "failed", 3), (5, "success", 0), (6, "failed", 3),
    }


def test_count_of_an_append_comes_from_the_write(spark, tmp_path):
    path = str(tmp_path / "queue")
    tracker = spark.createDataFrame([("1", "law")], "document_id STRING, document_type STRING")
    found = spark.createDataFrame([(str(i % 5), "law") for i in range(20)], "document_id STRING, document_type STRING")
    rows = D.enqueue_rows(found, tracker)
    assert D.append_counted(rows, path) == 4 == spark.read.parquet(path).count()
    assert D.append_counted(rows.limit(0), path) == 0
