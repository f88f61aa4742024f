import random
from datetime import datetime, timedelta
from pathlib import Path

import __spark_entry__  # noqa: F401 - registers the queries
from lexloom.operators.queue import fold_attempts
from lexloom.plans.registry import QUERIES
from lexloom.streaming.attempts import attempt_state, attempt_state_stream, compact_attempts
from lexloom.streaming.enqueue import compact_queue, enqueue_stream, first_seen
from lexloom.streaming.epochs import compact, epochs, stored_buckets, valid
from lexloom.streaming.pages import append_to, article_stream, judgment_stream, law_stream, page_stream

LOG = (
    "attempt_id BIGINT, document_id STRING, document_type STRING, attempted_at TIMESTAMP_NTZ, ok BOOLEAN, error STRING"
)
KEYS = "document_id STRING, document_type STRING"


def test_attempt_stream_equals_batch_fold_with_late_rows(spark, tmp_path):
    rng = random.Random(11)
    start = datetime(2024, 1, 1)
    rows = [
        (i, f"k{rng.randrange(30)}", "law", start + timedelta(minutes=rng.randrange(200)), ok, None if ok else f"e{i}")
        for i in range(400)
        for ok in [rng.random() < 0.15]
    ]
    rng.shuffle(rows)
    for part in range(4):  # arrival order is not time order
        spark.createDataFrame(rows[part * 100 : part * 100 + 100], LOG).coalesce(1).write.mode("append").parquet(str(tmp_path / "log"))
    log = spark.readStream.schema(LOG).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "log"))
    root = str(tmp_path / "attempts")
    attempt_state_stream(log, root, str(tmp_path / "ck")).awaitTermination()
    state = spark.read.parquet(f"{root}/state").orderBy("epoch").collect()
    assert {r.epoch for r in state} == {0, 1, 2, 3}
    seen = {r.document_id: tuple(r)[:6] for r in state}  # the last one written counts
    assert {r.document_id: tuple(r) for r in attempt_state(spark, root).collect()} == seen
    want = {r.document_id: tuple(r) for r in fold_attempts(spark.createDataFrame(rows, LOG)).collect()}
    assert seen == want


def test_enqueue_stream_adds_each_id_once(spark, tmp_path):
    source, root, ck = (str(tmp_path / p) for p in ("found", "queue", "ck"))
    for batch in (["a", "b", "a"], ["b", "c"]):
        spark.createDataFrame([(k, "law") for k in batch], KEYS).coalesce(1).write.mode("append").parquet(source)
        found = spark.readStream.schema(KEYS).parquet(source)
        enqueue_stream(found, root, ck).awaitTermination()
    assert sorted(r.document_id for r in spark.read.parquet(root).collect()) == ["a", "b", "c"]


def test_first_seen(spark, tmp_path):
    source = str(tmp_path / "found")
    spark.createDataFrame([("a", "law"), ("a", "law"), ("a", "judgment")], KEYS).write.parquet(source)
    found = first_seen(spark.readStream.schema(KEYS).parquet(source))
    append_to(found, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_page_and_article_streams(spark, tmp_path):
    now = datetime(2024, 1, 1)
    law = '<div id="divThuocTinh"><table><tr><td><b>Số hiệu:</b></td><td>N</td></tr></table></div>'
    pages = [("law", "1", "u", law, now, 200), ("judgment", "2", "u", "<p>", now, 200), ("law", "3", "u", "", now, 404)]
    schema = "doc_type STRING, doc_key STRING, url STRING, html STRING, fetched_at TIMESTAMP_NTZ, http_status INT"
    spark.createDataFrame(pages, schema).write.parquet(str(tmp_path / "pages"))
    stream = page_stream(spark, str(tmp_path / "pages"))
    append_to(law_stream(stream), str(tmp_path / "law"), str(tmp_path / "ck1")).awaitTermination()
    got = {r.doc_key: (r.document_number, r.error) for r in spark.read.parquet(str(tmp_path / "law")).collect()}
    assert got == {"1": ("N", None), "3": ("", "HTTP status 404")}
    append_to(judgment_stream(stream), str(tmp_path / "j"), str(tmp_path / "ck2")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "j")).count() == 1

    docs = "id BIGINT, document_number STRING, content_html STRING"
    spark.createDataFrame([(1, "A", "<p>Điều 1</p><p>x</p>"), (2, "B", None)], docs).write.parquet(str(tmp_path / "docs"))
    arts = article_stream(page_stream(spark, str(tmp_path / "docs"), docs), "id", "document_number", "content_html")
    append_to(arts, str(tmp_path / "arts"), str(tmp_path / "ck3")).awaitTermination()
    assert [(r.article_id, r.content) for r in spark.read.parquet(str(tmp_path / "arts")).collect()] == [("A-ART-1", "x")]


def test_streams_of_a_table_of_one_file_or_many(spark, tmp_path):
    """The given tables are single files, or folders of files as Spark writes them."""
    docs = spark.createDataFrame([(1, "a\nb", "s"), (2, "c", "s")], "doc_id BIGINT, text STRING, source STRING")
    pages = spark.createDataFrame([(7, "u", "<article><p>x</p></article>"), (8, "u", "")], "page_id BIGINT, url STRING, html STRING")
    for layout in ("one", "many"):
        root = tmp_path / layout
        for name, rows in (("documents", docs), ("pages", pages)):
            rows.repartition(2).write.parquet(str(root / f"{name}.parquet"))
            if layout == "one":
                pandas = spark.read.parquet(str(root / f"{name}.parquet")).toPandas()
                (root / "single").mkdir(exist_ok=True)
                pandas.to_parquet(root / "single" / f"{name}.parquet")
        d = str(root / "single") if layout == "one" else str(root)
        assert sorted(map(tuple, QUERIES["r1_article_stream"](spark, d).collect())) == [(1, 2), (2, 1)]
        assert sorted(map(tuple, QUERIES["r1_page_stream"](spark, d).collect())) == [(7, "x"), (8, "")]


def _files(spark, name):
    return set(Path(spark.conf.get("spark.checkpoint.dir")).glob(f"{name}-*/part-*"))


def test_arrivals_are_written_by_many_tasks(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"t{i % 30}") for i in range(40)], "doc_id BIGINT, text STRING")
    docs.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    before = _files(spark, "arrivals")
    got = QUERIES["r2_first_seen_horizon"](spark, str(tmp_path)).collect()
    assert sorted(r.arrival for r in got) == [0] * 30 + [4] * 30
    assert len(_files(spark, "arrivals") - before) == 3 * 3 + 2


def test_statutes_arrive_in_few_batches_of_many_files(spark, tmp_path):
    docs = spark.createDataFrame([(i, "a\nb\nc", "s") for i in range(64)], "doc_id BIGINT, text STRING, source STRING")
    docs.repartition(16).write.parquet(str(tmp_path / "documents.parquet"))
    commits = lambda: set(Path(spark.conf.get("spark.checkpoint.dir")).glob("statute-stream-*-checkpoint/commits/[0-9]*"))
    before, limit = commits(), spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")  # a task and a file for each of the 16
    try:
        assert QUERIES["r1_statute_stream"](spark, str(tmp_path)).select("document_id").distinct().count() == 64
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", limit)
    assert 2 <= len(commits() - before) <= 5


def test_compaction_of_attempts_and_queue(spark, tmp_path):
    """After each run past epochs become one folder; states stay, a replayed newest epoch writes the same."""
    rng, start = random.Random(3), datetime(2024, 1, 1)
    rows = [(i, f"k{rng.randrange(12)}", "law", start + timedelta(minutes=rng.randrange(200)), rng.random() < 0.2, "e") for i in range(240)]
    root, source, queue = str(tmp_path / "attempts"), str(tmp_path / "log"), str(tmp_path / "queue")
    want = spark.createDataFrame(rows, LOG)
    for run in range(2):
        for part in range(3):
            at = (3 * run + part) * 40
            spark.createDataFrame(rows[at : at + 40], LOG).coalesce(1).write.mode("append").parquet(source)
        log = spark.readStream.schema(LOG).option("maxFilesPerTrigger", 1).parquet(source)
        attempt_state_stream(log, root, str(tmp_path / "ck"), buckets=4).awaitTermination()
        enqueue_stream(log.select("document_id", "document_type"), queue, str(tmp_path / "ckq"), buckets=4).awaitTermination()
        before = sorted(map(str, attempt_state(spark, root).collect()))
        assert compact_attempts(spark, root) == 4  # a fold and the newest epoch, of log and state
        assert compact_queue(spark, queue, str(tmp_path / "ckq")) == 2
        assert sorted(map(str, attempt_state(spark, root).collect())) == before
    assert sorted(map(str, attempt_state(spark, root).collect())) == sorted(map(str, fold_attempts(want).collect()))
    assert epochs(spark, f"{root}/log") == [-5, 5]
    queued = [r.document_id for r in spark.read.parquet(queue).collect()]
    assert sorted(queued) == sorted({r[1] for r in rows})
    assert compact_attempts(spark, root) == 4
    assert stored_buckets(spark, root, 99) == 4


def test_folders_a_fold_stands_for_are_not_read(spark, tmp_path):
    """As after a failure between moving a fold into place and removing what it holds."""
    path = str(tmp_path / "store")
    for n in (0, 1, 2, -2):
        spark.createDataFrame([(n, 0)], "v INT, bucket INT").write.partitionBy("bucket").parquet(f"{path}/epoch={n}")
    assert valid(epochs(spark, path)) == [-2, 2]
    assert compact(spark, path, "v INT, epoch BIGINT, bucket INT", lambda rows: rows.drop("epoch")) == 2
    assert epochs(spark, path) == [-2, 2]
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == [-2, 2]
