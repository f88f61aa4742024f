import csv
import json
import os
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__  # noqa: F401 - registers the queries
from lexloom.operators import lookup as L
from lexloom.plans.registry import QUERIES
from lexloom.schemas import ALLOWED, TABLES, allowed
from lexloom.sources import csv_files, json_files, key_lists, tables

COLUMNS = ["id", "document_number", "document_type", "issue_date", "effective_date", "gazette_date", "content_html"]


def test_schemas_parse(spark):
    for name in TABLES:
        assert tables.empty_table(spark, name).count() == 0
    rows = spark.createDataFrame([("pending",), ("odd",), (None,)], "status STRING")
    assert [r[0] for r in rows.select(allowed("crawl_tracker", "status")).collect()] == [True, False, True]
    assert ("process_tracker", "document_type") in ALLOWED


def test_csv_round_trip(spark, tmp_path):
    rows = [
        (1, "1/QĐ", 'Quyết định, "số"', date(2025, 1, 21), "Đã biết", None, "<p>a\nb</p>"),
        (2, "2/QĐ", "", None, "", date(2025, 1, 2), None),
        (3, "3\\\\n", "a\\\nb\r\nc\\r", None, "\\", None, "\n"),
    ]
    df = spark.createDataFrame(
        rows, "id BIGINT, document_number STRING, document_type STRING, issue_date DATE, effective_date STRING, gazette_date DATE, content_html STRING"
    )
    path = str(tmp_path / "out")
    csv_files.export_csv(df, path, single_file=True)
    assert len([f for f in os.listdir(path) if f.endswith(".csv")]) == 1
    good, bad = csv_files.read_csv_table(spark, path, "legal_documents", COLUMNS, foreign=False)
    got = sorted(good.select(*COLUMNS).collect())
    assert bad.count() == 0
    assert [tuple(r) for r in got] == rows
    assert "content_text" in good.columns and good.first().content_text is None


def write(tmp_path, text):
    path = tmp_path / "in.csv"
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_csv_import_quarantine_and_strict(spark, tmp_path):
    path = write(
        tmp_path,
        "id,document_number,gazette_date,effective_date\n1,A,21/01/2025,Đã biết\n2,B,Đã biết,x\n3,C,,\n",
    )
    columns = ["id", "document_number", "gazette_date", "effective_date"]
    good, bad = csv_files.read_csv_table(spark, path, "legal_documents", columns)
    assert [(r.id, r.gazette_date, r.effective_date) for r in good.orderBy("id").collect()] == [
        (1, date(2025, 1, 21), "Đã biết"), (3, None, None),
    ]
    assert [(r.id, r.bad_columns) for r in bad.collect()] == [("2", ["gazette_date"])]
    target = str(tmp_path / "target")
    with pytest.raises(ValueError):
        csv_files.import_csv(spark, path, "legal_documents", columns, target, strict=True)
    assert not os.path.exists(target)
    csv_files.import_csv(spark, path, "legal_documents", columns, target, quarantine=str(tmp_path / "bad"))
    assert spark.read.parquet(target).count() == 2


def test_csv_files_split(spark, tmp_path):
    path = str(tmp_path / "big")
    df = spark.range(4000).select("id", F.concat(F.lit("line\n"), F.col("id")).alias("content_text"))
    csv_files.export_csv(df, path, single_file=True)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        good, _ = csv_files.read_csv_table(spark, path, "legal_documents", ["id", "content_text"], foreign=False)
        assert good.rdd.getNumPartitions() > 1
        assert sorted(r.content_text for r in good.collect()) == sorted(f"line\n{i}" for i in range(4000))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


TRICKY = ["a\nb \\n", 'say ""hi""\n', '""', "\n\n\n", "plain, with comma", "\r\nx\r\n", '""\n""\n""', "C:\\new", ""]


@pytest.mark.parametrize("ending", ("\n", "\r\n"))
def test_foreign_csv_in_blocks(spark, tmp_path, ending):
    """Files with breaks inside quotes, read in many blocks that begin anywhere, against a reader of whole files."""
    columns = ["id", "content_text", "signer"]
    for name, count in (("a", 700), ("b", 90), ("c", 0)):
        rows = [f'{i},"{TRICKY[i % len(TRICKY)]}",' + ('""' if i % 3 else "s") for i in range(count)]
        (tmp_path / f"{name}.csv").write_bytes(ending.join([",".join(columns), *rows, "", ""]).encode())
    want = []
    for name in "abc":
        with open(tmp_path / f"{name}.csv", encoding="utf-8", newline="") as file:
            want += [(int(i), text, signer) for i, text, signer in [r for r in csv.reader(file) if r][1:]]
    want.sort()
    if ending == "\n":  # the whole-file reader changes the breaks inside cells of other files
        whole = spark.read.schema("id STRING, content_text STRING, signer STRING").csv(str(tmp_path), header=True, quote='"', escape='"', multiLine=True, nullValue="\0")
        assert sorted((int(r.id), r.content_text, r.signer) for r in whole.collect()) == want
    for size in ("64", "997", "1m"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "16")
        try:
            good, bad = csv_files.read_csv_table(spark, str(tmp_path), "legal_documents", columns)
            assert sorted((r.id, r.content_text, r.signer) for r in good.collect()) == want and bad.count() == 0
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
    assert len(want) == 790


@pytest.mark.parametrize("text, error", (('id,signer\n1,"open\n', "unclosed quotes"), ("id,author\n1,x\n", "unexpected CSV header")))
def test_foreign_csv_that_is_none(spark, tmp_path, text, error):
    good, _ = csv_files.read_csv_table(spark, write(tmp_path, text), "legal_documents", ["id", "signer"])
    with pytest.raises(Exception, match=error):
        good.collect()


def test_key_list_keeps_order_and_repetitions(spark, tmp_path):
    (tmp_path / "a.txt").write_text("A\n\n  B \nA\n", encoding="utf-8")
    (tmp_path / "b.txt").write_text("C/1\n \nA", encoding="utf-8")
    got = key_lists.read_key_list(spark, str(tmp_path)).orderBy("pos").collect()
    assert [(r.pos, r.document_number) for r in got] == [(0, "A"), (2, "B"), (3, "A"), (4, "C/1"), (6, "A")]


def test_key_list_cut_into_blocks(spark, tmp_path):
    lines = [f"N{i % 700}" if i % 5 else "" for i in range(3000)]
    (tmp_path / "keys.txt").write_text("\n".join(lines), encoding="utf-8")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        df = key_lists.read_key_list(spark, str(tmp_path / "keys.txt"))
        got = [(r.pos, r.document_number) for r in df.orderBy("pos").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == [(i, k) for i, k in enumerate(lines) if k]


def test_json_columns(spark):
    rows = [('["a","b"]',), ('"one"',), (None,), ("{bad",)]
    got = [r[0] for r in spark.createDataFrame(rows, "c STRING").select(tables.text_list(F.col("c"))).collect()]
    assert got == [["a", "b"], ["one"], [], []]
    df = spark.createDataFrame([('{"nguyen_don": ["A"], "bi_don": "B"}',)], "c STRING")
    assert df.select(tables.parties_from_json(F.col("c")).alias("p")).first().p.asDict() == {
        "nguyen_don": ["A"], "bi_don": ["B"], "ben_lien_quan": [],
    }


def test_append_and_snapshot(spark, tmp_path):
    rows = spark.createDataFrame([("x",), ("y",)], "document_number STRING")
    path = str(tmp_path / "t")
    tables.append(rows, path, ["document_number"])
    tables.append(rows, path, ["document_number"])
    df = spark.read.parquet(path)
    assert df.count() == 4 and df.select("id").distinct().count() == 2
    assert df.filter("created_at IS NULL").count() == 0
    tables.write_snapshot(rows, str(tmp_path / "s"), 1)
    with pytest.raises(Exception):
        tables.write_snapshot(rows, str(tmp_path / "s"), 1)


def test_lookup_files(spark, tmp_path):
    docs = tables.empty_table(spark, "legal_documents").select(
        "id", "document_number", "document_type", "issuing_authority", "signer", "issue_date", "status",
        "effective_date", "gazette_date", "gazette_number", "created_at", "updated_at",
        "metadata_html", "content_html", "content_text",
    )
    row = spark.createDataFrame(
        [(1, "A", "QĐ", None, None, date(2020, 1, 2), None, None, None, None, None, None, None, "<p>", "t")], docs.schema
    )
    keys = spark.createDataFrame([(0, "A"), (1, "B")], "pos BIGINT, document_number STRING")
    json_files.write_lookup(keys, row, str(tmp_path / "full"))
    json_files.write_lookup(keys, row, str(tmp_path / "slim"), include_content=False)
    read = lambda p: [json.loads(s.value) for s in spark.read.text(str(tmp_path / p)).collect()]
    summary = read("full/summary")[0]
    assert (summary["total_found"], summary["total_searched"], summary["not_found_count"]) == (1, 2, 1)
    assert summary["include_content"] is True
    assert read("full/not_found") == [{"pos": 1, "document_number": "B"}]
    full, slim = read("full/documents")[0], read("slim/documents")[0]
    assert (full["issue_date"], full["content_text"], full["signer"]) == ("2020-01-02", "t", None)
    assert "content_html" not in slim
    json_files.write_lookup_ids(keys, row, str(tmp_path / "ids"))
    assert read("ids")[0]["document_id"] == "A#1" and len(read("ids")[0]["_id"]["$oid"]) == 24
    json_files.write_report(keys, row, str(tmp_path / "report"))
    assert read("report/coverage")[0]["found_percent"] == 50.0


def test_texts_listed_very_often_are_written_small(spark, tmp_path):
    """A record for every entry and document; their texts are shuffled and stored as often as there are documents."""
    schema = tables.empty_table(spark, "legal_documents").schema
    docs = spark.createDataFrame([], schema).unionByName(
        spark.createDataFrame([(i, "A") for i in range(20)] + [(20, "B"), (21, "C")], "id BIGINT, document_number STRING"), allowMissingColumns=True
    )
    text = "".join(chr(97 + i * i % 26) + str(i * 7919 % 1009) for i in range(1000))
    docs = docs.withColumns({"content_text": F.lit(text), "content_html": F.lit(f"<p>{text}</p>")})
    keys = spark.createDataFrame([(i, "A") for i in range(50)] + [(50, "B"), (51, "D"), (52, None)], "pos BIGINT, document_number STRING")
    for content in (True, False):
        path = str(tmp_path / str(content))
        json_files.write_lookup(keys, docs, path, include_content=content)
        got = spark.read.json(f"{path}/documents")
        counts = {(r.id, r.document_number): r["count"] for r in got.groupBy("id", "document_number").count().collect()}
        assert counts == {**{(i, "A"): 50 for i in range(20)}, (20, "B"): 1}
        assert ("content_text" in got.columns) == content
        if content:
            assert got.select("content_text", "content_html").distinct().collect() == [(text, f"<p>{text}</p>")]
            files = list((tmp_path / "True" / "documents").glob("part-*"))
            assert sum(f.stat().st_size for f in files) < 1001 * len(text) / 10
    listed = L.listed_documents(keys, docs)
    assert sorted(r.listed for r in listed.select("listed").collect()) == [1] + [50] * 20


def test_extracted_records_fit_their_tables(spark):
    from lexloom.operators import extraction as X

    pages = spark.createDataFrame([("1", "<p>x</p>", 200)], "doc_key STRING, html STRING, http_status INT")
    law = tables.conform(X.with_write_defaults(X.law_records(pages)), "legal_documents", ["doc_key"])
    judgment = tables.conform(X.judgment_records(pages), "judgments", ["doc_key"])
    assert law.columns == tables.empty_table(spark, "legal_documents").columns
    assert dict(law.dtypes)["effective_date"] == "string"
    assert law.first().id is not None and judgment.first().keywords == []


def test_foreign_files_are_written_by_many_tasks(spark, tmp_path):
    rows = [(i, f'a"{i}\r\nb', "es", "src") for i in range(40)]
    spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING, source STRING").repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    root = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(root.glob("foreign-csv-*/part-*"))
    got = QUERIES["s4_foreign_csv"](spark, str(tmp_path)).collect()
    assert sorted((r.id, r.content_text) for r in got) == [r[:2] for r in rows]
    assert len(set(root.glob("foreign-csv-*/part-*")) - before) == 3
