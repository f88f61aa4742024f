"""Stored layouts: same rows as a scan, and how little is read."""

import pytest
from pyspark.sql import functions as F

from lexloom.session import scratch_path
from lexloom.sources import layouts as L


def scans(df):
    """Rows and files of each scan after the query ran."""
    df.collect()
    out, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
            continue
        if name.endswith("QueryStage"):
            todo.append(node.plan())
            continue
        if name.startswith("Scan parquet"):
            out.append(tuple(node.metrics().get(m).get().value() for m in ("numOutputRows", "numFiles")))
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return out


@pytest.fixture(scope="module")
def numbers(spark):
    return spark.range(5000).select((F.col("id") * 7919 % 5003).alias("id"), F.concat(F.lit("n"), F.col("id") % 1250).alias("document_number"), F.lit("x" * 50).alias("text"))


def test_pages_at_any_depth(spark, numbers):
    root = scratch_path(spark, "positions")
    L.write_positions(numbers, root, ["id"], parts=8)
    want = [r.id for r in numbers.orderBy("id").collect()]
    for skip in (0, 1, 99, 2500, 4950, 4999, 5000, 10**9):
        assert [r.id for r in L.page_at(spark, root, skip).collect()] == want[skip : skip + 100], skip
    assert [r.id for r in L.page_at(spark, root, 0, 6000).collect()] == want
    deep = L.page_at(spark, root, 2500)
    plan = deep._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(nth" in plan and "PartitionFilters: [isnotnull(part" in plan
    assert all(rows <= 1300 and files == 1 for rows, files in scans(deep))


def test_pages_of_an_empty_table(spark, numbers):
    root = scratch_path(spark, "positions")
    L.write_positions(numbers.limit(0).union(numbers.filter("id = 3")), root, ["id"])
    assert [r.id for r in L.page_at(spark, root, 0).collect()] == [3]


def test_headings(spark):
    rows = [(d, s, [f"Chương {d % 3}", f"Mục {s % 2}", f"Mục {s % 2}"] if s else []) for d in range(60) for s in range(5)]
    articles = spark.createDataFrame(rows, "document_id INT, seq INT, h ARRAY<STRING>").select("document_id", "seq", F.struct(F.col("h").alias("hierarchy")).alias("structural_metadata"))
    root = scratch_path(spark, "headings")
    L.write_headings(articles, root, ["document_id", "seq"], folders=8)
    for wanted in (["Chương 1"], ["Chương 1", "Mục 0"], ["Mục 0", "Mục 0"], ["Mục 0", "Mục 1"], ["none"]):
        got = L.under_headings(spark, root, wanted, folders=8)
        assert sorted(map(tuple, got.collect())) == sorted((d, s) for d, s, h in rows if set(wanted) <= set(h)), wanted
    one = L.under_headings(spark, root, ["Chương 1"], folders=8)
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "(folder#" in plan.split("PartitionFilters")[1] and "EqualTo(label,Chương 1)" in plan
    every = sum(1 for f in spark.read.parquet(root).inputFiles())
    assert [files for _, files in scans(one)] < [every]


def test_numbers_skip_row_groups(spark, numbers):
    path = scratch_path(spark, "numbers")
    L.write_numbers(numbers, path, parts=4)
    stored = spark.read.parquet(path)
    assert stored.count() == 5000
    assert {r.document_number for r in stored.filter("document_number = 'n77'").collect()} == {"n77"}
    present, absent = stored.filter("document_number = 'n77'"), stored.filter("document_number = 'n77x'")
    assert len(present.collect()) == 4 and absent.collect() == []
    assert sum(rows for rows, _ in scans(present)) < 2500
    assert sum(rows for rows, _ in scans(absent)) == 0
