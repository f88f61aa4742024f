"""Merges into stored tables against a plain dictionary."""

import os
import random
import re

import pytest

from lexloom.session import scratch_path
from lexloom.sources import keyed_tables as K

SCHEMA = "number STRING, part INT, seen INT, text STRING"


def local(path):
    return re.sub("^file:/*", "/", path)


def test_rounds_against_a_dictionary(spark):
    draw, root, want = random.Random(4), scratch_path(spark, "merged"), {}
    for n in range(4):
        rows = [(f"n{draw.randrange(30)}", draw.randrange(2), draw.randrange(50), f"t{n}-{i}") for i in range(25)]
        rows = list({(r[0], r[1], r[2]): r for r in rows if (r[0], r[1], r[2]) not in {(*k, v[2]) for k, v in want.items()}}.values())  # no ties
        for r in rows:
            want[r[:2]] = max(want.get(r[:2], r), r, key=lambda x: x[2])
        K.merge(spark.createDataFrame(rows, SCHEMA), root, ["number", "part"], ["seen"], buckets=8)
        assert sorted(map(tuple, K.current(spark, root).collect())) == sorted(want.values())


def test_only_touched_buckets_are_read_and_written(spark):
    root = scratch_path(spark, "merged")
    K.merge(spark.createDataFrame([(f"n{i}", 0, 1, "old") for i in range(200)], SCHEMA), root, ["number"], ["seen"], buckets=16)
    new = spark.createDataFrame([("n7", 0, 2, "new")], SCHEMA)
    numbers = K.touched(new, ["number"], 16)
    part = K.stored_part(spark, root, numbers)
    files = {re.search(r"v=(\d+)/bucket=(\d+)", f)[0] for f in part.inputFiles()}
    assert len(numbers) == 1 and part.count() < 40
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in plan.replace("isnotnull(bucket", "bucket").replace("[(bucket", "[bucket") and files
    assert K.merge(new, root, ["number"], ["seen"], buckets=16) == 1
    assert os.listdir(local(f"{root}/rows/v=1")).count(f"bucket={numbers[0]}") == 1
    assert sum(d.startswith("bucket=") for d in os.listdir(local(f"{root}/rows/v=1"))) == 1
    assert K.current(spark, root).filter("text = 'new'").count() == 1 and K.current(spark, root).count() == 200


def test_failed_merge_leaves_the_table(spark):
    root = scratch_path(spark, "merged")
    K.merge(spark.createDataFrame([("a", 0, 1, "x")], SCHEMA), root, ["number"], ["seen"])
    before = K.current(spark, root).collect()
    with pytest.raises(Exception):
        K.merge(spark.createDataFrame([("a", 0, 2)], "number STRING, part INT, seen INT"), root, ["number"], ["seen"])
    spark.createDataFrame([("b", 0, 9, "lost")], SCHEMA).selectExpr("*").write.parquet(f"{root}/rows/v=1/bucket=3")  # written, never committed
    assert K.current(spark, root).collect() == before
    assert K.merge(spark.createDataFrame([("a", 0, 2, "y")], SCHEMA), root, ["number"], ["seen"]) == 1
    assert [tuple(r) for r in K.current(spark, root).collect()] == [("a", 0, 2, "y")]
    with pytest.raises(ValueError):
        K.merge(spark.createDataFrame([("a", 0, 2, "y")], SCHEMA), root, ["number"], ["seen"], buckets=3)


def test_missing_keys_ties_and_nothing(spark):
    root = scratch_path(spark, "merged")
    rows = [(None, 0, 1, "x"), (None, 0, 1, "x"), ("t", 0, 1, "p"), ("t", 0, 1, "q"), ("u", 0, None, "r"), ("u", 0, 0, "s")]
    df = spark.createDataFrame(rows, SCHEMA)
    K.merge(df, root, ["number"], ["seen"])
    first = sorted(map(str, K.current(spark, root).collect()))
    assert len(first) == 4 and any("'s'" in r for r in first)
    assert K.merge(df.limit(0), root, ["number"], ["seen"]) is None
    K.merge(df.filter("number IS NOT NULL"), root, ["number"], ["seen"])
    assert sorted(map(str, K.current(spark, root).collect())) == first
