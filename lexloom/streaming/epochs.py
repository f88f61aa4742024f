"""Stores that streams write one folder an epoch: their buckets, their valid epochs, and their compaction.

``compact`` folds all epochs but the newest (which may be replayed) into one folder ``epoch=-(M + 1)``, M being
the greatest epoch in it. The folder is written beside the store and moved into place at once, and only then
do the folders it stands for go, so a failure in between loses nothing: readers take ``valid`` epochs only.
Run it between two runs of the stream, not during one.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def stored_buckets(spark: SparkSession, root: str, wanted: int | None = None) -> int:
    """Key buckets of a store: what its first stream chose, by default as many as the session has shuffle partitions."""
    try:
        return spark.read.schema("buckets INT").parquet(f"{root}/_buckets").first()[0]
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
    chosen = wanted or int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.createDataFrame([(chosen,)], "buckets INT").coalesce(1).write.parquet(f"{root}/_buckets")
    return chosen


def epochs(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the epoch folders, from one listing; negative ones are folded."""
    files, place = _file_system(spark, path)
    if not files.exists(place):
        return []
    names = (status.getPath().getName() for status in files.listStatus(place))
    return sorted(int(name.removeprefix("epoch=")) for name in names if name.startswith("epoch="))


def valid(numbers: list[int]) -> list[int]:
    """The last fold, and the epochs after those in it."""
    folded = min((n for n in numbers if n < 0), default=None)
    return numbers if folded is None else [folded, *(n for n in numbers if n > -folded - 1)]


def compact(spark: SparkSession, path: str, schema: str, combine: Callable[[DataFrame], DataFrame]) -> int:
    """Fold the closed epochs of ``path`` through ``combine`` (rows with ``epoch`` in, rows without out); the folders left."""
    numbers = epochs(spark, path)
    good = valid(numbers)
    closed = [n for n in good if n >= 0][:-1]
    files, place = _file_system(spark, path)
    if closed:
        rows = spark.read.schema(schema).option("basePath", path).parquet(*(f"{path}/epoch={n}" for n in good if n <= closed[-1]))
        folded = combine(rows)
        beside = f"{path}/_fold-{uuid.uuid4().hex}"
        writer = folded.hint("rebalance", "bucket").write
        writer.partitionBy("bucket").parquet(beside)
        target = -(closed[-1] + 1)
        if not files.rename(_file_system(spark, beside)[1], _file_system(spark, f"{path}/epoch={target}")[1]):
            raise OSError(f"{path}: fold {target} could not be moved into place")
        numbers = epochs(spark, path)
        good = valid(numbers)
    for n in set(numbers) - set(good):  # those that a fold stands for
        files.delete(_file_system(spark, f"{path}/epoch={n}")[1], True)
    return len(good)
