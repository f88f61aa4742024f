"""Stored layouts from which a lookup reads little of a large table.

* ``write_positions`` / ``page_at``: rows in range partitions with their row number, and the totals before each
  partition, so that a page at any depth reads the one or two partitions it lies in.
* ``write_headings`` / ``under_headings``: an inverted index from heading label to articles, in folders by a hash
  of the label, sorted by it. A label held by every document is spread over many files of its folder.
* ``write_numbers``: rows sorted by document number with a bloom filter per row group, so that a lookup of one
  number skips the row groups it cannot be in.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# --- pages by position ------------------------------------------------------------------------


def write_positions(docs: DataFrame, root: str, order: list[str], parts: int | None = None) -> None:
    """Store rows in the order of ``order`` (NULL first), which should name every row apart.

    Partitions follow the session's shuffle settings, or there are ``parts`` of them.
    """
    ranged = docs.repartitionByRange(*([parts] if parts else []), *order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id()  # partition and row number, taken after the sort
    numbered = ranged.withColumn("_place", place)
    rows = numbered.withColumns({"part": F.shiftright("_place", 33).cast("int"), "nth": F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))})
    rows.drop("_place").write.partitionBy("part").parquet(f"{root}/rows")
    stored = docs.sparkSession.read.parquet(f"{root}/rows")
    totals = stored.groupBy("part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    totals.withColumn("before", F.coalesce(before, F.lit(0))).coalesce(1).write.parquet(f"{root}/parts")  # one row per partition


def page_at(spark: SparkSession, root: str, skip: int, limit: int = 100) -> DataFrame:
    """Rows ``skip`` to ``skip + limit`` in the stored order."""
    parts = spark.read.parquet(f"{root}/parts").filter((F.col("before") < skip + limit) & (F.col("before") + F.col("n") > skip))
    stored = spark.read.parquet(f"{root}/rows")
    pieces = [stored.filter(F.lit(False))]
    for p in parts.collect():  # those the page lies in
        first = skip - p["before"]
        pieces.append(stored.filter((F.col("part") == p["part"]) & (F.col("nth") >= first) & (F.col("nth") < first + limit)))
    found = functools.reduce(DataFrame.union, pieces[1:] or pieces)
    return found.orderBy("part", "nth").limit(limit).drop("part", "nth")


# --- articles by heading ----------------------------------------------------------------------


def _folder(label: Column, folders: int) -> Column:
    return F.pmod(F.xxhash64(label), F.lit(folders)).cast("int")


def write_headings(articles: DataFrame, root: str, key: list[str], folders: int = 64) -> None:
    """Index (label, key) of the articles' hierarchies; a label repeated in one hierarchy counts once."""
    labels = articles.select(*key, F.explode(F.array_distinct("structural_metadata.hierarchy")).alias("label"))
    placed = labels.withColumn("folder", _folder(F.col("label"), folders))
    # By range of (folder, label, key): few files a folder, and a label of very many articles in several.
    dealt = placed.repartitionByRange("folder", "label", *key).sortWithinPartitions("folder", "label", *key)
    dealt.write.partitionBy("folder").parquet(root)


def under_headings(spark: SparkSession, root: str, wanted: list[str], folders: int = 64) -> DataFrame:
    """Keys of the articles whose hierarchy contains every one of the labels."""
    stored = spark.read.parquet(root)
    key = [c for c in stored.columns if c not in ("label", "folder")]
    lists = [stored.filter((F.col("folder") == _folder(F.lit(w), folders)) & (F.col("label") == w)).select(*key) for w in dict.fromkeys(wanted)]
    return functools.reduce(lambda a, b: a.join(b, key, "left_semi"), lists)


# --- rows by number ---------------------------------------------------------------------------


def write_numbers(docs: DataFrame, path: str, number: str = "document_number", row_group: int = 16 << 20, parts: int | None = None) -> None:
    """Rows sorted by number; equal numbers may lie in neighbouring files."""
    ranged = docs.repartitionByRange(*([parts] if parts else []), number, F.xxhash64(*docs.columns)).sortWithinPartitions(number)
    options = {f"parquet.bloom.filter.enabled#{number}": "true", "parquet.block.size": str(row_group)}
    ranged.write.options(**options).parquet(path)
