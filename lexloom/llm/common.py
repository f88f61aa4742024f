"""Shared parts of the operators: held-out split, bounded samples, written intermediates."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexloom.session import materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["held_out", "labelled_sample", "materialize", "numbered", "share_below", "slices"]

FOLDS = 5
_UNIT = 1_000_000


def held_out(doc_id: str = "doc_id") -> Column:
    """True for the fifth of the rows labels are never learned from; NULL ids are not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % FOLDS == 0, F.lit(False))


def share_below(df: DataFrame, key: str, rows: int) -> DataFrame:
    """Repeatable sample of about ``rows`` rows (all, if fewer), chosen by a hash of ``key``."""
    total = df.count()
    if total <= rows:
        return df
    return df.where(F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(_UNIT)) < int(_UNIT * rows / total))


def labelled_sample(documents: DataFrame, labels: DataFrame, label: str, rows: int) -> DataFrame:
    """(text, label) of at most about ``rows`` labelled ids that are not held out, one row an id.

    The label side is narrow and bounded by ``rows``, so it is what gets broadcast. Several labels of
    one id count once, as their largest; NULL labels and ids are left out. Of several rows of one id
    the one whose text has the least hash is taken, in every task before the shuffle.
    """
    known = (
        labels.select("doc_id", F.col(label).cast("int").alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & ~held_out())
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
    )
    known = F.broadcast(share_below(known, "doc_id", rows))
    found = documents.select("doc_id", "text").join(known, "doc_id")
    return found.groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"), F.first("label").alias("label")).select("text", "label")


def numbered(rows: DataFrame, group: str, *order: str) -> DataFrame:
    """Rows with their place ``at`` in their group, from 0, and the group's number of rows ``total``.

    Rows are dealt by range of group and ``order`` (which should tell rows apart), written in order, and counted
    per partition; sums of the counts before give every partition its offset. So a group of any size is spread.
    """
    ranged = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    table = materialize(ranged.withColumn("place", F.monotonically_increasing_id()), "ranged")
    table = table.withColumn("part", F.shiftright("place", 33))
    parts = table.groupBy(group, "part").agg(F.min("place").alias("first"), F.count("*").alias("n"))  # one row per partition and group
    whole = Window.partitionBy(group)
    earlier = F.sum("n").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = parts.select(group, "part", "first", F.coalesce(earlier, F.lit(0)).alias("before"), F.sum("n").over(whole).alias("total"))
    at = F.col("before") + F.col("place") - F.col("first")
    return table.join(offsets, [group, "part"]).select(*rows.columns, at.alias("at"), "total")


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each holds about ``most`` bytes of ``column``, one row at least."""
    for batch in batches:
        sizes = [0 if v is None else v for v in pc.binary_length(batch.column(column)).to_pylist()]
        start, held = 0, 0
        for i, size in enumerate(sizes):
            if held and held + size > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if start < len(sizes):
            yield batch.slice(start)
