"""Contiguous shards of near equal bytes, cut from prefix sums over the whole corpus.

Rows are narrowed to id, size and hashes, counted where they repeat, dealt by range of the id and written.
Totals per partition (one row each) give every partition its offset; a running sum inside the partition
gives every row its global place in bytes and in rows. A row belongs to the shard in which its middle
byte falls, so a shard differs from the equal share by at most its largest row at either end.
DataFrame functions only; the texts are not shuffled.

* Order: doc_id (NULL first), then hashes of the text; repeated rows stand side by side.
* NULL and empty text: size 8. One huge text: its shard is as large as it, its neighbours may be empty.
* Fewer rows than shards: some shards stay empty. An empty table gives an empty result.
* Many rows of one id (or none): ranges are dealt by id and text hash together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexloom.llm.common import materialize

SHARDS = 24
#: Bytes counted for a row besides its text.
OVERHEAD = 8
#: Copies of one repeated row that a task lists, at most.
COPIES = 1 << 18
_KEYS = ("doc_id", "text_hash", "text_crc32", "size")


def balanced_shards(documents: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot (gapless from 0 in each shard)."""
    text = F.coalesce("text", F.lit("")).cast("binary")
    rows = documents.select("doc_id", (F.octet_length(text) + OVERHEAD).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.xxhash64(text).alias("text_hash"))
    counted = rows.groupBy(*_KEYS).agg(F.count("*").alias("n"))
    ranged = counted.repartitionByRange("doc_id", "text_hash").withColumn("part", F.spark_partition_id())
    table = materialize(ranged, "ranged")

    every = Window.orderBy("part")
    earlier = every.rowsBetween(Window.unboundedPreceding, -1)
    offsets = (  # one row per partition
        table.groupBy("part")
        .agg(F.sum(F.col("size") * F.col("n")).alias("b"), F.sum("n").alias("r"))
        .select(
            "part", F.coalesce(F.sum("b").over(earlier), F.lit(0)).alias("first_byte"), F.coalesce(F.sum("r").over(earlier), F.lit(0)).alias("first_row"),
            F.sum("b").over(every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("total"),
        )
    )
    inside = Window.partitionBy("part").orderBy(*_KEYS).rowsBetween(Window.unboundedPreceding, -1)
    before = table.select(
        "*", F.coalesce(F.sum(F.col("size") * F.col("n")).over(inside), F.lit(0)).alias("bytes_before"), F.coalesce(F.sum("n").over(inside), F.lit(0)).alias("rows_before")
    )
    begun = before.join(F.broadcast(offsets), "part")
    zero, many = F.lit(0).cast("long"), F.col("n") > COPIES
    runs = begun.where(many).withColumn("from", F.explode(F.sequence(zero, F.col("n") - 1, F.lit(COPIES).cast("long"))))
    runs = runs.repartition(*_KEYS, "from")  # the runs of a much repeated row go to many tasks; other rows stay where they are
    runs = begun.where(~many).withColumn("from", zero).unionByName(runs)
    each = runs.withColumn("copy", F.explode(F.sequence("from", F.least(F.col("from") + COPIES, F.col("n")) - 1)))
    begin = F.col("first_byte") + F.col("bytes_before") + F.col("copy") * F.col("size")
    middle = (2 * begin + F.col("size")).cast("decimal(38,0)")
    placed = each.select(
        "doc_id", "size", "text_crc32", F.expr(f"int({shards})").alias("shards"), middle.alias("middle"), "total",
        (F.col("first_row") + F.col("rows_before") + F.col("copy")).alias("row"),
    ).withColumn("shard", F.expr("cast(middle * shards div (2 * cast(total as decimal(38,0))) as int)"))
    firsts = placed.groupBy("shard").agg(F.min("row").alias("first"))  # one row per shard
    return placed.join(F.broadcast(firsts), "shard").select("doc_id", "size", "text_crc32", "shard", (F.col("row") - F.col("first")).alias("slot"))


def report(documents: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    return balanced_shards(documents).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
