"""CSV export and import."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexloom.functions.text import flexible_date
from lexloom.schemas import TABLES
from lexloom.session import materialize

_OPTIONS = {"header": True, "encoding": "UTF-8", "quote": '"', "escape": '"'}


def _escaped(c: Column) -> Column:
    """Line breaks as ``\\n`` and ``\\r``, so that a row is one line and files split at any line."""
    for plain, written in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r")):
        c = F.replace(c, F.lit(plain), F.lit(written))
    return c


def _unescaped(c: Column) -> Column:
    def breaks(part: Column) -> Column:
        return F.replace(F.replace(part, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r"))

    # Between doubled backslashes every single one begins a line break.
    joined = F.array_join(F.transform(F.split(c, r"\\\\"), breaks), "\\")
    return F.when(F.contains(c, F.lit("\\")), joined).otherwise(c)


def export_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Header plus all rows. Many files by default; one file is for small tables.

    Line breaks and backslashes in texts are written escaped.
    """
    nested = [f.name for f in df.schema if isinstance(f.dataType, (T.ArrayType, T.StructType))]
    flat = df.withColumns({c: F.to_json(c) for c in nested}) if nested else df
    flat = flat.withColumns({f.name: _escaped(F.col(f.name)) for f in flat.schema if isinstance(f.dataType, T.StringType)})
    if single_file:
        flat = flat.coalesce(1)
    # An empty text stays "" and a NULL stays blank, so both survive the round trip.
    flat.write.options(**_OPTIONS, nullValue="", emptyValue='""').csv(path)


def _typed(name: str, kind: T.DataType) -> Column:
    raw = F.col(name)
    if isinstance(kind, T.DateType):
        stamp = F.try_to_timestamp(raw).cast("date")
        return F.coalesce(flexible_date(raw), stamp)
    if isinstance(kind, (T.ArrayType, T.StructType)):
        return F.from_json(raw, kind)
    return F.expr(f"try_cast(`{name}` AS {kind.simpleString()})")


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(record, header): records of CSV files that may break lines inside quotes, read in splits of any size.

    A line break ends a record where the quotes before it are even in number. Every block of a file numbers
    its lines of odd quotes, sums of the blocks before it carry on the count, so a block knows whether it
    begins inside a cell. Only lines of records with breaks inside are grouped, record by record.

    Quotes must stand around cells, and doubled inside them; a file whose quotes do not close fails.
    """
    block = ["_file", "_start"]
    raw = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_line"),
        "value",
        (F.pmod(F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit(""))), F.lit(2)) == 1).alias("_odd"),
    )
    # One row per file block; lines of odd quotes stand in pairs, around each break inside a cell.
    blocks = raw.groupBy(*block).agg(F.min("_line").alias("_first"), F.count_if("_odd").alias("_n"))
    file = Window.partitionBy("_file")
    before = F.sum("_n").over(file.orderBy("_start").rowsBetween(Window.unboundedPreceding, -1))
    total = F.sum("_n").over(file)
    closed = F.when(total % 2 == 0, True).otherwise(F.raise_error(F.concat(F.lit("unclosed quotes in "), F.col("_file"))).cast("boolean"))
    offsets = blocks.select(*block, "_first", F.coalesce(before, F.lit(0)).alias("_before"), closed.alias("_closed")).filter("_closed")

    earlier = Window.partitionBy(*block).orderBy("_line").rowsBetween(Window.unboundedPreceding, -1)
    counted = raw.withColumn("_inside", F.coalesce(F.count_if("_odd").over(earlier), F.lit(0))).join(offsets, block)
    lines = counted.select(
        "_file", "_start", "_line", "value", "_odd",
        (F.col("_before") + F.col("_inside")).alias("_count"),
        ((F.col("_start") == 0) & (F.col("_line") == F.col("_first"))).alias("header"),
    )
    whole = (F.col("_count") % 2 == 0) & ~F.col("_odd")
    single = lines.filter(whole).select(F.col("value").alias("record"), "header")
    parts = F.sort_array(F.collect_list(F.struct("_start", "_line", "value")))
    broken = lines.filter(~whole).groupBy("_file", F.expr("_count div 2")).agg(F.array_join(F.transform(parts, lambda x: x["value"]), "\n").alias("record"), F.bool_or("header").alias("header"))
    records = single.union(broken.select("record", "header"))
    return records.withColumn("record", F.regexp_replace("record", r"\r$", "")).filter("record != ''")


def _foreign(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Raw cells of files written elsewhere; a header with other columns fails."""
    schema = ", ".join(f"`{c}` STRING" for c in columns)
    cells = F.from_csv("record", F.lit(schema), {**{k: str(v) for k, v in _OPTIONS.items() if k != "header"}, "nullValue": "\u0000", "multiLine": "true"})
    parsed = csv_records(spark, path).withColumn("cells", cells)
    # The reader's rule: names are compared without case.
    named = F.concat_ws(",", *(F.lower(F.col("cells")[c]) for c in columns)) == ",".join(columns).lower()
    wrong = F.raise_error(F.concat(F.lit("unexpected CSV header: "), F.col("record"))).cast("string")
    kind = F.when(~F.col("header"), "row").when(F.coalesce(named, F.lit(False)), "header").otherwise(wrong)
    # The row number keeps later filters, which a header would not pass, from going before the check.
    judged = parsed.select("cells", kind.alias("_kind"), F.monotonically_increasing_id().alias("_n"))
    return judged.filter((F.col("_kind") == "row") & (F.col("_n") >= 0)).select("cells.*")


def _checked(spark: SparkSession, path: str, table: str, columns: list[str], foreign: bool) -> DataFrame:
    """Every row as raw cells, typed cells and the names of the columns that do not fit."""
    schema = spark.createDataFrame([], TABLES[table]).schema
    kinds = {f.name: f.dataType for f in schema}
    if foreign:
        raw = _foreign(spark, path, columns)
    else:
        raw_schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
        # A blank cell is NULL, a quoted empty cell the empty text.
        raw = spark.read.options(**_OPTIONS, nullValue="\u0000", enforceSchema=False).schema(raw_schema).csv(path)
        raw = raw.withColumns({c: _unescaped(F.col(c)) for c in columns})
    known = [c for c in columns if c in kinds]
    typed = raw.select(*[F.col(c).alias(f"_raw_{c}") for c in known], *[_typed(c, kinds[c]).alias(c) for c in known])
    bad = F.array_compact(
        F.array(
            *[
                F.when(
                    (F.coalesce(F.col(f"_raw_{c}"), F.lit("")) != "") & F.col(c).isNull(), F.lit(c)
                )
                for c in known
            ]
        )
    )
    return typed.withColumn("bad_columns", bad)


def _parted(checked: DataFrame, table: str, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    schema = checked.sparkSession.createDataFrame([], TABLES[table]).schema
    known = [c for c in columns if c in schema.names]
    good = checked.filter(F.size("bad_columns") == 0).select(
        *[
            F.col(f.name) if f.name in known else F.lit(None).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )
    quarantined = checked.filter(F.size("bad_columns") > 0).select(
        *[F.col(f"_raw_{c}").alias(c) for c in known], "bad_columns"
    )
    return good, quarantined


def read_csv_table(
    spark: SparkSession, path: str, table: str, columns: list[str], foreign: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Typed rows and quarantined rows of a CSV with the given header.

    Only declared DATE columns are parsed as dates. A row is quarantined when a
    non-empty cell does not fit its column; missing nullable columns become NULL.
    Texts are taken as they are, line breaks inside quotes included. ``foreign=False``
    is for files that ``export_csv`` wrote, whose texts are unescaped. Both kinds are
    read in splits of any size.
    """
    return _parted(_checked(spark, path, table, columns, foreign), table, columns)


def import_csv(
    spark: SparkSession, path: str, table: str, columns: list[str], target: str,
    strict: bool = False, quarantine: str | None = None, foreign: bool = True,
) -> None:
    """Load a CSV into a Parquet table; ``strict`` writes nothing if any row is bad. Parses the files once."""
    checked = materialize(_checked(spark, path, table, columns, foreign), "import")
    good, bad = _parted(checked, table, columns)
    if strict and not bad.isEmpty():
        raise ValueError(f"{path}: rows do not fit table {table}; nothing was written")
    good.write.mode("append").parquet(target)
    if quarantine:
        bad.write.mode("append").json(quarantine)
