"""Key-list lookup and its report.

List and documents are reduced to counts per number before they meet wherever
only counts are asked for, so a number repeated in the list or shared by very many
documents never multiplies rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexloom.functions.text import UNKNOWN, document_key, object_id, percent
from lexloom.operators.corpus import HEAVY
from lexloom.session import materialize


def found_documents(key_list: DataFrame, docs: DataFrame) -> DataFrame:
    """List entries with their documents; list repetitions repeat results. Carries ``pos``."""
    return docs.join(key_list.select("pos", "document_number"), "document_number")


def in_list_order(found: DataFrame) -> DataFrame:
    return found.orderBy("pos", "id")


def not_found(key_list: DataFrame, docs: DataFrame) -> DataFrame:
    """List entries without a document, repetitions kept."""
    found = documents_by_number(key_list, docs).select("document_number")
    return key_list.join(found, "document_number", "left_anti").select("pos", "document_number")


def list_counts(key_list: DataFrame) -> DataFrame:
    """Distinct numbers of the list with their repetitions and first position."""
    return key_list.groupBy("document_number").agg(
        F.count("*").alias("listed"), F.min("pos").alias("pos")
    )


def documents_by_number(key_list: DataFrame, docs: DataFrame) -> DataFrame:
    """Documents per found number, not multiplied by list repetitions."""
    listed = key_list.select("document_number").distinct()
    return (
        docs.join(listed, "document_number", "left_semi")
        .groupBy("document_number")
        .agg(F.count("*").alias("n_documents"))
    )


def numbers_with_duplicates(by_number: DataFrame) -> DataFrame:
    return by_number.filter("n_documents > 1")


def top_duplicates(key_list: DataFrame, docs: DataFrame, top: int = 5) -> DataFrame:
    """Most duplicated listed numbers; ties in list order."""
    return (
        numbers_with_duplicates(documents_by_number(key_list, docs))
        .join(list_counts(key_list), "document_number")
        .orderBy(F.desc("n_documents"), "pos")
        .limit(top)
        .select("document_number", "n_documents", "pos")
    )


def _weighted(key_list: DataFrame, docs: DataFrame, group: Column, name: str) -> DataFrame:
    """Found documents per group, each counted as often as its number is listed."""
    return (
        docs.select("document_number", group.alias(name))
        .join(list_counts(key_list), "document_number")
        .groupBy(name)
        .agg(F.sum("listed").alias("n_documents"))
    )


def by_type(key_list: DataFrame, docs: DataFrame) -> DataFrame:
    return _weighted(key_list, docs, F.col("document_type"), "document_type")


def by_authority(key_list: DataFrame, docs: DataFrame) -> DataFrame:
    return _weighted(key_list, docs, F.col("issuing_authority"), "issuing_authority")


def issue_year(date: Column) -> Column:
    return F.coalesce(F.date_format(date, "yyyy"), F.lit(UNKNOWN))


def by_year(key_list: DataFrame, docs: DataFrame) -> DataFrame:
    return _weighted(key_list, docs, issue_year(F.col("issue_date")), "year")


def summaries(key_list: DataFrame, docs: DataFrame) -> DataFrame:
    """The three summaries in one pass: (dimension, value, n_documents)."""
    weighted = (
        docs.select(
            "document_number",
            "document_type",
            "issuing_authority",
            issue_year(F.col("issue_date")).alias("year"),
        )
        .join(list_counts(key_list), "document_number")
        .groupBy("document_type", "issuing_authority", "year")
        .agg(F.sum("listed").alias("_w"))
    )
    sets = [[F.col("document_type")], [F.col("issuing_authority")], [F.col("year")]]
    grouped = weighted.groupingSets(
        sets, F.col("document_type"), F.col("issuing_authority"), F.col("year")
    ).agg(F.sum("_w").alias("n_documents"), F.grouping_id().alias("_set"))
    # Bits of grouping_id: 1 = aggregated away.
    return grouped.select(
        F.when(F.col("_set") == 3, "document_type")
        .when(F.col("_set") == 5, "issuing_authority")
        .otherwise("year")
        .alias("dimension"),
        F.when(F.col("_set") == 3, F.col("document_type"))
        .when(F.col("_set") == 5, F.col("issuing_authority"))
        .otherwise(F.col("year"))
        .alias("value"),
        "n_documents",
    )


def coverage(key_list: DataFrame, docs: DataFrame) -> DataFrame:
    """One row of totals; percentages are NULL for an empty list."""
    matched = list_counts(key_list).join(
        documents_by_number(key_list, docs), "document_number", "left"
    )
    hit = F.col("n_documents").isNotNull()
    totals = matched.agg(
        F.coalesce(F.sum("listed"), F.lit(0)).alias("total_searched"),
        F.coalesce(F.sum(F.when(hit, F.col("listed") * F.col("n_documents"))), F.lit(0)).alias("total_found"),
        F.count_if(hit).alias("found_numbers"),
        F.coalesce(F.sum(F.when(~hit, F.col("listed"))), F.lit(0)).alias("not_found_count"),
    )
    return totals.withColumns(
        {
            "found_percent": percent(F.col("found_numbers"), F.col("total_searched")),
            "not_found_percent": percent(F.col("not_found_count"), F.col("total_searched")),
        }
    )


def lookup_ids(found: DataFrame) -> DataFrame:
    """Export rows ``{_id: {$oid}, document_id}`` with ids that do not change between runs."""
    key = document_key(F.col("document_number"), F.col("id"))
    oid = object_id(F.concat_ws("#", key, F.col("pos").cast("string")))
    return found.select(F.struct(oid.alias("$oid")).alias("_id"), key.alias("document_id"))


def listed_documents(key_list: DataFrame, docs: DataFrame) -> DataFrame:
    """Documents with a listed number, each once, with the times it is ``listed``, written: whatever is asked
    about a list reads these rows instead of the corpus.

    Rows are dealt by id, so that a number of very many documents lies in many files.
    """
    found = docs.join(list_counts(key_list).select("document_number", "listed"), "document_number")
    return materialize(found.repartition("id"), "listed")


def repeated_as_listed(listed: DataFrame) -> DataFrame:
    """Rows of ``listed_documents`` as often as the list names them: those of ``found_documents`` without ``pos``,
    from the row itself, equal ones one after the other."""
    return listed.withColumn("_nth", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("listed")))).drop("_nth", "listed")


def report(key_list: DataFrame, docs: DataFrame) -> dict[str, DataFrame]:
    """Named parts of the summary report; the corpus is read once, without its texts."""
    docs = listed_documents(key_list, docs.drop(*HEAVY))
    by_number = documents_by_number(key_list, docs)
    return {
        "coverage": coverage(key_list, docs),
        "not_found": not_found(key_list, docs),
        "documents_by_number": by_number,
        "documents_with_duplicates": numbers_with_duplicates(by_number),
        "summary_by_document_type": by_type(key_list, docs),
        "summary_by_issuing_authority": by_authority(key_list, docs),
        "summary_by_year": by_year(key_list, docs),
        "top_duplicates": top_duplicates(key_list, docs),
    }
