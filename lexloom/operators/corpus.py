"""Corpus queries: paging, point lookups, record views, validation, duplicates, relations."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexloom.functions.text import flexible_date

# Columns and required fields of a document record, and the messages below.
HEAVY = ("metadata_html", "content_html", "content_text")
REQUIRED = ("document_number", "document_type", "issuing_authority", "issue_date")


# --- listing and point lookups ----------------------------------------------------------------


def listing(docs: DataFrame, skip: int = 0, limit: int = 100, key: str = "id") -> DataFrame:
    """Page of rows in key order."""
    return docs.orderBy(key).offset(skip).limit(limit)


def listing_after(docs: DataFrame, last_key: int, limit: int = 100, key: str = "id") -> DataFrame:
    """Page after a key already seen: the filter reaches the scan, so depth costs nothing."""
    return docs.filter(F.col(key) > last_key).orderBy(key).limit(limit)


def first_by_number(
    docs: DataFrame, number: str, with_content: bool = False, key: str = "id"
) -> DataFrame:
    """First row with this number (optionally only rows that have content)."""
    found = docs.filter(F.col("document_number") == number)
    if with_content:
        found = found.filter(F.col("content_html").isNotNull())
    return found.orderBy(key).limit(1)


def random_rows(docs: DataFrame, n: int = 3, seed: int | None = None) -> DataFrame:
    """``n`` random rows: every task keeps its own ``n`` best before they are merged."""
    order = F.rand() if seed is None else F.rand(seed)
    return docs.orderBy(order).limit(n)


def random_samples(tables: dict[str, DataFrame], n: int = 3, seed: int | None = None) -> dict[str, DataFrame]:
    return {name: random_rows(df, n, seed) for name, df in tables.items()}


def samples_report(tables: dict[str, DataFrame], n: int = 3, seed: int | None = None) -> DataFrame:
    """(table_name, sample): ``n`` random rows of each table as JSON, or its label when it is empty."""
    names = [(name, f"Bảng {name} trống") for name in tables]  # fixed value: the label
    parts = [
        random_rows(df, n, seed).select(F.lit(name).alias("table_name"), F.to_json(F.struct("*")).alias("sample"))
        for name, df in tables.items()
    ]
    found = functools.reduce(DataFrame.unionByName, parts)
    spark = found.sparkSession
    return spark.createDataFrame(names, "table_name STRING, label STRING").join(found, "table_name", "left").select(
        "table_name", F.coalesce("sample", "label").alias("sample")
    )


def sampled_relations(
    relations: DataFrame, judgments: DataFrame, documents: DataFrame, n: int = 3, seed: int | None = None
) -> DataFrame:
    """Random relations with their judgment and document, NULL where these do not exist."""
    return enriched_relations(random_rows(relations, n, seed), judgments, documents)


# --- record views -----------------------------------------------------------------------------


def iso(c: Column, kind: str) -> Column:
    layout = "yyyy-MM-dd" if kind == "date" else "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    return F.date_format(c, layout)


def _view(df: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    types = dict(df.dtypes)

    def shown(name: str) -> Column:
        if types[name] == "date" or types[name].startswith("timestamp"):
            return iso(F.col(name), types[name]).alias(name)
        return F.col(name)

    return df.select(*[shown(f) for f in fields])


def document_view(docs: DataFrame) -> DataFrame:
    return _view(
        docs,
        (
            "id", "document_number", "document_type", "issuing_authority", "issue_date", "status",
            "effective_date", "gazette_date", "gazette_number", "created_at",
        ),
    )


def judgment_view(judgments: DataFrame) -> DataFrame:
    fields = (
        "id", "case_name", "case_number", "issuing_authority", "trial_level", "field",
        "judgment_date", "keywords",
    )
    return _view(judgments, fields).withColumn(
        "keywords", F.coalesce("keywords", F.array().cast("array<string>"))
    )


def qa_view(qa: DataFrame) -> DataFrame:
    return _view(
        qa,
        (
            "id", "category", "author", "tags", "related_documents", "created_at", "updated_at",
            "question_html", "answer_html",
        ),
    )


def relation_view(relations: DataFrame) -> DataFrame:
    return relations.select("id", "judgment_id", "document_id", "relation_type")


def full_record(docs: DataFrame, include_content: bool = True) -> DataFrame:
    """All fields with ISO dates; the heavy text columns only when asked for."""
    light = (
        "id", "document_number", "document_type", "issuing_authority", "signer", "issue_date",
        "status", "effective_date", "gazette_date", "gazette_number", "created_at", "updated_at",
    )
    return _view(docs, light + (HEAVY if include_content else ()))


# --- validation -------------------------------------------------------------------------------


def first_fault(
    required: tuple[str, ...] = REQUIRED,
    number: str = "document_number",
    max_length: int = 255,
    date_ok: Column | None = None,
) -> Column:
    """Message of the first rule a row breaks, NULL when it is valid."""
    chain = F
    for name in required:
        text = F.col(name).cast("string")
        chain = chain.when(text.isNull() | (text == ""), F.lit(f"Missing required field: {name}"))
    written = F.col("issue_date").cast("string")
    # Dates and timestamps as they are, and text of an accepted layout or in ISO form with a time.
    timed = written.rlike(r"^\d{4}-\d{2}-\d{2}[T ]") & written.try_cast("timestamp").isNotNull()
    parseable = flexible_date(written).isNotNull() | timed if date_ok is None else date_ok
    return (
        chain.when(F.length(number) > max_length, F.lit("Document number exceeds maximum length"))
        .when(~parseable, F.lit("Invalid date format for issue_date"))
        .otherwise(F.lit(None))
    )


def validate(docs: DataFrame, fault: Column | None = None) -> DataFrame:
    return docs.withColumn("error", first_fault() if fault is None else fault)


def split_valid(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantined rows)."""
    return validated.filter("error IS NULL").drop("error"), validated.filter("error IS NOT NULL")


def fault_counts(validated: DataFrame) -> DataFrame:
    return validated.groupBy(F.coalesce("error", F.lit("valid")).alias("error")).agg(
        F.count("*").alias("n_rows")
    )


# --- duplicates -------------------------------------------------------------------------------


def duplicate_numbers(docs: DataFrame) -> DataFrame:
    """Numbers held by more than one row, most frequent first."""
    return (
        docs.groupBy("document_number")
        .agg(F.count("id").alias("count"))
        .filter("count > 1")
        .orderBy(F.desc("count"), "document_number")
    )


def duplicate_details(docs: DataFrame, top: int = 3) -> DataFrame:
    """Rows behind the ``top`` most frequent numbers (``top`` rows are broadcast)."""
    worst = duplicate_numbers(docs).limit(top)
    return docs.join(F.broadcast(worst), "document_number")


# --- relations --------------------------------------------------------------------------------


def enriched_relations(
    relations: DataFrame, judgments: DataFrame, documents: DataFrame
) -> DataFrame:
    """Relations with their judgment's case number and document's number; missing sides NULL."""
    return relations.join(
        judgments.select(F.col("id").alias("judgment_id"), "case_number"), "judgment_id", "left"
    ).join(documents.select(F.col("id").alias("document_id"), "document_number"), "document_id", "left")


def linked(relations: DataFrame, judgments: DataFrame, documents: DataFrame) -> DataFrame:
    """Judgment-document pairs that exist on both sides, one row per relation."""
    return relations.join(
        judgments.select(F.col("id").alias("judgment_id"), "case_number"), "judgment_id"
    ).join(documents.select(F.col("id").alias("document_id"), "document_number"), "document_id")


def with_children(
    parents: DataFrame, children: DataFrame, parent_key: str, child_key: str, name: str
) -> DataFrame:
    """Every parent with the number of its children (0 when it has none).

    Children are counted before the join, so a parent with very many stays one row.
    """
    counts = children.groupBy(F.col(child_key).alias(parent_key)).agg(F.count("*").alias(name))
    return parents.join(counts, parent_key, "left").withColumn(name, F.coalesce(name, F.lit(0)))


def child_rows(
    parents: DataFrame, children: DataFrame, parent_key: str, child_key: str
) -> DataFrame:
    """Parents with their child rows, childless parents kept."""
    return parents.join(children, parents[parent_key] == children[child_key], "left")
