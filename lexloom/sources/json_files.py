"""JSON results of a lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexloom.operators.corpus import HEAVY, full_record
from lexloom.operators.lookup import coverage, found_documents, listed_documents, lookup_ids, not_found, repeated_as_listed, report


def write_lookup(key_list: DataFrame, docs: DataFrame, path: str, include_content: bool = True) -> None:
    """Result of a lookup as JSON folders: ``summary``, ``not_found`` and ``documents``.

    The list meets the corpus once; all three read the documents found, without their texts if these are not
    written. ``documents`` holds a record for every entry and document, equal ones in a row: compressed, a
    text that is listed very often takes little more room than once.
    """
    docs = listed_documents(key_list, docs if include_content else docs.drop(*HEAVY))
    summary = coverage(key_list, docs).select(
        "total_found",
        "total_searched",
        "not_found_count",
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        F.lit(include_content).alias("include_content"),
    )
    summary.write.json(f"{path}/summary", ignoreNullFields=False)
    not_found(key_list, docs).write.json(f"{path}/not_found")
    records = full_record(repeated_as_listed(docs), include_content).write.option("zlib.compress.level", "BEST_SPEED")
    records.json(f"{path}/documents", ignoreNullFields=False, compression="gzip")


def write_lookup_ids(key_list: DataFrame, docs: DataFrame, path: str) -> None:
    lookup_ids(found_documents(key_list, docs)).write.json(path)


def write_report(key_list: DataFrame, docs: DataFrame, path: str) -> None:
    """One JSON folder per part of the summary report."""
    for name, part in report(key_list, docs).items():
        part.write.json(f"{path}/{name}", ignoreNullFields=False)
