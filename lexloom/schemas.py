"""Table schemas as Spark DDL, and allowed values of the coded columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Column names and types of the corpus tables.
LEGAL_DOCUMENTS = """
    id BIGINT, document_number STRING NOT NULL, document_type STRING, issuing_authority STRING,
    signer STRING, issue_date DATE, effective_date STRING, gazette_date DATE, gazette_number STRING,
    status STRING, metadata_html STRING, content_html STRING, content_text STRING,
    created_at TIMESTAMP, updated_at TIMESTAMP"""
JUDGMENTS = """
    id BIGINT, case_name STRING, case_number STRING, issuing_authority STRING, trial_level STRING,
    field STRING, judgment_date DATE, keywords ARRAY<STRING>, metadata_html STRING,
    content_html STRING, content_text STRING,
    related_parties STRUCT<nguyen_don: ARRAY<STRING>, bi_don: ARRAY<STRING>, ben_lien_quan: ARRAY<STRING>>,
    created_at TIMESTAMP, updated_at TIMESTAMP"""
LEGAL_QA = """
    id BIGINT, question_html STRING, answer_html STRING, category STRING, author STRING,
    tags ARRAY<STRING>, related_documents ARRAY<BIGINT>, created_at TIMESTAMP, updated_at TIMESTAMP"""
RELATIONS = "id BIGINT, judgment_id BIGINT, document_id BIGINT, relation_type STRING"
CRAWL_TRACKER = """
    id BIGINT, document_id STRING NOT NULL, document_type STRING NOT NULL, status STRING,
    created_at TIMESTAMP_NTZ, last_attempt TIMESTAMP_NTZ, retry_count INT, error_log STRING"""
PROCESS_TRACKER = """
    id BIGINT, document_id BIGINT NOT NULL, document_type STRING NOT NULL, status STRING,
    created_at TIMESTAMP_NTZ, started_at TIMESTAMP_NTZ, finished_at TIMESTAMP_NTZ, retry_count INT,
    error_log STRING, crawl_tracker_id BIGINT"""
PROCESSED_ARTICLES = """
    article_id STRING, document_id BIGINT NOT NULL, number STRING, heading STRING, content STRING,
    clean_content STRING,
    structural_metadata STRUCT<hierarchy: ARRAY<STRING>, prefix: STRING, article_number: STRING>,
    process_tracker_id BIGINT, processed_at TIMESTAMP_NTZ"""
CAPTURED_PAGES = """
    doc_type STRING, doc_key STRING, url STRING, html STRING, fetched_at TIMESTAMP_NTZ,
    http_status INT"""
ATTEMPTS = """
    attempt_id BIGINT, document_id STRING, document_type STRING, attempted_at TIMESTAMP_NTZ,
    ok BOOLEAN, error STRING"""

TABLES = {
    "legal_documents": LEGAL_DOCUMENTS,
    "judgments": JUDGMENTS,
    "legal_qa": LEGAL_QA,
    "judgment_document_relations": RELATIONS,
    "crawl_tracker": CRAWL_TRACKER,
    "process_tracker": PROCESS_TRACKER,
    "processed_articles": PROCESSED_ARTICLES,
    "captured_pages": CAPTURED_PAGES,
    "attempts": ATTEMPTS,
}

# Allowed codes per table and column.
ALLOWED = {
    ("crawl_tracker", "document_type"): ("law", "judgment"),
    ("crawl_tracker", "status"): ("pending", "success", "failed"),
    ("process_tracker", "document_type"): ("law", "judgment", "qa"),
    ("process_tracker", "status"): ("pending", "processing", "success", "failed"),
}


def allowed(table: str, column: str) -> Column:
    """True when the coded column holds an allowed value (or NULL)."""
    return F.col(column).isNull() | F.col(column).isin(*ALLOWED[(table, column)])
