"""Corpus, lookup, relation and source queries on the given tables."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexloom.functions import text as T
from lexloom.operators import corpus as C
from lexloom.operators import lookup as L
from lexloom.plans.inputs import CORPUS_SQL, KEY_LIST_SQL, corpus, key_list
from lexloom.plans.registry import query, table
from lexloom.session import materialize, scratch_path
from lexloom.sources import csv_files, json_files, key_lists, layouts, tables

_BOTH = f"WITH {CORPUS_SQL}, {KEY_LIST_SQL}"


def _scratch(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, name)


# --- duplicates -------------------------------------------------------------------------------


@query("q9_duplicate_numbers", f"""WITH {CORPUS_SQL}
SELECT document_number, count(id) AS count FROM corpus GROUP BY document_number HAVING count(id) > 1""")
def q9(spark: SparkSession, d: str) -> DataFrame:
    return C.duplicate_numbers(corpus(spark, d))


@query("q10_duplicate_details", f"""WITH {CORPUS_SQL}, worst AS (
  SELECT document_number, count(id) AS count FROM corpus GROUP BY 1 HAVING count(id) > 1
  ORDER BY count DESC, document_number LIMIT 3)
SELECT document_number, id, document_type, issuing_authority, CAST(issue_date AS VARCHAR) AS issue_date, count
FROM corpus JOIN worst USING (document_number)""")
def q10(spark: SparkSession, d: str) -> DataFrame:
    return C.duplicate_details(corpus(spark, d)).select(
        "document_number", "id", "document_type", "issuing_authority",
        C.iso(F.col("issue_date"), "date").alias("issue_date"), "count",
    )


# --- listing, views, validation ---------------------------------------------------------------


@query("q1_listing", f"""WITH {CORPUS_SQL}
SELECT id, document_number, document_type, issuing_authority FROM corpus ORDER BY id LIMIT 100 OFFSET 200""")
def q1(spark: SparkSession, d: str) -> DataFrame:
    rows = corpus(spark, d).select("id", "document_number", "document_type", "issuing_authority")
    return C.listing(rows, skip=200, limit=100)


@query("q1_listing_after_key", f"""WITH {CORPUS_SQL}
SELECT id, document_number, document_type FROM corpus WHERE id > 150 ORDER BY id LIMIT 100""")
def q1_keyset(spark: SparkSession, d: str) -> DataFrame:
    return C.listing_after(corpus(spark, d).select("id", "document_number", "document_type"), 150)


@query("q1_listing_deep", f"""WITH {CORPUS_SQL},
n AS (SELECT *, row_number() OVER (ORDER BY id) - 1 AS pos, count(*) OVER () AS total FROM corpus)
SELECT id, document_number, document_type, CAST(pos AS BIGINT) AS pos FROM n
WHERE pos >= total * 9 // 10 AND pos < total * 9 // 10 + 100 OR pos >= total - 5""")
def q1_deep(spark: SparkSession, d: str) -> DataFrame:
    """A page at nine tenths of the table and the last five rows, read by position."""
    rows = corpus(spark, d).select("id", "document_number", "document_type")
    root = _scratch(spark, "positions")
    layouts.write_positions(rows, root, ["id"])
    total = spark.read.parquet(f"{root}/parts").agg(F.sum("n")).first()[0] or 0
    place = Window.orderBy("id")  # of one page

    def page(skip: int, limit: int) -> DataFrame:
        return layouts.page_at(spark, root, skip, limit).withColumn("pos", F.row_number().over(place) - 1 + F.lit(skip).cast("bigint"))

    return page(total * 9 // 10, 100).union(page(total - 5, 5)).distinct()


@query("q2_point_lookup", """
SELECT doc_id AS id, doc_id || '/QĐ' AS document_number, lang, md5(text) AS digest FROM documents WHERE doc_id IN (117, 42)""")
def q2_point(spark: SparkSession, d: str) -> DataFrame:
    """Two numbers there are and two there are not, each looked up in a table sorted by number with bloom filters."""
    docs = table(spark, d, "documents").select(
        F.col("doc_id").alias("id"), F.concat(F.col("doc_id"), F.lit("/QĐ")).alias("document_number"), "lang", F.md5("text").alias("digest")
    )
    path = _scratch(spark, "numbers")
    layouts.write_numbers(docs, path)
    stored = spark.read.parquet(path)
    found = [C.first_by_number(stored, number) for number in ("117/QĐ", "117/QD", "42/QĐ", "/QĐ")]
    return functools.reduce(DataFrame.union, found)


@query("q2_first_by_number", """
SELECT doc_id AS id, source AS document_number, lang FROM documents WHERE source = 'src7' ORDER BY doc_id LIMIT 1""")
def q2(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select(
        F.col("doc_id").alias("id"), F.col("source").alias("document_number"), "lang"
    )
    return C.first_by_number(docs, "src7")


@query("q3_first_with_content", """
SELECT doc_id AS id, lang FROM documents WHERE source = 'src5' AND lang <> 'en' ORDER BY doc_id LIMIT 1""")
def q3(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select(
        F.col("doc_id").alias("id"),
        F.col("source").alias("document_number"),
        F.when(F.col("lang") != "en", F.col("text")).alias("content_html"),
        "lang",
    )
    return C.first_by_number(docs, "src5", with_content=True).select("id", "lang")


@query("q3s_random_samples", """
SELECT 'documents' AS table_name, 3 AS n_samples, 3 AS n_members, NULL AS label UNION ALL SELECT 'conversations', 3, 3, NULL
UNION ALL SELECT 'empty', 1, 0, 'Bảng empty trống' UNION ALL SELECT 'relations', 3, 3, NULL""")
def q3s(spark: SparkSession, d: str) -> DataFrame:
    """How many samples each table gives, how many of them are rows of it, and the label of an empty one."""
    docs, turns = table(spark, d, "documents").drop("text"), table(spark, d, "conversations").drop("text")
    # Line items stand for relations of orders with parts.
    relations = table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("judgment_id"), F.col("l_partkey").alias("document_id"), F.col("l_linenumber").alias("relation_type")
    )
    orders = table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("case_number"))
    parts = table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("document_number"))
    linked = C.sampled_relations(relations, orders, parts)
    tables = {"documents": docs, "conversations": turns, "empty": docs.limit(0), "relations": linked}
    report = materialize(C.samples_report(tables), "samples")
    everyone = {
        "documents": docs,
        "conversations": turns,
        "relations": C.enriched_relations(relations, orders, parts).where("case_number IS NOT NULL AND document_number IS NOT NULL"),
    }
    known = [
        df.select(F.lit(name).alias("table_name"), F.to_json(F.struct(*tables[name].columns)).alias("sample")).join(
            F.broadcast(report.select("sample")), "sample", "left_semi"
        )
        for name, df in everyone.items()
    ]
    members = known[0].unionByName(known[1]).unionByName(known[2]).distinct().withColumn("member", F.lit(1))
    marked = report.join(members, ["table_name", "sample"], "left")
    return marked.groupBy("table_name").agg(
        F.count("*").cast("int").alias("n_samples"), F.count("member").cast("int").alias("n_members"),
        F.max(F.when(F.col("sample").startswith("Bảng "), F.col("sample"))).alias("label"),
    )


@query("q7_document_view", f"""WITH {CORPUS_SQL}
SELECT id, document_number, document_type, issuing_authority, CAST(issue_date AS VARCHAR) AS issue_date,
  CAST(NULL AS VARCHAR) AS status, CAST(NULL AS VARCHAR) AS effective_date, CAST(issue_date AS VARCHAR) AS gazette_date,
  '' AS gazette_number, '2024-01-01T00:00:00.000000' AS created_at FROM corpus""")
def q7_documents(spark: SparkSession, d: str) -> DataFrame:
    docs = corpus(spark, d).withColumns(
        {
            "status": F.lit(None).cast("string"),
            "effective_date": F.lit(None).cast("string"),
            "gazette_date": F.col("issue_date"),
            "gazette_number": F.lit(""),
            "created_at": F.lit("2024-01-01").cast("timestamp"),
        }
    )
    return C.document_view(docs)


@query("q7_judgment_view", """
SELECT o_orderkey AS id, 'case ' || o_orderkey AS case_name, CAST(o_custkey AS VARCHAR) AS case_number,
  o_orderpriority AS issuing_authority, o_orderstatus AS trial_level, 'civil' AS field,
  strftime(o_orderdate, '%Y-%m-%d') AS judgment_date,
  CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderpriority || ',' || o_orderstatus END AS keywords FROM orders""")
def q7_judgments(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.concat(F.lit("case "), F.col("o_orderkey")).alias("case_name"),
        F.col("o_custkey").cast("string").alias("case_number"),
        F.col("o_orderpriority").alias("issuing_authority"),
        F.col("o_orderstatus").alias("trial_level"),
        F.lit("civil").alias("field"),
        F.col("o_orderdate").cast("date").alias("judgment_date"),
        F.when(F.col("o_orderstatus") != "P", F.array("o_orderpriority", "o_orderstatus")).alias("keywords"),
    )
    return C.judgment_view(rows).withColumn("keywords", F.array_join("keywords", ","))


@query("q7_qa_view", """
SELECT conv_id * 100000 + turn AS id, role AS category, CAST(NULL AS VARCHAR) AS author, role || ',qa' AS tags,
  CAST(conv_id AS VARCHAR) AS related_documents, CAST(NULL AS VARCHAR) AS created_at,
  CAST(NULL AS VARCHAR) AS updated_at, text AS question_html, '' AS answer_html FROM conversations""")
def q7_qa(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "conversations").select(
        (F.col("conv_id") * 100000 + F.col("turn")).alias("id"),
        F.col("role").alias("category"),
        F.lit(None).cast("string").alias("author"),
        F.array("role", F.lit("qa")).alias("tags"),
        F.array("conv_id").alias("related_documents"),
        F.lit(None).cast("timestamp").alias("created_at"),
        F.lit(None).cast("timestamp").alias("updated_at"),
        F.col("text").alias("question_html"),
        F.lit("").alias("answer_html"),
    )
    return C.qa_view(rows).withColumns(
        {"tags": F.array_join("tags", ","), "related_documents": F.array_join(F.col("related_documents").cast("array<string>"), ",")}
    )


@query("q7_relation_view", """
SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS judgment_id, l_partkey AS document_id,
  l_returnflag AS relation_type FROM lineitem""")
def q7_relations(spark: SparkSession, d: str) -> DataFrame:
    return C.relation_view(_relations(spark, d))


_TO_VALIDATE = """rows_ AS (
  SELECT doc_id AS id, text AS document_number, CASE WHEN source = 'src3' THEN '' ELSE lang END AS document_type,
    CASE WHEN source <> 'src5' THEN source END AS issuing_authority,
    CASE WHEN n_chars > 300 THEN '31/02/2020' WHEN lang = 'fr' THEN '' ELSE '1/2/2020' END AS issue_date
  FROM documents),
checked AS (
  SELECT id, CASE WHEN document_number = '' THEN 'Missing required field: document_number'
    WHEN document_type = '' THEN 'Missing required field: document_type'
    WHEN coalesce(issuing_authority, '') = '' THEN 'Missing required field: issuing_authority'
    WHEN issue_date = '' THEN 'Missing required field: issue_date'
    WHEN length(document_number) > 255 THEN 'Document number exceeds maximum length'
    WHEN try_strptime(issue_date, '%d/%m/%Y') IS NULL THEN 'Invalid date format for issue_date' END AS error
  FROM rows_)"""


def _validated(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").select(
        F.col("doc_id").alias("id"),
        F.col("text").alias("document_number"),
        F.when(F.col("source") == "src3", "").otherwise(F.col("lang")).alias("document_type"),
        F.when(F.col("source") != "src5", F.col("source")).alias("issuing_authority"),
        F.when(F.col("n_chars") > 300, "31/02/2020")
        .when(F.col("lang") == "fr", "")
        .otherwise("1/2/2020")
        .alias("issue_date"),
    )
    return C.validate(rows)


@query("q8_validation", f"WITH {_TO_VALIDATE} SELECT id, error FROM checked")
def q8(spark: SparkSession, d: str) -> DataFrame:
    return _validated(spark, d).select("id", "error")


@query("q8_fault_counts", f"WITH {_TO_VALIDATE} SELECT coalesce(error, 'valid') AS error, count(*) AS n_rows FROM checked GROUP BY 1")
def q8_counts(spark: SparkSession, d: str) -> DataFrame:
    return C.fault_counts(_validated(spark, d))


@query("q8_quarantine", f"WITH {_TO_VALIDATE} SELECT id, error FROM checked WHERE error IS NOT NULL")
def q8_quarantine(spark: SparkSession, d: str) -> DataFrame:
    return C.split_valid(_validated(spark, d))[1].select("id", "error")


_FULL = """id, document_number, document_type, issuing_authority, CAST(NULL AS VARCHAR) AS signer,
  CAST(issue_date AS VARCHAR) AS issue_date, 'valid' AS status, 'x' AS effective_date,
  CAST(NULL AS VARCHAR) AS gazette_date, '' AS gazette_number, CAST(NULL AS VARCHAR) AS created_at,
  CAST(NULL AS VARCHAR) AS updated_at"""


def _full_docs(spark: SparkSession, d: str) -> DataFrame:
    return corpus(spark, d).withColumns(
        {
            "signer": F.lit(None).cast("string"),
            "status": F.lit("valid"),
            "effective_date": F.lit("x"),
            "gazette_date": F.lit(None).cast("date"),
            "gazette_number": F.lit(""),
            "created_at": F.lit(None).cast("timestamp"),
            "updated_at": F.lit(None).cast("timestamp"),
            "metadata_html": F.lit(None).cast("string"),
            "content_html": F.concat(F.lit("<p>"), "content_text", F.lit("</p>")),
        }
    )


@query("q20_slim_record", f"WITH {CORPUS_SQL} SELECT {_FULL} FROM corpus")
def q20_slim(spark: SparkSession, d: str) -> DataFrame:
    return C.full_record(_full_docs(spark, d), include_content=False)


@query("q20_full_record", f"""WITH {CORPUS_SQL} SELECT {_FULL}, CAST(NULL AS VARCHAR) AS metadata_html,
  '<p>' || content_text || '</p>' AS content_html, content_text FROM corpus""")
def q20_full(spark: SparkSession, d: str) -> DataFrame:
    return C.full_record(_full_docs(spark, d))


# --- list lookup ------------------------------------------------------------------------------


@query("q11_list_lookup", _BOTH + """
SELECT k.pos, c.id, document_number, document_type FROM key_list k JOIN corpus c USING (document_number)""")
def q11(spark: SparkSession, d: str) -> DataFrame:
    found = L.found_documents(key_list(spark, d), corpus(spark, d))
    return L.in_list_order(found.select("pos", "id", "document_number", "document_type"))


@query("q12_not_found", _BOTH + """
SELECT pos, document_number FROM key_list WHERE document_number NOT IN (SELECT document_number FROM corpus)""")
def q12(spark: SparkSession, d: str) -> DataFrame:
    return L.not_found(key_list(spark, d), corpus(spark, d))


_BY_NUMBER = """SELECT document_number, count(*) AS n_documents FROM corpus
WHERE document_number IN (SELECT document_number FROM key_list) GROUP BY 1"""


@query("q13_documents_by_number", f"{_BOTH} {_BY_NUMBER}")
def q13(spark: SparkSession, d: str) -> DataFrame:
    return L.documents_by_number(key_list(spark, d), corpus(spark, d))


@query("q14_numbers_with_duplicates", f"{_BOTH} {_BY_NUMBER} HAVING count(*) > 1")
def q14(spark: SparkSession, d: str) -> DataFrame:
    return L.numbers_with_duplicates(L.documents_by_number(key_list(spark, d), corpus(spark, d)))


_YEAR = "coalesce(strftime(issue_date, '%Y'), 'Không xác định')"


@query("q15_by_type", _BOTH + """
SELECT document_type, count(*) AS n_documents FROM key_list JOIN corpus USING (document_number) GROUP BY 1""")
def q15(spark: SparkSession, d: str) -> DataFrame:
    return L.by_type(key_list(spark, d), corpus(spark, d))


@query("q16_by_authority", _BOTH + """
SELECT CASE WHEN issuing_authority <> 'src2' THEN issuing_authority END AS issuing_authority, count(*) AS n_documents
FROM key_list JOIN corpus USING (document_number) GROUP BY 1""")
def q16(spark: SparkSession, d: str) -> DataFrame:
    docs = corpus(spark, d).withColumn(
        "issuing_authority", F.when(F.col("issuing_authority") != "src2", F.col("issuing_authority"))
    )
    return L.by_authority(key_list(spark, d), docs)


@query("q17_by_year", f"""{_BOTH}
SELECT {_YEAR} AS year, count(*) AS n_documents FROM key_list JOIN corpus USING (document_number) GROUP BY 1""")
def q17(spark: SparkSession, d: str) -> DataFrame:
    return L.by_year(key_list(spark, d), corpus(spark, d))


@query("q15_17_summaries", f"""{_BOTH}, found AS (SELECT * FROM key_list JOIN corpus USING (document_number))
SELECT 'document_type' AS dimension, document_type AS value, count(*) AS n_documents FROM found GROUP BY 2
UNION ALL SELECT 'issuing_authority', issuing_authority, count(*) FROM found GROUP BY 2
UNION ALL SELECT 'year', {_YEAR}, count(*) FROM found GROUP BY 2""")
def q15_17(spark: SparkSession, d: str) -> DataFrame:
    return L.summaries(key_list(spark, d), corpus(spark, d))


@query("q18_coverage", _BOTH + """,
n AS (SELECT document_number, count(*) AS n_docs FROM corpus GROUP BY 1),
t AS (SELECT count(*) AS total_searched, CAST(coalesce(sum(n_docs), 0) AS BIGINT) AS total_found,
  count(DISTINCT CASE WHEN n_docs IS NOT NULL THEN document_number END) AS found_numbers,
  count(*) FILTER (WHERE n_docs IS NULL) AS not_found_count
  FROM key_list LEFT JOIN n USING (document_number))
SELECT *, round(found_numbers / total_searched * 100, 2) AS found_percent,
  round(not_found_count / total_searched * 100, 2) AS not_found_percent FROM t""")
def q18(spark: SparkSession, d: str) -> DataFrame:
    return L.coverage(key_list(spark, d), corpus(spark, d))


@query("q19_top_duplicates", f"""{_BOTH}, b AS ({_BY_NUMBER} HAVING count(*) > 1),
p AS (SELECT document_number, min(pos) AS pos FROM key_list GROUP BY 1)
SELECT document_number, n_documents, pos FROM b JOIN p USING (document_number) ORDER BY n_documents DESC, pos LIMIT 5""")
def q19(spark: SparkSession, d: str) -> DataFrame:
    return L.top_duplicates(key_list(spark, d), corpus(spark, d))


@query("q21_q23_keys", f"""WITH {CORPUS_SQL}, k AS (SELECT document_number || '#' || id AS document_key FROM corpus)
SELECT document_key, md5(document_key) AS query_id, substr(sha256(document_key), 1, 24) AS object_id,
  24 AS random_id_length FROM k""")
def q21(spark: SparkSession, d: str) -> DataFrame:
    key = T.document_key(F.col("document_number"), F.col("id"))
    return corpus(spark, d).select(
        key.alias("document_key"),
        T.query_id(key).alias("query_id"),
        T.object_id(key).alias("object_id"),
        F.length(T.random_object_id()).alias("random_id_length"),
    )


@query("s7_lookup_ids", _BOTH + """,
f AS (SELECT document_number || '#' || id AS k, pos FROM key_list JOIN corpus USING (document_number))
SELECT substr(sha256(k || '#' || pos), 1, 24) AS oid, k AS document_id FROM f""")
def s7(spark: SparkSession, d: str) -> DataFrame:
    """Written as JSON and read back."""
    path = _scratch(spark, "lookup-ids")
    json_files.write_lookup_ids(key_list(spark, d), corpus(spark, d).drop("content_text"), path)
    rows = spark.read.schema("_id STRUCT<`$oid`: STRING>, document_id STRING").json(path)
    return rows.select(F.col("_id.$oid").alias("oid"), "document_id")


@query("s6_lookup_documents", _BOTH + """
SELECT c.id, document_number, document_type, CAST(issue_date AS VARCHAR) AS issue_date, length(content_text) AS n
FROM key_list JOIN corpus c USING (document_number)""")
def s6(spark: SparkSession, d: str) -> DataFrame:
    """Lookup result written as JSON; its documents read back."""
    path = _scratch(spark, "lookup")
    json_files.write_lookup(key_list(spark, d), _full_docs(spark, d), path)
    schema = "id BIGINT, document_number STRING, document_type STRING, issue_date STRING, content_text STRING"
    return spark.read.schema(schema).json(f"{path}/documents").select(
        "id", "document_number", "document_type", "issue_date",
        F.length("content_text").cast("bigint").alias("n"),
    )


def _named(df: DataFrame, part: str, name: str, value: str) -> DataFrame:
    return df.select(F.lit(part).alias("part"), F.col(name).cast("string").alias("name"), F.col(value).cast("string").alias("value"))


def _columns(df: DataFrame, part: str, *columns: str) -> DataFrame:
    """The columns of a single row as rows."""
    pairs = F.explode(F.array(*(F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for c in columns)))
    return df.select(pairs.alias("p")).select(F.lit(part).alias("part"), "p.name", "p.value")


_COVERAGE = """t AS (
  SELECT (SELECT count(*) FROM key_list) AS searched, (SELECT count(*) FROM key_list JOIN corpus USING (document_number)) AS found,
    (SELECT count(DISTINCT document_number) FROM key_list JOIN corpus USING (document_number)) AS numbers,
    (SELECT count(*) FROM key_list WHERE document_number NOT IN (SELECT document_number FROM corpus)) AS missing)"""
_MISSING = "SELECT 'not_found' AS part, document_number AS name, CAST(pos AS VARCHAR) AS value FROM key_list WHERE document_number NOT IN (SELECT document_number FROM corpus)"


@query("s6_lookup_parts", f"""{_BOTH}, {_COVERAGE}
{_MISSING}
UNION ALL SELECT 'summary', unnest(['total_found', 'total_searched', 'not_found_count', 'include_content', 'stamped']),
  unnest([CAST(found AS VARCHAR), CAST(searched AS VARCHAR), CAST(missing AS VARCHAR), 'false', 'true']) FROM t""")
def s6_parts(spark: SparkSession, d: str) -> DataFrame:
    """Summary and entries not found of a written lookup."""
    path = _scratch(spark, "lookup")
    json_files.write_lookup(key_list(spark, d), _full_docs(spark, d), path, include_content=False)
    summary = spark.read.schema("total_found BIGINT, total_searched BIGINT, not_found_count BIGINT, timestamp STRING, include_content BOOLEAN").json(f"{path}/summary")
    summary = summary.withColumn("stamped", F.col("timestamp").rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{6}$"))
    missing = spark.read.schema("pos BIGINT, document_number STRING").json(f"{path}/not_found")
    return _named(missing, "not_found", "document_number", "pos").union(
        _columns(summary, "summary", "total_found", "total_searched", "not_found_count", "include_content", "stamped")
    )


_PARTS = {  # part: schema of its JSON, name and value
    "not_found": ("pos BIGINT, document_number STRING", "document_number", "pos"),
    "documents_by_number": ("document_number STRING, n_documents BIGINT", "document_number", "n_documents"),
    "documents_with_duplicates": ("document_number STRING, n_documents BIGINT", "document_number", "n_documents"),
    "summary_by_document_type": ("document_type STRING, n_documents BIGINT", "document_type", "n_documents"),
    "summary_by_issuing_authority": ("issuing_authority STRING, n_documents BIGINT", "issuing_authority", "n_documents"),
    "summary_by_year": ("year STRING, n_documents BIGINT", "year", "n_documents"),
    "top_duplicates": ("document_number STRING, n_documents BIGINT, pos BIGINT", "document_number", "n_documents"),
}


@query("s8_report_parts", f"""{_BOTH}, {_COVERAGE}, b AS ({_BY_NUMBER}), found AS (SELECT * FROM key_list JOIN corpus USING (document_number)),
p AS (SELECT document_number, min(pos) AS pos FROM key_list GROUP BY 1)
{_MISSING}
UNION ALL SELECT 'documents_by_number', document_number, CAST(n_documents AS VARCHAR) FROM b
UNION ALL SELECT 'documents_with_duplicates', document_number, CAST(n_documents AS VARCHAR) FROM b WHERE n_documents > 1
UNION ALL SELECT 'summary_by_document_type', document_type, CAST(count(*) AS VARCHAR) FROM found GROUP BY 2
UNION ALL SELECT 'summary_by_issuing_authority', issuing_authority, CAST(count(*) AS VARCHAR) FROM found GROUP BY 2
UNION ALL SELECT 'summary_by_year', {_YEAR}, CAST(count(*) AS VARCHAR) FROM found GROUP BY 2
UNION ALL SELECT * FROM (SELECT 'top_duplicates', document_number, CAST(n_documents AS VARCHAR) FROM b JOIN p USING (document_number) WHERE n_documents > 1 ORDER BY n_documents DESC, pos LIMIT 5)
UNION ALL SELECT 'coverage', unnest(['total_searched', 'total_found', 'found_numbers', 'not_found_count', 'found_percent', 'not_found_percent']),
  unnest([CAST(searched AS VARCHAR), CAST(found AS VARCHAR), CAST(numbers AS VARCHAR), CAST(missing AS VARCHAR),
    CAST(round(numbers / searched * 100, 2) AS VARCHAR), CAST(round(missing / searched * 100, 2) AS VARCHAR)]) FROM t""")
def s8_parts(spark: SparkSession, d: str) -> DataFrame:
    """Every row of all eight parts of a written report."""
    path = _scratch(spark, "report")
    json_files.write_report(key_list(spark, d), corpus(spark, d).drop("content_text"), path)
    parts = [_named(spark.read.schema(schema).json(f"{path}/{part}"), part, name, value) for part, (schema, name, value) in _PARTS.items()]
    totals = spark.read.schema("total_searched BIGINT, total_found BIGINT, found_numbers BIGINT, not_found_count BIGINT, found_percent DOUBLE, not_found_percent DOUBLE").json(f"{path}/coverage")
    parts.append(_columns(totals, "coverage", *totals.columns))
    return functools.reduce(DataFrame.union, parts)


@query("s8_report_totals", _BOTH + """,
hit AS (SELECT DISTINCT document_number FROM key_list JOIN corpus USING (document_number)),
by_number AS (""" + _BY_NUMBER + """)
SELECT (SELECT count(*) FROM key_list) AS total_document_numbers, (SELECT count(*) FROM hit) AS found_document_numbers,
  (SELECT count(*) FROM key_list WHERE document_number NOT IN (SELECT * FROM hit)) AS not_found_document_numbers,
  (SELECT count(*) FROM by_number WHERE n_documents > 1) AS n_with_duplicates,
  (SELECT CAST(sum(n_documents) AS BIGINT) FROM by_number) AS n_documents""")
def s8(spark: SparkSession, d: str) -> DataFrame:
    """Report written as JSON folders; its totals read back from three of the parts."""
    path = _scratch(spark, "report")
    json_files.write_report(key_list(spark, d), corpus(spark, d).drop("content_text"), path)
    totals = spark.read.schema("total_searched BIGINT, found_numbers BIGINT, not_found_count BIGINT").json(
        f"{path}/coverage"
    )
    counted = "document_number STRING, n_documents BIGINT"
    by_number = spark.read.schema(counted).json(f"{path}/documents_by_number")
    repeated = spark.read.schema(counted).json(f"{path}/documents_with_duplicates")
    return totals.select(
        F.col("total_searched").alias("total_document_numbers"),
        F.col("found_numbers").alias("found_document_numbers"),
        F.col("not_found_count").alias("not_found_document_numbers"),
        repeated.agg(F.count("*")).scalar().alias("n_with_duplicates"),
        by_number.agg(F.sum("n_documents")).scalar().alias("n_documents"),
    )


# --- relations --------------------------------------------------------------------------------


def _relations(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        F.col("l_orderkey").alias("judgment_id"),
        F.col("l_partkey").alias("document_id"),
        F.col("l_returnflag").alias("relation_type"),
    )


def _judgments(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").filter("o_orderstatus = 'F'").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("case_number")
    )


def _parts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").filter("p_size > 10").select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("document_number")
    )


@query("q4_enriched_relations", """
SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS judgment_id, l_partkey AS document_id,
  l_returnflag AS relation_type, o_orderpriority AS case_number, p_name AS document_number
FROM lineitem LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus = 'F') o ON o_orderkey = l_orderkey
LEFT JOIN (SELECT * FROM part WHERE p_size > 10) p ON p_partkey = l_partkey""")
def q4(spark: SparkSession, d: str) -> DataFrame:
    return C.enriched_relations(_relations(spark, d), _judgments(spark, d), _parts(spark, d))


@query("q5_linked", """
SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS judgment_id, l_partkey AS document_id,
  l_returnflag AS relation_type, o_orderpriority AS case_number, p_name AS document_number
FROM lineitem JOIN (SELECT * FROM orders WHERE o_orderstatus = 'F') o ON o_orderkey = l_orderkey
JOIN (SELECT * FROM part WHERE p_size > 10) p ON p_partkey = l_partkey""")
def q5(spark: SparkSession, d: str) -> DataFrame:
    return C.linked(_relations(spark, d), _judgments(spark, d), _parts(spark, d))


@query("q6_child_counts", """
SELECT c_custkey AS id, c_name, count(o_orderkey) AS n_orders
FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1, 2""")
def q6_counts(spark: SparkSession, d: str) -> DataFrame:
    parents = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), "c_name")
    return C.with_children(parents, table(spark, d, "orders"), "id", "o_custkey", "n_orders")


@query("q6_child_rows", """
SELECT d.doc_id AS id, lang, quality, toxic FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""")
def q6_rows(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("id"), "lang")
    return C.child_rows(docs, table(spark, d, "labels"), "id", "doc_id").select(
        "id", "lang", "quality", "toxic"
    )


# --- sources and sinks ------------------------------------------------------------------------


@query("s1_table_scan", "SELECT doc_id, lang FROM documents")
def s1(spark: SparkSession, d: str) -> DataFrame:
    return tables.read_table(spark, d, "documents.parquet", ["doc_id", "lang"])


@query("s3_s4_csv_round_trip", f"""WITH {CORPUS_SQL}
SELECT id, document_number, document_type, issuing_authority, CAST(issue_date AS VARCHAR) AS issue_date,
  content_text FROM corpus""")
def s3_s4(spark: SparkSession, d: str) -> DataFrame:
    path = _scratch(spark, "csv")
    rows = corpus(spark, d)
    csv_files.export_csv(rows, path)
    good, _ = csv_files.read_csv_table(spark, path, "legal_documents", rows.columns, foreign=False)
    return good.select(
        "id", "document_number", "document_type", "issuing_authority",
        C.iso(F.col("issue_date"), "date").alias("issue_date"), "content_text",
    )


@query("s4_csv_quarantine", """
SELECT CASE WHEN lang = 'fr' THEN 'n' || doc_id ELSE CAST(doc_id AS VARCHAR) END AS id,
  CASE WHEN lang = 'fr' THEN 'id,gazette_date' ELSE 'gazette_date' END AS bad_columns
FROM documents WHERE lang IN ('fr', 'de')""")
def s4_quarantine(spark: SparkSession, d: str) -> DataFrame:
    path = _scratch(spark, "csv")
    lang = F.col("lang")
    rows = table(spark, d, "documents").select(
        F.when(lang == "fr", F.concat(F.lit("n"), F.col("doc_id"))).otherwise(F.col("doc_id").cast("string")).alias("id"),
        F.md5("text").alias("document_number"),
        F.when(lang.isin("fr", "de"), "Đã biết").when(lang == "es", "").otherwise("2025-01-21").alias("gazette_date"),
        F.lit("Đã biết").alias("effective_date"),
    )
    csv_files.export_csv(rows, path)
    _, bad = csv_files.read_csv_table(spark, path, "legal_documents", rows.columns, foreign=False)
    return bad.select("id", F.array_join("bad_columns", ",").alias("bad_columns"))


@query("s4_foreign_csv", """
SELECT doc_id AS id, 'n"' || source || '",\\' || chr(13) || chr(10) || lang AS document_number, nullif(trim(lang, 'es'), '') AS document_type, '' AS signer, text AS content_text FROM documents""")
def s4_foreign(spark: SparkSession, d: str) -> DataFrame:
    """Files as other programs write them: quotes doubled, line breaks and backslashes inside cells as they are."""
    path = _scratch(spark, "foreign-csv")
    quoted = lambda c: F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
    number = F.concat(F.lit('n"'), "source", F.lit('",\\\r\n'), "lang")
    kind = F.coalesce(F.expr("nullif(trim(BOTH 'es' FROM lang), '')"), F.lit(""))
    line = F.concat_ws(",", F.col("doc_id").cast("string"), quoted(number), kind, F.lit('""'), quoted(F.col("text")))
    columns = ["id", "document_number", "document_type", "signer", "content_text"]
    # Every task writes a file of its own; the lower 33 bits number its rows, and its header goes before the first.
    first = F.monotonically_increasing_id().bitwiseAND(2**33 - 1) == 0
    head = F.when(first, F.lit(",".join(columns) + "\n")).otherwise("")
    table(spark, d, "documents").select(F.concat(head, line).alias("value")).write.text(path)
    good, _ = csv_files.read_csv_table(spark, path, "legal_documents", columns)
    return good.select(columns)


_LISTED = "CASE WHEN lang = 'es' THEN '  ' ELSE ' ' || md5(text) || ' ' END"


@query("s5_key_list_file", f"""
SELECT row_number() OVER (ORDER BY doc_id) - 1 AS pos, trim({_LISTED}) AS document_number
FROM documents QUALIFY document_number <> ''""")
def s5(spark: SparkSession, d: str) -> DataFrame:
    path = _scratch(spark, "keys")
    lines = F.when(F.col("lang") == "es", "  ").otherwise(
        F.concat(F.lit(" "), F.md5("text"), F.lit(" "))
    )
    table(spark, d, "documents").select("doc_id", lines.alias("value")).orderBy("doc_id").select(
        "value"
    ).write.text(path)
    return key_lists.read_key_list(spark, path)


@query("s9_append", """
SELECT doc_id, lang, 2 AS n_rows, 1 AS n_ids, 2 AS n_stamped FROM documents
UNION ALL SELECT doc_id, lang, 1, 1, 0 FROM documents WHERE lang = 'fr'""")
def s9(spark: SparkSession, d: str) -> DataFrame:
    """Appended twice without id and time (one id per key, times filled), once more with both given."""
    path = _scratch(spark, "append")
    rows = table(spark, d, "documents").select("doc_id", "lang")
    tables.append(rows, path, ["doc_id"])
    tables.append(rows, path, ["doc_id"])
    old = F.lit("2000-01-01").cast("timestamp")
    given = rows.filter("lang = 'fr'").select("*", (-F.col("doc_id") - 1).alias("id"), old.alias("created_at"))
    tables.append(given, path, ["doc_id"])
    stored = spark.read.parquet(path).withColumn("own", F.col("id") < 0).filter(
        F.col("own") & (F.col("id") == -F.col("doc_id") - 1) | (F.col("id") == F.xxhash64("doc_id"))
    ).withColumn("own", F.col("created_at") == old)
    return stored.groupBy("doc_id", "lang", "own").agg(
        F.count("*").cast("int").alias("n_rows"), F.countDistinct("id").cast("int").alias("n_ids"), F.count_if(F.col("created_at") > old).cast("int").alias("n_stamped")
    ).drop("own")


@query("s10_lists_and_parties", """
SELECT doc_id, CASE lang WHEN 'en' THEN 'a|' || source WHEN 'fr' THEN source ELSE '' END AS tags,
  source || '|x' AS nguyen_don, lang AS bi_don, '' AS ben_lien_quan FROM documents""")
def s10_lists(spark: SparkSession, d: str) -> DataFrame:
    """Tags as a JSON list, a bare JSON text or NULL; parties of lists, texts and absent roles."""
    q = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    lang, source = F.col("lang"), F.col("source")
    tags = F.when(lang == "en", F.concat(F.lit('["a",'), q(source), F.lit("]"))).when(lang == "fr", q(source))
    parties = F.concat(F.lit('{"nguyen_don":['), q(source), F.lit(',"x"],"bi_don":'), q(lang), F.lit("}"))
    rows = table(spark, d, "documents").select("doc_id", tables.text_list(tags).alias("tags"), tables.parties_from_json(parties).alias("p"))
    return rows.select("doc_id", F.array_join("tags", "|").alias("tags"), *[F.array_join(f"p.{r}", "|").alias(r) for r in ("nguyen_don", "bi_don", "ben_lien_quan")])


@query("s10_json_columns", """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
  '{"k":' || json_extract(props, '$.k') || '}' AS props FROM events""")
def s10(spark: SparkSession, d: str) -> DataFrame:
    parsed = table(spark, d, "events").select(
        "event_id", tables.parse_json(F.col("props"), "k BIGINT").alias("p")
    )
    return parsed.select("event_id", F.col("p.k").alias("k"), F.to_json("p").alias("props"))


# --- scalar helpers on whole tables -----------------------------------------------------------


@query("fn_preview", """
SELECT doc_id, CASE WHEN length(text) > 300 THEN substr(text, 1, 300) || '…' ELSE text END AS preview FROM documents""")
def fn_preview(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", T.preview(F.col("text")).alias("preview"))
