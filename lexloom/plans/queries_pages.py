"""Extraction queries: raw pages, and statute/judgment pages derived from tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.functions import html as H
from lexloom.functions import text as T
from lexloom.operators import extraction as X
from lexloom.plans.inputs import LAW_STATUS_SQL, judgment_pages, law_pages
from lexloom.plans.queries_corpus import _scratch
from lexloom.plans.registry import query, table
from lexloom.sources import keyed_tables, tables
from lexloom.streaming.pages import append_to, table_stream

_ARTICLE = ("article", H.opener("article"))
_UNESCAPE = """replace(replace(replace(replace({0}, '&quot;', '"'), '&copy;', '©'), '&middot;', '·'), '&amp;', '&')"""
_BODY = "regexp_extract(html, '(?s)<article>.*?</article>')"
_RUNS = f"""[y FOR y IN [trim({_UNESCAPE.format('x')}, ' ' || chr(10) || chr(9)) FOR x IN
  string_split_regex({_BODY}, '<[^>]*>')] IF y <> '']"""
_FLAT = r"[y FOR y IN [trim(regexp_replace(x, '[\s\p{Z}]+', ' ', 'g')) FOR x IN string_split(%s, chr(10))] IF y <> '']"
_X7 = f"""SELECT page_id, array_to_string({_FLAT % f"array_to_string({_RUNS}, chr(10))"}, chr(10) || chr(10)) AS content_text FROM pages"""


def _sections(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages", heavy=True).select(
        "page_id", X.section(H.tokens(F.col("html")), _ARTICLE).alias("content")
    )


@query("s2_captured_pages", """
SELECT url AS document_id, 'page' AS document_type, CAST('HTTP status 404' AS VARCHAR) AS error FROM pages WHERE contains(url, '?')""")
def s2(spark: SparkSession, d: str) -> DataFrame:
    captured = table(spark, d, "pages").select(
        F.lit("page").alias("doc_type"),
        F.col("url").alias("doc_key"),
        F.lit(None).cast("timestamp_ntz").alias("fetched_at"),
        F.when(F.contains("url", F.lit("?")), 404).otherwise(200).alias("http_status"),
    )
    return tables.failed_fetches(captured).select("document_id", "document_type", "error")


@query("x1_section", f"SELECT page_id, md5({_BODY}) AS section_md5, length({_BODY}) AS n_chars FROM pages")
def x1(spark: SparkSession, d: str) -> DataFrame:
    section = H.html_of(F.col("content"))
    return _sections(spark, d).select(
        "page_id", F.md5(section).alias("section_md5"), F.length(section).cast("bigint").alias("n_chars")
    )


@query("x7_law_text", _X7)
def x7(spark: SparkSession, d: str) -> DataFrame:
    return _sections(spark, d).select("page_id", X.law_text(F.col("content")).alias("content_text"))


@query("x7_references", """
SELECT doc_id, source || ' � � � € – [ ' || lang || ' &copy2024 &notit; &lt; © A' || chr(10) || chr(10) || '�' || source || '&' AS content_text FROM documents""")
def x7_references(spark: SparkSession, d: str) -> DataFrame:
    """References of every kind in one section: impossible numbers, windows-1252 ones, names with and without semicolon."""
    first = "<article><p>{0} &#0; &#xD800; &#99999999; &#x80; &#150; &lsqb {1} &copy2024 &notit; &amp;lt; &copy; &#x0000041;</p>"
    second = "<p>&#x110000;{0}&amp</p></article>"
    columns = {"{0}": F.col("source"), "{1}": F.col("lang")}
    html = F.lit(first + second)
    for mark, column in columns.items():
        html = F.replace(html, F.lit(mark), column)
    section = table(spark, d, "documents", heavy=True).select("doc_id", X.section(H.tokens(html), _ARTICLE).alias("content"))
    return section.select("doc_id", X.law_text(F.col("content")).alias("content_text"))


@query("x13_judgment_text", f"""
SELECT page_id, array_to_string([y FOR y IN [trim(x) FOR x IN string_split(array_to_string({_RUNS}, ' '), chr(10))]
  IF y <> ''], chr(10)) AS content_text FROM pages""")
def x13(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "pages", heavy=True)
    content = X.markup_section(H.markup(F.col("html")), _ARTICLE)
    return pages.select("page_id", X.judgment_text(content).alias("content_text"))


@query("x10_link_texts", """
WITH links AS (SELECT page_id, unnest(regexp_extract_all(html, '<a [^>]*>([^<]*)</a>', 1)) AS txt,
  generate_subscripts(regexp_extract_all(html, '<a [^>]*>([^<]*)</a>', 1), 1) AS pos FROM pages)
SELECT page_id, pos, trim(txt) AS txt FROM links""")
def x10(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "pages", heavy=True).withColumn("_toks", H.tokens(F.col("html")))
    links = pages.select("page_id", F.posexplode(X.link_texts(F.col("_toks"))).alias("pos", "txt"))
    return links.select("page_id", (F.col("pos") + 1).cast("bigint").alias("pos"), "txt")


@query("x6_status_codes", """
SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN 'pending' WHEN 'F' THEN 'failed' ELSE 'unknown' END AS status FROM orders""")
def x6(spark: SparkSession, d: str) -> DataFrame:
    codes = {"p": "pending", "f": "failed"}
    return table(spark, d, "orders").select(
        "o_orderkey", T.status_code(F.col("o_orderstatus"), codes).alias("status")
    )


_LAYOUTS = {  # status/priority picks how a date is written
    "5-LOW": ("yyyy-M-d", "%Y-%-m-%-d"),
    "4-NOT SPECIFIED": ("d M yyyy", "%-d %-m %Y"),
    "3-MEDIUM": ("d-M-yyyy", "%-d-%-m-%Y"),
    "2-HIGH": ("dd/MM/yy", "%d/%m/%y"),
}


@query("x8_flexible_dates", """
WITH t AS (SELECT o_orderkey, CASE o_orderpriority """
    + " ".join(f"WHEN '{p}' THEN strftime(o_orderdate, '{s}')" for p, (_, s) in _LAYOUTS.items())
    + """ ELSE CASE WHEN o_orderstatus = 'P' THEN '31/02/2020' ELSE strftime(o_orderdate, '%Y/%-m/%-d') END END AS txt FROM orders)
SELECT o_orderkey, strftime(CASE WHEN regexp_matches(txt, '^\\d{1,2}/\\d{1,2}/\\d\\d$') THEN try_strptime(txt, '%d/%m/%y')
  ELSE try_strptime(txt, ['%d/%m/%Y', '%Y-%m-%d', '%d %m %Y', '%d-%m-%Y', '%Y/%m/%d']) END, '%Y-%m-%d') AS d FROM t""")
def x8(spark: SparkSession, d: str) -> DataFrame:
    written = F
    for priority, (layout, _) in _LAYOUTS.items():
        written = written.when(F.col("o_orderpriority") == priority, F.date_format("o_orderdate", layout))
    written = written.when(F.col("o_orderstatus") == "P", "31/02/2020").otherwise(
        F.date_format("o_orderdate", "yyyy/M/d")
    )
    return table(spark, d, "orders").select(
        "o_orderkey", F.date_format(T.flexible_date(written), "yyyy-MM-dd").alias("d")
    )


_LAW_FIELDS = f"""
  doc_id || '/QĐ-' || source AS document_number, lang || ' ' || lang AS document_type,
  source || ' ố' AS issuing_authority, CASE WHEN lang = 'en' THEN 'N. ' || source ELSE '' END AS signer,
  CASE WHEN lang <> 'es' THEN CAST(DATE '2000-01-01' + CAST(n_chars AS INTEGER) AS VARCHAR) END AS issue_date,
  CASE WHEN lang = 'fr' THEN '2025-03-01' END AS effective_date,
  {LAW_STATUS_SQL} AS status"""
_LAW_TEXT = f"array_to_string({_FLAT % 'text'}, chr(10) || chr(10)) AS content_text"


@query("x15_law_records", f"""
SELECT CAST(doc_id AS VARCHAR) AS doc_key, {_LAW_FIELDS},
  CASE WHEN lang = 'en' THEN '' ELSE strftime(DATE '2000-01-01' + CAST(n_chars AS INTEGER), '%-d/%-m/%Y') END AS gazette_date,
  CASE WHEN lang = 'fr' THEN 'Số ' || doc_id ELSE '' END AS gazette_number, {_LAW_TEXT},
  CASE WHEN lang = 'de' THEN 'impossible effective date: 31/02/2020' END AS error
FROM documents WHERE source <> 'src7'
UNION ALL
SELECT CAST(doc_id AS VARCHAR), '', '', '', '', NULL, NULL, 'unknown', '', '', '', 'HTTP status 404'
FROM documents WHERE source = 'src7'""")
def x15(spark: SparkSession, d: str) -> DataFrame:
    """X2-X7 assembled: every field of the record."""
    return X.law_records(law_pages(spark, d)).select(
        "doc_key", "document_number", "document_type", "issuing_authority", "signer",
        F.date_format("issue_date", "yyyy-MM-dd").alias("issue_date"),
        F.date_format("effective_date", "yyyy-MM-dd").alias("effective_date"),
        "status", "gazette_date", "gazette_number", "content_text", "error",
    )


@query("x17_write_defaults", f"""
SELECT CAST(doc_id AS VARCHAR) AS doc_key, doc_id || '/QĐ-' || source AS document_number,
  CASE WHEN lang <> 'en' THEN CAST(DATE '2000-01-01' + CAST(n_chars AS INTEGER) AS VARCHAR) END AS gazette_date,
  {LAW_STATUS_SQL} AS status FROM documents WHERE source <> 'src7' AND lang <> 'de'""")
def x17(spark: SparkSession, d: str) -> DataFrame:
    records = X.law_records(law_pages(spark, d)).filter("error IS NULL").drop("error")
    return X.with_write_defaults(records).select(
        "doc_key", "document_number", F.date_format("gazette_date", "yyyy-MM-dd").alias("gazette_date"), "status"
    )


@query("x17_keep_latest", """
SELECT md5(text) AS document_number, max(doc_id) AS id FROM documents GROUP BY 1""")
def x17_latest(spark: SparkSession, d: str) -> DataFrame:
    records = table(spark, d, "documents").select(
        F.md5("text").alias("document_number"), F.col("doc_id").alias("id")
    )
    return X.resolve_duplicates(records, "document_number", ["id"], "keep_latest")


@query("x17_merge_stored", """
WITH r AS (SELECT CASE WHEN lang = 'es' AND n_chars % 7 = 0 THEN NULL ELSE source || '/' || n_chars % 40 END AS document_number, n_chars AS fetched, doc_id AS id, md5(text) AS digest FROM documents)
SELECT * FROM r WHERE document_number IS NULL
UNION ALL SELECT * FROM (SELECT * FROM r WHERE document_number IS NOT NULL QUALIFY row_number() OVER (PARTITION BY document_number ORDER BY fetched DESC, id DESC) = 1)""")
def x17_merge(spark: SparkSession, d: str) -> DataFrame:
    """Three rounds of records merged into a stored table; a later round need not be the newer one."""
    docs = table(spark, d, "documents")
    number = F.when((F.col("lang") == "es") & (F.col("n_chars") % 7 == 0), None).otherwise(F.concat("source", F.lit("/"), F.col("n_chars") % 40))
    records = docs.select(number.alias("document_number"), F.col("n_chars").alias("fetched"), F.col("doc_id").alias("id"), F.md5("text").alias("digest"))
    root = _scratch(spark, "stored-records")
    for n in range(3):
        keyed_tables.merge(records.filter(F.pmod("id", F.lit(3)) == n), root, ["document_number"], ["fetched", "id"], buckets=32)
    return keyed_tables.current(spark, root)


@query("x16_judgment_records", """
SELECT CAST(o_orderkey AS VARCHAR) AS doc_key, 'Bản án ' || o_orderkey || ' về ' || o_orderpriority AS case_name,
  o_orderkey || '/DS' AS case_number, 'Tòa ' || o_custkey AS issuing_authority,
  CASE WHEN o_orderstatus = 'F' THEN 'Phúc thẩm' ELSE 'Sơ thẩm' END AS trial_level, o_orderstatus AS field,
  strftime(o_orderdate, '%Y-%m-%d') AS judgment_date,
  CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderpriority || '|' || o_orderstatus || ' & x' END AS keywords,
  'Quyết định' || chr(10) || 'số ' || o_orderkey || ' hết' AS content_text,
  'Bên ' || o_custkey || '|B' AS nguyen_don, 'Bị ' || o_orderkey AS bi_don, '' AS ben_lien_quan,
  CASE WHEN o_orderstatus = 'P' THEN 'Từ khóa:' ELSE '' END AS missing_labels FROM orders""")
def x16(spark: SparkSession, d: str) -> DataFrame:
    """X9-X14 assembled: every field of the record."""
    return X.judgment_records(judgment_pages(spark, d)).select(
        "doc_key", "case_name", "case_number", "issuing_authority", "trial_level", "field",
        F.date_format("judgment_date", "yyyy-MM-dd").alias("judgment_date"),
        F.array_join("keywords", "|").alias("keywords"),
        "content_text",
        *[F.array_join(f"related_parties.{r}", "|").alias(r) for r in ("nguyen_don", "bi_don", "ben_lien_quan")],
        F.array_join("missing_labels", "|").alias("missing_labels"),
    )


@query("x18_qa_records", """
WITH t AS (SELECT conv_id, turn, role, text, lead(role) OVER w AS next_role, lead(text) OVER w AS answer
  FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
SELECT conv_id || '-' || turn AS doc_key, text AS question_html,
  CASE WHEN next_role = 'assistant' THEN answer END AS answer_html, CAST(conv_id AS VARCHAR) AS category
FROM t WHERE role = 'user'""")
def x18(spark: SparkSession, d: str) -> DataFrame:
    """A user turn with the turn after it; paired by key, so a long conversation is no hot group."""
    turns = table(spark, d, "conversations")
    follow = turns.filter("role = 'assistant'").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer")
    )
    pairs = turns.filter("role = 'user'").join(follow, ["conv_id", "turn"], "left")
    keyed = pairs.withColumn("doc_key", F.concat_ws("-", "conv_id", "turn"))
    return X.qa_records(keyed, F.col("text"), F.col("answer"), F.col("conv_id").cast("string"))


@query("r1_page_stream", _X7)
def r1(spark: SparkSession, d: str) -> DataFrame:
    root = _scratch(spark, "page-stream")
    pages = table_stream(spark, d, "pages", "page_id BIGINT, url STRING, html STRING")
    texts = pages.select(
        "page_id", X.section(H.tokens(F.col("html")), _ARTICLE).alias("content")
    ).select("page_id", X.law_text(F.col("content")).alias("content_text"))
    append_to(texts, root, f"{root}-checkpoint").awaitTermination()
    return spark.read.parquet(root)
