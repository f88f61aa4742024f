"""Given tables in the roles the operators expect, and the same roles in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.plans.registry import table

# --- documents as a corpus --------------------------------------------------------------------

CORPUS_SQL = """
corpus AS (
  SELECT doc_id AS id, md5(text) AS document_number, lang AS document_type,
         source AS issuing_authority,
         CASE WHEN lang <> 'es' THEN DATE '2000-01-01' + CAST(n_chars AS INTEGER) END AS issue_date,
         text AS content_text
  FROM documents)"""


def corpus(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select(
        F.col("doc_id").alias("id"),
        F.md5("text").alias("document_number"),
        F.col("lang").alias("document_type"),
        F.col("source").alias("issuing_authority"),
        F.when(
            F.col("lang") != "es",
            F.date_add(F.lit("2000-01-01").cast("date"), F.col("n_chars").cast("int")),
        ).alias("issue_date"),
        F.col("text").alias("content_text"),
    )


# Numbers of the labelled documents (found, repeated where texts are) and of the
# benchmark items (mostly not found).
KEY_LIST_SQL = """
key_list AS (
  SELECT l.doc_id AS pos, md5(d.text) AS document_number
  FROM labels l JOIN documents d ON d.doc_id = l.doc_id
  UNION ALL
  SELECT -1 - item_id, md5(text) FROM benchmark)"""


def key_list(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", F.md5("text").alias("document_number"))
    labelled = table(spark, d, "labels").join(docs, "doc_id").select(
        F.col("doc_id").alias("pos"), "document_number"
    )
    items = table(spark, d, "benchmark").select(
        (F.lit(-1) - F.col("item_id")).alias("pos"), F.md5("text").alias("document_number")
    )
    return labelled.unionByName(items)


# --- orders as queue, events as attempts -------------------------------------------------------

TRACKER_SQL = """
tracker AS (
  SELECT o_orderkey AS id, CAST(o_custkey AS VARCHAR) AS document_id,
         CASE WHEN o_totalprice < 250000 THEN 'law' ELSE 'judgment' END AS document_type,
         CASE o_orderstatus WHEN 'P' THEN 'pending' WHEN 'F' THEN 'failed' ELSE 'success' END AS status,
         o_orderdate AS created_at, CAST(NULL AS TIMESTAMP) AS last_attempt,
         CAST(substr(o_orderpriority, 1, 1) AS INTEGER) - 1 AS retry_count,
         CAST(NULL AS VARCHAR) AS error_log
  FROM orders)"""


def tracker(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").cast("string").alias("document_id"),
        F.when(F.col("o_totalprice") < 250000, "law").otherwise("judgment").alias("document_type"),
        F.when(F.col("o_orderstatus") == "P", "pending")
        .when(F.col("o_orderstatus") == "F", "failed")
        .otherwise("success")
        .alias("status"),
        F.col("o_orderdate").alias("created_at"),
        F.lit(None).cast("timestamp_ntz").alias("last_attempt"),
        (F.substring("o_orderpriority", 1, 1).cast("int") - 1).alias("retry_count"),
        F.lit(None).cast("string").alias("error_log"),
    )


ATTEMPTS_SQL = """
attempts AS (
  SELECT event_id AS attempt_id, CAST(user_id AS VARCHAR) AS document_id, 'law' AS document_type,
         ts AS attempted_at, event_type = 'purchase' AS ok,
         CASE WHEN event_type = 'error' THEN 'attempt ' || event_id || ' failed' END AS error
  FROM events WHERE event_type IN ('purchase', 'error'))"""


def attempts(spark: SparkSession, d: str) -> DataFrame:
    return (
        table(spark, d, "events")
        .filter(F.col("event_type").isin("purchase", "error"))
        .select(
            F.col("event_id").alias("attempt_id"),
            F.col("user_id").cast("string").alias("document_id"),
            F.lit("law").alias("document_type"),
            F.col("ts").alias("attempted_at"),
            (F.col("event_type") == "purchase").alias("ok"),
            F.when(
                F.col("event_type") == "error",
                F.concat(F.lit("attempt "), F.col("event_id"), F.lit(" failed")),
            ).alias("error"),
        )
    )


# --- documents as statutes ---------------------------------------------------------------------

# Every line of a document becomes a paragraph; a prefix by line position gives it a heading.
_PREFIXES = {
    0: "Chương II ",
    2: "1. Theo điều 3 và Điều 1 của ",
    3: "a) ",
    5: "Mục 2 ",
    6: "ĐIỀU 5 ",
    7: "đ) theo điều 2, Điều 4 và ",
}

_PREFIX_SQL = " ".join(f"WHEN {k} THEN '{v}'" for k, v in _PREFIXES.items())

STATUTE_SQL = f"""
raw_lines AS (
  SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i
  FROM documents),
paras AS (
  SELECT doc_id, source, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS INTEGER) AS seq, content
  FROM (SELECT doc_id, source, i, trim(
          CASE i % 8 WHEN 1 THEN 'Điều ' || (i // 16 + 1) || '. ' {_PREFIX_SQL} ELSE '' END || line) AS content
        FROM raw_lines)
  WHERE content <> ''),
levels AS (
  SELECT *, CASE
      WHEN regexp_matches(content, '(?i)^PHẦN[\\s\\p{{Z}}]+[A-Z]+') THEN 1
      WHEN regexp_matches(content, '(?i)^Chương[\\s\\p{{Z}}]+[IVXLCDM]+') THEN 2
      WHEN regexp_matches(content, '(?i)^Mục[\\s\\p{{Z}}]+\\d+') THEN 3
      WHEN regexp_matches(content, '(?i)^Điều[\\s\\p{{Z}}]+\\d+[\\.:]?') THEN 4
      WHEN regexp_matches(content, '^\\d+\\.') THEN 5
      WHEN regexp_matches(content, '(?i)^[a-z]\\)') THEN 6 END AS level
  FROM paras),
typed AS (
  SELECT *, CASE level WHEN 1 THEN 'PHẦN' WHEN 2 THEN 'CHƯƠNG' WHEN 3 THEN 'MỤC' WHEN 4 THEN 'ĐIỀU'
            WHEN 5 THEN 'KHOẢN' WHEN 6 THEN 'ĐIỂM' ELSE 'CONTENT' END AS type,
    CASE level WHEN 1 THEN regexp_extract(content, '(\\d+)', 1)
      WHEN 2 THEN regexp_extract(content, 'Chương[\\s\\p{{Z}}]+([IVXLCDM]+)', 1)
      WHEN 3 THEN regexp_extract(content, '(\\d+)', 1)
      WHEN 4 THEN regexp_extract(content, 'Điều[\\s\\p{{Z}}]+(\\d+)', 1)
      WHEN 5 THEN regexp_extract(content, '^(\\d+)\\.', 1)
      WHEN 6 THEN regexp_extract(content, '^([a-z])\\)', 1) END AS number
  FROM levels),
nested AS (
  SELECT *,
    {", ".join(
        f"last_value(CASE WHEN level = {k} THEN seq END IGNORE NULLS) OVER w AS last{k}" for k in range(1, 7))}
  FROM typed
  WINDOW w AS (PARTITION BY doc_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
nodes AS (
  SELECT *, [x FOR x IN [{", ".join(
        f"CASE WHEN {k} < coalesce(level, 7) AND last{k} > "
        + ("-1" if k == 1 else f"greatest({', '.join(f'coalesce(last{j}, -1)' for j in range(1, k))}, -1)")
        + f" THEN last{k} END" for k in range(1, 7))}] IF x IS NOT NULL] AS ancestors
  FROM nested),
arts AS (
  SELECT *, CAST(sum(CASE WHEN level = 4 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY seq) AS BIGINT) AS art
  FROM nodes)"""


def statutes(spark: SparkSession, d: str) -> DataFrame:
    """Documents as statute pages: id, document_number, content_html."""

    def paragraph(line: Column, i: Column) -> Column:
        prefix = F.when(
            i % 8 == 1, F.concat(F.lit("Điều "), F.floor(i / 16) + 1, F.lit(". "))
        )
        for position, text in _PREFIXES.items():
            prefix = prefix.when(i % 8 == position, F.lit(text))
        escaped = F.replace(line, F.lit("&"), F.lit("&amp;"))
        return F.concat(F.lit('<p class="x">'), prefix.otherwise(""), escaped, F.lit("</p>\r\n"))

    return table(spark, d, "documents", heavy=True).select(
        F.col("doc_id").alias("id"),
        F.col("source").alias("document_number"),
        F.concat(
            F.lit("<div><style>p {}</style>"),
            F.array_join(F.transform(F.split("text", "\n"), paragraph), ""),
            F.lit("<!-- <p>end</p> --></div>"),
        ).alias("content_html"),
    )


# --- documents as statute pages with a metadata table ------------------------------------------

LAW_STATUS_SQL = """CASE lang WHEN 'en' THEN 'valid' WHEN 'fr' THEN 'expired' ELSE 'unknown' END"""


def _cell(label: str, value: Column | str) -> list[Column]:
    shown = F.lit(value) if isinstance(value, str) else value
    return [F.lit(f"<td><b> {label} </b></td>\n<td class='v'>"), shown, F.lit("</td>")]


def law_pages(spark: SparkSession, d: str) -> DataFrame:
    """Captured statute pages derived from documents."""
    lang = F.col("lang")
    number = F.concat(F.col("doc_id"), F.lit("/QĐ-"), F.col("source"))
    issued = F.date_format(
        F.date_add(F.lit("2000-01-01").cast("date"), F.col("n_chars").cast("int")), "d/M/yyyy"
    )
    effective = (
        F.when(lang == "en", "Đã biết")
        .when(lang == "fr", "Từ ngày 01/03/2025 trở đi")
        .when(lang == "de", "31/02/2020")
        .otherwise("chưa rõ")
    )
    validity = (
        F.when(lang == "en", "Còn hiệu lực")
        .when(lang == "fr", "Hết hiệu lực")
        .when(lang == "de", "Đang cập nhật")
        .otherwise("khác")
    )
    body = F.replace(F.replace("text", F.lit("&"), F.lit("&amp;")), F.lit("\n"), F.lit("</p>\n<p>"))
    html = F.concat(
        F.lit("<!DOCTYPE html><html><head><script>var s='<div id=\"divThuocTinh\">';</script></head><body>"),
        F.lit("<div class='page'><div id='divThuocTinh' class='tab'><table><tr>"),
        *_cell("Số hiệu:", F.concat(F.lit(" <span>(x <span>y</span>)</span>"), number, F.lit("\n "))),
        *_cell("Loại văn bản:", F.concat(lang, F.lit(" &nbsp; "), lang)),
        F.lit("</tr><tr>"),
        *_cell("Nơi ban hành:", F.concat(F.lit("<i>"), F.col("source"), F.lit("</i> &#7889;"))),
        *_cell("Người ký:", F.when(lang == "en", F.concat(F.lit("N. "), F.col("source"))).otherwise("Chưa xác định")),
        F.lit("</tr><tr>"),
        *_cell("Ngày ban hành:", F.when(lang == "es", "không rõ").otherwise(issued)),
        *_cell("Ngày hiệu lực:", effective),
        F.lit("</tr><tr><td>Ngày công báo:</td><td>"),
        F.when(lang == "en", "Đang cập nhật").otherwise(F.concat(F.lit("<span>"), issued, F.lit("</span>"))),
        F.lit("</td><td>Số công báo:</td><td>"),
        F.when(lang == "fr", F.concat(F.lit("Số "), F.col("doc_id"))).otherwise("Chưa công bố"),
        F.lit("</td></tr><tr>"),
        *_cell("Tình trạng:", validity),
        F.lit("</tr></table></div><div class='main content1'><nav><p>menu</p></nav><p>"),
        body,
        F.lit("</p><script>x('</div>');</script><aside>ad</aside></div><div>after</div></div></body></html>"),
    )
    return table(spark, d, "documents", heavy=True).select(
        F.lit("law").alias("doc_type"),
        F.col("doc_id").cast("string").alias("doc_key"),
        html.alias("html"),
        F.when(F.col("source") == "src7", 404).otherwise(200).alias("http_status"),
    )


def judgment_pages(spark: SparkSession, d: str) -> DataFrame:
    """Captured judgment pages derived from orders."""

    def item(label: str, value: Column) -> list[Column]:
        return [
            F.lit(f'<li class="list-group-item"><div class="row"><div class="col-xl-3"><b>{label}</b></div>'),
            F.lit('<div class="col-md-9 col-xl-9">'),
            value,
            F.lit("</div></div></li>"),
        ]

    key = F.col("o_orderkey").cast("string")
    customer = F.col("o_custkey").cast("string")
    status = F.col("o_orderstatus")
    keywords = F.concat(
        F.lit("<a href='#'>"), F.col("o_orderpriority"), F.lit("</a>, <a> "), status, F.lit(" &amp; x</a>")
    )
    keyword_item = F.when(status == "P", F.lit("")).otherwise(F.concat(*item("Từ khóa:", keywords)))
    html = F.concat(
        F.lit('<html><body><ul class="list-group"><li><b>Số hiệu:</b></li></ul>'),
        F.lit('<ul class="list-group detail-item">'),
        *item("Tên bản án:", F.concat(F.lit("Bản án <i>"), key, F.lit("</i>\nvề "), F.col("o_orderpriority"))),
        *item("Số hiệu:", F.concat(key, F.lit("/DS"))),
        *item("Cơ quan ban hành:", F.concat(F.lit("<a>Tòa "), customer, F.lit("</a> <a>khác</a>"))),
        *item("Cấp xét xử:", F.when(status == "F", "Phúc thẩm").otherwise("Sơ thẩm")),
        *item("Lĩnh vực:", status),
        *item("Ngày ban hành:", F.date_format("o_orderdate", "d/M/yyyy")),
        keyword_item,
        F.lit('</ul><div id="vanban_content"><header>top</header><div>Quyết định\n  số '),
        key,
        F.lit("</div><form>f</form><p> hết </p></div>"),
        F.lit('<div class="party-info-section"><h4>Nguyên đơn:</h4><ul><li>cũ</li></ul></div>'),
        F.lit('<div class="box party-info-section"><h4>NGUYÊN ĐƠN</h4><ul><li>Bên '),
        customer,
        F.lit("</li><li> B</li></ul></div>"),
        F.lit('<div class="party-info-section"><h4>Bị đơn</h4><ul><li>Bị '),
        key,
        F.lit("</li></ul></div></body></html>"),
    )
    return table(spark, d, "orders", heavy=True).select(
        F.lit("judgment").alias("doc_type"),
        key.alias("doc_key"),
        html.alias("html"),
        F.lit(200).alias("http_status"),
    )
