"""Statute structure queries on documents turned into statutes, and on raw pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.operators import structure as S
from lexloom.plans.corpus_plans import structure_corpus
from lexloom.plans.inputs import STATUTE_SQL, statutes
from lexloom.plans.queries_corpus import _scratch
from lexloom.plans.registry import query, table
from lexloom.sources import layouts
from lexloom.streaming.pages import append_to, article_stream, page_stream, table_stream

def _nodes(spark: SparkSession, d: str) -> DataFrame:
    return S.nodes(statutes(spark, d), "id", S.paragraphs(F.col("content_html")))


def _articles(spark: SparkSession, d: str) -> DataFrame:
    return S.articles(
        statutes(spark, d), "id", "document_number", S.paragraphs(F.col("content_html"))
    )


# Letters as levels: a second rule table for plain prose.
LETTERS = S.RuleTable(
    rules=(
        S.Rule("A", 1, r"^[A-D]", r"^(\w+)"),
        S.Rule("E", 2, r"^[E-L]", r"^(\w+)"),
        S.Rule("M", 3, r"^[M-Z]", r"^(\w+)"),
    ),
    article="E",
)


@query("p1_paragraphs", """
WITH cleaned AS (SELECT page_id, regexp_replace(regexp_replace(regexp_replace(replace(html, chr(13) || chr(10), ' '),
    '(?is)<!--.*?-->', '', 'g'), '(?is)<script\\b[^>]*>.*?</script\\s*>', '', 'g'),
    '(?is)<style\\b[^>]*>.*?</style\\s*>', '', 'g') AS html FROM pages),
pieces AS (SELECT page_id, unnest(string_split_regex(html, '(?i)<p(?:\\s[^>]*)?>')[2:]) AS piece,
    generate_subscripts(string_split_regex(html, '(?i)<p(?:\\s[^>]*)?>')[2:], 1) AS i FROM cleaned),
bodies AS (SELECT page_id, i, CASE WHEN regexp_matches(piece, '(?i)</p\\s*>')
    THEN string_split_regex(piece, '(?i)</p\\s*>')[1]
    ELSE string_split_regex(piece, '(?i)</(?:article|section|main|div|td|th|tr|table|li|ul|ol|blockquote|body|html)\\s*>')[1]
    END AS body FROM pieces),
texts AS (SELECT page_id, i, trim(replace(replace(replace(replace(regexp_replace(body, '<[A-Za-z/!?][^>]*>', '', 'g'),
    '&quot;', '"'), '&copy;', '©'), '&middot;', '·'), '&amp;', '&')) AS content FROM bodies)
SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY i) - 1 AS INTEGER) AS seq, content FROM texts WHERE content <> ''""")
def p1(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "pages", heavy=True)
    return pages.select("page_id", F.posexplode(S.paragraphs(F.col("html"))).alias("seq", "content"))


@query("p1_bare_brackets", """
SELECT doc_id, seq, CASE seq WHEN 0 THEN source || ' < 5 � > ' || lang ELSE '<' || lang || '> [x] &copy1' END AS content
FROM documents, (SELECT CAST(unnest([0, 1]) AS INTEGER) AS seq)""")
def p1_bare(spark: SparkSession, d: str) -> DataFrame:
    """Brackets that open no tag are text; references are decoded after the tags are gone."""
    parts = (F.lit("<p>"), F.col("source"), F.lit(" < 5 &#0; > "), F.col("lang"), F.lit("</p><p class=x><b>&lt;"), F.col("lang"), F.lit("&gt; &lsqb;x&rsqb</b> &copy1</p>"))
    docs = table(spark, d, "documents", heavy=True)
    return docs.select("doc_id", F.posexplode(S.paragraphs(F.concat(*parts))).alias("seq", "content"))


@query("p2_p3_classified_nodes", f"WITH {STATUTE_SQL} SELECT doc_id AS document_id, seq, type, level, number, content FROM typed")
def p2(spark: SparkSession, d: str) -> DataFrame:
    return _nodes(spark, d).select("document_id", "seq", "type", "level", "number", "content")


@query("p3_relaxed_numbers", f"""WITH {STATUTE_SQL}
SELECT doc_id AS document_id, seq, regexp_extract(content, '(?i)Điều[\\s\\p{{Z}}]+(\\d+)', 1) AS number
FROM typed WHERE level = 4""")
def p3(spark: SparkSession, d: str) -> DataFrame:
    relaxed = S.RuleTable(S.STATUTE.rules, article="ĐIỀU", strict_ref=False)
    rows = S.nodes(statutes(spark, d), "id", S.paragraphs(F.col("content_html")), relaxed)
    return rows.filter("type = 'ĐIỀU'").select("document_id", "seq", "number")


@query("p4_nesting", f"WITH {STATUTE_SQL} SELECT doc_id AS document_id, seq, level, list_last(ancestors) AS parent_seq FROM nodes")
def p4(spark: SparkSession, d: str) -> DataFrame:
    return _nodes(spark, d).select("document_id", "seq", "level", "parent_seq")


@query("p4_nesting_letters", """
WITH raw_lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
    generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents),
paras AS (SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS INTEGER) AS seq, trim(line) AS content
  FROM raw_lines WHERE trim(line) <> ''),
levels AS (SELECT *, CASE WHEN regexp_matches(content, '(?i)^[A-D]') THEN 1 WHEN regexp_matches(content, '(?i)^[E-L]') THEN 2
    WHEN regexp_matches(content, '(?i)^[M-Z]') THEN 3 END AS level FROM paras),
lasts AS (SELECT *, last_value(CASE WHEN level = 1 THEN seq END IGNORE NULLS) OVER w AS l1,
    last_value(CASE WHEN level = 2 THEN seq END IGNORE NULLS) OVER w AS l2,
    last_value(CASE WHEN level = 3 THEN seq END IGNORE NULLS) OVER w AS l3 FROM levels
  WINDOW w AS (PARTITION BY doc_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT doc_id AS document_id, seq, level, CASE coalesce(level, 4) WHEN 1 THEN NULL WHEN 2 THEN l1 WHEN 3 THEN greatest(l1, l2)
  ELSE greatest(l1, l2, l3) END AS parent_seq FROM lasts""")
def p4_letters(spark: SparkSession, d: str) -> DataFrame:
    rows = S.nodes(table(spark, d, "documents"), "doc_id", S.line_paragraphs(F.col("text")), LETTERS)
    return rows.select("document_id", "seq", "level", "parent_seq")


_SUBSECTION = "Tiểu mục 3 "  # put before the lines that name article 5, which makes them subsections


@query("p5_seven_levels", f"""WITH {STATUTE_SQL},
seven AS (SELECT doc_id, seq, CASE WHEN content LIKE 'ĐIỀU 5%' THEN 'TIỂU_MỤC' ELSE type END AS type,
    CASE WHEN content LIKE 'ĐIỀU 5%' THEN 4 WHEN level > 3 THEN level + 1 ELSE level END AS depth FROM typed),
lasts AS (SELECT *, {", ".join(f"last_value(CASE WHEN depth = {k} THEN seq END IGNORE NULLS) OVER w AS b{k}" for k in range(1, 8))}
  FROM seven WINDOW w AS (PARTITION BY doc_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT doc_id AS document_id, seq, type, CASE coalesce(depth, 8) WHEN 1 THEN NULL WHEN 2 THEN b1
  {" ".join(f"WHEN {k} THEN greatest({', '.join(f'b{j}' for j in range(1, k))})" for k in range(3, 9))} END AS parent_seq FROM lasts""")
def p5(spark: SparkSession, d: str) -> DataFrame:
    paras = F.transform(
        S.paragraphs(F.col("content_html")), lambda p: F.when(p.startswith("ĐIỀU 5"), F.concat(F.lit(_SUBSECTION), p)).otherwise(p)
    )
    rows = S.nodes(statutes(spark, d), "id", paras, S.STATUTE_WITH_SUBSECTIONS)
    return rows.select("document_id", "seq", "type", "parent_seq")


@query("p6_infer_type", f"""WITH {STATUTE_SQL}
SELECT doc_id AS document_id, seq, CASE WHEN level <= 3 THEN type ELSE 'CONTENT' END AS type FROM typed""")
def p6(spark: SparkSession, d: str) -> DataFrame:
    return _nodes(spark, d).select("document_id", "seq", S.infer_type(F.col("content")).alias("type"))


_ARTICLES = f"""WITH {STATUTE_SQL},
grouped AS (
  SELECT doc_id AS document_id, source AS document_number, art,
    min(CASE WHEN level = 4 THEN number END) AS number, min(CASE WHEN level = 4 THEN content END) AS heading,
    coalesce(string_agg(content, chr(10) ORDER BY seq) FILTER (WHERE level IS NULL OR level > 4), '') AS content,
    coalesce(string_agg(trim(regexp_replace(regexp_replace(content, '[\\s\\p{{Z}}]+', ' ', 'g'),
      '(?i)(điều\\s+\\d+)(\\s)', '[REF:\\1]\\2', 'g')), chr(10) ORDER BY seq)
      FILTER (WHERE level IS NULL OR level > 4), '') AS clean_content,
    count(*) FILTER (WHERE level IS NULL OR level > 4) AS n_paragraphs
  FROM arts WHERE art > 0 GROUP BY 1, 2, 3),
articles AS (
  SELECT document_number || '-ART-' || number AS article_id, *,
    row_number() OVER (PARTITION BY document_id, number ORDER BY art) AS occurrence FROM grouped)"""


@query("p7_p9_articles", f"""{_ARTICLES}
SELECT article_id, document_id, art, number, occurrence, heading, content, clean_content, n_paragraphs FROM articles""")
def p7(spark: SparkSession, d: str) -> DataFrame:
    return _articles(spark, d).select(
        "article_id", "document_id", F.col("art").cast("bigint").alias("art"), "number",
        F.col("occurrence").cast("bigint").alias("occurrence"), "heading", "content", "clean_content",
        F.col("n_paragraphs").cast("bigint").alias("n_paragraphs"),
    )


@query("p10_first_writer", f"""{_ARTICLES}
SELECT article_id, document_id, art FROM articles
WHERE article_id NOT IN (SELECT 'src' || doc_id || '-ART-1' FROM labels)
QUALIFY row_number() OVER (PARTITION BY article_id ORDER BY document_id, art) = 1""")
def p10(spark: SparkSession, d: str) -> DataFrame:
    stored = table(spark, d, "labels").select(
        F.concat(F.lit("src"), F.col("doc_id"), F.lit("-ART-1")).alias("article_id")
    )
    return S.first_writer(_articles(spark, d), stored).select(
        "article_id", "document_id", F.col("art").cast("bigint").alias("art")
    )


@query("p11_structure_corpus", f"""{_ARTICLES}
SELECT document_id, 'article' AS kind, article_id AS detail FROM articles
WHERE document_number <> 'src4' AND document_id IN (SELECT doc_id FROM documents WHERE lang <> 'es')
QUALIFY row_number() OVER (PARTITION BY article_id ORDER BY document_id, art) = 1
UNION ALL
SELECT doc_id, CASE WHEN source = 'src4' THEN 'failed' ELSE 'success' END,
  CASE WHEN source = 'src4' THEN 'document number missing' END FROM documents WHERE lang <> 'es'""")
def p11(spark: SparkSession, d: str) -> DataFrame:
    lang = table(spark, d, "documents").select(F.col("doc_id").alias("id"), "lang")
    docs = statutes(spark, d).join(lang, "id").select(
        "id",
        F.when(F.col("document_number") != "src4", F.col("document_number")).alias("document_number"),
        F.when(F.col("lang") != "es", F.col("content_html")).alias("content_html"),
    )
    done = structure_corpus(docs)
    articles = done.articles.select("document_id", F.lit("article").alias("kind"), F.col("article_id").alias("detail"))
    return articles.unionByName(
        done.outcomes.select("document_id", F.col("status").alias("kind"), F.col("error").alias("detail"))
    )


@query("p11_tracker_rows", f"""{_ARTICLES}
SELECT document_id, article_id, 'success' AS status, 0 AS retry_count, NULL AS error_log FROM articles WHERE document_number <> 'src4'
QUALIFY row_number() OVER (PARTITION BY article_id ORDER BY document_id, art) = 1
UNION ALL
SELECT doc_id, NULL, 'failed', 1, '[2024-01-01 00:00:00] Error processing ' || doc_id || ': document number missing' FROM documents WHERE source = 'src4'
UNION ALL
SELECT doc_id, 'document', CASE WHEN source = 'src4' THEN 'failed' ELSE 'success' END, 0, NULL FROM documents""")
def p11_rows(spark: SparkSession, d: str) -> DataFrame:
    """New tracker rows, and the documents' own rows as marked."""
    docs = statutes(spark, d).select(
        "id", F.when(F.col("document_number") != "src4", F.col("document_number")).alias("document_number"), "content_html"
    )
    waiting = docs.select(
        F.col("id"), F.col("id").alias("document_id"), F.lit("pending").alias("status"), F.lit(0).alias("retry_count"), F.lit(None).cast("timestamp_ntz").alias("finished_at")
    )
    done = structure_corpus(docs, tracker=waiting, at=F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    columns = ["document_id", "article_id", "status", "retry_count", "error_log"]
    own = done.tracker.select("document_id", F.lit("document").alias("article_id"), "status", "retry_count", F.lit(None).cast("string").alias("error_log"))
    return done.new_tracker_rows.select(*columns).unionByName(own)


_LABEL = r"regexp_extract(content, '^[^\s\p{Z}]+[\s\p{Z}]+[^\s\p{Z}.:]+')"


@query("p12_hierarchy", f"""WITH {STATUTE_SQL},
heads AS (SELECT doc_id, seq, {_LABEL} AS label FROM nodes),
steps AS (SELECT doc_id, seq, unnest(ancestors) AS a FROM nodes WHERE level = 4),
paths AS (SELECT s.doc_id, s.seq, string_agg(h.label, '/' ORDER BY s.a) AS path
  FROM steps s JOIN heads h ON h.doc_id = s.doc_id AND h.seq = s.a GROUP BY 1, 2)
SELECT n.doc_id AS document_id, n.seq, coalesce(path || '/', '') AS prefix, label AS article_number,
  CAST(coalesce(len(string_split(path, '/')), 0) AS BIGINT) AS depth
FROM nodes n JOIN heads h ON h.doc_id = n.doc_id AND h.seq = n.seq
LEFT JOIN paths p ON p.doc_id = n.doc_id AND p.seq = n.seq WHERE n.level = 4""")
def p12(spark: SparkSession, d: str) -> DataFrame:
    return _articles(spark, d).select(
        "document_id", "seq", "structural_metadata.prefix", "structural_metadata.article_number",
        F.size("structural_metadata.hierarchy").cast("bigint").alias("depth"),
    )


@query("p12_under_heading", f"""WITH {STATUTE_SQL}
SELECT doc_id AS document_id, seq FROM nodes
WHERE level = 4 AND last3 > greatest(coalesce(last1, -1), coalesce(last2, -1))""")
def p12_under(spark: SparkSession, d: str) -> DataFrame:
    return S.under_heading(_articles(spark, d), "Mục 2").select("document_id", "seq")


@query("p12_index_lookup", f"""WITH {STATUTE_SQL}
SELECT 'Mục 2' AS wanted, doc_id AS document_id, seq FROM nodes
WHERE level = 4 AND last3 > greatest(coalesce(last1, -1), coalesce(last2, -1))
UNION ALL
SELECT 'both', doc_id, seq FROM nodes
WHERE level = 4 AND last3 > greatest(coalesce(last1, -1), coalesce(last2, -1)) AND last2 > coalesce(last1, -1)""")
def p12_index(spark: SparkSession, d: str) -> DataFrame:
    """Articles under one heading, and under two, from an index by label."""
    root = _scratch(spark, "headings")
    layouts.write_headings(_articles(spark, d), root, ["document_id", "seq"])
    label = lambda wanted, name: layouts.under_headings(spark, root, wanted).select(F.lit(name).alias("wanted"), "document_id", "seq")
    return label(["Mục 2"], "Mục 2").union(label(["Mục 2", "Chương II"], "both"))


@query("p13_outline", f"""WITH {STATUTE_SQL}
SELECT doc_id AS document_id, seq, CAST(len(ancestors) AS BIGINT) AS depth,
  repeat('  ', len(ancestors)) || '- **' || type || '**' ||
  CASE WHEN coalesce(number, '') <> '' THEN ' ' || number ELSE '' END || ': ' || content AS line FROM nodes""")
def p13(spark: SparkSession, d: str) -> DataFrame:
    return S.outline(_nodes(spark, d)).withColumn("depth", F.col("depth").cast("bigint"))


@query("p14_references", f"""WITH {STATUTE_SQL},
numbers AS (SELECT doc_id, number AS to_number, min(art) AS to_art FROM arts WHERE level = 4 GROUP BY 1, 2),
own AS (SELECT doc_id, art, min(number) AS from_number FROM arts WHERE level = 4 GROUP BY 1, 2),
hits AS (SELECT doc_id, art, seq, unnest(regexp_extract_all(content, '(?i)điều\\s+(\\d+)\\s', 1)) AS to_number
  FROM arts WHERE art > 0 AND (level IS NULL OR level > 4))
SELECT h.doc_id AS document_id, CAST(h.art AS BIGINT) AS from_art, from_number, h.to_number,
  CAST(to_art AS BIGINT) AS to_art, count(*) AS n_mentions
FROM hits h JOIN own o ON o.doc_id = h.doc_id AND o.art = h.art
LEFT JOIN numbers n ON n.doc_id = h.doc_id AND n.to_number = h.to_number GROUP BY 1, 2, 3, 4, 5""")
def p14(spark: SparkSession, d: str) -> DataFrame:
    edges = S.references(statutes(spark, d), "id", S.paragraphs(F.col("content_html")))
    return edges.groupBy(
        "document_id", F.col("from_art").cast("bigint").alias("from_art"), "from_number", "to_number", "to_art"
    ).agg(F.count("*").alias("n_mentions"))


@query("r1_statute_stream", f"""{_ARTICLES}
SELECT article_id, document_id, art, number, occurrence, heading, content, clean_content, n_paragraphs FROM articles""")
def r1_statutes(spark: SparkSession, d: str) -> DataFrame:
    """Statutes arriving as files, about a quarter of them a micro-batch, every column of their articles."""
    source, root = _scratch(spark, "statutes-in"), _scratch(spark, "statute-stream")
    pages = statutes(spark, d).select("id", "document_number", "content_html")
    pages.write.parquet(source)
    quarter = max(2, -(-pages.rdd.getNumPartitions() // 4))
    docs = page_stream(spark, source, "id BIGINT, document_number STRING, content_html STRING", files_per_batch=quarter)
    append_to(article_stream(docs, "id", "document_number", "content_html"), root, f"{root}-checkpoint").awaitTermination()
    return spark.read.parquet(root).select(
        "article_id", "document_id", F.col("art").cast("bigint").alias("art"), "number",
        F.col("occurrence").cast("bigint").alias("occurrence"), "heading", "content", "clean_content",
        F.col("n_paragraphs").cast("bigint").alias("n_paragraphs"),
    )


@query("r1_article_stream", """
WITH t AS (SELECT doc_id, len([x FOR x IN string_split(text, chr(10)) IF trim(x) <> '']) AS n FROM documents)
SELECT doc_id AS document_id, n AS art FROM t WHERE n > 0""")
def r1(spark: SparkSession, d: str) -> DataFrame:
    """Documents through a file stream; every line is an article heading here."""
    root = _scratch(spark, "article-stream")
    docs = table_stream(spark, d, "documents", "doc_id BIGINT, text STRING, source STRING")
    lines = F.transform(
        F.split("text", "\n"),
        lambda x, i: F.when(F.trim(x) != "", F.concat(F.lit("<p>Điều "), i + 1, F.lit(". "), F.replace(x, F.lit("&"), F.lit("&amp;")), F.lit("</p>"))).otherwise(""),
    )
    html = docs.withColumn("html", F.array_join(lines, ""))
    append_to(
        article_stream(html, "doc_id", "source", "html"), root, f"{root}-checkpoint"
    ).awaitTermination()
    return spark.read.parquet(root).groupBy("document_id").agg(F.max("art").cast("bigint").alias("art"))
