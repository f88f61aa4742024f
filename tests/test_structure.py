import random
import re

from pyspark.sql import functions as F

from lexloom.operators import structure as S
from lexloom.plans.corpus_plans import structure_corpus

GOLDEN = [
    "Căn cứ Hiến pháp", "CHƯƠNG I", "Quy định chung", "Điều 1. Phạm vi",
    "1. Văn bản này theo điều 5 và Điều 7,", "a) Cá nhân", "đ) Tổ chức", "Chương II",
    "Tổ chức thực hiện", "Điều 2. Hiệu lực",
]


def docs(spark, *texts):
    return spark.createDataFrame(
        [(i, f"N{i}", list(t)) for i, t in enumerate(texts)], "id BIGINT, document_number STRING, paras ARRAY<STRING>"
    )


def node_rows(spark, *texts, rules=S.STATUTE):
    rows = S.nodes(docs(spark, *texts), "id", F.col("paras"), rules).collect()
    return sorted(rows, key=lambda r: (r.document_id, r.seq))


def test_golden_nodes(spark):
    got = [(r.type, r.number, r.parent_seq) for r in node_rows(spark, GOLDEN)]
    assert got == [
        ("CONTENT", None, None), ("CHƯƠNG", "", None), ("CONTENT", None, 1), ("ĐIỀU", "1", 1),
        ("KHOẢN", "1", 3), ("ĐIỂM", "a", 4), ("CONTENT", None, 5), ("CHƯƠNG", "II", None),
        ("CONTENT", None, 7), ("ĐIỀU", "2", 7),
    ]
    assert node_rows(spark, GOLDEN)[4].ancestors == [1, 3]


def test_classification_edge_cases(spark):
    texts = ["ĐIỀU 5", "1.5 tỷ đồng", "Mục I", "Phần mềm dùng chung", "Chương cuối", "ĐIỀU 5 sửa Điều 7", "z) x", "Mục 3"]
    got = [(r.type, r.number) for r in node_rows(spark, texts)]
    assert got == [
        ("ĐIỀU", ""), ("KHOẢN", "1"), ("CONTENT", None), ("PHẦN", ""), ("CHƯƠNG", ""),
        ("ĐIỀU", "7"), ("ĐIỂM", "z"), ("MỤC", "3"),
    ]


def test_golden_articles(spark):
    rows = S.articles(docs(spark, GOLDEN, [], ["no article"]), "id", "document_number", F.col("paras")).collect()
    rows = sorted(rows, key=lambda r: r.art)
    assert [(r.article_id, r.heading) for r in rows] == [
        ("N0-ART-1", "Điều 1. Phạm vi"), ("N0-ART-2", "Điều 2. Hiệu lực"),
    ]
    assert rows[0].content.split("\n") == [GOLDEN[4], GOLDEN[5], GOLDEN[6], GOLDEN[8]]
    assert rows[0].clean_content.split("\n")[0] == "1. Văn bản này theo [REF:điều 5] và Điều 7,"
    assert rows[1].content == "" and rows[1].n_paragraphs == 0
    assert rows[0].structural_metadata.asDict() == {
        "hierarchy": ["CHƯƠNG I"], "prefix": "CHƯƠNG I/", "article_number": "Điều 1",
    }


def test_repeated_article_numbers_and_first_writer(spark):
    df = docs(spark, ["Điều 1", "a", "Điều 1", "b", "Điều 2"])
    rows = S.articles(df, "id", "document_number", F.col("paras"))
    got = sorted((r.art, r.article_id, r.occurrence) for r in rows.collect())
    assert got == [(1, "N0-ART-1", 1), (2, "N0-ART-1", 2), (3, "N0-ART-2", 1)]
    stored = spark.createDataFrame([("N0-ART-2",)], "article_id STRING")
    assert [(r.article_id, r.art) for r in S.first_writer(rows, stored).collect()] == [("N0-ART-1", 1)]


def test_paragraphs(spark):
    html = (
        "<html><script>var x='<p>no</p>'</script><pre>no</pre><p> a\r\nb <b>c</b>&amp;</p>between"
        "<P class='x'>open<p>next</p><p> </p><!-- <p>no</p> --><div><p>last <i>x</i></div>footer"
    )
    df = spark.createDataFrame([(html,), (None,)], "h STRING").select(S.paragraphs(F.col("h")).alias("p"))
    assert [r.p for r in df.collect()] == [["a b c&", "open", "next", "last x"], None]


def test_references(spark):
    texts = ["Điều 1", "theo điều 2 và Điều 9 hay điều 1, hết", "theo điều 3", "Điều 2", "xem điều 1 nhé"]
    rows = S.references(docs(spark, texts), "id", F.col("paras")).collect()
    got = sorted((r.from_art, r.paragraph, r.nth, r.to_number, r.to_art) for r in rows)
    assert got == [(1, 1, 1, "2", 2), (1, 1, 2, "9", None), (2, 1, 1, "1", 1)]


def test_infer_type_and_outline(spark):
    df = spark.createDataFrame([("Chương I",), ("Điều 1",), ("x",)], "t STRING")
    assert [r[0] for r in df.select(S.infer_type(F.col("t"))).collect()] == ["CHƯƠNG", "CONTENT", "CONTENT"]
    rows = S.outline(S.nodes(docs(spark, GOLDEN), "id", F.col("paras"))).collect()
    lines = {r.seq: r.line for r in rows}
    assert lines[3] == "  - **ĐIỀU** 1: Điều 1. Phạm vi"
    assert lines[5] == "      - **ĐIỂM** a: a) Cá nhân"


def test_subsection_level(spark):
    texts = ["Mục 1", "Tiểu mục 2", "Điều 1", "Tiểu mục 3", "Điều 2"]
    got = [(r.type, r.parent_seq) for r in node_rows(spark, texts, rules=S.STATUTE_WITH_SUBSECTIONS)]
    assert got == [("MỤC", None), ("TIỂU_MỤC", 0), ("ĐIỀU", 1), ("TIỂU_MỤC", 0), ("ĐIỀU", 3)]


def stack_model(texts):
    """Plain stack: parents, and articles as (heading, contents)."""
    pats = [r"PHẦN\s+[A-Z]+", r"Chương\s+[IVXLCDM]+", r"Mục\s+\d+", r"Điều\s+\d+[\.:]?", r"\d+\.", r"[a-z]\)"]
    parents, stack, arts = [], [], []
    for i, t in enumerate(texts):
        level = next((k for k, p in enumerate(pats, 1) if re.match(p, t, re.IGNORECASE)), None)
        if level is None:
            parents.append(stack[-1][0] if stack else None)
        else:
            while stack and stack[-1][1] >= level:
                stack.pop()
            parents.append(stack[-1][0] if stack else None)
            stack.append((i, level))
        if level == 4:
            arts.append((t, []))
        elif arts and (level is None or level > 4):
            arts[-1][1].append(t)
    return parents, arts


def test_nesting_and_segmentation_match_stack_model(spark):
    rng = random.Random(7)
    kinds = ["PHẦN A", "Chương I", "Mục 1", "Điều 3", "1. x", "a) x", "text", "đ) y"]
    texts = [[rng.choice(kinds) for _ in range(rng.randrange(0, 40))] for _ in range(400)]
    df = docs(spark, *texts)
    parents = {}
    for r in S.nodes(df, "id", F.col("paras")).select("document_id", "seq", "parent_seq").collect():
        parents[(r.document_id, r.seq)] = r.parent_seq
    arts = {}
    for r in S.articles(df, "id", "document_number", F.col("paras")).collect():
        arts[(r.document_id, r.art)] = (r.heading, r.content)
    expected_arts = {}
    for i, t in enumerate(texts):
        want, found = stack_model(t)
        assert [parents[(i, s)] for s in range(len(t))] == want
        expected_arts.update({(i, n): (h, "\n".join(c)) for n, (h, c) in enumerate(found, 1)})
    assert arts == expected_arts


def test_structure_corpus_outcomes(spark):
    rows = [(1, "A", "<p>Điều 1</p><p>x</p>"), (2, None, "<p>Điều 1</p>"), (3, "C", None), (4, "A", "<p>Điều 1</p>")]
    df = spark.createDataFrame(rows, "id BIGINT, document_number STRING, content_html STRING")
    done = structure_corpus(df)
    assert [(r.article_id, r.document_id) for r in done.articles.collect()] == [("A-ART-1", 1)]
    assert {(r.document_id, r.status) for r in done.outcomes.collect()} == {(1, "success"), (2, "failed"), (4, "success")}


def test_structure_needs_no_exchange(spark):
    df = spark.createDataFrame([(1, "A", "<p>x</p>")], "id BIGINT, n STRING, h STRING")
    for rows in (S.articles(df, "id", "n", S.paragraphs(F.col("h"))), S.nodes(df, "id", S.paragraphs(F.col("h")))):
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Sort" not in plan and "Python" not in plan


def test_bare_brackets_and_unclosed_scripts(spark):
    pages = {
        "<p>nếu x <5 và y> 3 <b>đ</b></p>": ["nếu x <5 và y> 3 đ"],
        "<p>one</p><script>var a='<p>1</p>';<p>two</p>": ["one"],
        "<p>one</p><!-- <p>two</p>": ["one"],
    }
    df = spark.createDataFrame([(k,) for k in pages], "html STRING")
    got = {r.html: r.p for r in df.select("html", S.paragraphs(F.col("html")).alias("p")).collect()}
    assert got == pages
