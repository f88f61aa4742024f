import time
from datetime import date

from pyspark.sql import functions as F

from lexloom.functions import html as H
from lexloom.functions.arrays import let
from lexloom.operators import discovery as D
from lexloom.operators import extraction as X

LAW = """<html><!-- <div id="divThuocTinh">no</div> -->
<script>var x='<div id="divThuocTinh">';</script><table><tr><td><b>Số hiệu:</b></td><td>outside</td></tr></table>
<div id='divThuocTinh' class="att"><table>
<tr><td><b> Số hiệu: </b></td><td> 12/QĐ <span>drop <span>deep</span> more</span> -UBND</td>
    <td><b>Loại văn bản:</b></td><td>Quyết
   định</td></tr>
<tr><td><b>Nơi ban hành:</b></td><td><div>x<div>y</div>z</div>Bộ &amp; A<a>link</a></td>
    <td><b>Người ký:</b></td><td>Đang cập nhật</td></tr>
<tr><td><b>Ngày ban hành:</b></td><td>1/2/2020</td><td><b>Ngày hiệu lực:</b></td><td>{effective}</td></tr>
<tr><td>Ngày công báo:</td><td><b>21/01/2025</b></td><td>Số công báo:</td><td>Chưa công bố</td></tr>
<tr><td><b>Tình trạng:</b></td><td>{status}</td></tr></table></div>
<div class="a content1 b"><div>in<script>var x='</div>';</script></div><p>Điều 1.  x<br>y</p><nav>n</nav></div>
<div>out</div></html>"""

JUDGMENT = """<ul class="list-group"><li><b>Số hiệu:</b><div class="row"><div class="col-xl-9">no</div></div></li></ul>
<ul class="list-group detail-item">
<li><div class="row"><div class="col-xl-3"><b>Tên bản án:</b></div><div class="col-xl-9">Bản án <i>1</i>
x</div></div></li>
<li><div class="row"><div class="col-xl-3"><b>Cơ quan ban hành:</b></div><div class="col-xl-9"><a href=1>Tòa A</a><a>B</a></div></div></li>
{keywords}
<li><div class="row"><b>Ngày ban hành:</b><div class="col-xl-9"> 05/06/2021 </div></div></li></ul>
<div id="vanban_content"><header>h</header><p>A
 B</p>C</div>
<div class="party-info-section"><h4>Nguyên đơn</h4><ul><li>N1</li></ul></div>
<div class="party-info-section"><h4>NGUYÊN ĐƠN</h4><ul><li>N2</li><li>N3</li></ul></div>
<div class="party-info-section"><h4>Bị đơn</h4><ul><li>D</li></ul></div>"""
KEYWORDS = """<li><div class="row"><div><b>Từ khóa:</b></div><div class="col-md-2 col-xl-9"><a>k1</a>, <a>k2</a></div></div></li>"""


def law(spark, **kw):
    values = {"effective": "Từ 01/03/2025", "status": "Còn hiệu lực", **kw}
    rows = [("1", LAW.format(**values), 200), ("2", "gone", 404), ("3", "<p>no sections</p>", 200)]
    df = spark.createDataFrame(rows, "doc_key STRING, html STRING, http_status INT")
    return {r.doc_key: r for r in X.law_records(df).collect()}


def test_law_record(spark):
    rows = law(spark)
    r = rows["1"]
    assert r.document_number == "12/QĐ -UBND"
    assert r.document_type == "Quyết định"
    assert r.issuing_authority == "Bộ & A"
    assert r.signer == ""
    assert (r.issue_date, r.effective_date) == (date(2020, 2, 1), date(2025, 3, 1))
    assert (r.gazette_date, r.gazette_number) == ("21/01/2025", "")
    assert r.status == "valid"
    assert r.content_text == "in\n\nĐiều 1. x\n\ny"
    assert r.metadata_html.startswith("<div id='divThuocTinh'") and r.metadata_html.endswith("</table></div>")
    assert r.content_html.startswith('<div class="a content1 b">') and "</nav></div>" in r.content_html
    assert r.error is None
    assert rows["2"].error == "HTTP status 404"
    empty = rows["3"]
    assert (empty.document_number, empty.content_html, empty.content_text) == ("", None, "")
    assert (empty.status, empty.issue_date, empty.error) == ("unknown", None, None)


def test_law_special_values(spark):
    assert law(spark, effective="Đã biết")["1"].effective_date is None
    assert law(spark, effective="Liên hệ")["1"].error is None
    assert "31/02/2020" in law(spark, effective="31/02/2020")["1"].error
    # The placeholder is blanked before it could be mapped.
    assert law(spark, status="Đang cập nhật")["1"].status == "unknown"
    assert law(spark, status="Hết hiệu lực")["1"].status == "expired"


def test_value_cell_with_nested_table(spark):
    html = """<div id="divThuocTinh"><table><tr><td><b>Số hiệu:</b></td>
      <td>a<table><tr><td>in</td><td>ner</td></tr></table>z</td></tr>
      <tr><td><b>Người ký:</b></td></tr><tr><td>next row</td></tr></table></div>"""
    df = spark.createDataFrame([("1", html, 200)], "doc_key STRING, html STRING, http_status INT")
    r = X.law_records(df).first()
    assert r.document_number == "a in ner z"
    assert r.signer == ""


def test_judgment_record(spark):
    rows = [("1", JUDGMENT.format(keywords=KEYWORDS), 200), ("2", JUDGMENT.format(keywords=""), 200), ("3", "", 200)]
    df = spark.createDataFrame(rows, "doc_key STRING, html STRING, http_status INT")
    got = {r.doc_key: r for r in X.judgment_records(df).collect()}
    r = got["1"]
    assert (r.case_name, r.case_number, r.issuing_authority) == ("Bản án 1 x", "", "Tòa A")
    assert r.judgment_date == date(2021, 6, 5)
    assert r.keywords == ["k1", "k2"]
    assert r.content_text == "A\nB C"
    assert r.related_parties.asDict() == {"nguyen_don": ["N2", "N3"], "bi_don": ["D"], "ben_lien_quan": []}
    assert r.missing_labels == []
    assert got["2"].keywords == [] and got["2"].missing_labels == ["Từ khóa:"]
    assert got["3"].missing_labels == [] and got["3"].metadata_html is None


def test_elements_with_unbalanced_markup(spark):
    html = "</a>x<div><a>1<a>n</a></a></a><A>2</A><div>y</div></div></div>tail<div class='x'>open"
    df = spark.createDataFrame([(html,)], "h STRING").withColumn("t", H.tokens(F.col("h")))
    r = df.select(
        F.transform(H.all_elements(F.col("t"), H.opener("a"), "a"), lambda e: H.text_of(e, "|")).alias("a"),
        H.html_of(H.first_element(F.col("t"), H.opener("div"), "div")).alias("d"),
        H.text_of(H.drop_elements(F.col("t"), ["a", "div"]), "|").alias("left"),
        H.html_of(H.first_element(F.col("t"), H.opener("div", "class", "x"), "div")).alias("open"),
    ).first()
    assert r.a == ["1|n", "2"]
    assert r.d == "<div><a>1<a>n</a></a></a><A>2</A><div>y</div></div>"
    assert r.left == "x|tail"
    assert r.open == "<div class='x'>open"


def test_opener_matches_whole_words_only(spark):
    cases = {
        '<div class="content1">': True, "<div class='a content1'>": True, "<div class=content1>": True,
        '<div class="content10">': False, '<div class="x-content1">': False, "<divx class=content1>": False,
        '<div data-class="content1">': False, '<DIV CLASS="content1 z">': True,
    }
    df = spark.createDataFrame([(k,) for k in cases], "t STRING")
    got = {r.t: r.m for r in df.select("t", F.col("t").rlike(H.opener("div", "class", "content1")).alias("m")).collect()}
    assert got == cases


def test_search_page_ids(spark):
    html = """<p class="nqTitle" lawid=" 101 ">a</p><p class="nqTitle" lawid="101"></p>
    <p class="nqTitle" lawid=""></p><p lawid="9"></p><p class="nqTitleX" lawid="8"></p>
    <a class="h5 font-weight-bold" href="/ban-an/so-1-2-777/x">t</a><a class="h5 font-weight-bold" href="/tin/1-5">t</a>
    <a class="h5" href="/ban-an/z-6">t</a>"""
    r = spark.createDataFrame([(html,)], "h STRING").select(
        D.law_ids(F.col("h")).alias("law"), D.judgment_ids(F.col("h")).alias("judgment")
    ).first()
    assert (r.law, r.judgment) == (["101"], ["777"])


def test_write_defaults_and_duplicates(spark):
    rows = [(1, "A", None, "21/01/2025", None), (2, "A", "valid", "bad", "n")]
    df = spark.createDataFrame(rows, "id INT, document_number STRING, status STRING, gazette_date STRING, gazette_number STRING")
    got = {r.id: r for r in X.with_write_defaults(df).collect()}
    assert (got[1].status, got[1].gazette_date, got[1].gazette_number) == ("unknown", date(2025, 1, 21), "")
    assert got[2].gazette_date is None
    assert X.resolve_duplicates(df, "document_number", ["id"]).count() == 2
    assert [r.id for r in X.resolve_duplicates(df, "document_number", ["id"], "keep_latest").collect()] == [2]


def test_elements_cost_linear_time(spark):
    """Twice the links take about twice the time (an array copied at each of them would take four times)."""

    def seconds(n):
        df = spark.createDataFrame([("<ul>" + "<li><a href='x'>t</a></li>" * n + "</ul>",)] * 4, "html STRING").coalesce(1)
        start = time.perf_counter()
        assert df.select(F.sum(F.size(X.link_texts(H.tokens(F.col("html")))))).first()[0] == 4 * n
        return time.perf_counter() - start

    seconds(10_000)
    assert min(seconds(40_000) for _ in range(2)) < 3 * min(seconds(20_000) for _ in range(2)) + 0.5


def _plan(df):
    df.sparkSession.conf.set("spark.sql.maxPlanStringLength", "10000000")
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_usable_records_are_extracted_once(spark):
    """A filter on the error stays above the extraction, whose tokens would else be cut for it and for the record."""
    df = spark.createDataFrame([("1", LAW.format(effective="31/02/2020", status=""), 200)], "doc_key STRING, html STRING, http_status INT")
    usable = X.law_records(df).filter("error IS NULL")
    assert _plan(usable).count("regexp_extract_all(") == 1
    assert usable.count() == 0


def test_attribute_values_take_one_search_a_tag(spark):
    """Whatever stands around the value: either quote, the other quote inside, nothing, or nothing at all."""
    html = """<p class="nqTitle" lawid="a'b'">x</p><p class=nqTitle lawid='"c"'><p class="nqTitle" lawid=d><p class="nqTitle" lawid=""><p class='nqTitle' lawid='&amp;e'>"""
    df = spark.createDataFrame([(html,)], "h STRING").select(D.law_ids(F.col("h")).alias("law"), D.judgment_ids(F.col("h")).alias("judgment"))
    assert tuple(df.first()) == (["a'b'", '"c"', "d", "&e"], [])
    assert _plan(df).count("lawid") == 1


def test_binding_copies_nothing(spark):
    """A fold over nothing: its end result is taken as it is, where transform copies every element."""
    df = spark.range(1).select(let(F.sequence(F.lit(1), F.lit(3)), lambda a: F.concat(a, a)).alias("v"))
    assert df.first().v == [1, 2, 3, 1, 2, 3]
    assert "transform(" not in df._jdf.queryExecution().analyzed().toString()


def test_pairs_read_off_are_the_elements_folded(spark):
    """Pages whose tags close at once, and the same ones with something nested behind, which are folded."""
    row = "<tr><td><b> L{0}: </b></td><td>v{0} <span>x</span></td></tr>"
    flat = "<div>" + "".join(row.format(i) for i in range(3)) + "<tr><td>G:</td><td><i>g</i></td></tr>{}</div>"
    tails = ["", "</td>", "<td>", "<td><b>L9:</b><table><tr><td>n</td></tr></table></td><td>w</td>", "<tr><td>e</tr>", "<b>open"]
    pages = [(i, flat.format(t)) for i, t in enumerate(tails)]
    toks = H.tokens(F.col("html"))
    df = spark.createDataFrame(pages, "i INT, html STRING").withColumn("t", toks)
    fields = X.table_fields(F.col("t"), ["L0:", "L2:", "L9:"], ["G:"])
    got = {r.i: r for r in df.select("i", fields.alias("f"), X.link_texts(F.col("t")).alias("a"), F.transform(H.all_elements(F.col("t"), H.opener("b"), "b"), H.html_of).alias("b")).collect()}
    bold = [(True, "L0:", "v0"), (True, "L1:", None), (True, "L2:", "v2")]
    cell = [(False, "G:", "g"), (False, "g", None)]
    for i, r in got.items():
        named = [tuple(f) for f in r.f if f.label in ("L0:", "L1:", "L2:", "L9:", "G:", "g")]
        assert [f for f in named if f[0]] == bold + ([(True, "L9:", "w")] if i == 3 else [])
        assert [f for f in named if not f[0] and f[1] in ("G:", "g")] == cell
        closed = [f"<b> L{n}: </b>" for n in range(3)]
        assert r.b == closed + {3: ["<b>L9:</b>"], 5: ["<b>open</div>"]}.get(i, [])


def test_statute_text_decoded_at_once(spark):
    """Runs that end or begin with parts of a reference stay apart; white space of any kind, line breaks within runs."""
    runs = ["a &am", "p; b", "x&amp", "; y&#10;z", "  \t q　 r \x1f", "\x1c  ", "&#x2028;e&nbsp;", "  f  g\r"]
    html = "<div class='content1'>" + "<i></i>".join(runs) + "<aside>n</aside>\nh</div>"
    got = spark.createDataFrame([(html,)], "h STRING").select(X.law_text(X.section(H.tokens(F.col("h")), X.LAW_CONTENT)).alias("t"), H.lines_of(F.array().cast("array<struct<tag:string,raw:string>>")).alias("e")).first()
    assert got.t.split("\n\n") == ["a &am", "p; b", "x&", "; y", "z", "q r", "e", "f g", "h"] and got.e == ""


def test_markup_gives_the_elements_of_tokens(spark):
    """Nested (deeper than a pattern follows), unclosed, stray, hidden and odd tags: cut as markup or from tokens."""
    deep = "<div>" * 9 + "in" + "</div>" * 9
    pages = [
        "a<!-- <div class='x'>c</div> --><div class='x'>1<b>2</b>&amp;<div>3</div> 4</div>t<div class=x>5</div>",
        f"<p>{deep}<div class='x'>{deep}x</div></p>{deep}", "<div class='x'>open<div>y</div><nav>n<nav>m</nav>", "</div>x", "",
        "<div title='a>b' class='x'>1 < 2 <1</div><!><DIV CLASS='x'>s<script>'<div class=\"x\">'</script>t</DIV>",
        "<div-x class='x'>no</div-x><div class='x y' <div class='z x'>p</!q>r<nav>" + "<nav>" * 5 + "d" + "</nav>" * 6 + "e</div>",
        f"<div class='x'>{deep}<style>s</style><!DOCTYPE z>f</div>" * 3,
    ]
    df = spark.createDataFrame(list(enumerate(pages)) + [(99, None)], "i INT, h STRING")
    toks, page = H.tokens(F.col("h")), H.markup(F.col("h"))
    for tag, opening in (("div", H.opener("div", "class", "x")), ("div", H.opener("div")), ("b", H.opener("b")), ("nav", H.opener("nav"))):
        first, part = H.first_element(toks, opening, tag), H.part(page, opening, tag)
        r = df.select(
            H.html_of(first), H.text_of(first, "|"), F.transform(H.all_elements(toks, opening, tag), lambda e: H.text_of(e, "|")),
            H.source_of(part, page, F.col("h")), H.text_in(part, "|"), F.transform(H.parts(page, opening, tag), lambda e: H.text_in(e, "|")),
        ).collect()
        assert [tuple(x[:3]) for x in r] == [tuple(x[3:]) for x in r]
    dropped = df.select(H.text_of(H.drop_elements(toks, ["nav", "style", "div"]), "|"), H.text_in(H.without(page, ["nav", "style", "div"]), "|")).collect()
    assert [x[0] for x in dropped] == [x[1] for x in dropped]


def test_judgment_items_of_other_forms(spark):
    """Items that are no row with a label and one plain box: boxes in one another, two labels, tags in the label, no row."""
    def page(*items):
        return ("1", '<ul class="list-group detail-item">' + "".join(f"<li>{i}</li>" for i in items) + "</ul>", 200)

    usual = '<div class="row"><div class="c"><b>{0}</b></div><div class="col-xl-9">{1}</div></div>'
    html = page(
        usual.format("Số hiệu:", "<p>7</p>/<div>8<div class='col-xl-9'>9</div></div>"),
        '<div class="row"><div class="c"><b>Ngày</b><b>Cấp xét xử:</b></div></div><div class="col-xl-9">out</div>',
        '<div class="row"><b>Lĩnh <i>vực</i>:</b><div class="row col-xl-9">D&acirc;n sự</div></div>',
        '<b>Từ khóa:</b><div class="col-xl-9"><a>k<a>1</a></a>, <a>k2</div>',
        usual.format("C&#417; quan ban hành:", "none") + "<a>Tòa</a>",
        usual.format("Tên bản án:", "\n &lt;A&gt; <i>b</i>\n"),
    )
    r = X.judgment_records(spark.createDataFrame([html], "doc_key STRING, html STRING, http_status INT")).first()
    assert (r.case_number, r.trial_level, r.field, r.case_name) == ("7 / 8 9", "", "Dân sự", "<A> b")
    assert (r.keywords, r.issuing_authority, r.missing_labels) == (["k1", "k2"], "Tòa", [])
    assert r.metadata_html == html[1]


def test_judgment_pages_are_cut_as_markup(spark):
    """No array of all tokens of a page is made, which lambdas would visit for every section, item and label."""
    pages = spark.createDataFrame([("1", JUDGMENT.format(keywords=KEYWORDS), 200)], "doc_key STRING, html STRING, http_status INT")
    plan = _plan(X.judgment_records(pages))
    assert "_page" in plan and "_toks" not in plan
    item = F.lit('<LI class="i"><div class="a row"><div><b>L:</b></div><div class=col-xl-9>v <i>w</i></div></div></LI>')
    row, box = H.opener("div", "class", "row"), H.opener("div", "class", "col-xl-9")
    assert spark.range(1).select(H.label_and_box(item, row, box)).first()[0] == "L:<v <i>w</i>"
