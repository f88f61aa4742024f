import html
import re
from datetime import date
from html.entities import html5

import pytest
from pyspark.sql import functions as F

from lexloom.functions import text as T
from lexloom.functions.arrays import occurrence_numbers, spread_starts


def one(spark, value, fn):
    return spark.createDataFrame([(value,)], "c STRING").select(fn(F.col("c")).alias("r")).first().r


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("21/01/2025", date(2025, 1, 21)),
        ("2025-01-21", date(2025, 1, 21)),
        ("21 01 2025", date(2025, 1, 21)),
        ("21-01-2025", date(2025, 1, 21)),
        ("21/01/25", date(2025, 1, 21)),
        ("2025/01/21", date(2025, 1, 21)),
        ("1/2/2020", date(2020, 2, 1)),
        ("1/2/99", date(1999, 2, 1)),
        ("31/02/2020", None),
        ("Đã biết", None),
        ("", None),
    ],
)
def test_flexible_date(spark, raw, expected):
    assert one(spark, raw, T.flexible_date) == expected


def test_first_slash_date(spark):
    rows = [("Từ ngày 01/03/2025 trở đi",), ("Liên hệ",), ("31/02/2020",)]
    found, bad = T.first_slash_date(F.col("c"))
    got = spark.createDataFrame(rows, "c STRING").select(found.alias("d"), bad.alias("bad")).collect()
    assert [(r.d, r.bad) for r in got] == [(date(2025, 3, 1), False), (None, False), (None, True)]


@pytest.mark.parametrize(
    "label, code",
    [("Còn hiệu lực", "valid"), ("HẾT HIỆU LỰC", "expired"), ("Đã biết", "unknown"), ("", "unknown"), (None, "unknown")],
)
def test_status(spark, label, code):
    assert one(spark, label, T.status_code) == code


def test_unicode_white_space(spark):
    raw = " 　\x1f a  b \x85"
    assert one(spark, raw, T.strip) == raw.strip()
    assert one(spark, raw, T.collapse) == " ".join(raw.split())


def test_strip_matches_python_on_every_white_space_character(spark):
    spaces = [chr(c) for c in range(0x3100) if chr(c).isspace()]
    rows = [(c + "x" + c,) for c in spaces]
    got = spark.createDataFrame(rows, "c STRING").select(T.strip(F.col("c")).alias("r")).collect()
    assert {r.r for r in got} == {"x"}


def test_unescape(spark):
    assert one(spark, "a &amp;&amp; &#224; &#xE0;&nbsp;x &bogus; &", T.unescape) == "a && à à x &bogus; &"
    assert one(spark, "&apos;&lsqb;&lsqb &#150; &#x96;&#00000065;&#x0000041;&#1114112; &#129;&NewLine;.", T.unescape) == "'[[ – –AA\ufffd \x81\n."
    assert one(spark, "&amp;lt;", T.unescape) == "&lt;"
    assert one(spark, "&copy2024 &notit; &lsqb &copy; &not;it", T.unescape) == "&copy2024 &notit; [ © ¬it"


NUMBERS = ["&#0;", "&#000", "&#x0;", "&#X0", "&#xD800;", "&#57343;", "&#1114109;", "&#1114112;", "&#x110000;", "&#" + "9" * 40 + ";", "&#x" + "f" * 40, "&#x;", "&#;", "&#", "&#10;", "&#x80;", "&#128;"]


@pytest.mark.parametrize("decode", (T.unescape, T.decode_attribute))
def test_numbers_never_fail(spark, decode):
    got = spark.createDataFrame([(n,) for n in NUMBERS], "c STRING").select(decode(F.col("c")).alias("r")).collect()
    assert [r.r for r in got] == [html.unescape(n) for n in NUMBERS]


def test_attributes_of_every_name(spark):
    """Closed names as the library reads them; open ones only where the standard's rule for attributes does."""
    closed = [f"/x?a=1&{n.rstrip(';')};b" for n in sorted(html5)]
    opened = [f"/x?id=1&{n.rstrip(';')}{after}" for n in sorted(html5) for after in ("=vi", "x9", "/")]
    got = spark.createDataFrame([(v,) for v in closed + opened], "c STRING").repartition(8).select("c", T.decode_attribute(F.col("c")).alias("r"))
    got = {r.c: r.r for r in got.collect()}
    assert [got[v] for v in closed] == [html.unescape(v) for v in closed]
    for v in opened:
        name = re.match("[A-Za-z0-9]+", v.split("&")[1])[0]
        assert got[v] == (html.unescape(v) if name in html5 and not v.split("&")[1].startswith(f"{name}=") else v)
    assert one(spark, None, T.unescape) is None


def test_preview_and_percent(spark):
    assert one(spark, "abcdef", lambda c: T.preview(c, 3)) == "abc…"
    row = spark.range(1).select(
        T.percent(F.lit(1), F.lit(3)).alias("a"), T.percent(F.lit(1), F.lit(0)).alias("b")
    ).first()
    assert (row.a, row.b) == (33.33, None)


def test_spread_starts_and_occurrences(spark):
    row = spark.range(1).select(
        spread_starts(F.array(F.lit(1), F.lit(3)), F.lit(5)).alias("s"),
        spread_starts(F.array().cast("array<int>"), F.lit(2)).alias("e"),
        occurrence_numbers(F.array(*[F.lit(x) for x in "abacba"])).alias("o"),
    ).first()
    assert row.s == [None, 1, 1, 3, 3]
    assert row.e == [None, None]
    assert row.o == [1, 1, 2, 1, 2, 3]


def test_strip_at_every_kind_of_end(spark):
    ends = ["", *T.WS_CHARS, "a", "\u0084", "\u0086", "​", "‧", "、", "Đ", "😀", "  \t"]
    rows = [(a + m + b, m) for a in ends for b in ends for m in ("", "x y", "é é")]
    got = spark.createDataFrame(rows, "c STRING, m STRING").select("c", T.strip(F.col("c")).alias("r"), T.collapse(F.col("c")).alias("k")).collect()
    assert all(r.r == r.c.strip(T.WS_CHARS) for r in got)
    assert all(r.k == " ".join(w for w in re.split(f"[{T.WS_CHARS}]+", r.c) if w) for r in got)
    assert spark.range(1).select(T.strip(F.lit(None).cast("string")).alias("r")).first().r is None
