"""Captured pages to typed records.

Each page is tokenised once; sections, labelled values, links and text are folds
over that token array (``lexloom.functions.html``). Judgments, whose pages are cut
into many small elements, are cut as markup instead. A record is a projection of
its page row: no shuffle, and the same code runs on a stream of pages.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexloom.functions import html as H
from lexloom.functions import text as T
from lexloom.functions.arrays import fold_emitting, let

# Labels and anchors of the source pages.
LAW_METADATA = ("div", H.opener("div", "id", "divThuocTinh", exact=True))
LAW_CONTENT = ("div", H.opener("div", "class", "content1"))
LAW_LABELS = {
    "document_number": "Số hiệu:",
    "document_type": "Loại văn bản:",
    "issuing_authority": "Nơi ban hành:",
    "signer": "Người ký:",
    "issue_date": "Ngày ban hành:",
    "effective_date": "Ngày hiệu lực:",
    "status": "Tình trạng:",
}
GAZETTE_LABELS = {"gazette_date": "Ngày công báo:", "gazette_number": "Số công báo:"}
LAW_DROPPED = ["script", "style", "iframe", "nav", "footer", "aside"]

JUDGMENT_METADATA = ("ul", H.opener("ul", "class", "list-group detail-item", exact=True))
JUDGMENT_CONTENT = ("div", H.opener("div", "id", "vanban_content", exact=True))
JUDGMENT_LABELS = {
    "case_name": "Tên bản án:",
    "case_number": "Số hiệu:",
    "trial_level": "Cấp xét xử:",
    "field": "Lĩnh vực:",
    "judgment_date": "Ngày ban hành:",
}
KEYWORD_LABEL = "Từ khóa:"
AUTHORITY_LABEL = "Cơ quan ban hành:"
JUDGMENT_DROPPED = ["script", "style", "nav", "footer", "aside", "header", "form"]
PARTY_SECTION = ("div", H.opener("div", "class", "party-info-section"))
PARTY_ROLES = {"nguyen_don": "nguyên đơn", "bi_don": "bị đơn"}


# --- sections and text ------------------------------------------------------------------------


def section(toks: Column, where: tuple[str, str]) -> Column:
    """Tokens of the first element ``(tag, opening pattern)``."""
    tag, opening = where
    return H.first_element(toks, opening, tag)


def markup_section(page: Column, where: tuple[str, str]) -> Column:
    """``section`` of markup."""
    tag, opening = where
    return H.part(page, opening, tag)


def law_text(content: Column) -> Column:
    """One block per text line, blank line between blocks; '' without a content section."""
    joined = H.lines_of(H.drop_elements(content, LAW_DROPPED))
    return F.coalesce(T.clean_lines(joined, collapse_spaces=True, joiner="\n\n"), F.lit(""))


def judgment_text(content: Column) -> Column:
    """Text runs of markup joined by blanks, line breaks inside runs kept; '' without a content section."""
    joined = H.text_in(H.without(content, JUDGMENT_DROPPED), " ")
    return F.coalesce(T.clean_lines(joined, collapse_spaces=False, joiner="\n"), F.lit(""))


# --- two-column tables (statutes) --------------------------------------------------------------

_CELL, _ROW_END = 1, 2
_PART = "struct<start:int,stop:int,depth:int,kind:int>"


def _table_parts(toks: Column) -> Column:
    """Cells and row ends of a section with their cell depth.

    Only table tags count. Where every cell is closed by the next of them, no cell lies in
    another; else they are folded, with the stack of starts of the open cells.
    """
    tags = ("td", "/td", "/tr", "/tbody", "/table")
    marks = F.filter(
        F.transform(
            toks,
            lambda t, i: F.when(t["tag"].isin(*tags), F.struct(t["tag"].alias("tag"), i.alias("at"))),
        ),
        lambda m: m.isNotNull(),
    )

    def entry(start: Column, stop: Column, depth: Column, kind: int) -> Column:
        return F.struct(
            start.alias("start"),
            stop.alias("stop"),
            depth.alias("depth"),
            F.lit(kind).cast("int").alias("kind"),
        )

    def part(start: Column, stop: Column, depth: Column, kind: int) -> Column:
        return F.array(entry(start, stop, depth, kind))

    def step(opened: Column, m: Column) -> tuple[Column, Column]:
        depth = F.size(opened)
        pop = (m["tag"] == "/td") & (depth > 0)
        still_open = (
            F.when(m["tag"] == "td", F.concat(opened, F.array(m["at"])))
            .when(pop, F.slice(opened, F.lit(1), depth - 1))
            .otherwise(opened)
        )
        found = (
            F.when(pop, part(F.try_element_at(opened, F.lit(-1)), m["at"], depth, _CELL))
            .when(~m["tag"].isin("td", "/td"), part(m["at"], m["at"], depth + 1, _ROW_END))
            .otherwise(F.array().cast(f"array<{_PART}>"))
        )
        return still_open, found

    def flat(ms: Column) -> Column:
        def one(m: Column, i: Column) -> Column:
            cell = entry(m["at"], F.get(ms, i + 1)["at"], F.lit(1), _CELL)
            return F.when(m["tag"] == "td", cell).when(m["tag"] != "/td", entry(m["at"], m["at"], F.lit(1), _ROW_END))

        return F.filter(F.transform(ms, one), lambda p: p.isNotNull())

    def unpaired(ms: Column) -> Column:
        return F.filter(ms, lambda m, i: (m["tag"] == "td") != F.coalesce(F.get(ms, i + 1)["tag"] == "/td", F.lit(False)))

    none_open = F.array().cast("array<int>")

    def parts(ms: Column) -> Column:
        nested = fold_emitting(ms, none_open, step, _PART, lambda _, found: F.array_sort(found))
        return F.when(F.size(unpaired(ms)) == 0, flat(ms)).otherwise(nested)

    return let(marks, parts)


def _next_cell(parts: Column, cell: Column) -> Column:
    """The following cell of the same row, NULL at the end of the row."""
    following = F.filter(
        parts, lambda e: (e["depth"] == cell["depth"]) & (e["start"] > cell["stop"])
    )
    return let(F.get(following, F.lit(0)), lambda e: F.when(e["kind"] == _CELL, e))


def _enclosing_cell(parts: Column, at: Column) -> Column:
    """Innermost cell around a position (parts are sorted by start)."""
    around = F.filter(
        parts, lambda e: (e["kind"] == _CELL) & (e["start"] < at) & (e["stop"] > at)
    )
    return F.try_element_at(around, F.lit(-1))


def table_fields(meta: Column, bold_labels: list[str], cell_labels: list[str]) -> Column:
    """Labels of a two-column table with the text of the cell next to them.

    ``bold_labels`` are the sole text of a ``<b>`` in a cell; their value loses
    nested span/a/div bodies and placeholders. ``cell_labels`` are the sole text of
    a cell. Array of structs (bold, label, value) in page order; other labels get
    no value.
    """

    def sole_text(toks: Column) -> Column:
        return let(
            H.text_runs(toks),
            lambda runs: F.when(F.size(runs) == 1, T.strip(T.unescape(F.get(runs, F.lit(0))))),
        )

    def field(bold: bool, label: Column, wanted: list[str], value: Column) -> Column:
        return let(
            label,
            lambda name: F.struct(
                F.lit(bold).alias("bold"),
                name.alias("label"),
                F.when(name.isin(*wanted), value).alias("value"),
            ),
        )

    def bold_value(toks: Column, parts: Column, b: Column) -> Column:
        cell = let(
            _enclosing_cell(parts, b["start"]),
            lambda c: let(_next_cell(parts, c), lambda v: H.cut(toks, v)),
        )
        text = T.collapse(H.text_of(H.drop_elements(cell, ["span", "a", "div"]), " "))
        return let(
            text, lambda v: F.when(v.rlike("|".join(T.BLANK_MARKERS)), F.lit("")).otherwise(v)
        )

    def cell_value(toks: Column, parts: Column, cell: Column) -> Column:
        text = H.text_of(let(_next_cell(parts, cell), lambda v: H.cut(toks, v)), " ")
        return let(text, lambda v: F.when(v.isin(*T.GAZETTE_BLANKS), F.lit("")).otherwise(v))

    return let(
        meta,
        lambda toks: let(
            _table_parts(toks),
            lambda parts: F.concat(
                F.transform(
                    H.element_spans(toks, lambda x: F.lit(True), ["b"]),
                    lambda b: field(
                        True, sole_text(H.cut(toks, b)), bold_labels, bold_value(toks, parts, b)
                    ),
                ),
                F.transform(
                    F.filter(parts, lambda e: e["kind"] == _CELL),
                    lambda c: field(
                        False, sole_text(H.cut(toks, c)), cell_labels, cell_value(toks, parts, c)
                    ),
                ),
            ),
        ),
    )


def _labelled(fields: Column, bold: bool, label: str) -> Column:
    return F.filter(fields, lambda f: (f["bold"] == bold) & (f["label"] == label))


def table_value(fields: Column, label: str) -> Column:
    """Value of the first bold label, '' when missing."""
    return F.coalesce(F.get(_labelled(fields, True, label), F.lit(0))["value"], F.lit(""))


def gazette_value(fields: Column, label: str) -> Column:
    """Value next to the last labelled cell that has one, '' when missing."""
    with_value = F.filter(_labelled(fields, False, label), lambda f: f["value"].isNotNull())
    return F.coalesce(F.try_element_at(with_value, F.lit(-1))["value"], F.lit(""))


# --- label lists (judgments) -------------------------------------------------------------------


def link_texts(toks: Column) -> Column:
    """Text of every ``<a>`` in order."""
    return markup_link_texts(H.markup(H.html_of(toks)))


def markup_link_texts(page: Column) -> Column:
    """``link_texts`` of markup."""
    return F.transform(H.parts(page, H.opener("a"), "a", inside=True), lambda a: H.text_in(a, ""))


def list_fields(
    items: Column, value_labels: list[str], link_labels: list[str], first_link_labels: list[str]
) -> Column:
    """Per list item (markup) its bold labels and, where its label asks for it, the value text,
    the links of its value box, or its first link."""
    row, box = H.opener("div", "class", "row"), H.opener("div", "class", "col-xl-9")

    def among(labels: Column, wanted: list[str]) -> Column:
        return F.arrays_overlap(labels, F.array(*[F.lit(w) for w in wanted]))

    def field(item: Column, usual: Column, label: Column) -> Column:
        """``label`` is empty in items of another form, which begin with a tag."""

        def box_in(within: Column) -> Column:
            value = F.substring(usual, F.length(label) + 2, F.length(usual))
            return F.when(label != "", value).otherwise(H.part(within, box, "div"))

        bold = F.transform(H.parts(item, H.opener("b"), "b"), H.raw_text_in)
        labels = F.when(label != "", F.array(T.decode_entities(label))).otherwise(bold)
        value = F.replace(H.text_in(box_in(H.part(item, row, "div")), " "), F.lit("\n"), F.lit(" "))
        return let(
            labels,
            lambda ls: F.struct(
                ls.alias("labels"),
                F.when(among(ls, value_labels), value).alias("value"),
                F.when(among(ls, link_labels), markup_link_texts(box_in(item))).alias("links"),
                F.when(
                    among(ls, first_link_labels), F.get(markup_link_texts(item), F.lit(0))
                ).alias("first_link"),
            ),
        )

    def labelled(item: Column, usual: Column) -> Column:
        return let(F.substring_index(usual, "<", 1), lambda label: field(item, usual, label))

    return F.transform(
        items, lambda item: let(H.label_and_box(item, row, box), lambda usual: labelled(item, usual))
    )


def list_field(fields: Column, label: str) -> Column:
    """First list item that carries the exact label in bold; NULL if none."""
    return F.get(F.filter(fields, lambda f: F.array_contains(f["labels"], label)), F.lit(0))


def party_sections(page: Column) -> Column:
    """Party sections of markup with their titles."""
    return F.transform(
        H.parts(page, PARTY_SECTION[1], "div"),
        lambda s: F.struct(
            F.lower(H.text_in(H.part(s, H.opener("h4"), "h4", inside=True), "")).alias("title"),
            s.alias("section"),
        ),
    )


def parties(sections: Column) -> Column:
    """Names per role; when a role has several sections the last one counts."""
    plaintiff, defendant = PARTY_ROLES["nguyen_don"], PARTY_ROLES["bi_don"]
    empty = F.array().cast("array<string>")

    def names(section: Column) -> Column:
        lists = F.transform(
            H.parts(section, H.opener("ul"), "ul"),
            lambda u: F.transform(
                H.parts(u, H.opener("li"), "li", inside=True), lambda li: H.text_in(li, "")
            ),
        )
        return F.flatten(lists)

    def last_names(found: Column) -> Column:
        return F.coalesce(names(F.try_element_at(found, F.lit(-1))["section"]), empty)

    return let(
        sections,
        lambda ss: F.struct(
            last_names(F.filter(ss, lambda s: F.contains(s["title"], F.lit(plaintiff)))).alias(
                "nguyen_don"
            ),
            last_names(
                F.filter(
                    ss,
                    lambda s: F.contains(s["title"], F.lit(defendant))
                    & ~F.contains(s["title"], F.lit(plaintiff)),
                )
            ).alias("bi_don"),
            empty.alias("ben_lien_quan"),
        ),
    )


# --- records ----------------------------------------------------------------------------------


def _fetched(pages: DataFrame, name: str, form: Callable[[Column], Column]) -> DataFrame:
    """Fetched pages with their HTML in another form; a failed fetch keeps its row and gets an error."""
    fetched = F.coalesce(F.col("http_status") < 400, F.lit(True))
    return pages.withColumn(
        "error", F.when(~fetched, F.concat(F.lit("HTTP status "), F.col("http_status")))
    ).withColumn(name, F.when(fetched, form(F.col("html"))))


def law_records(pages: DataFrame, keep: tuple[str, ...] = ("doc_key",)) -> DataFrame:
    """Statute pages to typed records plus an ``error`` column (NULL = usable).

    ``metadata_html`` is the untouched section.
    """
    with_sections = (
        _fetched(pages, "_toks", H.tokens)
        .withColumn("_meta", section(F.col("_toks"), LAW_METADATA))
        .withColumn("_content", section(F.col("_toks"), LAW_CONTENT))
        .withColumn(
            "_fields",
            table_fields(
                F.col("_meta"), list(LAW_LABELS.values()), list(GAZETTE_LABELS.values())
            ),
        )
    )
    raw = with_sections.select(
        *keep,
        # Not deterministic, for the optimizer: else a filter on the error would be moved down and extract all pages again.
        F.when(F.spark_partition_id() >= 0, F.col("error")).alias("error"),
        *[table_value(F.col("_fields"), label).alias(f"_{n}") for n, label in LAW_LABELS.items()],
        *[gazette_value(F.col("_fields"), label).alias(f"_{n}") for n, label in GAZETTE_LABELS.items()],
        H.html_of(F.col("_meta")).alias("metadata_html"),
        H.html_of(F.col("_content")).alias("content_html"),
        law_text(F.col("_content")).alias("content_text"),
    )
    effective, impossible = T.first_slash_date(F.col("_effective_date"))
    effective = F.when(F.col("_effective_date").isin("Đã biết", "Liên hệ"), None).otherwise(effective)
    return raw.select(
        *keep,
        F.col("_document_number").alias("document_number"),
        F.col("_document_type").alias("document_type"),
        F.col("_issuing_authority").alias("issuing_authority"),
        F.col("_signer").alias("signer"),
        T.parse_date(F.col("_issue_date"), "d/M/yyyy").alias("issue_date"),
        effective.alias("effective_date"),
        F.col("_gazette_date").alias("gazette_date"),
        F.col("_gazette_number").alias("gazette_number"),
        T.status_code(F.col("_status")).alias("status"),
        "metadata_html",
        "content_html",
        "content_text",
        F.coalesce(
            "error",
            F.when(impossible, F.concat(F.lit("impossible effective date: "), "_effective_date")),
        ).alias("error"),
    )


def judgment_records(pages: DataFrame, keep: tuple[str, ...] = ("doc_key",)) -> DataFrame:
    """Judgment pages to typed records plus ``error`` and ``missing_labels`` flags."""
    with_sections = (
        _fetched(pages, "_page", H.markup)
        .withColumn("_meta", markup_section(F.col("_page"), JUDGMENT_METADATA))
        .withColumn("_content", markup_section(F.col("_page"), JUDGMENT_CONTENT))
        .withColumn("_items", H.parts(F.col("_meta"), H.opener("li"), "li"))
        .withColumn("_sections", party_sections(F.col("_page")))
        .withColumn(
            "_fields",
            list_fields(
                F.col("_items"),
                list(JUDGMENT_LABELS.values()),
                [KEYWORD_LABEL],
                [AUTHORITY_LABEL],
            ),
        )
    )
    keywords = list_field(F.col("_fields"), KEYWORD_LABEL)
    authority = list_field(F.col("_fields"), AUTHORITY_LABEL)
    values = {
        n: F.coalesce(list_field(F.col("_fields"), label)["value"], F.lit(""))
        for n, label in JUDGMENT_LABELS.items()
    }
    date = T.parse_date(T.strip(values.pop("judgment_date")), "d/M/yyyy")
    missing = F.array_compact(
        F.array(
            F.when(F.col("_meta").isNotNull() & keywords.isNull(), F.lit(KEYWORD_LABEL)),
            F.when(F.col("_meta").isNotNull() & authority.isNull(), F.lit(AUTHORITY_LABEL)),
        )
    )
    return with_sections.select(
        *keep,
        values["case_name"].alias("case_name"),
        values["case_number"].alias("case_number"),
        F.coalesce(authority["first_link"], F.lit("")).alias("issuing_authority"),
        values["trial_level"].alias("trial_level"),
        values["field"].alias("field"),
        date.alias("judgment_date"),
        F.coalesce(keywords["links"], F.array().cast("array<string>")).alias(
            "keywords"
        ),
        H.source_of(F.col("_meta"), F.col("_page"), F.col("html")).alias("metadata_html"),
        H.source_of(F.col("_content"), F.col("_page"), F.col("html")).alias("content_html"),
        judgment_text(F.col("_content")).alias("content_text"),
        parties(F.col("_sections")).alias("related_parties"),
        missing.alias("missing_labels"),
        "error",
    )


def qa_records(
    pages: DataFrame, question: Column, answer: Column, category: Column, keep: tuple[str, ...] = ("doc_key",)
) -> DataFrame:
    """Question/answer records; the extraction expressions are the caller's."""
    return pages.select(
        *keep,
        question.alias("question_html"),
        answer.alias("answer_html"),
        category.alias("category"),
    )


# --- before writing ---------------------------------------------------------------------------


def with_write_defaults(records: DataFrame) -> DataFrame:
    """Text dates to dates, status and gazette number filled."""

    def as_date(name: str) -> Column:
        is_text = dict(records.dtypes)[name] == "string"
        return T.flexible_date(F.col(name)) if is_text else F.col(name)

    dates = {n: as_date(n) for n in ("issue_date", "effective_date", "gazette_date") if n in records.columns}
    return records.withColumns(
        {
            **dates,
            "status": F.coalesce(F.col("status"), F.lit("unknown")),
            "gazette_number": F.coalesce(F.col("gazette_number"), F.lit("")),
        }
    )


def resolve_duplicates(
    records: DataFrame, key: str, newest: list[str], on_duplicate: str = "append"
) -> DataFrame:
    """``append`` keeps every record; ``keep_latest`` one per key, the greatest by ``newest``."""
    if on_duplicate == "append":
        return records
    if on_duplicate != "keep_latest":
        raise ValueError(f"on_duplicate: {on_duplicate}")
    order = Window.partitionBy(key).orderBy(*[F.col(c).desc_nulls_last() for c in newest])
    return records.withColumn("_rank", F.row_number().over(order)).filter("_rank = 1").drop("_rank")
