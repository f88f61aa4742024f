"""Statute structure: paragraphs, typed nodes, nesting, articles, references.

Everything about one document is computed from one array column of its
paragraphs, in the row that holds the document. The operators are projections
plus one ``inline``: no exchange, no sort, and usable on streams unchanged.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexloom.functions.arrays import let, occurrence_numbers, positions, spread_starts
from lexloom.functions.html import INVISIBLE
from lexloom.functions.text import WS, decode_entities, lines, strip

CONTENT = "CONTENT"


@dataclass(frozen=True)
class Rule:
    """One structural type: smaller ``level`` encloses larger ones."""

    type: str
    level: int
    detect: str
    number: str = r"(\d+)"


@dataclass(frozen=True)
class RuleTable:
    """Detection rules in priority order; the first match wins."""

    rules: tuple[Rule, ...]
    article: str
    strict_ref: bool = True
    reference: str = r"điều\s+\d+"

    @property
    def depth(self) -> int:
        return max(r.level for r in self.rules)

    @property
    def article_rule(self) -> Rule:
        return next(r for r in self.rules if r.type == self.article)

    def level_of(self, text: Column) -> Column:
        """Level of a paragraph, NULL for plain content (case-insensitive, Unicode)."""
        chain = F
        for rule in self.rules:
            chain = chain.when(text.rlike(f"(?iU){rule.detect}"), F.lit(rule.level).cast("int"))
        return chain.otherwise(F.lit(None).cast("int"))

    def type_of(self, level: Column) -> Column:
        chain = F
        for rule in self.rules:
            chain = chain.when(level == rule.level, F.lit(rule.type))
        return chain.otherwise(F.lit(CONTENT))

    def number_of(self, level: Column, text: Column) -> Column:
        """Number of a heading; NULL for plain content, '' when the heading shows none."""
        flags = "(?U)" if self.strict_ref else "(?iU)"
        chain = F
        for rule in self.rules:
            chain = chain.when(
                level == rule.level, F.regexp_extract(text, flags + rule.number, 1)
            )
        return chain.otherwise(F.lit(None).cast("string"))


# Headings of Vietnamese statutes.
STATUTE = RuleTable(
    rules=(
        Rule("PHẦN", 1, r"^PHẦN\s+[A-Z]+"),
        Rule("CHƯƠNG", 2, r"^Chương\s+[IVXLCDM]+", r"Chương\s+([IVXLCDM]+)"),
        Rule("MỤC", 3, r"^Mục\s+\d+"),
        Rule("ĐIỀU", 4, r"^Điều\s+\d+[\.:]?", r"Điều\s+(\d+)"),
        Rule("KHOẢN", 5, r"^\d+\.", r"^(\d+)\."),
        Rule("ĐIỂM", 6, r"^[a-z]\)", r"^([a-z])\)"),
    ),
    article="ĐIỀU",
)

# The same headings with the subsection level between section and article.
STATUTE_WITH_SUBSECTIONS = RuleTable(
    rules=(
        Rule("TIỂU_MỤC", 4, r"^Tiểu\s+mục\s+\d+"),
        *(
            Rule(r.type, r.level + (r.level > 3), r.detect, r.number)
            for r in STATUTE.rules
        ),
    ),
    article="ĐIỀU",
)

_P_OPEN = r"(?i)<p(?:\s[^>]*)?>"
_P_CLOSE = r"(?i)</p\s*>"
_TAG = "<[A-Za-z/!?][^>]*>"  # a bracket before anything else is text
_BLOCK_CLOSE = r"(?i)</(?:article|section|main|div|td|th|tr|table|li|ul|ol|blockquote|body|html)\s*>"


def paragraphs(html: Column) -> Column:
    """Non-empty texts of the ``<p>`` elements in order.

    A paragraph ends at its closing tag or at the next ``<p>``; one that is never
    closed ends with the block around it.
    """
    page = F.regexp_replace(F.replace(html, F.lit("\r\n"), F.lit(" ")), INVISIBLE, "")

    def body(piece: Column) -> Column:
        inner = F.when(
            piece.rlike(_P_CLOSE), F.get(F.split(piece, _P_CLOSE, 2), F.lit(0))
        ).otherwise(F.get(F.split(piece, _BLOCK_CLOSE, 2), F.lit(0)))
        return F.regexp_replace(inner, _TAG, "")

    bodies = F.transform(let(F.split(page, _P_OPEN), lambda parts: F.slice(parts, F.lit(2), F.size(parts))), body)
    return F.filter(
        F.transform(bodies, lambda p: strip(decode_entities(p))), lambda p: p != ""
    )


def line_paragraphs(text: Column) -> Column:
    """Non-empty stripped lines of plain text, as paragraphs."""
    return let(text, lambda t: F.filter(F.transform(lines(t), strip), lambda p: p != ""))


def infer_type(text: Column, rules: RuleTable = STATUTE, below: str | None = None) -> Column:
    """Type of a loose text by the rules above ``below`` (default: the article level)."""
    limit = next(r.level for r in rules.rules if r.type == (below or rules.article))
    upper = RuleTable(tuple(r for r in rules.rules if r.level < limit), article=rules.article)
    return upper.type_of(upper.level_of(text))


def _leveled(paras: Column, rules: RuleTable) -> Column:
    return F.transform(
        paras, lambda p: F.struct(rules.level_of(p).alias("level"), p.alias("content"))
    )


def _latest_by_level(nodes: Column, depth: int) -> Column:
    """For each level the latest position of that level at or before each node."""
    return F.transform(
        F.sequence(F.lit(1), F.lit(depth)),
        lambda k: spread_starts(positions(nodes, lambda n: n["level"] == k), F.size(nodes)),
    )


def _ancestors(latest: Column, at: Column, level: Column, depth: int) -> Column:
    """Positions of the enclosing headings of node ``at``, outermost first."""
    candidates = F.transform(
        latest,
        lambda runs, k: F.when((k + 1) < F.coalesce(level, F.lit(depth + 1)), F.get(runs, at)),
    )
    return let(
        candidates,
        lambda c: F.filter(
            c,
            lambda x, k: x.isNotNull()
            & (x > F.coalesce(F.array_max(F.slice(c, F.lit(1), k)), F.lit(-1))),
        ),
    )


def _node_array(paras: Column, rules: RuleTable) -> Column:
    def nest(nodes: Column) -> Column:
        return let(
            _latest_by_level(nodes, rules.depth),
            lambda latest: F.transform(
                nodes,
                lambda n, i: F.struct(
                    i.alias("seq"),
                    n["level"].alias("level"),
                    n["content"].alias("content"),
                    _ancestors(latest, i, n["level"], rules.depth).alias("ancestors"),
                ),
            ),
        )

    return let(_leveled(paras, rules), nest)


def nodes(docs: DataFrame, key: str, paras: Column, rules: RuleTable = STATUTE) -> DataFrame:
    """One row per paragraph: seq, type, level, number, content, parent_seq, ancestors."""
    return (
        docs.select(F.col(key).alias("document_id"), F.inline(_node_array(paras, rules)))
        .select(
            "document_id",
            "seq",
            rules.type_of(F.col("level")).alias("type"),
            "level",
            rules.number_of(F.col("level"), F.col("content")).alias("number"),
            "content",
            F.try_element_at("ancestors", F.lit(-1)).alias("parent_seq"),
            "ancestors",
        )
    )


def outline(node_rows: DataFrame) -> DataFrame:
    """Indented listing line of every node (fixed values: the marks of the line)."""
    number = F.when(F.coalesce("number", F.lit("")) != "", F.concat(F.lit(" "), F.col("number")))
    return node_rows.select(
        "document_id",
        "seq",
        F.size("ancestors").alias("depth"),
        F.concat(
            F.repeat(F.lit("  "), F.size("ancestors")),
            F.lit("- **"),
            F.col("type"),
            F.lit("**"),
            F.coalesce(number, F.lit("")),
            F.lit(": "),
            F.col("content"),
        ).alias("line"),
    )


def heading_label(text: Column) -> Column:
    """First two words of a heading without closing punctuation."""
    return F.regexp_extract(text, r"(?U)^\S+\s+[^\s.:]+", 0)


def mark_references(text: Column, rules: RuleTable = STATUTE) -> Column:
    """Collapse white space and bracket article references that a blank follows."""
    flat = F.regexp_replace(text, rf"{WS}+", " ")
    return F.btrim(F.regexp_replace(flat, rf"(?iU)({rules.reference})(?= )", "[REF:$1]"))


def clean_content(content: Column, rules: RuleTable = STATUTE) -> Column:
    return F.array_join(F.transform(content, lambda p: mark_references(p, rules)), "\n")


def _article_array(paras: Column, rules: RuleTable) -> Column:
    """Array of article structs of one document."""
    level = rules.article_rule.level

    def split_articles(nodes_: Column) -> Column:
        return let(
            positions(nodes_, lambda n: n["level"] == level),
            lambda starts: let(
                _latest_by_level(nodes_, level - 1) if level > 1 else F.array(),
                lambda latest: F.transform(
                    starts,
                    lambda s, j: F.struct(
                        (j + 1).alias("art"),
                        s.alias("seq"),
                        F.get(nodes_, s)["content"].alias("heading"),
                        rules.number_of(F.lit(level), F.get(nodes_, s)["content"]).alias("number"),
                        F.transform(
                            F.filter(
                                F.slice(
                                    nodes_,
                                    s + 2,
                                    F.coalesce(F.get(starts, j + 1), F.size(nodes_)) - s - 1,
                                ),
                                lambda n: n["level"].isNull() | (n["level"] > level),
                            ),
                            lambda n: n["content"],
                        ).alias("content"),
                        F.transform(
                            _ancestors(latest, s, F.lit(level), level),
                            lambda a: heading_label(F.get(nodes_, a)["content"]),
                        ).alias("hierarchy"),
                    ),
                ),
            ),
        )

    def with_occurrence(arts: Column) -> Column:
        return let(
            occurrence_numbers(F.transform(arts, lambda a: a["number"])),
            lambda nth: F.transform(
                arts,
                lambda a, i: F.struct(
                    *[a[f].alias(f) for f in ("art", "seq", "heading", "number", "content", "hierarchy")],
                    F.get(nth, i).alias("occurrence"),
                ),
            ),
        )

    return let(let(_leveled(paras, rules), split_articles), with_occurrence)


def article_id(document_number: Column, number: Column) -> Column:
    return F.concat(document_number, F.lit("-ART-"), number)


def articles(
    docs: DataFrame,
    key: str,
    document_number: str,
    paras: Column,
    rules: RuleTable = STATUTE,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row per article of every document.

    Text before the first article is dropped. Headings above article level do not
    close an article, so what follows them still belongs to it.
    """
    prefix = F.when(
        F.size("hierarchy") > 0, F.concat(F.array_join("hierarchy", "/"), F.lit("/"))
    ).otherwise("")
    return (
        docs.select(
            F.col(key).alias("document_id"),
            F.col(document_number).alias("document_number"),
            *keep,
            F.inline(_article_array(paras, rules)),
        )
        .select(
            article_id(F.col("document_number"), F.col("number")).alias("article_id"),
            "document_id",
            "document_number",
            "art",
            "seq",
            "number",
            "occurrence",
            "heading",
            F.array_join("content", "\n").alias("content"),
            clean_content(F.col("content"), rules).alias("clean_content"),
            F.size("content").alias("n_paragraphs"),
            F.struct(
                F.col("hierarchy"),
                prefix.alias("prefix"),
                heading_label(F.col("heading")).alias("article_number"),
            ).alias("structural_metadata"),
            *keep,
        )
    )


def under_heading(article_rows: DataFrame, label: str) -> DataFrame:
    """Articles whose hierarchy contains the given heading label."""
    return article_rows.filter(F.array_contains("structural_metadata.hierarchy", label))


def references(docs: DataFrame, key: str, paras: Column, rules: RuleTable = STATUTE) -> DataFrame:
    """Edges from articles to the article numbers their paragraphs mention.

    Same marks as ``mark_references``. ``to_art`` is the first article of the
    document with that number, NULL when it has none.
    """
    mention = rf"(?iU){rules.reference}(?=\s)"

    def edges(arts: Column) -> Column:
        return let(
            F.transform(arts, lambda a: a["number"]),
            lambda numbers: F.flatten(
                F.transform(
                    arts,
                    lambda a: F.flatten(
                        F.transform(
                            a["content"],
                            lambda p, i: F.transform(
                                F.regexp_extract_all(p, F.lit(mention), F.lit(0)),
                                lambda m, j: let(
                                    F.regexp_extract(m, r"(?U)(\d+)", 1),
                                    lambda n: F.struct(
                                        a["art"].alias("from_art"),
                                        a["number"].alias("from_number"),
                                        (i + 1).alias("paragraph"),
                                        (j + 1).alias("nth"),
                                        n.alias("to_number"),
                                        F.nullif(
                                            F.array_position(numbers, n), F.lit(0)
                                        ).alias("to_art"),
                                    ),
                                ),
                            ),
                        )
                    ),
                )
            ),
        )

    return docs.select(
        F.col(key).alias("document_id"), F.inline(let(_article_array(paras, rules), edges))
    )


def first_writer(article_rows: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """Articles to append: ids not stored yet, first writer (document, position) per id.

    The rank cut comes first: Spark keeps one candidate per id and task before the
    shuffle, so an id shared by very many rows stays cheap, and the anti join works
    on the partitioning of the ranks.
    """
    order = Window.partitionBy("article_id").orderBy("document_id", "art")
    winners = (
        article_rows.withColumn("_rank", F.row_number().over(order)).filter("_rank = 1").drop("_rank")
    )
    if stored is None:
        return winners
    return winners.join(stored.select("article_id").distinct(), "article_id", "left_anti")
