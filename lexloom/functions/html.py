"""HTML as an array of tokens: element lookup and text without a tree.

``tokens`` cuts a page into tags, text runs, comments and whole script/style
blocks, each with its tag name. Elements are found from the positions of the tags
of one name; only those few tags take part in the matching of opening and closing
tags. Everything stays in the page's row, so a page needs no shuffle.

``markup`` is the same page as one string, in which every ``<`` begins a token.
Elements and text runs are cut from it by patterns: no lambda visits each token, so
it is the faster form where a page is cut many times. Both forms give the same elements.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexloom.functions.arrays import fold_emitting, let
from lexloom.functions.text import decode_entities, strip, unescape

# Both patterns have the "<" of all branches in front, so that other characters meet one test.
_TOKEN = (
    r"(?is)[^<]+"
    # Comments and raw text that are never closed run to the end of the page.
    r"|<(?:!--.*?(?:-->|\z)"
    r"|(script|style)\b[^>]*>.*?(?:</\1\s*>|\z)"
    # No branch reads past the next "<", so unbalanced quotes cannot make a page quadratic.
    r"|/?[a-z](?:[^<>\"']++|\"[^<\"]*+\"|'[^<']*+')*+>"
    r"|/?[a-z!][^<>]*>"
    r"|)"
)
# Text that never counts as content: comments and raw-text blocks.
INVISIBLE = r"(?is)<(?:!--.*?(?:-->|\z)|(script|style)\b[^>]*>.*?(?:</\1\s*>|\z))"


def tokens(html: Column) -> Column:
    """Array of (tag, raw): lower-case tag name, with a slash when closing, '' for text,
    '!' for comments and declarations."""
    return F.transform(
        F.regexp_extract_all(html, F.lit(_TOKEN), F.lit(0)),
        lambda t: F.struct(
            F.when(~t.startswith("<") | (t == "<"), F.lit(""))
            .when(t.startswith("<!"), F.lit("!"))
            .otherwise(F.lower(F.regexp_extract(t, "^<(/?[A-Za-z][A-Za-z0-9:-]*)", 1)))
            .alias("tag"),
            t.alias("raw"),
        ),
    )


def opener(tag: str, attr: str | None = None, value: str | None = None, exact: bool = False) -> str:
    """Regex for an opening tag; ``value`` is one word of the attribute, or all of it if ``exact``."""
    if attr is None:
        return rf"(?i)^<{tag}(?=[\s/>])"
    if value is None:
        return rf"(?i)^<{tag}\s(?:[^>]*\s)?{attr}\s*="
    word = value if exact else rf"(?:[^\"'>]*\s)?{value}(?:\s[^\"'>]*)?"
    bare = "" if " " in value else rf"|{value}(?=[\s/>])"
    # The test for the value alone comes first: most tags do not hold it anywhere.
    return rf"^<(?i:{tag})\s(?=[^>]*?{value})(?:[^>]*\s)?(?i:{attr})\s*=\s*(?:\"{word}\"|'{word}'{bare})"


_SPAN = "struct<start:int,stop:int>"


def _int(n: int) -> Column:
    return F.lit(n).cast("int")


def _span(start: Column, stop: Column) -> Column:
    return F.struct(start.alias("start"), stop.alias("stop"))


def cut(toks: Column, span: Column) -> Column:
    """Tokens of a zero-based, inclusive span; NULL for a NULL span."""
    return F.slice(toks, span["start"] + 1, span["stop"] - span["start"] + 1)


def _marks(toks: Column, wanted: Callable[[Column], Column], names: list[str]) -> Column:
    """Opening and closing tags of these names: (tag, at, wanted), one pass over the page."""
    tags = [*names, *[f"/{n}" for n in names]]
    return F.filter(
        F.transform(
            toks,
            lambda t, i: F.when(
                t["tag"].isin(*tags),
                F.struct(
                    t["tag"].alias("tag"),
                    i.alias("at"),
                    (~t["tag"].startswith("/") & wanted(t)).alias("wanted"),
                ),
            ),
        ),
        lambda m: m.isNotNull(),
    )


def first_element(toks: Column, opening: str, tag: str) -> Column:
    """Tokens of the first element whose opening tag matches, NULL if there is none.

    The element ends at the first closing tag that has as many opening tags of the
    same name before it; one that is never closed runs to the last token.
    """

    def stop(t: Column, marks: Column, start: Column) -> Column:
        opens = F.filter(marks, lambda m: (m["at"] > start) & (m["tag"] == tag))
        closes = F.filter(marks, lambda m: (m["at"] > start) & (m["tag"] != tag))
        balanced = let(
            opens,
            lambda o: F.filter(
                closes, lambda c, k: F.coalesce(F.get(o, k)["at"] > c["at"], F.lit(True))
            ),
        )
        return F.coalesce(F.get(balanced, F.lit(0))["at"], F.size(t) - 1)

    def span(t: Column, marks: Column) -> Column:
        start = F.get(F.filter(marks, lambda m: m["wanted"]), F.lit(0))["at"]
        return let(start, lambda s: F.when(s.isNotNull(), _span(s, stop(t, marks, s))))

    def pick(t: Column) -> Column:
        marks = _marks(t, _wanted(opening, tag), [tag])
        return let(let(marks, lambda m: span(t, m)), lambda e: cut(t, e))

    return let(toks, pick)


def element_spans(toks: Column, wanted: Callable[[Column], Column], names: list[str]) -> Column:
    """Spans of the outermost elements with one of ``names`` whose opening tag is wanted.

    Only the tags of these names count, from the first wanted one on. While inside an
    element, tags of its name nest; an element never closed runs to the last token.
    Where every tag is closed by the next one, pairs are read off; others are folded.
    """
    nothing = F.array().cast(f"array<{_SPAN}>")

    def one_name(acc: Column, m: Column) -> tuple[Column, Column]:
        """``step`` where all tags have the same name."""
        outside, opens = acc["depth"] == 0, ~m["tag"].startswith("/")
        state = F.struct(
            F.when(outside, F.when(m["wanted"], _int(1)).otherwise(_int(0)))
            .when(opens, acc["depth"] + 1)
            .otherwise(acc["depth"] - 1)
            .alias("depth"),
            F.when(outside, m["at"]).otherwise(acc["start"]).alias("start"),
        )
        return state, F.when((acc["depth"] == 1) & ~opens, F.array(_span(acc["start"], m["at"]))).otherwise(nothing)

    def step(acc: Column, m: Column) -> tuple[Column, Column]:
        starts = (acc["depth"] == 0) & m["wanted"]
        closes = (acc["depth"] > 0) & (m["tag"] == F.concat(F.lit("/"), acc["name"]))
        state = F.struct(
            F.when(starts, m["tag"]).otherwise(acc["name"]).alias("name"),
            F.when(starts, _int(1))
            .when(closes, acc["depth"] - 1)
            .when((acc["depth"] > 0) & (m["tag"] == acc["name"]), acc["depth"] + 1)
            .otherwise(acc["depth"])
            .alias("depth"),
            F.when(starts, m["at"]).otherwise(acc["start"]).alias("start"),
        )
        ended = F.when(
            closes & (acc["depth"] == 1), F.array(_span(acc["start"], m["at"]))
        ).otherwise(nothing)
        return state, ended

    def finish(state: Column, spans: Column) -> Column:
        return F.when(
            state["depth"] > 0, F.concat(spans, F.array(_span(state["start"], F.size(toks) - 1)))
        ).otherwise(spans)

    def folded(marks: Column) -> Column:
        depth = [_int(0).alias("depth"), _int(0).alias("start")]
        if len(names) == 1:
            return fold_emitting(marks, F.struct(*depth), one_name, _SPAN, finish)
        return fold_emitting(marks, F.struct(F.lit("").alias("name"), *depth), step, _SPAN, finish)

    def pairs(marks: Column) -> Column:
        return F.filter(
            F.transform(
                marks,
                lambda m, i: F.when(m["wanted"], _span(m["at"], F.coalesce(F.get(marks, i + 1)["at"], F.size(toks) - 1))),
            ),
            lambda s: s.isNotNull(),
        )

    def unpaired(marks: Column) -> Column:
        return F.filter(
            marks,
            lambda m, i: F.when(i % 2 == 0, m["tag"].startswith("/")).otherwise(
                m["tag"] != F.concat(F.lit("/"), F.get(marks, i - 1)["tag"])
            ),
        )

    def from_first(marks: Column) -> Column:
        first = F.get(F.filter(marks, lambda m: m["wanted"]), F.lit(0))["at"]
        after = let(first, lambda at: F.filter(marks, lambda m: m["at"] >= at))
        spans = let(after, lambda ms: F.when(F.size(unpaired(ms)) == 0, pairs(ms)).otherwise(folded(ms)))
        return F.when(F.exists(marks, lambda m: m["wanted"]), spans).otherwise(nothing)

    return let(_marks(toks, wanted, names), from_first)


def _wanted(opening: str, tag: str) -> Callable[[Column], Column]:
    """Test of an opening tag; the plain opener of a tag needs none."""
    return (lambda x: F.lit(True)) if opening == opener(tag) else (lambda x: x["raw"].rlike(opening))


def all_elements(toks: Column, opening: str, tag: str) -> Column:
    """Tokens of every outermost matching element, in page order."""
    return let(
        toks,
        lambda t: F.transform(
            element_spans(t, _wanted(opening, tag), [tag]), lambda s: cut(t, s)
        ),
    )


def drop_elements(toks: Column, names: list[str]) -> Column:
    """Remove elements with these tag names, nested content included.

    Script and style blocks are single tokens.
    """
    nesting = [n for n in names if n not in ("script", "style")]

    def gap(t: Column, before: Column, start: Column) -> Column:
        return F.slice(t, before + 2, start - before - 1)

    def keep(t: Column, spans: Column) -> Column:
        kept = F.transform(
            spans,
            lambda s, j: let(
                F.coalesce(F.get(spans, j - 1)["stop"], _int(-1)), lambda p: gap(t, p, s["start"])
            ),
        )
        tail = gap(t, F.try_element_at(spans, F.lit(-1))["stop"], F.size(t))
        return F.when(F.size(spans) == 0, t).otherwise(F.flatten(F.concat(kept, F.array(tail))))

    visible = F.filter(toks, lambda x: ~x["tag"].isin("script", "style"))
    return let(
        visible,
        lambda t: let(
            element_spans(t, lambda x: F.lit(True), nesting), lambda spans: keep(t, spans)
        ),
    )


def text_runs(toks: Column) -> Column:
    """Text runs as they stand in the page."""
    return F.filter(toks, lambda t: t["tag"] == "")["raw"]


def texts(toks: Column) -> Column:
    """Decoded, stripped, non-empty text runs in order."""
    return F.filter(F.transform(text_runs(toks), lambda t: strip(decode_entities(t))), lambda t: t != "")


def raw_texts(toks: Column) -> Column:
    """Decoded text runs as they are."""
    return F.transform(text_runs(toks), decode_entities)


def text_of(toks: Column, separator: str) -> Column:
    return F.array_join(texts(toks), separator)


def lines_of(toks: Column) -> Column:
    """Decoded text, a line break between runs: no reference reaches over one, so the whole is decoded at once."""
    return unescape(F.array_join(text_runs(toks), "\n"))


def html_of(toks: Column) -> Column:
    return F.array_join(toks["raw"], "")


# --- markup -----------------------------------------------------------------------------------

# Rest of a tag after its name, as a token has it; end of a name.
_TAIL = r"(?:(?:[^<>\"']++|\"[^<\"]*+\"|'[^<']*+')*+>|[^<>]*+>)"
_END = "(?![A-Za-z0-9:-])"
_TAG = rf"<(?:/?[A-Za-z]{_TAIL}|![^<>]*+>)"
# Same-name elements in one another that a pattern follows; deeper ones are counted.
_NESTED = {"div": 3}
# Stands for a comment or raw-text block.
_HIDDEN = "<!>"


def markup(html: Column) -> Column:
    """The page with every comment and raw-text block replaced by ``<!>``."""

    def hidden(h: Column) -> Column:
        return F.when(h.rlike("<[!sS][-cCtT]"), F.regexp_replace(h, INVISIBLE, _HIDDEN)).otherwise(h)

    return let(html, hidden)


def _sought(tag: str, opening: str) -> str:
    """Test for a tag which ``opening``, an ``opener``, matches; the plain one of a tag needs none."""
    return "" if opening == opener(tag) else f"(?={opening.replace('^', '', 1)})"


def _open(tag: str) -> str:
    return f"<(?i:{tag}){_END}{_TAIL}"


def _close(tag: str) -> str:
    return f"</(?i:{tag}){_END}{_TAIL}"


def _inside(tag: str, nested: int | None = None) -> str:
    """Pattern of what follows an opening tag up to its closing tag. Nothing is tried twice: the time is linear."""
    nested = _NESTED.get(tag, 1) if nested is None else nested
    inner = f"<(?!/?(?i:{tag}){_END}{_TAIL})"
    if nested:
        inner = f"(?:{inner}|{_open(tag)}{_inside(tag, nested - 1)}{_close(tag)})"
    return f"[^<]*+(?:{inner}[^<]*+)*+"


def _element(tag: str, inside: bool) -> str:
    """Pattern of an element, whose group is the element or what it holds."""
    return f"{_open(tag)}({_inside(tag)}){_close(tag)}" if inside else f"({_open(tag)}{_inside(tag)}{_close(tag)})"


def _before(wanted: str) -> str:
    return f"(?:[^<]++|(?!{wanted})<)*+"


def part(page: Column, opening: str, tag: str, inside: bool = False) -> Column:
    """``first_element`` of markup, as markup; with ``inside`` its own tags may be left out, which its text does not need."""
    sought, mark = _sought(tag, opening), f"</?(?i:{tag}){_END}{_TAIL}"
    before = _before(sought + _open(tag))

    def step(acc: Column, piece: Column) -> Column:
        deeper = F.when(piece.startswith("</"), _int(-1)).otherwise(_int(1))
        return F.when((acc["depth"] == 0) & (acc["n"] > 0), acc).otherwise(
            F.struct((acc["depth"] + deeper).alias("depth"), (acc["n"] + 1).alias("n"))
        )

    def folded(rest: Column) -> Column:
        """The element at the start of the text, from the pieces that its tags begin."""
        pieces = F.regexp_extract_all(rest, F.lit(f"{mark}(?:[^<]++|(?!{mark})<)*+"), F.lit(0))

        def upto(ps: Column, end: Column) -> Column:
            whole = F.array_join(F.slice(ps, F.lit(1), end["n"] - 1), "")
            closing = F.regexp_extract(F.get(ps, end["n"] - 1), f"^{mark}", 0)
            return F.when(end["depth"] == 0, F.concat(whole, closing)).otherwise(rest)

        zero = F.struct(_int(0).alias("depth"), _int(0).alias("n"))
        return let(pieces, lambda ps: F.aggregate(ps, zero, step, lambda end: upto(ps, end)))

    def found(m: Column) -> Column:
        closed = F.regexp_extract(m, f"(?s)^{before}{_element(tag, inside)}", 1)
        rest = F.regexp_extract(m, f"(?s)^{before}({_open(tag)}.*)", 1)
        unusual = let(rest, lambda r: F.when(r != "", folded(r)))
        return let(closed, lambda c: F.when(c != "", c).otherwise(unusual))

    return let(page, found)


def parts(page: Column, opening: str, tag: str, inside: bool = False) -> Column:
    """``all_elements`` of markup, as an array of markup; ``inside`` as in ``part``."""
    first = f"(?=<[{tag[0]}{tag[0].upper()}])"

    def every(m: Column) -> Column:
        # One that does not close in the pattern's reach takes the rest of the page and gives ''.
        pattern = f"(?s){first}{_sought(tag, opening)}(?:{_element(tag, inside)}|{_open(tag)}.*)"
        elements = F.regexp_extract_all(m, F.lit(pattern), F.lit(1))
        unusual = F.transform(all_elements(tokens(m), opening, tag), html_of)
        found_all = let(elements, lambda es: F.when(F.try_element_at(es, F.lit(-1)) == "", unusual).otherwise(es))
        return F.coalesce(found_all, F.array().cast("array<string>"))

    return let(page, every)


def without(page: Column, names: list[str]) -> Column:
    """``drop_elements`` of markup: ``<!>`` in the place of each element, so that the text around it stays in two runs."""
    nesting = [n for n in names if n not in ("script", "style")]
    elements = "|".join(f"{_open(n)}(?:{_inside(n)}{_close(n)}|(?s:.*))" for n in nesting)

    def cleared(m: Column) -> Column:
        # An element that does not close in the pattern's reach takes the rest of the page.
        unusual = F.array_join(drop_elements(tokens(m), nesting)["raw"], _HIDDEN)
        dropped = F.regexp_replace(m, elements, _HIDDEN)
        return let(dropped, lambda x: F.when(x.endswith(_HIDDEN), unusual).otherwise(x))

    return let(page, cleared)


def label_and_box(item: Column, row: str, box: str) -> Column:
    """Label and value box of a list item of the usual form as one text, ``<`` between them; others as they are.

    The usual form is a row, in it a box with a bold label, after that the value box. Others have boxes
    before these or in the value box, a second bold text, or tags in the label.
    """

    def skip(*tags: str) -> str:
        return f"(?:[^<]++|<(?!/?(?i:{'|'.join(tags)}){_END}{_TAIL}))*+"

    plain, row, box = skip("li", "b", "div"), *(_sought("div", x) + _open("div") for x in (row, box))
    label = f"(?!{box}){_open('div')}{plain}{_open('b')}([^<]++){_close('b')}{plain}(?:{_close('div')}{plain})?+"
    usual = rf"^{_open('li')}{plain}(?!{box}){row}{plain}{label}{box}({plain}){_close('div')}{skip('li', 'b')}(?:{_close('li')})?+\z"
    return F.regexp_replace(item, usual, "$1<$2")


def runs(page: Column) -> Column:
    """``text_runs`` of markup."""
    return F.regexp_extract_all(page, F.lit(rf"\G(?:{_TAG})*+([^<]++|</![^<>]*+>|<)"), F.lit(1))


def text_in(page: Column, separator: str) -> Column:
    """``text_of`` of markup."""

    def joined(m: Column) -> Column:
        several = F.filter(F.transform(runs(m), lambda t: strip(decode_entities(t))), lambda t: t != "")
        return F.when(F.contains(m, F.lit("<")), F.array_join(several, separator)).otherwise(strip(decode_entities(m)))

    return let(page, joined)


def raw_text_in(page: Column) -> Column:
    """Decoded text runs of markup as they are, joined."""
    return F.array_join(F.transform(runs(page), decode_entities), "")


def source_of(element: Column, page: Column, html: Column) -> Column:
    """A ``part`` of a page as it stands in the HTML, with its comments and raw-text blocks."""

    def restored(e: Column) -> Column:
        # A part is the first of its kind, so the same text does not stand before it.
        before = F.split_part(page, e, F.lit(1))
        hidden = F.regexp_extract_all(html, F.lit(f"{INVISIBLE}|{_HIDDEN}"), F.lit(0))
        skipped = F.size(F.split(before, _HIDDEN)) - 1

        def joined(blocks: Column, n: Column) -> Column:
            pieces = F.transform(F.split(e, _HIDDEN), lambda p, i: F.when(i == 0, p).otherwise(F.concat(F.get(blocks, n + i - 1), p)))
            return F.array_join(pieces, "")

        return let(hidden, lambda blocks: let(skipped, lambda n: joined(blocks, n)))

    return let(element, lambda e: F.when(F.contains(e, F.lit(_HIDDEN)), restored(e)).otherwise(e))
