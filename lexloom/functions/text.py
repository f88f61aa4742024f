"""Text and date expressions with Unicode-aware white space and case rules."""

from __future__ import annotations

from collections.abc import Callable
from html.entities import html5, name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexloom.functions.arrays import let

# The characters a Unicode-aware strip removes, as a regex class. The
# class escapes are several times faster in Java than the spelled-out characters.
WS = r"(?U)[\s\x1c-\x1f]"
# Line boundaries, and those of them the fast escape does not know.
LINE_BREAK = r"\R"
RARE_BREAKS = r"[\x1c-\x1e]"

# Accepted date layouts, tried in this order.
DATE_LAYOUTS = ("d/M/yyyy", "yyyy-M-d", "d M yyyy", "d-M-yyyy", "d/M/yy", "yyyy/M/d")

# Placeholders on the source site.
BLANK_MARKERS = ("Đang cập nhật", "Chưa xác định")
GAZETTE_BLANKS = ("Đang cập nhật", "Chưa công bố")
UNKNOWN = "Không xác định"

# Validity labels and their codes.
STATUS_CODES = {
    "còn hiệu lực": "valid",
    "hết hiệu lực": "expired",
    "đã biết": "unknown",
    "đang cập nhật": "pending",
}


# The same characters, for trimming without a regex.
WS_CHARS = "".join(
    chr(p)
    for p in (
        *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
        0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
    )
)


def strip(c: Column) -> Column:
    """Text without white space at its ends. Trimming visits every character, so it is left to texts that need it."""

    def visible(code: Column) -> Column:
        return code.between(0x21, 0x84) | code.between(0xA1, 0x167F) | (code > 0x3000)

    def trimmed(x: Column) -> Column:
        clean = visible(F.ascii(x)) & visible(F.ascii(F.substring(x, -1, 1)))
        return F.when(clean, x).otherwise(F.btrim(x, F.lit(WS_CHARS)))

    return let(c, trimmed)


def collapse(c: Column) -> Column:
    """Runs of white space become one blank; ends are stripped. Single blanks are no match: most texts stay as they are."""
    return F.btrim(F.regexp_replace(c, r"(?U)[\s\x1c-\x1f&&[^ ]][\s\x1c-\x1f]*| [\s\x1c-\x1f]+", " "))


def lines(c: Column) -> Column:
    return F.when(
        c.rlike(RARE_BREAKS), F.split(c, f"{LINE_BREAK}|{RARE_BREAKS}")
    ).otherwise(F.split(c, LINE_BREAK))


def clean_lines(c: Column, collapse_spaces: bool, joiner: str) -> Column:
    """Strip (or collapse) every line, drop blank lines, join the rest."""
    tidy = collapse if collapse_spaces else strip

    def join(text: Column) -> Column:
        return F.array_join(F.filter(F.transform(lines(text), tidy), lambda x: x != ""), joiner)

    return let(c, join)


def preview(c: Column, length: int = 300, mark: str = "…") -> Column:
    return F.when(F.length(c) > length, F.concat(F.substring(c, 1, length), F.lit(mark))).otherwise(c)


def percent(part: Column, whole: Column) -> Column:
    """Share in percent, two decimals; NULL when ``whole`` is zero."""
    return F.round(F.try_divide(part.cast("double"), whole.cast("double")) * 100, 2)


def _code_point(n: Column) -> Column:
    return F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")


def _name_table(names: dict[str, str]) -> Column:
    """Lookup from one foldable literal instead of thousands of map entries in every plan."""
    pairs = "\x01".join(f"{name}\x02{chars}" for name, chars in sorted(names.items()))
    return F.str_to_map(F.lit(pairs), F.lit("\x01"), F.lit("\x02"))


_NAMES = {name.rstrip(";"): chars for name, chars in html5.items()}
_COMMON = {name: chars for name, chars in _NAMES.items() if name in name2codepoint}
# Names the standard also lists without a semicolon.
_BARE = {name: chars for name, chars in html5.items() if not name.endswith(";")}
# What pages mean by the control characters 128 to 159: the windows-1252 characters, where it has one.
_C1 = "".join(bytes([n]).decode("cp1252", "ignore") or chr(n) for n in range(128, 160))
_IMPOSSIBLE = "\ufffd"


def _numbered(name: Column) -> Column:
    """Character of a numeric reference; one that is no character (0, surrogates, too large) gives U+FFFD."""
    hexadecimal = name.rlike("^#[xX]")
    digits = F.ltrim(F.when(hexadecimal, F.substring(name, F.lit(3), F.length(name))).otherwise(F.substring(name, F.lit(2), F.length(name))), F.lit("0"))
    number = let(
        digits,
        lambda d: F.when(hexadecimal & F.length(d).between(1, 6), F.conv(d, 16, 10)).when(~hexadecimal & F.length(d).between(1, 7), d).try_cast("bigint"),
    )
    return let(
        number,
        lambda n: F.when(n.between(128, 159), F.substring(F.lit(_C1), n.cast("int") - 127, F.lit(1)))
        .when(n.between(1, 0xD7FF) | n.between(0xE000, 0x10FFFF), _code_point(n))
        .otherwise(F.lit(_IMPOSSIBLE)),
    )


def _named(name: Column) -> Column:
    # Few names make up most references; the long table is scanned only for the others.
    return F.coalesce(F.try_element_at(_name_table(_COMMON), name), F.try_element_at(_name_table(_NAMES), name))


def _decoded(c: Column, pattern: str, char_for: Callable[[Column], Column]) -> Column:
    """Text with every ``&`` and ``pattern`` after it replaced by the character, if there is one."""

    def decoded(piece: Column) -> Column:
        return let(
            char_for(piece),
            lambda char: F.when(
                char.isNotNull(), F.concat(char, F.regexp_replace(piece, pattern, ""))
            ).otherwise(F.concat(F.lit("&"), piece)),
        )

    pieces = F.transform(F.split(c, "&"), lambda p, i: F.when(i == 0, p).otherwise(decoded(p)))
    return F.when(F.contains(c, F.lit("&")), F.array_join(pieces, "")).otherwise(c)


_REFERENCE = "(#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*)"


def decode_entities(c: Column) -> Column:
    """Decode the HTML character references (named, decimal, hexadecimal) of running text.

    A name is the whole run of letters and digits after the ``&``, with or without a semicolon: ``&lsqb`` is a
    bracket, ``&copy2024`` and ``&notit;`` are text. Numbers may have any number of leading zeros.
    """
    ref = f"^{_REFERENCE};?"
    return _decoded(
        c, ref, lambda piece: let(F.regexp_extract(piece, ref, 1), lambda name: F.when(name.startswith("#"), _numbered(name)).otherwise(_named(name)))
    )


def decode_attribute(c: Column) -> Column:
    """Decode the character references of an attribute value.

    Links hold ``&`` between parameters: without its semicolon a name counts only if the standard lists it
    so, and never before ``=``, a letter or a digit.
    """
    def char_for(piece: Column) -> Column:
        return let(
            F.regexp_extract(piece, f"^{_REFERENCE}", 1),
            lambda name: F.when(name.startswith("#"), _numbered(name))
            .when(piece.rlike(f"^{_REFERENCE};"), _named(name))
            .when(~piece.rlike(f"^{_REFERENCE}="), F.try_element_at(_name_table(_BARE), name)),
        )

    return _decoded(c, f"^{_REFERENCE};?", char_for)


def unescape(c: Column) -> Column:
    """``decode_entities`` of an expression that should be evaluated once."""
    return let(c, decode_entities)


def parse_date(c: Column, layout: str) -> Column:
    """Strict parse, NULL when the text does not fit or is no real date."""
    parsed = F.try_to_timestamp(c, F.lit(layout)).cast("date")
    if layout.endswith("yy") and not layout.endswith("yyyy"):
        # Two-digit years: 69-99 belong to the 1900s.
        return F.when(F.year(parsed) >= 2069, F.add_months(parsed, -1200)).otherwise(parsed)
    return parsed


def flexible_date(c: Column) -> Column:
    """First accepted layout wins, else NULL."""
    return F.coalesce(*[parse_date(c, layout) for layout in DATE_LAYOUTS])


def first_slash_date(c: Column) -> tuple[Column, Column]:
    """First ``dd/mm/yyyy`` in the text and whether that text is an impossible date."""
    found = F.regexp_extract(c, r"\d{2}/\d{2}/\d{4}", 0)
    date = parse_date(found, "d/M/yyyy")
    return date, (found != "") & date.isNull()


def status_code(label: Column, codes: dict[str, str] | None = None, default: str = "unknown") -> Column:
    """Map a lower-cased label to its code through a caller-supplied table."""
    table = STATUS_CODES if codes is None else codes
    mapped = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    return F.coalesce(F.try_element_at(mapped, F.lower(label)), F.lit(default))


def object_id(key: Column) -> Column:
    """Deterministic 24-hex-digit id of a key (same row, same id on every retry)."""
    return F.substring(F.sha2(key, 256), 1, 24)


def random_object_id() -> Column:
    return F.substring(F.replace(F.uuid(), F.lit("-"), F.lit("")), 1, 24)


def document_key(number: Column, doc_id: Column) -> Column:
    """``number#id``."""
    return F.concat_ws("#", number, doc_id.cast("string"))


def query_id(key: Column) -> Column:
    return F.md5(key)
