"""Personal data: regular expressions propose spans, checksums confirm them, context words adjust the score.

Spark expressions only, row by row, no shuffle. The kinds, in this order:

* ``email``, ``ip`` (parts at most 255), ``card`` (13 to 19 digits passing Luhn), ``phone`` (9 to 15 digits);
* ``iban`` (mod-97; in one run or printed in groups of four, in any case) and ``national_id`` (weak by itself: counts only with a context word nearby).

Matches of one kind are leftmost and do not overlap; a match that fails its check is dropped and not tried
again at other places. Spans count code points, the end is exclusive. Spans of different kinds may overlap.

* NULL and empty text: no spans. Repeated rows stay. An empty table gives an empty result.
* Long runs and texts: the patterns neither back up over a run nor start inside one, so a text is scanned
  in time linear in its length, and so are the places of any number of matches.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexloom.functions.arrays import fold_emitting, let

#: Code points before and after a span in which context words count.
NEAR = 40
#: Added to the score when a context word is near.
BONUS = 0.3
#: Spans below this score are not reported.
LEAST_SCORE = 0.5
_CHUNK = 1024
_PART = 4096


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Luhn check of a string of digits: from the right, every second digit doubled, its digits summed."""

    def worth(i: Column) -> Column:
        digit = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        doubled = digit * 2 - F.when(digit > 4, 9).otherwise(0)
        return F.when(i % 2 == 1, doubled).otherwise(digit)

    places = F.sequence(F.lit(0), F.length(digits) - 1)
    return F.aggregate(F.transform(places, worth), F.lit(0), lambda a, x: a + x) % 10 == 0


def mod97(written: Column) -> Column:
    """ISO 7064 mod 97-10 of an account number: first four characters to the end, letters as 10 to 35.

    Blanks and case do not count.
    """
    return let(F.upper(F.replace(written, F.lit(" "), F.lit(""))), _mod97)


def _mod97(account: Column) -> Column:
    moved = F.concat(F.substring(account, F.lit(5), F.length(account)), F.substring(account, F.lit(1), F.lit(4)))

    def step(rest: Column, c: Column) -> Column:
        code = F.ascii(c)
        return F.when(code >= 65, (rest * 100 + code - 55) % 97).otherwise((rest * 10 + code - 48) % 97)

    return F.aggregate(F.split(moved, ""), F.lit(0), step) == 1


def _small_parts(match: Column) -> Column:
    return F.forall(F.split(match, r"\."), lambda p: F.length(F.ltrim(p, F.lit("0"))) <= 3) & F.forall(
        F.split(match, r"\."), lambda p: F.right(p, F.lit(4)).cast("int") <= 255
    )


def _card(match: Column) -> Column:
    return let(_digits(match), lambda d: F.when(F.length(d).between(13, 19), luhn(d)).otherwise(False))


@dataclass(frozen=True)
class Kind:
    """``hint``: a match holds this text (or, as a pattern, matches it); ``score`` is what a confirmed span is worth
    alone; ``shortest`` is the least length of a match."""

    name: str
    hint: str
    pattern: str
    confirmed: Callable[[Column], Column]
    score: float
    context: str
    shortest: int


# Account numbers as one run, or printed in groups of four. Groups after the bank's hold a digit, so words that
# follow are not taken for groups. Lookarounds are word boundaries of ASCII.
_FOUR = "(?:[0-9][A-Z0-9]{3}|[A-Z][0-9][A-Z0-9]{2}|[A-Z]{2}[0-9][A-Z0-9]|[A-Z]{3}[0-9])"
_REST = "(?:[0-9][A-Z0-9]{0,2}|[A-Z][0-9][A-Z0-9]?|[A-Z]{2}[0-9])"
IBAN = rf"[A-Z]{{2}}[0-9]{{2}}(?:[A-Z0-9]{{11,30}}|\x20[A-Z0-9]{{4}}(?:\x20{_FOUR}){{1,6}}(?:\x20{_REST})?)"

# A run of a class is entered only at its first character, or where the last match ended: from any other
# place of the run the same match would have begun earlier.
KINDS = (
    Kind("email", "@", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", lambda m: F.lit(True), 0.9, r"(?i)\b((e-?)?mail|contact|write)\b", 5),
    Kind("ip", ".", r"(?=[0-9])(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", _small_parts, 0.6, r"(?i)\b(ip|host|server|address|login)\b", 7),
    Kind("card", "", r"[0-9](?:[\x20-]?[0-9])++", _card, 0.8, r"(?i)\b(card|credit|visa|payment|pay)\b", 2),
    Kind("phone", "+", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: F.length(_digits(m)).between(9, 15), 0.6, r"(?i)\b(phone|tel|call|mobile|fax)\b", 4),
    Kind("iban", "", rf"(?i)(?<![A-Z0-9_]){IBAN}(?![A-Z0-9_])", mod97, 0.9, r"(?i)\b(iban|bank|account)\b", 15),
    Kind("national_id", "-", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", lambda m: F.lit(True), 0.3, r"(?i)\b(ssn|social|security|identity)\b", 11),
)
BASE = 4  # kinds that the plain patterns and checks decide; their spans are always reported


def running(values: Column, add: Callable[[Column, Column], Column], zero: Column) -> Column:
    """What stands before each place of an array of numbers, folded from ``zero`` (which changes nothing).

    Folded in parts: taking a slice walks over its whole array, so slices are taken from short ones.
    """

    def fold(part: Column) -> Column:
        return F.aggregate(part, zero, add)

    def before(part: Column, first: Column) -> Column:
        return let(part, lambda p: fold_emitting(p, first, lambda acc, x: (add(acc, x), F.array(acc)), "int", lambda _, out: out))

    def spread(parts: Column) -> Column:
        return let(F.transform(parts, fold), lambda sums: F.flatten(F.transform(parts, lambda p, j: before(p, fold(F.slice(sums, F.lit(1), j))))))

    def cut(v: Column) -> Column:
        starts = F.when(F.size(v) > 0, F.sequence(F.lit(1), F.size(v), F.lit(_PART))).otherwise(F.array().cast("array<int>"))
        return let(F.transform(starts, lambda s: F.slice(v, s, F.lit(_PART))), spread)

    return let(values, cut)


def pieces_of(text: Column, body: Callable[[Callable[[Column, Column], Column]], Column]) -> Column:
    """``body`` with a function (start, end) that cuts the text without walking to the start each time.

    Places count code points; a text is cut into chunks once, and a piece is taken from the chunks it lies in.
    """

    def cutting(chunks: Column) -> Column:
        def piece(start: Column, end: Column) -> Column:
            first = F.call_function("div", start, F.lit(_CHUNK)).cast("int")
            count = F.call_function("div", end - 1, F.lit(_CHUNK)).cast("int") - first + 1
            # Almost every piece lies in one chunk or two; a slice walks over all chunks.
            near = F.concat(F.get(chunks, first), F.when(count == 2, F.get(chunks, first + 1)).otherwise(""))
            held = F.when(count <= 2, near).otherwise(F.array_join(F.slice(chunks, first + 1, count), ""))
            return F.when(end > start, F.substring(held, start - first * _CHUNK + 1, end - start)).otherwise("")

        return body(piece)

    return let(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{_CHUNK}}}"), F.lit(0)), cutting)


def _matches(text: Column, kind: Kind) -> Column:
    found = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    likely = F.contains(text, F.lit(kind.hint)) & text.rlike("[0-9]") if kind.name != "email" else F.contains(text, F.lit("@"))
    return F.when(likely, found).otherwise(F.array().cast("array<string>"))


def _spans(text: Column, matches: Column, number: int, kind: Kind) -> Column:
    """array<struct<kind, start, end, score>> of one kind: the pieces between the matches give the places."""

    reach = -(-NEAR // kind.shortest)  # so many matches fill NEAR code points, whatever lies between them

    def placed(pieces: Column) -> Column:
        sizes = F.transform(matches, lambda m, i: F.length(F.get(pieces, i)) + F.length(m))

        def around(i: Column) -> Column:
            def earlier(j: Column) -> Column:
                return F.concat(F.right(F.get(pieces, j), F.lit(NEAR)), F.when(j < i, F.right(F.get(matches, j), F.lit(NEAR))).otherwise(""))

            def later(j: Column) -> Column:
                return F.concat(F.when(j > i + 1, F.left(F.get(matches, j - 1), F.lit(NEAR))).otherwise(""), F.left(F.get(pieces, j), F.lit(NEAR)))

            before = F.concat_ws("", F.transform(F.sequence(F.greatest(i - reach, F.lit(0)), i), earlier))
            after = F.concat_ws("", F.transform(F.sequence(i + 1, F.least(i + 1 + reach, F.size(matches))), later))
            return F.concat(F.right(before, F.lit(NEAR)), F.lit(" "), F.left(after, F.lit(NEAR)))

        def span(before: Column) -> Column:
            def one(m: Column, i: Column) -> Column:
                start = F.get(before, i) + F.length(F.get(pieces, i))
                return F.struct(i.alias("at"), start.alias("start"), (start + F.length(m)).alias("end"), kind.confirmed(m).alias("ok"))

            return F.filter(F.transform(matches, one), lambda s: s["ok"])

        def scored(s: Column) -> Column:
            score = F.lit(kind.score) + F.when(around(s["at"]).rlike(kind.context), BONUS).otherwise(0.0)
            return F.struct(F.lit(number).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), F.least(score, F.lit(1.0)).alias("score"))

        return F.transform(let(running(sizes, lambda a, x: a + x, F.lit(0)), span), scored)

    wanted = F.when(F.size(matches) > 0, F.split(text, kind.pattern, -1)).otherwise(F.array().cast("array<string>"))
    return F.filter(let(wanted, placed), lambda s: (s["kind"] < BASE) | (s["score"] >= LEAST_SCORE))


def find(documents: DataFrame, keep: list[str], name: str = "spans") -> DataFrame:
    """Columns ``keep`` and ``name``: array<struct<kind, start, end, score>>, by kind, then start."""
    step = documents.select(*keep, F.coalesce("text", F.lit("")).alias("__text"))
    step = step.select("*", *(_matches(F.col("__text"), k).alias(f"__m{i}") for i, k in enumerate(KINDS)))
    step = step.select(*keep, *(_spans(F.col("__text"), F.col(f"__m{i}"), i, k).alias(f"__s{i}") for i, k in enumerate(KINDS)))
    return step.select(*keep, F.concat(*(f"__s{i}" for i in range(len(KINDS)))).alias(name))


def _written(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*(F.lit(k.name) for k in KINDS))
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))))


def report(documents: DataFrame) -> DataFrame:
    """doc_id, counts by kind, base_sha256 (of the four base kinds' spans), spans and their lowest score."""
    found = find(documents.select("doc_id", "text"), ["doc_id"])

    def count(i: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == i)).cast("long").alias(f"n_{KINDS[i].name}")

    base = F.filter("spans", lambda s: s["kind"] < BASE)
    return found.select(
        "doc_id", *(count(i) for i in range(BASE)), F.sha2(_written(base).cast("binary"), 256).alias("base_sha256"), _written(F.col("spans")).alias("spans"),
        *(count(i) for i in range(BASE, len(KINDS))), F.array_min(F.transform("spans", lambda s: s["score"])).alias("lowest_score"),
    )


def redact(documents: DataFrame) -> DataFrame:
    """Documents with every span (overlapping ones as one) replaced by its kind in angle brackets.

    n_chars, where there is such a column, follows the text. NULL text stays NULL.
    """
    own = documents.columns
    found = find(documents, own, "__spans")
    names = F.array(*(F.lit(f"<{k.name.upper()}>") for k in KINDS))

    def rebuilt(ordered: Column) -> Column:
        reach = running(F.transform(ordered, lambda s: s["end"]), lambda a, x: F.greatest(a, x), F.lit(0))

        def cut(ends: Column) -> Column:
            heads = F.filter(F.transform(ordered, lambda s, i: F.when(s["start"] >= F.get(ends, i), i)), lambda i: i.isNotNull())

            def joined(at: Column) -> Column:
                def cutting(piece: Callable[[Column, Column], Column]) -> Column:
                    def replaced(i: Column) -> Column:
                        s = F.get(ordered, i)
                        return F.concat(piece(F.get(ends, i), s["start"]), F.get(names, s["kind"]))

                    last = F.array_max(F.transform(ordered, lambda s: s["end"]))
                    return F.concat(F.concat_ws("", F.transform(at, replaced)), piece(last, F.length("text")))

                return pieces_of(F.col("text"), cutting)

            return let(heads, joined)

        return let(reach, cut)

    by_place = F.array_sort(F.transform("__spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    text = F.when(F.size("__spans") > 0, let(by_place, rebuilt)).otherwise(F.col("text"))
    done = found.withColumn("text", text)
    if "n_chars" in own:
        done = done.withColumn("n_chars", F.coalesce(F.length("text").cast(documents.schema["n_chars"].dataType), F.col("n_chars")))
    return done.select(*own)
