"""Row-local array building blocks.

Per-document order (paragraphs, tokens) is kept inside one array column, so the
operators built on these helpers need no exchange: a document is one cell of one
row and everything about it is computed where the row was read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` once for use inside ``body``.

    A column mentioned inside a lambda would otherwise be evaluated again for
    every array element; a lambda parameter is evaluated once per row. It is the
    end of a fold over nothing: unlike ``transform``, that copies no result, which
    may be all tokens of a page.
    """
    return F.aggregate(F.array().cast("array<int>"), value, lambda bound, _: bound, body)


def positions(arr: Column, keep: Callable[[Column], Column]) -> Column:
    """Zero-based positions of the elements for which ``keep`` holds, ascending."""
    marked = F.transform(arr, lambda x, i: F.when(keep(x), i))
    return F.filter(marked, lambda i: i.isNotNull())


def fold_emitting(
    values: Column,
    state: Column,
    step: Callable[[Column, Column], tuple[Column, Column]],
    element: str,
    finish: Callable[[Column, Column], Column],
    block: int = 64,
) -> Column:
    """Left fold whose steps also emit elements; ``finish`` gets the last state and all that was emitted.

    ``step`` returns the new state and the array it emits (of type ``array<element>``). Appending to one
    array copies it every time, so emitted elements are gathered per block of values and joined at the end:
    the cost is linear in the length.
    """
    nothing = F.array().cast(f"array<{element}>")

    def within(acc: Column, x: Column) -> Column:
        new, emitted = step(acc["state"], x)
        return F.struct(new.alias("state"), F.concat(acc["out"], emitted).alias("out"))

    def one_block(acc: Column, part: Column) -> Column:
        start = F.struct(acc["state"].alias("state"), nothing.alias("out"))
        return let(
            F.aggregate(part, start, within),
            lambda r: F.struct(
                r["state"].alias("state"), F.concat(acc["blocks"], F.array(r["out"])).alias("blocks")
            ),
        )

    starts = F.when(F.size(values) > 0, F.sequence(F.lit(1), F.size(values), F.lit(block))).otherwise(
        F.array().cast("array<int>")
    )
    zero = F.struct(state.alias("state"), F.array().cast(f"array<array<{element}>>").alias("blocks"))
    return F.aggregate(
        F.transform(starts, lambda s: F.slice(values, s, F.lit(block))),
        zero,
        one_block,
        lambda acc: finish(acc["state"], F.flatten(acc["blocks"])),
    )


def spread_starts(starts: Column, length: Column) -> Column:
    """Latest start at or before each position of an array of ``length`` elements.

    ``starts`` holds ascending positions. Position ``i`` of the result is the
    largest start <= i, NULL before the first one. Built from repeated runs, so
    the cost is linear in ``length``.
    """
    head = F.array_repeat(F.lit(None).cast("int"), F.coalesce(F.get(starts, F.lit(0)), length))
    runs = F.transform(
        starts, lambda s, j: F.array_repeat(s, F.coalesce(F.get(starts, j + 1), length) - s)
    )
    return F.concat(head, F.flatten(runs))


def occurrence_numbers(keys: Column) -> Column:
    """1-based count of equal keys up to and including each position (n log n)."""

    def ranked(ordered: Column) -> Column:
        run_starts = F.filter(
            F.transform(
                ordered,
                lambda x, i: F.when(
                    (i == 0) | (x["key"] != F.get(ordered, i - 1)["key"]), i
                ),
            ),
            lambda i: i.isNotNull(),
        )
        return let(
            spread_starts(run_starts, F.size(ordered)),
            lambda first: F.transform(
                F.array_sort(
                    F.transform(
                        ordered,
                        lambda x, i: F.struct(
                            x["pos"].alias("pos"), (i - F.get(first, i) + 1).alias("nth")
                        ),
                    )
                ),
                lambda x: x["nth"],
            ),
        )

    keyed = F.transform(keys, lambda k, i: F.struct(k.alias("key"), i.alias("pos")))
    return let(F.array_sort(keyed), ranked)
