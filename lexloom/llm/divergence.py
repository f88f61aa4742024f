"""How far the sources of a language differ in their words: exact divergences of smoothed term shares.

1. A translate table lowers A-Z and blanks every separator in one pass over a text's bytes, ``split`` cuts the
   terms, a Counter per document gives occurrences and, by its keys, document counts. A task adds the counters
   up per group and hands them on before they grow past ``HELD`` entries, so a hot source or a very common
   term sends one row a task, not one a document.
2. Spark sums the sparse counts. A language keeps the terms in at least ``LEAST`` of its documents.
3. Shares are integers: p = 1 + floor(10**9 * (count + 2) / (N + 2 V)). Absent terms of a group all have one
   share, so only present ones are rows: a pair's sum over all kept terms is V times the value of two absent
   terms, corrected by the terms present in one source (by histograms of counts) and in both (joined by term).

Rows of the joins grow with terms times the sources that have them, never with documents. Divisions are
exact (38-digit decimals), so counts may pass what 64 bits hold after scaling.

* NULL text, lang and source are read as ''. Texts without terms still make their group occur; their language
  may keep no term, and its pairs have value 0. A lone source of a language has no pair.
* Repeated rows count every time; other columns are not read. Ties go to the smaller item, in UTF-8 order.
* Very long texts: terms are cut in pieces of ``PIECE`` bytes, at separators. An empty table gives an empty result.
"""

from __future__ import annotations

import sys
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexloom.llm.common import materialize, slices

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Documents of a language that a kept term is in.
LEAST = 10
#: Terms listed per group.
TOP = 10
#: Entries of a task's counters before they are handed on.
HELD = 200_000
PIECE = 4 << 20
_LETTERS = range(ord("a"), ord("z") + 1)
#: Letters lowered, bytes of other scripts kept, all else blank.
TABLE = bytes(b if b >= 0x80 or b in _LETTERS else b + 32 if b + 32 in _LETTERS else 0x20 for b in range(256))


def term_counts(text: bytes) -> Counter:
    """Occurrences of each term of one text."""
    plain = text.translate(TABLE)
    if len(plain) <= PIECE:
        return Counter(plain.split())
    counted, at = Counter(), 0
    while at < len(plain):
        cut = plain.find(b" ", at + PIECE)
        cut = len(plain) if cut < 0 else cut
        counted.update(plain[at:cut].split())
        at = cut
    return counted


def group_counts(documents: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents; one row with the term '' per group, of n 0."""
    fields = ["lang", "source", "term", "n", "docs"]

    def rows(groups: dict[tuple, tuple[Counter, Counter]]) -> pa.RecordBatch:
        listed = [(lang, source, term, n, docs[term]) for (lang, source), (found, docs) in groups.items() for term, n in found.items()]
        types = (pa.string(), pa.string(), pa.binary(), pa.int64(), pa.int64())
        arrays = [pa.array(c, t) for c, t in zip(zip(*listed), types)]
        arrays[2] = arrays[2].cast(pa.string())
        return pa.RecordBatch.from_arrays(arrays, fields)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple, tuple[Counter, Counter]] = {}
        held = 0
        for batch in slices(batches, "text", PIECE):
            for lang, source, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "source", "text"))):
                before = len(groups[lang, source][0]) if (lang, source) in groups else 0
                occurrences, docs = groups.setdefault((lang, source), (Counter({b"": 0}), Counter()))
                counts = term_counts(text)
                occurrences.update(counts)
                docs.update(counts.keys())
                held += len(occurrences) - before
                if held > HELD:
                    yield rows(groups)
                    groups, held = {}, 0
        if groups:
            yield rows(groups)

    read = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    texts = documents.select(read("lang").alias("lang"), read("source").alias("source"), read("text").cast("binary").alias("text"))
    parts = texts.mapInArrow(counted, "lang string, source string, term string, n long, docs long")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(count: Column, total: Column, terms: Column) -> Column:
    wide = lambda c: c.cast("decimal(27,0)")
    number = lambda c: c.cast("decimal(38,0)")
    scaled = number(wide(count + 2) * F.lit(10**9).cast("decimal(10,0)"))
    return 1 + F.call_function("div", scaled, number(wide(total) + 2 * wide(terms)))


def _value(p: Column, q: Column) -> Column:
    """floor((p - q)**2 / (p + q)); shares are at most 10**9 + 1, so the square fits 64 bits."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def audit(documents: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value, rank: the other sources by distance (``pair``), the ``top`` terms over-used (``term``)."""
    counts = materialize(group_counts(documents), "counts")
    kept = counts.where("term != ''").groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n_lang")).where(F.col("docs") >= least)
    cells = materialize(counts.where("term != ''").join(kept.select("lang", "term", "n_lang"), ["lang", "term"]).select("lang", "source", "term", "n", "n_lang"), "cells")

    # One row per group: V kept terms and N_lang of its language, N of its own, and the share of an absent term.
    groups = counts.where("term = ''").select("lang", "source")
    vocabulary = cells.groupBy("lang", "term").agg(F.first("n_lang").alias("n_lang")).groupBy("lang").agg(F.count("*").alias("v"), F.sum("n_lang").alias("total_lang"))
    totals = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = groups.join(totals, ["lang", "source"], "left").join(vocabulary, "lang", "left").na.fill(0, ["total", "v", "total_lang"])
    absent = F.when(F.col("v") > 0, _share(F.lit(0), F.col("total"), F.col("v")))
    groups = materialize(groups.withColumn("absent", absent), "groups")
    shares = materialize(
        cells.join(groups, ["lang", "source"])
        .withColumn("p", _share(F.col("n"), F.col("total"), F.col("v")))
        .withColumn("q", _share(F.col("n_lang"), F.col("total_lang"), F.col("v")))
        .select("lang", "source", "term", "n", "p", "q", "absent"),
        "shares",
    )

    excess = shares.where("n > 0 AND p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _value(F.col("p"), F.col("q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = excess.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)

    # Both present: beyond what the one-sided corrections below count for the term.
    side = lambda name: shares.select("lang", "term", F.col("source").alias(name), F.col("p").alias(f"p_{name}"), F.col("absent").alias(f"z_{name}"))
    p, q, zp, zq = F.col("p_a"), F.col("p_b"), F.col("z_a"), F.col("z_b")
    both = side("a").join(side("b"), ["lang", "term"]).where("a < b").groupBy("lang", "a", "b")
    both = both.agg(F.sum(_value(p, q) - _value(p, zq) - _value(zp, q) + _value(zp, zq)).alias("part"))
    other = groups.select("lang", F.col("source").alias("b"), F.col("absent").alias("z"))
    alike = shares.groupBy("lang", "source", "absent", "p").agg(F.count("*").alias("terms"))
    one = alike.join(other, "lang").where("source != b").groupBy("lang", F.least("source", "b").alias("a"), F.greatest("source", "b").alias("b"))
    one = one.agg(F.sum(F.col("terms") * (_value(F.col("p"), F.col("z")) - _value(F.col("absent"), F.col("z")))).alias("part"))
    none = groups.select("lang", F.col("source").alias("a"), "absent", "v").join(other, "lang").where("a < b")
    none = none.select("lang", "a", "b", F.coalesce(F.col("v") * _value(F.col("absent"), F.col("z")), F.lit(0)).alias("part"))
    summed = both.union(one).union(none).groupBy("lang", "a", "b").agg(F.sum("part").alias("value"))
    ways = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    pairs = summed.select("lang", "value", ways.alias("w")).select("lang", "w.source", F.lit("pair").alias("part"), "w.item", "value")
    ranked = pairs.withColumn("rank", F.row_number().over(order))
    return ranked.union(terms)
