"""Divergences of sources against dense sums over all kept terms."""

import os
import random
from collections import Counter

import duckdb

from lexloom.llm import divergence
from tests.llm import brute
from tests.llm.test_operators import SF_DIR, rows, run

COLUMNS = ("lang", "source", "part", "item", "value", "rank")


def frame(spark, docs):
    return spark.createDataFrame([(*d, 1, "x", 0.5, 2) for d in docs], "text string, lang string, source string, doc_id int, term string, value double, n int").repartition(3)


def words(draw, vocabulary, count):
    return " ".join(draw.choice(vocabulary) for _ in range(count))


def test_hard_cases(spark, monkeypatch):
    draw = random.Random(1)
    plain = ["alpha", "Beta", "GAMMA", "élan", "Éa", "字字", "x1y", "o'clock", "\U0001f600", "z\x85z", "one\xa0two"]
    docs = [(words(draw, plain[: 4 + k % 8], draw.randrange(1, 40)), "en", f"s{k % 5}") for k in range(90)]
    docs += [(None, "en", "s9"), ("", "en", None), (None, None, None), ("123 456", "fr", "a"), ("rare words only", "fr", "b"), ("rare", "fr", "b"), ("alone", "de", "d")]
    docs += [("same text here", "es", "é")] * 7 + [("same text", "es", "z")] * 5 + [("Same here", "es", "Z")] * 3 + [("long " * 5000 + "tail", "es", "z")]
    want = Counter(brute.audit(docs))
    assert rows(divergence.audit(frame(spark, docs)), *COLUMNS) == want
    monkeypatch.setattr(divergence, "HELD", 3)  # handed on after almost every document
    monkeypatch.setattr(divergence, "PIECE", 50)
    assert rows(divergence.audit(frame(spark, docs)), *COLUMNS) == want


def test_many_sources(spark):
    draw = random.Random(2)
    vocabulary = [f"t{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(150)]
    docs = [(words(draw, vocabulary[k % 40 : k % 40 + 60], 80), f"l{k % 2}", f"s{k % 12}") for k in range(300)]
    assert rows(divergence.audit(frame(spark, docs)), *COLUMNS) == Counter(brute.audit(docs))


def test_shares_beyond_64_bits(spark):
    df = spark.createDataFrame([(3 * 10**12, 7 * 10**12, 10**6)], "n long, total long, v long")
    got = df.select(divergence._share(df["n"], df["total"], df["v"])).first()[0]
    assert got == 1 + 10**9 * (3 * 10**12 + 2) // (7 * 10**12 + 2 * 10**6)


def test_empty_table(spark):
    empty = frame(spark, [("a", "b", "c")]).limit(0)
    assert divergence.audit(empty).collect() == []
    assert divergence.audit(empty).columns == list(COLUMNS)


def test_table(spark):
    docs = duckdb.connect().execute(f"SELECT text, lang, source FROM '{os.path.join(SF_DIR, 'documents.parquet')}'").fetchall()
    assert rows(run(spark, "op12_source_divergence"), *COLUMNS) == Counter(brute.audit(docs))
